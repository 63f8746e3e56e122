"""Conversation structure repair by generalised LR parsing (operator 13).

The legal sequences of roles are a grammar over role initials.  Its LR(0) automaton reads the rows of a
conversation; every action of a table entry is followed, as in a generalised parser, and four kinds of edits
are actions too: keep a row (shift its role), rerole it (shift another role), delete it (no shift), insert a row
(shift without reading).  Stacks are linked cells (state, cell below), interned, so that equal tops of
different histories are one cell; a cell keeps the least (cost, audit) that reaches it, the audit being the
edits so far.  Edits of equal cost are compared by their initials; two audits of one cell, one place and one
cost are never prefixes of one another, so the least prefix stays the least whatever follows.

The cells with their costs relative to the least one, and the order of their audits, have few forms; a form
and a kind of row give the next form, so each is worked out once (:meth:`Parser.step`) and a row costs one
look-up.  Stacks of the grammar must stay bounded (left recursion); others are refused.

On Spark: equal rows of one place are counted, rows are ordered by ranges of (conversation, turn), so that a
long conversation lies in several partitions.  A conversation inside one partition is parsed there.  Those at
the edges, and long ones, go on in segments of at most ``SEGMENT_ROWS`` rows: each segment is parsed from
every cell it can begin with, the segments' summaries are joined per conversation, then every segment writes
its part of the repaired rows.  Only the parts of one conversation, not its rows, meet in one task (its audit and digest
are one value each).

Defined results: a null role or text is one space; rows without a turn come first; rows of one turn are ordered by
a hash of role and text; equal rows of a turn are duplicates of the first; an empty role has no initial and
cannot be kept; conversations without an id are one conversation; one whose rows all have no copies has zeros, an
empty audit and the digest of nothing; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import stored

# (symbol, replacement); the first symbol is the start, symbols without a replacement are role initials
ROLE_GRAMMAR = (("S", ()), ("S", ("B",)), ("S", ("s", "B")), ("B", ("P",)), ("B", ("B", "P")), ("P", ("u", "a")))
ROLES = ("user", "assistant")          # what a row can be reroled to or inserted as
LEGAL_PAIRS = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
MAX_CELLS = 256
SEGMENT_ROWS = 20_000
SEGMENT_BYTES = 16 << 20


@dataclass(frozen=True)
class Row:
    """What the parser sees of a row: its initial, whether it must go, what keeping it costs besides."""
    initial: str
    must_go: bool
    extra: int


class Parser:
    """LR(0) automaton of a role grammar with its weighted edits."""

    def __init__(self, grammar=ROLE_GRAMMAR, roles=ROLES):
        self.grammar, self.roles = (("", (grammar[0][0],)),) + tuple(grammar), tuple(roles)
        self.nonterminals = {left for left, _ in grammar}
        if any(not right for left, right in grammar if left != grammar[0][0]):
            raise ValueError("only the start symbol of a role grammar can be empty")
        # one character per edit, ordered as its initial; D, I, K, R with the role as the last word
        self.codes, self.initials, self.targets = {}, {}, {}
        for n, (initial, role) in enumerate([("D", None)] + [("I", r) for r in roles] + [("K", None)] + [("R", r) for r in roles]):
            code = chr(97 + n)
            self.codes[initial, role], self.initials[code], self.targets[code] = code, initial, role
        self._states()
        self.cells, self.ids = [], {}
        self.start = self._cell(0, None)
        self._all_cells()
        self.memo: dict = {}
        self.forms: dict = {}

    # the automaton
    def _closure(self, items):
        out, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            right = self.grammar[rule][1]
            if dot < len(right):
                for n, (left, _) in enumerate(self.grammar):
                    if n and left == right[dot] and (n, 0) not in out:
                        out.add((n, 0))
                        todo.append((n, 0))
        return frozenset(out)

    def _states(self):
        first = self._closure({(0, 0)})
        numbers, self.goto, self.reduces, todo = {first: 0}, {}, {}, [first]
        while todo:
            state = todo.pop()
            at = numbers[state]
            self.reduces[at] = sorted(rule for rule, dot in state if rule and dot == len(self.grammar[rule][1]))
            for symbol in sorted({self.grammar[r][1][d] for r, d in state if d < len(self.grammar[r][1])}):
                following = self._closure({(r, d + 1) for r, d in state if d < len(self.grammar[r][1]) and self.grammar[r][1][d] == symbol})
                if following not in numbers:
                    numbers[following] = len(numbers)
                    todo.append(following)
                self.goto[at, symbol] = numbers[following]

    # linked stacks
    def _cell(self, state, below):
        key = (state, below)
        if key not in self.ids:
            if len(self.cells) >= MAX_CELLS:
                raise ValueError("the stacks of this role grammar are not bounded; write it with left recursion")
            self.ids[key] = len(self.cells)
            self.cells.append(key)
        return self.ids[key]

    def _shift(self, cell, symbol):
        to = self.goto.get((self.cells[cell][0], symbol))
        return None if to is None else self._cell(to, cell)

    def _reduced(self, cell):
        for rule in self.reduces[self.cells[cell][0]]:
            left, right = self.grammar[rule]
            base = cell
            for _ in right:
                base = self.cells[base][1]
            yield self._shift(base, left)

    def _all_cells(self):
        symbols = {s for _, right in self.grammar for s in right} - self.nonterminals
        todo = [self.start]
        seen = set(todo)
        while todo:
            cell = todo.pop()
            for to in [*self._reduced(cell), *(self._shift(cell, s) for s in sorted(symbols))]:
                if to is not None and to not in seen:
                    seen.add(to)
                    todo.append(to)
        self.accepting = self._shift(self.start, self.grammar[0][1][0])

    def _close(self, tops: dict) -> dict:
        """Reductions and insertions from {cell: (cost, root, edits)} until every cell has its least."""
        best, heap = {}, [(weight, cell) for cell, weight in tops.items()]
        heapq.heapify(heap)
        while heap:
            weight, cell = heapq.heappop(heap)
            if cell in best:
                continue
            best[cell] = weight
            for to in self._reduced(cell):
                if to not in best:
                    heapq.heappush(heap, (weight, to))
            cost, root, edits = weight
            for role in self.roles:
                to = self._shift(cell, role[0])
                if to is not None and to not in best:
                    heapq.heappush(heap, ((cost + INSERT, root, edits + self.codes["I", role]), to))
        return best

    def _form(self, tops: dict):
        """The form of {cell: (cost, root, edits)}: cells with costs over the least and audits as (root, rest), where
        no root is a prefix of another; with the least cost and what each root appends to which old one."""
        least = min(w[0] for w in tops.values())
        roots = []
        for root, edits in sorted({w[1:] for w in tops.values()}):
            if not (roots and roots[-1][0] == root and edits.startswith(roots[-1][1])):
                roots.append((root, edits))
        form = []
        for cell in sorted(tops):
            cost, root, edits = tops[cell]
            at = next(n for n, (r, e) in enumerate(roots) if r == root and edits.startswith(e))
            form.append((cell, cost - least, at, edits[len(roots[at][1]):]))
        form = tuple(form)
        return self.forms.setdefault(form, form), least, tuple(roots)

    def begin(self, cell: int | None = None):
        """(form, cost, audits) before any row: of the whole text, or of a segment that begins with a cell."""
        tops = self._close({self.start: (0, 0, "")}) if cell is None else {cell: (0, 0, "")}
        form, cost, roots = self._form(tops)
        return form, cost, [(None, edits) for _, edits in roots]

    def _worked_out(self, form, row: Row):
        tops: dict = {}

        def offer(cell, weight):
            if cell is not None and (cell not in tops or weight < tops[cell]):
                tops[cell] = weight

        for cell, cost, root, rest in form:
            offer(cell, (cost + DELETE, root, rest + self.codes["D", None]))
            if not row.must_go:
                if row.initial:
                    offer(self._shift(cell, row.initial), (cost + KEEP + row.extra, root, rest + self.codes["K", None]))
                for role in self.roles:
                    offer(self._shift(cell, role[0]), (cost + REROLE + row.extra, root, rest + self.codes["R", role]))
        return self._form(self._close(tops))

    def step(self, state, row: Row):
        """One row read: an audit is a chain (what came before, edits)."""
        form, cost, audits = state
        key = (form, row)
        found = self.memo.get(key)
        if found is None:
            found = self.memo[key] = self._worked_out(form, row)
        following, more, moves = found
        return following, cost + more, [(audits[root], edits) for root, edits in moves]

    def ends(self, state) -> dict:
        """{cell: (cost, edits)} with the edits written out."""
        form, cost, audits = state
        texts = [_chain(a) for a in audits]
        return {cell: (cost + over, texts[root] + rest) for cell, over, root, rest in form}

    def audit(self, edits: str) -> str:
        return "".join(self.initials[c] for c in edits)

    def replay(self, edits: str, rows):
        """The repaired (role, text) rows."""
        rows = iter(rows)
        for code in edits:
            kind, role = self.initials[code], self.targets[code]
            if kind == "I":
                yield role, ""
                continue
            own, text = next(rows)
            if kind != "D":
                yield (own if kind == "K" else role), text


def _chain(audit) -> str:
    parts = []
    while audit is not None:
        audit, edits = audit
        parts.append(edits)
    return "".join(reversed(parts))


def _kind(role: str, text: str, seen: bool) -> tuple[Row, int]:
    """What the parser sees, and the row's first fault: 0 none, 1 blank, 2 duplicate, 3 truncated."""
    core = text.rstrip(BLANKS)
    if not core:
        return _row(role[:1], True, 0), 1
    if seen:
        return _row(role[:1], True, 0), 2
    if core[-1] not in ENDINGS:
        return _row(role[:1], False, TRUNCATED), 3
    return _row(role[:1], False, 0), 0


_ROWS: dict = {}


def _row(*key) -> Row:
    if key not in _ROWS:
        if len(_ROWS) > 10_000:
            _ROWS.clear()
        _ROWS[key] = Row(*key)
    return _ROWS[key]


class _Faults:
    """Counts over rows in order; segments of one conversation are added in order."""

    def __init__(self):
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.first = self.last = ""

    def add(self, turn, initial: str, fault: int):
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        if self.rows:
            self.illegal += self.last + initial not in LEGAL_PAIRS or not (self.last and initial)
        else:
            self.first = initial
        self.last = initial
        self.rows += 1

    def join(self, other: dict):
        if not other["rows"]:
            return
        if other["low"] is not None:
            self.turns += other["turns"] - (self.high == other["low"])
            self.low = other["low"] if self.low is None else self.low
            self.high = other["high"]
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + other[name])
        if self.rows:
            self.illegal += self.last + other["first"] not in LEGAL_PAIRS or not (self.last and other["first"])
        else:
            self.first = other["first"]
        self.last = other["last"]
        self.rows += other["rows"]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


_FAULTS = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, rows long, first string, last string"
_FAULT_NAMES = [f.split()[0] for f in _FAULTS.split(", ")]
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT_NAMES = [f.split()[0] for f in _RESULT.split(", ")]


def _digest(pieces) -> str:
    """The digest of rows "role:text" joined by newlines."""
    sha, first = hashlib.sha256(), True
    for role, text in pieces:
        sha.update((("" if first else "\n") + role + ":" + text).encode())
        first = False
    return sha.hexdigest()


def _copies(rows):
    """(turn, role, text, whether seen before) of rows (turn, role, text, copies, seen before)."""
    for turn, role, text, copies, seen in rows:
        for n in range(copies):
            yield turn, role, text, seen or n > 0


def _whole(parser: Parser, rows) -> tuple:
    """The result of one conversation whose rows (turn, role, text, copies) are at hand in order."""
    met, marked = set(), []
    for turn, role, text, copies in rows:
        if copies:
            marked.append((turn, role, text, copies, (role, text) in met))
            met.add((role, text))
    faults, state, kept = _Faults(), parser.begin(), []
    for turn, role, text, seen in _copies(marked):
        row, fault = _kind(role, text, seen)
        faults.add(turn, role[:1], fault)
        state = parser.step(state, row)
        kept.append((role, text))
    cost, edits = parser.ends(state)[parser.accepting]
    return (faults.gaps, faults.blank, faults.duplicate, faults.truncated, faults.illegal, cost, parser.audit(edits),
            _digest(parser.replay(edits, kept)))


def _first_pass(kind: str, segment_rows: int, segment_bytes: int, grammar, roles):
    """Batches of ordered rows -> results of conversations inside the partition, rows of the others with their segment."""
    names = ["conv", "seg", "at", "turn", "role", "text", "copies", *_RESULT_NAMES]

    def run(batches):
        parser = Parser(grammar, roles)
        base = TaskContext.get().partitionId() << 32
        first, current, held, size, chunk, n, place = True, None, [], 0, 0, 0, 0
        out: list[list] = [[] for _ in names]
        weight = 0

        def row(values):
            nonlocal weight
            for column, value in zip(out, values):
                column.append(value)
            weight += 64 + len(values[5] or "") + len(values[13] or "")

        def pass_on(conv, rows):
            nonlocal chunk, n, place, size
            for turn, role, text, copies in rows:
                if n >= segment_rows or size >= segment_bytes:
                    chunk, n, size = chunk + 1, 0, 0
                row((conv, base + chunk, place, turn, role, text, copies) + (None,) * 8)
                place, n, size = place + 1, n + max(1, copies), size + len(text)

        def flush():
            nonlocal out, weight
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
            out, weight = [[] for _ in names], 0
            return batch

        types, key, long, held_bytes = None, None, False, 0
        started = False
        for batch in batches:
            if types is None:
                types = [batch.schema.field("conv").type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                         *[pa.string() if f.endswith(" string") else pa.int64() for f in _RESULT.split(", ")]]
            for conv, *rest in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies")]):
                if not started or conv != key:
                    if started:
                        if first or long:
                            pass_on(key, held)
                        else:
                            row((key, None, None, None, None, None, None) + _whole(parser, held))
                        first, long = False, False
                        chunk, n, size = chunk + 1, 0, 0
                    started, key, held, held_bytes = True, conv, [], 0
                held.append(rest)
                held_bytes += len(rest[2])
                # rows that are passed on anyway are not held
                if first or long or len(held) > segment_rows or held_bytes > segment_bytes:
                    long = long or not first
                    pass_on(key, held)
                    held, held_bytes = [], 0
                if weight > 4 << 20:
                    yield flush()
        if started:
            pass_on(key, held)
        if types is not None:
            yield flush()

    return run, f"conv {kind}, seg long, at long, turn long, role string, text string, copies long, {_RESULT}"


def _segment_summary(grammar, roles):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parser = Parser(grammar, roles)
        rows = rows.sort_values("at")
        faults, kinds = _Faults(), []
        turns = [None if pd.isna(t) else int(t) for t in rows["turn"]]
        for turn, role, text, seen in _copies(zip(turns, rows["role"], rows["text"], rows["copies"], rows["seen"])):
            row, fault = _kind(role, text, seen)
            faults.add(turn, role[:1], fault)
            kinds.append(row)
        found = []
        for cell in range(len(parser.cells)):
            state = parser.begin(cell)
            for row in kinds:
                state = parser.step(state, row)
            found += [(cell, to, cost, edits) for to, (cost, edits) in parser.ends(state).items()]
        out = pd.DataFrame(found, columns=["cell", "to", "cost", "edits"])
        out.insert(0, "conv", [rows["conv"].iloc[0]] * len(out))
        out.insert(1, "seg", rows["seg"].iloc[0])
        for name in _FAULT_NAMES:
            out[name] = pd.Series([getattr(faults, name)] * len(out), dtype=object)
        return out
    return run


def _best_path(grammar, roles):
    """Per conversation: the edits of each segment, and one row (seg null) with the counts, cost and audit."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parser = Parser(grammar, roles)
        conv, faults = rows["conv"].iloc[0], _Faults()
        form, cost, audits = parser.begin()
        lead = {cell: _chain(audits[root]) + rest for cell, _, root, rest in form}
        tops = {cell: (cost + over, lead[cell]) for cell, over, _, _ in form}
        segs, chosen = [], {}
        for seg, part in rows.groupby("seg", sort=True):
            one = part.iloc[0]
            faults.join({n: (None if pd.isna(one[n]) else one[n]) if n in ("low", "high") else one[n] for n in _FAULT_NAMES})
            new, back = {}, {}
            for cell, to, more, edits in zip(part["cell"], part["to"], part["cost"], part["edits"]):
                if cell in tops:
                    weight = (tops[cell][0] + more, tops[cell][1] + edits)
                    if to not in new or weight < new[to]:
                        new[to], back[to] = weight, (cell, edits)
            segs.append((seg, back))
            tops = new
        cost, edits = tops[parser.accepting]
        out, cell = [], parser.accepting
        for seg, back in reversed(segs):
            cell, own = back[cell]
            chosen[seg] = own
        # edits before the first row belong to the first segment
        if segs:
            chosen[segs[0][0]] = lead[cell] + chosen[segs[0][0]]
        nothing = (None,) * 7
        out = [(conv, seg, own) + nothing for seg, own in sorted(chosen.items())]
        out.append((conv, None, None, faults.gaps, faults.blank, faults.duplicate, faults.truncated, faults.illegal, cost, parser.audit(edits)))
        return pd.DataFrame(out, columns=["conv", "seg", "edits", *_RESULT_NAMES[:-1]]).astype(object)
    return run


def _segment_text(grammar, roles):
    """A segment's rows and its edits -> its part of the repaired rows, joined by newlines."""
    def run(rows: pd.DataFrame, edits: pd.DataFrame) -> pd.DataFrame:
        parser = Parser(grammar, roles)
        rows = rows.sort_values("at")
        ordered = [(role, text) for _, role, text, _ in _copies(zip(rows["turn"], rows["role"], rows["text"], rows["copies"], rows["seen"]))]
        lines = [f"{role}:{text}" for role, text in parser.replay(edits["edits"].iloc[0], ordered)]
        return pd.DataFrame({"conv": [edits["conv"].iloc[0]], "seg": [edits["seg"].iloc[0]], "lines": [len(lines)], "part": ["\n".join(lines)]})
    return run


def _joined_digest(batches):
    """Parts ordered by (conv, seg) -> one digest a conversation, never held whole."""
    key, sha, lines, started = None, None, 0, False
    done: tuple[list, list] = ([], [])
    kind = None
    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, n, part in zip(*[batch.column(c).to_pylist() for c in ("conv", "lines", "part")]):
            if not started or conv != key:
                if started:
                    done[0].append(key)
                    done[1].append(sha.hexdigest())
                key, sha, lines, started = conv, hashlib.sha256(), 0, True
            if n:
                sha.update((("\n" if lines else "") + part).encode())
                lines += n
    if started:
        done[0].append(key)
        done[1].append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(done[0], kind), pa.array(done[1], pa.string())], ["conv", "repaired_sha256"])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies_col: str | None = None, grammar=ROLE_GRAMMAR, roles=ROLES, segment_rows: int = SEGMENT_ROWS,
           segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(conversation, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row a conversation.

    ``copies_col``: how often a row stands there (0: the conversation is known, the row is not there)."""
    kind = rows.schema[conv_col].dataType.simpleString()
    space = F.lit(" ")
    plain = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
                        (F.col(copies_col).cast("long") if copies_col else F.lit(1).cast("long")).alias("copies"))
    counted = plain.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = ["conv", "turn", "tie"]
    ordered = (counted.withColumn("tie", F.xxhash64("role", "text")).repartitionByRange(*order)
               .sortWithinPartitions(*order, "role", "text").drop("tie"))
    run, schema = _first_pass(kind, segment_rows, segment_bytes, grammar, roles)
    passed = stored(ordered.mapInArrow(run, schema), "repair-pass")
    inside = passed.where("seg is null").select("conv", *_RESULT_NAMES)

    edge = passed.where("seg is not null")
    # the first of equal rows; copies of nothing are no row
    seen_key = [F.col("conv"), F.md5(F.concat_ws("\x00", "role", "text")).alias("digest")]
    placed = edge.select("conv", "seg", "at", "turn", "role", "text", "copies", seen_key[1])
    firsts = (placed.where("copies > 0").groupBy("conv", "digest").agg(F.min(F.struct("seg", "at")).alias("first"))
              .select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first"))
    marked = (placed.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
              .select("conv", "seg", "at", "turn", "role", "text", "copies",
                      F.coalesce(F.col("first") < F.struct("seg", "at"), F.lit(False)).alias("seen")))
    marked = stored(marked, "repair-edge")
    summaries = marked.groupBy("conv", "seg").applyInPandas(
        _segment_summary(grammar, roles), f"conv {kind}, seg long, cell long, to long, cost long, edits string, {_FAULTS}")
    paths = stored(summaries.groupBy("conv").applyInPandas(
        _best_path(grammar, roles), f"conv {kind}, seg long, edits string, " + ", ".join(_RESULT.split(", ")[:-1])), "repair-paths")
    parts = (marked.groupBy("conv", "seg").cogroup(paths.where("seg is not null").select("conv", "seg", "edits").groupBy("conv", "seg"))
             .applyInPandas(_segment_text(grammar, roles), f"conv {kind}, seg long, lines long, part string"))
    digests = (parts.repartition("conv").sortWithinPartitions("conv", "seg")
               .mapInArrow(_joined_digest, f"conv {kind}, repaired_sha256 string"))
    totals = paths.where("seg is null").drop("seg", "edits", "repaired_sha256")
    across = totals.join(digests.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).select("conv", *_RESULT_NAMES)
    return inside.unionByName(across).withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows with seeded faults and their number of ``copies``: a twentieth each is dropped (no copy), emptied, cut of its
    sentence ends, repeated (two copies) or said by the user."""
    space = F.lit(" ")
    told = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in (role_col, text_col))
    rows = rows.select(conv_col, turn_col, role.alias(role_col), text.alias(text_col), (F.crc32(told.cast("binary")) % 20).alias("__fault"))
    fault = F.col("__fault")
    return rows.select(
        conv_col, turn_col, F.when(fault == 4, "user").otherwise(F.col(role_col)).alias(role_col),
        F.when(fault <= 1, "").when(fault == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(F.col(text_col)).alias(text_col),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))


SQL = r"""
with recursive told as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' ')) as k from conversations),
bytes as (select distinct k from told),
crc as (select k, 0 as i, 4294967295::ubigint as c from bytes
  union all
  select k, i + 1, list_reduce(list_prepend(xor(c, ascii(k[(i // 1 + 1)::int])::ubigint), range(8)::ubigint[]),
    lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384::ubigint) else a >> 1 end)
  from crc where i < length(k)),
faults as (select k, xor(c, 4294967295::ubigint) % 20 as f from crc where i = length(k)),
damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, n
  from told join faults using (k), range(2) as r(n) where f <> 0 and (n = 0 or f = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, n) as p,
    row_number() over (partition by conv_id, role, text order by turn nulls first, n) > 1 as seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as core from damaged),
marked as (select conv_id, turn, role, text, p, left(role, 1) as r,
    case when core = '' then 'blank' when seen then 'duplicate' when right(core, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
  from placed),
-- states: 0 nothing read, 1 after s, 2 after u, 3 after a; after each row up to two insertions
moves as (select * from (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) m(s, r, t)),
grown as (select s, r, t, i from (
    select s, r, t, '' as i from moves union all
    select m.s, m.r, n.t, 'I' from moves m join moves n on n.s = m.t and n.r <> 's' union all
    select m.s, m.r, o.t, 'II' from moves m join moves n on n.s = m.t and n.r <> 's' join moves o on o.s = n.t and o.r <> 's')),
stays as (select * from (values (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'),
    (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')) m(s, t, i)),
edits as (
  select s, t, null as r, 'D' || i as e, 3 + 2 * length(i) as c, true as gone from stays union all
  select s, t, r, 'K' || i, 2 * length(i), false from grown union all
  select s, t, null, 'R' || i, 2 + 2 * length(i), false from grown where r <> 's'),
walk as (
  select conv_id, 0 as p, t as s, {'c': 2 * length(i), 'e': i} as w from (select distinct conv_id from marked), stays where stays.s = 0
  union all
  select walk.conv_id, any_value(walk.p) + 1, t, min({'c': w.c + edits.c + case when not gone and fault = 'truncated' then 1 else 0 end, 'e': w.e || edits.e})
  from walk join marked m on m.conv_id is not distinct from walk.conv_id and m.p = walk.p + 1
    join edits on edits.s = walk.s and (gone or m.fault not in ('blank', 'duplicate')) and (edits.r is null or edits.r = m.r)
  group by walk.conv_id, t),
counts as (
  select conv_id, max(p) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
    count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated
  from marked group by conv_id),
pairs as (select conv_id, r || lead(r) over (partition by conv_id order by p) as rr from marked),
illegal as (select conv_id, count(*) filter (where rr not in ('su', 'ua', 'au')) as illegal from pairs group by conv_id),
best as (select counts.*, min(w) as w from counts join walk on walk.conv_id is not distinct from counts.conv_id and walk.p = n and s in (0, 3)
  group by all),
replay as (
  select conv_id, w.e as e, 1 as j, 0 as p, 0 as s, [] :: varchar[] as lines from best
  union all
  select y.conv_id, e, j + 1, case when e[j] = 'I' then y.p else y.p + 1 end,
    case when e[j] = 'D' then s when e[j] = 'K' then case m.r when 's' then 1 when 'u' then 2 else 3 end when s = 2 then 3 else 2 end,
    case e[j] when 'D' then lines when 'K' then list_append(lines, m.role || ':' || m.text)
      when 'R' then list_append(lines, case when s = 2 then 'assistant:' else 'user:' end || m.text)
      else list_append(lines, case when s = 2 then 'assistant:' else 'user:' end) end
  from replay y left join marked m on m.conv_id is not distinct from y.conv_id and m.p = y.p + 1 where j <= length(e)),
texts as (select conv_id, array_to_string(lines, chr(10)) as repaired from replay where j = length(e) + 1)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(w.c, 0)::bigint as cost,
  coalesce(w.e, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join best on best.conv_id is not distinct from c.conv_id
  left join illegal on illegal.conv_id is not distinct from c.conv_id left join texts on texts.conv_id is not distinct from c.conv_id
"""
