import hashlib
import random
import zlib

import pytest

from tabflow.llm import repair as R
from tabflow.llm.queries import op13_structure_repair

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def legal(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(body) > 0 and body == "ua" * (len(body) // 2))


def brute(rows):
    """Least (cost, audit) over every edit of every row with up to two insertions around each."""
    faults, met = [], set()
    for role, text in rows:
        core = text.rstrip(WHITE)
        faults.append("blank" if not core else "duplicate" if (role, text) in met else "truncated" if core[-1] not in ".!?" else "")
        met.add((role, text))
    inserts = [()] + [(r,) for r in R.ROLES] + [(a, b) for a in R.ROLES for b in R.ROLES]
    best = {(): (0, "", "")}
    todo = {("", "", 0, ())}
    for gap in range(len(rows) + 1):
        grown = set()
        for audit, initials, cost, out in todo:
            for ins in inserts:
                grown.add((audit + "I" * len(ins), initials + "".join(r[0] for r in ins), cost + 2 * len(ins), out + tuple((r, "") for r in ins)))
        todo = grown
        if gap == len(rows):
            break
        (role, text), fault = rows[gap], faults[gap]
        nxt = set()
        for audit, initials, cost, out in todo:
            nxt.add((audit + "D", initials, cost + 3, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role:
                    nxt.add((audit + "K", initials + role[:1], cost + extra, out + ((role, text),)))
                for r in R.ROLES:
                    nxt.add((audit + "R", initials + r[0], cost + 2 + extra, out + ((r, text),)))
        # nothing but dead prefixes goes
        todo = {x for x in nxt if legal(x[1]) or legal(x[1] + "a") or x[1] == "s"}
    cost, audit, out = min((cost, audit, out) for audit, initials, cost, out in todo if legal(initials))
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    return {"cost": cost, "audit": audit, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"), "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}


def corpus(n, seed, longest):
    rng = random.Random(seed)
    for conv in range(n):
        yield conv, [(rng.choice(["user", "assistant", "system", "tool", "", "user", "assistant"]),
                      rng.choice(["", " \t", "Yes.", "No", "Why? ", "So!", "So!"])) for _ in range(rng.randint(1, longest))]


@pytest.mark.parametrize("segment", [R.SEGMENT_ROWS, 2])
def test_equals_brute_force(spark, segment):
    convs = dict(corpus(80, 7, 4))
    rows = [(c, t, role, text, "x") for c, rs in convs.items() for t, (role, text) in enumerate(rs)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, copies string")
    got = {r["conv_id"]: r.asDict() for r in R.repair(df.repartition(5), segment_rows=segment).collect()}
    assert sorted(got) == sorted(convs)
    for c, rs in convs.items():
        want = brute(rs)
        assert {k: got[c][k] for k in want} == want, (c, rs)
        assert got[c]["gaps"] == 0


def test_long_conversation_across_partitions_and_segments(spark):
    rng = random.Random(3)
    turns = [(rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", "a%d." % t, ""])) for t in range(700)]
    rows = [("hot", t, *x) for t, x in enumerate(turns)] + [(f"c{i}", 0, "user", "Hi.") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(9)
    results = []
    for segment in (R.SEGMENT_ROWS, 40, 7):
        results.append({r["conv_id"]: tuple(r) for r in R.repair(df, segment_rows=segment).collect()})
    assert results[0] == results[1] == results[2] and len(results[0]) == 301
    # the rows repaired are legal, and a plain table over four states finds the same cost
    parser = R.Parser()
    state, met = parser.begin(), set()
    for role, text in turns:
        state = parser.step(state, R._kind(role, text, (role, text) in met)[0])
        met.add((role, text))
    cost, edits = parser.ends(state)[parser.accepting]
    out = list(parser.replay(edits, turns))
    assert legal("".join(r[0] for r, _ in out)) and results[0]["hot"][6:8] == (cost, parser.audit(edits))
    assert len(parser.memo) < 400


def test_nulls_gaps_copies_and_missing_rows(spark):
    rows = [(1, None, "user", "First.", 1), (1, 5, "assistant", "Then.", 1), (1, 2, None, None, 1), (1, 5, "assistant", "Then.", 2),
            (2, 0, "user", "Gone.", 0), (None, None, "user", "A.", 1), (None, None, "assistant", "B.", 1), (3, 4, "user", "Hi.", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n long")
    got = {r["conv_id"]: r for r in R.repair(df, copies_col="n").collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert set(got) == {1, 2, 3, None}
    assert (got[1]["gaps"], got[1]["blank"], got[1]["duplicate"], got[1]["audit"], got[1]["cost"]) == (2, 1, 2, "KDKDD", 9)
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert got[3]["gaps"] == 0 and got[3]["audit"] == "KI" and got[None]["cost"] <= 4
    assert R.repair(df.limit(0), copies_col="n").count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "What. Now? Go!") for c in range(40) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in R.damaged(df).collect():
        fault = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        assert r["copies"] == {0: 0, 3: 2}.get(fault, 1) and r["role"] == ("user" if fault == 4 else "assistant")
        assert fault == 0 or r["text"] == {1: "", 2: "What Now Go"}.get(fault, "What. Now? Go!")


def test_other_grammars():
    chain = R.Parser((("S", ("T",)), ("S", ("S", "T")), ("T", ("u",)), ("T", ("u", "a"))))
    state = chain.begin()
    for initial in "auaa":
        state = chain.step(state, R.Row(initial, False, 0))
    cost, edits = chain.ends(state)[chain.accepting]
    assert cost == 4
    with pytest.raises(ValueError, match="bounded"):
        R.Parser((("S", ("u",)), ("S", ("u", "S"))))


def test_query_covers_every_conversation(spark):
    ids = {r[0] for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().collect()}
    got = op13_structure_repair(spark, SF).collect()
    assert sorted(r["conv_id"] for r in got) == sorted(ids)
