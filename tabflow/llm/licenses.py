"""Licence scan by Dice coefficient over word bigrams (operator 5, DataFrame functions only).

Units of a document are its sentences (cut at line ends and after ``. ! ?`` before white space) and the whole
text, compared with short notices; and its paragraphs, the whole text and every window of a template's length, compared with full
licence texts, standard headers and the notices (wrapped over lines; inside one sentence only the sentence counts), and its
lines, compared with titles.  A unit and a template are normalised to lower-case words of letters and digits and compared by
the Dice coefficient of their adjacent word pairs, 2 * shared / (a + b): a sentence's size a counts all its pairs, so a
repeated pair matches once and weighs twice; of the long units distinct pairs are counted.  With threshold t, sizes a and
b can only match if a lies between b * t / (2 - t) and b * (2 - t) / t.  The size is known from the number of words, so units
that no template admits are dropped before any pair is formed, and templates out of bounds are not compared.

Nearly all texts are done with after a search for the telling words, of which every match has one.  Windows are met from left to
right: one that shares s pairs where a match needs at least m cannot match at the next m - s - 1 places either, so these
are passed over; no start that could match is left out, whatever the template's length.  Positions of lines come from one
filter over marked words, so the work on a text is linear in it but for windows around matches.

Scale: one narrow pass, no shuffle; the templates are literals (``MAX_TEMPLATE_PAIRS`` and ``MAX_TEXT_PAIRS`` checked).
Matches are kept per document as an array, never exploded.

Defined results: null and empty texts match nothing; a template of fewer than
two words has its single word as its only pair; of equal scores the template
first by name wins; repeated rows give repeated results; an empty table gives an
empty table.  Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import math
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import LOWER, UPPER

THRESHOLD = 0.8
MAX_TEMPLATE_PAIRS = 5_000
MAX_TEXT_PAIRS = 50_000
SEARCHED_WORDS = 6            # of a template, searched one by one
SEARCHED_LENGTH = 5           # shorter ones stand inside too many other words
# Words of any English text, the last to tell a licence
COMMON = set("a and are as at be by for from in is it of on or that the this to under was which with you".split())
SLACK = 1e-9                  # sizes exactly on a bound stay in; the coefficient decides

# Licence notices.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Standard headers, and titles that are a line of their own.
_GPL = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the "
        "Free Software Foundation{2} version {3} of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU {1} for more details. You should have received a copy of the GNU {1} along with this program")
HEADERS = [
    ("AGPL-3.0", _GPL.format(":", "Affero General Public License", ", either", 3)),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", _GPL.format(";", "General Public License", "; either", 2)),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", _GPL.format(":", "General Public License", ", either", 3)),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
TITLES = [("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache License, Version 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
          ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"), ("ISC", "The ISC License"), ("MIT", "MIT License"),
          ("MIT", "The MIT License"), ("MIT", "The MIT License (MIT)"), ("MPL-2.0", "Mozilla Public License Version 2.0"),
          ("Unlicense", "The Unlicense")]


@functools.cache
def texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the full licence texts and standard headers."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    return tuple([(f.stem, f.read_text("utf-8")) for f in files] + HEADERS)


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def telling_words(pairs: list[str], need: int) -> set[str]:
    """Words, rare ones first, one of which is in any ``need`` of the pairs."""
    holders: dict[str, set[str]] = {}
    for pair in pairs:
        for word in pair.split():
            holders.setdefault(word, set()).add(pair)
    chosen, left = set(), set(pairs)
    for word in sorted(holders, key=lambda w: ("licen" not in w, w in COMMON, -len(w), w)):
        if len(left) < need:
            break
        chosen.add(word)
        left -= holders[word]
    return chosen


def normal_pairs(text: str) -> list[str]:
    """The sorted set of adjacent word pairs of a template."""
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or set(words))


def _pairs(words: Column) -> Column:
    n = F.size(words)
    two = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(
        F.element_at(words, i), F.lit(" "), F.element_at(words, i + 1)))
    return F.when(n > 1, two).otherwise(words)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text", long: tuple[tuple[str, str], ...] | None = None,
         titles: list[tuple[str, str]] = TITLES) -> DataFrame:
    """(id, ``matches``): an array of (licence, dice, unit), one per matching unit, the whole text last, then the
    long matches (``long`` and ``templates`` over paragraphs and windows, ``titles`` over lines), best first.

    ``unit`` is the normalised text that matched.
    """
    known = {name: normal_pairs(text) for name, text in sorted(templates.items())}
    known = {name: pairs for name, pairs in known.items() if pairs}
    if sum(map(len, known.values())) > MAX_TEMPLATE_PAIRS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_PAIRS} word pairs")
    if not known:
        return docs.select(F.col(id_col), F.array().cast("array<struct<licence:string,dice:double,unit:string>>").alias("matches"))
    low, high = threshold / (2 - threshold) - SLACK, (2 - threshold) / threshold + SLACK
    least, most = min(map(len, known.values())) * low, max(map(len, known.values())) * high
    every = F.array(*[F.lit(p) for p in sorted({p for ps in known.values() for p in ps})])
    long = texts() if long is None else long
    if sum(len(normal_pairs(text)) for _, text in long) > MAX_TEXT_PAIRS:
        raise ValueError(f"licence texts of more than {MAX_TEXT_PAIRS} word pairs")
    long = [t for t in long if len(words_of(t[1])) > 1]
    wanted = [t for t in sorted(templates.items()) if len(words_of(t[1])) > 1] + long
    wanted_titles = [t for t in titles if words_of(t[1])]
    sets = [telling_words(normal_pairs(t), _least_shared(t, threshold)) for _, t in wanted + wanted_titles]
    telling = set().union(*sets)
    # a unit that matches holds one of these words: the texts without any, nearly all, are empty from here on.  The few words of
    # short templates are searched as they stand, those of whole licence texts among the words of the text
    notices = [telling_words(normal_pairs(t), _least_shared(t, threshold)) for t in templates.values()]
    short = {w for s in sets + notices if len(s) <= SEARCHED_WORDS for w in s if len(w) >= SEARCHED_LENGTH}
    rare = sorted(telling.union(*notices) - short)
    lower = F.col("lower")
    told = reduce(lambda a, b: a | b, [lower.contains(w) for w in sorted(short, key=lambda w: (len(w), w))], F.lit(False))
    if rare:
        told = told | F.arrays_overlap(F.split(lower, "[^a-z0-9]+"), _literals(rare))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", "text", F.translate("text", UPPER, LOWER).alias("lower")).select("id", "text", "lower", told.alias("told"))
    rows = rows.select("id", F.when(F.col("told"), F.col("text")).alias("text"), F.when(F.col("told"), lower).otherwise("").alias("lower"))
    # one sentence a line, words apart by one blank; each step binds its result once for the next
    lines = F.regexp_replace("lower", "(?<=[.!?])[ \\t\\r]+", "\n")
    sentences = F.transform(F.split(F.regexp_replace(lines, "[^a-z0-9\n]+", " "), "\n"),
                            lambda u: F.filter(F.split(u, " "), lambda w: w != ""))
    pairs_of = lambda words: F.greatest(F.size(words) - 1, F.least(F.size(words), F.lit(1)))
    fits = lambda words: (pairs_of(words) >= least) & (pairs_of(words) <= most)
    total = lambda parts: F.aggregate(parts, F.lit(0), lambda n, words: n + F.size(words))
    nothing = F.array().cast("array<array<string>>")
    whole = F.col("parts")
    whole = F.when((F.size(whole) > 1) & (total(whole) - 1 <= most), F.array(F.flatten(whole))).otherwise(nothing)
    units = F.filter(F.concat("parts", whole), fits)
    paired = F.transform("units", lambda words: F.struct(words.alias("words"), _pairs(words).alias("pairs")))
    admitted = F.filter(paired, lambda u: F.arrays_overlap(u["pairs"], every))

    def best(u: Column) -> Column:
        n = F.size(u["pairs"])
        scored = [F.when((n >= len(p) * low) & (n <= len(p) * high), F.struct(
            (2.0 * F.size(F.array_intersect(u["pairs"], F.array(*map(F.lit, p)))) / (n + len(p))).alias("dice"),
            F.lit(-i).alias("order"), F.lit(name).alias("licence"))) for i, (name, p) in enumerate(known.items())]
        return F.greatest(*scored) if len(scored) > 1 else scored[0]

    rated = F.transform(admitted, lambda u: F.struct(best(u).alias("best"), u["words"].alias("words")))
    matches = F.transform(F.filter(rated, lambda m: m["best"]["dice"] >= threshold), lambda m: F.struct(
        m["best"]["licence"].alias("licence"), m["best"]["dice"].alias("dice"), F.array_join(m["words"], " ").alias("unit")))
    words = F.flatten("parts")
    hot = F.arrays_overlap(words, _literals(telling))
    # the text goes on only where a long match is possible
    rows = rows.select("id", sentences.alias("parts"), "text")
    rows = rows.select("id", "parts", units.alias("units"), F.when(hot, F.col("text")).alias("text")).select(
        "id", matches.alias("matches"), "text", F.when(F.col("text").isNotNull(), F.col("parts")).alias("parts"))
    rows = rows.select("id", "matches", "text", "parts", F.flatten("parts").alias("words"))
    rows = rows.select("*", _pairs(F.col("words")).alias("pairs"))
    every_long = _literals({p for _, text in wanted + wanted_titles for p in normal_pairs(text)})
    rows = rows.select("*", F.array_intersect("pairs", every_long).alias("there"), F.when(F.col("text").isNotNull(), _blocks()).alias("blocks"),
                       F.when(F.col("text").isNotNull(), _spans(F.col("parts"))).alias("lines"),
                       F.when(F.col("text").isNotNull(), F.flatten(F.transform("parts", lambda w, i: F.array_repeat(i, F.size(w))))).alias("line_of"))
    rows = rows.select("id", "matches", "words", "lines", _candidates(wanted, wanted_titles, len(wanted) - len(long), threshold).alias("candidates"),
                       F.array_distinct(F.transform("matches", lambda m: F.struct(m["unit"].alias("unit"), m["licence"].alias("licence")))).alias("named"))
    rows = rows.select("*", F.transform("named", lambda m: m["unit"]).alias("named_units"), F.transform("named", lambda m: m["licence"]).alias("named_as"))
    further = F.when(F.size("candidates") > 0, _apart())
    return rows.select(F.col("id").alias(id_col), F.concat("matches", F.coalesce(further, _NO_MATCH())).alias("matches"))


_CANDIDATES = "array<struct<dice:double,order:int,start:int,stop:int,licence:string>>"
_NO_MATCH = lambda: F.array().cast("array<struct<licence:string,dice:double,unit:string>>")


def _literals(values) -> Column:
    return F.split(F.lit("\n".join(sorted(values))), "\n")


def _least_shared(text: str, threshold: float) -> int:
    """Distinct pairs that any unit matching this template shares with it at least."""
    p = len(normal_pairs(text))
    return max(1, math.ceil(threshold * (p + p * threshold / (2 - threshold)) / 2 - 1e-6))


def _spans(parts: Column) -> Column:
    """(start, length) in words of consecutive parts: the places of marks set behind each part, less the marks before."""
    marked = F.flatten(F.transform(parts, lambda w: F.concat(w, F.array(F.lit("\n")))))
    ends = F.filter(F.transform(marked, lambda w, i: F.when(w == "\n", i)), lambda i: i.isNotNull())
    edges = F.zip_with(F.concat(F.array(F.lit(-1)), ends), ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(F.filter(edges, lambda e: e["b"].isNotNull()), lambda e, k: F.struct(
        (e["a"] + 1 - k).alias("start"), (e["b"] - e["a"] - 1).alias("length")))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _blocks() -> Column:
    """Spans of the paragraphs (blank lines part them) and the whole text."""
    lower = F.translate(F.col("text"), UPPER, LOWER)
    paragraphs = F.transform(F.split(lower, "\n[ \\t\\r]*\n"), lambda t: F.filter(
        F.split(F.regexp_replace(t, "[^a-z0-9]+", " "), " "), lambda w: w != ""))
    return F.concat(_spans(paragraphs), F.array(F.struct(F.lit(0).alias("start"), F.size("words").alias("length"))))


def _candidates(wanted: list, titles: list, n_notices: int, threshold: float) -> Column:
    """Every long unit that reaches the threshold: (dice, order, start, stop, licence)."""
    none = F.array().cast(_CANDIDATES)
    if not wanted + titles:
        return none
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    known = F.expr("array(" + ", ".join(
        f"named_struct('order', {i}, 'licence', {quoted(licence)}, 'length', {len(words_of(text))}, 'least', {_least_shared(text, threshold)}, "
        f"'pairs', split('{';'.join(normal_pairs(text))}', ';'))" for i, (licence, text) in enumerate(wanted + titles)) + ")")
    n, pairs = F.size("words"), F.col("pairs")
    low = threshold / (2 - threshold) - SLACK

    def candidate(t, size, shared, start, length) -> Column:
        return F.struct((2.0 * shared / (size + F.size(t["pairs"]))).alias("dice"), (-t["order"]).alias("order"), start.alias("start"),
                        (start + length).alias("stop"), t["licence"].alias("licence"))

    def rated(t, start, length, then) -> Column:
        """``then`` of (distinct pairs, those shared with the template) of a span."""
        # element by element: a slice would copy the whole array first
        own = F.array_distinct(F.transform(F.sequence(start, start + length - 2), lambda j: F.get(pairs, j)))
        return _let(_let(own, lambda o: F.struct(F.size(o).alias("size"), F.size(F.array_intersect(o, t["pairs"])).alias("shared"))), then)

    def found(t: Column) -> Column:
        is_title, is_notice = t["order"] >= len(wanted), t["order"] < n_notices
        # one word further a window shares one pair more at most: the starts that cannot reach the least are passed over
        # Each start is met twice, first to rate it, then to use the rating: a value bound inside would copy what is kept so far.
        zero = F.expr(f"named_struct('next', 0, 'kept', cast(array() as {_CANDIDATES}), 'x', named_struct('size', 0, 'shared', 0))")
        state = lambda after, kept, x: F.struct(after.alias("next"), kept.alias("kept"), x.alias("x"))
        hit = lambda x: 2.0 * x["shared"] >= threshold * (x["size"] + F.size(t["pairs"]))

        def met(s, step):
            i = F.shiftright(step, 1)
            here = candidate(t, s["x"]["size"], s["x"]["shared"], i, t["length"])
            used = state(i + F.greatest(F.lit(1), t["least"] - s["x"]["shared"]), F.when(hit(s["x"]), F.concat(s["kept"], F.array(here))).otherwise(s["kept"]), s["x"])
            return F.when(i < s["next"], s).when(step % 2 == 0, state(s["next"], s["kept"], rated(t, i, t["length"], lambda x: x))).otherwise(used)

        windows = F.aggregate(F.sequence(F.lit(0), 2 * (n - t["length"]) + 1), zero, met)["kept"]
        blocks = F.filter(F.when(is_title, F.col("lines")).otherwise(F.col("blocks")), lambda b: (b["length"] > 1) & (
            b["length"] - 1 >= F.size(t["pairs"]) * low))
        whole = F.transform(blocks, lambda b: rated(t, b["start"], b["length"], lambda x: candidate(t, x["size"], x["shared"], b["start"], b["length"])))
        scored = F.when(~is_title & (n >= t["length"]), F.concat(windows, whole)).otherwise(whole)
        # inside one sentence the sentence as a whole decides whether it is a notice
        one = lambda c: F.get("line_of", c["start"]) == F.get("line_of", c["stop"] - 1)
        return F.filter(scored, lambda c: (c["dice"] >= threshold) & ~(is_notice & one(c)))

    possible = F.filter(known, lambda t: (F.size("there") >= t["least"]) & (
        F.size(F.array_intersect("there", t["pairs"])) >= t["least"]))
    return F.when(F.col("text").isNotNull(), F.flatten(F.transform(possible, found))).otherwise(none)


def _apart() -> Column:
    """The best candidates, none in the place of a better one or of a sentence that matched."""
    named = F.col("named_units")
    spans = F.filter(F.concat("lines", F.array(F.struct(F.lit(0).alias("start"), F.size("words").alias("length")))), lambda b: b["length"] > 0)
    unit = lambda start, length: F.array_join(F.transform(F.sequence(start, start + length - 1), lambda j: F.get("words", j)), " ")
    taken = F.transform(F.filter(spans, lambda b: F.array_contains(named, unit(b["start"], b["length"]))), lambda b: F.struct(
        F.lit(0.0).alias("dice"), F.lit(1).alias("order"), b["start"].alias("start"), (b["start"] + b["length"]).alias("stop"),
        F.element_at("named_as", F.array_position(named, unit(b["start"], b["length"])).cast("int")).alias("licence")))
    inside = lambda k, c: (k["licence"] == c["licence"]) & (k["start"] <= c["start"]) & (k["stop"] >= c["stop"])
    same = lambda k, c: inside(k, c) | (2 * (F.least(k["stop"], c["stop"]) - F.greatest(k["start"], c["start"])) >= F.greatest(
        k["stop"] - k["start"], c["stop"] - c["start"]))
    kept = F.aggregate(F.sort_array("candidates", asc=False), taken.cast(_CANDIDATES), lambda held, c: F.when(
        F.exists(held, lambda k: same(k, c)), held).otherwise(F.concat(held, F.array(c))))
    return F.transform(F.filter(kept, lambda k: k["order"] <= 0), lambda k: F.struct(
        k["licence"].alias("licence"), k["dice"].alias("dice"), unit(k["start"], k["stop"] - k["start"]).alias("unit")))


def sql() -> str:
    """DuckDB SQL of the registered query."""
    values = ", ".join(f"('{n}', {i}, [{', '.join(repr(p) for p in normal_pairs(t))}])"
                       for i, (n, t) in enumerate(sorted(TEMPLATES.items())))
    return rf"""
with templates(licence, o, pairs) as (values {values}),
texts as (select doc_id, coalesce(text, '') as text from documents),
cut as (select doc_id, text, string_split_regex(regexp_replace(text, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), '\n') as s from texts),
units as (select doc_id, unnest(case when len(s) > 1 then list_append(s, text) else s end) as unit from cut),
word_lists as (select doc_id, regexp_extract_all(translate(unit, '{UPPER}', '{LOWER}'), '[a-z0-9]+') as w from units where unit <> ''),
paired as (select doc_id, case when len(w) > 1
             then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end as p from word_lists),
scored as (select u.doc_id, t.licence, 2.0::double * len(list_intersect(u.p, t.pairs)) / (len(u.p) + len(t.pairs)) as dice,
                  row_number() over (partition by u.n order by 2.0::double * len(list_intersect(u.p, t.pairs)) / (len(u.p) + len(t.pairs)) desc, t.o) as k
           from (select *, row_number() over () as n from paired where len(p) between 1 and 60) u join templates t
             on len(u.p) between len(t.pairs) * {THRESHOLD / (2 - THRESHOLD) - SLACK!r} and len(t.pairs) * {(2 - THRESHOLD) / THRESHOLD + SLACK!r}),
found as (select * from scored where k = 1 and dice >= {THRESHOLD})
select d.doc_id, count(f.licence) as n_matches, coalesce(string_agg(distinct f.licence, ',' order by f.licence), '') as licences,
       max(round(f.dice * 1e6) / 1e6) as best_dice
from documents d left join found f on f.doc_id = d.doc_id group by d.doc_id
"""
