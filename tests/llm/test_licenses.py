import random
import re
import time

from pyspark.sql import functions as F

from tabflow.llm import licenses as L

SF = "/root/testdata/sf0.001"


def brute(text):
    """(licence, dice) of every unit, the whole text last."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    units = [re.findall("[a-z0-9]+", s) for s in re.split(r"\n|(?<=[.!?])[ \t\r]+", lower)]
    if len(units) > 1:
        units.append([w for u in units for w in u])
    out = []
    for words in units:
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])] or words
        if not pairs:
            continue
        best = max((2 * len(set(pairs) & set(L.normal_pairs(t))) / (len(pairs) + len(L.normal_pairs(t))), -i, n)
                   for i, (n, t) in enumerate(sorted(L.TEMPLATES.items())))
        if best[0] >= L.THRESHOLD:
            out.append((best[2], round(best[0], 9)))
    return out


def test_scan_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = [(-1, None), (-2, ""), (-3, "released UNDER the   mit license"), (-4, "All rights reserved. Released under the MIT License.\nx"),
             (-5, "license"), (-6, "all rights reserved all rights reserved"), (None, "Licensed under CC BY-NC 4.0."), (-7, "word " * 100_000),
             (-8, "Released under the ISC License. And more text. Licensed under the Apache License, Version 2.0. Tail of words"),
             (-9, "It was\nreleased under\nthe MIT license"), (-3, "released UNDER the   mit license"), (-10, "...\n\n!?")]
    df = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).selectExpr("*", "1 as units", "'x' as id", "2 as parts")
    got = L.scan(df).join(df.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(got) >= docs.count() + len(extra) - 1
    found = 0
    for r in got:
        assert [(m["licence"], round(m["dice"], 9)) for m in r["matches"]] == brute(r["text"]), r
        found += len(r["matches"])
    assert found > 5


def test_edges(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert L.scan(df, templates={}).first()["matches"] == []
    assert L.scan(df, templates={"only": "word"}).first()["matches"] == []
    assert L.scan(df.limit(0)).count() == 0
    plan = L.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_full_texts_titles_and_wrapped_notices(spark):
    full = dict((n, t) for n, t in L.texts() if len(t) > 400 and (n, t) not in L.HEADERS)
    assert {"MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0"} <= set(full)
    lead, tail = "Some prose goes before it, line after line.\n" * 12, "\nand some goes after it" * 12
    wrapped = lead + "The code here is\nreleased under the\nMIT License. " + tail
    whole_and_title = lead + "MIT License\n\n" + full["MIT"].split("\n\n", 1)[1]
    # MIT with every twelfth word changed: 5/6 of its pairs are left
    changed = " ".join("changed" if i % 12 == 5 else w for i, w in enumerate(full["MIT"].split()))
    rows = [(name, lead + text + tail) for name, text in full.items()] + [
        ("wrapped", wrapped), ("title", lead + "MIT License\n" + tail), ("both", whole_and_title), ("changed", lead + changed + tail),
        ("header", lead + L.HEADERS[2][1].replace(" ", "\n", 4) + tail), ("prose", lead + tail),
        ("mention", lead + "he spoke of the MIT license and other software on that day" + tail), ("half", lead + full["MIT"][40:440] + tail)]
    got = {r["doc_id"]: r["matches"] for r in L.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for name in full:
        assert name in {m["licence"] for m in got[name] if len(m["unit"].split()) > 60}, (name, [m["licence"] for m in got[name]])
    assert [m["licence"] for m in got["wrapped"]] == ["MIT"] and got["wrapped"][0]["unit"] == "released under the mit license"
    assert [m["unit"] for m in got["title"]] == ["mit license"]
    assert {m["licence"] for m in got["both"]} == {"MIT"} and len(got["both"][0]["unit"].split()) > 150
    assert [m["licence"] for m in got["changed"]] == ["MIT"] and got["changed"][0]["dice"] < 0.9
    assert "Apache-2.0" in {m["licence"] for m in got["header"]}
    assert got["prose"] == got["mention"] == got["half"] == []


LONG = (("Long", "permission is hereby granted to any person who obtains a copy of this software licence to deal in it without any "
         "restriction and to use copy change merge publish and sell copies of it"),
        ("Short", "you may copy this under the terms of the licence of the authors only"))
SHORT = {"MIT": "Released under the MIT License.", "All": "All rights reserved."}
NAMES = [("MIT", "MIT License"), ("Long", "The Long Licence")]


def brute_scan(text):
    """The whole scan in plain Python, every window of every template."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    norm = lambda t: [w for w in re.sub("[^a-z0-9]+", " ", t).split(" ") if w]
    parts = [norm(p) for p in re.sub(r"(?<=[.!?])[ \t\r]+", "\n", low).split("\n")]
    words, line_of = [w for p in parts for w in p], [i for i, p in enumerate(parts) for _ in p]
    notices = [(m[0], m[1], u) for u in [*parts, *([words] if len(parts) > 1 else [])] for m in [sentence(u)] if m]
    spans = lambda units: [(sum(map(len, units[:i])), len(u)) for i, u in enumerate(units)]
    blocks = spans([norm(p) for p in re.split("\n[ \t\r]*\n", low)]) + [(0, len(words))]
    wanted = sorted(SHORT.items()) + list(LONG)
    candidates = []
    for order, (name, t) in enumerate(wanted + NAMES):
        own = norm(t.lower())
        pairs = {f"{a} {b}" for a, b in zip(own, own[1:])}
        title = order >= len(wanted)
        units = [(a, n) for a, n in (spans(parts) if title else blocks) if n > 1 and n - 1 >= len(pairs) * L.THRESHOLD / (2 - L.THRESHOLD) - 1e-9]
        if not title:
            units += [(a, len(own)) for a in range(len(words) - len(own) + 1)]
        for a, n in units:
            got = {f"{x} {y}" for x, y in zip(words[a:a + n], words[a + 1:a + n])}
            dice = 2.0 * len(got & pairs) / (len(got) + len(pairs))
            if dice >= L.THRESHOLD and not (order < len(SHORT) and line_of[a] == line_of[a + n - 1]):
                candidates.append((dice, -order, a, a + n, name))
    units = [" ".join(u) for _, _, u in notices]
    held = [(0.0, 1, a, a + n, notices[units.index(" ".join(words[a:a + n]))][0]) for a, n in spans(parts) + [(0, len(words))] if " ".join(words[a:a + n]) in units]
    for c in sorted(candidates, reverse=True):
        if not any((k[4] == c[4] and k[2] <= c[2] and k[3] >= c[3]) or 2 * (min(k[3], c[3]) - max(k[2], c[2])) >= max(k[3] - k[2], c[3] - c[2]) for k in held):
            held.append(c)
    return sorted([(n, round(d, 9), " ".join(u)) for n, d, u in notices] + [(k[4], round(k[0], 9), " ".join(words[k[2]:k[3]])) for k in held if k[1] <= 0])


def sentence(words):
    best = None
    for name, t in sorted(SHORT.items()):
        pairs = set(L.normal_pairs(t))
        mine = [f"{a} {b}" for a, b in zip(words, words[1:])] or words
        n, p = len(mine), len(pairs)
        if n and p * L.THRESHOLD / (2 - L.THRESHOLD) - 1e-9 <= n <= p * (2 - L.THRESHOLD) / L.THRESHOLD + 1e-9:
            dice = 2.0 * len(set(mine) & pairs) / (n + p)
            if dice >= L.THRESHOLD and (best is None or dice > best[1]):
                best = (name, dice)
    return best


def test_whole_scan_equals_brute_force(spark):
    rng = random.Random(8)
    pool = [t for _, t in LONG] + list(SHORT.values()) + [t for _, t in NAMES] + ["Plain words of prose go here", "\n\n", "\n", " ", ". "]
    texts = ["", "licence", "\n".join(["Released under the MIT License."] * 5)]
    for _ in range(60):
        words = " ".join(rng.choice(pool) for _ in range(rng.randint(1, 7))).replace(" ", " ~").split("~")
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(words))
            words[i:i + 1] = rng.choice([[], [words[i]] * 2, ["other "], ["\n", words[i]], ["\n\n", words[i]]])
        texts.append("".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: sorted((m["licence"], round(m["dice"], 9), m["unit"]) for m in r["matches"])
           for r in L.scan(df, SHORT, long=LONG, titles=NAMES).collect()}
    found = 0
    for i, t in enumerate(texts):
        assert got[i] == brute_scan(t), t
        found += sum(len(m[2].split()) > 10 for m in got[i])
    assert found > 15


def test_a_very_long_text_is_linear(spark):
    seconds = []
    for lines in (500, 4_000):
        text = "\n".join(f"line {i} of prose with a licence word" if i % 9 else "Released under the MIT License." for i in range(lines))
        start = time.time()
        r = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(F.size("matches")).first()[0]
        seconds.append(time.time() - start)
        assert r == -(-lines // 9)
    assert seconds[1] < 8 * seconds[0] + 5, seconds
