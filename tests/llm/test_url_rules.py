import random

import pytest

from tabflow.llm import url_rules as U


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, after = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = after[:min([i for i in (after.find(c) for c in "?#") if i >= 0], default=len(after))]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("seed,per_sweep", [(1, 100_000), (2, 3)])
def test_judge_equals_brute_force(spark, seed, per_sweep):
    rng = random.Random(seed)
    label = lambda: rng.choice(["a", "b", "é", "ab", "com"])
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "".join(rng.choice("ab/é") for _ in range(rng.randrange(0, 6)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(60)] + [("com", "", "block"), ("a", "/", "block"), ("a", "/", "allow")]
    rules = [r for r in rules if (r[0], r[1]) != ("a", "/")] + [("a", "/", "block"), ("a", "/", "allow")]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{host()}{rng.choice([path(), ''])}{rng.choice(['', '?x=/a', '#/b', '?a#b'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "http://", "http://A.COM/Ab", "http://..com//", "x://y://z/a", urls[0], urls[0]] + ["http://hot.a/ab"] * 50
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule int")
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    final = {}
    for h, p, v in rules:
        final[h, p] = max(v, final.get((h, p), ""))
    final = [(h, p, v) for (h, p), v in final.items()]
    got = {r["page_id"]: tuple(r)[1:] for r in U.judge(df, known, rows_per_sweep=per_sweep).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, final), u


def test_edges(spark):
    df = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert sorted(r["verdict"] for r in U.judge(df, none, default="block").collect()) == ["block"] * 3
    rules = spark.createDataFrame([("com", "/", "block"), (None, None, "allow")], "host string, path string, verdict string")
    got = U.judge(df, rules)
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in got.collect()) == [(0, "allow"), (1, "block"), (1, "block")]
    assert U.judge(df.limit(0), rules).count() == 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
