"""URL filters by a sort-merge range join (operator 8, DataFrame functions only).

A rule (host, path) becomes an interval of canonical keys: the host's labels
reversed (``www.example.com`` -> ``com.example.www``) and, under that host, all
paths from the rule's path up to its last possible extension.  The intervals of
one host are nested or apart.  A URL asks at one point per ancestor host that
has rules.  Interval starts, interval ends and URL points are sorted by key; a
sweep over the sorted rows keeps the stack of active nested rules, one column
per level, and the running depth tells a URL's point which level is innermost.

Scale: equal (host, path) pairs are judged once; only points under hosts that
own rules enter the sweep; a host with many points is swept in salted runs of
about ``ROWS_PER_SWEEP`` points, each with a copy of that host's rules, so a
host holding a third of all rows is no single task.  The stack depth is the
deepest nesting of the rules, measured, not assumed.

Defined results: a null URL or one without ``://`` has empty host and path and
gets the default verdict unless a rule fits (none can); repeated rows each get
a row; a rule given twice with both verdicts blocks; of two fitting rules of
equal length the longer host wins; null rule parts count as empty; an empty
rule table gives every URL the default.  Only the id and URL columns are read,
so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import LOWER, UPPER

ROWS_PER_SWEEP = 100_000
BROADCAST_HOSTS = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased A-Z) and path of a URL; both empty when there are none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _max(df: DataFrame, value: Column) -> int:
    return df.agg(F.max(value)).first()[0] or 0


def _sweep(events: DataFrame, part: list[str], levels: int | None) -> DataFrame:
    """Running depth over the sorted keys; with ``levels``, also the stack, one column per level."""
    order = Window.partitionBy(*part).orderBy("key", "kind")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = events.withColumn("depth", F.sum(
        F.when(F.col("kind") == 1, 1).when(F.col("kind") == 0, -1).otherwise(0)).over(running))
    if levels is None:
        return out
    for i in range(1, levels + 1):
        opened = F.when((F.col("kind") == 1) & (F.col("depth") == i), F.col("rule"))
        out = out.withColumn(f"level{i}", F.last(opened, ignorenulls=True).over(running))
    return out


def _intervals(rules: DataFrame) -> DataFrame:
    """Start and end rows of every rule; kind 0 closes, 1 opens, 2 is a URL's point."""
    path = F.col("rule.path").cast("binary")
    ends = F.array(F.struct(F.lit(1).alias("kind"), path.alias("key")),
                   F.struct(F.lit(0).alias("kind"), F.concat(path, F.lit(b"\xff")).alias("key")))
    return rules.select("rhost", "rule", F.explode(ends).alias("e")).select("rhost", "e.key", "e.kind", "rule")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
          rows_per_sweep: int = ROWS_PER_SWEEP) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has columns host, path, verdict (``allow`` or ``block``).
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    pages = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    known = (rules.select(F.coalesce(F.translate(F.col("host").cast("string"), UPPER, LOWER), F.lit("")).alias("host"),
                          F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("verdict"))
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))   # 'block' > 'allow'
             .select(_reversed_host(F.col("host")).alias("rhost"), F.struct("host", "path", "verdict").alias("rule")))
    labels = _max(known, F.size(F.split("rhost", r"\.")))
    levels = _max(_sweep(_intervals(known), ["rhost"], None), F.col("depth"))
    if not levels:
        return pages.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    hosts = known.select("rhost").distinct()
    few = hosts.count() <= BROADCAST_HOSTS
    bounded = F.broadcast if few else (lambda t: t)
    asked = pages.select("host", "path").distinct()
    parts = F.split(_reversed_host(F.col("host")), r"\.")
    depth = F.least(F.size(parts), F.lit(labels))
    points = (asked.select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(1), depth), lambda i: F.array_join(F.slice(parts, 1, i), "."))).alias("rhost"))
        .join(bounded(hosts), "rhost"))
    runs = points.groupBy("rhost").agg(F.ceil(F.count(F.lit(1)) / rows_per_sweep).cast("int").alias("runs"))
    salted = points.join(bounded(runs), "rhost").withColumn(
        "run", F.pmod(F.xxhash64("host", "path"), F.col("runs").cast("bigint")).cast("int"))
    copies = _intervals(known).join(bounded(runs), "rhost").select(
        "rhost", "key", "kind", "rule", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"))
    events = copies.select("rhost", "run", "key", "kind", "rule", F.lit(None).cast("string").alias("host"),
                           F.lit(None).cast("string").alias("path")).unionByName(
        salted.select("rhost", "run", F.col("path").cast("binary").alias("key"), F.lit(2).alias("kind"),
                      F.lit(None).cast(copies.schema["rule"].dataType).alias("rule"), "host", "path"))
    swept = _sweep(events, ["rhost", "run"], levels).where((F.col("kind") == 2) & (F.col("depth") > 0))
    stack = F.array(*[F.col(f"level{i}") for i in range(1, levels + 1)])
    fits = swept.select("host", "path", F.element_at(stack, F.col("depth").cast("int")).alias("fit"))
    length = F.length("fit.host") + F.length("fit.path")
    best = fits.groupBy("host", "path").agg(F.max_by("fit", F.struct(length, F.length("fit.host"))).alias("fit"))
    return (pages.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.concat("fit.host", "fit.path").alias("rule"),
                    F.coalesce("fit.verdict", F.lit(default)).alias("verdict")))


# The rules of the registered query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

SQL = """
with rules(host, path, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rests as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
          from pages),
cut as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as h from rests),
urls as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') as path from cut),
fits as (select u.page_id, u.host, u.path, r.host || r.path as rule, r.verdict,
                row_number() over (partition by u.page_id order by (r.host is null),
                                   length(r.host) + length(r.path) desc, length(r.host) desc) as n
         from urls u left join rules r
           on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where n = 1
"""
