"""From candidate lists to exact links and components, without all pairs of a list.

A list holds the documents that share one key (a signature coordinate's value, a
band).  In each round the first documents of every open list are its anchors:
only pairs of an anchor with the others of its list are tested, and an anchor
that has met its whole list leaves it.  A list is closed when all its remaining
documents lie in one component, as no further test could change anything.  So a
large group of near copies closes after the round that links it to its anchor,
every pair of different components in a list is tested in the end.  The first
round has one anchor per list, the second ``ANCHORS``, then twice as many each
time, so the number of rounds grows with the logarithm of the longest list.

Written tables are counted as they are written.  One of at most ``FEW`` rows is broadcast to what it is joined with,
so that neither the lists of a hot key nor anything else is shuffled for it; a larger one is joined by a shuffle in which the
rows of a long list are salted and its anchors repeated per salt.  Tables are written in as many files as their rows need.
New links are contracted to edges between the components so far; only these edges are iterated over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.llm.common import discard, stored

ANCHORS = 16
FEW = 200_000                 # rows of a few narrow columns that are broadcast
ROWS_A_TASK = 100_000
ROWS_A_SALT = 20_000


def tasks(rows: int) -> int:
    return 1 + rows // ROWS_A_TASK


def counted(df: DataFrame, name: str, rows: int | None = None, *more) -> tuple[DataFrame, int, list[int]]:
    """A stored table with its number of rows and the sums of ``more`` (count expressions), counted while it is written; ``rows``: how many
    there are at most, for the number of files."""
    seen = Observation()
    if rows is not None:
        df = df.coalesce(tasks(rows))
    extra = [m.alias(f"m{i}") for i, m in enumerate(more)]
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n"), *extra), name)
    got = seen.get
    return out, got["n"], [got[f"m{i}"] or 0 for i in range(len(more))]


def few(df: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """Broadcast if its counted rows allow it."""
    return F.broadcast(df) if rows <= (FEW if most is None else most) else df


def components(edges: DataFrame, rows: int | None = None) -> tuple[DataFrame, int]:
    """(id, component), the smallest id reachable over the undirected edges (a, b), and the number of ids.

    Every node takes the smallest label around it, then the label of its label,
    until nothing changes; lineage cut each time.
    """
    pairs = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both, n, _ = counted(pairs, "edges", None if rows is None else 2 * rows)
    labels, nodes, _ = counted(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
                               .select("id", F.least("id", "b").alias("component")), "labels", n)
    while nodes:
        told = few(labels, nodes)
        near = both.join(told.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = near.join(told, "id").select("id", F.least("component", "near").alias("to"), F.col("component").alias("old"))
        far = few(labels.select(F.col("id").alias("to"), F.col("component").alias("far")), nodes)
        new, _, (changed,) = counted(step.join(far, "to", "left").select("id", F.least("to", "far").alias("component"), "old"), "labels",
                                     nodes, F.count_if(F.col("component") != F.col("old")))
        discard(labels)
        labels = new.drop("old")
        if not changed:
            break
    discard(both)
    return labels, nodes


def _joined(labels: DataFrame, nodes: int, found: DataFrame, links: int) -> tuple[DataFrame, int]:
    """The components after new links: those before are the nodes of a smaller graph."""
    of = lambda c: few(labels.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")), nodes)
    told = found.join(of("a"), "a", "left").join(of("b"), "b", "left")
    told, n, _ = counted(told.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), "contracted", links)
    merged, m = components(told.select(F.col("ca").alias("a"), F.col("cb").alias("b")), n)
    # documents that had no link yet are components of their own
    fresh = (told.select(F.col("a").alias("id"), F.col("ca").alias("component")).unionByName(told.select(F.col("b").alias("id"), F.col("cb").alias("component")))
             .where("id = component").distinct())
    fresh = fresh.join(few(labels.select("id"), nodes), "id", "left_anti")
    every = labels.unionByName(fresh)
    new = few(merged.select(F.col("id").alias("component"), F.col("component").alias("to")), m)
    out, rows, _ = counted(every.join(new, "component", "left").select("id", F.coalesce("to", "component").alias("component")), "labels", nodes + 2 * n)
    for old in (labels, told, merged):
        discard(old)
    return out, rows


def linked(postings: DataFrame, verify: Callable[[DataFrame, int], DataFrame], first: DataFrame | None = None,
           share: tuple[int, int] = (0, 1), anchors: int = ANCHORS) -> tuple[DataFrame, DataFrame]:
    """(links, components) of documents listed as (key, id, n, rest).

    ``n`` is the size of a document's set and ``rest`` the most elements of it
    that a document can share which meets it under this key first (``n`` if
    nothing is known).  Two sets of at least ``share`` likeness have
    share0 / (share0 + share1) * (n + n') elements in common, so pairs whose
    rests are smaller are not made, nor is a document kept in a list where no
    partner could reach that.  ``verify`` takes distinct pairs (a, b, anchor), a < b, the
    anchor being one of them, and their number, and returns
    those that are links; ``first`` holds links known beforehand.
    """
    spark: SparkSession = postings.sparkSession
    kind = postings.schema["id"].dataType.simpleString()
    links = [first if first is not None else spark.createDataFrame([], f"a {kind}, b {kind}")]
    labels, nodes = components(links[0])
    tested, n_tested, at_once, open_, n_open, old = None, 0, 1, postings, None, []
    both, part = share[0] + share[1], share[0]
    while True:
        rows = (open_.join(few(labels.withColumnRenamed("component", "c"), nodes), "id", "left")
                .select("key", "id", "n", "rest", F.coalesce("c", "id").alias("c")))
        sizes = labels.groupBy(F.col("component").alias("c")).agg(F.count(F.lit(1)).alias("size"))
        mixed, n_mixed, _ = counted(
            rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("n").alias("least"), F.max("rest").alias("most"),
                                    F.ceil(F.count(F.lit(1)) / ROWS_A_SALT).cast("bigint").alias("salts"))
            .where("low < high").select("key", "least", "most", "salts"), "mixed", n_open)
        if not n_mixed:
            for table in [mixed, *old]:
                discard(table)
            return _union(links), labels
        # a partner has at least share * n elements and no less than the smallest of the list
        partner = F.greatest(F.col("least") * share[1], F.col("n") * part)
        reaches = F.least("rest", "most") * both * share[1] >= (F.col("n") * share[1] + partner) * part
        rows, n_rows, _ = counted(rows.join(few(mixed, n_mixed), "key").where(reaches).join(few(sizes, nodes), "c", "left").select(
            "key", "id", "n", "rest", "c", "salts", F.coalesce("size", F.lit(1).cast("bigint")).alias("size")), "postings", n_open)
        for table in [mixed, *old]:
            discard(table)
        # members of small components first: once they have met the list, the rest is mostly one component
        order = Window.partitionBy("key").orderBy("size", "id")
        heads, n_heads, _ = counted(rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= at_once)
                                    .select("key", "id", "n", "rest", "place", "c", "salts"), "anchors", n_rows)
        left = heads.select("key", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("rest").alias("rx"),
                            F.col("place").alias("px"), F.col("c").alias("cx"), "salts")
        spread = left.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt")).drop("salts")
        numbered = rows.join(few(heads.select("key", "id", "place"), n_heads), ["key", "id"], "left")
        enough = F.least("rest", "rx") * both >= (F.col("n") + F.col("nx")) * part
        if n_heads <= FEW:
            beside = numbered.join(F.broadcast(left.drop("salts")), "key")
        else:
            # only long lists have more than one salt
            salted = numbered.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
            beside = salted.join(spread, ["key", "salt"])
        met = (beside.where(F.expr("c <> cx and (place is null or place > px)") & enough)
               .groupBy(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).agg(F.min("x").alias("anchor")))
        if tested is not None:
            met = met.join(few(tested, n_tested), ["a", "b"], "left_anti")
        met, n_met, _ = counted(met, "pairs", n_rows * at_once)
        found, n_found, _ = counted(verify(met, n_met).select("a", "b"), "links", n_met)
        pairs = met.select("a", "b")
        tested, n_tested = pairs if tested is None else tested.unionByName(pairs), n_tested + n_met
        open_, n_open, old = numbered.where("place is null").select("key", "id", "n", "rest"), n_rows, [rows, heads]
        if n_found:
            links.append(found)
            labels, nodes = _joined(labels, nodes, found, n_found)
        at_once = anchors if at_once == 1 else 2 * at_once


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
