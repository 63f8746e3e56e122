"""MinHash near-duplicates by a signature-coordinate inverted join (operator 3).

A document is the set of its distinct five-word shingles; its signature has
``COORDINATES`` MinHash values.  Documents are posted under every (coordinate,
value) pair.  Two documents of the wanted likeness agree in at least ``least``
coordinates but for a chance of ``MISS`` (the exact binomial tail), so:

  * values that only one document has are skipped, and a document with fewer than
    ``least`` shared values has no partner;
  * prefix: with its values ordered from rare to frequent, two documents that
    agree in ``least`` of them meet among the first (all - least + 1), so only
    these are posted and the long lists of common values are skipped;
  * collisions of the pairs met are counted over the whole signatures, pairs with
    ``least`` or more are retained and confirmed on their full sets.

Equal sets are joined beforehand: one document of each class is posted, however
many copies there are.  Lists are met anchor by anchor (:mod:`links`), so no group
is expanded into all its pairs.  A list of over ``LONG_LIST`` documents is mostly a
passage that unlike documents share; its documents are posted anew under the
rarest of their shingles: two sets of the wanted likeness share at least that part
of either set, so they meet among the first (size - part + 1) shingles from rare to
frequent, and a document whose own text fills these is posted no more.  A place
in that order also bounds what two documents can share from there on, and pairs
for which that is not enough are not made.  Texts move once, and only those of documents that
still have lists; everything else is keyed rows of a few bytes or signatures.

Defined results: null, empty and blank texts have the empty set, are linked with
nothing and kept; rows of one id are one document and always in one component;
rows without an id are their own component (null) and kept; the smallest id of a
component is kept, so ties are settled; an empty table gives an empty table; only
the named columns are read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import discard, stored
from tabflow.llm.links import counted, few, linked
from tabflow.llm.shingles import WORDS, Permutations, set_key, shingle_set

COORDINATES = 64
MISS = 1e-6
SHARE = (75, 100)             # intersection / union at least
SLICE_ROWS = 256
BROADCAST_IDS = 1_000_000
BROADCAST_SIGNATURES = 50_000    # of COORDINATES * 4 bytes each
BROADCAST_ELEMENTS = 4_000_000   # shingles of 8 bytes
LONG_LIST = 32


def least_matches(coordinates: int, share: tuple[int, int] = SHARE, miss: float = MISS) -> int:
    """The largest count that a pair of the wanted likeness falls short of with a chance under ``miss``."""
    p, below = share[0] / share[1], 0.0
    for n in range(coordinates + 1):
        below += comb(coordinates, n) * p ** n * (1 - p) ** (coordinates - n)
        if below > miss:
            return max(1, n)
    return coordinates


def signatures(docs: DataFrame, id_col: str, text_col: str, coordinates: int = COORDINATES, words: int = WORDS) -> DataFrame:
    """(id, n, set_key, sig): sizes, digests and signatures of the shingle sets; key and signature null when empty."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches):
        permutations = Permutations(coordinates)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                n, keys, sigs = [], [], []
                for raw in part.column("text").to_pylist():
                    shingles = shingle_set(raw, words)
                    n.append(len(shingles))
                    keys.append(set_key(shingles) if len(shingles) else None)
                    sigs.append(permutations.signature(shingles).view(np.int32) if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
                    ["id", "n", "set_key", "sig"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n long, set_key binary, sig array<int>")


def shingle_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, shingles) of rows (id, text)."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                sets = [shingle_set(raw, words).view(np.int64) for raw in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    rows = docs.select("id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, shingles array<long>")


def confirm(pairs: DataFrame, n: int, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Of ``n`` distinct pairs (a, b, anchor) those whose full sets overlap enough.

    A pair's member, the one that is no anchor, brings its set; the anchors' sets are broadcast as long as their counted
    elements allow it, so that the set of a hot anchor is not shuffled once per pair."""
    pairs = pairs.withColumn("member", F.when(F.col("anchor") == F.col("a"), F.col("b")).otherwise(F.col("a")))
    wanted = pairs.select(F.col("anchor").alias("id")).distinct()
    heads, _, (elements,) = counted(sets.join(few(wanted, n), "id", "left_semi"), "anchor-sets", n, F.sum(F.size("shingles")))
    left = heads.select(F.col("id").alias("anchor"), F.col("shingles").alias("sa"))
    both = sets.select(F.col("id").alias("member"), F.col("shingles").alias("sb")).join(few(pairs, n), "member")
    both = both.join(few(left, elements, BROADCAST_ELEMENTS), "anchor")
    common = F.size(F.array_intersect("sa", "sb"))
    shared = both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
    return shared.where(F.col("common").cast("long") * share[1] >= (F.col("total") - F.col("common")).cast("long") * share[0]).select("a", "b")


def post_long_lists_anew(postings: DataFrame, sets: DataFrame, share: tuple[int, int], n_postings: int,
                         long_list: int = LONG_LIST) -> DataFrame:
    """Postings (id, key, n) with every list of over ``long_list`` documents replaced by lists of rare shingles.

    ``rest`` is what a set has left from the posted shingle on; for signature values it is the whole size.

    Nothing is lost: two documents of a long list both have a place in the new lists, which hold the exact
    prefix of their sets among all documents of long lists.
    """
    long, n_long, _ = counted(postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long_list).select("key"), "long", n_postings)
    kept = postings.select("id", "key", "n", F.col("n").alias("rest"))
    if not n_long:
        return kept
    long = few(long, n_long)
    hot = postings.join(long, "key").select("id").distinct()
    own = sets.join(hot, "id", "left_semi").select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("s"))
    shared = own.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = own.join(shared, "s").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("rare"))
    part = F.expr(f"(size * {share[0]} + {share[1] - 1}) div {share[1]}").cast("int")
    # shingles that no other of these documents has come first and meet nobody
    take = F.size("rare") - part + 1
    anew = ranked.where(take > 0).select("id", F.col("size").cast("bigint").alias("n"), F.size("rare").alias("shared"),
                                         F.posexplode(F.transform(F.slice("rare", F.lit(1), take), lambda x: x["s"])).alias("at", "key"))
    return kept.join(long, "key", "left_anti").select("id", "key", "n", "rest").unionByName(
        anew.select("id", "key", "n", (F.col("shared") - F.col("at")).cast("bigint").alias("rest")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: tuple[int, int] = SHARE,
                    coordinates: int = COORDINATES, words: int = WORDS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row."""
    least = least_matches(coordinates, share)
    signed = stored(signatures(docs, id_col, text_col, coordinates, words), "signatures")
    full = signed.where("id is not null and n > 0")
    classes = stored(full.groupBy("set_key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    # rows of one id in several classes link them
    members = full.select("id", "set_key").join(classes.select("set_key", F.col("id").alias("rep")), "set_key")
    members = stored(members.select("id", "rep").distinct(), "members")
    several = members.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("id", "low")
    same_id = several.join(members, "id").where("low <> rep").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()

    value = F.shiftleft(F.col("at").cast("bigint"), 32).bitwiseOR(F.col("v").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
    posted = classes.select("id", F.posexplode("sig").alias("at", "v")).select("id", value.alias("key"))
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = (posted.join(shared, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
              .where(F.size("keys") >= least))
    prefix = F.slice("keys", F.lit(1), F.size("keys") - least + 1)
    postings, n_postings, _ = counted(listed.select("id", F.explode(F.transform(prefix, lambda k: k["key"])).alias("key")), "postings")

    # sets of those documents only
    wanted, n_wanted, _ = counted(postings.select("id").distinct(), "wanted", n_postings)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = stored(shingle_sets(texts.join(few(wanted, n_wanted), "id", "left_semi"), words), "sets")
    signs = classes.select("id", "n", "sig")
    lists = stored(post_long_lists_anew(postings.join(signs.select("id", "n"), "id"), sets, share, n_postings), "lists")

    def verify(pairs: DataFrame, n: int) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        own, n_own, _ = counted(signs.join(few(ids, 2 * n), "id", "left_semi"), "signs", 2 * n)
        a, b = (few(own.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}")), n_own, BROADCAST_SIGNATURES) for c in "ab")
        both = pairs.join(a, "a").join(b, "b")
        sizes = F.least("na", "nb") * share[1] >= F.greatest("na", "nb") * share[0]
        equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
        agreed, n_agreed, _ = counted(both.where(sizes).where(equal >= least).select("a", "b", "anchor"), "agreed", n)
        sure = confirm(agreed, n_agreed, sets, share)
        discard(own)
        return sure

    _, labels = linked(lists, verify, same_id, share)
    found = (members.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component")))
    out = signed.select("id", "n").join(found, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the one row of each group that stays (of an id given twice, the row of the smallest text hash)."""
    found = near_duplicates(docs, id_col, text_col)
    dropped = stored(found.where("not kept").select(F.col(id_col).alias("__dropped")).distinct(), "dropped")
    few = dropped.count() <= BROADCAST_IDS
    rest = docs.join(F.broadcast(dropped) if few else dropped, docs[id_col] == F.col("__dropped"), "left_anti")
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("__twice"))
    twice = stored(ids, "twice")
    if not twice.limit(1).count():
        return rest
    names = docs.columns
    order = Window.partitionBy("k").orderBy("h")
    marked = rest.join(twice, rest[id_col] == F.col("__twice"), "left")
    once = marked.where("__twice is null").select(*[F.col(f"`{n}`") for n in names])
    first = (marked.where("__twice is not null").select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)],
                                                      F.col(f"`{id_col}`").alias("k"), F.xxhash64(text_col).alias("h"))
             .withColumn("place", F.row_number().over(order)).where("place = 1"))
    return once.unionByName(first.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)]))


SQL = r"""
with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (select distinct doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') as s
             from words, unnest(range(1, greatest(2, len(w) - 3))) as t(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
           group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
reach as (select a as doc_id, a as r from links union select reach.doc_id, links.b from reach join links on links.a = reach.r),
component as (select doc_id, min(r) as component_id from reach group by doc_id)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(least(component_id, d.doc_id), d.doc_id) as component_id,
       coalesce(least(component_id, d.doc_id), d.doc_id) = d.doc_id as kept
from documents d left join sizes using (doc_id) left join component using (doc_id)
"""
