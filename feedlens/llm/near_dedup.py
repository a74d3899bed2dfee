"""MinHash near-deduplication with min-max hashing.

Under every permutation both the minimum and the maximum of a document's shingles are kept, so a
signature of 80 values costs 40 hash evaluations per shingle. Bands of four values (the minimum
and the maximum of two permutations) name the buckets in which candidates meet.

Links between candidates are confirmed on the full shingle sets. A small bucket tests its pairs at
once. A larger one never emits its pairs: its members are measured against a *centre*, the shingles
that most of a few members have. Members near it are linked with the nearest one by the triangle
inequality, without a test, and any other link needs common differences from the centre; a prefix
of each member's differences names the buckets in which such partners meet again (see ``_rooted``).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import (WordCodes, discard, flat_batches, map_batches, mix64, read_table,
                                 stored)
from feedlens.session import lookup_join, materialize

SHINGLE = 5
PERMUTATIONS = 40
BANDS = 20
SMALL, SMALL_AGAIN, SAMPLED = 16, 48, 9
LOOKUP_BYTES = 32 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(20260101)
_FACTORS = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_set(text: str | None, codes: WordCodes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle names of a text; A-Z are lower-cased first."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    values = codes.of(words)
    width = min(size, len(values))
    names = np.full(len(values) - width + 1, width, np.uint64)
    for i in range(width):
        names = names * _STEP + values[i:len(values) - width + 1 + i]
    return np.unique(mix64(names))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Per set (none empty) 2 * PERMUTATIONS values: minimum and maximum of each permutation."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for p in range(PERMUTATIONS):
        hashed = flat * _FACTORS[p] + _SHIFTS[p]
        out[:, 2 * p] = np.minimum.reduceat(hashed, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(hashed, starts)
    return out


def band_names(signature: np.ndarray) -> np.ndarray:
    """One 64-bit name per document and band."""
    rows = signature.shape[1] // BANDS
    grouped = signature.reshape(len(signature), BANDS, rows)
    names = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, grouped.shape[:2])
    for r in range(rows):
        names = mix64(names + grouped[:, :, r])
    return names


def set_name(names: np.ndarray) -> int:
    """64-bit name of a whole set."""
    with np.errstate(over="ignore"):
        total = mix64(names).sum(dtype=np.uint64) + mix64(np.uint64(len(names)) * _STEP)
        return int(mix64(total).astype(np.int64))


def _describe():
    codes = WordCodes()

    def run(batch: pa.RecordBatch):
        sets = [shingle_set(t, codes) for t in batch.column("text").to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        node, bands = [None] * len(sets), [None] * len(sets)
        if full:
            named = band_names(signatures([sets[i] for i in full])).astype(np.int64)
            ids = batch.column("doc_id").to_pylist()
            for at, i in enumerate(full):
                if ids[i] is not None:
                    node[i], bands[i] = set_name(sets[i]), named[at]
        return [[len(s) for s in sets], node, bands]

    return run


def _full_sets():
    codes = WordCodes()

    def run(batch: pa.RecordBatch):
        sets = [shingle_set(t, codes) for t in batch.column("text").to_pylist()]
        sets = [s for s in sets if len(s)]
        return [[set_name(s) for s in sets], [s.astype(np.int64) for s in sets]]

    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components as ``(node, root)``, ``root`` the smallest node; by alternating stars.

    ``edges`` has columns ``a`` and ``b``. Every step is a grouping with partial aggregation and
    a join with its stored result, so a node with very many edges is split by AQE.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                       .select("a", F.least("a", "m").alias("m")), "least")
        large = stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"),
                                                                    F.col("m").alias("b"))
                       .filter("a <> b").distinct(), "large")
        least_small = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        hooked = large.join(least_small, "a")
        small = stored(hooked.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                       .filter("a <> b")
                       .unionByName(least_small.select("a", F.col("m").alias("b")))
                       .distinct(), "small")
        state = tuple(small.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                      .first())
        for table in (edges, least, large, least_small):
            discard(table)
        edges = small
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those pairs ``(a, b)`` that are linked, each held against the other on its full set."""
    left = sets.select(F.col("node").alias("a"), F.col("names").alias("a_names"))
    right = sets.select(F.col("node").alias("b"), F.col("names").alias("b_names"))
    common = F.size(F.array_intersect("a_names", "b_names"))
    joined = (pairs.join(left, "a").join(right, "b")
              .select("a", "b", common.alias("common"),
                      (F.size("a_names") + F.size("b_names")).alias("both")))
    return (joined.filter(100 * F.col("common") >= threshold * (F.col("both") - F.col("common")))
            .select("a", "b"))


def _centres(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """What up to ``SAMPLED`` members of a bucket have: ``centre``, the shingles that more than
    half of them have, ``usual``, those that all have, and ``known``, those that any has."""
    slot = F.pmod(F.xxhash64("node", "bucket"), F.lit(SAMPLED))
    chosen = (groups.groupBy("bucket", slot.alias("slot")).agg(F.min("node").alias("node"))
              .join(sets, "node"))
    listed = chosen.groupBy("bucket").agg(
        F.sort_array(F.flatten(F.collect_list("names"))).alias("names"), F.count("*").alias("k"))

    def had_by(least: Column) -> Column:
        return F.array_distinct(F.filter(
            "names", lambda x, i: F.get("names", i + (least - 1).cast("int")) == x))

    return listed.select("bucket", had_by(F.floor(F.col("k") / 2) + 1).alias("centre"),
                         had_by(F.col("k")).alias("usual"), F.array_distinct("names").alias("known"))


def _measured(groups: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Members with their distance ``d`` from the bucket's centre, ``far`` and ``differs``.

    ``far`` is G of ``_rooted``; ``differs`` holds the first shingles that either the member or the
    centre has alone, no more than a prefix can need: ``within`` + 1, where ``within`` is the
    largest difference that two linked sets can have. Differences that no sampled member shares
    come first, as they make small buckets.
    """
    centres = materialize(_centres(groups, sets), "centres")
    joined = lookup_join(groups.join(sets, "node"), centres, ["bucket"], limit=LOOKUP_BYTES)
    own, lacking = F.array_except("names", "centre"), F.array_except("centre", "names")
    n, total = F.col("n"), 100 + threshold
    widest = F.floor(100 * n / threshold)  # a partner's size at most
    within = F.floor((100 - threshold) * (n + widest) / total).cast("int")
    ordered = F.concat(F.array_except("own", "known"), F.array_intersect("lacking", "usual"),
                       F.array_intersect("own", "known"), F.array_except("lacking", "usual"))
    return (joined.withColumns({"own": own, "lacking": lacking, "within": within})
            .withColumn("d", F.size("own") + F.size("lacking"))
            .select("bucket", "node", "n", "within", "d",
                    (total * F.col("d") - (100 - threshold) * n).alias("far"),
                    F.slice(ordered, 1, F.col("within") + 1).alias("differs")))


def _around_centres(groups: DataFrame, sets: DataFrame,
                    threshold: int) -> tuple[DataFrame, DataFrame]:
    """Links with each bucket's nearest member, and the members with their share in what is left.

    The second table has ``rest`` (not linked with the nearest member) and ``prefix``, how many of
    a member's ``differs`` are needed to meet all partners; no row of a bucket without a rest.
    """
    near = stored(_measured(groups, sets, threshold), "near")
    nearest = materialize(near.groupBy("bucket").agg(F.min(F.struct("far", "node")).alias("c"))
                          .select("bucket", F.col("c.far").alias("low"),
                                  F.col("c.node").alias("hub")), "nearest")
    told = stored(lookup_join(near, nearest, ["bucket"], limit=LOOKUP_BYTES)
                  .withColumn("rest", F.col("far") + F.col("low") > 0), "told")
    links = told.filter("NOT rest AND node <> hub").select(F.col("hub").alias("a"),
                                                           F.col("node").alias("b"))
    lowest = materialize(told.filter("rest").groupBy("bucket")
                         .agg(F.min("far").alias("rest_low")), "rest_low")
    partner = F.when(F.col("rest"), F.col("low")).otherwise(F.col("rest_low"))
    needed = F.greatest(F.lit(1), F.ceil((F.col("far") + partner) / (2 * (100 + threshold))),
                        F.col("d") - F.col("within")).cast("int")
    left = lookup_join(told, lowest, ["bucket"], limit=LOOKUP_BYTES)
    return links, left.select("bucket", "node", "n", "rest", "differs",
                              (F.col("d") - needed + 1).alias("prefix"))


def _meeting_again(left: DataFrame) -> DataFrame:
    """New buckets ``(bucket, difference)`` with two members or more, one of the rest among them.

    A passage that some members share gives as many differences with the same members; buckets of
    the same members, told by two 64-bit sums of their names, are one bucket.
    """
    entered = stored(left.filter("prefix > 0").select(
        "bucket", "node", "n", "rest",
        F.explode(F.slice("differs", 1, F.col("prefix"))).alias("shingle")), "entered")
    open_ = stored(entered.groupBy("bucket", "shingle")
                   .agg(F.count("*").alias("sets"), F.max("rest").alias("any_rest"),
                        *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"s{i}") for i in (0, 1)])
                   .filter("sets > 1 AND any_rest")
                   .groupBy("sets", "s0", "s1")
                   .agg(F.min(F.struct("bucket", "shingle")).alias("least"))
                   .select("least.*", F.xxhash64("sets", "s0", "s1").alias("name")), "open")
    return (entered.join(open_, ["bucket", "shingle"])
            .select(F.col("name").alias("bucket"), "node", "n"))


def _by_top_member(members: DataFrame) -> DataFrame:
    """The buckets of all bands put together by their most central member, or a more central one
    that this shares a bucket with, so that a group is worked off once and not once per band."""
    named = stored(members.select(F.col("top.node").alias("hub"), "top", "node", "n").distinct(),
                   "named")
    best = named.groupBy(F.col("node").alias("hub")).agg(F.max("top").alias("best"))
    hubs = materialize(named.select("hub").distinct().join(best, "hub"), "hubs")
    return (lookup_join(named, hubs, ["hub"], limit=LOOKUP_BYTES)
            .select(F.col("best.node").alias("bucket"), "node", "n").distinct())


def near_duplicates(documents: DataFrame, threshold: int = 85) -> DataFrame:
    """Groups of near-duplicates: ``doc_id, n_shingles, component_id, kept`` per row.

    Documents are linked where ``100 * intersection >= threshold * union`` of their sets of
    5-word shingles. Other columns are not read. Null, empty and blank texts have no shingles and
    are linked with nothing; rows without ``doc_id`` are linked with nothing and have a null
    ``component_id`` (and are kept). Equal texts share one entry of the search, whatever their
    number. Rows that repeat a ``doc_id`` count as one document and get the same answer each.
    A pair at the threshold meets in no band with a probability of about 4e-7.
    """
    rows = documents.select("doc_id", "text")
    signed = stored(map_batches(rows, _describe, "n_shingles long, node long, bands array<long>",
                                keep=("doc_id",)), "signed")
    nodes = stored(signed.filter("node IS NOT NULL").groupBy("node")
                   .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"),
                        F.min_by("bands", "doc_id").alias("bands")), "nodes")
    rooted = _rooted(rows, nodes, threshold)
    joined = nodes.select("node", "first_id").join(rooted, "node", "left")
    root = F.coalesce("root", "node")
    lowest = stored(joined.groupBy(root.alias("root"))
                    .agg(F.min("first_id").alias("component_id")), "lowest")
    named = stored(joined.select("node", root.alias("root")).join(lowest, "root")
                   .select("node", "component_id"), "named")
    return (signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _rooted(rows: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """``(node, root)`` for every node with a link.

    Say that a set x differs from its bucket's centre P in d(x) shingles (P may be any set). Two
    sets differ in ``d(x) + d(y) - 2 s`` shingles, s being the number of differences from P that
    they share, and are linked if that is at most ``(n(x) + n(y)) (100 - t) / (100 + t)``. With
    ``G(x) = (100 + t) d(x) - (100 - t) n(x)`` that reads ``2 (100 + t) s >= G(x) + G(y)``, exactly
    and in whole numbers. So x is linked with the nearest member h (least G) for certain if
    ``G(x) + G(h) <= 0``; these are connected. Any pair with one of the others has a sum above
    zero and must share differences, ``(G(x) + G(h)) / (2 (100 + t))`` of them at least, and also
    ``d(x)`` less the largest difference of linked sets. With all differences of a bucket in one
    order, prefixes that leave fewer than so many behind
    have one in common, and its bucket is a smaller one: no difference is shared by all sampled
    members. No link is lost; sets that scatter around a centre in ways of their own share no
    prefix, and cost one measurement each.
    """
    spark = nodes.sparkSession
    buckets = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = materialize(buckets.groupBy("bucket").agg(F.count("*").alias("size"))
                         .filter("size > 1"), "shared")
    found = stored(lookup_join(buckets, shared, ["bucket"], limit=LOOKUP_BYTES), "found")
    central = materialize(found.groupBy("node").agg(F.sum("size").alias("central")), "central")
    members = stored(lookup_join(found.drop("size"), central, ["node"], limit=LOOKUP_BYTES),
                     "members")
    rooted = spark.createDataFrame([], "node long, root long")
    if members.isEmpty():
        return rooted
    ids = materialize(lookup_join(nodes.select("node", F.col("first_id").alias("doc_id")),
                                  central, ["node"], limit=LOOKUP_BYTES)
                      .select("doc_id").distinct(), "ids")
    sets = stored(flat_batches(lookup_join(rows, ids, ["doc_id"], limit=LOOKUP_BYTES).select("text"),
                               _full_sets, "node long, names array<long>"), "sets")
    repeated = not sets.groupBy("node").count().filter("count > 1").isEmpty()
    if repeated:  # rows that repeat a doc_id
        sets = stored(sets.groupBy("node").agg(F.first("names").alias("names")), "sets")
    links: list[DataFrame] = []
    done: list[DataFrame] = []
    while not members.isEmpty():
        first = not done
        small = SMALL if first else SMALL_AGAIN
        top = F.max(F.struct("central", "node")) if first else F.lit(None)
        sizes = stored(members.groupBy("bucket").agg(top.alias("top"), F.count("*").alias("size")),
                       "sizes")
        few = members.join(sizes.filter(F.col("size") <= small).select("bucket"), "bucket")
        other = few.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"))
        pairs = (few.select("bucket", F.col("node").alias("a"), "n").join(other, "bucket")
                 .filter((F.col("a") < F.col("b")) & (100 * F.least("n", "m")
                                                      >= threshold * F.greatest("n", "m")))
                 .select("a", "b").distinct())
        for earlier in done:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        done.append(stored(pairs, "pairs"))
        links.append(stored(_linked(done[-1], sets, threshold), "links"))
        many = members.join(sizes.filter(F.col("size") > small).select("bucket", "top"), "bucket")
        many = stored((_by_top_member(many) if first else many).select("bucket", "node", "n"),
                      "many")
        if many.isEmpty():
            break
        sure, left = _around_centres(many, sets, threshold)
        links.append(sure)
        members = stored(_meeting_again(left), "members")
    return components(reduce(DataFrame.unionByName, links))


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at 0.85 on 5-word shingles."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), threshold=85)
