"""Operator 4: MinHash near-duplicate groups.

Two documents are linked if the Jaccard similarity of their sets of distinct k-word shingles is
``threshold`` or more; a group is a connected component of links.

1. Documents with equal sets are one class (a grouping by a 128-bit fingerprint of the set), so
   copies are never paired. What follows works on classes.
2. Signature: ``BANDS * ROWS`` universal hash minima, in bands of ``ROWS``. Two sets of similarity
   0.8 share none of the bands with a probability of (1 - 0.8^ROWS)^BANDS = 3 in a million.
3. Classes that share a band are in one bucket. Each bucket is a star: its members are compared
   with its first one, not with each other.
4. A pair of sizes that can have the similarity passes the signature check (the share of equal minima, from one byte of each, is not
   far below the threshold), then its full sets are compared exactly.
5. Links become groups by alternating large-star and small-star.
6. The classes of buckets that still hold several groups go through one exact set-similarity join
   on their shingles (rarest first; prefix, length and positional filters, parities of the sets
   and one bit of each minimum, compared inside the join), which leaves no pair of different
   groups that has the similarity untried (but for six standard deviations of the minima's bits;
   parities are a bound). Its links merge groups in one more computation of components. So there
   are two passes, however the links lie.

The work of step 6 grows with the classes outside a family's largest group times those inside it,
for families whose similarities lie around the threshold.

No group of documents is collected anywhere; a hot bucket or centre is a hot join key, which
Spark splits (both sides of those joins are tables read back, so adaptive skew joins apply).

Defined results: a document without words or text has an empty set, is linked with nothing and
kept. One without an id is linked with nothing, has a null component_id and is kept. Rows of one
id and text are one class, so each is reported with the same group; an id with several texts can
be in several groups. An empty table gives an empty result. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagecraft.llm.bloom import bloom_semi_join
from stagecraft.llm.common import (
    Scratch,
    distinct_sorted,
    minima,
    mix,
    pieces,
    release,
    shingle_hashes,
    universal_family,
    utf8_buffers,
    word_hashes,
)

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
BANDS, ROWS = 42, 6
# Checks of signatures give way by so many standard deviations.
DEVIATIONS = 6
BIT_WORDS = -(-BANDS * ROWS // 64)
# Parities of a set, and sets that are counted at once.
PARITY_WORDS = 8
PARITY_ROWS = 4096
FACTORS, TERMS = universal_family(BANDS * ROWS)


# -- inside a task -----------------------------------------------------------
def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: (hashes, offsets)."""
    hashes, word_at, _, _ = word_hashes(data, offsets)
    return distinct_sorted(*shingle_hashes(hashes, word_at, k))


def fingerprints(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, which don't depend on an order."""
    sums = []
    for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ salt), dtype=np.uint64)])
        sums.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return sums[0], sums[1]


def signatures(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each band, one byte of each minimum) of sets that aren't empty."""
    low = minima(values, at[:-1], FACTORS, TERMS)
    bands = np.empty((BANDS, len(at) - 1), dtype=np.uint64)
    for b in range(BANDS):
        bands[b] = np.uint64(b)
        for r in range(ROWS):
            bands[b] = mix(bands[b] * np.uint64(0x9E3779B97F4A7C15) + low[b * ROWS + r])
    return np.ascontiguousarray(bands.T).view(np.int64), np.ascontiguousarray((mix(low) >> np.uint64(56)).astype(np.uint8).T)


def least_share(percent: int) -> float:
    """Share of equal minima that a pair needs to be compared in full."""
    s = percent / 100
    return s - DEVIATIONS * math.sqrt(s * (1 - s) / (BANDS * ROWS))


def most_bits(percent: int) -> int:
    """How many bits of a pair may differ; one differs with probability (1 - similarity) / 2."""
    p = (1 - percent / 100) / 2
    return int(BANDS * ROWS * p + DEVIATIONS * math.sqrt(BANDS * ROWS * p * (1 - p)))


def low_bits(lows: np.ndarray) -> np.ndarray:
    """The lowest bit of each of a set's minima, packed into BIT_WORDS whole numbers."""
    packed = np.zeros((len(lows), 8 * BIT_WORDS), dtype=np.uint8)
    bits = np.packbits(lows & 1, axis=1)
    packed[:, : bits.shape[1]] = bits
    return packed.view(np.int64)


def parities(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each of PARITY_WORDS * 64 ranges of hashes, whether an odd number of a set's are in it, packed.

    A hash that is in one of two sets alone changes one parity, one in both none: two sets differ in
    at least as many hashes as parities."""
    width = 64 * PARITY_WORDS
    out = np.zeros((len(at) - 1, PARITY_WORDS), dtype=np.int64)
    for start in range(0, len(out), PARITY_ROWS):
        ends = at[start : start + PARITY_ROWS + 1]
        held = values[ends[0] : ends[-1]] // np.uint64((1 << 64) // width)
        place = np.repeat(np.arange(len(ends) - 1) * width, np.diff(ends)) + held.astype(np.int64)
        odd = (np.bincount(place, minlength=(len(ends) - 1) * width) & 1).astype(np.uint8)
        out[start : start + PARITY_ROWS] = np.packbits(odd.reshape(-1, width), axis=1).view(np.int64)
    return out


def _sign(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            for start, stop in pieces(offsets):
                values, at = shingle_sets(data, offsets[start : stop + 1], k)
                n = np.diff(at)
                a, b = fingerprints(values, at)
                some = np.flatnonzero(n)
                bands, lows = np.zeros((0, BANDS), np.int64), np.zeros((0, BANDS * ROWS), np.uint8)
                if len(some):
                    bands, lows = signatures(values, np.append(at[some], at[-1]))
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                rows = iter(lows)
                bit_ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BIT_WORDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start).cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(a),
                        pa.array(b),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
                        pa.array([next(rows).tobytes() if x else None for x in n.tolist()], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(bit_ends), pa.array(low_bits(lows).ravel())),
                    ],
                    names=["doc_id", "n_shingles", "a", "b", "bands", "lows", "bits"],
                )
        release()

    return sign


def _sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            for start, stop in pieces(offsets):
                values, at = shingle_sets(data, offsets[start : stop + 1], k)
                a, b = fingerprints(values, at)
                ends = pa.array(np.arange(len(at), dtype=np.int32) * PARITY_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a),
                        pa.array(b),
                        pa.array([values[x:y].tobytes() for x, y in zip(at[:-1], at[1:])], pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(parities(values, at).ravel())),
                    ],
                    names=["a", "b", "hashes", "parities"],
                )
        release()

    return sets


@F.arrow_udf(T.DoubleType())
def equal_share(x: pa.Array, y: pa.Array) -> pa.Array:
    """Share of equal bytes of two signatures, less what chance gives."""
    width = BANDS * ROWS
    p, q = (utf8_buffers(c) for c in (x, y))
    p, q = (data[at[0] : at[-1]].reshape(-1, width) for data, at in (p, q))
    same = np.empty(len(p))
    for i in range(0, len(p), 4096):  # at most a megabyte of comparisons at once
        same[i : i + 4096] = (p[i : i + 4096] == q[i : i + 4096]).mean(axis=1)
    return pa.array((same - 1 / 256) / (1 - 1 / 256), pa.float64())


@F.arrow_udf(T.LongType())
def common(x: pa.Array, y: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets."""
    out = []
    for p, q in zip(x, y):
        a, b = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        out.append(int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(b) else 0)
    return pa.array(out, pa.int64())


# -- components --------------------------------------------------------------
def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``rows`` (u, v) with the ``m`` that ``least`` (u, m) has for u. A third of all rows may have one
    u. With a hash beside the key the join asks for exchanges of its own on both sides, whose large
    partitions adaptive execution splits; the one that has aggregated ``least`` it couldn't."""
    key = F.xxhash64("u").alias("h")
    return rows.select("*", key).join(least.select("*", key), ["u", "h"]).drop("h")


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node and component (the least node reachable) of every node of ``edges`` (u, v: bigint),
    by alternating large-star and small-star until every node points to its component's root."""
    scratch = scratch or Scratch(edges.sparkSession)
    edges = scratch.written(edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").where("u <> v").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = _with_least(both.where("v > u"), least).selectExpr("v AS u", "m AS v").where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least).where("v <> m").selectExpr("v AS u", "m AS v")
        edges = scratch.written(small.union(least.selectExpr("u", "m AS v")).where("u <> v").distinct(), "edges")
        # Done when no node has two edges down, or both one down and one up.
        ends = edges.selectExpr("u AS node", "1 AS down", "0 AS up").union(edges.selectExpr("v", "0", "1"))
        ends = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if ends.where("down > 1 OR (down = 1 AND up = 1)").isEmpty():
            break
    roots = edges.selectExpr("v AS node", "v AS component").distinct()
    return edges.selectExpr("u AS node", "v AS component").union(roots)


# -- the search --------------------------------------------------------------
class _Search:
    """Candidate pairs of classes, their verification, and the groups found so far."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> None:
        self.classes, self.sets, self.percent, self.scratch = classes, sets, percent, scratch
        self.groups: DataFrame | None = None  # node, component: of linked classes

    def grouped(self, rows: DataFrame, node: str, to: str) -> DataFrame:
        """``rows`` with column ``to``: the group of column ``node`` (itself without a link)."""
        if self.groups is None:
            return rows.withColumn(to, F.col(node))
        found = self.groups.select(F.col("node").alias(node), F.col("component").alias(to))
        return rows.join(found, node, "left").withColumn(to, F.coalesce(to, node))

    def verify(self, pairs: DataFrame) -> bool:
        """Link the pairs (u, v) of different groups that pass; whether there are any."""
        pairs = pairs.where("u <> v").selectExpr("least(u, v) AS u", "greatest(u, v) AS v").distinct()
        pairs = self.grouped(self.grouped(pairs, "u", "gu"), "v", "gv").where("gu <> gv")
        lows = self.classes.select("node", "lows")
        likely = (
            pairs.join(lows.selectExpr("node AS u", "lows AS lu"), "u")
            .join(lows.selectExpr("node AS v", "lows AS lv"), "v")
            .where(equal_share("lu", "lv") >= least_share(self.percent))
            .select("u", "v", "gu", "gv")
        )
        likely = self.scratch.written(likely, "likely")
        full = (
            likely.join(self.sets.selectExpr("node AS u", "hashes AS hu"), "u")
            .join(self.sets.selectExpr("node AS v", "hashes AS hv"), "v")
            .select("gu", "gv", (F.length("hu") / 8 + F.length("hv") / 8).cast("bigint").alias("total"), common("hu", "hv").alias("both"))
        )
        passed = full.where(f"100 * both >= {self.percent} * (total - both)")
        links = self.scratch.written(passed.selectExpr("gu AS u", "gv AS v").distinct(), "links")
        if links.isEmpty():
            return False
        merged = connected_components(links, self.scratch)  # of whole groups
        if self.groups is None:
            self.groups = self.scratch.written(merged, "groups")
        else:
            onto = merged.selectExpr("node AS component", "component AS onto")
            old = self.groups.join(onto, "component", "left").selectExpr("node", "coalesce(onto, component) AS component")
            new = merged.join(self.groups.select("node"), "node", "left_anti")
            self.groups = self.scratch.written(old.union(new.select("node", "component")), "groups")
        return True


def fitting(n: F.Column, m: F.Column, percent: int) -> F.Column:
    """Whether sets of n and m shingles can have the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def near_duplicates(
    documents: DataFrame, k: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of the group) and kept of every row
    of ``documents`` (doc_id, text). Links need ``100 * intersection >= percent * union``."""
    scratch = Scratch(documents.sparkSession)
    written = scratch.written
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = written(
        texts.mapInArrow(
            _sign(k), "doc_id bigint, n_shingles bigint, a bigint, b bigint, bands array<bigint>, lows binary, bits array<bigint>"
        ),
        "signed",
    )
    classes = written(
        signed.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("a", "b")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("lows").alias("lows"),
            F.first("bits").alias("bits"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    rows = classes.select("node", "n", F.explode("bands").alias("bucket"))
    centres = written(
        rows.groupBy("bucket")
        .agg(F.min(F.struct("node", "n")).alias("centre"), F.max("node").alias("last"))
        .where("centre.node <> last")
        .select("bucket", "centre"),
        "centres",
    )
    shared = written(rows.join(centres, "bucket"), "buckets")
    stars = written(
        shared.where("node <> centre.node")
        .where(fitting(F.col("n"), F.col("centre.n"), percent))
        .select("node", F.col("centre.node").alias("centre"))
        .distinct(),
        "stars",
    )
    # Sets of the classes that share a bucket, from the text of one document of each.
    wanted = written(
        classes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "a", "b", "first_id"), "wanted"
    )
    sets = written(
        bloom_semi_join(texts, wanted.select(F.col("first_id").alias("doc_id")), "doc_id")
        .mapInArrow(_sets(k), "a bigint, b bigint, hashes binary, parities array<bigint>")
        .join(wanted, ["a", "b"])
        .select("node", "hashes", "parities")
        .dropDuplicates(["node"]),
        "sets",
    )
    search = _Search(classes, sets, percent, scratch)
    search.verify(stars.selectExpr("node AS u", "centre AS v"))
    mixed = _mixed(search, shared)
    if not mixed.isEmpty():
        placed = prefixes(sets, mixed, percent, scratch)
        search.verify(prefix_pairs(_meeting(search, placed), percent))

    groups = classes.select("node", "a", "b", "first_id")
    groups = search.grouped(groups, "node", "group")
    smallest = written(groups.groupBy("group").agg(F.min("first_id").alias("component_id")), "smallest")
    named = written(groups.join(smallest, "group").select("a", "b", "component_id"), "named")
    scratch.drop_all("signed", "named")  # which the result reads
    alone = signed.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    grouped = (
        signed.where("doc_id IS NOT NULL AND n_shingles > 0")
        .select("doc_id", "n_shingles", "a", "b")
        .join(named, ["a", "b"])
        .select("doc_id", "n_shingles", "component_id")
    )
    return grouped.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _mixed(search: _Search, shared: DataFrame) -> DataFrame:
    """node and n of the classes that share a bucket with one of another group."""
    rows = search.scratch.written(search.grouped(shared.select("bucket", "node", "n"), "node", "group"), "in-groups")
    buckets = rows.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high")
    return search.scratch.written(rows.join(buckets.select("bucket"), "bucket").select("node", "n").distinct(), "mixed")


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8_buffers(batch.column(1))
        for start, stop in pieces(offsets):
            shingle = np.frombuffer(data[offsets[start] : offsets[stop]].tobytes(), np.int64)
            node = np.repeat(batch.column(0).slice(start, stop - start).to_numpy(), np.diff(offsets[start : stop + 1]) // 8)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(shingle)], names=["node", "shingle"])


def prefixes(sets: DataFrame, nodes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """node, n, at and shingle: the rarest shingles of each of ``nodes`` (node, n), and their place
    in the order from rare to frequent, as far as a pair that has the similarity can meet first.

    Sets of n >= m shingles have the similarity if they share ``percent / (100 + percent) * (n + m)``.
    If the first one that they share is number i of the one and j of the other (from 0), they share
    at most min(n - i, m - j), so i is below ``(100 - percent) / 100 * n``. Shingles that a large
    family shares come last.
    """
    shingles = scratch.written(
        sets.join(nodes.select("node"), "node", "left_semi").select("node", "hashes").mapInArrow(_explode_sets, "node bigint, shingle bigint"),
        "shingles",
    )
    # Shingles of one set alone come first and make no pair.
    times = scratch.written(shingles.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1"), "times")
    ordered = shingles.join(times, "shingle").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("times", "shingle"))).alias("by"))
    placed = (
        ordered.join(nodes, "node")
        .select("node", "n", F.size("by").alias("some"), F.posexplode("by").alias("pos", "one"))
        .select("node", "n", (F.col("n") - F.col("some") + F.col("pos")).alias("at"), F.col("one.shingle").alias("shingle"))
        .where(f"100 * (n - at) >= {percent} * n")
    )
    placed = scratch.written(placed, "placed")
    scratch.drop("shingles", "times")
    return placed


def _meeting(search: _Search, placed: DataFrame) -> DataFrame:
    """The rows of :func:`prefixes` whose shingle classes of several groups have, with the class's
    group and the shingle's largest group."""
    bits = search.classes.select("node", *[F.get("bits", F.lit(i)).alias(f"bits{i}") for i in range(BIT_WORDS)])
    odd = search.sets.select("node", *[F.get("parities", F.lit(i)).alias(f"odd{i}") for i in range(PARITY_WORDS)])
    rows = search.scratch.written(search.grouped(placed, "node", "group").join(bits, "node").join(odd, "node"), "prefixes")
    held = (
        rows.groupBy("shingle", "group")
        .agg(F.count("*").alias("size"))
        .groupBy("shingle")
        .agg(F.count("*").alias("groups"), F.max(F.struct("size", "group")).alias("most"))
        .where("groups > 1")
        .selectExpr("shingle", "most.group AS largest")
    )
    return search.scratch.written(rows.join(held, "shingle"), "meeting")


def prefix_pairs(meeting: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of classes of different groups: at least all that have the similarity. The
    shorter set has fewer shingles to meet in than the longer one."""
    shorter = meeting.where(f"{100 + percent} * (n - at) >= {2 * percent} * n")
    bits = lambda side: [
        *[f"bits{i} AS {side}{i}" for i in range(BIT_WORDS)],
        *[f"odd{i} AS {side}odd{i}" for i in range(PARITY_WORDS)],
    ]
    shorter = shorter.selectExpr("shingle", "node AS v", "group AS gv", "n AS nv", "n - at AS rv", "largest AS lv", *bits("y"))
    longer = meeting.selectExpr("shingle", "node AS u", "group AS gu", "n AS nu", "n - at AS ru", "largest AS lu", *bits("x"))
    differ = " + ".join(f"bit_count(x{i} ^ y{i})" for i in range(BIT_WORDS))
    # Sets that have the similarity differ in (100 - percent) / (100 + percent) * (n + m) shingles at most.
    apart = " + ".join(f"bit_count(xodd{i} ^ yodd{i})" for i in range(PARITY_WORDS))
    enough = (
        f"(nu > nv OR (nu = nv AND u > v)) AND gu <> gv AND {100 + percent} * least(ru, rv) >= {percent} * (nu + nv) "
        f"AND {100 + percent} * ({apart}) <= {100 - percent} * (nu + nv) AND {differ} <= {most_bits(percent)}"
    )
    # A member of the largest group meets those outside it only.
    outer = longer.where("gu <> lu").join(shorter, "shingle")
    inner = longer.where("gu = lu").join(shorter.where("gv <> lv"), "shingle")
    return outer.union(inner).where(enough).select("u", "v")


def near_dedup_query(spark, sf_dir: str) -> DataFrame:
    """Op 4: groups of all documents by 4-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4)


NEAR_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS pos FROM words WHERE len(w) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[pos : pos + 3], ' ') AS s FROM places
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), edges AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, e.v FROM reach JOIN edges e ON e.u = reach.r
), least AS (
    SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least c USING (doc_id)
"""
