"""Operator 13: a Merkle manifest of a table, by slot pivots.

A row is a leaf: the hash of its fields. The leaves of a group (for documents: of a language) in
ascending order make a tree: every ``FANOUT`` consecutive nodes become their hash, until one
remains, the group's root. The group roots, in order of the group's value (null first, bytewise),
make one more tree in the same way, whose last node is the root of the manifest.

* Positions: the leaves are sorted by ranges of (group, order, leaf), so a group that holds a third
  of all rows is dealt out like any other; a row's position is its place in its range plus the
  rows of its group in earlier ranges. No window or task holds a whole group.
* Slot pivot: a level's nodes are grouped by their parent; conditional aggregates spread them into
  ``FANOUT`` columns. All columns joined are the parent's input; all but the own slot's column are
  a child's siblings. A level has an eighth of the rows below it, so all levels above the leaves
  together are a seventh of them.
* Proofs go down the same pivots: a node's path is its own siblings, then its parent's path. Digests
  are kept as 32 bytes; hex digits of joined bytes are the joined hex digits of the digests.
* Folding hashes a (changed) leaf with its siblings, level by level; the result is the root exactly
  if the leaf is the one that the manifest was made of.

Defined results: a field that is null counts as ``-``, an empty one as ``0:``. A row without an id
is a leaf like others (before all ids of its group) and is never changed. Rows of one id are
ordered by their leaf's hash; repeated rows are equal leaves, each with its own place and path. A
group of one row has that leaf as its root; a single group's root is the manifest's root. An empty
table gives no rows. Texts are hashed whole, whatever their length. Other columns are ignored,
whatever their names. A field that is missing from the table is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagecraft.llm.common import Scratch, lower_ascii

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Bytes of a digest.
DIGEST = 32


def digest(joined: Column) -> Column:
    """The hash, as bytes, of the hex text of joined digests."""
    return F.unhex(F.sha2(F.lower(F.hex(joined)), 256))


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of a row's fields, as bytes: each `-` if null, else its bytes' number, `:` and its text."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def numbered(rows: DataFrame, group: str, order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``pos`` (place within the group, from 0) and ``of`` (rows of the group)."""
    keys = [group, *order]
    placed = scratch.written(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), name
    )
    # A range's rows of one group are consecutive; there are at most as many runs as ranges and groups.
    place = F.shiftright("_at", 33)
    runs = placed.groupBy(group, place.alias("_range")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    runs = scratch.written(runs, f"{name}-runs")
    whole = Window.partitionBy(group)
    earlier = runs.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_in"),
        "_first",
        (F.sum("_n").over(whole.orderBy("_range")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("of"),
    )
    found = placed.join(earlier, F.col(group).eqNullSafe(F.col("_group")) & (place == F.col("_in")))
    return found.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_group", "_in", "_first", "_before")


def pivoted(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """tree, of, parent and slots s0, s1, ..: the nodes (tree, pos, of, payload) of each parent."""
    node = f"struct({', '.join(payload)})"
    spread = [F.expr(f"max(CASE WHEN pmod(pos, {FANOUT}) = {i} THEN {node} END)").alias(f"s{i}") for i in range(FANOUT)]
    return nodes.where("of > 1").groupBy("tree", "of", F.expr(f"pos div {FANOUT}").alias("parent")).agg(*spread)


def joined(without: int | None = None) -> str:
    """The digests of a pivot's slots, joined; but for one slot. As SQL."""
    return f"concat({', '.join(f"coalesce(s{i}.d, X'')" for i in range(FANOUT) if i != without)})"


def children() -> Column:
    """slot, node and siblings of a pivot's slots, but for the empty ones."""
    child = [f"CASE WHEN s{i} IS NOT NULL THEN struct({i} AS slot, s{i} AS node, {joined(i)} AS siblings) END" for i in range(FANOUT)]
    return F.expr(f"array_compact(array({', '.join(child)}))")


def parents(pivot: DataFrame) -> DataFrame:
    """tree, pos, of and d of a pivot's parents."""
    up = F.expr(f"(of + {FANOUT - 1}) div {FANOUT}")
    return pivot.select("tree", F.col("parent").alias("pos"), up.alias("of"), digest(F.expr(joined())).alias("d"))


class Forest:
    """Trees over ``nodes`` (tree, pos, of and the payload, of which ``d`` is the digest): their
    pivots, one written table a level, and their roots."""

    def __init__(self, nodes: DataFrame, payload: Sequence[str], largest: int, scratch: Scratch, name: str) -> None:
        self.payload, self.lone, self.levels = payload, nodes.where("of = 1"), []
        tops = [self.lone.select("tree", F.lit(0).alias("level"), "d")]
        while largest > 1:
            self.levels.append(scratch.written(pivoted(nodes, payload if not self.levels else ["d"]), f"{name}-{len(self.levels)}"))
            nodes = parents(self.levels[-1])
            tops.append(nodes.where("of = 1").select("tree", F.lit(len(self.levels)).alias("level"), "d"))
            largest = -(-largest // FANOUT)
        roots = tops[0]
        for top in tops[1:]:
            roots = roots.unionByName(top)
        self.roots = scratch.written(roots, f"{name}-roots")

    def paths(self, base: DataFrame) -> DataFrame:
        """tree, pos, the payload, and ``path`` of every leaf: slot and siblings from the leaf up,
        then those of ``base`` (tree, level, path and more columns, which leaves get too)."""
        more = [c for c in base.columns if c not in ("tree", "level", "path")]
        up = None
        for level in reversed(range(len(self.levels))):
            above = base.where(F.col("level") == level + 1).select("tree", F.lit(0).cast("bigint").alias("parent"), "path", *more)
            if up is not None:
                above = above.unionByName(up.select("tree", F.col("pos").alias("parent"), "path", *more))
            own = F.array(F.struct("child.slot", "child.siblings"))
            up = (
                self.levels[level]
                .join(above, ["tree", "parent"])
                .select("tree", "parent", "path", *more, F.explode(children()).alias("child"))
                .select(
                    "tree",
                    (F.col("parent") * FANOUT + F.col("child.slot")).alias("pos"),
                    "child.node.*",
                    F.concat(own, "path").alias("path"),
                    *more,
                )
            )
        lone = self.lone.select("tree", "pos", *self.payload).join(base.where("level = 0").drop("level"), "tree")
        columns = ["tree", "pos", *self.payload, "path", *more]
        return lone.select(*columns) if up is None else up.select(*columns).unionByName(lone.select(*columns))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""

    def step(d: Column, p: Column) -> Column:
        at = p["slot"] * DIGEST
        return digest(F.concat(F.substring(p["siblings"], F.lit(1), at), d, F.substring(p["siblings"], at + 1, F.lit(2**31 - 1))))

    return F.aggregate(path, start, step)


def merkle_manifest(
    rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", changed: Mapping[str, Column] | None = None
) -> DataFrame:
    """The ``order`` column, leaf, subroot, root, proof_sha256, folded_root, verified and path of every row.

    ``changed`` gives other values for some fields (null where a row stays as it is, by the rule of
    :func:`changed_leaf`): folded_root is made from the changed row's leaf and the original siblings.
    """
    scratch = Scratch(rows.sparkSession)
    original = leaf([F.col(f) for f in fields])
    other = changed_leaf(fields, changed or {})
    leaves = scratch.written(
        rows.select(F.col(order).alias("id"), F.col(group).alias("group"), original.alias("d"), other.alias("other")), "leaves"
    )
    placed = numbered(leaves, "group", ["id", "d"], scratch, "placed")
    groups = placed.where("pos = 0").select("group", "of", F.lit(0).cast("bigint").alias("tree"))
    groups = numbered(scratch.written(groups, "groups").withColumnRenamed("of", "leaves"), "tree", ["group"], scratch, "group-order")
    groups = scratch.written(groups.selectExpr("group", "pos AS number", "of", "leaves"), "numbered-groups")
    told = groups.agg(F.max("leaves").alias("leaves"), F.max("of").alias("groups")).first()

    numbers = groups.select(F.col("group").alias("_group"), F.col("number").alias("tree"))
    nodes = placed.join(numbers, F.col("group").eqNullSafe(F.col("_group"))).select("tree", "pos", "of", "d", "id", "other")
    payload = ["d", "id", "other"]
    trees = Forest(scratch.written(nodes, "nodes"), payload, told["leaves"] or 0, scratch, "tree")
    scratch.drop("leaves", "placed")
    # The groups' roots are the leaves of the last tree.
    counted = groups.selectExpr("number AS tree", "of").distinct()
    top = trees.roots.join(counted, "tree").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "of", "d", "level")
    last = Forest(scratch.written(top, "group-roots"), ["d", "level"], told["groups"] or 0, scratch, "top")
    bottom = last.roots.select("tree", "level", F.array().cast("array<struct<slot:int,siblings:binary>>").alias("path"), F.col("d").alias("root"))
    above = last.paths(bottom).select(F.col("pos").alias("tree"), "level", "path", F.col("d").alias("subroot"), "root")
    found = trees.paths(scratch.written(above, "group-paths"))

    text = lambda c: F.lower(F.hex(c))
    proof = F.aggregate("path", F.lit(b""), lambda x, p: F.concat(x, p["siblings"]))
    found = found.select(
        F.col("id").alias(order),
        text("d").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        F.sha2(text(proof), 256).alias("proof_sha256"),
        text(folded(F.coalesce("other", "d"), F.col("path"))).alias("folded_root"),
        "path",
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def changed_leaf(fields: Sequence[str], changed: Mapping[str, Column]) -> Column:
    """The leaf of the row with ``changed`` fields; null where none of them is given."""
    if not changed:
        return F.lit(None).cast("binary")
    fields_now = [F.coalesce(changed[f], F.col(f)) if f in changed else F.col(f) for f in fields]
    return F.when(F.coalesce(*[c.isNotNull() for c in changed.values()]), leaf(fields_now))


def merkle_query(spark, sf_dir: str) -> DataFrame:
    """Op 13: the manifest of all documents; the rows that 3 divides (by the crc32 of their id) are
    folded with A-Z of their text in lower case."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower_ascii(F.col("text")))
    return merkle_manifest(documents, changed={"text": tampered}).drop("path")


MERKLE_SQL = r"""
WITH RECURSIVE field AS (
    SELECT doc_id, lang, row_number() OVER () AS row_id,
        [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS original,
        [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR),
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')] AS lowered,
        xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
            lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 3 = 0 AS touched
    FROM documents
), leaves AS (
    SELECT row_id, doc_id, lang, coalesce(touched, false) AS touched,
        sha256(list_aggregate(list_transform(original, lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '')) AS leaf,
        sha256(list_aggregate(list_transform(lowered, lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '')) AS other
    FROM field
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), levels(lang, level, nodes) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range((len(nodes) + 7) >> 3),
        lambda i: sha256(array_to_string(nodes[i * 8 + 1 : i * 8 + 8], ''))) FROM levels WHERE len(nodes) > 1
), subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS number
    FROM levels WHERE len(nodes) = 1
), tops(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY number) FROM subroots HAVING count(*) > 0
    UNION ALL
    SELECT level + 1, list_transform(range((len(nodes) + 7) >> 3),
        lambda i: sha256(array_to_string(nodes[i * 8 + 1 : i * 8 + 8], ''))) FROM tops WHERE len(nodes) > 1
), steps AS (
    SELECT p.row_id, l.level, l.nodes, p.pos >> (3 * l.level) AS place
    FROM placed p JOIN levels l ON p.lang IS NOT DISTINCT FROM l.lang AND len(l.nodes) > 1
    UNION ALL
    SELECT p.row_id, 1000 + t.level, t.nodes, s.number >> (3 * t.level)
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN tops t ON len(t.nodes) > 1
), sides AS (
    SELECT row_id, level, array_to_string(nodes[((place >> 3) << 3) + 1 : place], '') AS a,
        array_to_string(nodes[place + 2 : ((place >> 3) << 3) + 8], '') AS b FROM steps
), proofs AS (
    SELECT row_id, list({'a': a, 'b': b} ORDER BY level) AS path,
        string_agg(a || b, '' ORDER BY level) AS proof FROM sides GROUP BY row_id
), folds(row_id, done, d, path) AS (
    SELECT l.row_id, 0, CASE WHEN touched THEN other ELSE leaf END, coalesce(path, []) FROM leaves l LEFT JOIN proofs USING (row_id)
    UNION ALL
    SELECT row_id, done + 1, sha256(path[done + 1].a || d || path[done + 1].b), path FROM folds WHERE done < len(path)
)
SELECT p.doc_id, p.leaf, s.subroot, t.nodes[1] AS root, sha256(coalesce(q.proof, '')) AS proof_sha256,
    f.d AS folded_root, f.d = t.nodes[1] AS verified
FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN tops t ON len(t.nodes) = 1
    LEFT JOIN proofs q USING (row_id) JOIN folds f ON f.row_id = p.row_id AND f.done = len(f.path)
"""
