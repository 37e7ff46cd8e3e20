"""Operator 2: line deduplication by an exact set-similarity join, in DataFrame expressions only.

A line's tokens are its distinct 5-word shingles (words are what spaces separate; a line of fewer words
is one token). Two lines are similar if the Jaccard similarity of their token sets is 0.8 or more. A line
that is similar to any earlier line goes, earlier by (doc_id, hash of the text, line number).

1. Lines with equal sets are one class; only its first line can stay.
2. Prefix filter: in any order of tokens that all lines keep, classes of n tokens that are similar
   to another share one of their first n - ceil(0.8 n) + 1 tokens. In the order of hashes, which
   costs nothing but a sort, it finds the classes that may have a match; only they go on.
3. Rarity: occurrences of all their tokens, counted in ``BUCKETS`` hash buckets (a table of fixed
   size that travels in the plan). They are ordered by their bucket's count, then by hash, rare
   tokens first, and pairs share a token of the prefixes in that order.
4. Length filter (sizes within 0.8), positional filter (what follows the shared token in
   either set must suffice) and sketch filter (256 parities of each set: those that differ are
   no more than the tokens that do) hold for each candidate pair before it leaves the join; where all
   common tokens of two prefixes are known, they and what follows the last one must suffice.
   Pairs that share a frequent passage only grow with its square; the sketch drops nearly all of them there.
5. Verification counts the common tokens of the two whole sets; only sets of lines in pairs are shuffled.

Pairs in a hot group: every class is first compared with the earliest one that shares a token;
only classes that found no match this way are compared with all earlier ones. So near copies of
one line, however many, make one pair each.

Defined results: a null or empty text, and a line without words, stay as they are. Rows of one
id and text are one document: they keep the same lines. A null id sorts first. Ties can't occur,
as earlier is a total order of lines. An empty table gives an empty result; other columns come
through unchanged (``deduplicate_lines``) and may have any names but ``removed_lines``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.bloom import with_maybe
from stagecraft.llm.common import Scratch, shuffles_dropped, written

SHINGLE_WORDS = 5
BUCKETS = 1 << 14
CLASSES = 64  # of rarity
LINE = ["doc_id", "spread", "line_no"]
SKETCH = ["parity_0", "parity_1", "parity_2", "parity_3"]


# -- expressions -------------------------------------------------------------
def lines_of(texts: DataFrame, among: str = "true") -> DataFrame:
    """doc_id, spread (hash of the text), line_no and h (hashes of the words) of each line with a
    word, among those that meet a condition on ``line_no``."""
    hashed = texts.where("text IS NOT NULL").withColumn("spread", F.xxhash64("text"))  # once a text, not once a line
    lines = hashed.select("*", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(among)
    # A condition on the hashes would be pushed below them, and so hash every line twice.
    lines = lines.where(F.trim("line") != "")
    words = F.expr("transform(array_remove(split(line, ' '), ''), x -> xxhash64(x))")
    return lines.select(*LINE, words.alias("h"))


def with_tokens(lines: DataFrame) -> DataFrame:
    """``lines`` with ``tokens``: hashes of the distinct shingles (hashing skips nulls)."""
    pairs = F.expr("transform(h, (x, i) -> xxhash64(x, get(h, i + 1)))")
    fives = F.expr(
        f"transform(slice(p, 1, greatest(size(p) - {SHINGLE_WORDS - 1}, 1)), (x, i) -> xxhash64(x, get(p, i + 2), get(h, i + 4)))"
    )
    return lines.withColumn("p", pairs).select(*LINE, F.array_distinct(fives).alias("tokens"))


def bucket_of(token: Column) -> Column:
    """The rarity bucket of a token, one of ``BUCKETS``."""
    return token.bitwiseAND(BUCKETS - 1).cast("int")


def prefix_of(tokens: str) -> Column:
    """Those of a line's tokens, given in order, of which a similar line's prefix has one at least."""
    n = F.size(tokens)
    return F.slice(tokens, F.lit(1), (n - F.floor((4 * n + 4) / 5) + 1).cast("int"))


def rarity_table(sets: DataFrame) -> list[int]:
    """For each bucket of token hashes, a class from 0 (rare) to 63, by the logarithm of its count."""
    token = sets.select(F.explode("tokens").alias("token"))
    rows = token.groupBy(bucket_of(F.col("token")).alias("bucket")).count().collect()  # BUCKETS rows at most
    mean = sum(r["count"] for r in rows) / BUCKETS
    table = [0] * BUCKETS
    for r in rows:
        rarity = CLASSES // 2 + 8 * math.log2(r["count"] / mean)
        table[r["bucket"]] = int(min(max(rarity, 0), CLASSES - 1))
    return table


def in_order(table: list[int]) -> Column:
    """The tokens as sorted numbers: six bits of rarity, then the upper bits of the hash."""
    upper = F.split(F.lit(",".join(str(rarity << 57) for rarity in table)), ",").cast("array<bigint>")  # folded once

    def key(x: Column) -> Column:
        found = F.get(upper, bucket_of(x)).bitwiseOR(F.shiftrightunsigned(x, 7))
        return F.coalesce(found, F.lit(0).cast("bigint"))  # never null, and known to be: sorted as plain longs

    return F.sort_array(F.transform("tokens", key))


def sketch_of(tokens: str) -> dict[str, Column]:
    """``SKETCH``: a bit for each of 256 groups of tokens (by hash), whether their number is odd."""
    odd = f"aggregate({tokens}, 0L, (s, x) -> if((x & 192L) = {{}}L, s ^ shiftleft(1L, cast(x & 63L AS int)), s))"
    return {name: F.expr(odd.format(64 * i)) for i, name in enumerate(SKETCH)}


def similar(common: Column, n: Column, m: Column) -> Column:
    """Jaccard similarity of 0.8 or more: 9 * common >= 4 * (n + m)."""
    return 9 * common >= 4 * (n + m)


def may_be_similar(sketch: dict[str, str], n: Column, m: Column) -> Column:
    """Whether two sketches (columns of one by columns of the other) allow :func:`similar`: sets differ in
    n + m - 2 * common tokens, a ninth of n + m at most, and each bit that differs takes one of them."""
    differing = F.lit(0)
    for mine, other in sketch.items():
        differing = differing + F.bit_count(F.col(mine).bitwiseXOR(F.col(other)))
    return 9 * differing <= n + m


def _candidates(later: DataFrame, earlier: DataFrame, whole: bool, sketch: list[str] = ()) -> DataFrame:
    """Pairs of classes (line, other) that share a prefix token and pass the length, positional and
    sketch filters. Columns of both: key, line (struct), n, place (from 1) and those of ``sketch``. ``whole``:
    ``earlier`` has every row of its classes, so all tokens that two prefixes share are counted."""
    theirs = {name: f"other_{name}" for name in sketch}
    other = earlier.select(
        "key",
        F.col("line").alias("other"),
        F.col("n").alias("m"),
        F.col("place").alias("there"),
        *[F.col(name).alias(to) for name, to in theirs.items()],
    )
    n, m = F.col("n"), F.col("m")
    fits = (
        (F.col("other") < F.col("line"))
        & (5 * F.least(n, m) >= 4 * F.greatest(n, m))
        & similar(1 + F.least(n - F.col("place"), m - F.col("there")), n, m)
        & may_be_similar(theirs, n, m)
    )
    found = later.join(other, "key").where(fits)
    if not whole:
        return found.select("line", "other").distinct()
    last = [F.count("*").alias("common"), F.max("place").alias("place"), F.max("there").alias("there")]
    enough = similar(F.col("common") + F.least(n - F.col("place"), m - F.col("there")), n, m)
    return found.groupBy("line", "other", "n", "m").agg(*last).where(enough).select("line", "other")


# -- the operator ------------------------------------------------------------
def removed_lines(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, spread and line_no of the lines of ``documents`` (doc_id, text) that go. The
    result reads tables of ``scratch``."""
    written = scratch.written
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def sharing(prefixes: DataFrame) -> DataFrame:
        """Rows of ``prefixes`` (a row per token, ``key``) whose token is in several of them."""
        repeated = written(prefixes.groupBy("key").count().where("count > 1").select("key"), "keys")
        return with_maybe(prefixes, "key", repeated, "key").where("maybe").drop("maybe").join(repeated, "key", "left_semi")

    by_hash = with_tokens(lines_of(texts)).withColumn("tokens", F.sort_array("tokens"))
    n = F.size("tokens").alias("n")
    signed = written(
        by_hash.select(
            *LINE, n, F.xxhash64("tokens").alias("a"), F.hash("tokens").alias("b"), prefix_of("tokens").alias("prefix")
        ),
        "lines",
    )
    classes = written(
        signed.groupBy("a", "b", "n").agg(
            F.min(F.struct(*LINE)).alias("line"), F.count("*").alias("lines"), F.first("prefix").alias("prefix")
        ),
        "line-classes",
    )
    # The prefixes, most of what lines and classes hold, stay on disk only until the shared tokens are found.
    signed = written(signed.select(*LINE, "n", "a", "b"), "line-signs")
    scratch.drop("lines")
    wanted = written(
        sharing(classes.select("line", F.explode("prefix").alias("key")))
        .select("line.*")
        .groupBy("doc_id", "spread")
        .agg(F.collect_set("line_no").alias("wanted"))  # of one text
        .select(F.xxhash64("doc_id", "spread").alias("row"), "wanted"),
        "wanted",
    )
    classes = written(classes.drop("prefix"), "classes")
    scratch.drop("keys", "line-classes")

    # Whole sets of the classes that share a token, and their prefixes with rare tokens first.
    numbered = texts.where("text IS NOT NULL").withColumn("row", F.xxhash64("doc_id", F.xxhash64("text")))
    again = with_maybe(numbered, "row", wanted, "row").where("maybe").join(wanted, "row").dropDuplicates(["row"])
    sets = written(
        with_tokens(lines_of(again.select("doc_id", "text", "wanted"), "array_contains(wanted, line_no)")), "line-sets"
    )
    rare_first = sets.withColumns(sketch_of("tokens") | {"tokens": in_order(rarity_table(sets))})
    line = F.struct(*LINE).alias("line")
    prefixes = written(rare_first.select(line, n, *SKETCH, prefix_of("tokens").alias("prefix")), "prefixes")
    placed = prefixes.select("line", "n", *SKETCH, F.posexplode("prefix").alias("place", "key"))
    placed = placed.withColumn("place", F.col("place") + 1)
    shared = written(sharing(placed), "shared")
    scratch.drop("keys", "prefixes")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The lines of ``pairs`` that are similar to their other one. Only sets of lines in pairs are shuffled."""
        pairs = written(pairs, "pairs")
        content = lambda c: [F.col(f"{c}spread"), F.col(f"{c}line_no")]
        paired = pairs.select(F.explode(F.array("line", "other")).alias("line"))
        paired = paired.select(F.xxhash64(*content("line.")).alias("content"))
        asked = with_maybe(sets.withColumn("content", F.xxhash64(*content(""))), "content", paired, "content").where("maybe")
        mine = asked.select(F.struct(*content("")).alias("l"), F.col("tokens").alias("tl"))
        theirs = asked.select(F.struct(*content("")).alias("o"), F.col("tokens").alias("to"))
        keyed = pairs.withColumns({"l": F.struct(*content("line.")), "o": F.struct(*content("other."))})
        both = keyed.join(mine, "l").join(theirs, "o")
        common = F.size(F.array_intersect("tl", "to"))
        found = written(both.where(similar(common, F.size("tl"), F.size("to"))).select("line").distinct(), name)
        scratch.drop("pairs")
        return found

    first = shared.groupBy("key").agg(F.min(F.struct("line", "n", "place", *SKETCH)).alias("c")).select("key", "c.*")
    matched = verified(_candidates(shared, written(first, "firsts"), whole=False, sketch=SKETCH), "matched")
    open_ = shared.join(matched, "line", "left_anti")
    matched = matched.union(verified(_candidates(open_, shared, whole=True, sketch=SKETCH), "matched-later"))

    judged = classes.join(matched.withColumn("gone", F.lit(True)), "line", "left")
    judged = written(judged.where("lines > 1 OR gone").select("a", "b", "n", "line", "gone"), "judged")
    scratch.drop_all("line-signs", "judged")
    found = with_maybe(signed, "a", judged, "a").where("maybe").join(judged, ["a", "b", "n"])
    # Of a class without a match, lines that are the first one (or equal it as rows) stay.
    return found.where(F.col("gone") | (F.struct(*LINE) != F.col("line"))).select(*LINE).distinct()


def deduplicate_lines(documents: DataFrame, count_column: str = "removed_lines") -> DataFrame:
    """``documents`` without the lines that go (column text; all others as they are), with
    ``count_column``, the number of them, which must be a new name. Documents that lose no line
    aren't shuffled."""
    if count_column.lower() in (c.lower() for c in documents.columns):
        raise ValueError(f"documents has a column {count_column} already")
    scratch = Scratch(documents.sparkSession)
    with shuffles_dropped(documents.sparkSession):  # the tables on the way are on disk already
        gone = written(
            removed_lines(documents, scratch)
            .groupBy("doc_id", "spread")
            .agg(F.collect_set("line_no").alias("line_nos"))
            .select(F.col("doc_id").alias("gone_id"), F.col("spread").alias("gone_spread"), "line_nos"),
            "gone",
        )
    scratch.drop_all()
    columns = [F.col(c) for c in documents.columns]
    keyed = documents.select(F.struct(*columns).alias("row")).withColumn("gone_spread", F.xxhash64("row.text"))
    asked = with_maybe(keyed, "gone_spread", gone, "gone_spread")
    touched = asked.where("maybe").join(
        gone, (asked["gone_spread"] == gone["gone_spread"]) & asked["row.doc_id"].cast("bigint").eqNullSafe(gone["gone_id"]), "left"
    )
    kept = F.array_join(
        F.filter(F.split("row.text", "\n"), lambda x, i: ~F.coalesce(F.array_contains("line_nos", i), F.lit(False))), "\n"
    )
    text = F.when(F.col("line_nos").isNull(), F.col("row.text")).otherwise(kept)
    as_before = [F.col("row").getField(c).alias(c) if c != "text" else None for c in documents.columns]
    out = lambda t: [x if x is not None else t.alias("text") for x in as_before]
    removed = F.coalesce(F.size("line_nos"), F.lit(0))
    changed = touched.select(*out(text), F.when(F.col("line_nos").isNull(), 0).otherwise(removed).alias(count_column))
    same = asked.where("NOT maybe").select(*out(F.col("row.text")), F.lit(0).alias(count_column))
    return changed.union(same)


def line_dedup_query(spark, sf_dir: str) -> DataFrame:
    """Op 2: doc_id, lines, lines removed and the md5 of what is left, of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate_lines(documents.withColumn("n_lines", F.size(F.split("text", "\n")))).select(
        "doc_id",
        F.when(F.col("text").isNull() & (F.col("n_lines") < 0), 0).otherwise(F.coalesce("n_lines", F.lit(0))).alias("n_lines"),
        F.col("removed_lines").alias("n_removed"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
    )


LINE_SQL = """
WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), lines AS (
    SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM split
), words AS (
    SELECT doc_id, line_no, list_filter(string_split(line, ' '), lambda x: x <> '') AS w FROM lines
), places AS (
    SELECT doc_id, line_no, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM words WHERE len(w) > 0
), tokens AS (
    SELECT DISTINCT doc_id, line_no, array_to_string(w[pos : pos + 4], ' ') AS token FROM places
), sizes AS (
    SELECT doc_id, line_no, count(*) AS n FROM tokens GROUP BY ALL
), pairs AS (
    SELECT b.doc_id, b.line_no, a.doc_id AS other_doc, a.line_no AS other_no, count(*) AS common
    FROM tokens a JOIN tokens b ON a.token = b.token AND (a.doc_id, a.line_no) < (b.doc_id, b.line_no)
    GROUP BY ALL
), gone AS (
    SELECT DISTINCT p.doc_id, p.line_no
    FROM pairs p JOIN sizes x ON x.doc_id = p.doc_id AND x.line_no = p.line_no
        JOIN sizes y ON y.doc_id = p.other_doc AND y.line_no = p.other_no
    WHERE 9 * p.common >= 4 * (x.n + y.n)
)
SELECT d.doc_id, count(l.line_no)::INTEGER AS n_lines, count(g.line_no)::INTEGER AS n_removed,
    md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL), '')) AS text_md5
FROM documents d LEFT JOIN lines l ON l.doc_id = d.doc_id
    LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no
GROUP BY d.doc_id
"""
