"""A corpus-cleaning pipeline over the ``documents`` table (part of subpackage ``llm``).

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``. Every stage
works on all that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagecraft.llm.common import written
from stagecraft.llm.decontaminate import find_items
from stagecraft.llm.line_dedup import deduplicate_lines
from stagecraft.llm.near_dedup import near_duplicates
from stagecraft.llm.quality import THRESHOLD, fit_quality, quality_score
from stagecraft.llm.sentencepiece_fst import encode_documents

# Columns of the stages' own, beside those of documents.
ROW, GROUP = "_row_key", "_row_group"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_score(model, F.col("text")) >= THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are similar to an earlier one; n_chars follows. A
    document that had lines and keeps none goes: every one of them is in an earlier document."""
    count = "removed_lines"
    while count in (c.lower() for c in docs.columns):
        count += "_"
    cleaned = deduplicate_lines(docs, count)
    emptied = (F.col(count) > 0) & ~F.col("text").rlike(r"[^ \n]")
    changed = F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cleaned.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", changed).select(*docs.columns)


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ROW``, a number of each row's own: a hash of its file and its place in it,
    which a later read of the same files gives again. Rows that aren't read from files are written first."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        docs = written(docs, "keyed-documents")
    return docs.withColumn(ROW, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the one with the
    smallest id (rows without an id come last; of equal ids any one). Rows are judged by their
    own text, whatever their id, so repeated rows and rows without an id go too. Rows without words
    are in no group and stay."""
    rows = with_row_key(docs)
    found = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text")).where("n_shingles > 0")
    found = written(found.select(F.col("doc_id").alias(ROW), F.col("component_id").alias(GROUP)), "near-copies")
    several = found.where(f"{ROW} <> {GROUP}").select(GROUP).distinct()
    members = written(found.join(several, GROUP), "near-groups").join(rows.select(ROW, "doc_id"), ROW)
    first = members.groupBy(GROUP).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first"))
    gone = members.join(first.select(GROUP, F.col(f"first.{ROW}").alias("stays")), GROUP).where(f"{ROW} <> stays")
    return rows.join(written(gone.select(ROW), "near-copies-gone"), ROW, "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; each is judged by its own text, also without an id."""
    rows = with_row_key(docs)
    hits = find_items(rows.select(F.col(ROW).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hits = written(hits.select(F.col("doc_id").alias(ROW)).distinct(), "benchmark-hits")
    return rows.join(hits, ROW, "left_anti").select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the documents, and whether they decode to the text."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontamination", benchmark),
    ("sentencepiece", pieces),
]

#: The classifier learns from data, which SQL cannot express. tests/llm holds the other stages
#: against brute force or the library, and the classifier against held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
