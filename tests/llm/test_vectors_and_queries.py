"""Operator 1, the registered queries against their SQL, and the pipeline's stages."""

import math
import os

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from test_text_operators import groups_by_force, shingles

from stagecraft.llm import line_dedup, queries, topk_search
from stagecraft.llm.line_dedup import deduplicate_lines

TABLES = "documents embeddings pages benchmark labels".split()


def best_by_force(rows, k):
    fit = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in fit), default=0)
    fit = [(i, v + [0] * (width - len(v))) for i, v in fit]
    out = []
    for q in sorted({i for i, _ in fit if i % 50 == 0}):
        best = {}
        for i, v in fit:
            if i != q:
                s = max(sum(a * b for a, b in zip(u, v)) for j, u in fit if j == q)
                best[i] = max(best.get(i, s), s)
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.append((q, rank, i, s))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_top_k_against_brute_force(spark, monkeypatch, seed):
    """Clusters, one vector that a third of the rows share, ties, and vectors that take no part."""
    monkeypatch.setattr(topk_search, "CHUNK", 40)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 5)
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.2 * r.normal(size=8) * r.uniform(0, 2)).tolist()) for i in range(900)]
    rows += [(900 + i, centres[0].tolist()) for i in range(450)]
    rows += [(5000, None), (5050, []), (5100, [float("nan")] * 8), (5150, [1.0, None] * 4), (None, [9.0] * 8), (5200, [float("inf")] * 8)]
    rows += [(5250, [0.5, 0.5]), (50, rows[3][1]), (7, [3.0] * 8), (7, [3.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit("x")).withColumn("cell", F.lit(1))
    expected = best_by_force([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5)
    got = topk_search.top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(x) for x in got) == expected


@pytest.mark.parametrize("size", [30000.0, 1e7, 3e9, 1e12])
def test_top_k_of_large_components(spark, size):
    """Ties of many equal vectors go to the smaller ids, also where a double can't hold a score."""
    rows = [(i, [size] * 8) for i in range(120)] + [(200 + i, [size] * 7 + [size - i]) for i in range(5)] + [(300, [1e300] + [0.0] * 7)]
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    score = min(8 * (256 * int(size)) ** 2, (1 << 63) - 1)
    expected = [(q, r, i, score) for q in (0, 50, 100, 200) for r, i in enumerate([i for i in range(6) if i != q][:5], 1)]
    assert sorted(tuple(x) for x in got) == expected


def test_top_k_sends_a_chunk_only_to_blocks_that_visit_it(spark, monkeypatch):
    """Many blocks of queries over far clusters: few vector rows are sent, and all results right."""
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 1)
    sent = []
    scored = topk_search.scored
    monkeypatch.setattr(topk_search, "scored", lambda chunks, *rest: sent.append(chunks.count()) or scored(chunks, *rest))
    r = np.random.default_rng(4)
    centres = r.normal(size=(30, 6)) * 40
    rows = [(i, (centres[i % 30] + r.normal(size=6) * 0.1).tolist()) for i in range(1500)]
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(x) for x in got) == best_by_force(rows, 5)
    assert sum(sent) < 0.5 * 30 * len(rows)  # of 30 blocks times all rows


def test_top_k_with_few_or_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id bigint, embedding array<double>")
    got = topk_search.top_k(few, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(x) for x in got) == [(0, 1, 1, 256 * 512), (0, 2, 2, -256 * 256)]
    assert topk_search.top_k(few.limit(0), F.lit(True)).count() == 0
    assert topk_search.top_k(few.limit(1), F.lit(True)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    found = queries.queries()[name](spark, SF_MID).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_MID}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    expected = con.execute(queries.oracle_sql()[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = lambda x: sorted(map(repr, x[columns].astype(object).where(x[columns].notna(), None).itertuples(index=False, name=None)))
    assert rows(found) == rows(expected)


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in queries.queries()} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = docs.columns
    before = {x["doc_id"]: x["text"] for x in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == given
        after = [x["doc_id"] for x in out.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= set(before)
        assert len(after) >= 0.85 * len(before)
        docs, before = out, dict.fromkeys(after)
    assert docs.where("NOT round_trip").count() == 0


def as_documents(spark, rows):
    """Documents from (doc_id, text), with a column of each name that the stages use themselves."""
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars")
    return frame.withColumn("removed_lines", F.lit("mine")).withColumn("kept", F.lit("mine"))


def kept_texts(out):
    return sorted(((x["doc_id"], x["text"]) for x in out.collect()), key=repr)


def test_near_copies_stage_against_brute_force(spark):
    """All documents of sf0.001, some without their id, repeated, or with two texts for one id."""
    given = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = given + given[:3] + [(None, t) for _, t in given[3:6]] + [(given[6][0], given[7][1]), (given[8][0], "one more text of its own here")]
    docs = as_documents(spark, rows)
    groups = groups_by_force([(i, t) for i, (_, t) in enumerate(rows)], 5)
    first = {}
    for i, (n, group) in groups.items():
        key = (rows[i][0] is None, rows[i][0] or 0)
        if n and (group not in first or key < first[group][0]):
            first[group] = (key, i)
    expected = sorted((rows[i] for i, (n, g) in groups.items() if not n or first[g][1] == i), key=repr)
    out = corpus_pipeline.near_copies(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    got = kept_texts(out)
    # Of rows with equal ids in one group any one stays.
    assert [i for i, _ in got] == [i for i, _ in expected] and set(got) <= set(rows) and len(got) < len(given)


def test_decontamination_stage_against_brute_force(spark):
    given = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [shingles(x["text"], 5) for x in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    dirty = lambda t: any(s and len(s & shingles(t, 5)) >= 0.8 * len(s) for s in items)
    hit = [(i, t) for i, t in given if dirty(t)]
    clean = next((i, t) for i, t in given if not dirty(t))
    rows = given + [(None, hit[0][1]), (clean[0], hit[1][1]), hit[2], (None, None)]
    out = corpus_pipeline.benchmark(spark, as_documents(spark, rows), SF_SMALL)
    assert len(hit) > 2 and kept_texts(out) == sorted((x for x in rows if not dirty(x[1])), key=repr)


def test_line_stage_with_a_column_of_its_count(spark):
    text = "alpha beta gamma delta epsilon zeta"
    docs = as_documents(spark, [(1, text), (2, f"{text}\nsomething else of one line here"), (3, text)])
    out = corpus_pipeline.lines(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert kept_texts(out) == [(1, text), (2, "something else of one line here")]
    with pytest.raises(ValueError, match="removed_lines"):
        deduplicate_lines(docs)


def test_sentencepiece_stage_against_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {x["doc_id"]: x["text"] or "" for x in docs.collect()}
    for x in corpus_pipeline.pieces(spark, docs, SF_SMALL).collect():
        assert list(x["ids"]) == library.encode(texts[x["doc_id"]])


def test_line_stage_pairs_few_lines_that_share_a_passage(spark, monkeypatch):
    pairs, _candidates = [], line_dedup._candidates

    def counted(*args, **kwargs):
        pairs.append((found := _candidates(*args, **kwargs)).count())
        return found

    monkeypatch.setattr(line_dedup, "_candidates", counted)
    texts = [f"head{i // 8} a b c d e f g h i j tail{i % 8}" for i in range(64)]
    docs = as_documents(spark, list(enumerate(texts)))
    assert corpus_pipeline.lines(spark, docs, SF_SMALL).count() == 64  # none is similar to another
    assert len(pairs) == 2 and sum(pairs) < 64


def test_pipeline_stages_with_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "x y z" * 5000, None, None, 5), (3, "x y z" * 5000, None, None, 5)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, SF_SMALL).count() <= len(rows), name
