"""The registered queries of the subpackage and their DuckDB SQL (where SQL can express one)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stagecraft.llm.decontaminate import DECONTAMINATION_SQL, decontamination_query
from stagecraft.llm.language_id import language_query
from stagecraft.llm.line_dedup import LINE_SQL, line_dedup_query
from stagecraft.llm.lm_scoring import lm_query
from stagecraft.llm.merkle import MERKLE_SQL, merkle_query
from stagecraft.llm.near_dedup import NEAR_SQL, near_dedup_query
from stagecraft.llm.personal_data import PERSONAL_DATA_SQL, personal_data_query
from stagecraft.llm.quality import quality_query
from stagecraft.llm.sentencepiece_fst import sentencepiece_query
from stagecraft.llm.token_output import token_query
from stagecraft.llm.topk_search import TOPK_SQL, topk_query
from stagecraft.llm.url_filter import URL_SQL, url_query
from stagecraft.llm.whitening import whitening_query

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_topk_search": topk_query,
    "op2_line_dedup": line_dedup_query,
    "op3_token_output": token_query,
    "op4_near_dedup": near_dedup_query,
    "op5_quality_classifier": quality_query,
    "op6_lm_scoring": lm_query,
    "op7_language_id": language_query,
    "op8_url_filter": url_query,
    "op9_sentencepiece": sentencepiece_query,
    "op10_decontamination": decontamination_query,
    "op11_whitening": whitening_query,
    "op12_personal_data": personal_data_query,
    "op13_merkle_manifest": merkle_query,
}

ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": TOPK_SQL,
    "op2_line_dedup": LINE_SQL,
    "op4_near_dedup": NEAR_SQL,
    "op8_url_filter": URL_SQL,
    "op10_decontamination": DECONTAMINATION_SQL,
    "op12_personal_data": PERSONAL_DATA_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
