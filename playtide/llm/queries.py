"""The registered queries of this subpackage, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtide.llm import chat, decontaminate, divergence, lines, merkle, neighbours, orc_tokens, packing, ppm, repair, simhash, toxicity, transducer
from playtide.session import configure

_QUERIES = (
    ppm.op1_lm_scoring, packing.op2_sharding, simhash.op3_simhash_near_dedup, divergence.op4_quality_rules, chat.op5_chat_formatting,
    transducer.op6_sentencepiece, lines.op7_line_dedup, decontaminate.op8_benchmark_decontamination, orc_tokens.op9_token_ids_orc,
    neighbours.op10_quality_classifier, toxicity.op11_toxicity, repair.op12_conversation_repair, merkle.op13_merkle_manifest,
)


def _configured(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(configure(spark), folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _configured(query) for query in _QUERIES}


def oracles() -> dict[str, str]:
    return {"op7_line_dedup": lines.OP7_SQL}
