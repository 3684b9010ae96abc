"""The numbered queries over whole tables, and SQL for those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ebbtide.llm import (
    alignment, chat, decontamination, fingerprints, line_dedup, mixing, oracle, quality, resampling, secret_scan, simhash,
    token_output, toxicity, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_token_output": token_output.op2_token_output,
    "op3_secrets": secret_scan.op3_secrets,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_simhash": simhash.op6_simhash,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_chat": chat.op9_chat,
    "op10_warc": warc.op10_warc,
    "op11_resampling": resampling.op11_resampling,
    "op12_alignment": alignment.op12_alignment,
    "op13_quality": quality.op13_quality,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op7_decontamination": oracle.DECONTAMINATION,
    "op9_chat": oracle.CHAT,
    "op10_warc": oracle.WARC,
}
