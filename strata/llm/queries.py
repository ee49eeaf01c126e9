"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    conversations,
    decontaminate,
    fill_middle,
    html_extract,
    language,
    license_scan,
    line_dedup,
    near_dup,
    packing,
    quality,
    secret_scan,
    token_files,
    vector_dedup,
)
from strata.llm.session import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": lambda spark, d: quality.op1_quality_classifier(documents(spark, d)),
    "op2_lattice_near_dedup": lambda spark, d: vector_dedup.op2_lattice_near_dedup(table(spark, d, "embeddings")),
    "op3_line_dedup": lambda spark, d: line_dedup.op3_line_dedup(documents(spark, d)),
    "op4_language_id": lambda spark, d: language.op4_language_id(documents(spark, d)),
    "op5_html_extract": lambda spark, d: html_extract.op5_html_extract(table(spark, d, "pages")),
    "op6_best_fit_packing": lambda spark, d: packing.op6_best_fit_packing(documents(spark, d)),
    "op7_secret_scan": lambda spark, d: secret_scan.op7_secret_scan(documents(spark, d)),
    "op8_license_scan": lambda spark, d: license_scan.op8_license_scan(documents(spark, d)),
    "op9_minhash_near_dedup": lambda spark, d: near_dup.op9_minhash_near_dedup(documents(spark, d)),
    "op10_decontaminate": lambda spark, d: decontaminate.op10_decontaminate(documents(spark, d), table(spark, d, "benchmark")),
    "op11_fill_in_middle": lambda spark, d: fill_middle.op11_fill_in_middle(documents(spark, d)),
    "op12_token_files": lambda spark, d: token_files.op12_token_files(documents(spark, d)),
    "op13_conversation_repair": lambda spark, d: conversations.op13_conversation_repair(table(spark, d, "conversations")),
}

#: DuckDB SQL where SQL can express the whole result; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_lattice_near_dedup": vector_dedup.ORACLE_SQL,
    "op3_line_dedup": line_dedup.ORACLE_SQL,
    "op10_decontaminate": decontaminate.ORACLE_SQL,
    "op11_fill_in_middle": fill_middle.ORACLE_SQL,
}
