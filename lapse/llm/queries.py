"""Queries and DuckDB texts of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lapse.llm import (decontamination, factorisation, importance, packing, quality, secrets, sharding, simhash,
                       substring, toxicity, urlfilter, warc, whitening)
from lapse.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_sharding": sharding.op1_sharding,
        "op2_decontamination": decontamination.op2_decontamination,
        "op3_substring_dedup": substring.op3_substring_dedup,
        "op4_warc": warc.op4_warc,
        "op5_simhash": simhash.op5_simhash,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_packing": packing.op8_packing,
        "op9_url_filters": urlfilter.op9_url_filters,
        "op10_secret_scan": secrets.op10_secret_scan,
        "op11_importance_resampling": importance.op11_importance_resampling,
        "op12_whitening": whitening.op12_whitening,
        "op13_quality_classifier": factorisation.op13_quality_classifier,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    """Of the others SQL has neither the hashes, the models, the components nor the packing."""
    return {
        "op2_decontamination": decontamination.OP2_SQL,
        "op3_substring_dedup": substring.OP3_SQL,
        "op4_warc": warc.OP4_SQL,
        "op9_url_filters": urlfilter.OP9_SQL,
        "op11_importance_resampling": importance.OP11_SQL,
    }
