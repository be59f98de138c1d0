"""Queries of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterhouse.llm import (
    bpe,
    decontaminate,
    fingerprints,
    licenses,
    merkle,
    negatives,
    pages,
    personal,
    quality,
    secrets,
    simhash,
    substrings,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": licenses.query,
    "op2_secret_scan": secrets.query,
    "op3_byte_bpe": bpe.query,
    "op4_html_text": pages.query,
    "op5_quality": quality.query,
    "op6_substring_dedup": substrings.query,
    "op7_decontaminate": decontaminate.query,
    "op8_fingerprints": fingerprints.query,
    "op9_simhash": simhash.query,
    "op10_toxicity": toxicity.query,
    "op11_personal_data": personal.query,
    "op12_hard_negatives": negatives.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLES: dict[str, str] = {
    "op6_substring_dedup": substrings.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
