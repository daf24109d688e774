"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.ann import nearest
from strata.llm.chat_format import chat_digests, with_probe
from strata.llm.common import table
from strata.llm.fingerprints import fingerprints
from strata.llm.license_scan import scan_licenses
from strata.llm.line_dedup import dedup_lines
from strata.llm.merkle import merkle_manifest
from strata.llm.mixing import mix_taken
from strata.llm.near_dedup import near_duplicates
from strata.llm.packing import pack
from strata.llm.pii import replace_pii
from strata.llm.secret_scan import scan_secrets
from strata.llm.toxicity import toxic_scores
from strata.llm.whitening import whitened


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    digest = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    return scan_secrets(table(spark, sf, "documents")).select(*digest)


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Per document its text without duplicate lines, and the dropped line numbers."""
    return dedup_lines(table(spark, sf, "documents")).select("doc_id", "n_lines", "dropped_lines", "text")


def op3_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints(table(spark, sf, "documents"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxic_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Per document its size, its source's size and target, the words taken, and
    the training position of its first copy (null if none is taken), both as the
    range-sorted mix holds them."""
    found = mix_taken(table(spark, sf, "documents"))
    return found.withColumn("first_position", F.round("first_position", 9))


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Per document its text with surrogates, and the kinds of what was found."""
    return replace_pii(table(spark, sf, "documents")).select("doc_id", "n_pii", "pii_kinds", "text")


def op8_ann(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "embeddings"))


def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Per document the licenses whose templates it contains, with their containment."""
    found = scan_licenses(table(spark, sf, "documents"))
    return found.select("doc_id", "n_windows", "matches")


def op11_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Per conversation, digests of its turns and of the text under the loss mask,
    read back from the formatted text."""
    return chat_digests(with_probe(table(spark, sf, "conversations")))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Per document its leaf, roots and proof, and whether the proof holds."""
    return merkle_manifest(table(spark, sf, "documents"))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Per usable vector and component its whitened value."""
    return whitened(table(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_mixing": op6_mixing,
    "op7_pii": op7_pii,
    "op8_ann": op8_ann,
    "op9_near_dedup": op9_near_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_chat_format": op11_chat_format,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_whitening": op13_whitening,
}
