"""The queries of this package: token ids, containers and sentence units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.packing import mixture, packed
from fleetspan.llm.sentences import sentence_units
from fleetspan.llm.tokens import token_counts, token_ids
from fleetspan.session import table
from fleetspan.sources.lineage import materialised


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return token_ids(table(spark, d, "documents"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    """Documents in containers of 2,048 tokens."""
    return packed(materialised(token_counts(table(spark, d, "documents"), also=("source",))))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the sources in each window of containers."""
    m = mixture(p9_containers(spark, d))
    return m.select("window_id", "source", "tokens", F.round("share", 6).alias("share"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Sentence units of every document."""
    return sentence_units(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p8_ids, p9_containers, p9_mixture, p10_found)}


def oracle_sql() -> dict[str, str]:
    """None: tokenization, packing and segmentation are no SQL; tests hold them against whole-text encoding, invariants and brute force."""
    return {}
