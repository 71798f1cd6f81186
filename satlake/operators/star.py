"""Star joins of per-implementation rows with the three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog

# Descriptive columns that every per-implementation view ends with.
DESCRIPTION = (
    "network",
    "network_slug",
    "network_origin",
    "network_name",
    "token_slug",
    "token_name",
    "token_address",
    "explorer",
)


def described_implementations(cat: Catalog) -> DataFrame:
    """Implementation joined with its network and token; at most one row each."""
    impls = cat.token_implementations.select(
        F.col("slug").alias("token_implementation"),
        "network",
        "network_origin",
        F.col("token").alias("token_slug"),
        "token_address",
    )
    networks = cat.networks.select(
        F.col("slug").alias("network_slug"), F.col("name").alias("network_name"), "explorer"
    )
    tokens = cat.tokens.select(
        F.col("slug").alias("token_slug"),
        F.col("name").alias("token_name"),
        F.col("type").alias("token_type"),
        "depegged",
    )
    return impls.join(
        cat.small(networks, "networks"), impls["network"] == networks["network_slug"]
    ).join(cat.small(tokens, "tokens"), "token_slug")


def describe(cat: Catalog, facts: DataFrame) -> DataFrame:
    """Inner join of facts with the described implementations."""
    dim = cat.per_implementation(described_implementations(cat))
    return facts.join(dim, "token_implementation")
