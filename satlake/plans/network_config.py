"""Per-network configuration: its tokens and its reserves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.sources.source_config import BASE_CHAIN, BASE_CHAIN_BACKED


def scan_impl_by_network(cat: Catalog, network: str) -> DataFrame:
    """Implementations of one network; the filter and the columns reach the scan."""
    return cat.token_implementations.where(F.col("network") == network).select(
        "slug", "token_address", "token_decimals", "reserve_implementations"
    )


def backed_reserves(
    cat: Catalog, network: str = BASE_CHAIN, derivatives: Sequence[str] = (BASE_CHAIN_BACKED,)
) -> DataFrame:
    """Reserve addresses on one network that back the listed tokens."""
    chosen = (F.col("reserve_network") == network) & F.col("derivative_token").isin(*derivatives)
    return cat.reserve_implementations.where(chosen).select("derivative_token", "reserve_address")


def _token_refs(cat: Catalog) -> DataFrame:
    ref = F.struct(
        "slug", F.col("token_address").alias("address"), F.col("token_decimals").alias("decimals")
    )
    return cat.token_implementations.select("network", "slug", ref.alias("ref"))


def network_tokens(cat: Catalog) -> DataFrame:
    """(network, slug, address, decimals), one row per implementation."""
    return _token_refs(cat).select("network", "ref.*")


def network_reserves(cat: Catalog) -> DataFrame:
    """(network, id, tag, slug, address, collateral_token{…}, derivative_token{…}) per reserve.

    A reserve belongs to its reserve network; a token that is unknown is NULL.
    """

    def side(name: str) -> DataFrame:
        refs = _token_refs(cat).select(F.col("slug").alias(name), F.col("ref").alias(f"{name}_ref"))
        return cat.per_implementation(refs)

    return (
        cat.reserve_implementations.join(side("collateral_token"), "collateral_token", "left")
        .join(side("derivative_token"), "derivative_token", "left")
        .select(
            F.col("reserve_network").alias("network"),
            "id",
            "tag",
            "slug",
            F.col("reserve_address").alias("address"),
            F.col("collateral_token_ref").alias("collateral_token"),
            F.col("derivative_token_ref").alias("derivative_token"),
        )
    )


def network_config(cat: Catalog) -> DataFrame:
    """(network, token{…}, reserve{…}): the entries of all networks' documents, one per row.

    Each row has a token or a reserve.  Rows are not gathered per network, so
    a network may have any number of them.
    """

    def entries(rows: DataFrame, name: str) -> DataFrame:
        entry = F.struct(*[c for c in rows.columns if c != "network"]).alias(name)
        return rows.select("network", entry)

    tokens, held = entries(network_tokens(cat), "token"), entries(network_reserves(cat), "reserve")
    return tokens.unionByName(held, allowMissingColumns=True)
