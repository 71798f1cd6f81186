"""Current and historical supply views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.functions.scalars import concat_skip_null, distinct_array
from satlake.operators.adjust import (
    adjusted_history,
    net_of_children,
    pegged_links,
)
from satlake.operators.latest import latest_by
from satlake.operators.ranking import with_rank
from satlake.operators.star import DESCRIPTION, describe, described_implementations
from satlake.schemas import LIQUID_STAKING, STAKING, TOTAL


def _recent_rows(cat: Catalog) -> DataFrame:
    return cat.recent_rows("token_balances", "token_implementation")


def recent_balances(cat: Catalog) -> DataFrame:
    """Latest raw balance per implementation, each at its own latest date."""
    return latest_by(_recent_rows(cat), "token_implementation", "date", "balance")


def recent_pegged_balances(cat: Catalog) -> DataFrame:
    """Latest raw balances, with the parent, of implementations whose token holds its peg.

    The peg filter goes below the aggregation: rows of other tokens are not
    shuffled.
    """
    links = cat.per_implementation(pegged_links(cat))
    facts = _recent_rows(cat).join(links, "token_implementation")
    # An implementation has one parent or none, so the parent splits no group.
    return facts.groupBy("token_implementation", "parent").agg(
        F.max_by("balance", "date").alias("balance"), F.max("date").alias("date")
    )


def raw_supplies_unranked(cat: Catalog) -> DataFrame:
    return describe(cat, recent_balances(cat))


def helper_current_supplies_raw(cat: Catalog) -> DataFrame:
    """Latest raw supply per implementation with its rank; no adjustment, no peg filter."""
    rows = raw_supplies_unranked(cat)
    ranked = with_rank(rows, "balance", max_group_rows=cat.implementation_rows)
    return ranked.select("token_implementation", "balance", "date", *DESCRIPTION, "rank")


def current_supplies_unranked(cat: Catalog) -> DataFrame:
    recent = recent_pegged_balances(cat).withColumn("keep_own", F.lit(True))
    return describe(cat, net_of_children(recent, [], ["date"]))


def current_supplies_by_tokenimpl(cat: Catalog) -> DataFrame:
    """Latest supply per implementation minus its children's own latest supplies."""
    rows = current_supplies_unranked(cat)
    ranked = with_rank(rows, "balance", max_group_rows=cat.implementation_rows)
    return ranked.select("token_implementation", "balance", "date", *DESCRIPTION, "rank")


def _current_totals(
    cat: Catalog, supplies: DataFrame, keys: list[str], arrays: dict[str, str]
) -> DataFrame:
    totals = supplies.groupBy(*keys).agg(
        F.sum("balance").cast(TOTAL).alias("total_balance"),
        F.max("date").alias("latest_date"),
        *[distinct_array(F.col(source)).alias(name) for name, source in arrays.items()],
    )
    return with_rank(totals, "total_balance", max_group_rows=cat.implementation_rows)


def current_supplies_by_network(cat: Catalog) -> DataFrame:
    return _current_totals(
        cat,
        current_supplies_unranked(cat),
        ["network_slug", "network_name"],
        {"tokens": "token_slug", "token_names": "token_name", "token_addresses": "token_address"},
    )


def current_supplies_by_tokenproject(cat: Catalog) -> DataFrame:
    return _current_totals(
        cat,
        current_supplies_unranked(cat),
        ["token_slug", "token_name"],
        {
            "networks": "network_slug",
            "network_names": "network_name",
            "token_addresses": "token_address",
        },
    )


def _historical_rows(cat: Catalog, type_filter: Column) -> DataFrame:
    kept = (F.col("depegged") == F.lit(False)) & type_filter
    dim = described_implementations(cat).where(kept)
    adjusted = adjusted_history(cat, only=dim)
    return adjusted.join(cat.per_implementation(dim), "token_implementation")


def historical_supplies_by_network(cat: Catalog) -> DataFrame:
    """Adjusted supply per date and network, without staking tokens."""
    return (
        _historical_rows(cat, F.col("token_type") != STAKING)
        .groupBy("date", "network_slug", "network_name")
        .agg(
            F.sum("balance").cast(TOTAL).alias("total_balance"),
            distinct_array(F.col("token_slug")).alias("tokens"),
            distinct_array(F.col("token_name")).alias("token_names"),
        )
        .select("network_slug", "network_name", "total_balance", "date", "tokens", "token_names")
    )


def _historical_by_token(cat: Catalog, type_filter: Column) -> DataFrame:
    totals = (
        _historical_rows(cat, type_filter)
        .groupBy("date", "token_slug", "token_name")
        .agg(
            F.sum("balance").cast(TOTAL).alias("total_balance"),
            distinct_array(F.col("network_slug")).alias("networks"),
            distinct_array(F.col("network_name")).alias("network_names"),
            distinct_array(F.col("token_address")).alias("token_addresses"),
        )
    )
    # A date has at most one row per token, fewer than implementations.
    ranked = with_rank(
        totals, "total_balance", within=["date"], max_group_rows=cat.implementation_rows
    )
    return ranked.select(
        "token_slug",
        "token_name",
        "total_balance",
        "date",
        "networks",
        "network_names",
        "token_addresses",
        "rank",
    )


def historical_supplies_by_tokenproject(cat: Catalog) -> DataFrame:
    """Adjusted supply per date and token without staking tokens or unknown types."""
    return _historical_by_token(cat, F.col("token_type") != STAKING)


def historical_supplies_by_staking(cat: Catalog) -> DataFrame:
    return _historical_by_token(cat, F.col("token_type") == STAKING)


def historical_supplies_by_liquidstaking(cat: Catalog) -> DataFrame:
    return _historical_by_token(cat, F.col("token_type") == LIQUID_STAKING)


def historical_supplies_by_tokenimpl(cat: Catalog) -> DataFrame:
    """Adjusted daily supply per implementation with the current network and token ranks.

    The peg filter makes implementation and token required; the network and
    both ranks may be missing.  The dimension side is joined up first, so the
    facts meet one small table.
    """
    supplies = current_supplies_unranked(cat)
    network_ranks = _current_totals(cat, supplies, ["network_slug", "network_name"], {}).select(
        "network_slug", F.col("rank").alias("network_rank")
    )
    project_ranks = _current_totals(cat, supplies, ["token_slug", "token_name"], {}).select(
        F.col("token_slug").alias("infra_slug"), F.col("rank").alias("project_rank")
    )
    networks = cat.networks.select(
        F.col("slug").alias("network_slug"), F.col("name").alias("network_name")
    )
    pegged = cat.tokens.where(F.col("depegged") == F.lit(False)).select(
        F.col("slug").alias("infra_slug"), F.col("name").alias("token_name")
    )
    impls = cat.token_implementations.select(
        F.col("slug").alias("token_implementation"), F.col("token").alias("infra_slug"), "network"
    )
    dim = (
        impls.join(cat.small(pegged, "tokens"), "infra_slug")
        .join(cat.small(networks, "networks"), F.col("network") == F.col("network_slug"), "left")
        .join(cat.small(network_ranks, "networks"), "network_slug", "left")
        .join(cat.small(project_ranks, "tokens"), "infra_slug", "left")
    )
    zero = F.lit(0).cast("bigint")
    return (
        adjusted_history(cat)
        .join(cat.per_implementation(dim), "token_implementation")
        .select(
            "network_name",
            "network_slug",
            "token_name",
            concat_skip_null(F.col("network_slug"), F.lit("_"), F.col("infra_slug")).alias("identifier"),
            F.col("balance").alias("amount"),
            "date",
            "infra_slug",
            F.coalesce("network_rank", zero).alias("network_rank"),
            F.coalesce("project_rank", zero).alias("project_rank"),
        )
    )
