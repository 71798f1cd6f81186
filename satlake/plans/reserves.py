"""Reserve views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.operators.adjust import bridge_edges, children_totals, subtract_children
from satlake.operators.latest import latest_with_ties
from satlake.operators.ranking import with_rank
from satlake.operators.star import DESCRIPTION, describe
from satlake.plans.supplies import raw_supplies_unranked
from satlake.schemas import TOTAL

_GROUP = ("date", "reserve_network", "collateral_token", "derivative_token")


def _summed(balances: DataFrame) -> DataFrame:
    return (
        balances.groupBy(*_GROUP)
        .agg(F.sum("balance").cast(TOTAL).alias("total_balance"))
        .select("date", "derivative_token", "total_balance", "collateral_token")
    )


def helper_reserves_summed(cat: Catalog) -> DataFrame:
    """Reserves summed over addresses; the network is grouped by but not shown."""
    return _summed(cat.reserve_balances)


def recent_reserves(cat: Catalog) -> DataFrame:
    """All summed rows of each derivative token's latest date.

    The latest date is found on the raw rows, so only rows of that date are
    summed instead of the whole history.
    """
    rows = cat.recent_rows("reserve_balances", "derivative_token").select(*_GROUP, "balance")
    latest = latest_with_ties(rows, "derivative_token", "date", cat.per_implementation)
    return _summed(latest).select(
        F.col("derivative_token").alias("token_implementation"),
        F.col("total_balance").alias("balance"),
        "date",
    )


def adjusted_reserves(cat: Catalog, collapse: bool = False) -> DataFrame:
    """Latest reserves per implementation minus the children's latest reserves.

    An implementation has one row per reserve network and collateral, and the
    whole adjustment is subtracted from each.  ``collapse=True`` sums those
    rows per implementation and date first.
    """
    recent = recent_reserves(cat)
    if collapse:
        recent = recent.groupBy("token_implementation", "date").agg(
            F.sum("balance").cast(TOTAL).alias("balance")
        ).select("token_implementation", "balance", "date")
    edges = cat.per_implementation(bridge_edges(cat))
    totals = cat.per_implementation(children_totals(recent, edges))
    return subtract_children(recent, totals, ["token_implementation"], TOTAL)


def _rows_bound(cat: Catalog) -> int:
    """Latest rows: one per implementation, or per reserve where it has several."""
    return cat.implementation_rows + cat.dimension_rows("reserve_implementations")


def current_reserves_by_tokenimpl(cat: Catalog, collapse: bool = False) -> DataFrame:
    rows = describe(cat, adjusted_reserves(cat, collapse))
    ranked = with_rank(rows, "balance", max_group_rows=_rows_bound(cat))
    return ranked.select("token_implementation", "balance", "date", *DESCRIPTION, "rank")


def current_by_tokenimpl(cat: Catalog, collapse: bool = False) -> DataFrame:
    """Raw supply next to reserves; one row per reserve row where there are several."""
    supply = raw_supplies_unranked(cat).withColumnsRenamed(
        {"balance": "supply_balance", "date": "supply_date"}
    )
    # The described implementations are joined on the supply side already.
    reserve = adjusted_reserves(cat, collapse).select(
        "token_implementation",
        F.col("balance").alias("reserve_balance"),
        F.col("date").alias("reserve_date"),
    )
    backed = F.coalesce("reserve_balance", F.lit(0).cast(TOTAL))
    rows = supply.join(reserve, "token_implementation", "left").select(
        "token_implementation",
        "supply_balance",
        "reserve_balance",
        (F.col("supply_balance").cast(TOTAL) - backed).cast(TOTAL).alias("balance_difference"),
        F.greatest("supply_date", "reserve_date").alias("latest_date"),
        *DESCRIPTION,
    )
    return with_rank(rows, "supply_balance", max_group_rows=_rows_bound(cat))
