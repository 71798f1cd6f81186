"""Growth of the latest balance against four past days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.functions.scalars import percent_change, period_anchors
from satlake.operators.ranking import with_rank
from satlake.operators.star import DESCRIPTION, describe
from satlake.plans.supplies import recent_pegged_balances
from satlake.schemas import BALANCE


def _anchor(cat: Catalog, index: int):
    return F.element_at(period_anchors(cat.as_of_column), index + 1)


def past_balances(cat: Catalog) -> DataFrame:
    """Balances on the four comparison days, tagged with their period.

    The four days are constants of the plan, so the filter reaches the scan
    and leaves out the other months.
    """
    day = F.col("date")
    anchors = [_anchor(cat, i) for i in range(4)]
    period = F.lit(None).cast("string")
    for anchor in reversed(anchors):
        period = F.when(day == anchor["date"], anchor["period"]).otherwise(period)
    return cat.on_days("token_balances", [a["date"] for a in anchors]).select(
        "token_implementation", F.col("balance").alias("past_balance"), period.alias("period")
    )


def top_gainers_by_tokenimpl(cat: Catalog) -> DataFrame:
    """Percent change per implementation and period, ranked within the period.

    An implementation without any past row appears once, with no period and
    no change.
    """
    recent = recent_pegged_balances(cat).drop("parent").withColumnRenamed("balance", "recent_balance")
    changes = recent.join(past_balances(cat), "token_implementation", "left").withColumn(
        "percent_change", percent_change(F.col("recent_balance"), F.col("past_balance"))
    )
    # At most one past row per implementation and period (the key is unique).
    ranked = with_rank(
        describe(cat, changes),
        "percent_change",
        within=["period"],
        max_group_rows=cat.implementation_rows,
    )
    return ranked.select(
        "token_implementation",
        "recent_balance",
        "past_balance",
        "percent_change",
        "period",
        "date",
        *DESCRIPTION,
        "rank",
    )


def implementation_periods(cat: Catalog) -> DataFrame:
    """Every implementation with each of the four comparison days.

    The periods are a four-element array literal, exploded in place: no join.
    """
    return cat.token_implementations.select(
        F.col("slug").alias("token_implementation"),
        F.inline(period_anchors(cat.as_of_column)),
    )


def top_gainers_by_tokenimpl_absolute(cat: Catalog) -> DataFrame:
    """Absolute change per implementation for all four periods; a missing past is 0."""
    zero = F.lit(0).cast(BALANCE)
    # Only implementations with a balance can appear, so the periods go to them.
    recent = recent_pegged_balances(cat).select(
        "token_implementation",
        F.col("balance").alias("recent_balance"),
        "date",
        F.inline(period_anchors(cat.as_of_column)).alias("period", "past_date"),
    )
    changes = recent.join(past_balances(cat), ["token_implementation", "period"], "left").withColumn(
        "supply_change",
        (F.col("recent_balance") - F.coalesce("past_balance", zero)).cast("decimal(38,8)"),
    )
    ranked = with_rank(
        describe(cat, changes),
        "supply_change",
        within=["period"],
        max_group_rows=cat.implementation_rows,
    )
    return ranked.select(
        "token_implementation",
        "recent_balance",
        F.coalesce("past_balance", zero).alias("past_balance"),
        "supply_change",
        "period",
        "date",
        *DESCRIPTION,
        "rank",
    )
