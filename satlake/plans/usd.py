"""Supplies in US dollars: an as-of join with the prices, filled forward.

A price holds from its day until the day before the token's next price.  Each
such interval is dealt to the months that it covers, so that supplies and
prices meet by equality of token and month and only the intervals of one
month, at most one per day, are compared by range.  A token's last price has
no end; it is met by equality of the token alone, one row per token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.catalog import Catalog
from satlake.operators.adjust import adjusted_history
from satlake.operators.star import described_implementations
from satlake.plans.supplies import current_supplies_unranked
from satlake.schemas import TOTAL

USD = "decimal(38,8)"
# Supplies of up to 16 digits before the point: their product with a price keeps 11 places, of which 8 are shown.
AMOUNT = "decimal(24,8)"


def price_intervals(prices: DataFrame, delay_days: int = 0) -> DataFrame:
    """(priced_slug, price_usd, from_day, until_day): each price with the days that it holds.

    ``until_day`` is the first day on which it holds no more, NULL for the last
    price.  ``delay_days`` is how long after its date a price is known.  Rows
    without a token, date or price say nothing; of several rows of a day the
    one of the greatest id counts.
    """
    known = prices.where("token_slug is not null and date is not null and price_usd is not null")
    # One row per token and day reaches the sort.
    daily = known.groupBy(F.col("token_slug").alias("priced_slug"), "date").agg(
        F.max_by("price_usd", "id").alias("price_usd")
    )
    following = F.lead("date").over(Window.partitionBy("priced_slug").orderBy("date"))
    return daily.select(
        "priced_slug",
        "price_usd",
        F.date_add("date", delay_days).alias("from_day"),
        F.date_add(following, delay_days).alias("until_day"),
    )


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def with_price(rows: DataFrame, slug: str, day: str, intervals: DataFrame) -> DataFrame:
    """``rows`` with price_usd and price_date: the price of ``slug`` that holds on ``day``, else NULL.

    Every row stays, once.  Rows without a slug or day have no price.
    """
    ended = intervals.where("until_day is not null").select(
        "priced_slug",
        "from_day",
        "until_day",
        F.col("price_usd").alias("held_price"),
        F.explode(
            F.sequence(_month(F.col("from_day")), _month(F.date_sub("until_day", 1)), F.expr("interval 1 month"))
        ).alias("priced_month"),
    )
    last = intervals.where("until_day is null").select(
        F.col("priced_slug").alias("last_slug"),
        F.col("from_day").alias("last_from"),
        F.col("price_usd").alias("last_price"),
    )
    met = rows.join(
        ended,
        (F.col(slug) == F.col("priced_slug"))
        & (_month(F.col(day)) == F.col("priced_month"))
        & (F.col(day) >= F.col("from_day"))
        & (F.col(day) < F.col("until_day")),
        "left",
    ).join(last, (F.col(slug) == F.col("last_slug")) & (F.col(day) >= F.col("last_from")), "left")
    return met.select(
        *rows.columns,
        F.coalesce("last_price", "held_price").alias("price_usd"),
        F.coalesce("last_from", "from_day").alias("price_date"),
    )


def _usd(amount: str) -> Column:
    return F.round(F.col(amount).cast(AMOUNT) * F.col("price_usd"), 8).cast(USD)


def _described_slug(cat: Catalog, slug: str) -> DataFrame:
    """Implementations with the token column that the price table's slugs belong to."""
    if slug not in ("slug", "token_slug"):
        raise ValueError("prices are kept under a token's slug or token_slug")
    names = cat.tokens.select(F.col("slug").alias("token"), F.col(slug).alias("price_slug"))
    return cat.token_implementations.select(F.col("slug").alias("token_implementation"), "token").join(
        cat.small(names, "tokens"), "token"
    )


def current_supply_usd(cat: Catalog, slug: str = "token_slug", delay_days: int = 0) -> DataFrame:
    """Current adjusted supply per implementation in dollars of ``as_of``, with the price's day.

    A price older than the supply is as good as any later one that is missing.
    """
    rows = current_supplies_unranked(cat).select(
        "token_implementation", "network_slug", F.col("token_slug").alias("token"), "balance", "date"
    )
    named = rows.join(
        cat.per_implementation(_described_slug(cat, slug).drop("token")), "token_implementation"
    ).withColumn("valued_on", cat.as_of_column)
    priced = with_price(named, "price_slug", "valued_on", price_intervals(cat.price, delay_days))
    return priced.select(
        "token_implementation",
        "network_slug",
        F.col("token").alias("token_slug"),
        "balance",
        "date",
        "price_usd",
        "price_date",
        _usd("balance").alias("supply_usd"),
    )


def historical_supply_usd(cat: Catalog, slug: str = "token_slug", delay_days: int = 0) -> DataFrame:
    """Adjusted supply per date and token in dollars of that date.

    The supplies are summed before they meet the prices, so the as-of join has
    one row per date and token, however many networks a token is on.  Tokens
    that lost their peg, or whose peg is unknown, are left out.
    """
    dim = described_implementations(cat).where(F.col("depegged") == F.lit(False))
    dim = dim.select("token_implementation", F.col("token_slug").alias("token")).join(
        cat.per_implementation(_described_slug(cat, slug).drop("token")), "token_implementation"
    )
    totals = (
        adjusted_history(cat, only=dim)
        .join(cat.per_implementation(dim), "token_implementation")
        .groupBy("date", "token", "price_slug")
        .agg(F.sum("balance").cast(TOTAL).alias("total_balance"))
    )
    priced = with_price(totals, "price_slug", "date", price_intervals(cat.price, delay_days))
    return priced.select(
        "date",
        F.col("token").alias("token_slug"),
        "total_balance",
        "price_usd",
        "price_date",
        _usd("total_balance").alias("supply_usd"),
    )
