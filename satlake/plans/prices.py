"""Price view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.operators.latest import row_number_latest


def current_prices(cat: Catalog) -> DataFrame:
    """Latest price per token.

    Spark limits each map task to one row per token before the shuffle.
    """
    latest = row_number_latest(
        cat.price.select("token_slug", "token_name", "price_usd", "date"), "token_slug", "date"
    )
    return latest.select(
        "token_slug", "token_name", "price_usd", F.col("date").alias("most_recent_date")
    )
