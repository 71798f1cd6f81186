"""Keyed upserts: a conflict changes the balance and keeps the first row's other columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.schemas import BALANCE, RESERVE_KEY, TOKEN_KEY


def last_per_key(incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the balance of the last row and the rest of the first one.

    That is what inserting the rows one by one in ``order`` would leave.
    """
    rest = [c for c in incoming.columns if c not in (*keys, *order, "balance")]
    # A single order column keeps the aggregation hash-based.
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    picks = [F.min_by(c, position).alias(c) for c in rest]
    return incoming.groupBy(*keys).agg(F.max_by("balance", position).alias("balance"), *picks)


def merge_rows(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    defaults: dict[str, Column],
) -> DataFrame:
    """The table after the upsert of ``incoming``.

    ``order`` tells the sequence of the incoming rows.  ``defaults`` fill the
    columns of rows that are new and lack them.  A row with a NULL key part
    conflicts with nothing and is appended.
    """
    keys = list(keys)
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()

    def shaped(df: DataFrame) -> DataFrame:
        columns = []
        for field in existing.schema:
            if field.name in df.columns:
                value = F.col(field.name)
            else:
                value = defaults.get(field.name, F.lit(None))
            if field.name == "balance":
                # A poll without a number is to be rejected before it gets here.
                value = F.coalesce(value, F.raise_error(F.lit("a balance to upsert is NULL")).cast(BALANCE))
            columns.append(value.cast(field.dataType).alias(field.name))
        return df.select(*columns)

    fresh = shaped(last_per_key(incoming.where(complete), keys, order))
    appended = shaped(incoming.where(~complete))

    renamed = fresh.select(
        *[F.col(c) if c in keys else F.col(c).alias(f"_new_{c}") for c in fresh.columns],
        F.lit(True).alias("_fresh"),
    )
    old = existing.where(complete).withColumn("_old", F.lit(True))
    merged = old.join(renamed, keys, "full_outer")
    columns = []
    for c in existing.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c == "balance":
            columns.append(F.when(F.col("_fresh"), F.col("_new_balance")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c))
    return merged.select(*columns).unionByName(existing.where(~complete)).unionByName(appended)


def upsert_token_balances(
    existing: DataFrame, incoming: DataFrame, order: Sequence[str], created_at: Column | None = None
) -> DataFrame:
    """Upsert on (token_implementation, date).

    A new row without an id gets a hash of its key: repeating a batch after a
    failure gives the same rows again.
    """
    defaults = {
        "created_at": F.current_timestamp() if created_at is None else created_at,
        "id": F.xxhash64(*TOKEN_KEY),
    }
    return merge_rows(existing, incoming, TOKEN_KEY, order, defaults)


def upsert_reserve_balances(
    existing: DataFrame, incoming: DataFrame, order: Sequence[str], created_at: Column | None = None
) -> DataFrame:
    """Upsert on the five-part reserve key; the first row's implementation id stays."""
    defaults = {"created_at": F.current_timestamp() if created_at is None else created_at}
    return merge_rows(existing, incoming, RESERVE_KEY, order, defaults)


def merge_by_order(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Daily values after more polls: per key the one of the greatest poll_order.

    The result does not depend on how the polls were cut into batches, how late
    a batch is or how often it is merged.
    """
    columns = existing.columns
    return (
        existing.unionByName(incoming.select(*columns))
        .groupBy(*TOKEN_KEY)
        .agg(F.max_by("balance", "poll_order").alias("balance"), F.max("poll_order").alias("poll_order"))
        .select(*columns)
    )
