"""Latest row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Keys share this many lower bounds, so that the bounds always fit a broadcast.
BOUNDS = 131_072


def latest_by(df: DataFrame, key: str, order: str, *carried: str) -> DataFrame:
    """One row per non-NULL key: ``order`` and ``carried`` of its latest row.

    Needs (key, order) to be unique.  max_by keeps one candidate per key and
    map task, so a hot key costs one row per task in the shuffle and no sort.
    """
    picks = [F.max_by(c, order).alias(c) for c in carried]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*picks, F.max(order).alias(order))


def latest_with_ties(
    df: DataFrame, key: str, order: str, small: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Every row that carries its key's greatest ``order`` value.

    The maxima are aggregated before the shuffle.  ``small`` may mark them for
    broadcast, so that old rows are dropped where they are read; otherwise the
    rows that can be the latest are joined on (key, order), over which the rows
    of a hot key spread.
    """
    tops = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias(order))
    if small is not None:
        return df.join(small(tops), [key, order], "inner")
    return _since_lowest_top(df, tops, key, order).join(tops, [key, order], "inner")


def _since_lowest_top(df: DataFrame, tops: DataFrame, key: str, order: str) -> DataFrame:
    """Rows not older than the lowest maximum among the keys of their bucket, where they are read.

    However many keys there are, a bounded number of buckets is broadcast; all
    latest rows stay, most of the others do not reach the shuffle.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BOUNDS))
    lowest = tops.groupBy(bucket.alias("_bucket")).agg(F.min(order).alias("_lowest"))
    bounded = df.join(F.broadcast(lowest), bucket == F.col("_bucket"), "inner")
    return bounded.where(F.col(order) >= F.col("_lowest")).select(*df.columns)


def first_per_key(df: DataFrame, key: str, order: list[str], carried: list[str]) -> DataFrame:
    """The carried columns of the first row per key in ``order``."""
    row = F.min_by(F.struct(*carried), F.struct(*order)).alias("row")
    return df.groupBy(key).agg(row).select(key, "row.*")


def row_number_latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row-number form: also returns the group of rows whose key is NULL."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc_nulls_first()))
    return df.withColumn("rn", rn).where("rn = 1").drop("rn")
