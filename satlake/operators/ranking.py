"""SQL ``rank()`` in descending order that does not need all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.session import fresh_path

# Groups up to this many rows are ranked by a plain window in one task.
SINGLE_TASK_ROWS = 1_000_000


def with_rank(
    df: DataFrame,
    value: str,
    name: str = "rank",
    within: Sequence[str] = (),
    max_group_rows: int | None = None,
) -> DataFrame:
    """Add ``rank() over (partition by within order by value desc nulls first)``.

    ``max_group_rows`` is a proven bound of a group's rows; without one, or
    with a large one, the ranks are put together from counts per value.
    """
    if max_group_rows is not None and max_group_rows <= SINGLE_TASK_ROWS:
        w = Window.partitionBy(*within).orderBy(F.col(value).desc_nulls_first())
        return df.withColumn(name, F.rank().over(w).cast("bigint"))
    return rank_by_counts(df, value, name, within)


def rank_by_counts(
    df: DataFrame, value: str, name: str = "rank", within: Sequence[str] = ()
) -> DataFrame:
    """Rank from counts per distinct value, put together from ranges of values.

    The rows are written first, and both the counts and the result are made of
    what was written: the result is a snapshot, and rows that reach the input
    later cannot miss their counts.  Rows of one value are counted before the
    shuffle, so ties cannot make a task heavy.  The counts are dealt by ranges of the value, however narrow a
    band the values lie in, and fixed by a written table; a rank is the rows
    before it in its range plus those of the ranges before, of which there is
    one row per task.  The rows then join back on the value, where a value
    that fills much of the table is split by the run-time skew join.
    """
    within = list(within)
    spark = df.sparkSession
    order = [*[F.col(c).asc() for c in within], F.col(value).desc_nulls_first()]
    rows_path, path = fresh_path(spark, "rank-rows"), fresh_path(spark, "rank-counts")
    df.write.parquet(rows_path)
    df = spark.read.schema(df.schema).parquet(rows_path)
    (
        df.groupBy(*within, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .withColumn("_range", F.spark_partition_id())
        .write.parquet(path)
    )
    counts = spark.read.parquet(path)
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.groupBy(*within, "_range")
        .agg(F.sum("_n").alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .drop("_total")
    )
    inside = (
        Window.partitionBy(*within, "_range")
        .orderBy(F.col(value).desc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    positions = _join_null_safe(counts, starts, [*within, "_range"]).withColumn(name, before + 1)
    positions = positions.select(*within, value, F.col(name).cast("bigint").alias(name))
    return _join_null_safe(df, positions, [*within, value])


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, "inner").drop(*[f"_r_{k}" for k in keys])
