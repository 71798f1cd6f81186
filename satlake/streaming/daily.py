"""Streaming daily values, upserts, block scans and latest state.

Each job drains what has landed (``availableNow``) and can be started again on
the same checkpoint: it goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.operators.blocks import STAKING_PREFIX, staking_outputs
from satlake.operators.upsert import merge_by_order, upsert_token_balances
from satlake.plans.decode import poll_order
from satlake.schemas import schema
from satlake.sources.tables import MONTH, Landed, read_table, upsert_months, write_monthly


def stream_observations(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed observations with observed_at as an event time."""
    reader = spark.readStream.schema(schema("observations"))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("observed_at", F.col("observed_at").cast("timestamp"))


def drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _candidates(observations: DataFrame, day: Column, is_final: Column) -> DataFrame:
    """Polls that have a number, as candidates for the value of a day."""
    order = poll_order(is_final, F.col("observed_at"), F.col("seq"))
    return observations.where(F.col("balance").isNotNull()).select(
        "token_implementation", day.alias("date"), "balance", order.alias("poll_order")
    )


def daily_last_value(observations: DataFrame) -> DataFrame:
    """Candidates for the last value of the UTC day of observation."""
    return _candidates(observations, F.col("observed_at").cast("date"), F.lit(False))


def finalize_day(observations: DataFrame) -> DataFrame:
    """Candidates for the value of the effective day, where a final poll beats the incremental ones.

    Which poll wins is settled by merging the candidates, so a poll may be any
    number of days late; none is dropped.
    """
    return _candidates(observations, F.col("effective_day"), F.col("is_final"))


def write_daily_values(
    spark: SparkSession,
    values_path: str,
    balances_path: str | None,
    created_at: Column,
    follow: Sequence[Callable[[Landed], None]] = (),
) -> Callable[[DataFrame, int], None]:
    """Batch writer: merge candidates into the daily values, then upsert the winners.

    No state is kept between batches other than the tables, and repeating a
    batch changes neither.  ``follow`` is called with the winners once they
    are in the balance table.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        best = batch.groupBy("token_implementation", "date").agg(
            F.max_by("balance", "poll_order").alias("balance"), F.max("poll_order").alias("poll_order")
        )
        landed = upsert_months(spark, values_path, "daily_values", best, merge_by_order)
        if balances_path is None or landed is None:
            return
        keys = [MONTH, "token_implementation", "date"]
        current = landed.touched(values_path, "daily_values")
        winners = current.join(landed.rows.select(*keys), keys, "left_semi")

        def merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
            return upsert_token_balances(existing, incoming, ["poll_order"], created_at)

        upserted = upsert_months(spark, balances_path, "token_balances", winners.drop(MONTH), merge)
        for step in follow if upserted else ():
            step(upserted)

    return write


def stream_daily_values(
    candidates: DataFrame,
    values_path: str,
    checkpoint: str,
    created_at: Column,
    balances_path: str | None = None,
    follow: Sequence[Callable[[Landed], None]] = (),
) -> None:
    """Run candidates into the daily values and, if given, into a balance table."""
    write = write_daily_values(candidates.sparkSession, values_path, balances_path, created_at, follow)
    drain(candidates.writeStream.outputMode("append").foreachBatch(write), checkpoint)


def stream_staking_outputs(
    blocks: DataFrame, path: str, checkpoint: str, prefix: str = STAKING_PREFIX
) -> None:
    """Append the staking outputs of newly landed blocks; finished files are not read again."""
    hits = staking_outputs(blocks, prefix)
    drain(hits.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)


def latest_state(values: DataFrame) -> DataFrame:
    """Latest daily value per implementation; of one day the one of the greatest poll_order."""
    last = F.struct("date", "poll_order")
    return values.groupBy("token_implementation").agg(
        F.max_by("balance", last).alias("balance"),
        F.max("date").alias("date"),
        F.max_by("poll_order", last).alias("poll_order"),
    )


def write_latest(spark: SparkSession, path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer: merge candidates into the table of latest rows, one per implementation.

    The table changes at once behind its pointer, so a reader never finds it
    missing; repeating a batch changes nothing.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.select("date", "token_implementation", "balance", "poll_order")
        merged = latest_state(read_table(spark, path, "daily_values").unionByName(rows))
        write_monthly(merged.select(*rows.columns), path, replace=True)

    return write


def stream_latest_state(values: DataFrame, path: str, checkpoint: str) -> None:
    """Keep a table of the latest rows of a stream of daily values or candidates."""
    write = write_latest(values.sparkSession, path)
    drain(values.writeStream.outputMode("append").foreachBatch(write), checkpoint)
