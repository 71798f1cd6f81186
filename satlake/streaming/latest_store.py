"""Latest value per implementation in the state store of a stream.

The state holds one value per implementation.  A micro-batch updates the
implementations that it brings something newer for and hands on their rows;
nothing else is read or written, however many implementations there are.  The
stream's checkpoint is the table: ``read_latest`` reads the committed state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from satlake.schemas import schema

STATE = "best"
STATE_COLUMNS = "date DATE, poll_order DECIMAL(38,0), balance DECIMAL(20,8)"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


class LatestValue(StatefulProcessor):
    """Keeps the candidate of the greatest (date, poll_order); late and repeated ones change nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState(STATE, STATE_COLUMNS)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best = held = tuple(self.best.get()) if self.best.exists() else None
        for frame in rows:
            for found in zip(frame["date"], frame["poll_order"], frame["balance"]):
                if best is None or found[:2] > best[:2]:
                    best = found
        if best != held:
            self.best.update(best)
            date, order, balance = best
            yield pd.DataFrame(
                {"date": [date], "token_implementation": [key[0]], "balance": [balance], "poll_order": [order]}
            )

    def close(self) -> None:
        pass


def latest_changes(candidates: DataFrame) -> DataFrame:
    """Stream of the implementations whose latest value changed, with that value.

    Candidates lack neither day nor order; those without an implementation
    belong to nobody and are left out.
    """
    rows = candidates.select("token_implementation", "date", "poll_order", "balance").where(
        "token_implementation is not null and date is not null and poll_order is not null"
    )
    return rows.groupBy("token_implementation").transformWithStateInPandas(
        LatestValue(), schema("daily_values"), "Update", "None"
    )


def stream_latest(
    candidates: DataFrame, checkpoint: str, on_change: Callable[[DataFrame, int], None] | None = None
) -> None:
    """Drain candidates into the state below ``checkpoint``; ``on_change`` gets the changed rows of each batch."""
    spark = candidates.sparkSession
    before = spark.conf.get(_PROVIDER_KEY, None)
    spark.conf.set(_PROVIDER_KEY, PROVIDER)
    try:
        writer = latest_changes(candidates).writeStream.outputMode("update")
        writer = writer.format("noop") if on_change is None else writer.foreachBatch(on_change)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(_PROVIDER_KEY) if before is None else spark.conf.set(_PROVIDER_KEY, before)
    query.awaitTermination()


def read_latest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The latest values as of the last committed batch, in the columns of daily values."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return state.select(
        F.col("value.date").alias("date"),
        F.col("key.token_implementation").alias("token_implementation"),
        F.col("value.balance").alias("balance"),
        F.col("value.poll_order").alias("poll_order"),
    )
