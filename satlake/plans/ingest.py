"""From landed polls to balance tables: decode, reject, settle the day, upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.operators.upsert import upsert_reserve_balances
from satlake.plans.decode import (
    as_observations,
    decode_observations,
    decode_reserves,
    quarantined,
    valid_balances,
)
from satlake.session import work_path
from satlake.sources.source_config import RESERVE_NETWORKS
from satlake.sources.tables import Folder, Landed, upsert_months
from satlake.streaming.daily import drain, finalize_day, write_daily_values


def _kept(df: DataFrame, dead_path: str) -> DataFrame:
    """Written once, in place of the batch before, so that valid and rejected rows come from one decoding."""
    path = f"{work_path(df.sparkSession, dead_path)}/decoded"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest_polls(
    cat: Catalog,
    observations: DataFrame,
    config: DataFrame,
    values_path: str,
    balances_path: str,
    dead_path: str,
    created_at: Column,
    batch: str = "0",
    objects: DataFrame | None = None,
    follow: Sequence[Callable[[Landed], None]] = (),
) -> None:
    """One batch of token polls into the daily values and the balances; rejects go to ``dead_path``.

    Repeating a batch changes nothing: its rejects take the same folder again.
    ``objects`` are the polled second places of coins, ``follow`` the steps
    that keep further tables up to date (``maintain.followers``).
    """
    decoded = _kept(decode_observations(cat, observations, config, objects=objects), dead_path)
    quarantined(decoded).write.mode("overwrite").parquet(f"{dead_path}/batch={batch}")
    write = write_daily_values(cat.spark, values_path, balances_path, created_at, follow)
    write(finalize_day(valid_balances(decoded)), 0)


def stream_polls(
    cat: Catalog,
    observations: DataFrame,
    config: DataFrame,
    values_path: str,
    balances_path: str,
    dead_path: str,
    checkpoint: str,
    created_at: Column,
    objects: Callable[[], DataFrame] | None = None,
    follow: Sequence[Callable[[Landed], None]] = (),
) -> None:
    """The same for a stream of landed polls, batch by batch.

    ``objects`` is called per batch: the objects are polled as often as the
    coins, and a batch sees what has landed of them when it runs.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        second = None if objects is None else objects()
        ingest_polls(
            cat, batch, config, values_path, balances_path, dead_path, created_at, str(epoch), second, follow
        )

    drain(observations.writeStream.foreachBatch(write), checkpoint)


def replay_dead_letters(
    cat: Catalog,
    config: DataFrame,
    values_path: str,
    balances_path: str,
    dead_path: str,
    created_at: Column,
    objects: DataFrame | None = None,
    follow: Sequence[Callable[[Landed], None]] = (),
) -> None:
    """Take rejected polls through the normal path again, by the rules and implementations as they are now.

    The balances become what they would be had the polls been valid at first:
    days are settled by poll order, not by arrival.  What is rejected again
    stays, once, with its present reason.  The old letters go last, so a run
    that was cut off is repeated without harm.  Not to be run while polls of the
    same dead-letter folder are taken in.
    """
    folder = Folder(cat.spark, dead_path)
    batches = sorted(n for n in folder.names() if n.startswith("batch=") and folder.holds(f"{n}/_SUCCESS"))
    if not batches:
        return
    letters = cat.spark.read.parquet(*[f"{dead_path}/{n}" for n in batches])
    again = f"replay-{uuid.uuid4().hex[:12]}"
    polls = as_observations(letters)
    ingest_polls(cat, polls, config, values_path, balances_path, dead_path, created_at, again, objects, follow)
    for name in batches:
        folder.drop(name)


def ingest_reserves(
    cat: Catalog,
    observations: DataFrame,
    balances_path: str,
    dead_path: str,
    created_at: Column,
    batch: str = "0",
    networks: Sequence[str] = RESERVE_NETWORKS,
    follow: Sequence[Callable[[Landed], None]] = (),
) -> None:
    """One batch of reserve polls (seq, reserve_implementation_id, date, payload, status).

    Only reserves on networks that report them are taken.
    """
    decoded = decode_reserves(cat, observations)
    reported = F.col("reserve_network").isin(*networks)
    reason = F.coalesce("reason", F.when(~reported, F.lit("unsupported_network")))
    decoded = _kept(decoded.withColumn("reason", reason), dead_path)
    rejected = decoded.where(F.col("reason").isNotNull()).select(
        "seq", "reserve_implementation_id", "date", "status", "payload", "reason"
    )
    rejected.write.mode("overwrite").parquet(f"{dead_path}/batch={batch}")
    rows = decoded.where(F.col("reason").isNull()).select(
        "date",
        "balance",
        "reserve_implementation_id",
        "reserve_network",
        "collateral_token",
        "derivative_token",
        "reserve_address",
        "seq",
    )

    def merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
        return upsert_reserve_balances(existing, incoming, ["seq"], created_at)

    landed = upsert_months(cat.spark, balances_path, "reserve_balances", rows, merge)
    for step in follow if landed else ():
        step(landed)
