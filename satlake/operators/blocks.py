"""Staking outputs in nested block data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.catalog import counted
from satlake.functions.scalars import iso_from_epoch
from satlake.operators.latest import first_per_key

# Fixed value: start of the script that marks a staking output.
STAKING_PREFIX = "6a4762626e31"

HIT_COLUMNS = ("block_height", "block_hash", "txid", "value", "script_hex", "timestamp")


def _outputs(blocks: DataFrame) -> DataFrame:
    """One row per output; blocks are unnested where they are read, without a shuffle."""
    transactions = blocks.select(
        F.col("height").alias("block_height"),
        F.col("hash").alias("block_hash"),
        "time",
        F.posexplode("tx").alias("tx_index", "tx"),
    )
    return transactions.select(
        "block_height",
        "block_hash",
        "time",
        "tx_index",
        F.col("tx.txid").alias("txid"),
        F.try_element_at("tx.vout", F.lit(1))["value"].alias("first_value"),
        F.size("tx.vout").alias("outputs"),
        F.posexplode("tx.vout").alias("vout_index", "vout"),
    )


def staking_hits(blocks: DataFrame, prefix: str = STAKING_PREFIX) -> DataFrame:
    """Outputs whose script starts with the prefix, with their positions."""
    hex_text = F.col("vout.scriptPubKey.hex")
    return _outputs(blocks).where(hex_text.startswith(prefix)).select(
        "block_height",
        "block_hash",
        "txid",
        F.col("vout.value").alias("value"),
        hex_text.alias("script_hex"),
        iso_from_epoch(F.col("time")).alias("timestamp"),
        "tx_index",
        "vout_index",
        "first_value",
    )


def staking_outputs(blocks: DataFrame, prefix: str = STAKING_PREFIX) -> DataFrame:
    return staking_hits(blocks, prefix).select(*HIT_COLUMNS)


def prefix_table(spark: SparkSession, prefixes: Mapping[str, str]) -> DataFrame:
    """(prefix, project) of the script prefixes to look for; letters of hex texts are lower-case."""
    rows = [(prefix.lower(), project) for prefix, project in prefixes.items()]
    return spark.createDataFrame(rows, "prefix string, project string")


def staking_hits_by_prefix(blocks: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Outputs whose script starts with one of many prefixes, each with the longest that fits.

    One scan serves all prefixes: a script is cut to every length that occurs
    among them, and the cuts meet the prefixes by equality, so the work does
    not grow with the number of prefixes but with that of their lengths.  Only
    outputs that fit are shuffled.
    """
    # A script has few possible prefix lengths, whatever the number of prefixes.
    lengths = sorted(r[0] for r in prefixes.select(F.length("prefix")).distinct().collect() if r[0])
    outputs = _outputs(blocks)
    hex_text = F.col("vout.scriptPubKey.hex")
    cuts = F.array(*[F.substring(hex_text, 1, n) for n in lengths]).cast("array<string>")
    known = prefixes.where("prefix <> ''").groupBy("prefix").agg(F.min("project").alias("project"))
    fitting = outputs.withColumn("prefix", F.explode(F.array_distinct(cuts))).join(counted(known), "prefix")
    carried = [
        F.col("vout.value").alias("value"),
        hex_text.alias("script_hex"),
        iso_from_epoch(F.col("time")).alias("timestamp"),
        "first_value",
        "project",
        "prefix",
    ]
    place = ["block_height", "block_hash", "txid", "tx_index", "vout_index"]
    longest = F.max_by(F.struct(*carried), F.length("prefix")).alias("hit")
    return fitting.groupBy(*place).agg(longest).select(*place, "hit.*")


def staking_outputs_by_prefix(blocks: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The scan's columns with the prefix and its project."""
    return staking_hits_by_prefix(blocks, prefixes).select(*HIT_COLUMNS, "prefix", "project")


def distinct_first_txid(hits: DataFrame, order: list[str]) -> DataFrame:
    """The first hit of each transaction id."""
    return first_per_key(hits, "txid", order, ["block_height", "block_hash"])


def lookup_transactions(blocks: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits joined back to their transaction; ``found`` is NULL where there is none.

    Only blocks of a hit are unnested, and their transactions are cut to hash,
    id and first value before they meet the hits.
    """
    wanted = hits.select(F.col("block_hash").alias("hash")).distinct()
    transactions = blocks.join(wanted, "hash", "left_semi").select(
        F.col("hash").alias("block_hash"), F.explode("tx").alias("tx")
    ).select(
        "block_hash",
        F.col("tx.txid").alias("txid"),
        F.try_element_at("tx.vout", F.lit(1))["value"].alias("value"),
        F.lit(True).alias("found"),
    )
    return hits.join(transactions, ["block_hash", "txid"], "left")


def staking_values(blocks: DataFrame, hits: DataFrame) -> DataFrame:
    """First output value of each hit transaction, by the second look at the blocks.

    ``hits`` may come from a file, so it has no positions: within a block the
    hits of one transaction are alike, and block_height decides.
    """
    first = distinct_first_txid(hits, ["block_height", "block_hash"])
    looked_up = lookup_transactions(blocks, first)
    return looked_up.where(F.col("value").isNotNull()).select("block_height", "txid", "value")


def missing_transactions(blocks: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits whose transaction is not in its block or has no first output."""
    first = distinct_first_txid(hits, ["block_height", "block_hash"])
    looked_up = lookup_transactions(blocks, first)
    reason = F.when(F.col("found").isNull(), "no_transaction").otherwise("no_first_output")
    return looked_up.where(F.col("value").isNull()).select(
        "block_height", "block_hash", "txid", reason.alias("reason")
    )


def staking_outputs_onepass(blocks: DataFrame, prefix: str = STAKING_PREFIX) -> DataFrame:
    """Both looks in one scan: first output value of each hit transaction."""
    return first_per_key(
        staking_hits(blocks, prefix),
        "txid",
        ["block_height", "block_hash", "tx_index", "vout_index"],
        ["block_height", F.col("first_value").alias("value")],
    ).select("block_height", "txid", "value")


def skipped_blocks(blocks: DataFrame, start: int, stop: int) -> DataFrame:
    """Heights of [start, stop] to scan again: no block landed, or one without hash or transactions."""
    whole = F.col("hash").isNotNull() & F.col("tx").isNotNull()
    landed = blocks.groupBy("height").agg(F.max(whole).alias("whole"))
    heights = blocks.sparkSession.range(start, stop + 1).withColumnRenamed("id", "height")
    reason = F.when(F.col("whole").isNull(), "absent").otherwise("malformed")
    return (
        heights.join(landed, "height", "left")
        .where(~F.coalesce("whole", F.lit(False)))
        .select("height", reason.alias("reason"))
    )
