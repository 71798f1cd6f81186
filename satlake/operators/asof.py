"""As-of lookup: the last block of a network at or before a moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET_SECONDS = 3600


def asof_block(blocks: DataFrame, requests: DataFrame) -> DataFrame:
    """Add ``block_number`` and ``block_ts`` to requests (network, ts); NULL when none.

    ``blocks`` has network, height, ts (epoch seconds).  Blocks of one second
    collapse to the highest number before the shuffle, so an hour of a network
    holds at most 3600 of them however busy it is; hours are searched apart
    and only one row per hour is carried forward along a network.
    """
    hour = F.floor(F.col("ts") / BUCKET_SECONDS).cast("bigint").alias("hour")
    tops = blocks.groupBy("network", "ts").agg(F.max("height").alias("height"))
    asked = requests.select("network", "ts").distinct()

    points = tops.select(
        "network", hour, "ts", F.struct("ts", "height").alias("block"), F.lit(False).alias("asked")
    ).unionByName(
        asked.select("network", hour, "ts", F.lit(None).alias("block"), F.lit(True).alias("asked")),
        allowMissingColumns=False,
    )
    upto = (
        Window.partitionBy("network", "hour")
        .orderBy("ts", F.col("asked").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_hour = points.withColumn("block", F.last("block", ignorenulls=True).over(upto)).where("asked")

    # The last block of each hour, carried to the later hours of the network.
    hours = points.groupBy("network", "hour").agg(F.max("block.ts").alias("last_ts"), F.max_by(
        "block.height", "block.ts").alias("last_height"))
    earlier = (
        Window.partitionBy("network")
        .orderBy("hour")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = hours.select(
        "network",
        "hour",
        F.last(
            F.when(F.col("last_ts").isNotNull(), F.struct(F.col("last_ts").alias("ts"), F.col("last_height").alias("height"))),
            ignorenulls=True,
        )
        .over(earlier)
        .alias("before"),
    )
    found = in_hour.join(carried, ["network", "hour"], "left").select(
        "network", "ts", F.coalesce("block", "before").alias("block")
    )
    return requests.join(
        found.select(
            "network",
            "ts",
            F.col("block.height").alias("block_number"),
            F.col("block.ts").alias("block_ts"),
        ),
        ["network", "ts"],
        "left",
    )
