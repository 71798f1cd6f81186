"""Block data and the scan's file outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from satlake.schemas import schema

# Fixed value: first block that can hold a staking output.
FIRST_STAKING_BLOCK = 857910


def read_blocks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed blocks as JSON lines or Parquet, with a fixed schema."""
    return spark.read.schema(schema("blocks")).format(fmt).load(path)


def stream_blocks(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 64) -> DataFrame:
    return (
        spark.readStream.schema(schema("blocks"))
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def start_height(configured: int = FIRST_STAKING_BLOCK, prune_height: int = 0) -> int:
    """First block to scan: not before the configured one nor in the pruned part."""
    return max(configured, prune_height + 1)


def scan_range(blocks: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """Blocks of [start, stop]; the range reaches the file scan."""
    kept = blocks.where(F.col("height") >= start)
    return kept if stop is None else kept.where(F.col("height") <= stop)


def scan_after(blocks: DataFrame, done: DataFrame) -> DataFrame:
    """Blocks above the highest finished one (``done`` has height); all when none is."""
    last = done.agg(F.max("height")).scalar()
    return blocks.where(F.col("height") > F.coalesce(last, F.lit(-1)))


# Heights that one task of the interval steps looks at together.
INTERVAL_SPAN = 1 << 16


def _spans(intervals: DataFrame) -> DataFrame:
    """Intervals cut at the spans that they reach over, with their span."""
    span = F.explode(F.sequence(F.floor(F.col("first") / INTERVAL_SPAN), F.floor(F.col("last") / INTERVAL_SPAN)))
    cut = intervals.where("first <= last").select("first", "last", span.alias("span"))
    low = F.col("span") * INTERVAL_SPAN
    return cut.select(
        "span",
        F.greatest("first", low).alias("first"),
        F.least("last", low + F.lit(INTERVAL_SPAN - 1)).alias("last"),
    ).distinct()


def covered_intervals(intervals: DataFrame) -> DataFrame:
    """(first, last) of the stretches of heights that the given (first, last) cover, merged where they meet.

    The intervals may overlap, repeat and adjoin each other.  Each span of
    heights is merged on its own; what is left, at least one interval per span
    but no more than the gaps ask for, is merged across spans.
    """
    return _merged(_merged(_spans(intervals), ["span"]).drop("span"), [])


def _merged(intervals: DataFrame, within: list[str]) -> DataFrame:
    order = Window.partitionBy(*within).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.col("first") > F.coalesce(reached, F.lit(-2)) + 1
    island = F.sum(begins.cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = intervals.withColumn("begins", begins).withColumn("island", island)
    return marked.groupBy(*within, "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def heights_done(done: DataFrame) -> DataFrame:
    """Finished heights as intervals of one height each."""
    return done.where("height is not null").select(F.col("height").alias("first"), F.col("height").alias("last"))


def scan_uncovered(blocks: DataFrame, intervals: DataFrame) -> DataFrame:
    """Blocks in none of the finished intervals, wherever the gaps are.

    Blocks and intervals meet by equality of their span; of the merged
    intervals a span has no more than it has gaps, and a block keeps its place
    as soon as one of them is found to hold it.
    """
    spans = _spans(covered_intervals(intervals))
    inside = (
        (F.floor(F.col("height") / INTERVAL_SPAN) == F.col("span"))
        & (F.col("height") >= F.col("first"))
        & (F.col("height") <= F.col("last"))
    )
    return blocks.join(spans, inside, "left_anti")


def write_csv(df: DataFrame, path: str, append: bool) -> None:
    """CSV with a header; either added to the folder or in place of its content.

    Decimals are written in plain digits, never with an exponent.
    """
    plain = [
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
        for f in df.schema
    ]
    df.select(*plain).write.mode("append" if append else "overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(schema(table)).option("header", True).csv(path)
