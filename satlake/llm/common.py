"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satlake.session import fresh_path

# Words are runs of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: The same inside a SQL literal.
WORD_SQL = WORD.replace("\\", "\\\\")
BLANKS = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(value: Column, name: str) -> Column:
    """A column that later filters and projections take as it is.

    A generator of exactly one row keeps them from writing its expression out
    again for every use, which in a lambda means for every element.
    """
    return F.explode(F.array(value)).alias(name)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = Path(SparkFiles.getRootDirectory()) / "sources"
    folder.mkdir(exist_ok=True)
    archive = folder / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, fixes its rows."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables up to this many rows (counted) are sent to every task.
BROADCAST_ROWS = 50_000


def few(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows allow it; otherwise Spark plans the join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def tasks(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, keys: list[str], rank: str = "rank") -> DataFrame:
    """Gapless rank from 0 over all rows by ``keys``, without one task for all rows.

    Rows are dealt by ranges of the keys and sorted inside each range, then
    fixed by a written table; a rank is the place in its range plus the rows
    of the ranges before, of which there is one row per task.
    """
    spark = df.sparkSession
    columns = df.columns
    low = F.lit((1 << 33) - 1)
    placed = staged(
        df.repartitionByRange(tasks(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__place", F.monotonically_increasing_id().bitwiseAND(low)),
        "ranked",
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__part")
        .count()
        .select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    # One row per task of the range exchange: bounded by the partition setting.
    return placed.join(F.broadcast(starts), "__part").select(
        *columns, (F.col("__start") + F.col("__place")).alias(rank)
    )
