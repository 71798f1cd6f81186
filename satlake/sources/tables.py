"""Balance tables at rest: month partitions in versioned folders behind a pointer.

    <path>/data/version=<v>/month=<m>/   files, never changed once written
    <path>/pointers/<n>/                 which version holds each month

A write puts its months into a new version and then writes the next pointer,
which counts from the moment its job is committed.  Until then readers see the
table as it was; a write that was cut off leaves folders that nobody points to
and can simply be repeated.  One writer per table.

No write drops anything: a DataFrame keeps the files that it was opened on.
``sweep``, run apart from the writes, drops what has been out of use for longer
than any reader is held.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlake.schemas import schema
from satlake.session import work_path

MONTH = "month"
# Month of rows without a date.
UNDATED = "undated"

# Files of one month are split beyond this many rows.
ROWS_PER_FILE = 5_000_000

# How long a version that is out of use stays readable for those who hold it.
KEPT_FOR = timedelta(days=1)

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce(F.date_format("date", "yyyy-MM"), F.lit(UNDATED)))


class Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.path_of = jvm.org.apache.hadoop.fs.Path
        self.path = self.path_of(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path) if s.isDirectory()]

    def holds(self, name: str) -> bool:
        return self.fs.exists(self.path_of(self.path, name))

    def written(self, name: str) -> float:
        """When an entry was last changed, in seconds."""
        return self.fs.getFileStatus(self.path_of(self.path, name)).getModificationTime() / 1000

    def drop(self, name: str) -> None:
        self.fs.delete(self.path_of(self.path, name), True)


def _last_pointer(spark: SparkSession, path: str) -> int:
    """Number of the last committed pointer; 0 without one."""
    folder = Folder(spark, f"{path}/pointers")
    for n in sorted(map(int, folder.names()), reverse=True):
        if folder.holds(f"{n}/_SUCCESS"):
            return n
    return 0


def _pointed(spark: SparkSession, path: str, pointer: int) -> dict[str, str]:
    rows = spark.read.schema("month string, version string").parquet(f"{path}/pointers/{pointer}")
    return {r.month: r.version for r in rows.collect()}


def is_table(spark: SparkSession, path: str) -> bool:
    return _last_pointer(spark, path) > 0


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """Version of each month, one entry per calendar month."""
    last = _last_pointer(spark, path)
    return _pointed(spark, path, last) if last else {}


def _commit(spark: SparkSession, path: str, months: dict[str, str]) -> None:
    following = _last_pointer(spark, path) + 1
    entries = ", ".join(f"('{month}', '{version}')" for month, version in sorted(months.items()))
    rows = spark.sql(f"select * from values {entries or '(null, null)'} as t(month, version)").where("month is not null")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/pointers/{following}")


def sweep(spark: SparkSession, path: str, kept_for: timedelta = KEPT_FOR) -> list[str]:
    """Drop the versions that no pointer has named for ``kept_for``; returns their names.

    A pointer is out of use from the moment its successor was committed.
    Versions that were written more recently stay, pointed to or not: they may
    belong to a write that is under way.
    """
    pointers = Folder(spark, f"{path}/pointers")
    committed = sorted(int(n) for n in pointers.names() if pointers.holds(f"{n}/_SUCCESS"))
    if not committed:
        return []
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis() / 1000
    oldest = now - kept_for.total_seconds()
    ended = [n for n, later in zip(committed, committed[1:]) if pointers.written(f"{later}/_SUCCESS") < oldest]
    used = {v for n in committed if n not in ended for v in _pointed(spark, path, n).values()}
    data = Folder(spark, f"{path}/data")
    gone = [
        name for name in data.names() if name.removeprefix("version=") not in used and data.written(name) < oldest
    ]
    for name in gone:
        data.drop(name)
    for n in ended:
        pointers.drop(str(n))
    return [name.removeprefix("version=") for name in gone]


def _dealt(df: DataFrame, by_month: bool) -> DataFrame:
    """Rows as they are written, with their month.

    Rebalancing by month keeps small months in one file and lets a large month
    be split over several tasks.  Rows that lie by month already stay in the
    tasks that read them, which write about as many files as they read.
    """
    rows = _with_month(df)
    return rows if by_month else rows.hint("rebalance", MONTH)


def write_monthly(
    df: DataFrame, path: str, replace: bool = False, settled: Iterable[str] = (), by_month: bool = False
) -> None:
    """Put the months that occur in ``df`` in place; ``replace`` drops all others.

    The ``settled`` months become what ``df`` has of them, even if that is
    nothing.

    ``by_month`` says that ``df`` is read, without a shuffle since, from files
    of a month or a range of dates each.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    (
        _dealt(df, by_month)
        .write.option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(MONTH)
        .parquet(f"{path}/data/version={version}")
    )
    written = Folder(spark, f"{path}/data/version={version}").names()
    emptied = set(settled)
    months = {} if replace else {m: v for m, v in current(spark, path).items() if m not in emptied}
    months |= {name.removeprefix(f"{MONTH}="): version for name in written}
    _commit(spark, path, months)


def read_monthly(spark: SparkSession, path: str, table: str, only: Iterable[str] | None = None) -> DataFrame:
    """The table with its month, which filters prune the files by; folders other than of ``only`` are not listed."""
    columns = T.StructType(
        [*schema(table).fields, T.StructField("version", T.StringType()), T.StructField(MONTH, T.StringType())]
    )
    months = current(spark, path)
    if only is not None:
        wanted = set(only)
        months = {m: v for m, v in months.items() if m in wanted}
    if not months:
        return spark.createDataFrame([], columns).drop("version")
    folders = [f"{path}/data/version={v}/{MONTH}={m}" for m, v in sorted(months.items())]
    return spark.read.schema(columns).option("basePath", f"{path}/data").parquet(*folders).drop("version")


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    return read_monthly(spark, path, table).drop(MONTH)


def create_table(spark: SparkSession, path: str, table: str) -> None:
    """An empty table, so that a first upsert finds something to read."""
    write_monthly(spark.createDataFrame([], schema(table)), path)


class Landed:
    """A batch as written, with the months that occur in it."""

    def __init__(self, rows: DataFrame, months: list[str]):
        self.rows, self.months = rows, months

    def touched(self, path: str, table: str) -> DataFrame:
        """The rows of these months in a table, with their month; its other months are not opened."""
        return read_monthly(self.rows.sparkSession, path, table, self.months)


def land(path: str, incoming: DataFrame) -> Landed:
    """Write a batch below the work folder of a table, in place of the previous one.

    The months are observed while the rows are written: at most one entry per
    calendar month reaches the driver, and no job of its own is needed.
    """
    spark = incoming.sparkSession
    batch_path = f"{work_path(spark, path)}/batch"
    seen = Observation()
    rows = _with_month(incoming)
    rows.observe(seen, F.collect_set(MONTH).alias("months")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(batch_path)
    return Landed(spark.read.schema(rows.schema).parquet(batch_path), sorted(seen.get.get("months") or []))


def upsert_months(
    spark: SparkSession, path: str, table: str, incoming: DataFrame, merge: Merge
) -> Landed | None:
    """Merge ``incoming`` into the months of the table that it touches.

    The batch is first written next to the shared work of this table, in place
    of the previous batch, so that it is computed once.  The merged months
    become a new version; repeating a batch gives the same table again, whether
    the first run was cut off or not.  Returns the batch as written, or None
    when it is empty.
    """
    landed = land(path, incoming)
    if not landed.months:
        return None
    write_monthly(merge(landed.touched(path, table).drop(MONTH), landed.rows.drop(MONTH)), path)
    return landed
