"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to a few bits: values of a category by the share of
rows before them, numbers by their binary magnitude.  Rows are sorted by their
index on the curve and cut into runs of equal row counts, so that a shard (and
a file inside it) spans a small range of every dimension.  All of it is
DataFrame operators.

Defined results: null dimensions and sizes take the lowest level or zero, ties
on the curve follow the remaining sort keys, repeated rows are kept, an empty
table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlake.llm.common import ranked

#: Bits per dimension.
BITS = 5


def _rotate(value: int, by: int, n: int) -> int:
    by %= n
    return ((value >> by) | (value << (n - by))) & ((1 << n) - 1)


def curve_states(n: int) -> list[list[tuple[int, int]]]:
    """Per state of the n-dimensional curve and corner: (digit, next state).

    A state is the corner that the curve enters a cell by and the axis it runs
    along; corners are visited in the order of the reflected Gray code.
    """
    corners = 1 << n
    ends = [0] + [2 * ((i - 1) // 2) for i in range(1, corners)]
    enter = [e ^ (e >> 1) for e in ends]

    def axis(i: int) -> int:
        if i == 0:
            return 0
        k = i - 1 if i % 2 == 0 else i
        return ((k ^ (k + 1)).bit_length() - 1) % n

    table = []
    for state in range(corners * n):
        entry, along = divmod(state, n)
        row = []
        for corner in range(corners):
            gray = _rotate(corner ^ entry, along + 1, n)
            digit = gray
            shift = 1
            while shift < n:
                digit ^= digit >> shift
                shift <<= 1
            step = entry ^ _rotate(enter[digit], n - (along + 1) % n, n)
            row.append((digit, step * n + (along + axis(digit) + 1) % n))
        table.append(row)
    return table


def curve_index(levels: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of a cell given by one level (0 to 2^bits - 1) per dimension."""
    n = len(levels)
    table = curve_states(n)
    corners = 1 << n
    digits = F.array(*[F.lit(d) for row in table for d, _ in row])
    following = F.array(*[F.lit(s) for row in table for _, s in row])

    def step(at: Column, bit: Column) -> Column:
        corner = reduce(
            lambda a, b: a.bitwiseOR(b),
            [
                F.call_function("shiftleft", F.call_function("shiftright", level.cast("int"), bit).bitwiseAND(1), F.lit(k))
                for k, level in enumerate(levels)
            ],
        )
        cell = at["state"] * corners + corner
        return F.struct(
            (at["index"] * corners + F.get(digits, cell)).cast("bigint").alias("index"),
            F.get(following, cell).cast("int").alias("state"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("index"), F.lit(0).cast("int").alias("state"))
    down = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(down, start, step)["index"]


def category_levels(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """Level per distinct value: the share of the rows with a smaller value, nulls first."""
    before = Window.orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    return (
        df.groupBy(column)
        .count()
        .select(
            F.col(column).alias("value"),
            F.floor(
                F.coalesce(F.sum("count").over(before), F.lit(0)) * (1 << bits) / F.sum("count").over(whole)
            ).cast("int").alias("level"),
        )
    )


def magnitude_level(number: Column, bits: int = BITS) -> Column:
    """Number of binary digits, at most the highest level; null and negatives are 0."""
    digits = F.when(number > 0, F.length(F.bin(number))).otherwise(F.lit(0))
    return F.least(digits, F.lit((1 << bits) - 1)).cast("int")


def hilbert_order(
    df: DataFrame, categories: list[str], numbers: list[str], keys: list[str], bits: int = BITS
) -> DataFrame:
    """Add ``curve`` (index on the curve) and ``rank`` (gapless, by curve, then ``keys``)."""
    columns = df.columns
    levels = []
    for i, name in enumerate(categories):
        found = category_levels(df, name, bits).select(
            F.col("value").alias(f"__value{i}"), F.col("level").alias(f"__level{i}")
        )
        df = df.join(found, F.col(name).eqNullSafe(F.col(f"__value{i}")), "left").drop(f"__value{i}")
        levels.append(F.col(f"__level{i}"))
    levels += [magnitude_level(F.col(name), bits) for name in numbers]
    placed = df.select(*columns, curve_index(levels, bits).alias("curve"))
    return ranked(placed, ["curve", *keys])


def cut_runs(ordered: DataFrame, shards: int, total: int) -> DataFrame:
    """Cut ``rank`` into runs whose row counts are at most one apart: ``shard`` and ``slot``."""
    small, longer = divmod(total, shards)
    split = longer * (small + 1)
    rank = F.col("rank")
    shard = F.when(rank < split, F.floor(rank / (small + 1))).otherwise(
        longer + F.floor((rank - split) / max(1, small))
    )
    first = F.when(F.col("shard") < longer, F.col("shard") * (small + 1)).otherwise(
        split + (F.col("shard") - longer) * small
    )
    return ordered.withColumn("shard", shard.cast("int")).withColumn(
        "slot", (rank - first).cast("bigint")
    )


def hilbert_shards(
    df: DataFrame, categories: list[str], numbers: list[str], keys: list[str], shards: int, bits: int = BITS
) -> DataFrame:
    """All rows of ``df`` with curve, rank, shard and slot."""
    return cut_runs(hilbert_order(df, categories, numbers, keys, bits), shards, df.count())


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order: file statistics then prune on every dimension."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
