"""Data rules of the model as reports and repairs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.functions.scalars import concat_skip_null
from satlake.schemas import FOREIGN_KEYS, UNIQUE_KEYS, schema


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is exempt."""
    counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1").select(F.lit(rule).alias("rule"), _key_text(keys).alias("key"), "n")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def check_unique(cat: Catalog) -> DataFrame:
    return _union(
        duplicate_keys(cat.tables[table], keys, f"{table}({','.join(keys)})")
        for table, all_keys in UNIQUE_KEYS.items()
        for keys in all_keys
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Referenced values without a parent row, with their row counts; NULL passes.

    Values are counted before the anti-join: a hot value is one row there.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(parent_key).alias("value"))
    missing = counted.join(known, "value", "left_anti")
    return missing.select(F.lit(rule).alias("rule"), F.col("value").cast("string").alias("value"), "n")


def parent_key(table: str) -> str:
    return "id" if table == "reserve_implementations" else "slug"


def check_fk(cat: Catalog) -> DataFrame:
    return _union(
        orphans(
            cat.tables[table],
            column,
            cat.tables[parent],
            parent_key(parent),
            f"{table}.{column}->{parent}",
        )
        for table, column, parent in FOREIGN_KEYS
    )


def cascade_delete(cat: Catalog, networks: Column | None = None, tokens: Column | None = None) -> Catalog:
    """The catalog without the networks and tokens for which the condition holds.

    Rows that refer to a deleted row go as well, down to the facts; rows with
    a NULL reference stay.
    """
    kept = dict(cat.tables)
    for table, condition in (("networks", networks), ("tokens", tokens)):
        if condition is not None:
            kept[table] = kept[table].where(~F.coalesce(condition, F.lit(False)))
    for table, column, parent in FOREIGN_KEYS:
        parents = kept[parent].select(F.col(parent_key(parent)).alias(column))
        gone = cat.tables[parent].select(F.col(parent_key(parent)).alias(column)).join(
            cat.small(parents, parent), column, "left_anti"
        )
        kept[table] = kept[table].join(cat.small(gone, parent), column, "left_anti").select(
            *kept[table].columns
        )
    return Catalog(cat.spark, kept, cat.as_of)


def check_domain(cat: Catalog, allowed_types: Sequence[str]) -> DataFrame:
    """NOT NULL violations per column and token types outside the allowed set."""
    reports = []
    for name, df in cat.tables.items():
        required = [f.name for f in schema(name) if not f.nullable]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        rules = [
            F.struct(F.lit(f"{name}.{c} not null").alias("rule"), F.col(c).alias("n")) for c in required
        ]
        reports.append(counts.select(F.inline(F.array(*rules))))
    bad = cat.tokens.where(F.col("type").isNotNull() & ~F.col("type").isin(*allowed_types))
    reports.append(
        bad.groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.concat(F.lit("tokens.type in domain: "), "type").alias("rule"), "n")
    )
    return _union(reports)


def fill_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add absent columns with their default; an explicit NULL stays NULL."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def derive_impl_slug(impls: DataFrame) -> DataFrame:
    """Fill a missing slug with <token>_<network> and a missing name with the slug."""
    slug = F.coalesce(F.col("slug"), concat_skip_null(F.col("token"), F.lit("_"), F.col("network")))
    return impls.withColumn("slug", slug).withColumn("name", F.coalesce("name", "slug"))
