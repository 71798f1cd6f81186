"""Tables kept next to the facts: the latest rows and the adjusted history.

    latest_token_balances     latest row of each implementation
    latest_reserve_balances   all rows of each derivative token's latest date
    latest_reserves_by_id     all rows of each reserve's latest date
    adjusted_balances         balances minus the children's, per (implementation, date)
    adjusted_edges            the (parent, child) edges that the adjusted history was made with

An upsert brings them up to date from its own batch: only the months that the
batch touches are read, only the keys that it touches are computed again, and
everything is read back from the facts after their commit.  So the kept tables
do not depend on how polls were cut into batches, how late a batch is or how
often it is repeated; after a run that was cut off, the repeated batch mends
them.  Views read them through ``Catalog.kept``.

The edges follow from the dimensions.  When those change, ``refresh_edges``
computes the history of the parents that won or lost a child again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.catalog import ADJUSTED, LATEST, Catalog
from satlake.operators.adjust import (
    bridge_edges,
    helper_token_balances_adjusted,
    implementation_links,
    same_group,
)
from satlake.operators.latest import latest_with_ties
from satlake.operators.upsert import upsert_reserve_balances, upsert_token_balances
from satlake.schemas import schema
from satlake.sources.tables import MONTH, Landed, is_table, read_monthly, upsert_months, write_monthly

Follow = Callable[[Landed], None]

EDGES = "parent string, child string"


def build_kept(cat: Catalog, root: str) -> None:
    """Make all kept tables from the whole facts of ``cat``."""
    for (table, key), name in LATEST.items():
        write_monthly(latest_with_ties(cat.tables[table], key, "date"), f"{root}/{name}", replace=True)
    write_monthly(_full_rows(helper_token_balances_adjusted(cat)), f"{root}/{ADJUSTED}", replace=True)
    _write_edges(cat, root)


def _full_rows(adjusted: DataFrame) -> DataFrame:
    return adjusted.select(*[f.name for f in schema("token_balances")])


# ---------------------------------------------------------------- latest rows


def follow_latest(spark: SparkSession, root: str, table: str, key: str) -> Follow:
    """Bring the latest rows by ``key`` up to date after an upsert of ``table``.

    The keys of the batch are looked up in the months of the batch as the
    facts have them now; what the kept table says of these months and keys is
    replaced, the rest competes with it by date.
    """
    path = f"{root}/{LATEST[table, key]}"

    def follow(landed: Landed) -> None:
        keys = landed.rows.select(F.col(key).alias("touched")).where("touched is not null").distinct()
        facts = landed.touched(f"{root}/{table}", table)
        fresh = facts.join(keys, F.col(key) == F.col("touched"), "left_semi").drop(MONTH)
        kept = read_monthly(spark, path, table)
        settled = F.col(MONTH).isin(landed.months)
        older = kept.where(~settled).unionByName(
            kept.where(settled).join(keys, F.col(key) == F.col("touched"), "left_anti")
        )
        # One row per key (and reserve): the table does not grow with the history.
        write_monthly(latest_with_ties(older.drop(MONTH).unionByName(fresh), key, "date"), path, replace=True)

    return follow


# ---------------------------------------------------------------- adjusted history


def touched_groups(cat: Catalog, landed: Landed) -> DataFrame:
    """(token_implementation, date) whose adjusted balance a batch can change: its keys and their parents'."""
    keys = landed.rows.select("token_implementation", "date").where("token_implementation is not null")
    links = cat.per_implementation(implementation_links(cat).where("parent is not null").drop("depegged"))
    parents = keys.join(links, "token_implementation").select(F.col("parent").alias("token_implementation"), "date")
    return keys.unionByName(parents).distinct()


def follow_adjusted(cat: Catalog, root: str) -> Follow:
    """Bring the adjusted history up to date after an upsert of token balances.

    Rows without an implementation have no children and stand as in the facts.
    """
    path = f"{root}/{ADJUSTED}"

    def follow(landed: Landed) -> None:
        groups = touched_groups(cat, landed)
        facts = landed.touched(f"{root}/token_balances", "token_balances").drop(MONTH)
        named = facts.where("token_implementation is not null")
        fresh = helper_token_balances_adjusted(cat, named, groups=groups)
        old = landed.touched(path, "token_balances").drop(MONTH).where("token_implementation is not null")
        rest = old.join(groups, same_group(old, groups), "left_anti")
        nameless = facts.where("token_implementation is null")
        write_monthly(rest.unionByName(_full_rows(fresh)).unionByName(nameless), path)

    return follow


def _read_edges(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root}/adjusted_edges"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    system = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(EDGES).parquet(path) if system.exists(done) else None


def _write_edges(cat: Catalog, root: str) -> None:
    bridge_edges(cat).select("parent", "child").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{root}/adjusted_edges")


def refresh_edges(cat: Catalog, root: str) -> list[str]:
    """Follow a change of the dimensions; returns the months that were written again.

    Only the history of parents whose children changed is computed again, and
    only the months that hold it are read.  The new edges are noted last: a
    run that was cut off is repeated, and one that lost the note starts anew.
    """
    spark = cat.spark
    old = _read_edges(spark, root)
    if old is None:
        build_kept(cat, root)
        return []
    new = bridge_edges(cat).select("parent", "child")
    changed = old.exceptAll(new).unionByName(new.exceptAll(old))
    parents = changed.select(F.col("parent").alias("token_implementation")).distinct()
    parents = cat.per_implementation(parents)
    facts = read_monthly(spark, f"{root}/token_balances", "token_balances")
    # At most one name per calendar month.
    held = facts.join(parents, "token_implementation", "left_semi").select(MONTH).distinct()
    months = sorted(r[0] for r in held.collect())
    if months:
        path = f"{root}/{ADJUSTED}"
        facts = read_monthly(spark, f"{root}/token_balances", "token_balances", months).drop(MONTH)
        kept = read_monthly(spark, path, "token_balances", months).drop(MONTH)
        fresh = helper_token_balances_adjusted(cat, facts.where("token_implementation is not null"), groups=parents)
        rest = kept.join(parents, "token_implementation", "left_anti")
        write_monthly(rest.unionByName(_full_rows(fresh)), path)
    _write_edges(cat, root)
    return months


# ---------------------------------------------------------------- upserts


def followers(cat: Catalog, root: str, table: str) -> list[Follow]:
    """What an upsert of ``table`` has to bring up to date below ``root``."""
    found = [
        follow_latest(cat.spark, root, table, key)
        for (held, key), name in LATEST.items()
        if held == table and is_table(cat.spark, f"{root}/{name}")
    ]
    if table == "token_balances" and is_table(cat.spark, f"{root}/{ADJUSTED}"):
        found.append(follow_adjusted(cat, root))
    return found


def upsert_tokens(
    cat: Catalog, root: str, incoming: DataFrame, order: Sequence[str], created_at: Column | None = None
) -> None:
    """Upsert token balances below ``root`` and bring the kept tables up to date."""

    def merge(existing: DataFrame, rows: DataFrame) -> DataFrame:
        return upsert_token_balances(existing, rows, order, created_at)

    landed = upsert_months(cat.spark, f"{root}/token_balances", "token_balances", incoming, merge)
    for follow in followers(cat, root, "token_balances") if landed else ():
        follow(landed)


def upsert_reserves(
    cat: Catalog, root: str, incoming: DataFrame, order: Sequence[str], created_at: Column | None = None
) -> None:
    """Upsert reserve balances below ``root`` and bring the kept tables up to date."""

    def merge(existing: DataFrame, rows: DataFrame) -> DataFrame:
        return upsert_reserve_balances(existing, rows, order, created_at)

    landed = upsert_months(cat.spark, f"{root}/reserve_balances", "reserve_balances", incoming, merge)
    for follow in followers(cat, root, "reserve_balances") if landed else ():
        follow(landed)
