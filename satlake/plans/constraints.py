"""Constraints where rows are written: quarantine of what breaks one, deletes that cascade.

The rules are those of ``schemas.UNIQUE_KEYS`` and ``FOREIGN_KEYS``.  A conflict
on a table's upsert key is no violation but an update; a NULL breaks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import ADJUSTED, LATEST, Catalog
from satlake.operators.adjust import bridge_edges, helper_token_balances_adjusted
from satlake.operators.latest import latest_with_ties
from satlake.operators.quality import cascade_delete, parent_key
from satlake.plans.maintain import upsert_reserves, upsert_tokens
from satlake.schemas import FOREIGN_KEYS, TOKEN_KEY, schema
from satlake.session import work_path
from satlake.sources.tables import MONTH, is_table, read_monthly, read_table, write_monthly

# ---------------------------------------------------------------- upserts


def with_broken_rule(cat: Catalog, table: str, incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """``incoming`` with ``broken``, the first rule that a row breaks, or NULL.

    References meet the dimensions, which are small; row ids meet the facts
    only if the batch has ids, and then nothing but ids and keys are read.
    """
    rows, reasons = incoming, []
    for held, column, parent in FOREIGN_KEYS:
        if held == table and column in incoming.columns:
            known = cat.tables[parent].select(F.col(parent_key(parent)).alias(f"_{column}")).distinct()
            rows = rows.join(cat.small(known, parent), F.col(column) == F.col(f"_{column}"), "left")
            missing = F.col(column).isNotNull() & F.col(f"_{column}").isNull()
            reasons.append(F.when(missing, f"{table}.{column}->{parent}"))
    if table == "token_balances" and "id" in incoming.columns:
        rows = _with_id_owner(cat, rows, order)
        key = F.struct(*TOKEN_KEY)
        taken = F.col("id").isNotNull() & F.col("_owner").isNotNull() & ~F.col("_owner").eqNullSafe(key)
        reasons.append(F.when(taken, f"{table}(id)"))
    broken = F.coalesce(*reasons, F.lit(None).cast("string")) if reasons else F.lit(None).cast("string")
    return rows.select(*[F.col(f"`{c}`") for c in incoming.columns], broken.alias("broken"))


def _with_id_owner(cat: Catalog, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_owner``: the key that has a row's id, in the table or else by the batch's first row with it.

    A row whose key is in the table updates it and keeps the id it has there,
    so such rows claim none.
    """
    facts = cat.token_balances.select(*TOKEN_KEY, "id")
    keys = rows.select(*TOKEN_KEY).distinct()
    updates = facts.join(keys, list(TOKEN_KEY), "left_semi").select(*TOKEN_KEY, F.lit(True).alias("_update"))
    rows = rows.join(updates, list(TOKEN_KEY), "left")
    claims = rows.where("id is not null and _update is null").groupBy(F.col("id").alias("_id")).agg(
        F.min_by(F.struct(*TOKEN_KEY), F.struct(*order)).alias("_first")
    )
    stored = facts.join(claims.select(F.col("_id").alias("id")), "id", "left_semi").select(
        F.col("id").alias("_stored_id"), F.struct(*TOKEN_KEY).alias("_stored")
    )
    owners = claims.join(stored, F.col("_id") == F.col("_stored_id"), "left").select(
        "_id", F.coalesce("_stored", "_first").alias("_claimed")
    )
    claimed = rows.join(owners, F.col("id") == F.col("_id"), "left")
    return claimed.withColumn("_owner", F.when(F.col("_update").isNull(), F.col("_claimed"))).drop(
        "_update", "_id", "_claimed"
    )


def upsert_checked(
    cat: Catalog,
    root: str,
    table: str,
    incoming: DataFrame,
    order: Sequence[str],
    quarantine_path: str,
    batch: str,
    created_at: Column | None = None,
) -> None:
    """Upsert the rows that keep the rules; the others go to ``quarantine_path`` with the rule they break.

    Repeating a batch changes nothing: its quarantine takes the same folder again.
    """
    path = f"{work_path(cat.spark, quarantine_path)}/checked"
    flagged = with_broken_rule(cat.reopened(), table, incoming, order)
    flagged.write.mode("overwrite").parquet(path)
    flagged = cat.spark.read.schema(flagged.schema).parquet(path)
    flagged.where("broken is not null").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{quarantine_path}/batch={batch}")
    valid = flagged.where("broken is null").drop("broken")
    if table == "token_balances" and "id" in valid.columns:
        # A row without an id among others with one gets what a batch without ids gets.
        valid = valid.withColumn("id", F.coalesce("id", F.xxhash64(*TOKEN_KEY)))
    upsert = upsert_tokens if table == "token_balances" else upsert_reserves
    upsert(cat, root, valid, order, created_at)


# ---------------------------------------------------------------- deletes


def _months_with(cat: Catalog, path: str, table: str, column: str, keys: DataFrame) -> list[str]:
    """Months that hold a row of ``keys``: one column is read, one name per month is collected."""
    rows = read_monthly(cat.spark, path, table).select(column, MONTH)
    return sorted(r[0] for r in rows.join(keys, column, "left_semi").select(MONTH).distinct().collect())


def _without(cat: Catalog, path: str, table: str, column: str, keys: DataFrame) -> list[str]:
    """Drop the rows of ``keys`` from a monthly table; only months that hold one are written again."""
    months = _months_with(cat, path, table, column, keys)
    if months:
        rows = read_monthly(cat.spark, path, table, months).drop(MONTH)
        columns = rows.columns
        kept = rows.join(keys, column, "left_anti").select(*columns)
        write_monthly(kept, path, settled=months)
    return months


def cascade_stored(
    cat: Catalog, root: str, networks: Column | None = None, tokens: Column | None = None
) -> Catalog:
    """Delete networks and tokens, and from the stored facts and kept tables what refers to them.

    Returns a catalog of the dimensions that are left over the facts as they
    are then; writing these dimensions is up to the caller.  Repeating a
    delete that was cut off ends in the same tables.
    """
    left = cascade_delete(cat, networks, tokens)
    doomed = _gone(cat, left, "token_implementations", "slug")
    reserves = _gone(cat, left, "reserve_implementations", "id")
    impls = cat.per_implementation(doomed.select(F.col("slug").alias("token_implementation")))
    ids = cat.small(reserves.select(F.col("id").alias("reserve_implementation_id")), "reserve_implementations")

    # What the kept tables have to look at again, as long as the facts still say it.
    parents = bridge_edges(cat).join(doomed, F.col("child") == F.col("slug"), "left_semi")
    parents = parents.select(F.col("parent").alias("token_implementation")).distinct()
    parents = cat.per_implementation(parents.join(impls, "token_implementation", "left_anti"))
    backed = cat.reserve_implementations.join(reserves, "id", "left_semi").select("derivative_token")
    held = cat.reserve_balances.join(ids, "reserve_implementation_id", "left_semi").select("derivative_token")
    derivatives = backed.unionByName(held).where("derivative_token is not null").distinct()
    path = f"{work_path(cat.spark, root)}/derivatives"
    derivatives.write.mode("overwrite").parquet(path)
    derivatives = cat.spark.read.schema(derivatives.schema).parquet(path)

    _without(cat, f"{root}/token_balances", "token_balances", "token_implementation", impls)
    _without(cat, f"{root}/reserve_balances", "reserve_balances", "reserve_implementation_id", ids)

    if is_table(cat.spark, f"{root}/{ADJUSTED}"):
        _adjust_without(cat, left, root, impls, parents)
    gone = {"token_implementation": impls, "reserve_implementation_id": ids}
    for (table, key), name in LATEST.items():
        if is_table(cat.spark, f"{root}/{name}"):
            if key in gone:
                _without(cat, f"{root}/{name}", table, key, gone[key])
            else:
                _latest_again(cat, root, table, key, derivatives)
    left.root, left._use_kept = root, cat._use_kept
    return left.reopened()


def _gone(cat: Catalog, left: Catalog, table: str, key: str) -> DataFrame:
    known = left.tables[table].select(key)
    return cat.tables[table].select(key).join(cat.small(known, table), key, "left_anti").distinct()


def _adjust_without(cat: Catalog, left: Catalog, root: str, impls: DataFrame, parents: DataFrame) -> None:
    """Adjusted rows of the deleted go, those of their parents are computed again from what is left."""
    path = f"{root}/{ADJUSTED}"
    touched = impls.unionByName(parents)
    months = _months_with(cat, path, "token_balances", "token_implementation", touched)
    if months:
        facts = read_monthly(cat.spark, f"{root}/token_balances", "token_balances", months).drop(MONTH)
        kept = read_monthly(cat.spark, path, "token_balances", months).drop(MONTH)
        columns = [f.name for f in schema("token_balances")]
        fresh = helper_token_balances_adjusted(left, facts.where("token_implementation is not null"), groups=parents)
        rest = kept.join(touched, "token_implementation", "left_anti").select(*columns)
        write_monthly(rest.unionByName(fresh.select(*columns)), path, settled=months)


def _latest_again(cat: Catalog, root: str, table: str, key: str, keys: DataFrame) -> None:
    """Latest rows of some keys from the whole facts: a delete can bring an older date back."""
    path = f"{root}/{LATEST[table, key]}"
    kept = read_table(cat.spark, path, table)
    facts = read_table(cat.spark, f"{root}/{table}", table)
    fresh = latest_with_ties(facts.join(keys, key, "left_semi"), key, "date")
    columns = kept.columns
    rest = kept.join(keys, key, "left_anti").select(*columns)
    write_monthly(rest.unionByName(fresh.select(*columns)), path, replace=True)
