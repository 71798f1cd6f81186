"""Bridge dependencies and the double-count adjustment.

A token bridged from network A to B counts on B and is subtracted from A.
Each implementation has one token and one origin, hence at most one parent:
the dependency graph is an edge list of at most one row per implementation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import ADJUSTED, Catalog
from satlake.functions.scalars import concat_skip_null
from satlake.schemas import BALANCE, TOTAL

# Origin marker of native tokens, and the form of a bridged
# token's address (it starts with a digit).
NATIVE_ORIGIN = "native"
BRIDGED_ADDRESS = "^[0-9].*"


def implementation_links(cat: Catalog) -> DataFrame:
    """(token_implementation, depegged, parent): the parent only of bridged, pegged ones."""
    pegs = cat.tokens.select(F.col("slug").alias("token"), "depegged")
    bridged = (
        F.col("network_origin").isNotNull()
        & (F.col("network_origin") != NATIVE_ORIGIN)
        & F.col("token_address").rlike(BRIDGED_ADDRESS)
        & (F.col("depegged") == F.lit(False))
    )
    parent = concat_skip_null(F.col("token"), F.lit("_"), F.col("network_origin"))
    return cat.token_implementations.join(cat.small(pegs, "tokens"), "token", "left").select(
        F.col("slug").alias("token_implementation"), "depegged", F.when(bridged, parent).alias("parent")
    )


def pegged_links(cat: Catalog) -> DataFrame:
    """Implementations of tokens known to hold their peg, with the parent if bridged."""
    links = implementation_links(cat).where(F.col("depegged") == F.lit(False))
    return links.select("token_implementation", "parent")


def bridge_edges(cat: Catalog) -> DataFrame:
    """(parent, child): the child's balance is subtracted from the parent's.

    Tokens that lost their peg, or whose peg is unknown, have no edges.
    """
    return pegged_links(cat).where(F.col("parent").isNotNull()).select(
        "parent", F.col("token_implementation").alias("child")
    )


def helper_dependencies_bridges(cat: Catalog) -> DataFrame:
    """Per token and origin network: the implementations to subtract, as an array."""
    bridged = cat.token_implementations.where(
        F.col("network_origin").isNotNull()
        & (F.col("network_origin") != NATIVE_ORIGIN)
        & F.col("token_address").rlike(BRIDGED_ADDRESS)
    )
    origins = bridged.groupBy(
        F.col("token").alias("token_slug"), F.col("network_origin").alias("origin_network")
    ).agg(F.array_sort(F.collect_list("slug")).alias("tokens_to_subtract"))
    pegged = cat.tokens.where(F.col("depegged") == F.lit(False)).select(
        F.col("slug").alias("token_slug"), "token_name", F.col("type").alias("token_type")
    )
    return origins.join(cat.small(pegged, "tokens"), "token_slug").select(
        "token_slug",
        concat_skip_null(F.col("token_slug"), F.lit("_"), F.col("origin_network")).alias(
            "token_implementation"
        ),
        "token_name",
        "token_type",
        "origin_network",
        "tokens_to_subtract",
    )


def edges_from_arrays(dependencies: DataFrame) -> DataFrame:
    """Edge list of the array form.

    Exploding turns "value is any element of the array" into an equi-join;
    membership matches once, hence distinct.
    """
    return dependencies.select(
        F.col("token_implementation").alias("parent"),
        F.explode("tokens_to_subtract").alias("child"),
    ).distinct()


def children_totals(
    balances: DataFrame, edges: DataFrame, also_by: tuple[str, ...] = ()
) -> DataFrame:
    """Sum of the children's balances per parent (and per ``also_by``)."""
    joined = balances.join(edges, balances["token_implementation"] == edges["child"])
    return joined.groupBy(F.col("parent").alias("token_implementation"), *also_by).agg(
        F.sum("balance").cast(TOTAL).alias("total_to_subtract")
    )


def subtract_children(balances: DataFrame, totals: DataFrame, on: list[str], target: str) -> DataFrame:
    """``balance - total`` where the parent has a row; other rows keep their balance."""
    net = F.col("balance").cast(TOTAL) - F.coalesce(F.col("total_to_subtract"), F.lit(0).cast(TOTAL))
    return balances.join(totals, on, "left").select(
        *[net.cast(target).alias(c) if c == "balance" else c for c in balances.columns]
    )


def adjusted_history(cat: Catalog, only: DataFrame | None = None) -> DataFrame:
    """The adjusted balances as the upserts keep them, or computed where they do not."""
    kept = cat.kept.get(ADJUSTED)
    return helper_token_balances_adjusted(cat, only=only) if kept is None else kept


def helper_token_balances_adjusted(
    cat: Catalog,
    balances: DataFrame | None = None,
    only: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Daily balances minus the children's balances of the same date.

    A child without a parent row on the date gives nothing.  Rows depend on
    their own date only, so one date range can be recomputed on its own by
    passing its ``balances``.  ``only`` names the wanted implementations: rows
    that neither belong to them nor are subtracted from them stay out of the
    shuffle.  ``groups`` names the wanted (token_implementation, date), or
    token_implementation alone.
    """
    facts = cat.token_balances if balances is None else balances
    links = cat.per_implementation(_family_links(cat, only))
    rows = facts.join(links, "token_implementation", "left" if only is None else "inner")
    if only is None:
        rows = rows.withColumn("keep_own", F.lit(True))
    # Rows without an implementation belong to nobody: their id keeps them apart.
    nameless = F.when(F.col("token_implementation").isNull(), F.col("id"))
    adjusted = net_of_children(
        rows.withColumn("nameless", nameless), ["date", "nameless"], ["created_at", "id"], groups
    )
    return adjusted.select(
        "date", "token_implementation", F.col("balance").cast(BALANCE).alias("balance"), "created_at", "id"
    )


def _family_links(cat: Catalog, only: DataFrame | None) -> DataFrame:
    """Per implementation: its parent, and with ``only`` whether its own rows are wanted."""
    links = implementation_links(cat).select("token_implementation", "parent")
    if only is None:
        return links.where(F.col("parent").isNotNull())
    wanted = only.select(F.col("token_implementation").alias("wanted"))
    mine = cat.per_implementation(wanted.select("*", F.lit(True).alias("keep_own")))
    parents = cat.per_implementation(wanted.select("*", F.lit(True).alias("lends")))
    flagged = links.join(mine, F.col("token_implementation") == F.col("wanted"), "left").drop("wanted")
    flagged = flagged.join(parents, F.col("parent") == F.col("wanted"), "left").drop("wanted")
    return flagged.where(F.col("keep_own") | F.col("lends")).select(
        "token_implementation",
        F.when(F.col("lends"), F.col("parent")).alias("parent"),
        F.coalesce("keep_own", F.lit(False)).alias("keep_own"),
    )


def same_group(rows: DataFrame, groups: DataFrame, holder: str = "token_implementation") -> Column:
    """Condition that a row belongs to one of ``groups``; a missing date is a date of its own."""
    same = rows[holder] == groups["token_implementation"]
    return same & rows["date"].eqNullSafe(groups["date"]) if "date" in groups.columns else same


def net_of_children(
    rows: DataFrame, keys: list[str], carried: list[str], groups: DataFrame | None = None
) -> DataFrame:
    """Balance minus the children's balances, in one scan and one shuffle.

    ``rows`` has one row per implementation and ``keys``, with the columns
    parent and keep_own.  Each row goes to its own key and, if bridged, also to
    its parent's; a key gets one row per child at most, so none is hot.  Keys
    that only children reached are dropped, as are those not in ``groups``.
    """
    types = {f.name: f.dataType for f in rows.schema}
    nothing = F.lit(None).cast(TOTAL)
    own = F.struct(
        F.col("token_implementation").alias("holder"),
        *keys,
        F.col("balance").cast(TOTAL).alias("own"),
        nothing.alias("bridged"),
        *carried,
    )
    lent = F.struct(
        F.col("parent").alias("holder"),
        *keys,
        nothing.alias("own"),
        F.col("balance").cast(TOTAL).alias("bridged"),
        *[F.lit(None).cast(types[c]).alias(c) for c in carried],
    )
    pieces = (
        F.when(F.col("parent").isNull(), F.array(own))
        .when(F.col("keep_own"), F.array(own, lent))
        .otherwise(F.array(lent))
    )
    taken = F.coalesce(F.sum("bridged").cast(TOTAL), F.lit(0).cast(TOTAL))
    dealt = rows.select(F.inline(pieces))
    if groups is not None:
        dealt = dealt.join(groups, same_group(dealt, groups, "holder"), "left_semi")
    return (
        dealt.groupBy("holder", *keys)
        .agg(
            F.max("own").alias("own"),
            (F.max("own") - taken).cast(TOTAL).alias("balance"),
            *[F.max(c).alias(c) for c in carried],
        )
        .where(F.col("own").isNotNull())
        .drop("own")
        .withColumnRenamed("holder", "token_implementation")
    )
