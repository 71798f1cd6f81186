"""One callable per operator: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlake import fixtures
from satlake.catalog import Catalog
from satlake.functions import scalars
from satlake.operators import adjust, asof, blocks, latest, quality, ranking, star, upsert
from satlake.plans import constraints, decode, gainers, ingest, maintain, network_config, prices, reserves, supplies, usd
from satlake.session import fresh_path
from satlake.sources import chain, source_config, tables
from satlake.streaming import daily, latest_store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

NULL_MARK = "<null>"

# created_at given to the rows that the upsert queries insert.
INSERTED_AT = "2024-02-01 00:15:00"


def inserted_at():
    return F.lit(INSERTED_AT).cast("timestamp_ntz")


def comparable(df: DataFrame) -> DataFrame:
    """Arrays and timestamps as text, so that both engines print them alike."""
    columns = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, ",", NULL_MARK)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir))
        return fn

    return register


def catalog_query(name: str, build: Callable[[Catalog], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: build(fixtures.catalog(spark, sf_dir)))


# ---------------------------------------------------------------- views

for _name, _build in {
    "helper_current_supplies_raw": supplies.helper_current_supplies_raw,
    "helper_dependencies_bridges": adjust.helper_dependencies_bridges,
    "helper_reserves_summed": reserves.helper_reserves_summed,
    "helper_token_balances_adjusted": adjust.helper_token_balances_adjusted,
    "current_supplies_by_tokenimpl": supplies.current_supplies_by_tokenimpl,
    "current_supplies_by_network": supplies.current_supplies_by_network,
    "current_supplies_by_tokenproject": supplies.current_supplies_by_tokenproject,
    "current_reserves_by_tokenimpl": reserves.current_reserves_by_tokenimpl,
    "current_by_tokenimpl": reserves.current_by_tokenimpl,
    "historical_supplies_by_network": supplies.historical_supplies_by_network,
    "historical_supplies_by_tokenproject": supplies.historical_supplies_by_tokenproject,
    "historical_supplies_by_staking": supplies.historical_supplies_by_staking,
    "historical_supplies_by_liquidstaking": supplies.historical_supplies_by_liquidstaking,
    "historical_supplies_by_tokenimpl": supplies.historical_supplies_by_tokenimpl,
    "top_gainers_by_tokenimpl": gainers.top_gainers_by_tokenimpl,
    "top_gainers_by_tokenimpl_absolute": gainers.top_gainers_by_tokenimpl_absolute,
    "current_prices": prices.current_prices,
}.items():
    catalog_query(_name, _build)


# ---------------------------------------------------------------- scans, sources, sinks


@query("scan_catalog")
def scan_catalog(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    labels = {
        "networks": "slug",
        "tokens": "slug",
        "token_implementations": "slug",
        "reserve_implementations": "slug",
        "token_balances": "token_implementation",
        "reserve_balances": "reserve_address",
        "price": "token_slug",
    }
    parts = [
        cat.tables[t].agg(
            F.lit(t).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.min(c).alias("lowest"),
            F.max(c).alias("highest"),
        )
        for t, c in labels.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


catalog_query(
    "scan_backed_reserves",
    lambda cat: network_config.backed_reserves(cat, "AFRICA", ["Brand#1_AFRICA", "Brand#11_AFRICA"]),
)
catalog_query("scan_impl_by_network", lambda cat: network_config.scan_impl_by_network(cat, "EUROPE"))


@query("network_config")
def network_config_flat(spark, sf_dir):
    """The rows of all networks' documents."""
    entries = network_config.network_config(fixtures.catalog(spark, sf_dir))
    token, held = F.col("token"), F.col("reserve")
    return entries.select(
        "network",
        F.when(token.isNotNull(), "token").otherwise("reserve").alias("kind"),
        F.coalesce(token["slug"], held["slug"]).alias("slug"),
        F.coalesce(token["address"], held["address"]).alias("address"),
        F.coalesce(token["decimals"], held["collateral_token"]["decimals"]).alias("decimals"),
        held["id"].alias("id"),
        held["collateral_token"]["slug"].alias("collateral"),
        held["derivative_token"]["slug"].alias("derivative"),
    )


@query("scan_blocks")
def scan_blocks(spark, sf_dir):
    start = chain.start_height(2, prune_height=5)
    found = chain.scan_range(chain.read_blocks(spark, f"{fixtures.stage_chain(spark, sf_dir)}/blocks"), start)
    return found.select("height", "hash", "time", F.size("tx").alias("transactions"))


def _blocks(spark, sf_dir):
    return fixtures.staged(spark, sf_dir, "blocks")


@query("sink_csv")
def sink_csv(spark, sf_dir):
    """Hits written with a truncating and an appending run, read back as text."""
    found = _blocks(spark, sf_dir)
    middle = found.agg(F.expr("avg(height)").alias("m")).scalar()
    path = fresh_path(spark, "hits-csv")
    chain.write_csv(blocks.staking_outputs(found.where(F.col("height") <= middle)), path, append=False)
    chain.write_csv(blocks.staking_outputs(found.where(F.col("height") > middle)), path, append=True)
    return spark.read.option("header", True).csv(path)


@query("scan_csv_dict")
def scan_csv_dict(spark, sf_dir):
    path = fresh_path(spark, "hits-csv")
    chain.write_csv(blocks.staking_outputs(_blocks(spark, sf_dir)), path, append=False)
    return chain.read_csv(spark, path, "staking_hits")


def _decoded_observations(spark, sf_dir, shift_days=0):
    """Valid balances of the landed observations, optionally moved to earlier days."""
    observations = fixtures.staged(spark, sf_dir, "observations")
    amount = scalars.hex_uint(F.get_json_object("payload", "$.result"))
    return observations.select(
        "seq",
        "token_implementation",
        "observed_at",
        F.date_sub("effective_day", shift_days).alias("effective_day"),
        "is_final",
        scalars.shift_point(amount, F.lit(8)).alias("balance"),
    )


@query("upsert_token_balances")
def upsert_token_balances(spark, sf_dir):
    path = fixtures.monthly_copy(spark, sf_dir, "token_balances", "upsert")
    polled = _decoded_observations(spark, sf_dir, fixtures.UPSERT_SHIFT_DAYS)
    incoming = decode.daily_last(polled).drop("observed_at").withColumn("run", F.lit(0))

    def merge(existing, rows):
        return upsert.upsert_token_balances(existing, rows, ["run"], inserted_at())

    tables.upsert_months(spark, path, "token_balances", incoming, merge)
    # Ids of new rows are hashes; the comparison keeps those of the old rows.
    result = tables.read_table(spark, path, "token_balances")
    new = F.col("created_at") == inserted_at()
    return result.withColumn("id", F.when(~new, F.col("id")))


def _incoming_reserves(spark, sf_dir):
    """Events as polls of the reserves; some lack a part of the key."""
    cat = fixtures.catalog(spark, sf_dir)
    polled = fixtures.poll_base(spark, sf_dir).select(
        "seq",
        F.date_sub("effective_day", fixtures.UPSERT_SHIFT_DAYS).alias("date"),
        F.concat(F.lit("Brand#"), F.col("b").cast("string"), F.lit("_"), "r_name").alias("collateral_token"),
        (F.col("u") / 100).cast("decimal(20,8)").alias("balance"),
        (F.col("event_type") == "click").alias("no_derivative"),
    )
    # One reserve per collateral: the one of the lowest id.
    chosen = cat.reserve_implementations.groupBy("collateral_token").agg(
        F.min_by(
            F.struct(
                F.col("id").alias("reserve_implementation_id"),
                "reserve_network",
                "reserve_address",
                "derivative_token",
            ),
            "id",
        ).alias("r")
    )
    return polled.join(cat.per_implementation(chosen), "collateral_token").select(
        "date",
        "balance",
        F.col("r.reserve_implementation_id"),
        F.col("r.reserve_network"),
        "collateral_token",
        F.when(~F.col("no_derivative"), F.col("r.derivative_token")).alias("derivative_token"),
        F.col("r.reserve_address"),
        "seq",
    )


@query("upsert_reserve_balances")
def upsert_reserve_balances(spark, sf_dir):
    # Rows without a full key are appended by every run, so each run has its table.
    path = fresh_path(spark, "reserve_balances")
    tables.write_monthly(fixtures.catalog(spark, sf_dir).reserve_balances, path, by_month=True)

    def merge(existing, rows):
        return upsert.upsert_reserve_balances(existing, rows, ["seq"], inserted_at())

    tables.upsert_months(spark, path, "reserve_balances", _incoming_reserves(spark, sf_dir), merge)
    return tables.read_table(spark, path, "reserve_balances")


def _mixed_polls(spark, sf_dir):
    """Catalog, polls, rules and objects of the mixed sources."""
    sources = fixtures.mixed_sources(source_config.default_sources())
    return (
        with_addresses(fixtures.catalog(spark, sf_dir), ADDRESS_FORMS["mixed"]),
        fixtures.mixed_polls(spark, sf_dir, sources),
        source_config.source_config(spark, sources),
        fixtures.object_polls(spark, sf_dir),
    )


def _mixed(spark, sf_dir):
    cat, polls, config, objects = _mixed_polls(spark, sf_dir)
    return decode.decode_observations(cat, polls, config, objects=objects)


@query("poll_to_balances")
def poll_to_balances(spark, sf_dir):
    """Mixed polls, good and bad, in two batches that share their days, into a table with old rows."""
    cat, polls, config, objects = _mixed_polls(spark, sf_dir)
    polls = polls.withColumn("effective_day", F.date_sub("effective_day", fixtures.UPSERT_SHIFT_DAYS))
    balances = fresh_path(spark, "polled-balances")
    tables.write_monthly(cat.token_balances, balances, by_month=True)
    values, dead = fresh_path(spark, "daily-values"), fresh_path(spark, "dead")
    tables.create_table(spark, values, "daily_values")
    for k in (1, 0):
        part = polls.where(F.col("seq") % 2 == k)
        ingest.ingest_polls(cat, part, config, values, balances, dead, inserted_at(), str(k), objects)
    result = tables.read_table(spark, balances, "token_balances")
    return result.withColumn("id", F.when(F.col("created_at") != inserted_at(), F.col("id")))


@query("replayed_letters")
def replayed_letters(spark, sf_dir):
    """Polls of which one network is unknown at first, and again once it is known."""
    cat, polls, config, objects = _mixed_polls(spark, sf_dir)
    polls = polls.withColumn("effective_day", F.date_sub("effective_day", fixtures.UPSERT_SHIFT_DAYS))
    balances = fresh_path(spark, "replayed-balances")
    tables.write_monthly(cat.token_balances, balances, by_month=True)
    values, dead = fresh_path(spark, "daily-values"), fresh_path(spark, "dead")
    tables.create_table(spark, values, "daily_values")
    known = cat.token_implementations.where("network <> 'EUROPE'")
    before = Catalog(spark, {**cat.tables, "token_implementations": known}, cat.as_of)
    ingest.ingest_polls(before, polls, config, values, balances, dead, inserted_at(), "0", objects)
    for _ in range(2):
        ingest.replay_dead_letters(cat, config, values, balances, dead, inserted_at(), objects)
    result = tables.read_table(spark, balances, "token_balances")
    return result.withColumn("id", F.when(F.col("created_at") != inserted_at(), F.col("id")))


@query("poll_to_reserves")
def poll_to_reserves(spark, sf_dir):
    """Reserve polls into the reserve table, of the networks that report them."""
    polls = _reserve_polls(spark, sf_dir).withColumn(
        "date", F.date_sub("effective_day", fixtures.UPSERT_SHIFT_DAYS)
    )
    cat = fixtures.catalog(spark, sf_dir)
    balances = fresh_path(spark, "polled-reserves")
    tables.write_monthly(cat.reserve_balances, balances, by_month=True)
    networks = ("AFRICA", "ASIA", "EUROPE")
    ingest.ingest_reserves(cat, polls, balances, fresh_path(spark, "dead"), inserted_at(), networks=networks)
    return tables.read_table(spark, balances, "reserve_balances")


@query("dead_letter")
def dead_letter(spark, sf_dir):
    return decode.quarantined(_mixed(spark, sf_dir)).select("seq", "source", "token_implementation", "reason")


# Cuts of the polls in the order in which they are merged: later ones first.
POLL_CUTS = (2, 0, 1)


def _kept_after_polls(spark, sf_dir):
    """Catalog over kept tables after the shifted polls came in cuts, none of them in order.

    Polls that come again change nothing, so one copy serves every run.
    """
    root = fixtures.kept_copy(spark, sf_dir, "polled")
    cat = Catalog.from_parquet(spark, root, fixtures.AS_OF)
    values = fresh_path(spark, "daily-values")
    tables.create_table(spark, values, "daily_values")
    follow = maintain.followers(cat, root, "token_balances")
    write = daily.write_daily_values(spark, values, f"{root}/token_balances", inserted_at(), follow)
    polled = _decoded_observations(spark, sf_dir, fixtures.UPSERT_SHIFT_DAYS)
    for cut in POLL_CUTS:
        write(daily.finalize_day(polled.where(F.col("seq") % len(POLL_CUTS) == cut)), cut)
    return cat.reopened()


@query("kept_latest_supplies")
def kept_latest_supplies(spark, sf_dir):
    """Current supplies from the kept latest rows, after polls that came in cuts."""
    return supplies.current_supplies_by_tokenimpl(_kept_after_polls(spark, sf_dir))


@query("kept_adjusted_history")
def kept_adjusted_history(spark, sf_dir):
    """The adjusted history as the upserts keep it, after polls that came in cuts."""
    result = adjust.adjusted_history(_kept_after_polls(spark, sf_dir))
    return result.withColumn("id", F.when(F.col("created_at") != inserted_at(), F.col("id")))


@query("kept_latest_reserves")
def kept_latest_reserves(spark, sf_dir):
    """Current reserves from the kept latest rows, after reserve polls."""
    # Rows without a full key are appended by every run; none of them has a latest row.
    root = fixtures.kept_copy(spark, sf_dir, "reserves")
    cat = Catalog.from_parquet(spark, root, fixtures.AS_OF)
    maintain.upsert_reserves(cat, root, _incoming_reserves(spark, sf_dir), ["seq"], inserted_at())
    return reserves.current_reserves_by_tokenimpl(cat.reopened())


catalog_query("supply_usd_current", usd.current_supply_usd)
# Prices known a day late, so that every supply takes an earlier one.
catalog_query("supply_usd_history", lambda cat: usd.historical_supply_usd(cat, "slug", delay_days=1))


@query("decode_observations")
def decode_observations(spark, sf_dir):
    return decode.valid_balances(_mixed(spark, sf_dir)).drop("observed_at")


@query("resume_checkpoint")
def resume_checkpoint(spark, sf_dir):
    """A scan that stops half way and one that goes on after the last finished block."""
    found = _blocks(spark, sf_dir)
    middle = found.agg(F.expr("avg(height)").alias("m")).scalar()
    path, done = fresh_path(spark, "hits"), fresh_path(spark, "done")
    first = found.where(F.col("height") <= middle)
    blocks.staking_outputs(first).write.mode("append").parquet(path)
    first.agg(F.max("height").alias("height")).write.mode("append").parquet(done)
    rest = chain.scan_after(found, spark.read.parquet(done))
    blocks.staking_outputs(rest).write.mode("append").parquet(path)
    return spark.read.parquet(path)


# Two prefixes within another, and one of other scripts.
PREFIXES = {"6a": "data", blocks.STAKING_PREFIX: "staking", "6A24aa21A9ed": "commitment", "0014": "key"}


@query("staking_outputs_by_prefix")
def staking_outputs_by_prefix(spark, sf_dir):
    """All outputs whose script starts with one of several prefixes, in one scan."""
    return blocks.staking_outputs_by_prefix(_blocks(spark, sf_dir), blocks.prefix_table(spark, PREFIXES))


def _finished_intervals(spark, sf_dir):
    """Each block with a hit stands for a scan of some heights around it; they overlap and leave gaps."""
    hits = blocks.staking_outputs(_blocks(spark, sf_dir)).select("block_height")
    reach = F.col("block_height") % 3
    return hits.select((F.col("block_height") - reach).alias("first"), (F.col("block_height") + 2 - reach).alias("last"))


@query("covered_intervals")
def covered_intervals(spark, sf_dir):
    return chain.covered_intervals(_finished_intervals(spark, sf_dir))


@query("scan_uncovered")
def scan_uncovered(spark, sf_dir):
    """Blocks that no finished interval holds, below, between and above them."""
    return chain.scan_uncovered(_blocks(spark, sf_dir), _finished_intervals(spark, sf_dir)).select("height", "hash")


catalog_query(
    "endpoint_read",
    lambda cat: cat.view("top_gainers_by_tokenimpl_absolute", {"period": "eq.weekly"}),
)


def _ordered(view: str, *columns: str) -> None:
    @query(f"ordered_{view}")
    def run(spark, sf_dir):
        """Places of the rows in the published order; equal rows of the order are alike here."""
        rows = fixtures.catalog(spark, sf_dir).ordered(view).select(*columns)
        return rows.coalesce(1).withColumn("place", F.monotonically_increasing_id())


_ordered("current_supplies_by_network", "total_balance")
_ordered("top_gainers_by_tokenimpl", "period", "percent_change")
_ordered("historical_supplies_by_tokenimpl", "project_rank", "network_rank", "date")
_ordered("helper_token_balances_adjusted", "date", "token_implementation")


@query("observation_source")
def observation_source(spark, sf_dir):
    return fixtures.staged(spark, sf_dir, "observations").drop("source")


# ---------------------------------------------------------------- joins


@query("join_star_inner")
def join_star_inner(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    facts = cat.token_balances.select("date", "token_implementation", "balance")
    return star.describe(cat, facts).select("date", "token_implementation", "balance", *star.DESCRIPTION)


@query("join_left_dims")
def join_left_dims(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    impls = cat.token_implementations.select(F.col("slug").alias("token_implementation"), "network_origin")
    origins = cat.networks.select(
        F.col("slug").alias("network_origin"), F.col("name").alias("origin_name")
    )
    ranks = supplies.current_supplies_by_network(cat).select(
        F.col("network_slug").alias("network_origin"), F.col("rank").alias("origin_rank")
    )
    dim = impls.join(cat.small(origins, "networks"), "network_origin", "left").join(
        cat.small(ranks, "networks"), "network_origin", "left"
    )
    facts = cat.token_balances.select("date", "token_implementation", "balance")
    return facts.join(cat.per_implementation(dim), "token_implementation", "left").select(
        "date", "token_implementation", "balance", "origin_name", "origin_rank"
    )


@query("join_left_adjust")
def join_left_adjust(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    facts = cat.token_balances.select("date", "token_implementation", "balance")
    edges = cat.per_implementation(adjust.bridge_edges(cat))
    totals = adjust.children_totals(facts, edges, ("date",))
    return facts.join(totals, ["token_implementation", "date"], "left")


@query("join_left_adjust_current")
def join_left_adjust_current(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    recent = supplies.recent_pegged_balances(cat).drop("parent")
    totals = adjust.children_totals(recent, cat.per_implementation(adjust.bridge_edges(cat)))
    return recent.join(cat.per_implementation(totals), "token_implementation", "left")


@query("join_left_reserve")
def join_left_reserve(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    held = reserves.recent_reserves(cat).select(
        "token_implementation", F.col("balance").alias("reserve_balance")
    )
    return supplies.recent_balances(cat).join(held, "token_implementation", "left")


@query("join_left_past")
def join_left_past(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    return supplies.recent_pegged_balances(cat).drop("parent").join(
        gainers.past_balances(cat), "token_implementation", "left"
    )


@query("join_array_any")
def join_array_any(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    edges = adjust.edges_from_arrays(adjust.helper_dependencies_bridges(cat))
    facts = cat.token_balances.select(F.col("token_implementation").alias("child"), "date", "balance")
    return facts.join(cat.per_implementation(edges), "child")


catalog_query("join_cross_periods", gainers.implementation_periods)


@query("join_correlated_max")
def join_correlated_max(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    facts = cat.reserve_balances.select(
        "derivative_token", "date", "reserve_address", "collateral_token", "balance"
    )
    return latest.latest_with_ties(facts, "derivative_token", "date", cat.per_implementation)


@query("asof_block")
def asof_block(spark, sf_dir):
    """Per event: the last block of the next chain at or before the event's second."""
    chain_blocks = fixtures.staged(spark, sf_dir, "chain_blocks")
    asked = chain_blocks.select(
        F.col("height").alias("request"),
        F.when(F.col("network") == "chain_view", "chain_click").otherwise("chain_view").alias("network"),
        "ts",
    )
    return asof.asof_block(chain_blocks, asked)


catalog_query("join_reserve_to_impl", decode.impl_fallback_reserve)


@query("join_tx_lookup")
def join_tx_lookup(spark, sf_dir):
    found = _blocks(spark, sf_dir)
    hits = blocks.staking_outputs(found).select("block_height", "block_hash", "txid")
    return blocks.lookup_transactions(found, hits).drop("found")


# ---------------------------------------------------------------- aggregates, windows


catalog_query(
    "agg_sum",
    lambda cat: cat.reserve_balances.groupBy("collateral_token", "reserve_network").agg(
        F.sum("balance").cast("decimal(38,8)").alias("total_balance")
    ),
)
catalog_query(
    "agg_max_date",
    lambda cat: cat.token_balances.groupBy("token_implementation").agg(F.max("date").alias("latest_date")),
)
catalog_query(
    "agg_array",
    lambda cat: cat.token_implementations.groupBy("token", "network_origin").agg(
        F.array_sort(F.collect_list("slug")).alias("slugs")
    ),
)
catalog_query(
    "agg_array_distinct",
    lambda cat: star.describe(cat, cat.token_balances.select("token_implementation", "date"))
    .groupBy("date", "network_slug")
    .agg(
        scalars.distinct_array(F.col("token_address")).alias("token_addresses"),
        scalars.distinct_array(F.col("explorer")).alias("explorers"),
    ),
)


@query("agg_sum_by_derivative")
def agg_sum_by_derivative(spark, sf_dir):
    return decode.sum_by_derivative(_decode_one(spark, sf_dir, "utxo_sums"))


@query("distinct_first_txid")
def distinct_first_txid(spark, sf_dir):
    """First output per transaction id over all outputs, hits or not."""
    outputs = blocks.staking_hits(_blocks(spark, sf_dir), prefix="")
    order = ["block_height", "tx_index", "vout_index"]
    return latest.first_per_key(outputs, "txid", order, ["block_height", "block_hash", "value"])


catalog_query(
    "rank_global",
    lambda cat: ranking.with_rank(
        cat.token_balances.select("date", "token_implementation", "balance"), "balance"
    ),
)
catalog_query(
    "rank_over_aggregate",
    lambda cat: ranking.with_rank(
        cat.reserve_balances.groupBy("reserve_address").agg(
            F.sum("balance").cast("decimal(38,8)").alias("total_balance")
        ),
        "total_balance",
    ),
)
catalog_query(
    "rank_in_partition",
    lambda cat: ranking.with_rank(
        cat.token_balances.select("date", "token_implementation", "balance"),
        "balance",
        within=["date"],
        max_group_rows=cat.implementation_rows,
    ),
)


@query("rank_in_period")
def rank_in_period(spark, sf_dir):
    """Rank within the period, one period being NULL, by the counting form."""
    cat = fixtures.catalog(spark, sf_dir)
    rows = supplies.recent_pegged_balances(cat).join(
        gainers.past_balances(cat), "token_implementation", "left"
    )
    return ranking.with_rank(
        rows.select("token_implementation", "period", "past_balance"), "past_balance", within=["period"]
    )


catalog_query(
    "row_number_latest",
    lambda cat: latest.row_number_latest(
        cat.token_balances.select("token_implementation", "date", "balance"), "token_implementation", "date"
    ),
)


@query("topk_latest")
def topk_latest(spark, sf_dir):
    """The ten latest and largest reserve rows: a report with a limit."""
    facts = fixtures.catalog(spark, sf_dir).reserve_balances.select(
        "date", "balance", "reserve_address", "collateral_token"
    )
    order = [F.desc("date"), F.desc("balance"), F.asc("reserve_address"), F.asc("collateral_token")]
    return facts.orderBy(*order).limit(10)


catalog_query(
    "union_all_periods",
    lambda cat: cat.token_balances.select(F.col("date").alias("as_of"))
    .distinct()
    .select("as_of", F.inline(scalars.period_anchors(F.col("as_of")))),
)


# ---------------------------------------------------------------- blocks


@query("staking_outputs")
def staking_outputs(spark, sf_dir):
    return blocks.staking_outputs(_blocks(spark, sf_dir))


@query("staking_values")
def staking_values(spark, sf_dir):
    found = _blocks(spark, sf_dir)
    return blocks.staking_values(found, blocks.staking_outputs(found))


@query("staking_outputs_onepass")
def staking_outputs_onepass(spark, sf_dir):
    return blocks.staking_outputs_onepass(_blocks(spark, sf_dir))


@query("sui_fallback_objects")
def sui_fallback_objects(spark, sf_dir):
    cat = fixtures.catalog(spark, sf_dir)
    return decode.object_fallback(cat.token_implementations, fixtures.object_polls(spark, sf_dir))


@query("skipped_blocks")
def skipped_blocks(spark, sf_dir):
    """Heights to scan again after some blocks were lost or came without transactions."""
    found = _blocks(spark, sf_dir)
    top = found.agg(F.max("height")).first()[0]
    tx = F.when(F.col("height") % 11 != 5, F.col("tx"))
    return blocks.skipped_blocks(found.where("height % 7 <> 3").withColumn("tx", tx), 0, top)


@query("missing_transactions")
def missing_transactions(spark, sf_dir):
    """Hits looked up in blocks of which some have lost their transactions."""
    found = _blocks(spark, sf_dir)
    hits = blocks.staking_outputs(found)
    kept = F.filter("tx", lambda t: F.col("height") % 11 != 5)
    return blocks.missing_transactions(found.withColumn("tx", kept), hits)


# ---------------------------------------------------------------- decoders

# Address forms that the stricter decoders ask for, over the fixture's text.
ADDRESS_FORMS = {
    "evm_hex_default18": "concat('0x', lpad(substr(token_address, 3), 40, '0'))",
    "unminted_cap": "concat('0x', lpad(substr(token_address, 3), 40, '0'))",
    "clarity_hex": "concat(token_address, '.contract')",
    "mixed": "token_address",
}
# Tokens of one region keep the plain text and so have no valid form.
PLAIN_REGION = "MIDDLE EAST"

DECODER_SOURCES = {
    "evm_hex": "Arbitrum",
    "evm_int": "BEVM",
    "evm_hex_default18": "Rootstock",
    "evm_hex_any_places": "Botanix",
    "native_cap": "Rootstock",
    "unminted_cap": "Hyperliquid",
    "explorer_json": "Rollux",
    "explorer_self": "Mezo",
    "token_amount": "Solana",
    "felt_hex": "Starknet",
    "clarity_hex": "Stacks",
    "coin_value": "Sui",
    "object_or_number": "Tron",
    "metrics_text": "InternetComputer",
    "asset_string": "Libre",
    "capacity_or_series": "Lightning",
    "bare_sats": "Liquid",
    "active_tvl": "Babylon",
    "staked_amount": "CoreStaking",
    "utxo_sums": "BitcoinReserves",
}


def with_addresses(cat: Catalog, form: str) -> Catalog:
    impls = cat.token_implementations.withColumn(
        "token_address",
        F.when(F.col("network") == PLAIN_REGION, F.col("token_address")).otherwise(F.expr(form)),
    )
    return Catalog(cat.spark, {**cat.tables, "token_implementations": impls}, cat.as_of)


def _decode_one(spark, sf_dir, decoder):
    cat = fixtures.catalog(spark, sf_dir)
    if decoder in ADDRESS_FORMS:
        cat = with_addresses(cat, ADDRESS_FORMS[decoder])
    source = DECODER_SOURCES[decoder]
    if decoder == "asset_string":
        # Its payloads name symbols, which only such slugs have.
        slug = F.expr("concat('Proj-Tok', substr(token, 7), '_', network)")
        impls = cat.token_implementations.withColumn("slug", slug)
        cat = Catalog(cat.spark, {**cat.tables, "token_implementations": impls}, cat.as_of)
    row = (source, None, decoder, source in source_config.KEEP_ZERO, False, False, None, None, None, None)
    return decode.decode_observations(
        cat,
        fixtures.polls(spark, sf_dir, decoder, source),
        source_config.source_config(spark, [row]),
        [decoder],
        fixtures.object_polls(spark, sf_dir) if decoder == "coin_value" else None,
    )


def _decoder_query(decoder: str) -> None:
    @query(f"decode_{decoder}")
    def run(spark, sf_dir):
        decoded = _decode_one(spark, sf_dir, decoder)
        kept = F.when(F.col("reason").isNull(), F.col("balance"))
        return decoded.select("seq", "token_implementation", kept.alias("balance"), "reason")


for _decoder in DECODER_SOURCES:
    _decoder_query(_decoder)


def _reserve_polls(spark, sf_dir):
    """Events as polls of the reserves, each of some supplier and brand."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    total = suppliers.agg(F.max("s_suppkey")).scalar()
    return fixtures.poll_base(spark, sf_dir).select(
        "seq",
        ((F.col("seq") % total + 1) * 100 + F.col("b")).cast("int").alias("reserve_implementation_id"),
        "effective_day",
        F.expr(fixtures.PAYLOADS["evm_hex"]).alias("payload"),
        "status",
    )


@query("decode_evm_reserve")
def decode_evm_reserve(spark, sf_dir):
    cat, polls = fixtures.catalog(spark, sf_dir), _reserve_polls(spark, sf_dir)
    decoded = decode.decode_reserves(cat, polls)
    kept = F.when(F.col("reason").isNull(), F.col("balance"))
    return decoded.select(
        "seq",
        "reserve_implementation_id",
        "reserve_address",
        "collateral_token",
        "derivative_token",
        kept.alias("balance"),
        "reason",
    )


@query("assign_day")
def assign_day(spark, sf_dir):
    """Stored day and block second of every event taken as a run of some source and kind."""
    sources = source_config.default_sources()
    names = F.array(*[F.lit(s[0]) for s in sources])
    runs = fixtures.poll_base(spark, sf_dir).select(
        "seq",
        F.element_at(names, (F.col("seq") % len(sources) + 1).cast("int")).alias("source"),
        F.when(F.col("event_type") == "view", "incremental")
        .when(F.col("event_type") == "error", "final")
        .otherwise(F.col("event_type"))
        .alias("invocation"),
        "observed_at",
    )
    stamped = decode.stamp_runs(runs, source_config.source_config(spark, sources))
    return stamped.select("seq", "source", "invocation", "day", "block_second")


# ---------------------------------------------------------------- scalar functions


@query("fn_percent_change")
def fn_percent_change(spark, sf_dir):
    """Percent change of every balance against its token's price of the day."""
    cat = fixtures.catalog(spark, sf_dir)
    impls = cat.token_implementations.select(F.col("slug").alias("token_implementation"), "token")
    facts = cat.token_balances.join(cat.per_implementation(impls), "token_implementation")
    prices_of_day = cat.price.select("date", F.col("token_slug").alias("token"), "price_usd")
    change = scalars.percent_change(F.col("balance"), F.col("price_usd").cast("decimal(20,8)"))
    return facts.join(prices_of_day, ["date", "token"]).select(
        "date", "token_implementation", change.alias("percent_change")
    )


@query("fn_hex_uint")
def fn_hex_uint(spark, sf_dir):
    """Hex texts of up to 32 digits, some beyond 38 decimal digits, some no hex."""
    base = fixtures.poll_base(spark, sf_dir)
    high = F.lower(F.hex(F.col("u") * F.col("seq") * 100000))
    text = F.when(F.col("bad"), F.lit("0x")).otherwise(F.concat(F.lit("0x"), high, F.lpad(F.lower(F.hex("n")), 16, "0")))
    number = scalars.hex_uint(text)
    return base.select("seq", text.alias("text"), number.cast("string").alias("number"))


@query("fn_text")
def fn_text(spark, sf_dir):
    """Address padding, slug pieces, lists and NULL-skipping concat over the events."""
    base = fixtures.poll_base(spark, sf_dir)
    slug = F.concat(F.lit("Proj-Tok"), F.col("b").cast("string"), F.lit("_"), "r_name")
    origin = F.when(F.col("k") != 0, F.col("r_name"))
    address = F.concat(F.lit("0x"), F.upper(F.hex("u")))
    return base.select(
        "seq",
        scalars.pad_address(address).alias("padded"),
        scalars.pad_address(address, strip="first", lower=False).alias("padded_case"),
        scalars.symbol_of_slug(slug).alias("symbol"),
        scalars.concat_skip_null(slug, F.lit("_"), origin).alias("joined"),
        scalars.comma_list(F.concat(F.lit(" a, ,"), F.col("event_type"), F.lit(" ,"))).alias("entries"),
        scalars.split_exactly(F.concat_ws(".", F.col("event_type"), origin), ".", 2, 1).alias("piece"),
        scalars.iso_from_epoch(scalars.epoch_seconds(F.col("observed_at"))).alias("iso"),
    )


# ---------------------------------------------------------------- data rules


@query("check_unique")
def check_unique(spark, sf_dir):
    """The model's keys, and the raw observations, which repeat theirs."""
    cat = fixtures.catalog(spark, sf_dir)
    raw = fixtures.staged(spark, sf_dir, "observations")
    return quality.check_unique(cat).unionByName(
        quality.duplicate_keys(raw, ["token_implementation", "effective_day"], "observations")
    )


@query("check_fk")
def check_fk(spark, sf_dir):
    """The model's references, and polls that also name unknown tokens."""
    cat = fixtures.catalog(spark, sf_dir)
    slug = F.concat(F.lit("Brand#"), (F.col("user_id") % 30).cast("string"), F.lit("_"), "r_name")
    raw = fixtures.poll_base(spark, sf_dir).select(slug.alias("token_implementation"))
    return quality.check_fk(cat).unionByName(
        quality.orphans(raw, "token_implementation", cat.token_implementations, "slug", "polls")
    )


def _left_balances(cat):
    """Token and reserve balances in one form."""
    supply = cat.token_balances.select(
        F.lit("token").alias("kind"), "date", F.col("token_implementation").alias("holder"),
        F.lit(None).cast("string").alias("address"), "balance",
    )
    held = cat.reserve_balances.select(
        F.lit("reserve").alias("kind"), "date", F.col("collateral_token").alias("holder"),
        F.col("reserve_address").alias("address"), "balance",
    )
    return supply.unionByName(held)


def _doomed():
    return {"networks": F.col("slug") == "ASIA", "tokens": F.col("depegged")}


@query("cascade_delete")
def cascade_delete(spark, sf_dir):
    """Balances left after deleting a network and the depegged tokens."""
    return _left_balances(quality.cascade_delete(fixtures.catalog(spark, sf_dir), **_doomed()))


@query("cascade_stored")
def cascade_stored(spark, sf_dir):
    """The same delete from the stored month tables."""
    root = fixtures.kept_copy(spark, sf_dir, "cascade")
    cat = Catalog.from_parquet(spark, root, fixtures.AS_OF)
    return _left_balances(constraints.cascade_stored(cat, root, **_doomed()))


@query("checked_upsert")
def checked_upsert(spark, sf_dir):
    """Daily polls of known and unknown implementations: the balances, and the quarantine next to them."""
    root, dead = fixtures.kept_copy(spark, sf_dir, "checked"), fresh_path(spark, "quarantine")
    cat = Catalog.from_parquet(spark, root, fixtures.AS_OF)
    polled = fixtures.poll_base(spark, sf_dir).select(
        F.concat(F.lit("Brand#"), (F.col("user_id") % 30).cast("string"), F.lit("_"), "r_name").alias("token_implementation"),
        F.date_sub("effective_day", fixtures.UPSERT_SHIFT_DAYS).alias("date"),
        (F.col("u") / 100).cast("decimal(20,8)").alias("balance"),
        F.struct("is_final", "observed_at", "seq").alias("place"),
        "seq",
    )
    last = polled.groupBy("token_implementation", "date").agg(
        F.max_by("balance", "place").alias("balance"), F.max("seq").alias("seq")
    )
    constraints.upsert_checked(cat, root, "token_balances", last, ["seq"], dead, "0", inserted_at())
    columns = ["token_implementation", "date", "balance"]
    stored = cat.reopened().token_balances.select(*columns, F.lit(None).cast("string").alias("broken"))
    return stored.unionByName(spark.read.parquet(dead).select(*columns, "broken"))


catalog_query("check_domain", lambda cat: quality.check_domain(cat, ["staking", "liquid_staking"]))


@query("fill_defaults")
def fill_defaults(spark, sf_dir):
    """Depeg flag absent from one load and NULL in another."""
    tokens = fixtures.catalog(spark, sf_dir).tokens
    given = quality.fill_defaults(tokens.select("slug", "depegged"), {"depegged": F.lit(False)})
    absent = quality.fill_defaults(tokens.select("slug"), {"depegged": F.lit(False)})
    return given.withColumn("load", F.lit("given")).unionByName(absent.withColumn("load", F.lit("absent")))


@query("derive_impl_slug")
def derive_impl_slug(spark, sf_dir):
    """Slugs of every token and network met in the reserves, some of them given."""
    held = fixtures.catalog(spark, sf_dir).reserve_implementations.select(
        F.substring_index("collateral_token", "_", 1).alias("token"),
        F.col("reserve_network").alias("network"),
    ).distinct()
    loaded = held.withColumn("slug", F.when(F.col("network") == "ASIA", F.concat(F.lit("given_"), "token")))
    return quality.derive_impl_slug(loaded.withColumn("name", F.lit(None).cast("string")))


# ---------------------------------------------------------------- streams


# Files per batch of the observation streams, so that days are met again in later batches.
FILES_PER_BATCH = 3


def _stream_values(spark, sf_dir, shift_days=0):
    path = f"{fixtures.stage_chain(spark, sf_dir)}/observations"
    amount = scalars.hex_uint(F.get_json_object("payload", "$.result"))
    return daily.stream_observations(spark, path, FILES_PER_BATCH).select(
        "seq",
        "token_implementation",
        F.expr(f"observed_at - make_dt_interval({shift_days})").alias("observed_at"),
        F.date_sub("effective_day", shift_days).alias("effective_day"),
        "is_final",
        scalars.shift_point(amount, F.lit(8)).alias("balance"),
    )


def _drained(spark, candidates, balances=None):
    """Paths of the daily values after the candidates have run into them."""
    path = fresh_path(spark, "daily-values")
    tables.create_table(spark, path, "daily_values")
    daily.stream_daily_values(
        candidates, path, fresh_path(spark, "stream-checkpoint"), inserted_at(), balances
    )
    return path


@query("daily_last_value")
def daily_last_value(spark, sf_dir):
    balances = fresh_path(spark, "stream-balances")
    tables.create_table(spark, balances, "token_balances")
    _drained(spark, daily.daily_last_value(_stream_values(spark, sf_dir)), balances)
    return tables.read_table(spark, balances, "token_balances").drop("id")


@query("finalize_day")
def finalize_day(spark, sf_dir):
    path = _drained(spark, daily.finalize_day(_stream_values(spark, sf_dir)))
    return tables.read_table(spark, path, "daily_values").drop("poll_order")


@query("stream_upsert")
def stream_upsert(spark, sf_dir):
    """Streamed days into a table that already holds some of them."""
    balances = fixtures.monthly_copy(spark, sf_dir, "token_balances", "stream")
    _drained(spark, daily.finalize_day(_stream_values(spark, sf_dir, fixtures.UPSERT_SHIFT_DAYS)), balances)
    return tables.read_table(spark, balances, "token_balances").drop("id")


@query("stream_blocks")
def stream_blocks(spark, sf_dir):
    path = fresh_path(spark, "stream-hits")
    landed = chain.stream_blocks(spark, f"{fixtures.stage_chain(spark, sf_dir)}/blocks", files_per_batch=2)
    daily.stream_staking_outputs(landed, path, fresh_path(spark, "stream-checkpoint"))
    return spark.read.parquet(path)


@query("stream_latest_state")
def stream_latest_state(spark, sf_dir):
    """Latest value per implementation of the streamed polls; a day is polled many times."""
    path = fresh_path(spark, "latest-state")
    tables.create_table(spark, path, "daily_values")
    candidates = daily.finalize_day(_stream_values(spark, sf_dir))
    daily.stream_latest_state(candidates, path, fresh_path(spark, "stream-checkpoint"))
    return tables.read_table(spark, path, "daily_values").drop("poll_order")


@query("stream_latest_store")
def stream_latest_store(spark, sf_dir):
    """The same from the state store of the stream, started twice on one checkpoint."""
    checkpoint = fresh_path(spark, "latest-store")
    candidates = daily.finalize_day(_stream_values(spark, sf_dir))
    for _ in range(2):
        latest_store.stream_latest(candidates, checkpoint)
    return latest_store.read_latest(spark, checkpoint).drop("poll_order")
