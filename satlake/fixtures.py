"""The domain tables, derived from the generic order, event and supplier tables.

Each derived table is written once per session below the shared folder, as it
would lie at rest in production; every query then scans those files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.catalog import Catalog, counted, scan_table
from satlake.functions.scalars import epoch_seconds
from satlake.plans.maintain import build_kept
from satlake.schemas import BASE_TABLES, DDL, schema
from satlake.session import apply_settings, fresh_path, widen
from satlake.sources.tables import ROWS_PER_FILE, write_monthly

# The greatest date of the daily facts at the test scales.
AS_OF = dt.date(2001, 11, 4)

# Days between the events and the last balances, for upserts that hit old rows.
UPSERT_SHIFT_DAYS = 8120

UTXO_SOURCE = "BitcoinReserves"

_roots: dict[tuple[str, str, str], str] = {}
_catalogs: dict[str, Catalog] = {}


def stage(spark: SparkSession, sf_dir: str) -> str:
    """Write the seven base tables of a scale factor, and those kept next to them, once; returns their folder."""
    return _once(spark, sf_dir, "domain", _write_balances)


def stage_chain(spark: SparkSession, sf_dir: str) -> str:
    """Write the block and observation inputs once and return their folder."""
    return _once(spark, sf_dir, "chain", _write_chain)


def _once(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[SparkSession, str, str], None]
) -> str:
    apply_settings(spark)
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _roots:
        root = fresh_path(spark, label)
        write(spark, sf_dir, root)
        _roots[key] = root
    return _roots[key]


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    root = stage(spark, sf_dir)
    if root not in _catalogs:
        _catalogs[root] = Catalog.from_parquet(spark, root, AS_OF)
    return _catalogs[root]


def staged(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the other staged inputs: blocks, chain_blocks, observations."""
    root = stage_chain(spark, sf_dir)
    if table in DDL:
        return scan_table(spark, root, table)
    return spark.read.parquet(f"{root}/{table}")


def _save(df: DataFrame, root: str, table: str) -> None:
    if table in DDL:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(table)])
    df.write.parquet(f"{root}/{table}")


def _save_monthly(df: DataFrame, root: str, table: str, by_month: bool = False) -> None:
    """A fact table in the layout that the upserts write."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(table)]
    write_monthly(df.select(*columns), f"{root}/{table}", by_month=by_month)


def _by_date(df: DataFrame, source_rows: int) -> DataFrame:
    """Range layout on date: a date filter skips files and row groups.

    One task per core, and more of them for more rows.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, source_rows // ROWS_PER_FILE)
    return df.repartitionByRange(tasks, "date", "id").sortWithinPartitions("date")


def _suppliers(read: Callable[[str], DataFrame]) -> DataFrame:
    return (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", F.col("r_regionkey").alias("k"), "r_name")
    )


def _daily_positions(read: Callable[[str], DataFrame], suppliers: DataFrame) -> DataFrame:
    """The line items by day, brand and supplier, in one pass and one shuffle.

    That shuffle goes by ranges of the date, so the files of the positions hold
    a range of dates each and month tables are written from them as they lie.
    """
    return (
        read("lineitem")
        .join(read("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(counted(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("date"),
            "p_brand",
            "k",
            "r_name",
            "s_suppkey",
            "s_name",
            "l_quantity",
            "l_extendedprice",
        )
        .repartitionByRange("date", "s_suppkey")
        .groupBy("date", "p_brand", "k", "r_name", "s_suppkey", "s_name")
        .agg(
            F.sum(F.col("l_quantity").cast("decimal(20,8)")).cast("decimal(20,8)").alias("quantity"),
            F.max(F.col("l_extendedprice").cast("decimal(18,8)")).alias("top_price"),
        )
        .withColumn("b", F.substring("p_brand", 7, 2).cast("int"))
    )


def _write_balances(spark: SparkSession, sf_dir: str, root: str) -> None:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    suppliers = _suppliers(read)
    # Everything below works on daily positions.
    positions = _daily_positions(read, suppliers)
    positions.write.parquet(f"{root}/positions")
    positions = spark.read.parquet(f"{root}/positions")
    rows = positions.count()

    slug = F.concat("p_brand", F.lit("_"), "r_name")
    derivative = F.concat(
        F.lit("Brand#"), (F.floor((F.col("b") - 1) / 5) * 5 + 1).cast("string"), F.lit("_"), "r_name"
    )
    day_number = F.date_diff("date", F.lit("1970-01-01").cast("date"))
    next_quarter_past = F.expr(
        "cast(date_add(date, 1) as timestamp_ntz) + make_dt_interval(0, 0, 15, 0)"
    )

    balances = positions.groupBy("date", "p_brand", "b", "k", "r_name").agg(
        F.sum("quantity").alias("balance")
    ).select(
        "date",
        slug.alias("token_implementation"),
        "balance",
        next_quarter_past.alias("created_at"),
        (day_number * 1000 + F.col("b") * 10 + F.col("k")).alias("id"),
    )
    _save_monthly(balances, root, "token_balances")

    reserve_id = (F.col("s_suppkey") * 100 + F.col("b")).cast("int")
    reserves = positions.select(
        "date",
        F.col("quantity").alias("balance"),
        next_quarter_past.alias("created_at"),
        reserve_id.alias("reserve_implementation_id"),
        F.col("r_name").alias("reserve_network"),
        slug.alias("collateral_token"),
        derivative.alias("derivative_token"),
        F.col("s_name").alias("reserve_address"),
    )
    _save_monthly(reserves, root, "reserve_balances", by_month=True)

    prices = positions.groupBy("date", "p_brand", "b").agg(F.max("top_price").alias("price_usd")).select(
        (day_number * 100 + F.col("b")).alias("id"),
        "date",
        F.col("p_brand").alias("token_slug"),
        F.concat(F.lit("Token "), "p_brand").alias("token_name"),
        "price_usd",
    )
    _save(_by_date(prices, rows), root, "price")

    # The few columns that tell them apart are made distinct before the texts join them.
    held = positions.select("s_suppkey", "p_brand", "b").distinct().join(suppliers, "s_suppkey")
    reserve_impls = held.select(
        reserve_id.alias("id"),
        F.col("s_name").alias("reserve_address"),
        F.col("r_name").alias("reserve_network"),
        derivative.alias("derivative_token"),
        slug.alias("collateral_token"),
        F.col("b").cast("string").alias("tag"),
    ).distinct().withColumn(
        "slug", F.concat("derivative_token", F.lit("__backedby__"), "collateral_token", F.lit("__"), "tag")
    )
    _save(reserve_impls, root, "reserve_implementations")

    # Dimensions: one row per brand and region that occurs, hence one file.
    impls = positions.select("p_brand", "b", "k", "r_name").distinct().selectExpr(
        "concat(p_brand, '_', r_name) as slug",
        "concat(p_brand, '_', r_name) as name",
        "p_brand as token",
        "r_name as network",
        """case when k = 0 then 'native' when k in (1, 2, 3) then 'AFRICA'
                when b % 4 = 0 then null else 'AMERICA' end as network_origin""",
        "case when b % 3 = 0 then '18' else '8' end as token_decimals",
        """case when k = 4 and b % 6 = 0 then null
                else concat(case when k = 2 then 'T' else '0x' end, cast(b * 16 + k as string))
           end as token_address""",
        """concat('["obj', cast(b * 10 + k as string), '_0","obj', cast(b * 10 + k as string),
                  '_1","obj', cast(b * 10 + k as string), '_2"]') as reserve_implementations""",
        "case when k = 0 then 0 else 1 end as degree",
    )
    _save(impls.coalesce(1), root, "token_implementations")

    tokens = positions.select("p_brand", "b").distinct().selectExpr(
        "p_brand as slug",
        "concat('Token ', p_brand) as name",
        "concat('Project ', cast(floor(b / 10) as string)) as project_name",
        "concat('project', cast(floor(b / 10) as string)) as project_slug",
        "p_brand as token_name",
        "p_brand as token_slug",
        """case when b % 5 = 0 then 'staking' when b % 5 = 1 then 'liquid_staking'
                when b % 5 = 2 then null else 'wrapped' end as type""",
        "cast(null as timestamp_ntz) as created_at",
        "case when b % 7 = 0 then true when b % 11 = 0 then null else false end as depegged",
    )
    _save(tokens.coalesce(1), root, "tokens")

    region = read("region")
    networks = region.selectExpr(
        "r_name as slug",
        "concat('Net ', r_name) as name",
        "case when r_regionkey = 4 then null else concat('https://x.example/', r_name) end as explorer",
        "(r_regionkey % 2 = 0) as is_bitcoin_layer",
    ).unionByName(
        spark.range(1).selectExpr(
            "'native' as slug", "'Native' as name", "cast(null as string) as explorer",
            "cast(null as boolean) as is_bitcoin_layer",
        )
    ).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    _save(networks.coalesce(1), root, "networks")
    # Kept from here on by the upserts of the facts.
    build_kept(Catalog.from_parquet(spark, root, AS_OF), root)


def _write_chain(spark: SparkSession, sf_dir: str, root: str) -> None:
    events = widen(spark.read.parquet(f"{sf_dir}/events.parquet"))

    # Ten events make a block: the group is bounded by construction.
    script = F.when(F.col("event_type") == "purchase", "6a4762626e31ff").otherwise("6a24aa21a9ed")
    output = lambda value, hex_text: F.struct(
        value.cast("decimal(16,8)").alias("value"), F.struct(hex_text.alias("hex")).alias("scriptPubKey")
    )
    tx = F.struct(
        F.col("event_id"),
        F.concat(F.lit("tx"), F.col("event_id").cast("string")).alias("txid"),
        F.array(output(F.col("value"), F.lit("0014ab")), output(F.lit(0), script)).alias("vout"),
    )
    height = F.floor(F.col("event_id") / 10).cast("bigint")
    blocks = (
        events.groupBy(height.alias("height"))
        .agg(
            F.max(epoch_seconds(F.col("ts"))).alias("time"),
            F.sort_array(F.collect_list(tx)).alias("tx"),
        )
        .select(
            "height",
            F.concat(F.lit("bh"), F.col("height").cast("string")).alias("hash"),
            "time",
            F.transform("tx", lambda t: F.struct(t["txid"].alias("txid"), t["vout"].alias("vout"))).alias("tx"),
        )
    )
    _save(blocks, root, "blocks")

    # One network per event type; every event is a block of it.
    _save(
        events.select(
            F.concat(F.lit("chain_"), "event_type").alias("network"),
            F.col("event_id").alias("height"),
            epoch_seconds(F.col("ts")).alias("ts"),
        ),
        root,
        "chain_blocks",
    )

    observations = events.selectExpr(
        "event_id as seq",
        "'Arbitrum' as source",
        "concat('Brand#', cast(user_id % 25 + 1 as string), '_AFRICA') as token_implementation",
        "ts as observed_at",
        "cast(ts as date) as effective_day",
        "event_type = 'error' as is_final",
        """concat('{"result":"0x', lower(hex(cast(round(value * 100) as bigint) * 1000000)), '"}')
           as payload""",
        "200 as status",
    )
    _save(observations, root, "observations")


def kept_copy(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A copy of the seven tables with kept latest rows and adjusted history for one upsert job, made once."""

    def write(spark: SparkSession, sf_dir: str, root: str) -> None:
        cat = catalog(spark, sf_dir)
        for table in BASE_TABLES:
            if table in cat.monthly:
                write_monthly(cat.tables[table], f"{root}/{table}", by_month=True)
            else:
                cat.tables[table].write.parquet(f"{root}/{table}")
        build_kept(cat, root)

    return _once(spark, sf_dir, f"kept-{name}", write)


def monthly_copy(spark: SparkSession, sf_dir: str, table: str, name: str) -> str:
    """A month-partitioned copy of a fact table for one upsert job, made once."""

    def write(spark: SparkSession, sf_dir: str, path: str) -> None:
        write_monthly(catalog(spark, sf_dir).tables[table], path, by_month=True)

    return _once(spark, sf_dir, f"{table}-{name}", write)


# Payload texts per decoder as SQL over an event; both Spark and the checking
# engine evaluate them.  n is a whole number that is 0 for some events, e the
# text of an error reply that some events get, hx a 64-digit hex text of n and
# hs one of n below the cap.
PAYLOADS: dict[str, str] = {
    "evm_hex": """case when bad then e else concat('{"jsonrpc":"2.0","id":1,"result":"0x', hx, '"}') end""",
    "evm_int": """case when bad then e else concat('{"result":', cast(n as string), '}') end""",
    "evm_hex_default18": """case when bad then e else concat('{"result":"0x', hx, '"}') end""",
    "evm_hex_any_places": """case when bad then e else concat('{"result":"0x', hx, '"}') end""",
    "native_cap": """case when bad then e else concat('{"result":"0x', hx, '"}') end""",
    "unminted_cap": """case when bad then e else concat('{"result":"0x', hs, '"}') end""",
    "explorer_json": """case when bad then e
        else concat('{"name":"t","total_supply":"', cast(n as string), '"}') end""",
    "explorer_self": """case when bad then e
        else concat('{"total_supply":"', cast(n as string), '","decimals":"18"}') end""",
    "token_amount": """case when bad then e
        else concat('{"result":{"value":{"amount":"', cast(n as string), '","decimals":9}}}') end""",
    "felt_hex": """case when bad then e else concat('{"result":["0x', hx, '","0x0"]}') end""",
    "clarity_hex": """case when bad then concat('{"okay":false,"cause":"x"}')
        else concat('{"okay":true,"result":"0x0701', hx, '"}') end""",
    "coin_value": """case when bad then e
        else concat('{"result":{"value":"', cast(n as string), '"}}') end""",
    "object_or_number": """case when bad then e when event_type = 'view' then cast(u as string)
        else concat('{"totalSupply":', cast(u as string), '.5}') end""",
    "metrics_text": """case when bad then concat('# nothing here') else concat('# HELP ledger', chr(10),
        'ledger_total_supply ', cast(n as string), ' 1700000000', chr(10), 'other 5') end""",
    "asset_string": """case when bad then e else concat('{"Tok', cast(b as string), '":{"supply":"',
        cast(u as string), '.25 TOK"},"X":{"supply":"1 X"}}') end""",
    "capacity_or_series": """case when bad then e when event_type = 'view'
        then concat('{"results":[{"series":[{"values":[["d0",1.5],["d1",', cast(u as string), '.75]]}]}]}')
        else concat('{"networkcapacity":', cast(n as string), '}') end""",
    "bare_sats": """case when bad then e else cast(n as string) end""",
    "active_tvl": """case when bad then e
        else concat('{"data":{"active_tvl":', cast(n as string), '}}') end""",
    "staked_amount": """case when bad then e
        else concat('{"data":{"stakedBTCAmount":"', cast(n as string), '"}}') end""",
    "utxo_sums": """case when bad then e else concat('{"chain_stats":{"funded_txo_sum":',
        cast(n + 5 as string), ',"spent_txo_sum":5}}') end""",
}


def poll_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One poll per event with the parts that the payload texts are made of."""
    events = widen(spark.read.parquet(f"{sf_dir}/events.parquet"))
    regions = spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name")
    parts = events.selectExpr(
        "event_id as seq",
        "event_type",
        "user_id",
        "ts as observed_at",
        "cast(ts as date) as effective_day",
        "event_type = 'error' as is_final",
        "case when event_type = 'signup' and user_id % 10 = 0 then 500 else 200 end as status",
        "cast(user_id % 25 + 1 as int) as b",
        "cast(event_id % 5 as int) as k",
        "cast(round(value * 100) as bigint) as u",
        "event_type = 'click' and user_id % 7 = 0 as bad",
        """concat('{"error":{"code":-32000}}') as e""",
    )
    parts = parts.withColumn(
        "n",
        F.expr(
            """case when event_type = 'signup' and user_id % 4 = 1 then 0
                    else u * 10000000000000 + (seq % 1000003) * 1234567 end"""
        )
    ).withColumns(
        {
            "hx": F.expr("lpad(lower(hex(n)), 64, '0')"),
            "hs": F.expr("lpad(lower(hex(n % 2100000000000000)), 64, '0')"),
        }
    )
    return parts.join(F.broadcast(regions), F.col("k") == F.col("r_regionkey"))  # five regions


def poll_slug(decoder: str) -> str:
    """SQL of the polled implementation: an existing one, or a project-symbol slug."""
    if decoder == "asset_string":
        return "concat('Proj-Tok', cast(b as string), '_', r_name)"
    return "concat('Brand#', cast(b as string), '_', r_name)"


def polls(spark: SparkSession, sf_dir: str, decoder: str, source: str) -> DataFrame:
    """All events as observations of one source in the payload form of its decoder."""
    return poll_base(spark, sf_dir).select(
        "seq",
        # Not a constant: landed rows carry their source, and the join needs its key.
        F.when(F.col("seq").isNotNull(), F.lit(source)).alias("source"),
        F.expr(poll_slug(decoder)).alias("token_implementation"),
        "observed_at",
        "effective_day",
        "is_final",
        F.expr(PAYLOADS[decoder]).alias("payload"),
        "status",
    )


# Networks that two sources of the mixed polls are bound to; the others take any token.
MIXED_NETWORKS = {"Base": "ASIA", "Tron": "EUROPE"}


def mixed_sources(sources: list[tuple]) -> list[tuple]:
    """The source rules with the networks of these tables."""
    return [(source, MIXED_NETWORKS.get(source), *rest) for source, _, *rest in sources]


def object_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects report the greatest number of their events; some report nothing or zero."""
    totals = poll_base(spark, sf_dir).groupBy(
        F.concat(
            F.lit("obj"), (F.col("b") * 10 + F.col("k")).cast("string"), F.lit("_"),
            (F.col("seq") % 3).cast("string"),
        ).alias("object_id"),
        F.col("b"),
        (F.col("seq") % 3).alias("i"),
    ).agg(F.max("n").alias("total"))
    value = F.when((F.col("i") == 1) & (F.col("b") % 3 == 0), F.lit(0)).otherwise(F.col("total"))
    payload = F.when((F.col("i") == 0) & (F.col("b") % 2 == 0), F.lit('{"result":{}}')).otherwise(
        F.concat(
            F.lit(
                '{"result":{"data":{"content":{"fields":{"treasury_cap":{"fields":'
                '{"total_supply":{"fields":{"value":"'
            ),
            value.cast("string"),
            F.lit('"}}}}}}}}}'),
        )
    )
    return totals.select("object_id", payload.alias("payload"))


def mixed_polls(spark: SparkSession, sf_dir: str, sources: list[tuple]) -> DataFrame:
    """Events spread over all sources, each in the payload form of its source."""
    index = F.col("seq") % len(sources)
    payload, slug = F.lit(None).cast("string"), F.lit(None).cast("string")
    source = F.element_at(F.array(*[F.lit(s[0]) for s in sources]), (index + 1).cast("int"))
    for decoder in sorted({s[2] for s in sources}):
        mine = index.isin(*[i for i, s in enumerate(sources) if s[2] == decoder])
        payload = F.when(mine, F.expr(PAYLOADS[decoder])).otherwise(payload)
        slug = F.when(mine, F.expr(poll_slug(decoder))).otherwise(slug)
    return poll_base(spark, sf_dir).select(
        "seq",
        source.alias("source"),
        slug.alias("token_implementation"),
        "observed_at",
        "effective_day",
        "is_final",
        payload.alias("payload"),
        "status",
    )
