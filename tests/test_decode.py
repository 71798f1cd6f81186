import datetime as dt
import json
from decimal import Decimal as D

import pytest
from conftest import day, table
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.functions import scalars
from satlake.operators.quality import fill_defaults
from satlake.plans import decode, ingest
from satlake.schemas import schema
from satlake.sources import tables
from satlake.sources.source_config import default_sources, source_config

EVM = "0x" + "ab" * 20


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


def column(spark, values, fn, ddl="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + ddl)
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


@pytest.mark.parametrize(
    "text",
    ["0x0", "0xff", "FF", "0x" + "0" * 63 + "1", "0xffffffffffffffff", "0x10000000000000000", hex(10**38 - 1), "0x0000", " 0x1 "],
)
def test_hex_is_exact(spark, text):
    assert column(spark, [text], scalars.hex_uint) == [D(int(text, 16))]


@pytest.mark.parametrize("text", ["0x", "", "xyz", "0x12g", None, hex(10**38), hex(2**128), hex(2**256 - 1), "-0x1"])
def test_hex_out_of_range_or_no_hex_is_null(spark, text):
    assert column(spark, [text], scalars.hex_uint) == [None]


def test_shift_point_rounds_once_half_away(spark):
    df = spark.createDataFrame(
        [(1, "5", 9), (2, "4", 9), (3, "123456789", 8), (4, "7", 0), (5, "-5", 9), (6, "1" + "0" * 20, 8),
         (7, "9" * 38, 30), (8, "1", None)],
        "i int, v string, d int",
    )
    got = df.orderBy("i").select(scalars.shift_point(F.col("v").cast("decimal(38,0)"), F.col("d"))).collect()
    assert [r[0] for r in got] == [
        D("0.00000001"), D("0E-8"), D("1.23456789"), D("7"), D("-0.00000001"), None, D("100000000"), None,
    ]


def test_text_helpers(spark):
    assert one(spark, scalars.concat_skip_null(F.lit("a"), F.lit(None), F.lit("b"))) == "ab"
    assert column(spark, ["0xAbC", "0x1" + "0" * 64], scalars.pad_address) == ["abc".rjust(64, "0"), "1" + "0" * 64]
    assert column(spark, ["0xAbC"], lambda c: scalars.pad_address(c, "first", lower=False)) == ["AbC".rjust(64, "0")]
    assert column(spark, ["a.b", "a", "a.b.c"], lambda c: scalars.split_exactly(c, ".", 2, 1)) == ["b", None, None]
    assert column(spark, ["Bit-wBTC_Net", "x"], scalars.symbol_of_slug) == ["wBTC", ""]
    assert column(spark, [" a, ,b ,"], scalars.comma_list) == [["a", "b"]]
    text = "# x\nledger_total_supply_e8s 12 99\nledger_total_supply 13\n"
    assert column(spark, [text, "none"], lambda c: scalars.metric_value(c, "ledger_total_supply")) == ["12", None]
    assert column(spark, ["150000000", "x"], scalars.sats_to_coins) == [D("1.5"), None]
    assert one(spark, scalars.iso_from_epoch(F.lit(1704067199))) == "2023-12-31T23:59:59"
    assert one(spark, scalars.end_of_day_seconds(F.lit(day("2023-12-31")))) == 1704067199


def test_percent_change_ties(spark):
    df = spark.createDataFrame([(D("2.02345"), D("2")), (D("1.97655"), D("2")), (D("1"), D("0")), (D("1"), None)],
                               "r decimal(20,8), p decimal(20,8)")
    got = [r[0] for r in df.select(scalars.percent_change(F.col("r"), F.col("p"))).collect()]
    assert got == [D("1.17"), D("-1.17"), D("0"), D("0")]


def test_effective_day_rules(spark):
    df = spark.createDataFrame([("incremental",), ("final",), ("manual",), (None,)], "v string")
    today = F.lit(day("2024-03-01"))
    got = df.select(
        decode.effective_day(today, F.col("v"), F.lit(False)).alias("a"),
        decode.effective_day(today, F.col("v"), F.lit(True)).alias("b"),
    ).collect()
    now, before = day("2024-03-01"), day("2024-02-29")
    assert [tuple(r) for r in got] == [(now, now), (before, before), (before, now), (now, now)]


def test_runs_are_stamped_by_the_rules_of_their_source(spark):
    at = dt.datetime(2024, 3, 1, 0, 15, 0)
    runs = spark.createDataFrame(
        [(s, i, at) for s in ("Arbitrum", "Sui", "Bitlayer") for i in ("incremental", "final", "manual")],
        "source string, invocation string, observed_at timestamp_ntz",
    )
    day_start, before = 1709251200, day("2024-02-29")
    live, closed = (day("2024-03-01"), day_start + 900), (before, day_start - 1)
    got = table(decode.stamp_runs(runs, source_config(spark)), "source", "invocation", "day", "block_second")
    assert got == [
        ("Arbitrum", "final", *closed), ("Arbitrum", "incremental", *live), ("Arbitrum", "manual", *closed),
        ("Bitlayer", "final", before, day_start - 86400), ("Bitlayer", "incremental", day("2024-03-01"), day_start),
        ("Bitlayer", "manual", before, day_start - 86400),
        ("Sui", "final", *closed), ("Sui", "incremental", *live), ("Sui", "manual", *live),
    ]


def test_all_sources_are_configured():
    rows = default_sources()
    assert len(rows) == 45 and len({r[0] for r in rows}) == 45
    assert {r[2] for r in rows} <= set(decode.DECODERS)


def polls(spark, *rows):
    filled = []
    for i, (source, slug, payload, status) in enumerate(rows):
        text = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
        filled.append((i, source, slug, dt.datetime(2024, 1, 1, 12), day("2024-01-01"), False, text, status))
    return spark.createDataFrame(filled, schema("observations"))


def run(spark, cat, *rows):
    decoded = decode.decode_observations(cat, polls(spark, *rows), source_config(spark))
    return [(r.balance if r.reason is None else None, r.reason) for r in decoded.orderBy("seq").collect()]


@pytest.fixture
def cat(build):
    return (
        build()
        .impl("T", "Arbitrum").impl("T18", "Arbitrum", decimals="18").impl("T0", "Arbitrum", decimals="0")
        .impl("TN", "Arbitrum", decimals=None).impl("TA", "Arbitrum", address="")
        .impl("R", "Rootstock", address=EVM, decimals=None).impl("Rbad", "Rootstock", address="0x12")
        .impl("Rootstock-RBTC", "Rootstock", address=EVM).impl("Botanix-BTC", "Botanix", address=EVM)
        .impl("Unit-UBTC", "Hyperliquid", address=EVM)
        .impl("M", "Mezo").impl("Sol", "Solana").impl("Stk", "Starknet").impl("P", "Stacks", address="SP1.tok")
        .impl("P1", "Stacks", address="SP1").impl("Su", "Sui").impl("Tr", "Tron").impl("ck", "InternetComputer").impl("Lq", "Liquid")
        .impl("Proj-TOK", "Libre").impl("L", "Lightning").impl("B", "Babylon").impl("Core-stakedBTC", "staking")
        .impl("d", "any", slug="d").impl("Mnone", "Mezo", address=None).impl("Mheld", "Mezo", address="")
        .reserve_impl(5, "Mheld_Mezo", "T_Arbitrum").reserve("Mheld_Mezo", "2024-01-01", "3", rid=5)
        .reserve("Mheld_Mezo", "2024-01-02", "4", rid=5, address="b")
        .build()
    )


def test_evm_hex_rules(spark, cat):
    assert run(
        spark, cat,
        ("Arbitrum", "T_Arbitrum", {"result": "0x" + f"{150000000:064x}"}, 200),
        ("Arbitrum", "T18_Arbitrum", {"result": hex(25 * 10**17)}, 500),
        ("Arbitrum", "T0_Arbitrum", {"result": "0x1"}, 200),
        ("Arbitrum", "TN_Arbitrum", {"result": "0x1"}, 200),
        ("Arbitrum", "TA_Arbitrum", {"result": "0x1"}, 200),
        ("Arbitrum", "T_Arbitrum", {"error": {}}, 200),
        ("Arbitrum", "T_Arbitrum", {"result": "0x"}, 200),
        ("Arbitrum", "T_Arbitrum", {"result": "0x0"}, 200),
        ("Arbitrum", "T18_Arbitrum", {"result": "0x1"}, 200),
        ("Arbitrum", "T_Arbitrum", {"result": "0x" + "f" * 64}, 200),
        ("Nowhere", "T_Arbitrum", {"result": "0x1"}, 200),
    ) == [
        (D("1.5"), None), (D("2.5"), None), (None, "no_decimals"), (None, "no_decimals"), (None, "no_address"),
        (None, "no_result"), (None, "not_a_number"), (None, "zero_supply"), (D("0"), None),
        (None, "out_of_range"), (None, "unknown_source"),
    ]


def test_special_tokens_and_caps(spark, cat):
    assert run(
        spark, cat,
        ("Rootstock", "R_Rootstock", {"result": hex(3 * 10**18)}, 200),
        ("Rootstock", "Rbad_Rootstock", {"result": "0x1"}, 200),
        ("Rootstock", "Rootstock-RBTC_Rootstock", {"result": hex(20_999_999 * 10**18 + 5 * 10**17)}, 200),
        ("Botanix", "Botanix-BTC_Botanix", {"result": hex(21_000_000 * 10**18)}, 200),
        ("Hyperliquid", "Unit-UBTC_Hyperliquid", {"result": hex(20_999_000 * 10**8)}, 200),
        ("Hyperliquid", "T_Arbitrum", {"result": "0x1"}, 200),
    ) == [
        (D("3"), None), (None, "bad_address"), (D("0.5"), None), (D("0"), None), (D("1000"), None),
        (None, "unsupported_token"),
    ]


def test_other_payloads(spark, cat):
    series = {"results": [{"series": [{"values": [["a", 1], ["b", 2.5]]}]}]}
    assert run(
        spark, cat,
        ("Mezo", "M_Mezo", {"total_supply": "1500", "decimals": "3"}, 200),
        ("Solana", "Sol_Solana", {"result": {"value": {"amount": "123", "decimals": 2}}}, None),
        ("Starknet", "Stk_Starknet", {"result": [hex(10**8), "0x0"]}, 200),
        ("Stacks", "P_Stacks", {"okay": True, "result": "0x0701" + f"{10**8:032x}"}, 200),
        ("Stacks", "P_Stacks", {"okay": False, "cause": "x"}, 200),
        ("Stacks", "P1_Stacks", {"okay": True, "result": "0x0701" + f"{10**8:032x}"}, 200),
        ("Sui", "Su_Sui", {"result": {"value": "0"}}, 200),
        ("Tron", "Tr_Tron", {"totalSupply": 12.5}, 200),
        ("Tron", "Tr_Tron", "7", 200),
        ("Tron", "Tr_Tron", "7", 503),
        ("InternetComputer", "ck_InternetComputer", "x 1\nledger_total_supply 250000000 1\n", 200),
        ("Libre", "Proj-TOK_Libre", {"TOK": {"supply": "1.25 TOK"}}, 200),
        ("Libre", "Proj-TOK_Libre", {"OTHER": {"supply": "1.25 TOK"}}, 200),
        ("Lightning", "L_Lightning", {"networkcapacity": 100000001}, 200),
        ("Lightning", "L_Lightning", series, 200),
        ("Liquid", "Lq_Liquid", "123456789", 200),
        ("Liquid", "Lq_Liquid", "nonsense", 200),
        ("Babylon", "B_Babylon", {"data": {"active_tvl": 100000000}}, 200),
        ("CoreStaking", "Core-stakedBTC_staking", {"data": {"stakedBTCAmount": "0"}}, 200),
        ("BitcoinReserves", "d", {"chain_stats": {"funded_txo_sum": 500000000, "spent_txo_sum": 100000000}}, 200),
    ) == [
        (D("1.5"), None), (D("1.23"), None), (D("1"), None), (D("1"), None), (None, "not_okay"),
        (None, "bad_address"), (D("0"), None), (D("12.5"), None), (D("7"), None), (None, "bad_status"),
        (D("2.5"), None), (D("1.25"), None), (None, "no_result"), (D("1.00000001"), None), (D("2.5"), None),
        (D("1.23456789"), None), (None, "not_a_number"), (D("1"), None), (D("0"), None), (D("4"), None),
    ]


def test_scope_of_a_poll(spark, cat):
    assert run(
        spark, cat,
        ("Tron", "nobody", "7", 200),
        ("Lightning", "nobody", {"networkcapacity": 1}, 200),
        ("Base", "T_Arbitrum", {"result": "0x1"}, 200),
        ("Hyperliquid", "T_Arbitrum", {"result": "0x1"}, 200),
    ) == [
        (None, "unknown_implementation"), (None, "unknown_implementation"), (None, "wrong_network"),
        (None, "unsupported_token"),
    ]
    undated = polls(spark, ("Tron", "Tr_Tron", "7", 200)).withColumn("effective_day", F.lit(None).cast("date"))
    assert table(decode.decode_observations(cat, undated, source_config(spark)), "reason") == [("no_day",)]


def test_second_places_to_look(spark, cat):
    assert run(
        spark, cat,
        ("Mezo", "Mheld_Mezo", {}, 500),
        ("Mezo", "Mnone_Mezo", {"total_supply": "1", "decimals": "1"}, 200),
    ) == [(D("4"), None), (None, "no_address")]
    listed = cat.token_implementations.withColumn("reserve_implementations", F.lit('["o1"]'))
    value = {"data": {"content": {"fields": {"treasury_cap": {"fields": {"total_supply": {"fields": {"value": "500000000"}}}}}}}}
    objects = spark.createDataFrame([("o1", json.dumps({"result": value}))], "object_id string, payload string")
    sui = Catalog(spark, {**cat.tables, "token_implementations": listed})
    rows = polls(spark, ("Sui", "Su_Sui", {"result": {}}, 200), ("Sui", "Su_Sui", {"result": {"value": "7"}}, 200))
    decoded = decode.decode_observations(sui, rows, source_config(spark), objects=objects)
    assert table(decoded, "seq", "balance", "reason") == [(0, D("5.00000000"), None), (1, D("0.00000007"), None)]


def test_runs_of_unknown_sources_are_named(spark):
    runs = spark.createDataFrame([("Nowhere", "final", dt.datetime(2024, 3, 1))], "source string, invocation string, observed_at timestamp_ntz")
    assert table(decode.stamp_runs(runs, source_config(spark)), "day", "reason") == [(None, "unknown_source")]


def test_polls_end_as_balances_and_rejects(spark, cat, tmp_path):
    values, balances, dead = (str(tmp_path / n) for n in ("values", "balances", "dead"))
    tables.create_table(spark, values, "daily_values")
    tables.create_table(spark, balances, "token_balances")
    good, bad = ("Arbitrum", "T_Arbitrum", {"result": hex(10**8)}, 200), ("Arbitrum", "T_Arbitrum", {"error": {}}, 200)
    stamp = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    for _ in range(2):
        ingest.ingest_polls(cat, polls(spark, good, bad), source_config(spark), values, balances, dead, stamp)
        assert table(tables.read_table(spark, balances, "token_balances"), "token_implementation", "balance") == [
            ("T_Arbitrum", D("1.00000000"))
        ]
        assert table(spark.read.parquet(dead), "seq", "reason") == [(1, "no_result")]
    landing = str(tmp_path / "landing")
    polls(spark, ("Arbitrum", "T_Arbitrum", {"result": hex(2 * 10**8)}, 200), bad).withColumn("seq", F.col("seq") + 10).write.parquet(landing)
    landed = spark.readStream.schema(schema("observations")).parquet(landing)
    ingest.stream_polls(cat, landed, source_config(spark), values, balances, dead + "2", str(tmp_path / "c"), stamp)
    assert table(tables.read_table(spark, balances, "token_balances"), "balance") == [(D("2.00000000"),)]
    assert table(spark.read.parquet(dead + "2"), "seq") == [(11,)]


def test_dead_letters_come_back_once_they_are_valid(spark, cat, tmp_path, monkeypatch):
    values, balances, dead = (str(tmp_path / n) for n in ("values", "balances", "dead"))
    tables.create_table(spark, values, "daily_values")
    tables.create_table(spark, balances, "token_balances")
    stamp = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    config = source_config(spark)
    columns = ("token_implementation", "balance")
    ingest.replay_dead_letters(cat, config, values, balances, dead, stamp)  # nothing has been rejected yet
    rows = polls(
        spark,
        ("Arbitrum", "T_Arbitrum", {"result": hex(10**8)}, 200),
        ("Arbitrum", "T_Arbitrum", {"error": {}}, 200),
        ("Tron", "Tr_Tron", "7", 200),
    )
    unknown = cat.token_implementations.where("network <> 'Arbitrum'")
    before = Catalog(spark, {**cat.tables, "token_implementations": unknown})
    for batch in ("0", "1"):  # a batch that came twice leaves its letters twice
        ingest.ingest_polls(before, rows, config, values, balances, dead, stamp, batch)
    first = table(tables.read_table(spark, balances, "token_balances"), *columns)
    assert [slug for slug, _ in first] == ["Tr_Tron"] and spark.read.parquet(dead).count() == 4

    # Cut off before the old letters go, then run to the end, then run again.
    with monkeypatch.context() as m:
        m.setattr(tables.Folder, "drop", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.replay_dead_letters(cat, config, values, balances, dead, stamp)
    for _ in range(2):
        ingest.replay_dead_letters(cat, config, values, balances, dead, stamp)
        assert table(spark.read.parquet(dead), "seq", "reason") == [(1, "no_result")]
        got = tables.read_table(spark, balances, "token_balances")
        assert table(got, *columns) == sorted([("T_Arbitrum", D("1.00000000")), *first])

    values, at_once = str(tmp_path / "v2"), str(tmp_path / "b2")
    tables.create_table(spark, values, "daily_values")
    tables.create_table(spark, at_once, "token_balances")
    ingest.ingest_polls(cat, rows, config, values, at_once, str(tmp_path / "d2"), stamp)
    assert table(tables.read_table(spark, at_once, "token_balances"), *got.columns) == table(got, *got.columns)


def test_reserve_polls_end_as_balances(spark, cat, tmp_path):
    balances, dead = str(tmp_path / "balances"), str(tmp_path / "dead")
    tables.create_table(spark, balances, "reserve_balances")
    rows = spark.createDataFrame(
        [(1, 5, day("2024-01-01"), '{"result":"0x5f5e100"}', 200), (2, 5, day("2024-01-01"), "{}", 200), (3, 9, day("2024-01-01"), "{}", 200)],
        "seq long, reserve_implementation_id int, date date, payload string, status int",
    )
    networks = [r.reserve_network for r in cat.reserve_implementations.collect()]
    stamp = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    ingest.ingest_reserves(cat, rows, balances, dead, stamp, networks=networks)
    assert table(tables.read_table(spark, balances, "reserve_balances"), "balance") == [(D("1.00000000"),)]
    ingest.ingest_reserves(cat, rows, balances, dead, stamp, networks=["elsewhere"])
    assert table(spark.read.parquet(dead), "seq", "reason") == [
        (1, "unsupported_network"), (2, "no_result"), (3, "no_collateral_token"),
    ]


def test_valid_and_quarantined_split_all_rows(spark, cat):
    rows = polls(spark, ("Arbitrum", "T_Arbitrum", {"result": "0x1"}, 200), ("Arbitrum", "T_Arbitrum", "bad", 200))
    decoded = decode.decode_observations(cat, rows, source_config(spark))
    assert table(decode.valid_balances(decoded), "seq") == [(0,)]
    assert table(decode.quarantined(decoded), "seq", "payload", "reason") == [(1, "bad", "no_result")]


def test_daily_last_prefers_final_then_later(spark):
    def row(seq, hour, final, amount):
        return (seq, "s", "T", dt.datetime(2024, 1, 1, hour), day("2024-01-01"), final, D(amount))

    rows = spark.createDataFrame(
        [row(1, 4, False, "1"), row(2, 8, True, "2"), row(3, 12, False, "3"), row(4, 8, True, "4")],
        "seq long, source string, token_implementation string, observed_at timestamp_ntz, effective_day date,"
        " is_final boolean, balance decimal(20,8)",
    )
    assert table(decode.daily_last(rows), "balance") == [(D("4.00000000"),)]
    assert table(decode.daily_last(rows.where("not is_final")), "balance") == [(D("3.00000000"),)]


def test_object_fallback_takes_first_non_zero_in_order(spark):
    def payload(value):
        inner = {"fields": {"total_supply": {"fields": {"value": value}}}}
        return json.dumps({"result": {"data": {"content": {"fields": {"treasury_cap": inner}}}}})

    tokens = spark.createDataFrame([("t", '["o1","o2","o3"]', "2"), ("u", None, "2")], "slug string, reserve_implementations string, token_decimals string")
    objects = spark.createDataFrame([("o3", payload("300")), ("o2", payload("200")), ("o1", payload("0"))], "object_id string, payload string")
    assert table(decode.object_fallback(tokens, objects), "slug", "object_id", "balance") == [("t", "o2", D("2.00000000"))]


def test_reserve_polls(spark, build):
    cat = build().impl("C", "N").impl("C0", "N", decimals="").reserve_impl(1, "d", "C_N").reserve_impl(2, "d", "C0_N").build()
    rows = spark.createDataFrame(
        [(1, 1, '{"result":"0x5f5e100"}', 200), (2, 2, '{"result":"0x1"}', 200), (3, 9, "{}", 200)],
        "seq long, reserve_implementation_id int, payload string, status int",
    )
    assert table(decode.decode_reserves(cat, rows), "seq", "balance", "reason") == [
        (1, D("1.00000000"), None), (2, None, "no_decimals"), (3, None, "no_collateral_token"),
    ]


def test_sum_by_derivative(spark):
    rows = spark.createDataFrame(
        [("d", day("2024-01-01"), D("1"), None), ("d", day("2024-01-01"), D("2"), None), ("d", day("2024-01-01"), D("9"), "bad")],
        "token_implementation string, effective_day date, balance decimal(20,8), reason string",
    )
    assert table(decode.sum_by_derivative(rows), "balance") == [(D("3.00000000"),)]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([("a", None)], "slug string, depegged boolean")
    assert fill_defaults(df, {"depegged": F.lit(False)}).first().depegged is None
    assert fill_defaults(df.drop("depegged"), {"depegged": F.lit(False)}).first().depegged is False
