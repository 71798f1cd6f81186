import datetime as dt
import random
from datetime import timedelta
from decimal import Decimal as D

import pytest
from conftest import day, table
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.catalog import FACTS, Catalog
from satlake.operators import asof, blocks, latest, quality, ranking, upsert
from satlake.plans import maintain, network_config
from satlake.schemas import BASE_TABLES, schema
from satlake.sources import chain, tables


def test_counting_rank_equals_window_rank(spark):
    rnd = random.Random(7)
    values = [None, D("0"), D("0.00000001"), D("-0.00000001"), D("999999999999.99999999"), D("-5"), D("5")]
    values += [D(rnd.randrange(-50, 50)) / 4 for _ in range(200)] + [D(rnd.randrange(10**15)) / 10**8 for _ in range(200)]
    rows = [(i, None if i % 3 == 0 else "p", values[i % len(values)]) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, p string, v decimal(20,8)")
    for within in ([], ["p"]):
        w = Window.partitionBy(*within).orderBy(F.col("v").desc_nulls_first())
        want = table(df.withColumn("rank", F.rank().over(w).cast("bigint")), "i", "rank")
        assert table(ranking.rank_by_counts(df, "v", within=within), "i", "rank") == want
        assert table(ranking.with_rank(df, "v", within=within, max_group_rows=900), "i", "rank") == want


def test_rank_of_a_narrow_band_with_a_heavy_tie(spark):
    # All values within a thousandth of each other, and a third of the rows alike.
    df = spark.range(30_000).selectExpr(
        "id", "cast(case when id % 3 = 0 then 1000000.5 else 1000000 + id / 30000D end as decimal(20,8)) as v"
    )
    ranked = ranking.rank_by_counts(df, "v")
    want = df.withColumn("want", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())))
    assert ranked.join(want, ["id"]).where("rank <> want").count() == 0
    assert ranked.count() == 30_000


def test_skipped_blocks(spark):
    rows = [(1, "a", 0, []), (2, None, 0, []), (4, "d", 0, None), (4, "d", 0, [])]
    found = spark.createDataFrame(rows, schema("blocks"))
    assert table(blocks.skipped_blocks(found, 0, 5), "height", "reason") == [
        (0, "absent"), (2, "malformed"), (3, "absent"), (5, "absent"),
    ]


def test_latest_forms(spark):
    df = spark.createDataFrame(
        [("a", day("2024-01-01"), 1), ("a", day("2024-01-02"), 2), ("a", day("2024-01-02"), 3), (None, day("2024-01-09"), 4)],
        "k string, d date, v int",
    )
    assert table(latest.latest_with_ties(df, "k", "d"), "v") == [(2,), (3,)]
    assert table(latest.latest_by(df.where("v <> 3"), "k", "d", "v"), "k", "v", "d") == [("a", 2, day("2024-01-02"))]


def brute_asof(block_rows, request_rows):
    found = []
    for n, t in request_rows:
        best = max(((ts, h) for m, h, ts in block_rows if m == n and ts <= t), default=(None, None))
        found.append((n, t, best[1], best[0]))
    return sorted(found, key=str)


def test_latest_rows_of_many_keys_drop_the_old_ones_before_the_shuffle(spark, monkeypatch):
    """The bounds are shared by the keys of a bucket; nothing but speed may hang on them."""
    draw = random.Random(5)
    days = [None, *(day("2024-01-01") + timedelta(d) for d in range(40))]
    rows = [(draw.choice([None, *range(30)]), draw.choice(days), v) for v in range(600)]
    rows += [(99, None, 1000), (98, day("2020-01-01"), 1001), (98, day("2020-01-01"), 1002)]
    tops = {}
    for k, d, _ in rows:
        if k is not None and d is not None:
            tops[k] = max(tops.get(k, d), d)
    wanted = sorted(((v,) for k, d, v in rows if d is not None and tops.get(k) == d), key=str)
    df = spark.createDataFrame(rows, "k int, d date, v int")
    for bounds in (latest.BOUNDS, 7, 1):
        monkeypatch.setattr(latest, "BOUNDS", bounds)
        assert table(latest.latest_with_ties(df, "k", "d"), "v") == wanted
    assert latest.latest_with_ties(df, "k", "d").columns == ["k", "d", "v"]
    # Where the rows meet the bounds is a broadcast whatever their sizes are.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = latest.latest_with_ties(df, "k", "d")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan


def test_asof_against_brute_force(spark):
    rnd = random.Random(3)
    block_rows = [("n%d" % rnd.randrange(3), h, rnd.randrange(0, 200_000)) for h in range(400)]
    block_rows += [("n0", 1000 + i, 5000) for i in range(5)]
    request_rows = [("n%d" % rnd.randrange(4), rnd.randrange(-10, 250_000)) for _ in range(200)]
    request_rows += [("n0", 5000), ("n0", 4999), ("n1", 10**9), ("n0", 5000)]
    got = asof.asof_block(
        spark.createDataFrame(block_rows, "network string, height long, ts long"),
        spark.createDataFrame(request_rows, "network string, ts long"),
    )
    assert sorted((tuple(r) for r in got.select("network", "ts", "block_number", "block_ts").collect()), key=str) == brute_asof(
        block_rows, request_rows
    )


HIT = blocks.STAKING_PREFIX + "ff"


def chain_blocks(spark):
    def tx(txid, *outputs):
        return (txid, [(None if v is None else D(v), (h,)) for v, h in outputs])

    rows = [
        (1, "h1", 1704067199, [tx("a", ("1.5", "00"), ("0", HIT), ("0", HIT)), tx("none")]),
        (2, "h2", 1704067200, [tx("b", ("2", HIT)), tx("a", ("9", "00"), ("0", HIT)), tx("n", ("3", None))]),
        (3, "h3", 1704067201, []),
    ]
    return spark.createDataFrame(rows, schema("blocks"))


def test_staking_scan(spark):
    found = chain_blocks(spark)
    hits = blocks.staking_outputs(found)
    assert table(hits, "block_height", "txid", "value", "timestamp") == [
        (1, "a", D("0E-8"), "2023-12-31T23:59:59"), (1, "a", D("0E-8"), "2023-12-31T23:59:59"),
        (2, "a", D("0E-8"), "2024-01-01T00:00:00"), (2, "b", D("2.00000000"), "2024-01-01T00:00:00"),
    ]
    want = [(1, "a", D("1.50000000")), (2, "b", D("2.00000000"))]
    assert table(blocks.staking_values(found, hits), "block_height", "txid", "value") == want
    assert table(blocks.staking_outputs_onepass(found), "block_height", "txid", "value") == want
    assert table(blocks.staking_outputs(found, prefix="00"), "txid") == [("a",), ("a",)]


def test_missing_transactions_are_reported(spark):
    hits = spark.createDataFrame(
        [(1, "h1", "a"), (1, "h1", "none"), (9, "h9", "z")], "block_height long, block_hash string, txid string"
    )
    found = chain_blocks(spark)
    assert table(blocks.missing_transactions(found, hits), "txid", "reason") == [
        ("none", "no_first_output"), ("z", "no_transaction"),
    ]


def test_scan_is_not_shuffled(spark):
    plan = blocks.staking_outputs(chain_blocks(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_resume_and_range(spark):
    found = chain_blocks(spark)
    done = spark.createDataFrame([(1,), (2,)], "height long")
    assert table(chain.scan_after(found, done), "height") == [(3,)]
    assert table(chain.scan_after(found, done.limit(0)), "height") == [(1,), (2,), (3,)]
    assert chain.start_height(prune_height=900000) == 900001 and chain.start_height() == 857910
    assert table(chain.scan_range(found, 2, 2), "height") == [(2,)]


def test_csv_round_trip(spark, tmp_path):
    hits = blocks.staking_outputs(chain_blocks(spark))
    path = str(tmp_path / "hits")
    chain.write_csv(hits, path, append=False)
    chain.write_csv(hits.limit(0), path, append=True)
    back = chain.read_csv(spark, path, "staking_hits")
    assert table(back, *back.columns) == table(hits, *hits.columns)
    chain.write_csv(hits.where("txid = 'b'"), path, append=False)
    assert chain.read_csv(spark, path, "staking_hits").count() == 1


def existing_balances(spark):
    rows = [(day("2024-01-01"), "a", D("1"), dt.datetime(2024, 1, 1), 1), (day("2024-02-01"), "a", D("2"), dt.datetime(2024, 2, 1), 2)]
    return spark.createDataFrame(rows, schema("token_balances"))


def incoming(spark, *rows):
    return spark.createDataFrame(
        [(k, d and day(d), D(v), s) for k, d, v, s in rows], "token_implementation string, date date, balance decimal(20,8), seq int"
    )


def test_upsert_changes_balance_only_and_last_wins(spark):
    batch = incoming(spark, ("a", "2024-01-01", "5", 1), ("a", "2024-01-01", "7", 2), ("b", "2024-01-01", "9", 1), (None, "2024-01-01", "3", 1), (None, "2024-01-01", "3", 2))
    stamp = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    once = upsert.upsert_token_balances(existing_balances(spark), batch, ["seq"], stamp)
    got = table(once, "token_implementation", "date", "balance", "created_at")
    new = dt.datetime(2024, 3, 1)
    assert got == [
        ("a", day("2024-01-01"), D("7.00000000"), dt.datetime(2024, 1, 1)),
        ("a", day("2024-02-01"), D("2.00000000"), dt.datetime(2024, 2, 1)),
        ("b", day("2024-01-01"), D("9.00000000"), new),
        (None, day("2024-01-01"), D("3.00000000"), new), (None, day("2024-01-01"), D("3.00000000"), new),
    ]
    whole = batch.where("token_implementation is not null")
    once = upsert.upsert_token_balances(existing_balances(spark), whole, ["seq"], stamp)
    twice = upsert.upsert_token_balances(once, whole, ["seq"], stamp)
    assert table(twice, *twice.columns) == table(once, *once.columns)
    assert {r.id for r in once.where("token_implementation = 'a'").collect()} == {1, 2}


def test_reserve_upsert_appends_rows_without_a_full_key(spark):
    old = spark.createDataFrame(
        [(day("2024-01-01"), D("1"), dt.datetime(2024, 1, 1), 4, "n", "c", "d", "a"), (day("2024-01-01"), D("2"), None, 4, None, "c", "d", "a")],
        schema("reserve_balances"),
    )
    batch = spark.createDataFrame(
        [(day("2024-01-01"), D("8"), 5, "n", "c", "d", "a", 1), (day("2024-01-01"), D("9"), 5, None, "c", "d", "a", 1), (day("2024-01-01"), D("6"), 7, "n", "c", "d", "b", 1), (day("2024-01-01"), D("5"), 8, "n", "c", "d", "b", 2)],
        "date date, balance decimal(20,8), reserve_implementation_id int, reserve_network string, collateral_token string, derivative_token string, reserve_address string, seq int",
    )
    got = upsert.upsert_reserve_balances(old, batch, ["seq"])
    assert table(got, "balance", "reserve_implementation_id", "reserve_network") == [
        (D("2.00000000"), 4, None), (D("5.00000000"), 7, "n"), (D("8.00000000"), 4, "n"), (D("9.00000000"), 5, None),
    ]


def test_monthly_upsert_touches_only_its_months(spark, tmp_path):
    path = str(tmp_path / "balances")
    tables.write_monthly(existing_balances(spark), path)
    untouched = tables.current(spark, path)["2024-02"]

    def merge(old, new):
        return upsert.upsert_token_balances(old, new, ["seq"])

    batch = incoming(spark, ("a", "2024-01-01", "5", 1), ("c", "2024-03-09", "6", 1))
    for _ in range(2):
        tables.upsert_months(spark, path, "token_balances", batch, merge)
        assert table(tables.read_table(spark, path, "token_balances"), "token_implementation", "date", "balance") == [
            ("a", day("2024-01-01"), D("5.00000000")), ("a", day("2024-02-01"), D("2.00000000")),
            ("c", day("2024-03-09"), D("6.00000000")),
        ]
    assert tables.current(spark, path)["2024-02"] == untouched
    tables.upsert_months(spark, path, "token_balances", batch.limit(0), merge)
    assert tables.read_table(spark, path, "token_balances").count() == 3


def model(build):
    return (
        build()
        .network("native").network("A").network("B").token("T").token("X", type="odd", depegged=True)
        .impl("T", "A", "native").impl("T", "B", "A").impl("X", "A", None).impl("T", "gone", slug="T_gone")
        .reserve_impl(1, "T_A", "X_A").reserve_impl(2, "T_A", "T_B", address="z")
        .balance("T_A", "2024-01-01", "1").balance("T_B", "2024-01-01", "1").balance("X_A", "2024-01-01", "1")
        .balance("orphan", "2024-01-01", "1").balance(None, "2024-01-01", "1").balance(None, "2024-01-01", "1")
        .reserve("T_A", "2024-01-01", "1", rid=1).reserve("T_A", "2024-01-01", "1", address="z", rid=2)
        .reserve("T_A", "2024-01-02", "1", rid=None)
    )


def test_rule_reports(build):
    b = model(build).balance("T_A", "2024-01-01", "4")
    cat = b.build()
    assert table(quality.check_unique(cat), "rule", "key", "n") == [
        ("token_balances(token_implementation,date)", "T_A|2024-01-01", 2)
    ]
    assert table(quality.check_fk(cat), "rule", "value", "n") == [
        ("token_balances.token_implementation->token_implementations", "orphan", 1),
        ("token_implementations.network->networks", "gone", 1),
    ]
    bad = quality.check_domain(cat, ["wrapped"]).where("n > 0")
    assert table(bad, "rule", "n") == [("tokens.type in domain: odd", 1)]


def test_cascade_reaches_the_facts(build):
    cat = quality.cascade_delete(model(build).build(), tokens=F.col("depegged"))
    assert table(cat.token_implementations, "slug") == [("T_A",), ("T_B",), ("T_gone",)]
    assert table(cat.reserve_implementations, "id") == [(2,)]
    assert table(cat.token_balances, "token_implementation") == [("T_A",), ("T_B",), ("orphan",), (None,), (None,)]
    assert table(cat.reserve_balances, "reserve_implementation_id") == [(2,), (None,)]


def test_slug_rule(spark):
    df = spark.createDataFrame([(None, None, "T", "A"), ("s", "n", "T", "B")], "slug string, name string, token string, network string")
    assert table(quality.derive_impl_slug(df), "slug", "name") == [("T_A", "T_A"), ("s", "n")]


def test_rows_that_lie_by_month_are_copied_without_a_shuffle(spark, tmp_path):
    rows = [
        dict(date=day("2024-01-01") + timedelta(n), token_implementation=f"t{n % 4}", balance=D(n), id=n)
        for n in range(200)
    ]
    first = spark.createDataFrame(rows, schema("token_balances"))
    tables.write_monthly(first, f"{tmp_path}/a")
    held = tables.read_table(spark, f"{tmp_path}/a", "token_balances")
    tables.write_monthly(held, f"{tmp_path}/b", by_month=True)
    copied = tables.read_monthly(spark, f"{tmp_path}/b", "token_balances")
    assert copied.drop("month").exceptAll(held).count() == 0 and copied.count() == len(rows)
    assert set(tables.current(spark, f"{tmp_path}/a")) == set(tables.current(spark, f"{tmp_path}/b"))
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert shuffles(tables._dealt(held, by_month=True)) == 0
    assert shuffles(tables._dealt(held, by_month=False)) == 1


def test_upsert_prunes_the_scan_to_its_months(spark, tmp_path):
    path = str(tmp_path / "balances")
    tables.write_monthly(existing_balances(spark), path)
    landed = tables.land(path, incoming(spark, ("a", "2024-02-05", "5", 1), ("b", "2024-02-06", "5", 1)))
    assert landed.months == ["2024-02"] and landed.rows.count() == 2
    touched = landed.touched(path, "token_balances")
    assert {file.split("month=")[1][:7] for file in touched.inputFiles()} == {"2024-02"}
    assert table(touched, "date") == [(day("2024-02-01"),)]
    assert tables.land(path, incoming(spark)).months == []


@pytest.mark.parametrize("step", ["_commit", "write_monthly", "land", "read_monthly"])
def test_a_cut_off_upsert_can_be_repeated(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "balances")
    rows = [(day("2024-01-01"), k, D("1"), None, i) for i, k in enumerate("ad")]
    tables.write_monthly(spark.createDataFrame(rows, schema("token_balances")), path)
    batch = incoming(spark, ("a", "2024-01-01", "5", 1), ("c", "2024-01-09", "6", 1))
    columns = ("token_implementation", "date", "balance")
    old = [("a", day("2024-01-01"), D("1.00000000")), ("d", day("2024-01-01"), D("1.00000000"))]
    new = [("a", day("2024-01-01"), D("5.00000000")), ("c", day("2024-01-09"), D("6.00000000")), old[1]]

    def merge(existing, fresh):
        return upsert.upsert_token_balances(existing, fresh, ["seq"])

    def cut(*args, **kwargs):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(tables, step, cut)
        with pytest.raises(RuntimeError):
            tables.upsert_months(spark, path, "token_balances", batch, merge)
    # Readers see the old table, never less.
    assert table(tables.read_table(spark, path, "token_balances"), *columns) == old
    for _ in range(3):
        tables.upsert_months(spark, path, "token_balances", batch, merge)
        assert table(tables.read_table(spark, path, "token_balances"), *columns) == new
    # What was superseded or left behind goes with a sweep, and only then.
    assert len(list((tmp_path / "balances" / "data").iterdir())) >= 4
    tables.sweep(spark, path, timedelta(0))
    assert len(list((tmp_path / "balances" / "data").iterdir())) == 1
    assert table(tables.read_table(spark, path, "token_balances"), *columns) == new


def test_held_readers_outlive_upserts(spark, tmp_path):
    path = str(tmp_path / "balances")
    tables.write_monthly(existing_balances(spark), path)
    columns = ("token_implementation", "date", "balance")

    def merge(existing, fresh):
        return upsert.upsert_token_balances(existing, fresh, ["seq"])

    held = [tables.read_table(spark, path, "token_balances")]
    seen = [table(held[0], *columns)]
    for k in range(5):
        tables.upsert_months(spark, path, "token_balances", incoming(spark, ("a", "2024-02-01", str(k + 10), 1)), merge)
        held.append(tables.read_table(spark, path, "token_balances"))
        seen.append(table(held[-1], *columns))
    assert [table(df, *columns) for df in held] == seen and len(set(map(tuple, seen))) == 6
    # Versions out of use for less than the time kept stay, others go; the current one always stays.
    assert tables.sweep(spark, path, timedelta(hours=1)) == []
    assert [table(df, *columns) for df in held] == seen
    # The first version still holds the other month, the last one this month.
    assert len(tables.sweep(spark, path, timedelta(0))) == 4
    assert table(tables.read_table(spark, path, "token_balances"), *columns) == seen[-1]


def test_a_catalog_opens_its_facts_anew_for_each_view(spark, build, tmp_path):
    root = str(tmp_path)
    b = model(build)
    for name in BASE_TABLES:
        if name in FACTS:
            tables.write_monthly(b.frame(name), f"{root}/{name}")
        else:
            b.frame(name).write.parquet(f"{root}/{name}")
    cat = Catalog.from_parquet(spark, root, b.as_of)
    view = "helper_current_supplies_by_tokenimpl_raw"
    held = cat.view(view)
    cat.register_views()
    before = table(held, "token_implementation", "balance")
    maintain.upsert_tokens(cat, root, incoming(spark, ("T_B", "2024-02-01", "7", 1)), ["seq"])
    assert table(held, "token_implementation", "balance") == before
    assert table(spark.table(view), "token_implementation", "balance") == before
    after = table(cat.view(view), "token_implementation", "balance")
    assert ("T_B", D("7.00000000")) in after and after != before
    cat.register_views()
    assert table(spark.table(view), "token_implementation", "balance") == after
    with pytest.raises(KeyError):
        cat.view("nothing")


def test_ranks_from_counts_are_of_one_snapshot(spark, tmp_path):
    path = str(tmp_path / "grown")
    spark.range(5).selectExpr("id as i", "cast(id as decimal(20,8)) as v").write.parquet(path)
    ranked = ranking.rank_by_counts(spark.read.parquet(path), "v")
    spark.range(5, 9).selectExpr("id as i", "cast(id as decimal(20,8)) as v").write.mode("append").parquet(path)
    assert table(ranked, "i", "rank") == [(i, 5 - i) for i in range(5)]
    assert table(ranking.rank_by_counts(spark.read.parquet(path), "v"), "i", "rank") == [(i, 9 - i) for i in range(9)]


def block_of(height, *scripts):
    outputs = [(D(n + 1), (script,)) for n, script in enumerate(scripts)]
    return (height, f"h{height}", 1704067200, [(f"t{height}", outputs)])


def test_overlapping_prefixes_in_one_scan(spark):
    rows = [block_of(1, "6a47ff", "6a", "6A47"), block_of(2, "6a4", None), block_of(3), (4, "h4", 0, None)]
    found = spark.createDataFrame(rows, schema("blocks"))
    prefixes = blocks.prefix_table(spark, {"6a": "short", "6a47": "long", "6a47ff00": "longer than any", "": "empty"})
    got = blocks.staking_hits_by_prefix(found, prefixes)
    assert table(got, "block_height", "vout_index", "project") == [(1, 0, "long"), (1, 1, "short"), (2, 0, "short")]
    assert blocks.staking_outputs_by_prefix(found, prefixes.limit(0)).count() == 0
    one = blocks.prefix_table(spark, {"6a47": "x"})
    assert table(blocks.staking_hits_by_prefix(found, one), *blocks.HIT_COLUMNS) == table(
        blocks.staking_hits(found, "6a47"), *blocks.HIT_COLUMNS
    )


def test_covered_intervals_merge_over_gaps_overlaps_and_spans(spark, monkeypatch):
    monkeypatch.setattr(chain, "INTERVAL_SPAN", 4)
    given = [(0, 1), (1, 2), (1, 2), (3, 3), (9, 21), (10, 12), (30, 29), (40, 40), (42, 42)]
    intervals = spark.createDataFrame(given, "first long, last long")
    assert table(chain.covered_intervals(intervals), "first", "last") == [(0, 3), (40, 40), (42, 42), (9, 21)]
    heights = spark.range(50).withColumnRenamed("id", "height")
    left = [r.height for r in chain.scan_uncovered(heights, intervals).orderBy("height").collect()]
    assert left == [h for h in range(50) if not any(a <= h <= b for a, b in given)]
    assert chain.scan_uncovered(heights, intervals.limit(0)).count() == 50
    done = chain.heights_done(spark.createDataFrame([(3,), (None,), (4,), (4,)], "height long"))
    assert table(chain.covered_intervals(done), "first", "last") == [(3, 4)]


def test_upserts_refuse_missing_balances_and_keep_undated_rows(spark, tmp_path):
    path = str(tmp_path / "balances")
    loose = "date date, token_implementation string, balance decimal(20,8), created_at timestamp_ntz, id long"
    tables.write_monthly(spark.createDataFrame([(None, "a", D("1"), None, 1)], loose), path)

    def merge(existing, fresh):
        return upsert.upsert_token_balances(existing, fresh, ["seq"])

    tables.upsert_months(spark, path, "token_balances", incoming(spark, ("b", None, "5", 1)), merge)
    assert table(tables.read_table(spark, path, "token_balances"), "token_implementation") == [("a",), ("b",)]
    missing = spark.createDataFrame([("a", day("2024-01-01"), None, 1)], incoming(spark).schema)
    with pytest.raises(Exception, match="is NULL"):
        tables.upsert_months(spark, path, "token_balances", missing, merge)


def test_network_config_document(build):
    cat = model(build).build()
    rows = network_config.network_config(cat).collect()
    assert sorted(r.token.slug for r in rows if r.network == "A" and r.token) == ["T_A", "X_A"]
    assert not [r for r in rows if r.network == "native"]
    assert {(r.reserve.id, r.reserve.collateral_token.slug) for r in rows if r.reserve} == {(1, "X_A"), (2, "T_B")}
    assert table(network_config.scan_impl_by_network(cat, "B"), "slug", "token_decimals") == [("T_B", "8")]
