"""Kept tables against the full computation, after any order of upserts."""

import random
from datetime import datetime
from decimal import Decimal as D

import pytest
from conftest import day, dec, table
from pyspark.sql import functions as F

from satlake.catalog import FACTS, LATEST, Catalog
from satlake.operators import adjust, quality
from satlake.plans import constraints, decode, ingest, maintain, supplies
from satlake.plans.views import VIEWS
from satlake.schemas import BASE_TABLES, schema
from satlake.sources import tables
from satlake.streaming import daily, latest_store

BALANCE = ("token_implementation", "date", "balance")
VIEW_NAMES = [
    "helper_current_supplies_by_tokenimpl_raw",
    "current_supplies_by_tokenimpl",
    "current_supplies_by_network",
    "current_reserves_by_tokenimpl",
    "current_by_tokenimpl",
    "historical_supplies_by_network",
    "historical_supplies_by_tokenimpl",
]


def model(build):
    """Two generations of bridged tokens, one that lost its peg, reserves with several rows."""
    b = build().network("native").network("A").network("B").network("C").token("T").token("S", type="staking")
    b.token("X", depegged=True)
    b.impl("T", "A", "native").impl("T", "B", "A", address="1b").impl("T", "C", "B", address="2c")
    b.impl("S", "A", "native").impl("S", "B", "A", address="3b").impl("X", "A", "native").impl("X", "B", "A", address="4b")
    b.reserve_impl(1, "T_A", "X_A").reserve_impl(2, "T_A", "S_A", address="z").reserve_impl(3, "S_A", "X_A")
    for k, (impl, date) in enumerate(
        [("T_A", "2024-01-30"), ("T_B", "2024-01-30"), ("T_A", "2024-02-01"), ("T_C", "2024-02-01"), ("S_A", "2024-02-02")]
    ):
        b.balance(impl, date, str(10 * (k + 1)))
    b.balance(None, "2024-02-01", "3").balance(None, "2024-02-01", "4").balance("gone", "2024-02-01", "5")
    b.reserve("T_A", "2024-01-31", "1", rid=1).reserve("T_A", "2024-01-31", "2", collateral="d", rid=2)
    b.reserve("S_A", "2024-01-30", "3", rid=3).reserve(None, "2024-01-30", "9")
    return b


def written(build, root, b=None):
    b = b or model(build)
    for name in BASE_TABLES:
        if name in FACTS:
            tables.write_monthly(b.frame(name), f"{root}/{name}")
        else:
            b.frame(name).write.parquet(f"{root}/{name}")
    cat = Catalog.from_parquet(b.spark, root, b.as_of)
    maintain.build_kept(cat, root)
    return cat.reopened()


def rows(df):
    return table(df, *sorted(df.columns))


def agrees(cat, views=()):
    """The kept tables and the views over them equal the full computation."""
    full = Catalog.from_parquet(cat.spark, cat.root, cat.as_of, use_kept=False)
    now = cat.reopened()
    assert not full.kept and set(now.kept) == {*LATEST.values(), "adjusted_balances"}
    assert rows(adjust.adjusted_history(now)) == rows(adjust.helper_token_balances_adjusted(full))
    for (name, key), kept in LATEST.items():
        tops = full.tables[name].where(f"{key} is not null").groupBy(key).agg(F.max("date").alias("date"))
        assert rows(now.kept[kept]) == rows(full.tables[name].join(tops, [key, "date"], "left_semi"))
    for view in views:
        assert rows(VIEWS[view](now)) == rows(VIEWS[view](full))


def tokens(spark, *found):
    """(slug, day, amount, sequence)"""
    filled = [(slug, date and day(date), dec(amount), seq) for slug, date, amount, seq in found]
    return spark.createDataFrame(filled, "token_implementation string, date date, balance decimal(20,8), seq int")


def reserves(spark, *found):
    """(derivative, day, amount, collateral, reserve id, sequence)"""
    filled = [(day(date), dec(amount), rid, "n", c, d, "a", seq) for d, date, amount, c, rid, seq in found]
    return spark.createDataFrame(
        filled,
        "date date, balance decimal(20,8), reserve_implementation_id int, reserve_network string,"
        " collateral_token string, derivative_token string, reserve_address string, seq int",
    )


def test_views_over_kept_tables_equal_the_full_computation(spark, build, tmp_path):
    cat = written(build, str(tmp_path))
    agrees(cat)
    batches = [
        # A new last day, an old day again, a child without its parent, another month, rows without a key part.
        tokens(spark, ("T_A", "2024-02-03", "70", 1), ("T_B", "2024-01-30", "21", 2), ("S_B", "2024-02-02", "1", 3)),
        tokens(spark, ("T_C", "2023-12-31", "5", 1), ("T_B", "2024-02-01", "6", 2), ("T_B", "2024-02-01", "7", 3)),
        tokens(spark, (None, "2024-02-01", "8", 1), ("T_B", None, "9", 2), ("gone", "2024-03-01", "9", 3)),
        tokens(spark),
        tokens(spark, ("X_B", "2024-02-01", "1", 1), ("X_A", "2024-02-01", "2", 2), ("S_A", "2024-02-02", "99", 3)),
    ]
    for batch in batches:
        maintain.upsert_tokens(cat, cat.root, batch, ["seq"], F.lit("2024-03-01").cast("timestamp_ntz"))
        agrees(cat)
    for batch in [
        reserves(spark, ("T_A", "2024-02-01", "5", "c", 1, 1), ("T_A", "2024-01-31", "6", "d", 2, 2)),
        reserves(spark, ("T_A", "2024-02-01", "7", "d", 2, 1), ("S_A", "2024-01-29", "1", "c", 3, 2), (None, "2024-02-01", "1", "c", 3, 3)),
        reserves(spark, ("S_A", "2024-01-30", "30", "e", 3, 1), ("T_B", "2023-01-30", "3", "c", None, 2)),
    ]:
        maintain.upsert_reserves(cat, cat.root, batch, ["seq"], F.lit("2024-03-01").cast("timestamp_ntz"))
        agrees(cat)
    agrees(cat, VIEW_NAMES)


def test_any_order_of_random_upserts(spark, build, tmp_path):
    cat = written(build, str(tmp_path))
    rnd = random.Random(11)
    slugs = ["T_A", "T_B", "T_C", "S_A", "S_B", "X_B"]
    for _ in range(3):
        found = [(rnd.choice(slugs), f"2024-{rnd.choice('123'):0>2}-{rnd.choice([1, 15]):02}", str(rnd.randrange(50)), n) for n in range(6)]
        maintain.upsert_tokens(cat, cat.root, tokens(spark, *found), ["seq"])
        agrees(cat)


def test_current_views_scan_no_month_of_the_facts(spark, build, tmp_path):
    cat = written(build, str(tmp_path))
    views = {"current_supplies_by_tokenimpl": "token_balances", "current_supplies_by_network": "token_balances"}
    views |= {"current_reserves_by_tokenimpl": "reserve_balances", "historical_supplies_by_network": "token_balances"}
    for view, facts in views.items():
        files = VIEWS[view](cat).inputFiles()
        assert files and not [f for f in files if f"/{facts}/" in f]
    full = Catalog.from_parquet(spark, cat.root, cat.as_of, use_kept=False)
    assert [f for f in supplies.current_supplies_by_tokenimpl(full).inputFiles() if "/token_balances/" in f]


def test_an_upsert_reads_the_touched_months_only(spark, build, tmp_path, monkeypatch):
    cat = written(build, str(tmp_path))
    opened = []
    read = tables.read_monthly

    def noted(spark, path, table, only=None):
        if path.endswith(("/token_balances", "/adjusted_balances")):
            opened.append(only)
        return read(spark, path, table, only)

    monkeypatch.setattr(tables, "read_monthly", noted)
    before = tables.current(spark, f"{cat.root}/adjusted_balances")
    maintain.upsert_tokens(cat, cat.root, tokens(spark, ("T_B", "2024-02-01", "6", 1)), ["seq"])
    assert opened and all(only == ["2024-02"] for only in opened)
    after = tables.current(spark, f"{cat.root}/adjusted_balances")
    assert {m for m in after if after[m] != before.get(m)} == {"2024-02"}


@pytest.mark.parametrize("step", ["follow_latest", "follow_adjusted"])
def test_a_cut_off_follower_is_mended_by_the_repeated_batch(spark, build, tmp_path, monkeypatch, step):
    cat = written(build, str(tmp_path))
    batch = tokens(spark, ("T_B", "2024-02-01", "6", 1), ("T_C", "2024-02-09", "7", 2))

    def cut(*args):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(maintain, step, cut)
        with pytest.raises(RuntimeError):
            maintain.upsert_tokens(cat, cat.root, batch, ["seq"])
    for _ in range(2):
        maintain.upsert_tokens(cat, cat.root, batch, ["seq"])
        agrees(cat)


def test_changed_dimensions_reach_the_history_of_their_parents(spark, build, tmp_path):
    cat = written(build, str(tmp_path / "one"))
    assert maintain.refresh_edges(cat, cat.root) == []
    # T loses its peg, X finds it again: other children are subtracted.
    b = model(build)
    for row in b.rows["tokens"]:
        row["depegged"] = row["slug"] == "T"
    for name in ("tokens", "token_implementations"):
        b.frame(name).write.mode("overwrite").parquet(f"{cat.root}/{name}")
    changed = Catalog.from_parquet(spark, cat.root, cat.as_of)
    assert maintain.refresh_edges(changed, cat.root) == ["2024-01", "2024-02"]
    agrees(changed, VIEW_NAMES[1:2])
    assert maintain.refresh_edges(changed, cat.root) == []


def test_polls_bring_the_kept_tables_along(spark, build, tmp_path):
    """A coin that its node does not serve is read from its listed objects, in the stream as in a batch."""
    b = model(build).token("G").impl("G", "C", address="0x2::g::G", reserves='["o1","o2"]')
    cat = written(build, str(tmp_path / "root"), b)
    config = spark.createDataFrame(
        [("Sui", "C", "coin_value", False, False, False, None, None, None, None)],
        "source string, network string, decoder string, keep_zero boolean, final_only boolean, start_of_day boolean,"
        " special_token string, special_decoder string, only_token string, stored_as string",
    )
    fields = '{"result":{"data":{"content":{"fields":{"treasury_cap":{"fields":{"total_supply":{"fields":{"value":"%s"}}}}}}}}}'
    listed = [("o1", "{}"), ("o2", fields % "4200000000")]
    landing, values, dead = (str(tmp_path / n) for n in ("landing", "values", "dead"))
    tables.create_table(spark, values, "daily_values")
    polls = [(k, "Sui", "G_C", datetime(2024, 3, 1, k), day("2024-03-01"), False, "{}", 200) for k in (1, 2)]
    spark.createDataFrame(polls, schema("observations")).write.parquet(landing)
    follow = maintain.followers(cat, cat.root, "token_balances")
    stream = spark.readStream.schema(schema("observations")).parquet(landing)
    ingest.stream_polls(
        cat, stream, config, values, f"{cat.root}/token_balances", dead, str(tmp_path / "checkpoint"),
        F.lit("2024-03-01").cast("timestamp_ntz"),
        lambda: spark.createDataFrame(listed, "object_id string, payload string"), follow,
    )
    assert spark.read.parquet(dead).count() == 0
    got = cat.reopened()
    assert ("G_C", day("2024-03-01"), D("42.00000000")) in table(got.token_balances, *BALANCE)
    agrees(cat, VIEW_NAMES[1:2])


# -- constraints where rows are written --------------------------------------


def test_rows_that_break_a_rule_go_to_quarantine(spark, build, tmp_path):
    cat = written(build, str(tmp_path / "root"))
    dead = str(tmp_path / "dead")
    found = [
        ("T_B", "2024-02-05", "1", None, 1),
        ("nobody", "2024-02-05", "2", None, 2),
        ("T_C", "2024-02-05", "4", 900, 4),
        ("S_A", "2024-02-05", "5", 900, 5),  # the id of the row before
        ("S_A", "2024-02-06", "6", 1, 6),  # the id of a stored row
        ("T_A", "2024-02-01", "7", 1, 7),  # updates its key, whatever id it claims
        ("T_C", "2024-02-05", "8", 900, 8),  # its own id again
    ]
    filled = [(slug, day(d), dec(amount), i, seq) for slug, d, amount, i, seq in found]
    batch = spark.createDataFrame(filled, "token_implementation string, date date, balance decimal(20,8), id long, seq int")
    old = rows(cat.token_balances.select(*BALANCE, "id"))
    for _ in range(2):
        constraints.upsert_checked(cat, cat.root, "token_balances", batch, ["seq"], dead, "0")
        quarantine = spark.read.parquet(dead)
        assert table(quarantine, "seq", "broken") == [
            (2, "token_balances.token_implementation->token_implementations"),
            (5, "token_balances(id)"),
            (6, "token_balances(id)"),
        ]
        now = cat.reopened()
        stored = {r[0:2]: r[2:] for r in table(now.token_balances.where("token_implementation is not null"), *BALANCE, "id")}
        assert stored["T_C", day("2024-02-05")] == (D("8.00000000"), 900)
        assert stored["T_A", day("2024-02-01")] == (D("7.00000000"), 3)
        assert ("nobody", day("2024-02-05")) not in stored and ("S_A", day("2024-02-06")) not in stored
        agrees(cat)
    assert len(stored) == len([r for r in old if r[-1] is not None]) + 2
    unknown = reserves(spark, ("T_A", "2024-02-01", "5", "c", 77, 1), ("T_A", "2024-02-01", "6", "c", 1, 2))
    constraints.upsert_checked(cat, cat.root, "reserve_balances", unknown, ["seq"], dead + "2", "0")
    assert table(spark.read.parquet(dead + "2"), "reserve_implementation_id") == [(77,)]
    agrees(cat)


@pytest.mark.parametrize(
    "condition",
    [{"tokens": "slug = 'T'"}, {"networks": "slug = 'B'"}, {"tokens": "depegged"}, {"tokens": "false"}],
)
def test_a_delete_reaches_the_stored_facts_and_kept_tables(spark, build, tmp_path, condition):
    unchanged = condition == {"tokens": "false"}
    condition = {name: F.expr(said) for name, said in condition.items()}
    cat = written(build, str(tmp_path))
    maintain.upsert_tokens(cat, cat.root, tokens(spark, ("X_B", "2024-03-01", "1", 1), ("S_B", "2024-02-02", "2", 2)), ["seq"])
    cat = cat.reopened()
    want = quality.cascade_delete(cat, **condition)
    facts = {name: rows(want.tables[name]) for name in FACTS}
    before = {name: tables.current(spark, f"{cat.root}/{name}") for name in FACTS}
    for _ in range(2):
        left = constraints.cascade_stored(cat, cat.root, **condition)
        assert {name: rows(left.tables[name]) for name in FACTS} == facts
        assert rows(left.token_implementations) == rows(want.token_implementations)
        assert rows(adjust.adjusted_history(left)) == rows(adjust.helper_token_balances_adjusted(left))
        for (name, key), kept in LATEST.items():
            tops = left.tables[name].where(f"{key} is not null").groupBy(key).agg(F.max("date").alias("date"))
            assert rows(left.kept[kept]) == rows(left.tables[name].join(tops, [key, "date"], "left_semi"))
    if unchanged:
        assert {name: tables.current(spark, f"{cat.root}/{name}") for name in FACTS} == before


# -- latest values in the state store ---------------------------------------


def test_the_state_store_follows_the_stream_and_survives_restarts(spark, tmp_path):
    landing, checkpoint = (str(tmp_path / n) for n in ("in", "checkpoint"))
    changes = []
    batches = [
        [("a", "2024-01-02", "1", "1"), ("b", "2024-01-01", "5", "1"), (None, "2024-01-01", "5", "1")],
        [("a", "2024-01-02", "2", "3"), ("a", "2024-01-02", "3", "2")],
        [("a", "2024-01-01", "9", "99"), ("b", "2024-01-01", "5", "1")],
        [("c", "2024-01-05", "-7.5", "12345678901234567890123456789")],
    ]
    seen = []
    for batch in batches:
        found = [(day(d), slug, dec(amount), dec(order)) for slug, d, amount, order in batch]
        spark.createDataFrame(found, schema("daily_values")).coalesce(1).write.mode("append").parquet(landing)
        seen += [r for r in found if r[1]]
        stream = spark.readStream.schema(schema("daily_values")).parquet(landing)
        latest_store.stream_latest(stream, checkpoint, lambda df, epoch: changes.append(sorted(r[1] for r in df.collect())))
        want = {}
        for row in seen:
            if row[1] not in want or (row[0], row[3]) > (want[row[1]][0], want[row[1]][3]):
                want[row[1]] = row
        got = {r.token_implementation: (r.date, r.balance, r.poll_order) for r in latest_store.read_latest(spark, checkpoint).collect()}
        assert got == {k: (r[0], r[2], r[3]) for k, r in want.items()}
    # Late and repeated polls hand on nothing.
    assert [c for c in changes if c] == [["a", "b"], ["a"], ["c"]]


def test_the_state_store_equals_the_batch_result_however_files_are_cut(spark, tmp_path):
    rnd = random.Random(3)
    found = [(day(f"2024-01-{rnd.randrange(1, 9):02}"), rnd.choice("abcdef"), D(n), D(rnd.randrange(10**6))) for n in range(200)]
    landing = str(tmp_path / "in")
    spark.createDataFrame(found, schema("daily_values")).repartition(9).write.parquet(landing)
    stream = spark.readStream.schema(schema("daily_values")).option("maxFilesPerTrigger", 2).parquet(landing)
    checkpoint = str(tmp_path / "checkpoint")
    latest_store.stream_latest(stream, checkpoint)
    want = daily.latest_state(spark.read.schema(schema("daily_values")).parquet(landing))
    columns = ("token_implementation", "date", "poll_order")
    assert table(latest_store.read_latest(spark, checkpoint), *columns) == table(want, *columns)


def test_fallback_reserves_from_the_kept_rows(spark, build, tmp_path):
    cat = written(build, str(tmp_path))
    maintain.upsert_reserves(cat, cat.root, reserves(spark, ("T_A", "2024-02-01", "5", "c", 1, 1)), ["seq"])
    full = Catalog.from_parquet(spark, cat.root, cat.as_of, use_kept=False)
    got, want = decode.impl_fallback_reserve(cat.reopened()), decode.impl_fallback_reserve(full)
    assert rows(got) == rows(want) and not [f for f in got.inputFiles() if "/reserve_balances/" in f]
