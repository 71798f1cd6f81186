"""Supplies in dollars: prices as of a day, filled forward."""

import random
from decimal import Decimal as D

import pytest
from conftest import day, table

from satlake.plans import usd


def model(build):
    return (
        build()
        .network("native").network("A").network("B")
        .token("T").token("U").token("X", depegged=True)
        .impl("T", "A", "native").impl("T", "B", "A", address="1b").impl("U", "A", "native").impl("X", "A", "native")
        .balance("T_A", "2024-01-05", "10").balance("T_B", "2024-01-05", "4").balance("T_A", "2024-03-10", "20")
        .balance("U_A", "2024-01-05", "3").balance("X_A", "2024-01-05", "3")
        .price("T", "2024-01-03", "2").price("T", "2024-03-10", "3.5").price("T", "2024-04-30", "9")
        .price("T", "2024-02-01", None).price("T", None, "7").price(None, "2024-01-01", "7")
    )


def test_history_takes_the_last_price_before(build):
    cat = model(build).build()
    columns = ("date", "token_slug", "total_balance", "price_date", "supply_usd")
    assert table(usd.historical_supply_usd(cat, "slug"), *columns) == [
        (day("2024-01-05"), "T", D("10.00000000"), day("2024-01-03"), D("20.00000000")),
        (day("2024-01-05"), "U", D("3.00000000"), None, None),
        (day("2024-03-10"), "T", D("20.00000000"), day("2024-03-10"), D("70.00000000")),
    ]
    late = usd.historical_supply_usd(cat, "slug", delay_days=1)
    assert table(late, "date", "token_slug", "price_usd", "price_date") == [
        (day("2024-01-05"), "T", D("2.00000000"), day("2024-01-04")),
        (day("2024-01-05"), "U", None, None),
        (day("2024-03-10"), "T", D("2.00000000"), day("2024-01-04")),
    ]


def test_current_supplies_are_valued_at_the_catalogs_day(build):
    b = model(build)
    columns = ("token_implementation", "balance", "price_usd", "supply_usd")
    assert table(usd.current_supply_usd(b.build(), "slug"), *columns) == [
        ("T_A", D("16.00000000"), D("3.50000000"), D("56.00000000")),
        ("T_B", D("4.00000000"), D("3.50000000"), D("14.00000000")),
        ("U_A", D("3.00000000"), None, None),
    ]
    b.as_of = day("2024-05-01")
    assert {r.price_usd for r in usd.current_supply_usd(b.build(), "slug").where("token_slug = 'T'").collect()} == {D("9.00000000")}


def test_prices_under_either_slug(build):
    b = model(build)
    for row in b.rows["tokens"]:
        row["token_slug"] = "T" if row["slug"] == "U" else "other"
    cat = b.build()
    by_token = usd.current_supply_usd(cat).where("supply_usd is not null")
    assert table(by_token, "token_implementation", "supply_usd") == [("U_A", D("10.50000000"))]
    with pytest.raises(ValueError):
        usd.current_supply_usd(cat, "name")


def test_as_of_join_equals_a_search(spark):
    rnd = random.Random(5)
    days = [day(f"{y}-{m:02}-{d:02}") for y in (2022, 2023, 2024) for m in range(1, 13) for d in (1, 2, 15, 28)]
    prices = [(n, rnd.choice(days), rnd.choice("abc"), D(n)) for n in range(60)]
    supplies = [(n, rnd.choice([*"abcd", None]), rnd.choice([*days, None])) for n in range(150)]
    table_of = spark.createDataFrame(prices, "id long, date date, token_slug string, price_usd decimal(18,8)")
    asked = spark.createDataFrame(supplies, "n long, slug string, on_day date")
    got = usd.with_price(asked, "slug", "on_day", usd.price_intervals(table_of)).collect()
    found = {r.n: (r.price_usd, r.price_date) for r in got}
    assert len(got) == len(supplies)
    for n, slug, on_day in supplies:
        known = [(date, i, usd_price) for i, date, token, usd_price in prices if token == slug and on_day and date <= on_day]
        best = max(known, default=None)
        assert found[n] == ((best[2], best[0]) if best else (None, None))


def test_prices_meet_supplies_by_equality(build):
    plan = usd.historical_supply_usd(model(build).build())._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_tables(build):
    cat = build().network("A").token("T").impl("T", "A").build()
    assert usd.historical_supply_usd(cat).collect() == [] and usd.current_supply_usd(cat).collect() == []
