from decimal import Decimal as D

import pytest
from conftest import day, table

from satlake.operators.latest import row_number_latest
from satlake.plans import decode, gainers, prices, reserves


def one_token(build, as_of="2024-03-31"):
    b = build().network("native").network("A").token("T").token("X", depegged=True)
    b.impl("T", "A", "native").impl("X", "A", "native")
    b.as_of = day(as_of)
    return b


def test_percent_rounds_half_away_and_zero_base_gives_zero(build):
    b = one_token(build).impl("T", "A", slug="T_zero").impl("T", "A", slug="T_new")
    b.balance("T_A", "2024-03-31", "3").balance("T_A", "2024-03-30", "7").balance("T_A", "2024-03-24", "0")
    b.balance("T_zero", "2024-03-31", "5").balance("T_zero", "2024-03-30", "0")
    b.balance("T_new", "2024-03-31", "5")
    rows = table(
        gainers.top_gainers_by_tokenimpl(b.build()), "token_implementation", "period", "percent_change", "rank"
    )
    assert rows == [
        ("T_A", "daily", D("-57.14"), 2), ("T_A", "weekly", D("0.00"), 1),
        ("T_new", None, D("0.00"), 1), ("T_zero", "daily", D("0.00"), 1),
    ]


@pytest.mark.parametrize(
    "as_of, month, year",
    [("2024-03-31", "2024-02-29", "2023-03-31"), ("2024-02-29", "2024-01-29", "2023-02-28")],
)
def test_anchors_clamp_to_month_end(build, as_of, month, year):
    b = one_token(build, as_of)
    b.balance("T_A", as_of, "10").balance("T_A", month, "5").balance("T_A", year, "4")
    rows = table(gainers.top_gainers_by_tokenimpl(b.build()), "period", "past_balance")
    assert rows == [("monthly", D("5.00000000")), ("yearly", D("4.00000000"))]


def test_absolute_has_all_periods_with_zero_for_missing(build):
    b = one_token(build).balance("T_A", "2024-04-02", "10").balance("T_A", "2024-03-30", "12")
    b.balance("X_A", "2024-03-31", "1")
    rows = table(
        gainers.top_gainers_by_tokenimpl_absolute(b.build()), "token_implementation", "period", "supply_change"
    )
    assert rows == [
        ("T_A", "daily", D("-2.00000000")), ("T_A", "monthly", D("10.00000000")),
        ("T_A", "weekly", D("10.00000000")), ("T_A", "yearly", D("10.00000000")),
    ]


def test_period_filter_reads_the_endpoint_form(build):
    cat = one_token(build).balance("T_A", "2024-03-31", "10").build()
    df = cat.view("top_gainers_by_tokenimpl_absolute", {"period": "eq.weekly"})
    assert table(df, "period") == [("weekly",)]
    with pytest.raises(ValueError):
        cat.view("top_gainers_by_tokenimpl_absolute", {"period": "gt.weekly"})
    with pytest.raises(KeyError):
        cat.view("no_such_view")


def test_date_filter_of_the_past_reaches_the_scan(spark, build, tmp_path):
    from satlake.catalog import Catalog

    b = one_token(build).balance("T_A", "2024-03-31", "10")
    small = b.build()
    path = str(tmp_path / "tb")
    small.token_balances.write.parquet(path)
    cat = Catalog(spark, {**small.tables, "token_balances": spark.read.parquet(path)}, b.as_of)
    plan = gainers.past_balances(cat)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "In(date, [2023-03-31,2024-02-29,2024-03-24,2024-03-30])" in pushed


def test_the_past_prunes_the_months_of_an_upserted_table(spark, build, tmp_path):
    from satlake.catalog import Catalog
    from satlake.schemas import BASE_TABLES
    from satlake.sources.tables import write_monthly

    b = one_token(build).balance("T_A", "2024-03-31", "10").balance("T_A", "2024-03-24", "4").balance("T_A", "2022-01-01", "1")
    small = b.build()
    for name in BASE_TABLES:
        if name in ("token_balances", "reserve_balances"):
            write_monthly(small.tables[name], str(tmp_path / name))
        else:
            small.tables[name].write.parquet(str(tmp_path / name))
    cat = Catalog.from_parquet(spark, str(tmp_path), b.as_of)
    assert "month" not in cat.token_balances.columns
    past = gainers.past_balances(cat)
    plan = past._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert sorted(map(tuple, past.collect())) == sorted(map(tuple, gainers.past_balances(small).collect()))
    name = "top_gainers_by_tokenimpl_absolute"
    assert sorted(map(str, cat.view(name).collect())) == sorted(map(str, small.view(name).collect()))


def reserve_case(build):
    b = build().network("native").network("A").network("B").token("T").token("W")
    b.impl("T", "A", "native").impl("T", "B", "A").impl("W", "A", "native")
    b.reserve("T_A", "2024-01-01", "99")
    b.reserve("T_A", "2024-01-02", "10", collateral="c1").reserve("T_A", "2024-01-02", "4", collateral="c1", address="b")
    b.reserve("T_A", "2024-01-02", "20", collateral="c2").reserve("T_A", "2024-01-02", "30", collateral="c2", network="m")
    b.reserve("T_B", "2024-01-05", "5").reserve(None, "2024-01-05", "5").reserve("unknown", "2024-01-05", "5")
    return b


def test_reserves_group_by_a_hidden_network(build):
    rows = table(reserves.helper_reserves_summed(reserve_case(build).build()), "derivative_token", "collateral_token", "total_balance")
    assert [r for r in rows if r[0] == "T_A"] == [
        ("T_A", "c", D("99.00000000")), ("T_A", "c1", D("14.00000000")),
        ("T_A", "c2", D("20.00000000")), ("T_A", "c2", D("30.00000000")),
    ]
    assert (None, "c", D("5.00000000")) in rows


def test_reserves_repeat_the_whole_adjustment_per_row(build):
    cat = reserve_case(build).build()
    rows = table(reserves.current_reserves_by_tokenimpl(cat), "token_implementation", "balance", "rank")
    assert rows == [
        ("T_A", D("15.00000000"), 2), ("T_A", D("25.00000000"), 1), ("T_A", D("9.00000000"), 3),
        ("T_B", D("5.00000000"), 4),
    ]
    rows = table(reserves.current_reserves_by_tokenimpl(cat, collapse=True), "token_implementation", "balance")
    assert rows == [("T_A", D("59.00000000")), ("T_B", D("5.00000000"))]


def test_supply_next_to_reserves_fans_out(build):
    b = reserve_case(build).balance("T_A", "2024-01-09", "100").balance("W_A", "2024-01-01", "7")
    rows = table(
        reserves.current_by_tokenimpl(b.build()),
        "token_implementation", "reserve_balance", "balance_difference", "latest_date", "rank",
    )
    assert rows == [
        ("T_A", D("15.00000000"), D("85.00000000"), day("2024-01-09"), 1),
        ("T_A", D("25.00000000"), D("75.00000000"), day("2024-01-09"), 1),
        ("T_A", D("9.00000000"), D("91.00000000"), day("2024-01-09"), 1),
        ("W_A", None, D("7.00000000"), day("2024-01-01"), 4),
    ]


def test_current_price_is_the_latest_even_for_a_null_slug(build):
    b = build().price("T", "2024-01-01", "1").price("T", "2024-01-03", "3").price(None, "2024-01-02", "2")
    assert table(prices.current_prices(b.build()), "token_slug", "price_usd") == [
        ("T", D("3.00000000")), (None, D("2.00000000")),
    ]
    assert row_number_latest(b.build().price, "token_slug", "date").count() == 2


def test_fallback_takes_the_latest_reserve_of_the_lowest_id(build):
    b = build().reserve_impl(1, "d", "c", address="a1").reserve_impl(2, "d", "c", address="a2")
    b.reserve("d", "2024-01-01", "9", rid=1).reserve("d", "2024-01-02", "5", rid=2).reserve("d", "2024-01-02", "4", rid=1)
    b.reserve("d", "2024-01-03", "1", rid=77)
    rows = table(decode.impl_fallback_reserve(b.build()), "derivative_token", "balance", "date")
    assert rows == [("d", D("4.00000000"), day("2024-01-02"))]


def test_ordered_view_puts_unknown_first(build):
    b = one_token(build).impl("T", "A", slug="T_b")
    b.balance("T_A", "2024-03-31", "1").balance("T_b", "2024-03-31", "2")
    rows = [r.token_implementation for r in b.build().ordered("current_supplies_by_tokenimpl").collect()]
    assert rows == ["T_b", "T_A"]


def test_sql_users_can_query_the_views(spark, build):
    one_token(build).balance("T_A", "2024-03-31", "1").build().register_views()
    assert spark.sql("select sum(total_balance) from current_supplies_by_network").first()[0] == D("1.00000000")
