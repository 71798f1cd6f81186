import datetime as dt
from decimal import Decimal as D

from conftest import day, table
from pyspark.sql import functions as F

from satlake.operators.adjust import bridge_edges, helper_dependencies_bridges
from satlake.plans import supplies


def bridged(build):
    """T: native on A, bridged to B and C; D has no parent implementation."""
    return (
        build()
        .network("native").network("A").network("B", explorer=None).network("C").network("D")
        .token("T").token("S", type="staking").token("L", type="liquid_staking")
        .token("X", depegged=True).token("Y", depegged=None).token("U", type=None)
        .impl("T", "A", "native").impl("T", "B", "A").impl("T", "C", "A", address="0x2")
        .impl("T", "D", "Z", address="0x3")
        .impl("S", "A", "native").impl("S", "B", "A", address="Tabc")
        .impl("L", "A", "native").impl("L", "B", "A", address="")
        .impl("X", "A", "native").impl("X", "B", "A")
        .impl("Y", "A", "native").impl("U", "A", None, address=None)
    )


def test_edges_need_origin_digit_address_and_peg(build):
    cat = bridged(build).build()
    assert table(bridge_edges(cat), "parent", "child") == [
        ("T_A", "T_B"), ("T_A", "T_C"), ("T_Z", "T_D"),
    ]


def test_dependencies_hold_sorted_children(build):
    rows = helper_dependencies_bridges(bridged(build).build()).collect()
    found = {r.token_implementation: (r.token_type, r.tokens_to_subtract) for r in rows}
    assert found == {"T_A": ("wrapped", ["T_B", "T_C"]), "T_Z": ("wrapped", ["T_D"])}


def test_current_uses_each_childs_own_latest_date(build):
    b = bridged(build)
    b.balance("T_A", "2024-01-01", "50").balance("T_A", "2024-01-05", "100")
    b.balance("T_B", "2024-01-03", "10").balance("T_C", "2024-01-06", "7").balance("T_D", "2024-01-01", "3")
    b.balance("X_A", "2024-01-05", "9").balance("Y_A", "2024-01-05", "9")
    rows = table(supplies.current_supplies_by_tokenimpl(b.build()), "token_implementation", "balance", "rank")
    assert rows == [
        ("T_A", D("83.00000000"), 1), ("T_B", D("10.00000000"), 2), ("T_C", D("7.00000000"), 3),
        ("T_D", D("3.00000000"), 4),
    ]


def test_raw_keeps_depegged_and_ranks_ties(build):
    b = bridged(build)
    b.balance("T_A", "2024-01-05", "9").balance("X_A", "2024-01-04", "9").balance("Y_A", "2024-01-05", "5")
    rows = table(supplies.helper_current_supplies_raw(b.build()), "token_implementation", "rank")
    assert rows == [("T_A", 1), ("X_A", 1), ("Y_A", 3)]


def test_historical_subtracts_on_the_same_date_only(build):
    b = bridged(build)
    b.balance("T_A", "2024-01-01", "50").balance("T_A", "2024-01-02", "60")
    b.balance("T_B", "2024-01-01", "10").balance("T_C", "2024-01-01", "5").balance("T_B", "2024-01-03", "4")
    b.balance(None, "2024-01-01", "1").balance(None, "2024-01-01", "1")
    cat = b.build()
    rows = table(cat.view("helper_token_balances_adjusted"), "token_implementation", "date", "balance", "id")
    assert rows == [
        ("T_A", day("2024-01-01"), D("35.00000000"), 1),
        ("T_A", day("2024-01-02"), D("60.00000000"), 2),
        ("T_B", day("2024-01-01"), D("10.00000000"), 3),
        ("T_B", day("2024-01-03"), D("4.00000000"), 5),
        ("T_C", day("2024-01-01"), D("5.00000000"), 4),
        (None, day("2024-01-01"), D("1.00000000"), 6),
        (None, day("2024-01-01"), D("1.00000000"), 7),
    ]


def test_adjusted_keeps_created_at(build):
    b = bridged(build).balance("T_A", "2024-01-01", "50").balance("T_B", "2024-01-01", "10")
    rows = table(b.build().view("helper_token_balances_adjusted"), "token_implementation", "created_at")
    assert rows == [("T_A", dt.datetime(2024, 1, 1, 0, 1)), ("T_B", dt.datetime(2024, 1, 1, 0, 2))]


def test_chain_subtracts_one_level_of_raw_balances(build):
    b = build().network("native").network("A").network("B").network("C").token("T")
    b.impl("T", "A", "native").impl("T", "B", "A").impl("T", "C", "B")
    for impl, amount in (("T_A", "100"), ("T_B", "40"), ("T_C", "15")):
        b.balance(impl, "2024-01-01", amount)
    rows = table(supplies.current_supplies_by_tokenimpl(b.build()), "token_implementation", "balance")
    assert rows == [("T_A", D("60.00000000")), ("T_B", D("25.00000000")), ("T_C", D("15.00000000"))]


def test_network_totals_keep_one_null_address_at_the_end(build):
    b = bridged(build).impl("T", "A2", slug="T_A2", address="0x9").network("A2")
    b.balance("T_A", "2024-01-01", "5").balance("U_A", "2024-01-02", "6").balance("S_A", "2024-01-01", "1")
    row = supplies.current_supplies_by_network(b.build()).collect()[0]
    assert (row.network_slug, row.total_balance, row.latest_date) == ("A", D("12.00000000"), day("2024-01-02"))
    assert row.tokens == ["S", "T", "U"] and row.token_addresses == ["0x1", None]


def test_type_filters_drop_unknown_types(build):
    b = bridged(build)
    for impl in ("T_A", "S_A", "L_A", "U_A", "X_A", "Y_A"):
        b.balance(impl, "2024-01-01", "2")
    cat = b.build()
    assert table(supplies.historical_supplies_by_tokenproject(cat), "token_slug", "rank") == [("L", 1), ("T", 1)]
    assert table(supplies.historical_supplies_by_staking(cat), "token_slug") == [("S",)]
    assert table(supplies.historical_supplies_by_liquidstaking(cat), "token_slug") == [("L",)]
    assert table(supplies.historical_supplies_by_network(cat), "network_slug", "total_balance") == [
        ("A", D("4.00000000"))
    ]


def test_history_by_implementation_has_current_ranks_or_zero(build):
    b = bridged(build).impl("T", None, slug="T_none", address="0x8")
    b.balance("T_A", "2024-01-01", "5").balance("S_A", "2024-01-01", "9").balance("T_none", "2024-01-01", "1")
    rows = table(
        supplies.historical_supplies_by_tokenimpl(b.build()), "identifier", "amount", "network_rank", "project_rank"
    )
    assert rows == [
        ("A_S", D("9.00000000"), 1, 1), ("A_T", D("5.00000000"), 1, 2), ("_T", D("1.00000000"), 0, 2),
    ]


def test_totals_agree_across_groupings(build):
    b = bridged(build)
    for i, impl in enumerate(("T_A", "T_B", "T_C", "S_A", "L_A", "U_A")):
        b.balance(impl, "2024-01-01", str(10 * i + 1))
    cat = b.build()
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    whole = total(supplies.current_supplies_by_tokenimpl(cat), "balance")
    assert whole == total(supplies.current_supplies_by_network(cat), "total_balance")
    assert whole == total(supplies.current_supplies_by_tokenproject(cat), "total_balance")


def test_one_date_range_can_be_recomputed_alone(build):
    from satlake.operators.adjust import helper_token_balances_adjusted

    b = bridged(build)
    for d in ("2024-01-01", "2024-01-02"):
        b.balance("T_A", d, "50").balance("T_B", d, "10")
    cat = b.build()
    one_day = cat.token_balances.where(F.col("date") == F.lit(day("2024-01-02")))
    whole = helper_token_balances_adjusted(cat).where(F.col("date") == F.lit(day("2024-01-02")))
    assert table(helper_token_balances_adjusted(cat, one_day), "id", "balance") == table(whole, "id", "balance")


def test_dimensions_beyond_the_broadcast_bound_give_the_same(build, monkeypatch):
    from satlake import catalog
    from satlake.operators import ranking

    b = bridged(build)
    for i, impl in enumerate(("T_A", "T_B", "T_C", "S_A", "L_A", "X_A")):
        b.balance(impl, "2024-01-01", str(10 * i + 1)).balance(impl, "2024-03-30", str(7 * i + 1))
    cat = b.build()
    names = (
        "current_supplies_by_tokenimpl", "current_supplies_by_network", "historical_supplies_by_tokenimpl",
        "top_gainers_by_tokenimpl", "top_gainers_by_tokenimpl_absolute", "historical_supplies_by_tokenproject",
    )
    small = {n: table(cat.view(n), *cat.view(n).columns) for n in names}
    monkeypatch.setattr(catalog, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ranking, "SINGLE_TASK_ROWS", 0)
    cat = b.build()
    for n in names:
        assert table(cat.view(n), *cat.view(n).columns) == small[n], n
