"""Registry of the published views and of their row orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog
from satlake.operators.adjust import helper_dependencies_bridges, helper_token_balances_adjusted
from satlake.plans import gainers, prices, reserves, supplies

VIEWS: dict[str, Callable[[Catalog], DataFrame]] = {
    "helper_current_supplies_by_tokenimpl_raw": supplies.helper_current_supplies_raw,
    "helper_dependencies_bridges": helper_dependencies_bridges,
    "helper_reserves_summed": reserves.helper_reserves_summed,
    "helper_token_balances_adjusted": helper_token_balances_adjusted,
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
}


def _down(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in columns]


def _up(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


# Row order of each view when it is read on its own; NULL sorts as greatest.
ROW_ORDER: dict[str, Callable[[], list[Column]]] = {
    "helper_current_supplies_by_tokenimpl_raw": lambda: _down("balance"),
    "helper_dependencies_bridges": lambda: _up("token_implementation"),
    "helper_reserves_summed": lambda: _up("date", "derivative_token"),
    "helper_token_balances_adjusted": lambda: _down("date") + _up("token_implementation"),
    "current_supplies_by_tokenimpl": lambda: _down("balance"),
    "current_supplies_by_network": lambda: _down("total_balance"),
    "current_supplies_by_tokenproject": lambda: _down("total_balance"),
    "current_reserves_by_tokenimpl": lambda: _down("balance"),
    "current_by_tokenimpl": lambda: _down("supply_balance"),
    "historical_supplies_by_network": lambda: _down("date", "total_balance"),
    "historical_supplies_by_tokenproject": lambda: _down("date", "total_balance"),
    "historical_supplies_by_staking": lambda: _down("date", "total_balance"),
    "historical_supplies_by_liquidstaking": lambda: _down("date", "total_balance"),
    # A missing rank is shown as 0, and 0 sorts last here as a missing one does.
    "historical_supplies_by_tokenimpl": lambda: _down("project_rank", "network_rank", "date"),
    "top_gainers_by_tokenimpl": lambda: _up("period") + _down("percent_change"),
    "top_gainers_by_tokenimpl_absolute": lambda: _up("period") + _down("supply_change"),
    "current_prices": lambda: _up("token_slug"),
}
