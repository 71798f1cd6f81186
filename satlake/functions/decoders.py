"""How each kind of landed payload is read, stated as data.

A decoder says where the reported number is (``found``, text), in which form
it is written, and by how many places its decimal point moves.  The decode job
turns the specs in use into one CASE expression per step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from satlake.functions.scalars import metric_value, symbol_of_slug

HEX, INTEGER, DECIMAL = "hex", "integer", "decimal"

# Caps, unit places and payload markers of the sources.
COIN_CAP = 21_000_000
NATIVE_PLACES = 18
SAT_PLACES = 8
CLARITY_OK_UINT = "0x0701"
SUPPLY_METRIC = "ledger_total_supply"
HTTP_OK = 200


def _json(path: str) -> Callable[[Column, Column], Column]:
    return lambda payload, slug: F.get_json_object(payload, path)


def _config_places(payload: Column, decimals: Column) -> Column:
    return decimals.try_cast("int")


def _fixed_places(places: int) -> Callable[[Column, Column], Column]:
    return lambda payload, decimals: F.lit(places)


def _payload_places(path: str) -> Callable[[Column, Column], Column]:
    return lambda payload, decimals: F.get_json_object(payload, path).try_cast("int")


@dataclass(frozen=True)
class Decoder:
    found: Callable[[Column, Column], Column]
    form: str = INTEGER
    places: Callable[[Column, Column], Column] = _config_places
    needs_address: bool = False
    needs_decimals: bool = False
    zero_decimals_ok: bool = False
    checks_status: bool = False
    address_form: str | None = None
    cap: int | None = None
    ok: Callable[[Column], Column] | None = None


EVM_ADDRESS = "^(0x)?[0-9a-fA-F]{40}$"
TWO_PART_ADDRESS = r"^[^.]+\.[^.]*$"


def _clarity_value(payload: Column, slug: Column) -> Column:
    return F.replace(F.get_json_object(payload, "$.result"), F.lit(CLARITY_OK_UINT), F.lit(""))


def _object_or_number(payload: Column, slug: Column) -> Column:
    text = F.trim(payload)
    in_object = F.get_json_object(payload, "$.totalSupply")
    return F.coalesce(in_object, F.when(~text.startswith("{"), text))


def _asset_supply(payload: Column, slug: Column) -> Column:
    assets = F.from_json(payload, "map<string, struct<supply: string>>")
    supply = F.try_element_at(assets, symbol_of_slug(slug))["supply"]
    return F.nullif(F.split_part(supply, F.lit(" "), F.lit(1)), F.lit(""))


def _last_series_value(payload: Column) -> Column:
    points = F.from_json(F.get_json_object(payload, "$.results[0].series[0].values"), "array<array<string>>")
    return F.try_element_at(F.try_element_at(points, F.lit(-1)), F.lit(2))


def _capacity_or_series(payload: Column, slug: Column) -> Column:
    """Capacity in sats as coins, else the last series point as it stands."""
    sats = F.get_json_object(payload, "$.networkcapacity").try_cast("decimal(28,0)")
    coins = (sats * F.lit("0.00000001").cast("decimal(9,8)")).cast("string")
    return F.coalesce(coins, _last_series_value(payload))


def _utxo_difference(payload: Column, slug: Column) -> Column:
    funded = F.get_json_object(payload, "$.chain_stats.funded_txo_sum").try_cast("decimal(37,0)")
    spent = F.get_json_object(payload, "$.chain_stats.spent_txo_sum").try_cast("decimal(37,0)")
    return (funded - spent).cast("string")


def _first_word(payload: Column, slug: Column) -> Column:
    return F.nullif(F.trim(payload), F.lit(""))


DECODERS: dict[str, Decoder] = {
    "evm_hex": Decoder(_json("$.result"), HEX, needs_address=True, needs_decimals=True),
    "evm_int": Decoder(_json("$.result"), INTEGER, needs_address=True, needs_decimals=True),
    # 18 places unless configured; the address only has to look like one.
    "evm_hex_default18": Decoder(
        _json("$.result"),
        HEX,
        places=lambda payload, decimals: F.coalesce(decimals.try_cast("int"), F.lit(NATIVE_PLACES)),
        needs_address=True,
        address_form=EVM_ADDRESS,
    ),
    "evm_hex_any_places": Decoder(
        _json("$.result"), HEX, needs_address=True, needs_decimals=True, zero_decimals_ok=True
    ),
    "native_cap": Decoder(
        _json("$.result"), HEX, places=_fixed_places(NATIVE_PLACES), needs_address=True, cap=COIN_CAP
    ),
    "unminted_cap": Decoder(
        _json("$.result"),
        HEX,
        places=_fixed_places(SAT_PLACES),
        needs_address=True,
        address_form=EVM_ADDRESS,
        cap=COIN_CAP,
    ),
    "explorer_json": Decoder(
        _json("$.total_supply"), needs_address=True, needs_decimals=True, checks_status=True
    ),
    "explorer_self": Decoder(
        _json("$.total_supply"),
        places=_payload_places("$.decimals"),
        needs_address=True,
        needs_decimals=True,
        zero_decimals_ok=True,
        checks_status=True,
    ),
    "token_amount": Decoder(
        _json("$.result.value.amount"),
        places=_payload_places("$.result.value.decimals"),
        needs_address=True,
    ),
    "felt_hex": Decoder(_json("$.result[0]"), HEX, needs_address=True, needs_decimals=True),
    "clarity_hex": Decoder(
        _clarity_value,
        HEX,
        needs_address=True,
        needs_decimals=True,
        zero_decimals_ok=True,
        checks_status=True,
        address_form=TWO_PART_ADDRESS,
        ok=lambda payload: F.get_json_object(payload, "$.okay") == "true",
    ),
    "coin_value": Decoder(_json("$.result.value"), needs_decimals=True, zero_decimals_ok=True),
    "object_or_number": Decoder(_object_or_number, DECIMAL, checks_status=True),
    "metrics_text": Decoder(
        lambda payload, slug: metric_value(payload, SUPPLY_METRIC),
        places=_fixed_places(SAT_PLACES),
        needs_address=True,
        checks_status=True,
    ),
    "asset_string": Decoder(_asset_supply, DECIMAL, checks_status=True),
    "capacity_or_series": Decoder(_capacity_or_series, DECIMAL, checks_status=True),
    "bare_sats": Decoder(
        _first_word, places=_fixed_places(SAT_PLACES), needs_address=True, checks_status=True
    ),
    "active_tvl": Decoder(
        _json("$.data.active_tvl"), places=_fixed_places(SAT_PLACES), checks_status=True
    ),
    "staked_amount": Decoder(
        _json("$.data.stakedBTCAmount"), places=_fixed_places(SAT_PLACES), checks_status=True
    ),
    "utxo_sums": Decoder(_utxo_difference, places=_fixed_places(SAT_PLACES), checks_status=True),
}
