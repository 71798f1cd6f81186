"""Fixed schemas of the seven base tables, the landed inputs and the outputs."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

BALANCE = "decimal(20,8)"
TOTAL = "decimal(38,8)"

DDL = {
    "networks": """
        slug STRING NOT NULL, name STRING NOT NULL, explorer STRING,
        is_bitcoin_layer BOOLEAN, created_at TIMESTAMP_NTZ""",
    "tokens": """
        slug STRING NOT NULL, name STRING NOT NULL, project_name STRING, project_slug STRING,
        token_name STRING, token_slug STRING, type STRING, created_at TIMESTAMP_NTZ,
        depegged BOOLEAN""",
    "token_implementations": """
        slug STRING NOT NULL, name STRING, token STRING, network STRING, network_origin STRING,
        token_decimals STRING, token_address STRING, reserve_implementations STRING, degree INT""",
    "reserve_implementations": """
        slug STRING NOT NULL, reserve_address STRING, reserve_network STRING,
        derivative_token STRING, collateral_token STRING, tag STRING, id INT NOT NULL""",
    # Row ids of the facts are widened to BIGINT: 2^31 rows are not enough here.
    "token_balances": """
        date DATE NOT NULL, token_implementation STRING, balance DECIMAL(20,8) NOT NULL,
        created_at TIMESTAMP_NTZ, id BIGINT NOT NULL""",
    # Best poll so far per implementation and day, with its place in the order.
    "daily_values": """
        date DATE NOT NULL, token_implementation STRING, balance DECIMAL(20,8),
        poll_order DECIMAL(38,0)""",
    "reserve_balances": """
        date DATE NOT NULL, balance DECIMAL(20,8) NOT NULL, created_at TIMESTAMP_NTZ,
        reserve_implementation_id INT, reserve_network STRING, collateral_token STRING,
        derivative_token STRING, reserve_address STRING NOT NULL""",
    "price": """
        id BIGINT NOT NULL, date DATE, token_slug STRING, token_name STRING,
        price_usd DECIMAL(18,8)""",
    "blocks": """
        height BIGINT, hash STRING, time BIGINT,
        tx ARRAY<STRUCT<txid: STRING,
            vout: ARRAY<STRUCT<value: DECIMAL(16,8), scriptPubKey: STRUCT<hex: STRING>>>>>""",
    "staking_hits": """
        block_height BIGINT, block_hash STRING, txid STRING, value DECIMAL(16,8),
        script_hex STRING, timestamp STRING""",
    "staking_values": "block_height BIGINT, txid STRING, value DECIMAL(16,8)",
    "observations": """
        seq BIGINT, source STRING, token_implementation STRING, observed_at TIMESTAMP_NTZ,
        effective_day DATE, is_final BOOLEAN, payload STRING, status INT""",
}


@cache
def schema(name: str) -> T.StructType:
    """Schema of a table; parsed by the running session."""
    return T.StructType.fromDDL(DDL[name])


BASE_TABLES = (
    "networks",
    "tokens",
    "token_implementations",
    "reserve_implementations",
    "token_balances",
    "reserve_balances",
    "price",
)

TOKEN_KEY = ("token_implementation", "date")
RESERVE_KEY = ("date", "reserve_network", "reserve_address", "collateral_token", "derivative_token")

# Uniqueness rules: table -> keys. A row with a NULL key part is exempt.
UNIQUE_KEYS: dict[str, tuple[tuple[str, ...], ...]] = {
    "networks": (("slug",),),
    "tokens": (("slug",), ("project_slug", "token_slug")),
    "token_implementations": (("slug",),),
    "reserve_implementations": (("id",), ("reserve_address", "collateral_token")),
    "token_balances": (("id",), TOKEN_KEY),
    "reserve_balances": (RESERVE_KEY,),
    "price": (("id",), ("date", "token_slug")),
}

# References: (table, column, referenced table); all delete in cascade.
FOREIGN_KEYS = (
    ("token_implementations", "network", "networks"),
    ("token_implementations", "network_origin", "networks"),
    ("token_implementations", "token", "tokens"),
    ("reserve_implementations", "collateral_token", "token_implementations"),
    ("reserve_implementations", "derivative_token", "token_implementations"),
    ("token_balances", "token_implementation", "token_implementations"),
    ("reserve_balances", "reserve_implementation_id", "reserve_implementations"),
)

# Token types that the views distinguish by name.
STAKING = "staking"
LIQUID_STAKING = "liquid_staking"
