"""The polled sources: network, decoder and the rules that differ by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values. Networks whose tokens report a hex total supply under result.
EVM_HEX_NETWORKS = (
    "Arbitrum", "Avalanche", "Ethereum", "Base", "Optimism", "PolygonPoS", "Merlin",
    "BNBSmartChain", "Mantle", "Berachain", "Ink", "Soneium", "Sonic", "BOB", "Bsquared", "Corn",
    "Hemi", "Fantom", "Gnosis", "PolygonzkEVM", "Scroll", "zkSync", "Zeta", "Taiko", "Core", "Mode",
)

# Fixed values. Networks that also report reserves.
RESERVE_NETWORKS = (
    "Arbitrum", "Avalanche", "Ethereum", "Base", "Optimism", "PolygonPoS", "Merlin",
)

# Fixed values. Other sources: (source, network, decoder).
OTHER_SOURCES = (
    ("Bitlayer", "Bitlayer", "evm_int"),
    ("BEVM", "BEVM", "evm_int"),
    ("Rootstock", "Rootstock", "evm_hex_default18"),
    ("Botanix", "Botanix", "evm_hex_any_places"),
    ("Hyperliquid", "Hyperliquid", "unminted_cap"),
    ("Rollux", "Rollux", "explorer_json"),
    ("Mezo", "Mezo", "explorer_self"),
    ("Solana", "Solana", "token_amount"),
    ("Starknet", "Starknet", "felt_hex"),
    ("Stacks", "Stacks", "clarity_hex"),
    ("Sui", "Sui", "coin_value"),
    ("Tron", "Tron", "object_or_number"),
    ("InternetComputer", "InternetComputer", "metrics_text"),
    ("Libre", "Libre", "asset_string"),
    ("Lightning", "Lightning", "capacity_or_series"),
    ("Liquid", "Liquid", "bare_sats"),
    ("Babylon", "Babylon", "active_tvl"),
    ("CoreStaking", "Core", "staked_amount"),
    ("BitcoinReserves", None, "utxo_sums"),
)

# Fixed values. Sources that store a supply of zero.
KEEP_ZERO = (
    "Rootstock", "Botanix", "Hyperliquid", "Mezo", "Solana", "Sui", "Tron", "CoreStaking",
    "BitcoinReserves",
)

# Fixed values. Sources whose runs are final only when called 'final';
# everywhere else any call but 'incremental' is final.
FINAL_ONLY = ("Sui", "Tron", "Hyperliquid")

# Fixed values. Sources that read the block at the start of the day.
START_OF_DAY = ("Bitlayer",)

# Fixed values. Tokens read by their own decoder: (source, token, decoder).
SPECIAL_TOKENS = (
    ("Rootstock", "Rootstock-RBTC_Rootstock", "native_cap"),
    ("Botanix", "Botanix-BTC_Botanix", "native_cap"),
)

# Fixed values. Sources that handle a single token only.
SINGLE_TOKEN = (("Hyperliquid", "Unit-UBTC_Hyperliquid"),)

# Fixed values. Sources whose number is stored under one implementation.
STORED_AS = (("CoreStaking", "Core-stakedBTC_staking"),)

# Fixed values. Derivative tokens backed by addresses on the base chain.
BASE_CHAIN = "bitcoin"
BASE_CHAIN_BACKED = "Simple-sBTC_Fractal"

CONFIG_SCHEMA = """
    source STRING, network STRING, decoder STRING, keep_zero BOOLEAN, final_only BOOLEAN,
    start_of_day BOOLEAN, special_token STRING, special_decoder STRING, only_token STRING,
    stored_as STRING"""


def default_sources() -> list[tuple]:
    """(source, network, decoder, keep_zero, final_only, start_of_day, special…, only_token, stored_as)."""
    special = {source: (token, decoder) for source, token, decoder in SPECIAL_TOKENS}
    single, stored = dict(SINGLE_TOKEN), dict(STORED_AS)
    rows = [(n, n, "evm_hex") for n in EVM_HEX_NETWORKS] + list(OTHER_SOURCES)
    return [
        (
            source,
            network,
            decoder,
            source in KEEP_ZERO,
            source in FINAL_ONLY,
            source in START_OF_DAY,
            *special.get(source, (None, None)),
            single.get(source),
            stored.get(source),
        )
        for source, network, decoder in rows
    ]


def _literal(value: str | bool | None) -> str:
    if value is None:
        return "null"
    return str(value).lower() if isinstance(value, bool) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def source_config(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The configuration as literal rows; its size is fixed by the list of sources."""
    fields = T.StructType.fromDDL(CONFIG_SCHEMA).fields
    if rows is None:
        rows = default_sources()
    if not rows:
        return spark.createDataFrame([], CONFIG_SCHEMA)
    values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
    said = spark.sql(f"select * from values {values} as t({', '.join(f.name for f in fields)})")
    return said.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
