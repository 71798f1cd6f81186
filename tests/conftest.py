import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from satlake.catalog import Catalog  # noqa: E402
from satlake.schemas import BASE_TABLES, schema  # noqa: E402
from satlake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "satlake-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def dec(text):
    return None if text is None else Decimal(text)


class Builder:
    """Small hand-made catalogs."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {t: [] for t in BASE_TABLES}
        self.as_of = day("2024-03-31")

    def network(self, slug, explorer="https://e"):
        self.rows["networks"].append(dict(slug=slug, name=f"Net {slug}", explorer=explorer))
        return self

    def token(self, slug, type="wrapped", depegged=False):
        self.rows["tokens"].append(
            dict(slug=slug, name=f"Token {slug}", token_name=slug, type=type, depegged=depegged)
        )
        return self

    def impl(self, token, network, origin=None, address="0x1", decimals="8", slug=None, reserves=None):
        self.rows["token_implementations"].append(
            dict(
                slug=slug or f"{token}_{network}",
                token=token,
                network=network,
                network_origin=origin,
                token_address=address,
                token_decimals=decimals,
                reserve_implementations=reserves,
            )
        )
        return self

    def balance(self, impl, date, amount):
        n = len(self.rows["token_balances"]) + 1
        self.rows["token_balances"].append(
            dict(
                date=day(date),
                token_implementation=impl,
                balance=dec(amount),
                created_at=dt.datetime(2024, 1, 1, 0, n % 60),
                id=n,
            )
        )
        return self

    def reserve(self, derivative, date, amount, collateral="c", network="n", address="a", rid=None):
        self.rows["reserve_balances"].append(
            dict(
                date=day(date),
                balance=dec(amount),
                derivative_token=derivative,
                collateral_token=collateral,
                reserve_network=network,
                reserve_address=address,
                reserve_implementation_id=rid,
            )
        )
        return self

    def reserve_impl(self, rid, derivative, collateral, address="a", network="n"):
        self.rows["reserve_implementations"].append(
            dict(
                id=rid,
                slug=f"{derivative}__backedby__{collateral}__{rid}",
                tag=str(rid),
                derivative_token=derivative,
                collateral_token=collateral,
                reserve_address=address,
                reserve_network=network,
            )
        )
        return self

    def price(self, token, date, usd):
        n = len(self.rows["price"]) + 1
        self.rows["price"].append(
            dict(id=n, date=date and day(date), token_slug=token, token_name=token, price_usd=dec(usd))
        )
        return self

    def frame(self, table):
        columns = schema(table)
        rows = [tuple(r.get(f.name) for f in columns) for r in self.rows[table]]
        return self.spark.createDataFrame(rows, columns)

    def build(self):
        return Catalog(self.spark, {t: self.frame(t) for t in BASE_TABLES}, self.as_of)


@pytest.fixture
def build(spark):
    return lambda: Builder(spark)


def table(df, *columns):
    """Rows as sorted tuples of the named columns."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
