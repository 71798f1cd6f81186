"""The base tables, their measured dimension sizes, and the named views."""

from __future__ import annotations

import copy
import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.schemas import BASE_TABLES, schema
from satlake.sources.tables import MONTH, is_table, read_monthly, read_table

FACTS = ("token_balances", "reserve_balances")

# Tables kept next to the facts by their upserts (satlake.plans.maintain): the
# latest rows of a fact table by a key, and the adjusted history.
LATEST = {
    ("token_balances", "token_implementation"): "latest_token_balances",
    ("reserve_balances", "derivative_token"): "latest_reserve_balances",
    ("reserve_balances", "reserve_implementation_id"): "latest_reserves_by_id",
}
ADJUSTED = "adjusted_balances"
KEPT = {**{name: table for (table, _), name in LATEST.items()}, ADJUSTED: "token_balances"}

# A dimension is broadcast by hint only up to this many rows; beyond it Spark
# picks the join from its own size estimates and run-time shuffle sizes.
BROADCAST_ROWS = 200_000

PERIOD_FILTER = re.compile(r"^eq\.(.+)$")


def counted(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Catalog:
    """Base tables of the data model as DataFrames.

    ``as_of`` stands for the current date in the views that compare with past
    days; it defaults to today.  A catalog is a snapshot: its facts are those
    of the moment it was made, whatever is written since.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.date | None = None):
        missing = [t for t in BASE_TABLES if t not in tables]
        if missing:
            raise ValueError(f"missing tables: {missing}")
        self.spark = spark
        self.tables = dict(tables)
        self.as_of = as_of
        self._counts: dict[str, int] = {}
        # Facts that lie in month partitions, with their month.
        self.monthly: dict[str, DataFrame] = {}
        # Tables kept by the upserts: latest rows and the adjusted history.
        self.kept: dict[str, DataFrame] = {}
        self.root: str | None = None
        self._use_kept = False

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, root: str, as_of: dt.date | None = None, use_kept: bool = True
    ) -> Catalog:
        """Scan the base tables below ``root`` with their fixed schemas, flat or in months.

        With ``use_kept`` the views read the tables that the upserts keep,
        where there are any, instead of the whole history.
        """
        monthly = _monthly_facts(spark, root)
        flat = {t: scan_table(spark, root, t) for t in BASE_TABLES if t not in monthly}
        cat = cls(spark, {**flat, **monthly}, as_of)
        cat.root, cat._use_kept = root, use_kept
        cat._set_facts(monthly)
        return cat

    def reopened(self) -> Catalog:
        """The same catalog over the tables as they are now; the dimensions stay as they were read."""
        if self.root is None:
            return self
        found = copy.copy(self)
        found._set_facts(_monthly_facts(self.spark, self.root))
        return found

    def _set_facts(self, monthly: dict[str, DataFrame]) -> None:
        self.monthly = monthly
        self.tables = {**self.tables, **{t: df.drop(MONTH) for t, df in monthly.items()}}
        names = [n for n in KEPT if self._use_kept and is_table(self.spark, f"{self.root}/{n}")]
        self.kept = {n: read_table(self.spark, f"{self.root}/{n}", KEPT[n]) for n in names}

    def recent_rows(self, table: str, key: str) -> DataFrame:
        """Rows of a fact table that hold all of the latest date of each ``key``: the kept table, or the whole one."""
        return self.kept.get(LATEST[table, key], self.tables[table])

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("tables", {})
        if name in tables:
            return tables[name]
        raise AttributeError(name)

    @property
    def as_of_column(self):
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    def on_days(self, table: str, days: list[Column]) -> DataFrame:
        """Rows of a fact table on some days; constant days prune its months."""
        dated = F.col("date").isin(*days)
        if table not in self.monthly:
            return self.tables[table].where(dated)
        months = [F.date_format(d, "yyyy-MM") for d in days]
        return self.monthly[table].where(F.col(MONTH).isin(*months) & dated).drop(MONTH)

    def dimension_rows(self, table: str) -> int:
        """Size of a dimension, counted once per catalog (file footers only)."""
        if table not in self._counts:
            self._counts[table] = self.tables[table].count()
        return self._counts[table]

    @property
    def implementation_rows(self) -> int:
        return self.dimension_rows("token_implementations")

    def small(self, df: DataFrame, table: str) -> DataFrame:
        """Mark a side with at most one row per row of a dimension for broadcast.

        The bound is checked against the counted dimension; a larger side is
        left to the planner, which shuffles it or re-plans at run time.
        """
        return F.broadcast(df) if self.dimension_rows(table) <= BROADCAST_ROWS else df

    def per_implementation(self, df: DataFrame) -> DataFrame:
        return self.small(df, "token_implementations")

    def view(self, name: str, filters: dict[str, str] | None = None) -> DataFrame:
        """A published view by name, with ``eq.<value>`` column filters, over the tables as they are now."""
        from satlake.plans.views import VIEWS

        if name not in VIEWS:
            raise KeyError(f"unknown view {name!r}; known: {sorted(VIEWS)}")
        df = VIEWS[name](self.reopened())
        for column, condition in (filters or {}).items():
            match = PERIOD_FILTER.match(condition)
            if not match:
                raise ValueError(f"only eq.<value> filters are supported, got {condition!r}")
            df = df.where(F.col(column) == match.group(1))
        return df

    def ordered(self, name: str, filters: dict[str, str] | None = None) -> DataFrame:
        """The view in its published row order (a total sort, so only on request)."""
        from satlake.plans.views import ROW_ORDER

        return self.view(name, filters).orderBy(*ROW_ORDER[name]())

    def register_views(self) -> None:
        """Create temporary views for SQL users: base tables and published views.

        They show the tables as they are now; calling it again shows what has
        been written since.
        """
        from satlake.plans.views import VIEWS

        now = self.reopened()
        for name, df in now.tables.items():
            df.createOrReplaceTempView(name)
        for name, build in VIEWS.items():
            build(now).createOrReplaceTempView(name)


def _monthly_facts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: read_monthly(spark, f"{root}/{t}", t) for t in FACTS if is_table(spark, f"{root}/{t}")}


def scan_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(schema(name)).parquet(f"{root}/{name}")
