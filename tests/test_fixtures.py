import datetime as dt
from decimal import Decimal as D

from conftest import day
from pyspark.sql import functions as F

from satlake import fixtures
from satlake.catalog import Catalog


def source(spark):
    """Line items of ten years, with a supplier that comes twice and lines that refer to nothing."""
    rows = {
        "region": ([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": (
            [(1, "S1", 0), (2, "S2", 1), (2, "S2", 1), (None, "S3", 1), (4, None, 0)],
            "s_suppkey bigint, s_name string, s_nationkey int",
        ),
        "part": ([(1, "Brand#1"), (2, "Brand#12"), (3, None), (4, "Brand#3")], "p_partkey bigint, p_brand string"),
        "lineitem": (
            [
                (
                    n % 5 + 1,
                    n % 6 if n % 7 else None,
                    float(n % 50),
                    n / 8,
                    dt.datetime(2000, 1, 1) + dt.timedelta(n // 4) if n % 11 else None,
                )
                for n in range(4000)
            ],
            "l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
        ),
    }
    return {name: spark.createDataFrame(*made) for name, made in rows.items()}


def test_positions_take_one_shuffle_and_lie_by_date(spark, tmp_path):
    found = source(spark)
    positions = fixtures._daily_positions(found.get, fixtures._suppliers(found.get))
    plan = positions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(date") == 1

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        positions.write.parquet(f"{tmp_path}/positions")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kept = spark.read.parquet(f"{tmp_path}/positions")
    spans = kept.selectExpr("date", "_metadata.file_path as file").groupBy("file").agg(
        F.min("date").alias("low"), F.max("date").alias("high")
    )
    spans = sorted((r.low, r.high) for r in spans.collect() if r.low)
    assert len(spans) > 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))

    totals = {}
    regions = {0: "AFRICA", 1: "ASIA"}
    parts, suppliers = found["part"].collect(), found["supplier"].collect()
    for line in found["lineitem"].collect():
        for part in parts:
            for held in suppliers:
                if line.l_partkey == part.p_partkey and line.l_suppkey is not None and line.l_suppkey == held.s_suppkey:
                    when = line.l_shipdate and line.l_shipdate.date()
                    key = (when, part.p_brand, held.s_nationkey, regions[held.s_nationkey], held.s_suppkey, held.s_name)
                    old = totals.get(key, (0, 0))
                    totals[key] = (old[0] + D(line.l_quantity), max(old[1], D(line.l_extendedprice)))
    rows = {
        (r.date, r.p_brand, r.k, r.r_name, r.s_suppkey, r.s_name): (r.quantity, r.top_price) for r in kept.collect()
    }
    assert rows == totals and kept.count() == len(totals)


def test_staged_reserves_are_those_of_the_positions(spark, tmp_path):
    """The reserves are made distinct by few columns first; the texts may still fall together."""
    found = source(spark)
    for name, df in found.items():
        df.write.parquet(f"{tmp_path}/in/{name}.parquet")
    fixtures._write_balances(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    positions = spark.read.parquet(f"{tmp_path}/out/positions").collect()
    wanted = {
        (r.s_suppkey * 100 + r.b if r.b is not None else None, r.s_name, r.r_name, r.p_brand and f"{r.p_brand}_{r.r_name}")
        for r in positions
    }
    held = spark.read.parquet(f"{tmp_path}/out/reserve_implementations").collect()
    assert {(r.id, r.reserve_address, r.reserve_network, r.collateral_token) for r in held} == wanted
    assert len(held) == len(wanted)
    facts = Catalog.from_parquet(spark, f"{tmp_path}/out", day("2003-01-01")).reserve_balances
    assert facts.count() == len(positions)
