import datetime as dt
from decimal import Decimal as D

from conftest import day, table
from pyspark.sql import functions as F

from satlake.operators import blocks
from satlake.plans import decode
from satlake.schemas import schema
from satlake.sources import chain, tables
from satlake.streaming import daily


def stamp():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


def polls(spark, *rows):
    """(seq, slug, 'day hour', effective day, final, amount) with the amount as payload."""
    filled = [
        (seq, "s", slug, dt.datetime.fromisoformat(at), day(eff), final, amount, 200)
        for seq, slug, at, eff, final, amount in rows
    ]
    return spark.createDataFrame(filled, schema("observations"))


FIRST = (
    (1, "a", "2024-01-01T04:00", "2024-01-01", False, "1"),
    (2, "a", "2024-01-01T08:00", "2024-01-01", False, "2"),
    (3, "b", "2024-01-01T08:00", "2024-01-01", False, "3"),
)
SECOND = (
    (4, "a", "2024-01-02T00:15", "2024-01-01", True, "4"),
    (5, "a", "2024-01-02T04:00", "2024-01-02", False, "5"),
    (6, "b", "2024-01-01T07:00", "2024-01-01", False, "6"),
)


def values(spark, path):
    return daily.stream_observations(spark, path).withColumn("balance", F.col("payload").cast("decimal(20,8)"))


def run_into_balances(spark, tmp_path, build, *batches):
    """Drain, land more, drain again from the same checkpoint."""
    names = ("landing", "values", "balances", "checkpoint")
    landing, target, balances, checkpoint = (str(tmp_path / n) for n in names)
    tables.create_table(spark, target, "daily_values")
    tables.create_table(spark, balances, "token_balances")
    for batch in batches:
        polls(spark, *batch).write.mode("append").parquet(landing)
        daily.stream_daily_values(build(values(spark, landing)), target, checkpoint, stamp(), balances)
    return tables.read_table(spark, balances, "token_balances")


LATE = (
    (7, "a", "2024-03-01T00:15", "2024-03-01", False, "7"),
    (8, "b", "2024-01-01T09:00", "2024-01-01", False, "8"),
    (9, "a", "2024-01-01T23:00", "2024-01-01", False, "9"),
)


def test_finalized_days_equal_the_batch_result_however_late(spark, tmp_path):
    names = ("landing", "values", "balances", "checkpoint")
    landing, target, balances, checkpoint = (str(tmp_path / n) for n in names)
    tables.create_table(spark, target, "daily_values")
    tables.create_table(spark, balances, "token_balances")
    # The last two polls arrive after one that is two months younger.
    for batch in (FIRST, SECOND, LATE[:1], LATE[1:]):
        polls(spark, *batch).write.mode("append").parquet(landing)
        candidates = daily.finalize_day(values(spark, landing))
        daily.stream_daily_values(candidates, target, checkpoint, stamp(), balances)
    want = decode.daily_last(spark.read.parquet(landing).withColumn("balance", F.col("payload").cast("decimal(20,8)")))
    columns = ("token_implementation", "date", "balance")
    assert table(tables.read_table(spark, target, "daily_values"), *columns) == table(want, *columns) == [
        ("a", day("2024-01-01"), D("4.00000000")), ("a", day("2024-01-02"), D("5.00000000")),
        ("a", day("2024-03-01"), D("7.00000000")), ("b", day("2024-01-01"), D("8.00000000")),
    ]
    got = tables.read_table(spark, balances, "token_balances")
    assert table(got, *columns) == table(want, *columns)


def test_daily_last_value_by_day_of_observation(spark, tmp_path):
    got = run_into_balances(spark, tmp_path, daily.daily_last_value, FIRST, SECOND)
    assert table(got, "token_implementation", "date", "balance") == [
        ("a", day("2024-01-01"), D("2.00000000")), ("a", day("2024-01-02"), D("5.00000000")),
        ("b", day("2024-01-01"), D("3.00000000")),
    ]


def test_late_polls_and_failed_ones(spark, tmp_path):
    days = ("2024-01-10", "2024-01-14", "2024-01-15", "2024-01-11", "2024-01-16")
    batches = [((i, "a", f"{d}T01:00", d, False, str(i)),) for i, d in enumerate(days)]
    batches += [((9, "a", "2024-01-10T05:00", "2024-01-10", False, None), (10, "z", "2024-01-10T05:00", "2024-01-10", False, None))]
    got = run_into_balances(spark, tmp_path, daily.finalize_day, *batches)
    assert table(got, "token_implementation", "date", "balance") == sorted(
        ("a", day(d), D(i).quantize(D("1.00000000"))) for i, d in enumerate(days)
    )


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    target, balances = str(tmp_path / "v"), str(tmp_path / "t")
    tables.create_table(spark, target, "daily_values")
    tables.create_table(spark, balances, "token_balances")
    batch = spark.createDataFrame(
        [("a", day("2024-01-01"), D("1"), D("1"))],
        "token_implementation string, date date, balance decimal(20,8), poll_order decimal(38,0)",
    )
    write = daily.write_daily_values(spark, target, balances, stamp())
    write(batch, 0)
    before = table(tables.read_table(spark, balances, "token_balances"), "token_implementation", "balance", "id")
    write(batch, 0)
    assert table(tables.read_table(spark, balances, "token_balances"), "token_implementation", "balance", "id") == before


def test_block_stream_resumes_after_the_finished_files(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("blocks", "hits", "checkpoint"))

    def block(height):
        outputs = [(D("1.5"), ("00",)), (D("0"), (blocks.STAKING_PREFIX,))]
        return (height, f"h{height}", 1704067200 + height, [(f"t{height}", outputs)])

    for heights in ((1, 2), (3,)):
        rows = spark.createDataFrame([block(h) for h in heights], schema("blocks"))
        rows.write.mode("append").json(landing)
        daily.stream_staking_outputs(chain.stream_blocks(spark, landing, "json"), target, checkpoint)
    assert table(spark.read.parquet(target), "block_height", "txid") == [(1, "t1"), (2, "t2"), (3, "t3")]
    assert table(blocks.staking_outputs(chain.read_blocks(spark, landing, "json")), "txid") == [("t1",), ("t2",), ("t3",)]


def test_latest_state_follows_the_stream(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    tables.create_table(spark, target, "daily_values")
    # Eight polls of one day, then an older day.
    polled = [("2024-01-02", str(amount), amount) for amount in range(1, 9)] + [("2024-01-01", "9", 99)]
    for batch in (polled[:5], polled[5:8], polled[8:]):
        rows = [(day(d), "a", D(amount), D(order)) for d, amount, order in batch]
        spark.createDataFrame(rows, schema("daily_values")).write.mode("append").parquet(landing)
        landed = spark.readStream.schema(schema("daily_values")).parquet(landing)
        daily.stream_latest_state(landed, target, checkpoint)
        got = tables.read_table(spark, target, "daily_values")
        assert table(got, "balance", "date") == [(D(batch[-1][1] if batch[-1][2] < 9 else 8).quantize(D("1.00000000")), day("2024-01-02"))]
