import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from satlake.llm.oracles import ORACLES
from satlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_everything_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cursor.fetchall(), columns)
