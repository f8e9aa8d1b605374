"""Each query against its SQL text, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import rows

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_names_agree():
    assert set(entry.QUERIES) == set(entry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(SF))
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = rows(names, cursor.fetchall())
    assert expected, "the check would be empty"
    assert rows(df.columns, df.collect()) == expected


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "date" and len(df.columns) == 37 and not df.isEmpty()


@pytest.mark.parametrize("hidden", ["marketspark.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "ahocorasick"])
def test_the_market_queries_need_no_corpus_library(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(len(set(e.QUERIES) & set(e.queries())))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[1], check=True)
    assert int(done.stdout) == len(entry.QUERIES)
