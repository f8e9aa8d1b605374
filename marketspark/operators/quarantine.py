"""Records that a rule rejects, kept once per version of the file they came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.dates import day
from marketspark.operators.quality import Rule, kinds
from marketspark.operators.upsert import upsert
from marketspark.schemas import CORRUPT, FILE_LINEAGE, LETTER
from marketspark.sources.tables import read_by_date

FILE_VERSION = ("feed", "source_file", "file_modified")
_MARKS = ("reject_reasons", "first_reason")


def letters(screened: DataFrame, feed: str) -> DataFrame:
    """The rejected rows of ``screened`` (see ``with_reasons``, with file lineage) as dead letters.

    ``document`` is the raw text of what could not be parsed whole, else the record as JSON.
    Equal documents of one file are one letter with their number. ``date`` is the day the
    file was written, by which the table is partitioned.
    """
    lineage = set(FILE_LINEAGE.fieldNames())
    fields = [name for name in screened.columns if name not in {*lineage, *_MARKS, CORRUPT}]
    document = f"to_json(struct({', '.join(f'`{name}`' for name in fields)}))"
    if CORRUPT in screened.columns:
        document = f"coalesce({CORRUPT}, {document})"
    rows = screened.where("first_reason is not null").selectExpr(
        "cast(file_modified as date) as date", f"'{feed}' as feed", *FILE_LINEAGE.fieldNames(), f"{document} as document", *_MARKS)
    return rows.withColumn("document_sha256", F.sha2("document", 256)).groupBy(
        "date", *FILE_VERSION, "document", "document_sha256", *_MARKS).agg(F.expr("count(*) as copies")).select(*LETTER.fieldNames())


def quarantine(dead: DataFrame, path: str, grain: str = "month") -> None:
    """Put dead letters into the table at ``path``. Those of a file version replace what it had before.

    Reading a file again, in another window or after a failure, therefore changes nothing,
    and a new version of it adds its own letters.
    """
    upsert(dead, path, (*FILE_VERSION, "document_sha256"), ("copies",), grain, replaced=FILE_VERSION)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All dead letters; empty where there are none yet."""
    table = read_by_date(spark, path, LETTER)
    return spark.createDataFrame([], LETTER) if table is None else table


def records(dead: DataFrame, schema: T.StructType) -> DataFrame:
    """The letters' documents as records of their feed, with the reasons; a field that cannot be read is null."""
    return dead.select(F.from_json("document", schema).alias("record"), *_MARKS, "source_file", "file_modified").select(
        "record.*", *_MARKS, "source_file", "file_modified")


def daily_attrition(screened: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Rows before and after each rule per day, where a rule sees the survivors of those before it.

    A record belongs to its date; one without a readable date to the day its file was
    written, with ``dated`` false. Days can be replaced one by one and added up.
    """
    last = len(rules)
    readable = day("date", kinds(screened)["date"], allow_time=True)
    counts = [f"count_if(first_reason = '{rule.name}') as r{i + 1}" for i, rule in enumerate(rules)]
    removed = lambda upto: " + ".join(["0", *(f"r{i + 1}" for i in range(upto))])
    steps = ", ".join(
        f"struct('{table}' as table_name, {i + 1} as step, '{rules[i].name}' as rule, n - ({removed(i)}) as rows_before, "
        f"r{i + 1} as rows_removed, n - ({removed(i + 1)}) as rows_after)" for i in range(last))
    return (
        screened.selectExpr(
            f"coalesce({readable}, cast(file_modified as date)) as date", f"{readable} is not null as dated", "first_reason")
        .groupBy("date", "dated").agg(F.expr("count(*) as n"), *map(F.expr, counts))
        .selectExpr("date", "dated", f"inline(array({steps}))")
    )


def attrition_totals(daily: DataFrame) -> DataFrame:
    """Attrition over all days."""
    sums = [F.expr(f"sum({name}) as {name}") for name in ("rows_before", "rows_removed", "rows_after")]
    return daily.groupBy("table_name", "step", "rule").agg(*sums)

