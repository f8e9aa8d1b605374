"""What the operators share: shipped code, stored tables, ordinary expressions."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from marketspark.session import scratch

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Give the package to Python workers, which need not have it installed. Once per application."""
    sc = spark.sparkContext
    if not any(str(name).endswith("marketspark-code.zip") for name in sc._python_includes):
        target = Path(tempfile.mkdtemp(prefix="marketspark-code-")) / "marketspark-code.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(_PACKAGE.rglob("*.py")):
                out.write(file, file.relative_to(_PACKAGE.parent))
        sc.addPyFile(str(target))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`keep` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
