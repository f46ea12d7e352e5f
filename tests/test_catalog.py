"""Every registered query of the library against its SQL, at the smallest size."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import watermark
from tidemark.plans import catalog, stored_catalog  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def _norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return "NULL"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_equals_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem", "events", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(_norm(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall())
    got = sorted(tuple(_norm(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == want


def test_entry_works_without_the_optional_subpackage(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_lines_of_archives_are_not_broadcast(spark):
    """Their size is guessed from the archives' listing; only what has a row a file may go through the driver."""
    df = stored_catalog.landed_zip(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.split("== Initial Plan ==")[0].splitlines() if "Join [archive#" in x and "Inner" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)


def test_a_plan_of_files_reads_its_names_once(spark, tmp_path):
    day = F.lit("2024-01-01").cast("date")
    files = spark.range(6).select(F.lit("A").alias("symbol"), F.concat(F.lit("f"), F.col("id")).alias("name"), F.add_months(day, F.col("id").cast("int") % 3).alias("period"), (F.col("id") > 2).alias("daily"))
    files.write.parquet(str(tmp_path / "files"))
    marks = spark.createDataFrame([("A",)], "symbol string").withColumn("watermark", day)
    plan = watermark.file_plan(spark.read.parquet(str(tmp_path / "files")), marks, ["symbol"], F.lit("2024-03-15").cast("date"))
    assert {r.name for r in plan.collect()} == {"f0", "f1", "f5"}
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
