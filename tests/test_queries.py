"""Every query of the core library against its SQL on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from tidemark import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def text(value):
    return ("nan" if value != value else repr(round(value, 9) + 0.0)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, tables, name):
    result = plans.queries()[name](spark, SF)
    columns = sorted(result.columns)
    got = sorted(tuple(map(text, row)) for row in result.select(*columns).collect())
    found = tables.execute(plans.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(text(row[i]) for i in places) for row in found.fetchall())


def test_the_index_of_current_files_makes_its_outcomes_once(spark, monkeypatch):
    from tidemark import fixtures

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    views = fixtures.load(spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    views["lineitem"] = lines.mapInArrow(counted, lines.schema)
    views["lineitem"].createOrReplaceTempView("lineitem")
    monkeypatch.setattr(fixtures, "load", lambda *_: views)
    assert plans.queries()["current_files_index"](spark, SF).count() > 0
    assert made.value == lines.count()


def test_results_take_less_room_than_their_texts(spark, tmp_path, monkeypatch):
    from tidemark.plans import files

    monkeypatch.setattr(files, "shared_folder", lambda _, name: str(tmp_path / name))
    assert plans.queries()["ingest_results"](spark, SF).count() > 0
    room = sum(p.stat().st_size for p in (tmp_path / "results").rglob("part-*"))
    assert room < spark.read.text(str(tmp_path / "results")).selectExpr("sum(length(value))").first()[0] / 5


def differing(spark, name, documents):
    """(rows of the SQL only, rows of the query only) over other documents, given as SQL for DuckDB."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS {documents}")
    result = plans.queries()[name](spark, SF)
    found = con.execute(plans.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    want, got = (Counter(tuple(map(text, row)) for row in rows) for rows in (found.fetchall(), result.select(*columns).collect()))
    return want - got, got - want


def test_a_csv_catalog_may_be_in_any_store(spark, tmp_path, monkeypatch):
    from tidemark.plans import files

    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.csvstore.link./lists", f"file://{tmp_path}")
    monkeypatch.setattr(files, "shared_folder", lambda _, name: f"viewfs://csvstore/lists/{name}")
    assert differing(spark, "csv_catalog", f"SELECT * FROM '{SF}/documents.parquet'") == ({}, {})


def with_documents(spark, monkeypatch, change):
    """Let queries read the documents with a column that is made otherwise; the same as SQL for DuckDB."""
    from tidemark import fixtures

    views = fixtures.load(spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    views["documents"] = documents.selectExpr(*(f"{change[c]} AS {c}" if c in change else c for c in documents.columns))
    views["documents"].createOrReplaceTempView("documents")
    monkeypatch.setattr(fixtures, "load", lambda *_: views)
    return "SELECT " + ", ".join(f"{change.get(c, c)} AS {c}" for c in documents.columns) + f" FROM '{SF}/documents.parquet'"


@pytest.mark.parametrize("shift", [-100, -1_000_000, 2**53 + 1])
@pytest.mark.parametrize("name", ["csv_catalog", "folder_catalog", "file_checksum", "verify_pinned_files"])
def test_days_hold_for_all_ids(spark, monkeypatch, name, shift):
    documents = with_documents(spark, monkeypatch, {"doc_id": f"doc_id + {shift}"})
    assert differing(spark, name, documents) == ({}, {})


def test_a_csv_catalog_of_documents_without_characters(spark, monkeypatch):
    documents = with_documents(spark, monkeypatch, {"n_chars": "CASE WHEN doc_id % 5 = 0 THEN 0 WHEN doc_id % 5 = 1 THEN NULL ELSE n_chars END"})
    assert differing(spark, "csv_catalog", documents) == ({}, {})
