"""The registered queries: a sample runs beside its DuckDB statement; ``FULL_CHECK=1`` runs them all."""

import os

import pytest

import __spark_entry__ as contract
from workload import check

SAMPLE = (
    "v_summary_overview",
    "consistency_outliers",
    "invoice_top_suppliers",
    "invoice_document_id",
    "receipt_phone",
    "invoice_meta",
    "receipt_meta",
    "header_table_to_items",
    "choose_ocr_variant",
    "replace_by_key",
)
NAMES = tuple(contract.queries()) if os.environ.get("FULL_CHECK") else SAMPLE


@pytest.fixture(scope="module")
def duck(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_the_statement(spark, sf, duck, name):
    df = contract.queries()[name](spark, sf)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert check.compare(df, duck, sql) is None


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["supplier_name", "invoices", "total_value"] and df.count() == 5


def test_reports_read_only_their_type(spark, tmp_path):
    """On a documents table partitioned by type, a report prunes the other type's files."""
    from docledger.plans import reports
    from workload import views

    path = str(tmp_path / "documents")
    views.documents(spark, "/root/testdata/sf0.001").write.partitionBy("doc_type").parquet(path)
    plan = reports.receipt_top_merchants(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(doc_type" in plan and "ReadSchema: struct<supplier_name:string,total_meta:decimal(18,2)>" in plan


def test_a_long_order_is_one_receipt_in_both_engines(spark, sf, tmp_path):
    """An order of several buckets of lines prints as one text, with the same lines in the same places."""
    import shutil

    import pandas as pd

    for name in check.TABLES:
        shutil.copyfile(f"{sf}/{name}.parquet", tmp_path / f"{name}.parquet")  # not the mode: the tables are read-only
    lines = pd.read_parquet(f"{sf}/lineitem.parquet")
    key = next(k for k in sorted(lines.l_orderkey.unique()) if k % 3 == 0 and k % 13 != 5 and k % 7 != 3)
    own = lines[lines.l_orderkey == key]
    many = pd.concat([own] * (9_000 // len(own) + 1), ignore_index=True)
    many["l_linenumber"] = range(1, len(many) + 1)
    many = many.astype(lines.dtypes.to_dict())
    pd.concat([lines[lines.l_orderkey != key], many], ignore_index=True).to_parquet(tmp_path / "lineitem.parquet")
    from workload import views
    from workload.oracle_views import with_views

    texts = views.receipt_texts(spark, str(tmp_path))
    assert texts.where(f"doc_id = 'ORD-{key}'").count() == 1
    assert check.compare(texts, check.connect(str(tmp_path)), with_views("SELECT doc_id, text FROM fx_receipt_text")) is None
