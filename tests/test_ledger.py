"""Incremental loads: buckets, versions, rules, repeated and killed runs, damaged files."""

import hashlib
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docledger.operators import lineage, tables
from docledger.plans import gold, loads, pipelines
from docledger.schemas import DOCUMENTS_TABLE, ITEMS_TABLE, columns
from docledger.sources import files
from docledger.sources.ledger import Ledger, Version, bucket_of_key

STAMPS = [f"2024-0{i}-01T00:00:00" for i in range(1, 7)]


@pytest.fixture
def batch(spark):
    def build(rows, run_ts=STAMPS[0], items=None):
        """Documents from (id, type, party, value), two items each unless ``items`` has (id, item, value)."""
        d = lambda v: None if v is None else Decimal(v)
        docs = [(i, t, None, p, "s", "USD", 2, d(v), d(v), None, d(v), d(0), d(0), f"in/{i}", "f") for i, t, p, v in rows]
        pairs = [(i, f"{p} {k}", d(v)) for i, _, p, v in rows for k in "ab"] if items is None else [(i, n, d(v)) for i, n, v in items]
        lines = [(i, n, "", d(1) if len(n) % 2 else None, v, v) for i, n, v in pairs]
        return (
            tables.load_defaults(spark.createDataFrame(docs, DOCUMENTS_TABLE), run_ts),
            spark.createDataFrame(lines, ITEMS_TABLE),
        )

    return build


def some(seed, ids):
    draw = random.Random(seed)
    return [(f"D-{i}", draw.choice(["invoice", "receipt"]), draw.choice(["p", "q", None]), draw.choice([None, 1, 20, 300])) for i in ids]


def contents(folder):
    return {p: hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.rglob("*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same_tables(ledger, documents, items):
    found = ledger.tables()
    assert rows(found[0]) == rows(documents.select(found[0].columns))
    assert rows(found[1].drop("id")) == rows(items.select(found[1].drop("id").columns))
    ids = [r.id for r in found[1].collect()]
    assert len(set(ids)) == len(ids)


def test_three_loads_are_keyed_replacement(spark, tmp_path, batch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    assert [df.count() for df in ledger.tables()] == [0, 0]
    documents = items = None
    for i, ids in enumerate([range(0, 100), [*range(90, 100), *range(100, 104)], [5, 400]]):
        new = batch(some(i, ids), STAMPS[i])
        before = contents(tmp_path / "l")
        version = loads.load_batch(ledger, *new, loads.run_identity("t", STAMPS[i]))
        after = contents(tmp_path / "l")
        assert before.items() <= after.items()  # no file is written again
        documents, items = (
            new if documents is None else (tables.replace_by_key(documents, new[0], new[0]), tables.replace_by_key(items, new[1], new[0]))
        )
        same_tables(ledger, documents, items)
        assert version.summary == {"loaded_docs": len(ids), "loaded_items": 2 * len(ids)} and version.number == i + 1
        views = gold.gold_tables(ledger, version, STAMPS[i])
        whole = ledger.tables()
        assert rows(views["v_summary_overview"]) == rows(gold.summary_overview(whole[0], STAMPS[i]))
        assert views["v_top_parties"].collect() == gold.top_parties(whole[0]).collect()
        assert views["v_top_items_by_frequency"].collect() == gold.top_items_by_frequency(whole[1]).collect()
        assert views["v_top_items_by_value"].collect() == gold.top_items_by_value(whole[1]).collect()
        assert "line_items" not in "".join(views["v_top_items_by_value"].inputFiles())
    last = {b for i in (5, 400) for b in bucket(spark, f"D-{i}")}
    runs = {b: version.parts[b] for b in version.parts if any(STAMPS[2][5:7] in r[6:8] for r in version.parts[b])}
    assert set(runs) == last  # other buckets keep the files they had
    # The bucket with only a new document was added to, the one with a replaced document was copied.
    (added,), (copied,) = bucket(spark, "D-400"), bucket(spark, "D-5")
    assert added != copied and len(version.parts[added]) > 1 and len(version.parts[copied]) == 2 and "kept" in version.parts[copied][0]


def bucket(spark, key):
    return [r[0] for r in spark.createDataFrame([(key,)], "document_id string").select(bucket_of_key(buckets=8)).collect()]


def test_a_load_reads_only_touched_buckets(spark, tmp_path, batch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    loads.load_batch(ledger, *batch(some(1, range(60))), "one")
    version = ledger.current()
    (b,) = bucket(spark, "D-7")
    read = ledger.read("documents", version, {b}).select("document_id")
    assert rows(read) == sorted((r.document_id,) for r in ledger.tables()[0].collect() if bucket(spark, r.document_id) == [b])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scan = ledger.read("documents", version, {b}).where("doc_type = 'invoice'")._jdf.queryExecution().executedPlan().toString()
    assert "doc_type" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_the_same_run_twice_changes_nothing(spark, tmp_path, batch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    first = loads.load_batch(ledger, *batch(some(1, range(20))), "run-1", replace=False)
    before = contents(tmp_path / "l")
    assert loads.load_batch(ledger, *batch(some(2, range(20))), "run-1", replace=False) == first
    assert contents(tmp_path / "l") == before and ledger.current() == first
    assert loads.run_identity("invoices", STAMPS[0]) == "invoices-20240101T000000"


def test_a_killed_load_leaves_the_old_version(spark, tmp_path, batch, monkeypatch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    loads.load_batch(ledger, *batch(some(1, range(50))), "one")
    before = [rows(df) for df in ledger.tables()]
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "publish", lambda self, version: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            loads.load_batch(ledger, *batch(some(2, range(40, 60))), "two")
    assert [rows(df) for df in ledger.tables()] == before and ledger.current().run_id == "one"
    reader = ledger.tables()  # resolved once
    loads.load_batch(ledger, *batch(some(2, range(40, 60))), "two")
    assert [rows(df) for df in reader] == before
    assert ledger.tables()[0].count() == 60 and ledger.tables()[1].count() == 120
    left = [rows(df) for df in ledger.tables()]
    gone = ledger.drop_unused()
    assert gone and all("two" in name for name in gone)  # what the killed attempt had written
    assert [rows(df) for df in ledger.tables()] == left and ledger.drop_unused() == []


def test_all_broken_rules_are_named(spark, tmp_path, batch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    loads.load_batch(ledger, *batch(some(1, range(10))), "one")
    before = [rows(df) for df in ledger.tables()]
    bad = [("D-50", "invoice", "p", 1), ("D-50", "invoice", "p", 1), ("D-51", None, "p", 1), (None, "receipt", "p", 1)]
    lines = [("D-50", "x", 1), ("D-3", "old", 1), ("D-99", "y", 1), ("D-98", "y", 1), (None, "z", 1)]
    with pytest.raises(loads.LoadRejected) as broken:
        loads.load_batch(ledger, *batch(bad, items=lines), "two")
    assert str(broken.value) == (
        "duplicate document_id: 1, e.g. D-50; missing document_id or doc_type: 2; line item without document_id: 1; "
        "line item of an unknown document: 2, e.g. D-98"
    )
    assert [rows(df) for df in ledger.tables()] == before
    with pytest.raises(loads.LoadRejected, match="duplicate document_id: 2, e.g. D-3$"):
        loads.load_batch(ledger, *batch(some(2, [3, 4, 70])), "three", replace=False)
    version = loads.load_batch(ledger, *batch([], items=[("D-3", "added", 5)]), "four", replace=False)
    assert version.summary == {"loaded_docs": 0, "loaded_items": 1} and ledger.tables()[1].count() == 21


def test_rules_take_one_aggregate(spark):
    keys = spark.createDataFrame([("a", 1)], "document_id string, bucket int")
    plan = loads.key_check(keys, keys, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_buckets_with_many_runs_are_copied(spark, tmp_path, batch, monkeypatch):
    monkeypatch.setattr(loads, "MAX_PARTS", 2)
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    for i in range(4):
        version = loads.load_batch(ledger, *batch(some(i, range(40 * i, 40 * i + 40))), f"run-{i}")
    assert max(map(len, version.parts.values())) <= 3 and ledger.tables()[0].count() == 160 and ledger.tables()[1].count() == 320
    ledger.drop_unused(keep=1)
    assert ledger.tables()[0].count() == 160
    assert ledger.current().last_id == 320 == max(r.id for r in ledger.tables()[1].collect())


def test_a_document_may_change_its_type_and_lose_its_items(spark, tmp_path, batch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    loads.load_batch(ledger, *batch([("a", "invoice", "p", 1), ("b", "invoice", "p", 1)]), "one")
    loads.load_batch(ledger, *batch([("a", "receipt", "q", 2)], items=[]), "two")
    assert sorted((r.document_id, r.doc_type, r.party_name) for r in ledger.tables()[0].collect()) == [("a", "receipt", "q"), ("b", "invoice", "p")]
    assert {r.document_id for r in ledger.tables()[1].collect()} == {"b"}


def test_empty_batches(spark, tmp_path, batch):
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=8)
    version = loads.load_batch(ledger, *batch([], items=[]), "none")
    assert version.summary == {"loaded_docs": 0, "loaded_items": 0} and [df.count() for df in ledger.tables()] == [0, 0]
    assert gold.gold_tables(ledger, version)["v_summary_overview"].first().n_docs == 0
    assert Version().live() is not None
    assert [name for name, _ in columns(DOCUMENTS_TABLE)] == [c for c in ledger.tables()[0].columns if c != "updated_at"]


HEADER = "item,description,quantity,unit_price,line_total\n"


def put(root, stem, items=HEADER + "Mix,hot,2.0,10.0,20.0\n", meta=None):
    folder = root / stem
    folder.mkdir(parents=True)
    if items is not None:
        (folder / "invoice_line_items.csv").write_text(items)
    known = json.dumps({"document_number_raw": f"{stem} ABC", "client_or_supplier": "Edge", "invoice_date": "27/08/2025", "source_path": f"in/{stem}.pdf"}, indent=2)
    if meta != "":
        (folder / "invoice_meta.json").write_text(meta or known)
    return known


def test_damaged_files_are_failures(spark, tmp_path):
    root = tmp_path / "bronze"
    known = put(root, "1")
    put(root, "2", HEADER + '"Mix, ""large""","two\nlines",1,2,2\nNail,,n/a,1.5,3\n')
    put(root, "3", HEADER)
    put(root, "4", meta=known[:40])
    put(root, "5", HEADER + "Mix,hot,2.0\n")
    put(root, "6", HEADER + 'Mix,hot,2.0,10.0,20.0\n"open,1,2,3,4\n')
    put(root, "7", "name,what,quantity,unit_price,line_total\nMix,hot,2.0,10.0,20.0\n")
    put(root, "8", items=None)
    put(root, "9", items="")
    put(root, "10", meta="")
    put(root, "11", HEADER + "Mix,hot,2.0,10.0,20.0,30.0\n")
    put(root, "12", meta="not json")
    run = pipelines.ingest_bronze_files(spark, str(root), "invoice", str(tmp_path / "ledger"), STAMPS[0])
    failed = {r.doc_stem: (r.path.rpartition("/")[2], r.error.partition(":")[0]) for r in run["failed"].collect()}
    items, meta = "invoice_line_items.csv", "invoice_meta.json"
    assert failed == {
        "4": (meta, "broken JSON"),
        "5": (items, "torn line"),
        "6": (items, "torn line"),
        "7": (items, "wrong header"),
        "8": (meta, "no line items file"),
        "9": (meta, "no line items file"),
        "10": (items, "no metadata file"),
        "11": (items, "torn line"),
        "12": (meta, "broken JSON"),
    }
    assert tuple(run["summary"].first()) == (3, 9, 3, 3, "ok")
    assert sorted(r.source_path for r in run["documents"].collect()) == ["in/1.pdf", "in/2.pdf", "in/3.pdf"]
    found = sorted((r.item, r.description, r.quantity, r.line_total) for r in run["line_items"].collect())
    d = Decimal
    assert found == [("Mix", "hot", d("2.000"), d("20.00")), ('Mix, "large"', "two\nlines", d("1.000"), d("2.00")), ("Nail", None, None, d("3.00"))]


def test_damaged_receipt_files(spark, tmp_path):
    for stem, meta in (("00", {"merchant_name": "WAL*MART", "subtotal_meta": 5.11, "source_path": "in/00.jpg"}), ("01", None)):
        folder = tmp_path / "bronze" / stem
        folder.mkdir(parents=True)
        (folder / "receipt_line_items.csv").write_text(HEADER + "BOLT,,1,4.00,4.00\n")
        (folder / "receipt_meta.json").write_text(json.dumps(meta) if meta else "{\"merchant_name\": ")
    run = pipelines.ingest_bronze_files(spark, str(tmp_path / "bronze"), "receipt", str(tmp_path / "ledger"), STAMPS[0])
    assert [(r.doc_stem, r.error) for r in run["failed"].collect()] == [("01", "broken JSON")]
    assert [(r.document_id, r.items_count, r.sum_line_total) for r in run["documents"].collect()] == [("WALMART-00-NA", 1, Decimal("4.00"))]
    assert [r.document_id for r in run["line_items"].collect()] == ["WALMART-00-NA"]
    assert files.read_bronze_items(spark, str(tmp_path / "bronze"), "receipt").count() == 1
    assert run["documents"].where(F.col("doc_type") == "receipt").count() == 1


def test_a_load_leaves_no_scratch_files(spark, tmp_path, batch, monkeypatch):
    """Rows written to be numbered are removed, and numbering them deals none."""
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(lineage, "fresh_folder", lambda _, name: f"{scratch}/{name}-{len(list(scratch.glob('*')))}")
    spark.sparkContext.setCheckpointDir(str(scratch / "checkpoints"))
    ledger = Ledger(spark, str(tmp_path / "l"), buckets=4)
    documents, items = batch(some(1, range(30)))
    numbered = tables.assign_line_id(items.repartition(3), 5)
    assert sorted(r.id for r in numbered.collect()) == list(range(6, 66))
    assert [p for p in scratch.rglob("part-*") if p.suffix == ".parquet"]
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(_part" not in plan.split("BroadcastHashJoin")[0]
    lineage.spent(numbered)
    loads.load_batch(ledger, documents, items, "one")
    loads.load_batch(ledger, documents.limit(7), items.where("false"), "two")
    assert not [p for p in scratch.rglob("*") if p.is_file() and p.name.startswith("part-")]


def test_only_spent_files_go(spark, tmp_path, monkeypatch):
    names = iter("abc")
    monkeypatch.setattr(lineage, "fresh_folder", lambda *_: str(tmp_path / next(names)))
    one, other = lineage.stored(spark.range(5)), lineage.stored(spark.range(7))
    lineage.spent(lineage.read_from(one.select("id"), one), spark.range(3))
    assert not (tmp_path / "a").exists() and other.count() == 7
