import pathlib
import random

import brute
from pyspark.sql import functions as F

from docledger.llm import secret_ownership, store


def spans(row, kinds=("assign", "access", "hex")):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["found"] if s["kind"] in kinds]


def test_base_spans_like_python(make):
    draw = random.Random(6)
    parts = ["password", "Api_Key", "apikey", "SECRET", "token", "pass", "AKIA", "AKIAAB12", "\u017fecret", " ", "  ", ":", "=", '"', "'", "\n", "é漢😀"]
    parts += ["abcdef0123456789", "0123", "ABCDEFGHIJKLMNOP", "x.y/z+w=", "deadbeef", "zz", "-_"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(0, 60)))) for i in range(300)]
    rows += [(1000, "token:secret =abcdefghijklmnop"), (1001, "token: " + "a1" * 50_000), (1002, "f" * 200_000 + " AKIA" + "B" * 14)]
    found = {r["doc_id"]: r for r in secret_ownership.secrets_by_document(make(rows)).collect()}
    for i, text in rows:
        assert spans(found[i]) == brute.base_spans(text), text[:200]
        counts = [sum(s.startswith(k) for s in brute.base_spans(text)) for k in ("assign", "access", "hex")]
        assert [found[i]["n_assign"], found[i]["n_access"], found[i]["n_hex"]] == counts


def test_owners_tell_examples_from_leaks(make):
    example, live = "password = Examp1eValue-2024", "password = Qz8kLm3vRt7XwB"
    rows = [(i, example, "en", f"src{i}") for i in range(5)] + [(10 + i, live, "en", "src1") for i in range(5)]
    rows += [(20, "see ghp_Q8dkVm3vRt7XwBz0aLpE here", "en", "src2"), (21, "token: aaaaaaaaaaaaaaaa", "en", "src2")]
    found = {r["doc_id"]: r["found"] for r in secret_ownership.secrets_by_document(make(rows)).collect()}
    assert {found[i][0]["verdict"] for i in range(5)} == {"example"} and found[0][0]["owners"] == 5
    assert {found[10 + i][0]["verdict"] for i in range(5)} == {"live"} and found[10][0]["repositories"] == 5
    assert [s["kind"] for s in found[20]] == ["opaque"] and found[21][0]["verdict"] == "weak"


def test_no_clear_value_is_written(spark, make):
    """No file that steps share holds a value, only hashes."""
    value = "Wk3xPq9LmZt7RvB2nYc5"
    rows = [(1, f"password = {value}"), (2, f"see {value} here")]
    found = secret_ownership.secrets_by_document(make([(*r, "en", "src") for r in rows])).collect()
    assert {r["doc_id"]: [s["kind"] for s in r["found"]] for r in found} == {1: ["assign"], 2: ["opaque"]}
    folder = pathlib.Path(store.shared_folder(spark)) / f"docledger-{spark.sparkContext.applicationId}"
    assert any(folder.iterdir())
    for path in folder.iterdir():
        for row in spark.read.parquet(str(path)).select(F.to_json(F.struct("*")).alias("row")).where(F.col("row").contains(value)).collect():
            raise AssertionError(row)


def test_odd_rows(make, odd_rows):
    rows = [(*r, "en", None) for r in odd_rows] + [(4, "secret=abcdefghijkl", "en", "a"), (4, "secret=abcdefghijkl", "en", "b")]
    found = secret_ownership.secrets_by_document(make(rows)).collect()
    assert len(found) == len(rows) and sum(r["n_assign"] for r in found) == 2
    assert secret_ownership.secrets_by_document(make([])).count() == 0


def test_no_python_in_the_plan(make):
    plan = secret_ownership.secrets_by_document(make([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
