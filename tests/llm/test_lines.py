import random

import brute
import corpus_pipeline

from docledger.llm import line_templates, queries, store


def results(df):
    return sorted(((r["doc_id"], r["n_lines"], r["dropped"], r["text"]) for r in df.collect()), key=repr)


def test_like_brute_force(make):
    draw = random.Random(4)
    names = ["ann", "bob", "cy", "dee", "eve", "fay"]
    rows = []
    for i in range(60):
        lines = [" ".join(f"t{draw.randrange(60)}" for _ in range(draw.randrange(1, 9))) for _ in range(6)]
        lines += [f"Dear reader of page {i} this is {draw.choice(names)} writing", "All rights reserved.", "1 2 3"]
        if i % 3 == 0:
            lines += ["one two three four", "one two three five", ""]
        draw.shuffle(lines)
        rows.append((draw.choice([i, i, None]), "\n".join(lines)))
    rows += [(1, None), (2, ""), (3, "All rights reserved."), (4, "x\n\n y"), rows[0]]
    expected = sorted(brute.recurring_lines(rows, 5), key=repr)
    assert any(gone for _, _, gone, _ in expected)
    assert results(line_templates.drop_recurring_lines(make(rows))) == expected


def test_odd_rows_and_empty_tables(make, odd_rows):
    found = line_templates.drop_recurring_lines(make(odd_rows), min_documents=2)
    assert results(found) == sorted(brute.recurring_lines(odd_rows, 2), key=repr)
    assert line_templates.drop_recurring_lines(make([])).count() == 0


def test_copies_keep_their_lines(make):
    text = "\n".join(f"line number {x} of a text that is copied" for x in "abcdefgh")
    found = results(line_templates.drop_recurring_lines(make([(i, text) for i in range(9)])))
    assert all(gone == [] and kept == text for _, _, gone, kept in found)


def test_columns_stay(make):
    docs = make([(1, "a b c d")])
    assert line_templates.drop_recurring_lines(docs, names=("lines", "gone")).columns == [*docs.columns, "lines", "gone"]


def test_lines_go_whatever_their_share(spark, tmp_path, make):
    """Short pages that are mostly shared lines lose them; copies, changed ones too, do not lose their text to each other."""
    shared = [f"All {x} rights are reserved by the owner of these pages and nobody else may copy them" for x in ("first", "second", "third", "fourth")]
    own = [" ".join(f"{chr(97 + i)}{chr(97 + n)}z" for n in range(20)) for i in range(12)]
    rows = [(i, "\n".join([*shared, own[i]])) for i in range(12)]
    text = [" ".join(f"word{chr(97 + i)}{chr(97 + n)}" for n in range(15)) for i in range(8)]
    rows += [(100 + i, "\n".join([*text[:i], text[i] + " changed", *text[i + 1 :]])) for i in range(8)]
    rows += [(200 + i, "\n".join(text)) for i in range(6)]
    make(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    stage = corpus_pipeline.STAGES[1][1](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    kept = {r["doc_id"]: r["text"] for r in stage.collect()}
    assert kept == {i: own[i] if i < 100 else t for i, t in rows}
    counts = {r["doc_id"]: r["n_dropped"] for r in queries.op1_line_templates(spark, str(tmp_path)).collect()}
    assert counts == {i: 4 if i < 100 else 0 for i, _ in rows}


def test_fields_are_general_at_every_size(make):
    """Lines with names from one vocabulary recur in a small corpus and in one of a hundred times the rows."""
    letters = "abcdefghijklmnopqrst"
    firsts, lasts, cities = ([f"{kind}{x}" for x in letters] for kind in ("first", "last", "city"))
    for n in (30, 3000):
        draw = random.Random(n)
        name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
        rows = []
        for i in range(n):
            line = f"Report filed by {draw.choice(firsts)} {draw.choice(lasts)} in {draw.choice(cities)} yesterday evening"
            rows.append((i, f"{line}\n{' '.join(f'own{x}{name(i)}' for x in letters)}"))
        found = line_templates.drop_recurring_lines(make(rows)).collect()
        assert sum(r["dropped"] == [0] for r in found) == n


def test_files_of_finished_steps_go(make, monkeypatch):
    """Lines, tokens and chosen texts are not kept until the end."""
    written, settled = [], line_templates.settled
    monkeypatch.setattr(line_templates, "settled", lambda df: written.append(settled(df)) or written[-1])
    rows = [(i, f"the same line in each text\n{brute.prose(i, 30)}") for i in range(8)]
    found = line_templates.recurring_lines(make(rows), by_class=True)
    assert {(r["k"]["doc_id"], r["line"]) for r in found.collect()} == {(i, 0) for i in range(8)}
    left = [set(df.columns) for df in written if df in store._folders]
    assert left and not any(c & {"once", "token", "sample", "text"} for c in left)
