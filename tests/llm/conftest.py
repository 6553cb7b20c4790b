import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import prose  # noqa: E402

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns of the input.
EXTRA = "k string, score string, size string, toxic string, anchor string, draw string, weight string, value string, n string, slice string, taken string, dropped string, threshold string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or longer rows, with extra columns of clashing names."""

    def build(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
        if not extra:
            return spark.createDataFrame(full, DOCUMENT)
        return spark.createDataFrame([(*r, *["x"] * len(EXTRA.split(","))) for r in full], f"{DOCUMENT}, {EXTRA}")

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, one very long text."""
    long = prose(1, 30_000)
    return [
        (None, None),
        (None, "no id here but some words"),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, prose(2, 300)),
        (4, prose(2, 300)),
        (4, prose(3, 120)),
        (5, prose(2, 300)),
        (6, long),
        (7, long + " end"),
        (8, "é" * 900 + "\n" + "Ünïcode wörds 漢字 " * 70),
        (9, "é" * 900),
    ]
