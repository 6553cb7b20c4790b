"""Removal of byte strings that stand in several places, by column-wise ordering of many contents at once.

The order of all suffixes of a collection can be built column by column: starting at the last symbol, each round
puts one more symbol in front of every member, keeps the members sorted by what follows, and updates the longest
common prefixes of neighbours. Here the members are the contents of one anchor (see :mod:`repeats`), aligned at it: equal
windows lie in equal columns, so one order per column is enough, and no member has more than ``2 * width`` columns,
however long its document. A window stands elsewhere if a neighbour in its column's order shares ``width`` symbols. The
contents are the sorted external files that Spark's shuffle writes and a task reads in sequence.

Defined cases. Null text: no bytes. Documents shorter than ``width``: nothing removed. Rows equal in all columns are
different places, so each of them repeats the other. Ids may be null or repeated. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.repeats import Windows, removed_ranges, repeated_ranges
from docledger.llm.store import map_arrow, row_key

WIDTH, GRAM = 400, 32
OUTSIDE = 256


def neighbours_share(group: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
    """For members in rows of ``columns`` (``OUTSIDE`` where a member has no symbol), true where the ``width`` symbols from
    a column on are also those of another member of the same ``group``. ``group`` is sorted."""
    members, total = columns.shape
    share = np.zeros((members, total), bool)
    order = np.arange(members)
    common = np.zeros(members + 1, np.int32)  # of a member and the one before it; the last entry is for the reduction only
    for at in range(total - 1, -1, -1):
        symbol = columns[order, at].astype(np.int64)
        rank = group[order] * 512 + symbol
        moved = np.argsort(rank, kind="stable")
        rank, symbol = rank[moved], symbol[moved]
        pairs = np.empty((members - 1, 2), np.int64)
        pairs[:, 0], pairs[:, 1] = moved[:-1] + 1, moved[1:] + 1
        alike = (rank[1:] == rank[:-1]) & (symbol[1:] != OUTSIDE)
        updated = np.zeros(members + 1, np.int32)
        if alike.any():
            least = np.minimum.reduceat(common, pairs[alike].ravel())[::2]
            updated[1:members][alike] = least + 1
        order, common = order[moved], updated
        close = common >= width
        share[order, at] = close[:members] | close[1:]
    return share


def compare_columns(width: int):
    def compare(block: list[dict]) -> list[tuple[int, list[tuple[int, int]]]]:
        lead = np.array([r["lead"] for r in block])
        size = np.array([len(r["content"]) for r in block])
        left = int(lead.max())
        columns = np.full((len(block), left + int((size - lead).max())), OUTSIDE, np.uint16)
        for i, row in enumerate(block):
            columns[i, left - lead[i] : left - lead[i] + size[i]] = np.frombuffer(row["content"], np.uint8)
        group = np.cumsum(np.diff([r["anchor"] for r in block], prepend=block[0]["anchor"]) != 0)
        share = neighbours_share(group, columns, width)
        out = []
        for i, row in enumerate(block):
            hit = share[i, left - lead[i] : left - lead[i] + row["n"]]
            if row["copies"] == 1 and hit.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                out.append((i, [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]))
        return out

    return compare


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (removed ranges of bytes) and ``kept``, the bytes left.

    Each byte goes that is covered by a string of ``width`` bytes which also starts anywhere else in the collection.
    """
    ranges = repeated_ranges(
        docs,
        Windows(width, gram, words=False),
        compare_columns(width),
        order=["c1", "c2", "n"],
        whole=F.col("copies") > 1,
        hot_value=F.sum("copies"),
        hot_windows=F.col("seen") > 1,
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers.text_bytes(batch.column("text"))
            spans, kept = [], []
            for i, (starts, ends) in enumerate(removed_ranges(batch, width)):
                text = data[offsets[i] : offsets[i + 1]]
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)])
                left = zip([0, *ends], [*starts, len(text)], strict=True)
                kept.append(b"".join(text[a:b].tobytes() for a, b in left))
            spans = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), spans, pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    whole = docs.select(row_key().alias("k"), "doc_id", "text").join(ranges, "k", "left").drop("k")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(whole, apply, f"doc_id {doc_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
