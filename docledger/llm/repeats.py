"""Repeated windows across documents: the parts that the byte and the word operator share.

A *window* is ``width`` consecutive symbols of one document. Its *anchor* is the leftmost smallest ``gram``-gram in it, so
equal windows have equal anchors at equal places. Neighbouring windows with one anchor form a *run*; what a run covers
is its *content*, at most ``2 * width - gram`` symbols.

1. Each document is cut into runs; a run is a row of hashes. Runs whose anchor stands nowhere else are done with.
2. Equal contents are counted with partial aggregation, so exact copies of any number become one row.
3. Only anchors with several different contents need symbols. These contents are cut out of one document each and go, by
   anchor, to tasks that compare them with a method of the operator's own (``compare``).
4. An anchor with more than ``GROUP_ROWS`` contents, such as a passage in a large group of near copies, is not gathered:
   its contents are dealt out as single windows, by window hash, and counted with partial aggregation. The result is
   the same.
5. What was found goes back to the runs and, as ranges, to the documents.

Hashes of contents and windows have 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.store import map_arrow, row_key, settled

CHUNK = 1 << 20
GROUP_ROWS = 2048
CONTENT = ["anchor", "c1", "c2", "n", "lead"]
RANGES = "array<struct<a:int,b:int>>"


@dataclass(frozen=True)
class Windows:
    width: int
    gram: int
    words: bool


def row_groups(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows with together about ``most`` bytes, at least one."""
    row = 0
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, last
        row = last


def symbol_values(data: np.ndarray, offsets: np.ndarray, words: bool, values: int = 2) -> tuple[list[np.ndarray], np.ndarray]:
    """Two 64-bit values for each symbol, or just the first one, and the rows' offsets in symbols."""
    if not words:
        return [of_byte[data] for of_byte in buffers.BYTE_VALUES[:values]], offsets
    starts, ends, at = buffers.word_spans(data, offsets)
    out = [np.empty(len(starts), np.uint64) for _ in buffers.BASES[:values]]
    step = 1 << 17
    for a in range(0, len(starts), step):
        lo, hi = starts[a], ends[min(a + step, len(starts)) - 1]
        for which, of_word in enumerate(out):
            of_word[a : a + step] = buffers.word_hashes(data[lo:hi], starts[a : a + step] - lo, ends[a : a + step] - lo, which)
    return out, at


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def find_runs(windows: Windows) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers.text_bytes(batch.column("text"))
            for first, last in row_groups(offsets, CHUNK):
                values, at = symbol_values(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], windows.words)
                for rows, starts, ends in buffers.pieces(at, windows.width, CHUNK):
                    lo, hi = starts[0], ends[-1]
                    if hi - lo < windows.width:
                        continue
                    rolls = [buffers.Rolling(v[lo:hi], which) for which, v in enumerate(values)]
                    grams = rolls[0].windows(windows.gram)
                    row, run, n, anchor = buffers.anchored_runs(grams, np.append(starts, hi) - lo, windows.width, windows.gram)
                    if not len(row):
                        continue
                    row = rows[row]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("k").take(pa.array(row + first)),
                            *(
                                pa.array(x)
                                for x in (
                                    _signed(grams[anchor]),
                                    *(_signed(r.ranges(run, run + n + windows.width - 1)) for r in rolls),
                                    n.astype(np.int32),
                                    (anchor - run).astype(np.int32),
                                    (run + lo - at[row]).astype(np.int32),
                                )
                            ),
                        ],
                        names=["k", *CONTENT, "at"],
                    )

    return find


def cut_contents(windows: Windows) -> Callable:
    """Contents of the wanted runs as bytes or, for words, as 64-bit hashes; single windows for those marked ``hot``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers.text_bytes(batch.column("text"))
            want = batch.column("want")
            wanted = want.offsets.to_numpy() - want.offsets[0].as_py()
            fields = dict(zip([f.name for f in want.type.value_type], want.flatten().flatten(), strict=True))
            for first, last in row_groups(offsets, CHUNK):
                values, at = symbol_values(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], windows.words)
                part = slice(int(wanted[first]), int(wanted[last]))
                here = {name: col[part] for name, col in fields.items()}
                row = np.repeat(np.arange(last - first), np.diff(wanted[first : last + 1]))
                start = at[row] + here["at"].to_numpy()
                end = start + here["n"].to_numpy() + windows.width - 1
                hot = here["hot"].to_numpy(zero_copy_only=False)
                symbols = values[0].view(np.int64) if windows.words else data[offsets[first] : offsets[last]]
                plain = np.flatnonzero(~hot)
                keys = [*CONTENT, "copies", "first"]
                take = pa.array(plain)
                none = pa.nulls(len(plain), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [here[c].take(take) for c in keys]
                    + [pa.array([symbols[start[i] : end[i]].tobytes() for i in plain], pa.binary()), pa.nulls(len(plain), pa.int32()), none, none],
                    names=[*keys, "content", "i", "w1", "w2"],
                )
                for i in np.flatnonzero(hot):
                    rolls = [buffers.Rolling(v[start[i] : end[i]], which).windows(windows.width) for which, v in enumerate(values)]
                    m = len(rolls[0])
                    take = pa.array(np.full(m, i))
                    yield pa.RecordBatch.from_arrays(
                        [here[c].take(take) for c in keys]
                        + [pa.nulls(m, pa.binary()), pa.array(np.arange(m, dtype=np.int32)), *(pa.array(_signed(r)) for r in rolls)],
                        names=[*keys, "content", "i", "w1", "w2"],
                    )

    return cut


def by_group(compare: Callable[[list[dict]], list[tuple[int, list[tuple[int, int]]]]]) -> Callable:
    """Apply ``compare`` to blocks of whole anchor groups of a partition sorted by anchor.

    A block has at most twice ``GROUP_ROWS`` rows. ``compare`` returns, for rows by number, ranges of their windows.
    """

    def ranges(block: list[dict]) -> pa.RecordBatch:
        found = compare(block)
        rows = [block[i] for i, _ in found]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64() if c in ("anchor", "c1", "c2") else pa.int32()) for c in CONTENT]
            + [pa.array([[{"a": a, "b": b} for a, b in spans] for _, spans in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
            names=[*CONTENT, "ranges"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(block) >= GROUP_ROWS and row["anchor"] != block[-1]["anchor"]:
                    yield ranges(block)
                    block = []
                block.append(row)
        if block:
            yield ranges(block)

    return run


def repeated_ranges(
    docs: DataFrame, windows: Windows, compare: Callable, order: list[str], whole: Column, hot_windows: Column, hot_value: Column
) -> DataFrame:
    """``k, ranges``: ranges of windows to remove, for documents (doc_id, text) that have any.

    ``whole`` tells, of a run beside its content's ``copies`` and ``first`` document, that all its windows go; other runs
    lose what ``compare`` finds for their content. ``hot_value`` is what is aggregated for single windows, ``hot_windows``
    the condition on it as ``seen`` and the content's own columns.
    """
    keyed = docs.select(row_key().alias("k"), "text")
    types = f"k {keyed.schema['k'].dataType.simpleString()}, anchor long, c1 long, c2 long, n int, lead int, at int"
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    runs = settled(map_arrow(keyed, find_runs(windows), types))
    # Small sides of joins on hot keys are settled first: then Spark can split the large side's partitions.
    again = settled(runs.groupBy("anchor").count().where("count > 1").select("anchor"))
    runs = settled(runs.join(again, "anchor", "left_semi"))
    contents = settled(
        runs.groupBy(*CONTENT).agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("k.doc_id").alias("first"),
            F.max("k.doc_id").alias("last"),
            F.min(F.struct("k", "at")).alias("sample"),
        )
    )
    variants = settled(contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1"))
    wanted = F.struct(*CONTENT, "copies", "first", F.col("sample.at").alias("at"), (F.col("variants") > GROUP_ROWS).alias("hot"))
    want = contents.join(variants, "anchor").groupBy(F.col("sample.k").alias("k")).agg(F.collect_list(wanted).alias("want"))
    cut_types = f"anchor long, c1 long, c2 long, n int, lead int, copies long, first {doc_type}, content binary, i int, w1 long, w2 long"
    # Rows equal in id and text have one key: the last one is as good as any.
    sources = keyed.join(want, "k")
    cut = settled(map_arrow(sources, cut_contents(windows), cut_types))

    groups = cut.where("content is not null").drop("i", "w1", "w2").repartition("anchor").sortWithinPartitions("anchor", *order)
    compared = map_arrow(groups, by_group(compare), f"anchor long, c1 long, c2 long, n int, lead int, ranges {RANGES}")
    single = cut.where("content is null").drop("content").dropDuplicates([*CONTENT, "i"])
    seen = settled(single.groupBy("w1", "w2").agg(hot_value.alias("seen")))
    dealt = (
        single.join(seen, ["w1", "w2"])
        .where(hot_windows)
        .groupBy(*CONTENT)
        .agg(F.collect_list(F.struct(F.col("i").alias("a"), (F.col("i") + 1).alias("b"))).alias("ranges"))
    )
    parts = compared.unionByName(dealt)
    found = settled(contents.join(parts, CONTENT, "left").where(F.col("ranges").isNotNull() | (F.col("copies") > 1)))
    shifted = F.transform("ranges", lambda r: F.struct((F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"]).alias("b")))
    all_of = F.array(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("n")).alias("b")))
    return (
        runs.join(found.select(*CONTENT, "copies", "first", "ranges"), CONTENT)
        .select("k", F.when(whole, all_of).otherwise(shifted).alias("r"))
        .where(F.col("r").isNotNull())
        .groupBy("k")
        .agg(F.flatten(F.collect_list("r")).alias("ranges"))
    )


def removed_ranges(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row, the symbols that its window ranges cover, merged."""
    column = batch.column("ranges")
    flat = column.flatten()
    a, b = (x.to_numpy(zero_copy_only=False) for x in flat.flatten()) if len(flat) else (np.zeros(0, np.int32),) * 2
    at = 0
    for n in column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False):
        yield buffers.union_ranges(a[at : at + n].astype(np.int64), b[at : at + n].astype(np.int64) + width - 1)
        at += n
