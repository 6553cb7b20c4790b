"""Fill-in-middle transformation by repeated-capture matching.

A text is cut into units, runs of letters or single other characters. One ``fullmatch`` of ``(unit)*`` with the ``regex``
library retains every repetition of the group, so ``match.ends(1)`` is the list of all unit ends: its length is the number of
units ``n``, and both cuts are entries of it. No loop visits the units. What a document becomes is drawn from the hash of its
id, so reruns and any partitioning agree.

Captures cost about 100 bytes a unit. A text of more than ``BLOCK`` characters is therefore matched block by block, each
block ending where a unit ends; only the numbers of units are kept, and the one or two blocks with a cut in them are matched
again. The result is that of a single match. Tasks hold one group of about ``CHUNK`` bytes of texts at a time.

Defined cases. Null text counts as empty; an empty text has no unit and stays plain. A null id is hashed as the empty
string. Texts that contain one of the markers stay plain, so what is between markers never holds one, and since no
marker ends as another begins, the text can be rebuilt exactly. Repeated rows give equal results, ``doc_id`` may have
any type, other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.repeats import row_groups
from docledger.llm.store import map_arrow

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
SEED, TRANSFORMED, SUFFIX_FIRST = "1", 90, 20  # texts of 100 that are transformed; of 100 of these, with the suffix first
BLOCK = 1 << 20
CHUNK = 1 << 22

_UNITS = regex.compile(f"({UNIT})*")
_MARKER = regex.compile("|".join(map(regex.escape, (PREFIX, SUFFIX, MIDDLE))))
_NOT_LETTER = regex.compile("[^A-Za-z]")


class Units:
    """The units of a text, by their ends."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.edges, counts = text, [0], []
        while True:
            start, stop = self.edges[-1], self.edges[-1] + block
            if stop < len(text):  # a run of letters is not divided
                found = _NOT_LETTER.search(text, stop - 1)
                stop = found.end() if found else len(text)
            self.edges.append(min(stop, len(text)))
            self.last = _UNITS.fullmatch(text, start, self.edges[-1]).ends(1)
            counts.append(len(self.last))
            if self.edges[-1] == len(text):
                break
        self.upto = list(accumulate(counts))
        self.n = self.upto[-1]

    def end(self, k: int) -> int:
        """Where the first ``k`` units end."""
        if k == 0:
            return 0
        block = bisect_left(self.upto, k)
        if block < len(self.upto) - 1:
            ends = _UNITS.fullmatch(self.text, self.edges[block], self.edges[block + 1]).ends(1)
        else:
            ends = self.last
        return ends[k - 1 - (self.upto[block - 1] if block else 0)]


def cut(text: str, draws: tuple[int, int, int, int], transformed: int, suffix_first: int) -> tuple:
    """Number of units, form, length of prefix and middle, output."""
    units = Units(text)
    if not text or draws[2] % 100 >= transformed or _MARKER.search(text):
        return units.n, "plain", None, None, text
    a, b = (units.end(k) for k in sorted(h % (units.n + 1) for h in draws[:2]))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < suffix_first:
        return units.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _draws(seed: str) -> list[Column]:
    """Four numbers from the hash of the id: groups of eight hexadecimal digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, seed: str = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``. Nothing is shuffled.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``: the text as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = buffers.text_bytes(batch.column("text"))
            for first, last in row_groups(offsets, CHUNK):
                rows = batch.slice(first, last - first)
                draws = zip(*(rows.column(f"h{i}").to_pylist() for i in range(1, 5)), strict=True)
                done = [cut(t or "", h, transformed, suffix_first) for t, h in zip(rows.column("text").to_pylist(), draws, strict=True)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array([row[i] for row in done], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_arrow(docs.select("doc_id", "text", *_draws(seed)), run, kinds)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from what it became."""
    parts = F.split(output, _MARKER.pattern)  # nothing, two parts by form, the middle
    order = F.when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(F.concat(parts[1], parts[3], parts[2]))
    return F.when(form == "plain", output).otherwise(order)
