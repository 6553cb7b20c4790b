"""Line deduplication by a tree of line templates.

A line's place in the tree is fixed by its number of tokens and its first ``DEPTH`` tokens; tokens with a digit are variable
fields from the start. In a leaf, a token stays part of the template if a share of the leaf's documents, and at least
``MIN_DOCUMENTS`` of them, have it at its place; at all other places the leaf's lines vary, and the field is generalised. There
is a template of the line for each of ``SHARES``: for half, so that names and cities are fields however many documents have
each, for a tenth, so that a leaf may hold several kinds of lines, and for none, so that lines which just repeat recur however
small their part of the leaf. A template is used if it still has at least ``FIXED`` of its tokens, and recurs if
``MIN_DOCUMENTS`` documents have a line of it. Lines with a recurring template are dropped.

Copies of one text must not lose their lines to each other. With ``most=None``, as in the registered query and the pipeline, a
template's documents are counted over the classes of near-duplicates among the documents with recurring lines, so that copies
alone make no line recur, and recurring lines go whatever their share of a document. With a number, documents count singly and
one that would lose more than this share of its characters keeps all its lines, copy or not.

Equal lines are counted with partial aggregation before anything else; only lines of leaves that have several different
ones and enough documents are looked at token by token, and a leaf's tokens are spread over tasks by place and token.

Defined cases. Null text: no lines, kept text null. Blank lines are never dropped; a line without a token to keep (numbers
only) is in no template. Tokens are counted by row; a template recurs by documents that differ in id or text, so a row that is
merely repeated does not make it recur. Ids may be null. Line ends are ``\\n``. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm import buffers
from docledger.llm.order_minhash import near_duplicates
from docledger.llm.repeats import row_groups, symbol_values
from docledger.llm.store import fresh, map_arrow, row_key, settled, spent

DEPTH, MIN_DOCUMENTS, FIXED, MOST = 3, 5, 0.5, 0.5
SHARES = (0.0, 0.1, 0.5)  # of a leaf's documents that have a token which stays
CHUNK = 1 << 18
VARIABLE = np.uint64(0x2A)
_DIGIT = np.zeros(256, np.int32)
_DIGIT[ord("0") : ord("9") + 1] = 1
LINE = ["leaf", "h1", "h2"]


class Lines:
    """Tokens of many texts by line; only lines with a token appear."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, at = buffers.word_spans(data, offsets)
        values, _ = symbol_values(data, offsets, words=True)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        self.variable = digits[ends] > digits[starts]
        self.tokens = [np.where(self.variable, VARIABLE, v) for v in values]
        breaks = np.flatnonzero(data == 10)
        token_row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[token_row]
        new = np.ones(len(starts), bool)
        new[1:] = (token_row[1:] != token_row[:-1]) | (number[1:] != number[:-1])
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(starts))
        self.row, self.number = token_row[self.first], number[self.first]

    def hashes(self, depth: int) -> list[np.ndarray]:
        """Leaf and the two line hashes."""
        rolls = [buffers.Rolling(v, which) for which, v in enumerate(self.tokens)]
        lead = rolls[1].ranges(self.first, np.minimum(self.first + depth, self.last))
        length = (self.last - self.first).astype(np.uint64)
        return [buffers.mixed(lead + buffers.mixed(length)), *(buffers.mixed(r.ranges(self.first, self.last) + length) for r in rolls)]

    def fixed(self) -> np.ndarray:
        known = np.concatenate([[0], np.cumsum(~self.variable)])
        return known[self.last] - known[self.first]


def _lines(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers.text_bytes(batch.column("text"))
            for a, b in row_groups(offsets, CHUNK):
                lines = Lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                hashes = lines.hashes(depth)
                once = np.zeros(len(lines.row), bool)
                once[np.unique(buffers.mixed(hashes[1] + buffers.mixed(lines.row.astype(np.uint64))), return_index=True)[1]] = True
                columns = [h.view(np.int64) for h in hashes]
                columns += [x.astype(np.int32) for x in (lines.number, lines.last - lines.first, lines.fixed())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").take(pa.array(lines.row + a)), *map(pa.array, columns), pa.array(once)],
                    names=["k", *LINE, "line", "n", "fixed", "once"],
                )

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens by place of the wanted lines."""
    for batch in batches:
        data, offsets = buffers.text_bytes(batch.column("text"))
        want = batch.column("want")
        fields = dict(zip([f.name for f in want.type.value_type], want.flatten().flatten(), strict=True))
        wanted = want.offsets.to_numpy() - want.offsets[0].as_py()
        number = fields["line"].to_numpy()
        for a, b in row_groups(offsets, CHUNK):
            lines = Lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            here = np.arange(wanted[a], wanted[b])
            row = np.repeat(np.arange(b - a), np.diff(wanted[a : b + 1]))
            wide = int(lines.number.max()) + 1 if len(lines.number) else 1
            at = np.searchsorted(lines.row * wide + lines.number, row * wide + number[here])
            length = lines.last[at] - lines.first[at]
            place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            token = np.repeat(lines.first[at], length) + place
            keep = ~lines.variable[token]
            take = pa.array(np.repeat(here, length)[keep])
            values = lines.tokens[0][token[keep]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [fields[c].take(take) for c in (*LINE, "docs", "n")] + [pa.array(place[keep].astype(np.int32)), pa.array(values)],
                names=[*LINE, "docs", "n", "place", "token"],
            )


def recurring_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, depth: int = DEPTH, fixed: float = FIXED, by_class: bool = False
) -> DataFrame:
    """``k, line, t1, t2``: the lines, by document and number from 0, and their recurring templates, one or more.

    With ``by_class`` near-duplicates count as one document.
    """
    keyed = docs.select(row_key().alias("k"), "text")
    key_type = keyed.schema["k"].dataType.simpleString()
    rows = settled(map_arrow(keyed, _lines(depth), f"k {key_type}, leaf long, h1 long, h2 long, line int, n int, fixed int, once boolean"))
    lines = settled(
        rows.groupBy(*LINE, "n", "fixed").agg(
            F.count_if("once").alias("docs"), F.min(F.struct("k", "line")).alias("sample")
        )
    )
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("several"), F.sum("docs").alias("in_leaf"))
    leaves = settled(leaves.where(F.col("in_leaf") >= min_documents))
    counted, lines = lines, settled(lines.join(leaves, "leaf"))
    spent(counted)
    enough = F.lit(fixed) * F.col("n")
    alone = lines.where((F.col("several") == 1) & (F.col("fixed") >= enough) & (F.col("fixed") > 0))
    alone = alone.select(*LINE, F.col("h1").alias("t1"), F.col("h2").alias("t2"), "docs")

    # What grows with the documents is never broadcast, however small it is here: hence the hints.
    want = F.struct(*LINE, "docs", "n", F.col("sample.line").alias("line"))
    want = lines.where("several > 1").groupBy(F.col("sample.k").alias("k")).agg(F.collect_list(want).alias("want"))
    types = "leaf long, h1 long, h2 long, docs long, n int, place int, token long"
    tokens = settled(map_arrow(keyed.join(want.hint("merge"), "k").dropDuplicates(["k"]), _tokens, types))
    places = tokens.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("having")).where(F.col("having") >= min_documents)
    places = settled(places.join(leaves.select("leaf", "in_leaf").hint("merge"), "leaf").withColumn("share", F.col("having") / F.col("in_leaf")).drop("in_leaf", "having"))
    kept = tokens.join(places, ["leaf", "place", "token"]).groupBy(*LINE, "n", "docs")
    template = lambda share: F.struct(
        F.count_if(F.col("share") >= share).alias("fixed"),
        F.bit_xor(F.when(F.col("share") >= share, F.xxhash64("place", "token"))).alias("t1"),
        F.bit_xor(F.when(F.col("share") >= share, F.xxhash64("token", "place", F.lit(1)))).alias("t2"),
    )
    kept = kept.agg(F.array(*map(template, SHARES)).alias("templates"))
    kept = kept.select(*LINE, "n", "docs", F.inline(F.array_distinct("templates")))
    general = kept.where(F.col("fixed") >= enough).select(*LINE, "t1", "t2", "docs")
    placed = alone.unionByName(general)
    common = placed.groupBy("leaf", "t1", "t2").agg(F.sum("docs").alias("d")).where(F.col("d") >= min_documents)
    placed = settled(placed.join(common, ["leaf", "t1", "t2"]).select(*LINE, "t1", "t2"))
    spent(tokens, places, leaves, lines)
    placed_lines = settled(rows.join(placed, LINE).select("k", "line", "leaf", "t1", "t2"))
    spent(rows, placed)
    documents = placed_lines.select("leaf", "t1", "t2", "k").distinct().groupBy("leaf", "t1", "t2").count()
    recurring = settled(documents.where(F.col("count") >= min_documents))
    found = placed_lines.join(recurring, ["leaf", "t1", "t2"], "left_semi")
    if by_class:
        found = settled(found)
        some = settled(found.select("k").distinct())
        spent(placed_lines, recurring)
        chosen = docs.select("doc_id", "text", row_key().alias("k")).join(some.hint("merge"), "k", "left_semi").dropDuplicates(["k"])
        chosen = settled(chosen.select("doc_id", "text"))  # read twice
        classes, _ = near_duplicates(chosen)
        classes = settled(classes.select("k", F.struct("class_id", "class_hash").alias("class")))
        spent(chosen, some)
        counted = found.select("leaf", "t1", "t2", "k").distinct().join(classes.hint("merge"), "k").select("leaf", "t1", "t2", "class").distinct()
        recurring = settled(counted.groupBy("leaf", "t1", "t2").count().where(F.col("count") >= min_documents))
        found = found.join(recurring, ["leaf", "t1", "t2"], "left_semi")
    return found.select("k", "line", "t1", "t2")


def drop_recurring_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    depth: int = DEPTH,
    fixed: float = FIXED,
    most: float | None = MOST,
    names: tuple[str, str] = ("n_lines", "dropped"),
) -> DataFrame:
    """The columns of ``docs`` with ``text`` replaced, then, by ``names``, the number of lines and the numbers of those that went.

    Columns of ``docs`` with these names are replaced.
    """
    own = [c for c in docs.columns if c not in names]
    key, marked = fresh(docs, "line_key"), fresh(docs, "recurring")
    found = recurring_lines(docs, min_documents, depth, fixed, by_class=most is None).groupBy(F.col("k").alias(key))
    found = found.agg(F.collect_set("line").alias(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone = [], [], []
            for text, numbers in zip(batch.column("text").to_pylist(), batch.column(marked).to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                drop = set(numbers or ())
                if most is not None and sum(len(lines[x]) for x in drop) > most * len(text or ""):
                    drop = set()
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text)
                counts.append(len(lines))
                gone.append(sorted(drop))
            new = [pa.array(texts, pa.string()), pa.array(counts, pa.int32()), pa.array(gone, pa.list_(pa.int32()))]
            rest = [n for n in own if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), *new], names=[*rest, "text", *names])

    whole = docs.select(*own, row_key().alias(key)).join(found.hint("merge"), key, "left").drop(key)
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own if c != "text")
    done = map_arrow(whole, run, f"{types}, text string, `{names[0]}` int, `{names[1]}` array<int>")
    return done.select(*own, *names)
