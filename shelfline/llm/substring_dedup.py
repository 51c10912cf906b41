"""Removal of repeated word passages, found through difference-cover anchors.

A window is `WINDOW` consecutive words. A word goes when a window around it also starts in a document
with a smaller id. Windows are not all hashed: a difference cover D of the residues modulo `PERIOD` holds, for
every shift, two members that far apart. So if two places start equal windows, both have a cover position
(a place whose number modulo the period is in D) at the same offset below `PERIOD`, and the `ANCHOR` words from
there on lie inside both windows. Only these anchors are hashed and counted over the corpus; an anchor that
only one id holds proves that no window around it is shared.

Anchors held by several ids are extended in two steps. First by their context, the words before and behind
that any window around the anchor can reach: where a smaller id has the very same context, all those windows are
shared at once. What is left is extended window by window: its windows are hashed, and the smallest id
per window decides. An id that has a smaller partner in context can not be the smallest holder
of any of these windows, so it needs no window of its own; neither does an anchor that only one id is left with.

Texts that more than `SHARE` of the rows hold are settled before all that: of equal texts only the rows of the smallest id
can be the smallest holders of a window, and all windows of the others go. So a large group of copies brings the anchors of one text.

What travels: 6 slim rows per 31 words, then rows of repeated anchors only. Hashes of windows and contexts have
128 bits. Smallest ids are partial aggregates; they come back by a join in which the keys that hold more than
`SHARE` of the rows are broadcast (at most 1 / `SHARE` keys, whatever the input), so no group meets in one task.

Defined cases: a null text has no words; texts shorter than a window keep all words; a null id is larger than
any other and null ids are equal; rows with equal ids never remove words from each other (nor inside one text); rows that
repeat id and text get the same answer; an empty table gives an empty result; other columns are kept by `clean`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import boxed, cut_lineage, unboxed, whole_text
from shelfline.llm.textbuf import BYTE_VALUES, SPACE, Block, blocks, mix, powers, prefix_sums, row_bounds, span_hashes, spans

WINDOW = 50
# A perfect difference cover: every shift modulo 31 is the difference of two members.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
SHARE = 1 / 2000
# Fewer characters hold no window.
LEAST = 2 * WINDOW - 1
# A run that goes to the end of any text.
WHOLE = 2**31 - 1
WORD_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Words:
    """The words of a block of texts: byte spans, rows, and two independent running hashes over them."""

    def __init__(self, block: Block):
        self.block = block
        self.starts, self.ends, self.rows = spans(block, ~SPACE)
        self.bounds = row_bounds(self.rows, block.rows)
        hashes = span_hashes(prefix_sums(block.data, BYTE_VALUES), self.starts, self.ends)
        self.sums = []
        for k, base in enumerate(WORD_BASES):
            sums = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(hashes + np.uint64(k)) * powers(base, len(hashes)), out=sums[1:])
            self.sums.append(sums)

    def hashes(self, at: np.ndarray, length, k: int) -> np.ndarray:
        """Hash number k of `length` words from each place on, as a signed long."""
        sums, base = self.sums[k], WORD_BASES[k]
        raw = (sums[at + length] - sums[at]) * powers(pow(base, -1, 1 << 64), len(sums))[at]
        return mix(raw + np.asarray(length).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def anchors_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in its text) of every cover position with `ANCHOR` words behind it inside a text of a window's length."""
    place = np.arange(len(words.rows)) - words.bounds[words.rows]
    length = np.diff(words.bounds)[words.rows]
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True
    chosen = np.flatnonzero(on_cover[place % PERIOD] & (place + ANCHOR <= length) & (length >= WINDOW))
    return words.rows[chosen], place[chosen]


def contexts(words: Words, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hash of all that windows around each anchor can reach. With the anchor's own hash the key has 128 bits."""
    length = np.diff(words.bounds)[rows]
    lo = np.maximum(places - (PERIOD - 1), 0)
    hi = np.minimum(places + WINDOW, length)
    at = words.bounds[rows] + lo
    # the anchor's offset inside its context is part of the key
    key = words.hashes(at, hi - lo, 1).view(np.uint64) + mix((places - lo).astype(np.uint64) + np.uint64(1))
    return mix(key).view(np.int64)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(2)):
            words = Words(block)
            rows, places = anchors_of(words)
            if len(rows):
                at = words.bounds[rows] + places
                context = contexts(words, rows, places)
                take = pa.array(rows + block.lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(places.astype(np.int32)),
                     pa.array(words.hashes(at, ANCHOR, 0)), pa.array(context)],
                    ["_id", "_th", "at", "anchor", "context"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts with their open anchors: every window around one, once."""
    for batch in batches:
        spots, offsets = batch.column(3).flatten().to_numpy(), batch.column(3).offsets.to_numpy()
        offsets = offsets - offsets[0]
        for block in blocks(batch.column(2)):
            words = Words(block)
            length = np.diff(words.bounds)
            lo, hi = offsets[block.lo], offsets[block.lo + block.rows]
            rows = np.repeat(np.arange(block.rows), np.diff(offsets[block.lo: block.lo + block.rows + 1]))
            places = spots[lo:hi].astype(np.int64)
            # how many open anchors begin or end their reach at each window start
            first = np.maximum(places - (PERIOD - 1), 0)
            last = np.minimum(places, length[rows] - WINDOW)
            ok = first <= last
            reach = np.zeros(len(words.rows) + 1, np.int64)
            np.add.at(reach, words.bounds[rows[ok]] + first[ok], 1)
            np.add.at(reach, words.bounds[rows[ok]] + last[ok] + 1, -1)
            at = np.flatnonzero(np.cumsum(reach)[:-1] > 0)
            if len(at):
                take = pa.array(words.rows[at] + block.lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take),
                     pa.array((at - words.bounds[words.rows[at]]).astype(np.int32)),
                     pa.array(words.hashes(at, WINDOW, 0)), pa.array(words.hashes(at, WINDOW, 1))],
                    ["_id", "_th", "at", "w0", "w1"])


def _kept_words(words: Words, gone: pa.Array, lo: int) -> np.ndarray:
    """True for the words of the block that stay; `gone` lists (start, len) runs per row."""
    runs = gone.slice(lo, words.block.rows)
    counts = np.diff(runs.offsets.to_numpy())
    flat = runs.flatten()
    rows = np.repeat(np.arange(words.block.rows), counts)
    start = words.bounds[rows] + flat.field(0).to_numpy()
    # the reach of an anchor near the end is longer than the text
    stop = np.minimum(start + flat.field(1).to_numpy(), words.bounds[rows + 1])
    # a copy of a text without a window keeps its words
    holds = np.diff(words.bounds)[rows] >= WINDOW
    covered = np.zeros(len(words.rows) + 1, np.int64)
    np.add.at(covered, start[holds], 1)
    np.add.at(covered, stop[holds], -1)
    return np.cumsum(covered)[:-1] == 0


def _kept_texts(texts: pa.Array, gone: pa.Array) -> Iterator[tuple[int, int, bytes]]:
    """(words, words removed, the words that stay joined by one space) per text."""
    for block in blocks(texts):
        words = Words(block)
        stays = _kept_words(words, gone, block.lo)
        data = block.data.tobytes()
        starts, ends = words.starts.tolist(), words.ends.tolist()
        for r in range(block.rows):
            a, b = int(words.bounds[r]), int(words.bounds[r + 1])
            left = (np.flatnonzero(stays[a:b]) + a).tolist()
            yield b - a, b - a - len(left), b" ".join([data[starts[i]:ends[i]] for i in left])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("_id"), *_text_keys(whole_text(text_col)))


def _text_keys(text: Column) -> list[Column]:
    """The text and two hashes of it, 128 bits together."""
    return [F.xxhash64(text).alias("_th"), text.alias("_text"), F.xxhash64(F.length(text), text).alias("_tl")]


def _smallest(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key held by more than one id: the smallest id (null last) and the number of rows."""
    some_null = F.max(F.col("_id").isNull())
    return (
        rows.groupBy(*keys).agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), some_null.alias("_null"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_first") < F.col("_last")) | (F.col("_null") & F.col("_first").isNotNull()))
        .select(*keys, "_first", "_n")
    )


def with_smallest(rows: DataFrame, *keys: str, others: bool = False, share: float = SHARE) -> DataFrame:
    """The rows whose key more than one id holds, with that key's smallest id `_first`; `others` keeps the rest without one.

    Keys above `share` of the rows are settled where they are read, the others by a shuffle.
    """
    shared = cut_lineage(_smallest(rows, *keys))
    most = int(rows.count() * share) + 1
    hot = F.broadcast(shared.where(F.col("_n") > most).drop("_n"))  # at most 1 / share keys
    rest = shared.where(F.col("_n") <= most).drop("_n")
    cold = rows.join(hot, list(keys), "left_anti")
    return rows.join(hot, list(keys)).unionByName(cold.join(rest, list(keys), "left" if others else "inner"))


def _later() -> Column:
    """The row's id is larger than the smallest one."""
    return F.col("_first").isNotNull() & (F.col("_id").isNull() | F.coalesce(F.col("_id") > F.col("_first"), F.lit(False)))


def common_texts(keyed: DataFrame, share: float = SHARE) -> DataFrame:
    """(_th, _tl, _first): the texts that more than one id and more than `share` of the rows hold, with their smallest id."""
    most = int(keyed.count() * share) + 1
    return cut_lineage(_smallest(keyed.where(F.length("_text") >= LEAST), "_th", "_tl").where(F.col("_n") > most).drop("_n"))


def _with_copies(keyed: DataFrame, common: DataFrame) -> DataFrame:
    """Every row, with `_copy`: a smaller id has the same text, which is a common one."""
    marked = keyed.join(F.broadcast(common), ["_th", "_tl"], "left")  # at most 1 / share texts
    return marked.withColumn("_copy", _later()).drop("_first")


def removed_runs(keyed: DataFrame) -> DataFrame:
    """(_rid, _rth, gone): the runs of words that go, as (at, len), per text that loses any and is no `_copy`."""
    keyed = keyed.where("not _copy").drop("_copy")
    kind = keyed.schema["_id"].dataType.simpleString()
    key = [F.col("_id").alias("_rid"), F.col("_th").alias("_rth")]
    anchors = cut_lineage(keyed.where(F.length("_text") >= LEAST).select("_id", "_th", "_text").mapInArrow(
        _anchor_rows, f"_id {kind}, _th long, at int, anchor long, context long"))
    repeated = cut_lineage(with_smallest(anchors, "anchor").drop("_first"))
    # where a smaller id has the context, so has it all windows around the anchor
    settled = cut_lineage(
        with_smallest(repeated, "anchor", "context", others=True).select("_id", "_th", "at", "anchor", _later().alias("gone")))
    # an anchor left in one id only has no partner with another context
    spots = with_smallest(settled.where("not gone"), "anchor").groupBy(*key).agg(F.collect_set("at").alias("spots"))
    windows = cut_lineage(
        keyed.join(spots, _on_key(keyed, spots)).select("_id", "_th", "_text", "spots")
        .mapInArrow(_window_rows, f"_id {kind}, _th long, at int, w0 long, w1 long"))
    single = with_smallest(windows, "w0", "w1").where(_later()).select("_id", "_th", "at", F.lit(WINDOW).alias("len"))
    start = F.greatest(F.col("at") - (PERIOD - 1), F.lit(0))
    around = settled.where("gone").select("_id", "_th", start.alias("at"), (F.col("at") + WINDOW - start).alias("len"))
    return single.unionByName(around).groupBy(*key).agg(F.collect_set(F.struct("at", "len")).alias("gone"))


def _on_key(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_rid"]) & (left["_th"] == right["_rth"])


def _with_runs(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """Every row with its runs of words that go; `keyed` are the same rows without further columns."""
    common = common_texts(keyed)
    gone = removed_runs(_with_copies(keyed, common))
    rows = _with_copies(rows, common)
    whole = F.array(F.struct(F.lit(0).alias("at"), F.lit(WHOLE).alias("len")))
    return rows.join(gone, _on_key(rows, gone), "left").withColumn("gone", F.when(F.col("_copy"), whole).otherwise(F.col("gone")))


@F.arrow_udf(T.StructType().add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept_sha256", T.StringType()))
def _summary(texts: pa.Array, gone: pa.Array) -> pa.Array:
    rows = [(n, less, hashlib.sha256(body).hexdigest()) for n, less, body in _kept_texts(texts, gone)]
    n, less, digest = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(less, pa.int64()), pa.array(digest, pa.string())], ["n_words", "n_removed", "kept_sha256"])


@F.arrow_udf(T.StringType())
def _left_over(texts: pa.Array, gone: pa.Array) -> pa.Array:
    return pa.array([body.decode() for _, _, body in _kept_texts(texts, gone)], pa.string())


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their repeated passages. A text that loses words is its other words joined by one space; others stay as they are."""
    name = f"_row.`{text_col}`"
    boxed_rows = boxed(docs).select("_row", F.col(f"_row.`{id_col}`").alias("_id"), *_text_keys(whole_text(name)))
    rows = _with_runs(boxed_rows, _keyed(docs, id_col, text_col))
    new = F.when(F.col("gone").isNull(), F.col(name)).otherwise(F.col("_new"))
    return unboxed(rows.withColumn("_new", _left_over("_text", "gone")).withColumn("_row", F.col("_row").withField(f"`{text_col}`", new)))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 of the words that stay, joined by one space."""
    keyed = _keyed(docs, id_col, text_col)
    rows = _with_runs(keyed, keyed).select(F.col("_id").alias("doc_id"), _summary("_text", "gone").alias("s"))
    return rows.select("doc_id", "s.n_words", "s.n_removed", "s.kept_sha256")
