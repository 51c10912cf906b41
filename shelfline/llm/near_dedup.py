"""MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates.

Words are runs of non-white bytes with A-Z lower-cased; a document's set holds the hashes of its
distinct 3-word shingles (a shorter text is one shingle). Two documents are linked when
100 * |A and B| >= 85 * |A or B|, and a document's component is everything reachable over links.

* Equal sets are one class from the start (a digest of the set), so copies never meet in pairs. Classes
  are what is linked, so texts with a null id or under one id lose no link.
* One permutation: the 64-bit shingle hash picks the bin by its high bits, the smallest hash of a
  bin is its value. Empty bins borrow from a random full bin, chosen by a fixed probe sequence per
  bin that is the same in all documents (optimal densification).
* 192 bins in 32 bands of 6: a pair at the limit of 0.85 misses every bucket with probability 3e-7.
* In a bucket the candidates are the edges of a star around its smallest id: as many as members.
  They are confirmed on the full sets.
* A failed star edge says nothing about two outer members. The members of buckets that do not lie in
  one component yet meet in an exact set join with prefix, length and positional filters, so no link is
  lost and nothing is capped; a bucket of one component, such as a group around its base, needs none.
* Components come from smallest-label propagation with pointer jumping over the confirmed links;
  links and labels stay in written tables.

Defined cases: null, empty and white texts have an empty set, link with nothing and are their own
component, kept; the links are between sets, whatever ids their rows have; a component is named after its
smallest doc_id, null last, and of that id's texts the one with the smallest text hash is kept; rows that
repeat both id and text are one document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import boxed, cut_lineage, id_order, unboxed, whole_text
from shelfline.llm.textbuf import (
    BASE, LOWER_VALUES, SPACE, Block, blocks, kept, mix, prefix_sums, row_bounds, span_hashes, spans,
)

SHINGLE = 3
BINS = 192
BAND_ROWS = 6
BANDS = BINS // BAND_ROWS
LINK_PERCENT = 85
PROBES = 8 * BINS
LONGS = T.ArrayType(T.LongType())
SKETCH_TYPE = T.StructType().add("n", T.LongType()).add("digest", T.BinaryType()).add("bands", LONGS)
SET_TYPE = T.StructType().add("digest", T.BinaryType()).add("items", LONGS)


def shingle_sets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows of a block, and the border of each row's."""
    starts, ends, rows = spans(block, ~SPACE)
    hashes = span_hashes(prefix_sums(block.data, LOWER_VALUES), starts, ends)
    bounds = row_bounds(rows, block.rows)
    counts = np.diff(bounds)
    # every position begins a window; windows that leave their text are dropped or, in short texts, filled with a mark
    out, width = None, len(hashes)
    for k in range(SHINGLE):
        at = np.arange(width) + k
        inside = at < bounds[1:][rows]
        word = np.where(inside, hashes[np.minimum(at, max(width - 1, 0))], np.uint64(k + 1))
        out = mix(word if out is None else out * np.uint64(BASE) + word)
    if out is None or not width:
        return np.zeros(0, np.uint64), np.zeros(block.rows + 1, np.int64)
    place = np.arange(width) - bounds[rows]
    whole = (place + SHINGLE <= counts[rows]) | (place == 0)
    out, rows = out[whole], rows[whole]
    order = np.lexsort((out, rows))
    out, rows = out[order], rows[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (rows[1:] != rows[:-1])
    out, rows = out[fresh], rows[fresh]
    return out, row_bounds(rows, block.rows)


def probe_table() -> np.ndarray:
    """The bins that each empty bin tries in turn, the same for all documents."""
    seeds = np.arange(PROBES * BINS, dtype=np.uint64).reshape(PROBES, BINS) + np.uint64(BASE)
    return ((mix(seeds) >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of densified bin minima per set; rows of empty sets are meaningless."""
    n = len(bounds) - 1
    values = np.zeros((n, BINS), np.uint64)
    full = np.zeros((n, BINS), bool)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    slot = rows * BINS + bins
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]  # hashes ascend, so the first of a bin is its smallest
    values[rows[first], bins[first]] = hashes[first]
    full[rows[first], bins[first]] = True
    probes = kept("probes", probe_table)
    row, empty = np.nonzero(~full & full.any(axis=1, keepdims=True))
    for step in range(PROBES + BINS):
        if not len(row):
            break
        source = probes[step, empty] if step < PROBES else (empty + step) % BINS
        found = full[row, source]
        values[row[found], empty[found]] = values[row[found], source[found]]
        row, empty = row[~found], empty[~found]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    parts = values.reshape(len(values), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for r in range(BAND_ROWS):
        key = mix(key * np.uint64(BASE) + parts[:, :, r])
    return key


@F.arrow_udf(SKETCH_TYPE)
def sketch(texts: pa.Array) -> pa.Array:
    """Set size, digest of the set, one bucket key per band; no digest and no keys for an empty set."""
    sizes, digests, keys = [], [], []
    for block in blocks(texts):
        hashes, bounds = shingle_sets(block)
        n = np.diff(bounds)
        digests += [_digest(hashes[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        sizes.append(n)
        keys.append(band_keys(signatures(hashes, bounds)))
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    flat = np.concatenate(keys).view(np.int64) if keys else np.zeros((0, BANDS), np.int64)
    empty = size == 0
    # an empty set owns no keys: its list is null
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(size) + 1) * BANDS, pa.int32()), pa.array(flat.reshape(-1)), mask=pa.array(empty))
    return pa.StructArray.from_arrays([pa.array(size), pa.array(digests, pa.binary()), lists], ["n", "digest", "bands"])


def _digest(items: bytes) -> bytes | None:
    return hashlib.blake2b(items, digest_size=16).digest() if items else None


@F.arrow_udf(SET_TYPE)
def shingles(texts: pa.Array) -> pa.Array:
    """The full set of each text, as sorted 64-bit hashes, and its digest."""
    parts, sizes, digests = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
    for block in blocks(texts):
        hashes, bounds = shingle_sets(block)
        digests += [_digest(hashes[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        parts.append(hashes)
        sizes.append(np.diff(bounds))
    borders = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    items = pa.ListArray.from_arrays(pa.array(borders), pa.array(np.concatenate(parts).view(np.int64)))
    return pa.StructArray.from_arrays([pa.array(digests, pa.binary()), items], ["digest", "items"])


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough; each with `linked`."""
    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("_x"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    return (
        edges.join(right, "b").join(left, "a")
        .withColumn("_both", both)
        .select("a", "b", (100 * F.col("_both") >= percent * (F.size("_x") + F.size("_y") - F.col("_both"))).alias("linked"))
    )


def components(links: DataFrame) -> DataFrame:
    """(rep, label): the smallest rep reachable over the undirected links (a, b)."""
    both = cut_lineage(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct())
    labels = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")))
    while True:
        seen = both.join(labels.withColumnsRenamed({"u": "v", "label": "_near"}), "v").groupBy("u").agg(F.min("_near").alias("_near"))
        moved = labels.join(seen, "u").select("u", "label", F.least("label", "_near").alias("_next"))
        jump = labels.select(F.col("u").alias("_next"), F.col("label").alias("_far"))
        step = cut_lineage(moved.join(jump, "_next", "left").select("u", F.col("label").alias("_old"), F.coalesce("_far", "_next").alias("label")))
        labels = step.select("u", "label")
        if step.where("label <> _old").isEmpty():
            return labels.withColumnRenamed("u", "rep")


def star_edges(buckets: DataFrame) -> DataFrame:
    """Every member of a bucket with the smallest one: as many pairs as members."""
    bucket = ["band", "key"]
    hubs = buckets.groupBy(bucket).agg(F.min("rep").alias("a"))
    return buckets.join(hubs, bucket).where("rep > a").select("a", F.col("rep").alias("b")).distinct()


def rest_edges(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of members of different components that can be similar enough, by an exact set join.

    members: (rep, label). Items are ordered by how many members hold them, rarest first. A pair at the limit
    shares `needed` items, so with the smaller set on the left one of its first items is among the first
    items of the larger one, and from there on both still have as many left as are needed. The larger side
    meets only sizes for which that holds, so copies of one text that differ from it by more than the limit
    do not meet over what they all share.
    """
    needed = lambda m, n: F.ceil(percent * (m + n) / (100 + percent))
    items = cut_lineage(
        sets.join(members, "rep").select("rep", "label", F.size("items").cast("bigint").alias("n"), F.explode("items").alias("item")))
    # no pair shares an item that one component alone holds
    held = (
        items.groupBy("item").agg(F.count(F.lit(1)).alias("held"), F.min("label").alias("_low"), F.max("label").alias("_high"))
        .where("_low <> _high").select("item", "held")
    )
    # one document's own items; what no other component holds comes first and needs no row
    own = Window.partitionBy("rep")
    placed = cut_lineage(
        items.join(held, "item")
        .withColumn("place", F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("held", "item")) - 1)
        .where(F.col("n") - F.col("place") >= F.ceil(percent * F.col("n") / 100)).drop("held")
    )
    small = placed.where(F.col("n") - F.col("place") >= needed(F.col("n"), F.col("n"))).select(
        "item", F.col("n").alias("m"), F.col("rep").alias("_rep"), F.col("label").alias("_label"), F.col("place").alias("_place"))
    # components meet first, with one row per item and size, so members of one component never meet
    groups = small.groupBy("item", "m", "_label").agg(F.min("_place").alias("_first"))
    sizes = groups.select("item", "m").distinct()
    pairs = (
        placed.groupBy("item", "n", "label").agg(F.min("place").alias("first")).join(sizes, "item")
        .where((F.col("m") <= F.col("n")) & (100 * F.col("m") >= percent * F.col("n")) & (F.col("n") - F.col("first") >= needed(F.col("m"), F.col("n"))))
        .join(groups, ["item", "m"]).where((F.col("label") != F.col("_label")) & (F.col("m") - F.col("_first") >= needed(F.col("m"), F.col("n"))))
        .select("item", "n", "label", "m", "_label")
    )
    large = placed.join(pairs, ["item", "n", "label"]).where(F.col("n") - F.col("place") >= needed(F.col("m"), F.col("n")))
    met = large.join(small, ["item", "m", "_label"]).where(
        ((F.col("m") < F.col("n")) | (F.col("_rep") < F.col("rep")))
        & (F.col("m") - F.col("_place") >= needed(F.col("m"), F.col("n"))))
    return met.select(F.least("rep", "_rep").alias("a"), F.greatest("rep", "_rep").alias("b")).distinct()


def find_components(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(rep, label) of the linked classes; `buckets` (band, key, rep) hold two or more each."""
    bucket = ["band", "key"]
    starred = cut_lineage(_confirmed(star_edges(buckets), sets, percent))
    labels = components(starred.where("linked"))
    found = buckets.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    torn = found.groupBy(bucket).agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low <> _high")
    members = cut_lineage(found.join(torn.select(*bucket), bucket, "left_semi").select("rep", "label").distinct())
    if members.isEmpty():
        return labels
    edges = rest_edges(members, sets, percent).join(starred.select("a", "b"), ["a", "b"], "left_anti")
    rest = cut_lineage(_confirmed(edges, sets, percent))
    if rest.where("linked").isEmpty():
        return labels
    return components(starred.unionByName(rest).where("linked"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (the row's id is that of its component).

    Of several texts under one id that are linked, all are kept rows here; `deduplicate` leaves the one that leads.
    """
    return _decided(docs, id_col, text_col, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(whole_text(text_col))


def _decided(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """As `decide`, with the hash of each row's text as `th`; `leads` says that this very text stands for its component."""
    sketched = cut_lineage(
        docs.select(F.col(id_col).alias("doc_id"), _text_hash(text_col).alias("th"), sketch(F.col(text_col)).alias("s"))
        .select("doc_id", "th", F.col("s.n").alias("n"), F.col("s.digest").alias("digest"), F.col("s.bands").alias("bands"))
    )
    # one class per distinct set, led by its first text; numbered in the order of the leads, so the
    # smallest number of a component is that of its first text
    classes = cut_lineage(
        sketched.where(F.col("digest").isNotNull())
        .groupBy("digest").agg(F.min(F.struct(id_order().alias("id"), F.col("th"))).alias("lead"), F.any_value("bands").alias("bands"))
        .orderBy("lead", "digest").withColumn("rep", F.monotonically_increasing_id())
    )
    buckets = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    rivals = cut_lineage(_rivals(buckets))
    involved = rivals.select("rep").distinct().join(classes.select("rep", "digest", "lead"), "rep")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), _text_hash(text_col).alias("_th"))
    wanted = texts.join(involved, F.col("_id").eqNullSafe(F.col("lead.id.doc_id")) & (F.col("_th") == F.col("lead.th")))
    sets = cut_lineage(
        wanted.select("rep", "digest", shingles("_text").alias("s")).where("s.digest = digest")
        .select("rep", F.col("s.items").alias("items")).dropDuplicates(["rep"])
    )
    labels = find_components(rivals, sets, percent)
    leads = labels.join(classes.select(F.col("rep").alias("label"), F.col("lead").alias("_lead")), "label").select("rep", "_lead")
    home = classes.select("digest", "rep", "lead").join(leads, "rep", "left").select("digest", F.coalesce("_lead", "lead").alias("lead"))
    alone = F.col("digest").isNull()
    first = F.col("doc_id").eqNullSafe(F.col("lead.id.doc_id")) & (F.col("th") == F.col("lead.th"))
    return (
        sketched.select("doc_id", "th", "n", "digest").join(home, "digest", "left")
        .select("doc_id", "th", F.col("n").alias("n_shingles"),
                F.when(alone, F.col("doc_id")).otherwise(F.col("lead.id.doc_id")).alias("component_id"),
                (alone | first).alias("leads"))
    )


def _rivals(buckets: DataFrame) -> DataFrame:
    """The bucket rows that share their bucket with another representative."""
    shared = buckets.groupBy("band", "key").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high")).where("_low <> _high")
    return buckets.join(shared.select("band", "key"), ["band", "key"], "left_semi")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """The documents without those that are near copies of a kept one, with all their columns."""
    gone = (
        _decided(docs, id_col, text_col, percent).where("not leads")
        .select(F.col("doc_id").alias("_gone"), F.col("th").alias("_gone_th")).distinct()
    )
    rows = boxed(docs).select("_row", F.col(f"_row.`{id_col}`").alias("_id"), _text_hash(f"_row.`{text_col}`").alias("_th"))
    return unboxed(rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_th") == F.col("_gone_th")), "left_anti"))

