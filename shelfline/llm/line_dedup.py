"""Removal of repeated passages by content-defined chunks of lines, in DataFrame functions only.

A text is cut into lines at "\\n"; lines without a word are passed over and stay. Each line has a hash
and a rolling hash runs over every two lines. A chunk opens where the rolling hash is not larger than that
of the line before or after: one of any two neighbouring places is always such a minimum, whatever stands
around them, so a passage of three lines that moved to another text opens a chunk at the same place.

A chunk is the two lines at its place. Of equal chunks the one in the smallest (id, line) stays and the
others go; each then grows by one line on either side where that line also stands next to an earlier
equal chunk. Chunks lie at most one line apart, so the grown ones cover a repeated passage of three lines
or more from end to end. A passage of two lines goes where the lines around it let it open a chunk.

Lines are keyed by 128 bits. All lines under one key of a repeated chunk and its neighbours are compared
byte by byte; should two differ, all is done again with other keys.

What travels: one slim row per chunk, each text once to its marks, and for the comparison the lines of
repeated chunks, where equal lines meet within a task first. Picking the first place is a partial aggregate;
the joins back have ordinary equi keys, so a hot chunk is split like any skewed join.

Defined cases: a null text is empty; a text of one line is unchanged; repeats inside one text are
removed too; rows that repeat id and text are one document and cleaned alike; null ids come last; an
empty table gives an empty result; extra columns are kept by `clean` and not read by `decide`.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import bound, boxed, cut_lineage, id_order, unboxed, whole_text

# Fixed values of the rolling hash: a multiplier and a prime below 2^32, so products fit a long.
MULTIPLIER = 65_599
MODULUS = 4_294_967_291
WORDY = r"[^\x20\x09-\x0D]"


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def wordy(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike(WORDY))


def line_key(line: Column, salt: str = "") -> Column:
    return F.unhex(F.md5(F.concat(F.lit(salt), line)))


def chunks(lines: Column, salt: str = "") -> Column:
    """An array of (k, a, b, c, d): the chunk of the wordy lines k and k + 1 with the keys b, c and its neighbours' a, d."""
    hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint"))
    rolling = lambda h: F.transform(h, lambda x, i: (x * MULTIPLIER + F.get(h, i + 1)) % MODULUS)
    keys = F.transform(lines, lambda x: line_key(x, salt))

    def opened(r: Column, key: Column) -> Column:
        minimum = lambda x, i: (x <= F.coalesce(F.get(r, i - 1), x)) | (x <= F.coalesce(F.get(r, i + 1), x))
        around = lambda i: [F.get(key, i + at).alias(name) for at, name in zip((-1, 0, 1, 2), "abcd")]
        return F.array_compact(F.transform(r, lambda x, i: F.when(minimum(x, i), F.struct(i.alias("k"), *around(i)))))

    return bound(hashes, lambda h: bound(rolling(h), lambda r: bound(keys, lambda key: opened(r, key))))


def text_chunks(text: Column, salt: str = "") -> Column:
    return bound(wordy(split_lines(text)), lambda lines: chunks(lines, salt))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in a box, by (id, hash of the text); a repeated row has the same key."""
    text = whole_text(f"_row.`{text_col}`")
    return boxed(docs).select("_row", F.col(f"_row.`{id_col}`").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_th"))


def _on_key(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_rid"]) & (left["_th"] == right["_rth"])


def place() -> Column:
    """Places, not rows: a repeated row is the same place."""
    return F.struct(id_order("_id"), F.col("_th"), F.col("k"))


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys stand in two places or more, with `late`: not the first of these."""
    firsts = rows.dropna(subset=keys).groupBy(keys).agg(F.min(place()).alias("_first"), F.max(place()).alias("_last")).where("_first <> _last")
    return rows.join(firsts.drop("_last"), keys).withColumn("late", place() != F.col("_first")).drop("_first")


def marks(keyed: DataFrame, salt: str) -> DataFrame:
    """(_rid, _rth, seeds, gone), per text with a repeated chunk: the places of these and the numbers of the wordy lines that go."""
    chunked = keyed.select("_id", "_th", F.explode(text_chunks(F.col("_text"), salt)).alias("c"))
    slim = cut_lineage(chunked.select("_id", "_th", "c.*"))
    seeds = cut_lineage(_repeated(slim, ["b", "c"]))
    places = seeds.drop("late")
    left, right = _repeated(places, ["a", "b", "c"]), _repeated(places, ["b", "c", "d"])

    def late(rows: DataFrame, *steps: int) -> DataFrame:
        return rows.where("late").select("_id", "_th", F.lit(None).cast("int").alias("seed"), F.explode(F.array(*[F.col("k") + s for s in steps])).alias("line"))

    found = places.select("_id", "_th", F.col("k").alias("seed"), F.lit(None).cast("int").alias("line"))
    for rows in (late(seeds, 0, 1), late(left, -1), late(right, 2)):
        found = found.unionByName(rows)
    return found.groupBy(F.col("_id").alias("_rid"), F.col("_th").alias("_rth")).agg(
        F.collect_set("seed").alias("seeds"), F.collect_set("line").alias("gone"))


def keys_clash(lines: DataFrame, salt: str) -> bool:
    """Whether two lines that differ in their bytes have one key."""
    keyed = lines.dropna().select(line_key(F.col("line"), salt).alias("key"), "line").distinct()
    return not keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _cleaned(docs: DataFrame, id_col: str, text_col: str, *result: Column) -> DataFrame:
    """The result columns, made of `_row`, `_text`, `gone` and `_clean`. The texts meet their marks once: the
    result is written beside the lines to compare, and written anew if their keys clash."""
    keyed = _keyed(docs, id_col, text_col)
    reach = F.array_distinct(F.flatten(F.transform("seeds", lambda k: F.sequence(k - 1, k + 2))))

    def remaining(lines: Column) -> Column:
        at = F.array_compact(F.transform(lines, lambda x, i: F.when(x.rlike(WORDY), i)))
        lost = bound(at, lambda at: F.transform("gone", lambda k: F.get(at, k)))
        kept = F.when(F.col("gone").isNull(), lines).otherwise(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost), lambda i: F.get(lines, i)))
        return F.array_join(kept, "\n")

    compared = F.when(F.col("seeds").isNotNull(), bound(
        wordy(split_lines(F.col("_text"))), lambda lines: bound(reach, lambda at: F.transform(at, lambda k: F.get(lines, k)))))
    for attempt in count():
        salt = str(attempt) if attempt else ""
        found = marks(keyed, salt)
        joined = keyed.join(found, _on_key(keyed, found), "left").withColumn("_clean", bound(split_lines(F.col("_text")), remaining))
        written = cut_lineage(joined.select(F.struct(*result).alias("_row"), compared.alias("_lines")))
        if not keys_clash(written.select(F.explode("_lines").alias("line")), salt):
            return unboxed(written)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the repeated passages taken out of their text; a null text stays null."""
    text = F.when(F.col(f"_row.`{text_col}`").isNotNull(), F.col("_clean"))
    return _cleaned(docs, id_col, text_col, *[
        (text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, n_chunks, removed_chunks, removed_lines, text_sha256 of what is left.

    `removed_chunks` counts the grown ones: runs of wordy lines that go.
    """
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    return _cleaned(
        docs.select(id_col, text_col), id_col, text_col,
        F.col("_id").alias("doc_id"),
        F.size(split_lines(F.col("_text"))).cast("bigint").alias("n_lines"),
        F.size(text_chunks(F.col("_text"))).cast("bigint").alias("n_chunks"),
        F.size(F.array_except(gone, F.transform(gone, lambda k: k + 1))).cast("bigint").alias("removed_chunks"),
        F.size(gone).cast("bigint").alias("removed_lines"),
        F.sha2(F.col("_clean").cast("binary"), 256).alias("text_sha256"),
    )
