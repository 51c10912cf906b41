"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of aligned token pairs.

Both tokenizers spell " " + text, so their token ends are byte offsets in one string. Where both end, a group
ends; every stretch between two neighbouring ends of either side is one overlap, hence one link of an A token
with a B token.

Counting how many documents hold a pair is external: a task gathers (pair, document, links) records and, when
`RECORDS` of them are there, sorts them by pair, cuts them by the radix of the A id and writes one *run* of zstd
frames per radix to the shared folder. A run holds its pairs once, with their number of documents (`counts`),
and apart from that the records (`places`), so what meets in the merge grows with runs, not documents. Per radix the
runs are merged by a k-way heap merge over their frames, in rounds of at most `FAN_IN` runs. The last round sees
the pairs in A-major order, so the highest count of an A id is known when its pairs have passed. Totals and
maxima then stream back: each run gets them for its own pairs, and its records turn into sums per document.

Defined cases: a text that is null or empty, or that either side does not spell exactly (the mark that stands for a
space in B's pieces, for example), has no tokens: zeros and an empty digest. Rows are documents: a repeated row
counts again and gets the same result. Ties for the highest count are all highest. An empty table gives an empty result;
only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import cut_lineage
from shelfline.llm.textbuf import kept
from shelfline.llm.token_counts import PATTERN

TOKENS_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENS_B = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
# Records a task holds before it writes a run, pairs in a frame, runs merged at once, radixes of the A id.
RECORDS = 2_000_000
FRAME = 1 << 14
FAN_IN = 256
RADIXES = 64
# Characters encoded at once.
BLOCK_CHARS = 1 << 20


class Side:
    """One tokenizer: ids of texts, and the bytes of every id."""

    def __init__(self, tokens: Sequence[bytes], encode):
        self.encode = encode
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of some ids, one after the other."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        return self.data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - n), n)]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def side_a(path: str) -> Side:
    """A byte-level vocabulary; ids are merge ranks."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)
    letters = byte_letters()
    special = {t["id"] for t in vocabulary["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary["model"]["vocab"].items() if i not in special}
    coder = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(max(ranks.values()), max(special, default=0)) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return Side(tokens, lambda texts: [coder.encode_ordinary(" " + t) for t in texts])


def side_b(path: str) -> Side:
    """A piece model that puts the space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
    return Side(tokens, lambda texts: model.encode(list(texts), num_threads=1))


def sides(a: str, b: str) -> tuple[Side, Side]:
    return kept(f"tokens of {a}", lambda: side_a(a)), kept(f"tokens of {b}", lambda: side_b(b))


def _coded(side: Side, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids per text)."""
    lists = side.encode(texts)
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for ids in lists for i in ids), np.int64, int(counts.sum())), counts


def _same_bytes(side: Side, ids: np.ndarray, counts: np.ndarray, texts: Sequence[bytes]) -> np.ndarray:
    """Per text, whether its ids spell it."""
    wanted = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    rows = np.repeat(np.arange(len(texts)), counts)
    got = np.bincount(rows, side.lengths[ids], len(texts)).astype(np.int64)
    same = got == size
    if same.all():
        spelt = side.spell(ids)
        wrong = np.flatnonzero(spelt != wanted)
        same[np.searchsorted(np.cumsum(size), wrong, "right")] = False
        return same
    ends, stops = np.cumsum(counts), np.cumsum(size)
    for r in np.flatnonzero(same):
        same[r] = (side.spell(ids[ends[r] - counts[r]: ends[r]]) == wanted[stops[r] - size[r]: stops[r]]).all()
    return same


def _digits(items: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number in decimal and its separator behind it, as bytes; and where each item ends."""
    n_digits = np.ones(len(items), np.int64)
    for power in (10, 100, 1000, 10_000, 100_000, 1_000_000):
        n_digits += items >= power
    ends = np.cumsum(n_digits + 1)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = marks
    rest, at, live = items.copy(), ends - 2, np.arange(len(items))
    while len(live):
        out[at[live]] = 48 + rest[live] % 10
        rest[live] //= 10
        at[live] -= 1
        live = live[rest[live] > 0]
    return out, ends


class Aligned:
    """The alignment of a block of texts: counts per text, digests, and (text, A id, B id) of every link."""

    def __init__(self, texts: Sequence[str], a: Side, b: Side):
        n = len(texts)
        self.counts = np.zeros((4, n), np.int64)
        self.digests = [""] * n
        spelt = [(" " + t).encode() for t in texts]
        coded = [_coded(side, texts) for side in (a, b)]
        good = np.fromiter(map(bool, texts), bool, n)
        for side, (ids, count) in zip((a, b), coded):
            good &= _same_bytes(side, ids, count, spelt)
        ids, rows, ends = [], [], []
        for side, (id_, count) in zip((a, b), coded):
            row = np.repeat(np.arange(n), count)
            stays = good[row]
            ids.append(id_[stays])
            rows.append(row[stays])
            ends.append(np.cumsum(side.lengths[ids[-1]]))
        size = int(ends[0][-1]) if len(ends[0]) else 0
        marked = np.zeros((2, size + 1), bool)
        marked[0, ends[0]] = marked[1, ends[1]] = True
        both = np.flatnonzero(marked[0] & marked[1])
        either = np.flatnonzero(marked[0] | marked[1])
        at_a, at_b = np.searchsorted(ends[0], either), np.searchsorted(ends[1], either)
        self.rows, self.a, self.b = rows[0][at_a], ids[0][at_a], ids[1][at_b]
        last_a, last_b = np.searchsorted(ends[0], both), np.searchsorted(ends[1], both)
        group_rows = rows[0][last_a]
        for k, r in enumerate((rows[0], rows[1], group_rows, self.rows)):
            self.counts[k] = np.bincount(r, minlength=n)
        self._digest(ids, last_a, last_b, group_rows)

    def _digest(self, ids, last_a, last_b, group_rows) -> None:
        """sha256 of the groups written as a1,a2|b1;a3|b2 per text; all texts are written at once."""
        if not len(last_a):
            return
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        before = np.cumsum(n_a + n_b) - n_a - n_b
        items, marks = np.empty(int((n_a + n_b).sum()), np.int64), np.full(int((n_a + n_b).sum()), ord(","), np.uint8)
        for id_, count, shift in ((ids[0], n_a, before), (ids[1], n_b, before + n_a)):
            first = np.cumsum(count) - count
            items[np.arange(len(id_)) + np.repeat(shift - first, count)] = id_
        marks[before + n_a - 1] = ord("|")
        marks[before + n_a + n_b - 1] = ord(";")
        text, ends = _digits(items, marks)
        text = text.tobytes()
        closing = np.flatnonzero(np.diff(group_rows, append=-1))  # the last group of each text
        stop = ends[(before + n_a + n_b - 1)[closing]].tolist()
        for row, lo, hi in zip(group_rows[closing].tolist(), [0, *stop[:-1]], stop):
            self.digests[row] = hashlib.sha256(text[lo: hi - 1]).hexdigest()

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, text, links) of every distinct pair of each text."""
        key, links = np.unique((self.rows.astype(np.uint64) << np.uint64(32)) | pair_of(self.a, self.b).astype(np.uint64), return_counts=True)
        return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), (key >> np.uint64(32)).astype(np.uint32), links.astype(np.uint32)


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number per id pair, ordered by the A id first; ids are below 2^16."""
    return (a.astype(np.uint32) << np.uint32(16)) | b.astype(np.uint32)


def packed(*columns: np.ndarray, frame: int = FRAME) -> list[bytes]:
    """Equally long columns as zstd frames of at most `frame` rows."""
    import zstandard

    coder = zstandard.ZstdCompressor(level=1)
    n = len(columns[0])
    return [coder.compress(b"".join(c[i: i + frame].tobytes() for c in columns)) for i in range(0, n, frame)]


def unpacked(frame: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(frame)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(data) // sum(widths), 0, []
    for kind, width in zip(kinds, widths):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * width
    return out


def joined(frames: Sequence[bytes], *kinds) -> list[np.ndarray]:
    parts = [unpacked(f, *kinds) for f in frames]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind) for k, kind in enumerate(kinds)]


U32, I64, U8 = np.uint32, np.int64, np.uint8
FRAMES = pa.list_(pa.binary())
DOC = "run long, idx int, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RUN = "radix int, counts array<binary>, places array<binary>"


def run_rows(pair: np.ndarray, text: np.ndarray, links: np.ndarray, radixes: int) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """Per radix of the A id: its pairs with their number of texts, and the records in pair order."""
    radix = (pair >> U32(16)) % U32(radixes)
    order = np.lexsort((text, pair, radix))
    pair, text, links, radix = pair[order], text[order], links[order], radix[order]
    borders = np.searchsorted(radix, np.arange(radixes + 1))
    for r in range(radixes):
        lo, hi = borders[r], borders[r + 1]
        if lo < hi:
            distinct, n = np.unique(pair[lo:hi], return_counts=True)
            yield r, packed(distinct, n.astype(I64)), packed(text[lo:hi], links[lo:hi])


def write_runs(docs: DataFrame, id_col: str, text_col: str, a: str, b: str, records: int, radixes: int) -> DataFrame:
    """Two kinds of rows, written once: documents (without radix) and run segments."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [f.split(" ", 1) for f in f"{DOC.format(id=kind)}, {RUN}".split(", ")]

    def run(batches):
        left, right = sides(a, b)
        task = TaskContext.get().partitionId() << 32
        number, idx, held, parts = 0, 0, 0, []

        def close():
            nonlocal number, idx, held, parts
            rows = list(run_rows(*[np.concatenate([p[k] for p in parts]) for k in range(3)], radixes))
            out = pa.RecordBatch.from_pydict({
                "run": pa.array([task + number] * len(rows), pa.int64()), "radix": pa.array([r for r, _, _ in rows], pa.int32()),
                "counts": pa.array([c for _, c, _ in rows], FRAMES), "places": pa.array([p for _, _, p in rows], FRAMES)})
            number, idx, held, parts = number + 1, 0, 0, []
            return out

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").to_pylist()
            sizes = np.cumsum([len(t) for t in texts])
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BLOCK_CHARS, "right")))
                found = Aligned(texts[lo:hi], left, right)
                n = hi - lo
                yield _complete(pa.RecordBatch.from_arrays(
                    [pa.array([task + number] * n, pa.int64()), pa.array(np.arange(idx, idx + n), pa.int32()), batch.column(0).slice(lo, n),
                     *[pa.array(c) for c in found.counts], pa.array(found.digests, pa.string())],
                    ["run", "idx", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]), batch.column(0).type)
                pair, text, links = found.records()
                parts.append((pair, text + U32(idx), links))
                idx, held, lo = idx + n, held + len(pair), hi
                if held >= records:
                    yield _complete(close(), batch.column(0).type)
        if parts:
            yield _complete(close(), batch.column(0).type)

    def _complete(rows: pa.RecordBatch, id_type: pa.DataType) -> pa.RecordBatch:
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<binary>": FRAMES}
        return pa.RecordBatch.from_arrays(
            [rows.column(name) if name in rows.schema.names else pa.nulls(rows.num_rows, id_type if name == "doc_id" else kinds[k])
             for name, k in fields], [name for name, _ in fields])

    return cut_lineage(docs.select(id_col, text_col).mapInArrow(run, ", ".join(" ".join(f) for f in fields)))


def merge(runs: Sequence[Sequence[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, documents) in order, summed over the runs; a batch holds all pairs of every A id it has.

    One frame per run is held. `ends` is a heap of the last A id loaded of every run that has further frames: below the
    smallest of them nothing is missing. `fronts` is a heap of the first A id at hand of every run.
    """
    todo = [iter(frames) for frames in runs]
    held: list[list[np.ndarray]] = [[np.zeros(0, U32), np.zeros(0, I64)] for _ in runs]
    ends: list[tuple[int, int]] = []
    fronts: list[tuple[int, int]] = []

    def load(r: int) -> None:
        frame = next(todo[r], None)
        if frame is None:
            return
        new = unpacked(frame, U32, I64)
        if not len(held[r][0]):
            heapq.heappush(fronts, (int(new[0][0]) >> 16, r))
        held[r] = [np.concatenate([x, y]) for x, y in zip(held[r], new)]
        heapq.heappush(ends, (int(new[0][-1]) >> 16, r))

    def take(bound: int) -> tuple[np.ndarray, np.ndarray] | None:
        taken = []
        while fronts and fronts[0][0] < bound:
            r = heapq.heappop(fronts)[1]
            pairs, n = held[r]
            cut = int(np.searchsorted(pairs, bound << 16)) if bound < 1 << 16 else len(pairs)
            taken.append((pairs[:cut], n[:cut]))
            held[r] = [pairs[cut:], n[cut:]]
            if cut < len(pairs):
                heapq.heappush(fronts, (int(pairs[cut]) >> 16, r))
        if not taken:
            return None
        pairs, at = np.unique(np.concatenate([p for p, _ in taken]), return_inverse=True)
        total = np.zeros(len(pairs), I64)
        np.add.at(total, at, np.concatenate([n for _, n in taken]))
        return pairs, total

    for r in range(len(runs)):
        load(r)
    while ends:
        bound, r = heapq.heappop(ends)
        found = take(bound)
        if found:
            yield found
        load(r)  # a run without further frames no longer bounds the others
    found = take(1 << 16)
    if found:
        yield found


def highest(pairs: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 where a pair's count is the highest of its A id; all pairs of an A id are there."""
    first = np.flatnonzero(np.diff(pairs >> U32(16), prepend=U32(0xFFFFFFFF)))
    size = np.diff(np.append(first, len(pairs)))
    return (total == np.repeat(np.maximum.reduceat(total, first), size)).astype(U8)


def _by_key(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that arrive in key order, one list per key."""
    last, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if rows and key != last:
                yield last, rows
                rows = []
            last = key
            rows.append(row)
    if rows:
        yield last, rows


def merged_runs(segments: DataFrame, final: bool) -> DataFrame:
    """(radix, run, counts): one row per (radix, run), summed; the final round adds the marks of the highest counts."""

    def run(batches):
        for (radix, number), rows in _by_key(batches, "radix", "run"):
            frames = []
            for pairs, total in merge([row["counts"] for row in rows]):
                frames += packed(pairs, total, highest(pairs, total)) if final else packed(pairs, total)
            yield pa.RecordBatch.from_pydict(
                {"radix": pa.array([radix], pa.int32()), "run": pa.array([number], pa.int64()), "counts": pa.array([frames], FRAMES)})

    placed = segments.repartition("radix", "run").sortWithinPartitions("radix", "run")
    return cut_lineage(placed.mapInArrow(run, "radix int, run long, counts array<binary>"))


def pair_table(segments: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(radix, counts): all pairs of a radix with their number of documents and whether it is the highest of its A id."""
    level = segments.select("radix", "run", "counts")
    while True:
        most = level.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
        groups = -(-most // fan_in)
        if groups <= 1:
            return merged_runs(level.withColumn("run", F.lit(0).cast("bigint")), True).drop("run")
        level = merged_runs(level.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(groups))), False)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a run segment and its radix's table: total and mark for each of the segment's pairs, in their order."""
    known: tuple[int, list[np.ndarray]] | None = None
    for batch in batches:
        for row in batch.to_pylist():
            if known is None or known[0] != row["radix"]:
                known = (row["radix"], joined(row["table"], U32, I64, U8))
            pairs, n = joined(row["counts"], U32, I64)
            at = np.searchsorted(known[1][0], pairs)
            yield pa.RecordBatch.from_pydict({
                "run": pa.array([row["run"]], pa.int64()), "radix": pa.array([row["radix"]], pa.int32()),
                "answers": pa.array([packed(n, known[1][1][at], known[1][2][at])], FRAMES)})


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, idx, n_best, count_sum) from the records of a run and the answers to them; rows come in run order."""

    def closed(run: int, sums: np.ndarray) -> pa.RecordBatch:
        n = sums.shape[1]
        return pa.RecordBatch.from_arrays(
            [pa.array([run] * n, pa.int64()), pa.array(np.arange(n), pa.int32()), pa.array(sums[0]), pa.array(sums[1])],
            ["run", "idx", "n_best", "count_sum"])

    last, sums, answer = None, np.zeros((2, 0), I64), None
    for batch in batches:
        for row in batch.to_pylist():
            if last is not None and row["run"] != last:
                yield closed(last, sums)
                sums = np.zeros((2, 0), I64)
            last = row["run"]
            if row["answers"] is not None:  # the answers stand before the records they belong to
                answer = joined(row["answers"], I64, I64, U8)
                continue
            n, total, best = answer
            idx, links = joined(row["places"], U32, U32)
            if len(idx) and int(idx.max()) >= sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, int(idx.max()) + 1 - sums.shape[1])))
            np.add.at(sums[0], idx, links.astype(I64) * np.repeat(best, n))
            np.add.at(sums[1], idx, links.astype(I64) * np.repeat(total, n))
    if last is not None:
        yield closed(last, sums)


def decide(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = TOKENS_A, b: str = TOKENS_B,
    records: int = RECORDS, radixes: int = RADIXES, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    written = write_runs(docs, id_col, text_col, a, b, records, radixes)
    segments = written.where(F.col("radix").isNotNull())
    table = pair_table(segments, fan_in).withColumnRenamed("counts", "table")
    answers = segments.select("radix", "run", "counts").join(table, "radix").mapInArrow(
        _answers, "run long, radix int, answers array<binary>")
    stream = (
        segments.select("run", "radix", "places").unionByName(answers, allowMissingColumns=True)
        .repartition("run").sortWithinPartitions("run", "radix", F.col("answers").isNull())
    )
    sums = stream.mapInArrow(_contributions, "run long, idx int, n_best long, count_sum long")
    zero = F.lit(0).cast("bigint")
    return written.where(F.col("radix").isNull()).join(sums, ["run", "idx"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
