"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is cut into pre-tokens (a word with the one space before it, a run of further spaces, a line
break); no piece crosses them, so the piece lattice of a text is a row of small lattices. Each
distinct pre-token's lattice is filtered forward once per block of texts: alpha(end) sums over all
segmentations up to `end`. Every occurrence then draws its own segmentation backward, piece by
piece, with probability alpha(start) * p(piece) / alpha(end). The draws are a hash of (row key, place in the
text, step), so a row gets the same pieces in any run, partitioning or block.

The vocabulary is a given SentencePiece model; a piece's weight is Zipf's law over its rank in the model,
raised to `sharpness`. A character without a piece of its own is spelt in byte pieces, so every text
can be encoded. Spaces are kept as they are (no normalising, no added space), and the mark that
stands for a space inside pieces is itself spelt in bytes: decoding gives back the exact text.

Defined cases: a null text has null pieces and decodes to null; an empty one has none; repeated rows
with the same key get the same pieces; a null key is a key; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.textbuf import BYTE_VALUES, Block, blocks, kept, mix, prefix_sums, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHARPNESS = 1.0
SEED = 1
# Texts encoded, and pieces decoded, at once.
BLOCK = 1 << 17
DECODED = 1 << 18
SPACE_MARK = "▁"
CHAR_BYTES = np.ones(256, np.int64)
CHAR_BYTES[0xC0:0xE0], CHAR_BYTES[0xE0:0xF0], CHAR_BYTES[0xF0:0xF8] = 2, 3, 4


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as text bytes, their weights, and per length the hashes of all piece heads of that length."""

    weight: np.ndarray
    byte_ids: np.ndarray
    heads: list[tuple[np.ndarray, np.ndarray]]
    data: np.ndarray
    offsets: np.ndarray


def vocabulary(path: str) -> Vocabulary:
    return kept(f"pieces of {path}", lambda: read_vocabulary(path))


def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    texts, byte_ids, usable = [], np.full(256, -1, np.int64), []
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            texts.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            texts.append(model.id_to_piece(i).replace(SPACE_MARK, " ").encode())
            usable.append(i)
    if (byte_ids < 0).any():
        raise ValueError(f"{path} has no byte pieces; texts could not be decoded without loss")
    weight = -np.log(np.arange(n) + 1.0)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    sums = prefix_sums(data, BYTE_VALUES)
    starts, lengths = offsets[:-1], np.diff(offsets)
    usable = np.array(usable)
    heads = []
    for length in range(1, int(lengths[usable].max()) + 1):
        longer = usable[lengths[usable] >= length]
        keys = span_hashes(sums, starts[longer], starts[longer] + length)
        ids = np.where(lengths[longer] == length, longer, -1)
        order = np.lexsort((-ids, keys))  # a whole piece before the longer ones it begins
        keys, ids = keys[order], ids[order]
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        heads.append((keys[fresh], ids[fresh]))
    return Vocabulary(weight, byte_ids, heads, data, offsets)


def pre_tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the pre-tokens; they cover all bytes."""
    data, n = block.data, len(block.data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space, line = data == 32, (data < 32)
    cut = np.zeros(n + 1, bool)
    cut[block.offsets] = True
    cut[:n] |= line
    cut[1:] |= line
    before, after = np.concatenate([[False], space[:-1]]), np.concatenate([space[1:], [False]])
    # a neighbour is one of the same text
    before[block.offsets[block.offsets < n]] = False
    after[block.offsets[1:] - 1] = False
    cut[:n] |= space & ~(before & after)
    borders = np.flatnonzero(cut)
    starts, ends = borders[:-1], borders[1:]
    return starts, ends, np.searchsorted(block.offsets, starts, "right") - 1


@dataclass(frozen=True)
class Lattice:
    """Edges grouped by end node; `first` per node, cumulated probability, piece and start node per edge."""

    first: np.ndarray
    cumulated: np.ndarray
    piece: np.ndarray
    start: np.ndarray


def forward(data: np.ndarray, lengths: np.ndarray, vocab: Vocabulary, sharpness: float) -> tuple[Lattice, np.ndarray, np.ndarray]:
    """The filtered lattices of many words that lie one after the other in `data`; first and last node of each.

    Word k has lengths[k] + 1 nodes; node = byte position + k.
    """
    total, count = len(data), len(lengths)
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
    word = np.repeat(np.arange(count), lengths)
    end = (begin + lengths)[word]
    sums = prefix_sums(data, BYTE_VALUES)
    froms, tos, ids = [], [], []
    at = np.arange(total)
    char = np.minimum(CHAR_BYTES[data], end - at)
    single = np.zeros(total, bool)
    alive = at
    for length, (keys, pieces) in enumerate(vocab.heads, 1):
        alive = alive[alive + length <= end[alive]]
        if not len(alive):
            break
        hashes = span_hashes(sums, alive, alive + length)
        slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[slot] == hashes
        alive, slot = alive[known], slot[known]
        whole = pieces[slot] >= 0
        froms.append(alive[whole])
        tos.append(alive[whole] + length)
        ids.append(pieces[slot[whole]])
        one = alive[whole]
        single[one[char[one] == length]] = True
    # characters without a piece of their own are spelt in bytes
    head = (data & 0xC0) != 0x80
    spelt = np.flatnonzero(head & ~single)
    for k in range(4):
        byte = spelt[char[spelt] > k] + k
        froms.append(byte)
        tos.append(byte + 1)
        ids.append(vocab.byte_ids[data[byte]])
    # a stray continuation byte, which valid text does not have, is spelt too
    inner = np.zeros(total + 4, bool)
    for k in range(1, 4):
        inner[np.flatnonzero(head & (char > k)) + k] = True
    stray = np.flatnonzero(~head & ~inner[:total])
    froms.append(stray)
    tos.append(stray + 1)
    ids.append(vocab.byte_ids[data[stray]])
    source, target, piece = np.concatenate(froms), np.concatenate(tos), np.concatenate(ids)
    of = word[source]
    order = np.argsort(target, kind="stable")
    source, target, piece, of = source[order], target[order], piece[order], of[order]
    depth = target - begin[of]
    source, target = source + of, target + of
    log_p = vocab.weight[piece] * sharpness
    alpha = np.full(total + count, -np.inf)
    alpha[begin + np.arange(count)] = 0.0
    by_depth = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 65536 else depth, kind="stable")
    steps = np.searchsorted(depth[by_depth], np.arange(1, (depth.max() if len(depth) else 0) + 2))
    for a, b in zip(steps[:-1], steps[1:]):
        edges = by_depth[a:b]
        if not len(edges):
            continue
        goal = target[edges]
        lead = np.flatnonzero(np.concatenate([[True], goal[1:] != goal[:-1]]))
        alpha[goal[lead]] = np.logaddexp.reduceat(alpha[source[edges]] + log_p[edges], lead)
    with np.errstate(invalid="ignore"):
        p = np.exp(alpha[source] + log_p - alpha[target])
    p = np.nan_to_num(p)
    first = np.searchsorted(target, np.arange(total + count))
    running = np.cumsum(p)
    lead = first[target]
    cumulated = running - (running[lead] - p[lead])
    final = np.concatenate([target[1:] != target[:-1], [True]]) if len(target) else np.zeros(0, bool)
    cumulated[final] = np.inf
    return Lattice(first, cumulated, piece, source), begin + np.arange(count), begin + lengths + np.arange(count)


def backward(lattice: Lattice, origin: np.ndarray, node: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One draw per occurrence, all at once: (pieces per occurrence, all pieces in text order)."""
    n = len(node)
    node = node.copy()
    alive, taken = np.arange(n), []
    count = np.zeros(n, np.int64)
    step = 0
    while len(alive):
        draw = (mix(seeds[alive] + np.uint64(step)) >> np.uint64(11)).astype(float) * 2.0**-53
        edge = lattice.first[node[alive]]
        later = np.flatnonzero(lattice.cumulated[edge] <= draw)
        while len(later):
            edge[later] += 1
            later = later[lattice.cumulated[edge[later]] <= draw[later]]
        taken.append((alive, lattice.piece[edge]))
        node[alive] = lattice.start[edge]
        count[alive] += 1
        alive = alive[node[alive] != origin[alive]]
        step += 1
    end = np.cumsum(count)
    out = np.zeros(int(end[-1]) if n else 0, np.int32)
    for step, (who, piece) in enumerate(taken):
        out[end[who] - 1 - step] = piece
    return count, out


def encode_block(block: Block, keys: np.ndarray, vocab: Vocabulary, sharpness: float) -> tuple[np.ndarray, np.ndarray]:
    """(pieces per row, all pieces)."""
    starts, ends, rows = pre_tokens(block)
    hashes = span_hashes(prefix_sums(block.data, BYTE_VALUES), starts, ends)
    _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = (ends - starts)[sample]
    shift = np.repeat(starts[sample] - np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths)
    lattice, origin, final = forward(block.data[np.arange(len(shift)) + shift], lengths, vocab, sharpness)
    place = np.arange(len(starts)) - np.searchsorted(rows, rows)
    seeds = mix(keys[rows] + mix(place.astype(np.uint64)))
    count, pieces = backward(lattice, origin[which], final[which], seeds)
    return np.bincount(rows, count, block.rows).astype(np.int64), pieces


def spell(count: np.ndarray, pieces: np.ndarray, vocab: Vocabulary) -> tuple[bytes, np.ndarray]:
    """(text bytes, end of each row in them) that pieces spell."""
    sizes = (vocab.offsets[1:] - vocab.offsets[:-1])[pieces]
    stops = np.concatenate([[0], np.cumsum(sizes)])
    shift = np.repeat(vocab.offsets[pieces] - stops[:-1], sizes)
    return vocab.data[np.arange(len(shift)) + shift].tobytes(), stops[np.cumsum(count)]


def _row_key(key: Column, seed: int) -> Column:
    return F.xxhash64(key.cast("string"), F.lit(seed))


def _coded(texts: pa.Array, keys: pa.Array, vocab: Vocabulary, sharpness: float) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    numbers = np.asarray(keys).astype(np.int64).view(np.uint64)
    for block in blocks(texts, BLOCK):
        yield block, *encode_block(block, numbers[block.lo: block.lo + block.rows], vocab, sharpness)


def _lists(counts: list[np.ndarray], pieces: list[np.ndarray]) -> pa.ListArray:
    borders = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(np.concatenate([np.zeros(0, np.int32), *pieces])))


def encode(text: Column, key: Column, model: str = MODEL, sharpness: float = SHARPNESS, seed: int = SEED) -> Column:
    """Piece ids of a text column, drawn by a key column."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def sampled(texts: pa.Array, keys: pa.Array) -> pa.Array:
        found = [(n, ids) for _, n, ids in _coded(texts, keys, vocabulary(model), sharpness)]
        return _lists([n for n, _ in found], [ids for _, ids in found])

    return F.when(text.isNotNull(), sampled(text.cast("string"), _row_key(key, seed)))


def encode_with_digest(text: Column, key: Column, model: str = MODEL, sharpness: float = SHARPNESS, seed: int = SEED) -> Column:
    """struct(pieces, text_sha256): the piece ids and the SHA-256 of the text they decode to.

    Pieces are decoded where they are made, so the texts do not travel a second time.
    """

    @F.arrow_udf(T.StructType().add("pieces", T.ArrayType(T.IntegerType())).add("text_sha256", T.StringType()))
    def sampled(texts: pa.Array, keys: pa.Array) -> pa.Array:
        vocab = vocabulary(model)
        counts, pieces, digests = [], [], []
        for _, n, ids in _coded(texts, keys, vocab, sharpness):
            body, ends = spell(n, ids, vocab)
            counts.append(n)
            pieces.append(ids)
            starts = [0, *ends[:-1].tolist()]
            digests += [hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(starts, ends.tolist())]
        return pa.StructArray.from_arrays([_lists(counts, pieces), pa.array(digests, pa.string())], ["pieces", "text_sha256"])

    return F.when(text.isNotNull(), sampled(text.cast("string"), _row_key(key, seed)))


@F.arrow_udf(T.StringType())
def digests(lists: pa.Array) -> pa.Array:
    """A digest of each list of piece ids."""
    borders = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    ids = lists.flatten().to_numpy()
    return pa.array([hashlib.blake2b(ids[a:b].tobytes(), digest_size=16).hexdigest() for a, b in zip(borders[:-1], borders[1:])], pa.string())


def decode(ids: Column, model: str = MODEL) -> Column:
    """The text that some piece ids spell."""

    @F.arrow_udf(T.StringType())
    def spelt(lists: pa.Array) -> pa.Array:
        vocab = vocabulary(model)
        counts = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        borders = np.concatenate([[0], np.cumsum(counts)])
        flat = np.asarray(lists.flatten())
        bodies, ends, lo, size = [], [np.zeros(1, np.int64)], 0, 0
        while lo < len(lists):
            hi = min(len(lists), max(lo + 1, int(np.searchsorted(borders, borders[lo] + DECODED, "right")) - 1))
            body, stops = spell(counts[lo:hi], flat[borders[lo]: borders[hi]], vocab)
            bodies.append(body)
            ends.append(size + stops)
            size += len(body)
            lo = hi
        texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(np.concatenate(ends).tobytes()), pa.py_buffer(b"".join(bodies)))
        return texts.cast(pa.string())

    return F.when(ids.isNotNull(), spelt(ids))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per input row: doc_id, n_pieces, pieces_digest, lossless (the pieces decode to the text), pieces."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    coded = rows.withColumn("pieces", encode(F.col("_text"), F.col("doc_id"), model))
    read = coded.withColumn("_back", decode(F.col("pieces"), model))
    listed = F.coalesce("pieces", F.array().cast("array<int>"))
    return read.select(
        "doc_id", F.size(listed).cast("bigint").alias("n_pieces"), digests(listed).alias("pieces_digest"),
        F.col("_text").eqNullSafe(F.col("_back")).alias("lossless"), "pieces")


def sampled_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, pieces, text_sha256 (of the decoded pieces): the table a trainer reads. A null text has null pieces."""
    coded = docs.select(F.col(id_col).alias("doc_id"), encode_with_digest(F.col(text_col), F.col(id_col), model).alias("c"))
    return coded.select("doc_id", F.coalesce(F.size("c.pieces"), F.lit(0)).cast("bigint").alias("n_pieces"), "c.pieces", "c.text_sha256")
