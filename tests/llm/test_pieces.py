"""Sampled segmentations: lossless, reproducible, and with the right distribution."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfline.llm import pieces as P
from shelfline.llm.textbuf import blocks

ODD = ["", " ", "   ", "a", " a", "a ", "a  b   c", "▁ ▁▁ x▁y", "tab\tnew\n\nline\r\n", "\x00\x01", "日本語のテキスト", "😀 emoji🎉", "é ü ñ", "x" * 700, "  lead", "trail  "]


def coded(texts, keys, size=P.BLOCK):
    vocab = P.vocabulary(P.MODEL)
    out = []
    for block in blocks(pa.array(texts), size):
        count, found = P.encode_block(block, keys[block.lo: block.lo + block.rows], vocab, P.SHARPNESS)
        ends = np.cumsum(count)
        out += [found[a:b].tolist() for a, b in zip(ends - count, ends)]
    return out


def spell(ids):
    vocab = P.vocabulary(P.MODEL)
    return b"".join(vocab.data[vocab.offsets[i]: vocab.offsets[i + 1]].tobytes() for i in ids).decode()


def random_texts(n=200, seed=1):
    rng = random.Random(seed)
    letters = "abcdefghij ABC  \n\t.,▁éß日😀\x7f"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_decoding_is_lossless_and_blocks_do_not_matter():
    texts = ODD + random_texts() + ["a ", "   ", " b", " ", "  "]
    keys = np.arange(len(texts), dtype=np.uint64)
    found = coded(texts, keys)
    assert [spell(ids) for ids in found] == texts
    assert coded(texts, keys, 64) == found
    assert coded(texts, keys + np.uint64(1)) != found


def test_round_trip_in_spark(spark):
    texts = ODD + random_texts(60, 3) + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    back = df.withColumn("ids", P.encode(F.col("text"), F.col("doc_id"))).withColumn("back", P.decode(F.col("ids")))
    assert back.where(~F.col("back").eqNullSafe(F.col("text"))).count() == 0
    got = {r.doc_id: r for r in P.decide(df).collect()}
    assert all(r.lossless for r in got.values()) and got[len(texts) - 1].n_pieces == 0
    again = {r.doc_id: r.pieces_digest for r in P.decide(df.repartition(2)).collect()}
    assert again == {d: r.pieces_digest for d, r in got.items()}


def all_segmentations(word, vocab):
    """Every way to spell the word in pieces, with its weight; characters without a piece are not used here."""
    ids = {vocab.data[vocab.offsets[i]: vocab.offsets[i + 1]].tobytes(): i for i in range(259, len(vocab.weight))}
    data = word.encode()
    out = []

    def walk(at, path, weight):
        if at == len(data):
            out.append((tuple(path), weight))
        for stop in range(at + 1, len(data) + 1):
            if data[at:stop] in ids:
                walk(stop, [*path, ids[data[at:stop]]], weight + vocab.weight[ids[data[at:stop]]])

    walk(0, [], 0.0)
    return out


def test_samples_follow_the_lattice_distribution():
    vocab = P.vocabulary(P.MODEL)
    n = 40_000
    for word in (" hello", "there", " thing"):
        ways = all_segmentations(word, vocab)
        mass = np.exp([w for _, w in ways])
        wanted = dict(zip([p for p, _ in ways], mass / mass.sum()))
        seen = Counter(map(tuple, coded([word] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919))))
        assert set(seen) <= set(wanted) and len(ways) > 5
        for path, p in wanted.items():
            assert abs(seen[path] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4, (word, path)


def test_occurrences_of_one_word_are_drawn_on_their_own():
    (ids,) = coded([" hello" * 300], np.array([5], np.uint64))
    (one,) = coded([" hello"], np.array([5], np.uint64))
    assert len(ids) != 300 * len(one)


def test_awkward_rows_and_empty_tables(awkward, nothing):
    out = P.decide(awkward)
    assert out.count() == awkward.count() and out.where("not lossless").count() == 0
    assert len({r.pieces_digest for r in out.where("doc_id = 1").collect()}) == 1
    assert P.decide(nothing).count() == 0 and P.sampled_pieces(nothing).count() == 0


def test_the_query_returns_pieces_that_decode(spark, documents):
    out = P.decide(documents)
    assert out.columns == ["doc_id", "n_pieces", "pieces_digest", "lossless", "pieces"]
    assert out._jdf.queryExecution().executedPlan().toString().count("sampled(") <= 2  # drawn once
    texts = {r.doc_id: r.text for r in documents.collect()}
    model = P.vocabulary(P.MODEL)
    for r in out.limit(40).collect():
        body = b"".join(bytes(model.data[model.offsets[i]: model.offsets[i + 1]]) for i in r.pieces)
        assert body.decode() == texts[r.doc_id] and r.n_pieces == len(r.pieces) and r.lossless
