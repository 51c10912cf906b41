"""Token alignment against a plain computation with the libraries' own encoders."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfline.llm import token_alignment as A


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A.TOKENS_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=A.TOKENS_B)


def by_hand(data, encoders):
    """doc key → the contract's columns, token by token; the first side uses another library than the operator."""
    a, b = encoders
    letters = A.byte_letters()
    a_bytes = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    out, holds, links_of = {}, Counter(), {}
    for key, text in data:
        out[key] = [0, 0, 0, 0, 0, 0, ""]
        links_of[key] = Counter()
        if not text:
            continue
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
        spelt = [[f(i) for i in x] for f, x in zip((a_bytes, b_bytes), ids)]
        if any(b"".join(s) != (" " + text).encode() for s in spelt):
            continue
        spans = []
        for s in spelt:
            at, row = 0, []
            for t in s:
                row.append((at, at + len(t)))
                at += len(t)
            spans.append(row)
        i = j = 0
        links, groups, start = [], [], (0, 0)
        while i < len(ids[0]) and j < len(ids[1]):
            links.append((ids[0][i], ids[1][j]))
            end_a, end_b = spans[0][i][1], spans[1][j][1]
            i, j = i + (end_a <= end_b), j + (end_b <= end_a)
            if end_a == end_b:
                groups.append(",".join(map(str, ids[0][start[0]:i])) + "|" + ",".join(map(str, ids[1][start[1]:j])))
                start = (i, j)
        links_of[key] = Counter(links)
        holds.update(set(links))
        out[key] = [len(ids[0]), len(ids[1]), len(groups), len(links), 0, 0, hashlib.sha256(";".join(groups).encode()).hexdigest()]
    best = defaultdict(int)
    for (x, y), n in holds.items():
        best[x] = max(best[x], n)
    for key, links in links_of.items():
        out[key][4] = sum(n for (x, y), n in links.items() if holds[x, y] == best[x])
        out[key][5] = sum(n * holds[p] for p, n in links.items())
    return {k: tuple(v) for k, v in out.items()}


def texts():
    rng = random.Random(3)
    words = ["the", "naïve", "Über", "日本語", "don't", "x" * 40, "12345", "<|endoftext|>", "<s>", "<0x41>", "…", "\x00", "🙂👩‍👩‍👧", "foo_bar", "A-B", "​", "é"]
    made = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "", "\t", " \n\n ", "   "]) for _ in range(rng.choice([1, 3, 30, 200]))) for _ in range(120)]
    return [None, "", " ", "  ", "\n", "▁", "a ▁ b", "<|endoftext|>", "a", " a", *made, made[0], made[0]]


def columns(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_alignment_equals_plain_computation_however_runs_are_cut(spark, encoders):
    data = list(enumerate(texts()))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    wanted = by_hand(data, encoders)
    assert sum(v[3] for v in wanted.values()) > 5000 and wanted[5] == (0, 0, 0, 0, 0, 0, "")
    assert columns(A.decide(df)) == wanted
    # many small runs, merged in several rounds
    assert columns(A.decide(df, records=300, radixes=3, fan_in=2)) == wanted


def test_documents_equal_plain_computation(documents, encoders):
    data = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert columns(A.decide(documents)) == by_hand(data, encoders)


def test_the_merge_holds_one_frame_per_run_and_sums_all(monkeypatch):
    rng = np.random.default_rng(4)
    runs, total = [], Counter()
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 40, 300).astype(np.uint32) << 16 | rng.integers(0, 20, 300).astype(np.uint32))
        n = rng.integers(1, 5, len(pairs))
        total.update(dict(zip(pairs.tolist(), n.tolist())))
        runs.append(A.packed(pairs, n.astype(np.int64), frame=7))
    batches = list(A.merge(runs))
    assert len(batches) > 5
    pairs, n = (np.concatenate([b[k] for b in batches]) for k in (0, 1))
    assert dict(zip(pairs.tolist(), n.tolist())) == dict(total) and (np.diff(pairs.astype(np.int64)) > 0).all()
    # an A id never spans two batches, so its highest count is known inside one
    seen = [set((b[0] >> 16).tolist()) for b in batches]
    assert sum(map(len, seen)) == len(set().union(*seen))
    for pairs, n in batches:
        best = {a: n[(pairs >> 16) == a].max() for a in set((pairs >> 16).tolist())}
        assert A.highest(pairs, n).tolist() == [int(best[int(p) >> 16] == c) for p, c in zip(pairs, n)]


def test_awkward_rows_and_empty_tables(awkward, nothing):
    out = A.decide(awkward)
    assert out.count() == awkward.count() and out.where("n_a is null or n_best is null or groups_sha256 is null").count() == 0
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    twins = {tuple(r)[1:] for r in out.where("doc_id = 1").collect()}
    assert len(twins) == 1
    assert A.decide(nothing).count() == 0
