"""Substring dedup against all windows, compared word by word."""

import hashlib
import random
import re

import pytest

from shelfline.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(rows, window=S.WINDOW):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p: p + window])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, w in words:
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p: p + window])] < order(i) for q in range(p, p + window)}
        left = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in S.decide(df).collect()), key=repr)


def test_the_cover_has_every_shift():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


def texts(seed, n=60):
    rng = random.Random(seed)
    own = lambda k: [f"w{rng.randint(0, 400)}" for _ in range(k)]
    passages = [own(rng.choice([20, 49, 50, 51, 60, 80, 81, 120, 300])) for _ in range(12)]
    out = []
    for _ in range(n):
        words = own(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(passages)
            cut = rng.choice([0, 0, rng.randint(0, len(piece))])
            words += piece[cut:] + own(rng.choice([0, 1, 40]))
        out.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_passages_equal_brute_force(spark, seed):
    rows = list(enumerate(texts(seed)))
    rows += [(500 + i, t) for i, t in rows[:5]]
    assert sum(r[2] for r in by_hand(rows)) > 1000
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == by_hand(rows)


def test_hot_keys_are_settled_where_they_are_read(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, " ".join(f"{rng.randint(0, 10**9)}" for _ in range(i % 40)) + " " + passage + f" end{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = S._keyed(df, "doc_id", "text")
    # every anchor of the passage is above the share
    assert S._smallest(keyed.mapInArrow(S._anchor_rows, "_id long, _th long, at int, anchor long, context long"), "anchor").count() > 0
    assert found(df) == by_hand(rows)


def test_awkward_rows(spark, awkward, nothing):
    def plain(df):
        return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in S.decide(df).collect()], key=repr)

    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert plain(awkward) == by_hand(rows)
    assert S.decide(nothing).count() == 0 and S.clean(nothing).columns == nothing.columns
    # null ids are equal and larger than all others; an id never removes words of its own other texts
    long = " ".join(f"v{i}" for i in range(130))
    rows = [(None, long), (None, long + " x"), (3, long), (3, "y " + long), (3, long), (4, long + " " + long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == by_hand(rows)
    only_null = [(None, long), (None, long + " x")]
    assert found(spark.createDataFrame(only_null, "doc_id long, text string")) == by_hand(only_null)


def test_clean_takes_the_words_out(spark, awkward):
    out = S.clean(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert out.where("doc_id = 9").first().text == "" and out.where("doc_id = 6").first().n_chars == len(out.where("doc_id = 6").first().text)
    assert out.where("doc_id = 3").first().text is None and out.where("doc_id = 8").first().text == "Ünïcode ▁ mark \x00 é"


def test_a_large_group_of_copies_brings_the_anchors_of_one_text(spark, monkeypatch):
    text, short = " ".join(f"c{i}" for i in range(200)), " ".join(f"longer-word-{i}" for i in range(49))
    rows = [(i, text) for i in range(100, 300)] + [(None, text), (100, text), (7, "x " + text), (400, text + " y")] + [(i, short) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counted, real = [], S.with_smallest

    def counting(found, *keys, **options):
        counted.append(found.count())
        return real(found, *keys, **options)

    monkeypatch.setattr(S, "with_smallest", counting)
    assert found(df) == by_hand(rows)
    one = max(len(S.COVER) * (200 // S.PERIOD + 1), 1)
    assert counted[0] <= 4 * one  # two rows of the smallest id and two texts of their own, not 204
    left = {r.doc_id: r.text for r in S.clean(df).collect()}
    assert left[7] == "x " + text and left[100] == left[299] == left[None] == "" and left[39] == short
