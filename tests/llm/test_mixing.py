"""Mixing against a plain solution of the same program."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfline.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def plain_targets(sizes, limit=3):
    """Source → target: share out, stop those above their limit, share their excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left, base = total - sum(fixed.values()), sum(weight[s] for s in rest)
        if not rest:
            return fixed
        out = {s: left * weight[s] / base for s in rest}
        above = [s for s in rest if out[s] > limit * sizes[s]]
        if not above:
            return {**fixed, **out}
        fixed |= {s: float(limit * sizes[s]) for s in above}


def plain_rate(sizes, target, limit=3.0):
    lo, hi = -5.0, 5.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(n * min(limit, math.exp(min(mid * n, 700))) for n in sizes) > target:
            hi = mid
        else:
            lo = mid
    return lo


def made(seed, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "Z", "é", "tiny", None])
        if source == "tiny" and rng.random() < 0.9:
            source = "a"
        words = rng.choice([0, 1, 3, 20, rng.randint(1, 300), rng.randint(1, 3000) if rng.random() < 0.05 else 7])
        rows.append((i, None if words == 0 and rng.random() < 0.5 else " ".join(["w"] * words), source))
    return rows


@pytest.mark.parametrize("seed", [1])
def test_targets_rates_and_words_taken(spark, seed):
    data = made(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r.doc_id: r for r in mixing.decide(df).collect()}
    assert len(got) == len(data)
    sizes = defaultdict(list)
    for doc_id, text, source in data:
        n = len((text or "").split())
        assert got[doc_id].size == n
        sizes[source].append((doc_id, n))
    totals = {s: sum(n for _, n in rows) for s, rows in sizes.items()}
    wanted = plain_targets(totals)
    for source, rows in sizes.items():
        ones = [got[d] for d, _ in rows]
        assert {r.source_size for r in ones} == {totals[source]}
        assert all(math.isclose(r.target, wanted[source], rel_tol=1e-9) for r in ones)
        taken = sum(r.taken for r in ones)
        longest = max(n for _, n in rows)
        assert abs(taken - wanted[source]) <= max(0.02 * wanted[source], 0.5 * longest), source
        assert all(r.taken == r.copies * r.size and r.copies <= 3 for r in ones)
        if wanted[source] < 2.999 * totals[source]:
            lam = plain_rate([n for _, n in rows if n], wanted[source])
            for r in ones:
                if r.size:
                    assert math.isclose(r.rate, min(3.0, math.exp(lam * r.size)), rel_tol=1e-3, abs_tol=1e-6)
                    assert math.floor(r.rate - 1e-9) <= r.copies <= math.ceil(r.rate + 1e-9)


def test_reruns_agree_however_the_rows_lie(spark, rows):
    df = spark.createDataFrame(made(3, 600), SCHEMA)
    assert rows(mixing.decide(df.repartition(2)), "doc_id", "copies") == rows(mixing.decide(df.repartition(9, "text")), "doc_id", "copies")


def test_awkward_rows(awkward, nothing):
    got = mixing.decide(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r.taken == 0 and r.rate == 0 for r in got if r.size == 0) and all(r.taken <= 3 * r.size for r in got)
    assert len({(r.size, r.copies) for r in got if r.doc_id == 1}) == 1
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.decide(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_one_source_and_texts_without_words(spark):
    df = spark.createDataFrame([(1, "a b", "s"), (2, " ", "s"), (3, None, "t")], SCHEMA)
    got = {r.doc_id: (r.source_size, r.target, r.taken) for r in mixing.decide(df).collect()}
    assert got == {1: (2, 2.0, 2), 2: (2, 2.0, 0), 3: (0, 0.0, 0)}


def test_the_mix_repeats_each_document_as_often_as_decided(spark):
    df = spark.createDataFrame(made(4, 400), SCHEMA)
    copies = {r.doc_id: r.copies for r in mixing.decide(df).collect() if r.copies}
    mixed = {r.doc_id: r["count"] for r in mixing.mix(df).groupBy("doc_id").count().collect()}
    assert mixed == copies
    assert mixing.mix(df).join(df, ["doc_id", "text", "source"], "left_anti").where(F.col("text").isNotNull() & F.col("source").isNotNull()).count() == 0
