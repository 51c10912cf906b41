"""Exact dedup, near dedup and line dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline.llm import exact_dedup, line_dedup, near_dedup
from shelfline.llm.textbuf import blocks

WHITE = re.compile(r"[\x20\x09-\x0D]")


def by_hand_exact(rows):
    """(doc_id, text) rows → the expected result rows."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[WHITE.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text in rows:
        bare = WHITE.sub("", text or "")
        best = min(groups[bare], key=lambda x: (x[0], x[1], x[2] or 0))
        kept = (-len(text or ""), doc_id is None, doc_id) == best
        out.append((doc_id, best[2], len(groups[bare]), kept, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_cases(awkward, rows):
    given = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows(exact_dedup.decide(awkward)) == by_hand_exact(given)


@pytest.mark.parametrize("share", [0.5, 0.01, 1 / 2000])
def test_exact_is_the_same_however_many_digests_are_hot(spark, rows, share):
    rng = random.Random(3)
    data = [(i, "hot text" + " " * rng.randint(0, 3) if rng.random() < 0.4 else f"t{rng.randint(0, 60)}") for i in range(900)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(7)
    assert rows(exact_dedup.decide(df, share=share)) == by_hand_exact(data)
    kept = sorted(r[0] for r in exact_dedup.deduplicate(df, share=share).select("doc_id").collect())
    assert kept == sorted(r[0] for r in by_hand_exact(data) if r[3])


def test_exact_leaves_one_row_of_each_text(awkward):
    left = exact_dedup.deduplicate(awkward)
    assert left.columns == awkward.columns
    texts = [WHITE.sub("", r.text or "") for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({WHITE.sub("", r.text or "") for r in awkward.collect()})


def test_empty_tables(nothing):
    assert exact_dedup.decide(nothing).count() == 0 and exact_dedup.deduplicate(nothing).count() == 0
    assert near_dedup.decide(nothing).count() == 0 and near_dedup.deduplicate(nothing).count() == 0
    assert line_dedup.decide(nothing).count() == 0 and line_dedup.clean(nothing).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i: i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def by_hand_near(data, percent=85):
    sets = {d: shingle_set(t) for d, t in data}
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(sets[d]), root(d), root(d) == d) for d in ids), key=repr)


def near_data(seed, bases=12, copies=9):
    """Groups of near copies around the limit, chains, short texts and unrelated ones."""
    rng = random.Random(seed)
    data, n = [], 0
    for b in range(bases):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([2, 4, 9, 30, 80, 150]))]
        for _ in range(rng.randint(1, copies)):
            mine = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                mine[rng.randrange(len(mine))] = f"e{rng.randint(0, 10_000)}"
            if rng.random() < 0.3:
                words = mine  # a chain: the next copies start from here
            data.append((n, " ".join(mine).upper() if rng.random() < 0.2 else "  ".join(mine)))
            n += 1
    rng.shuffle(data)
    return [*data, (9000, ""), (9001, None), (9002, " \n"), (9003, "one"), (9004, "one"), (9005, "one two")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_components_equal_brute_force(spark, rows, seed):
    data = near_data(seed)
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    assert rows(near_dedup.decide(df)) == by_hand_near(data)


def test_near_group_with_a_late_base_is_one_component(spark, rows):
    """The base comes last: no member of the star around the smallest id is similar enough to it."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    data = []
    for i in range(40):
        mine = list(base)
        for _ in range(3):
            mine[rng.randrange(120)] = f"x{i}{rng.randint(0, 99)}"
        data.append((i, " ".join(mine)))
    data.append((99, " ".join(base)))
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    assert rows(near_dedup.decide(df)) == by_hand_near(data)


def test_near_cases(awkward):
    got = near_dedup.decide(awkward).collect()
    assert len(got) == awkward.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert {x[1:] for x in by[1]} == {(1, True)} and len(by[1]) == 2
    assert by[5][0][1:] == (1, False) and by[9][0][1:] == (6, False) and by[6][0][1:] == (6, True)
    # the null id has the text of document 1, and the other one no text
    assert sorted(by[None], key=repr) == sorted([(by[1][0][0], 1, False), (0, None, True)], key=repr)
    left = near_dedup.deduplicate(awkward)
    assert left.columns == awkward.columns and left.where("doc_id in (5, 9)").count() == 0 and left.where("doc_id = 1").count() == 2


def test_near_dedup_drops_a_text_not_all_texts_of_its_id(spark, awkward):
    """A null-id copy and a copy under an id of two texts go alone."""
    data = [(1, "a b c d e f g"), (None, "a b c d e f g"), (None, "quite another text here"), (7, "two texts of one id"), (7, "A b C d e f g")]
    left = near_dedup.deduplicate(spark.createDataFrame(data, "doc_id bigint, text string").repartition(3))
    assert {tuple(r) for r in left.collect()} == {data[0], data[2], data[3]}
    left = [(r.doc_id, r.text) for r in near_dedup.deduplicate(awkward).collect()]
    assert (None, None) in left and (7, "twice") in left and (7, "two texts of one id") in left
    assert sum(d is None for d, _ in left) == 1


def test_near_links_do_not_depend_on_ids(spark):
    """Texts under null ids, or several under one id, link and chain like others."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(200)]

    def variant(words, *places):
        return [f"v{i}" if i in places else w for i, w in enumerate(words)]

    chain = [base, variant(base, 20, 60), variant(base, 20, 60, 100, 140), variant(base, 20, 60, 100, 140, 170, 190)]
    other = [f"o{i}" for i in range(90)]
    texts = [*chain, other, variant(other, 50), [f"z{i}" for i in range(40)]]
    data = [(i, " ".join(words)) for i, words in enumerate(texts)]
    ids = {0: 30, 1: None, 2: 8, 3: 40, 4: 8, 5: 50, 6: None}  # the links of 0 to 3 run over a null id and a shared id
    want = {d: c for d, _, c, _ in by_hand_near(data)}
    assert len({want[i] for i in range(4)}) == 1 and want[4] == want[5] and want[6] == 6
    given = [(ids[i], text) for i, text in data]
    rng.shuffle(given)
    df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id) for r in near_dedup.decide(df).collect()), key=repr)
    assert got == sorted([(30, 8), (None, 8), (8, 8), (40, 8), (8, 8), (50, 8), (None, None)], key=repr)
    left = {(r.doc_id, r.text) for r in near_dedup.deduplicate(df).collect()}
    assert left == {(8, data[2][1]), (8, data[4][1]), (None, data[6][1])}


def test_members_of_one_component_never_meet(spark):
    """A large group torn by one outsider: the members meet by component, and only the pairs across are made."""
    rng = random.Random(5)
    sets = [(rep, sorted([*rng.sample(range(100), 97), 1000 + rep, 2000 + rep, 3000 + rep])) for rep in range(31)]
    df = spark.createDataFrame(sets, "rep bigint, items array<bigint>")
    members = spark.createDataFrame([(rep, 0 if rep < 30 else 30) for rep, _ in sets], "rep bigint, label bigint")
    edges = near_dedup.rest_edges(members, df, 85)
    assert {tuple(r) for r in edges.collect()} == {(rep, 30) for rep in range(30)}
    plan = edges._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [line for line in plan if "Join " in line and "_rep" in line]
    assert joins and not any("NOT (label" in line for line in joins)


def test_signatures_estimate_similarity():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(600)]
    other = [w if rng.random() < 0.95 else w + "x" for w in words]
    block = next(blocks(pa.array([" ".join(words), " ".join(other), "a b c"])))
    hashes, bounds = near_dedup.shingle_sets(block)
    a, b = set(hashes[bounds[0]: bounds[1]].tolist()), set(hashes[bounds[1]: bounds[2]].tolist())
    values = near_dedup.signatures(hashes, bounds)
    assert abs((values[0] == values[1]).mean() - len(a & b) / len(a | b)) < 0.12
    # one shingle fills every bin
    assert (values[2] == values[2][0]).all()


def line_chunks(lines):
    """The places of the chunks among lines that all have a word."""
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    r = [(x * 65_599 + y) % 4_294_967_291 for x, y in zip(h, h[1:])]
    return [k for k, x in enumerate(r) if k in (0, len(r) - 1) or x <= r[k - 1] or x <= r[k + 1]]


def by_hand_lines(data):
    seen, out = set(), {}
    for doc_id, text in sorted(data):
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if WHITE.sub("", x)]
        words, gone = [lines[i] for i in at], set()
        places = line_chunks(words)
        for k in places:
            for a, b, falls in ((k, k + 2, {k, k + 1}), (k - 1, k + 2, {k - 1}), (k, k + 3, {k + 2})):
                if a < 0 or b > len(words):
                    continue
                key = (a - k, *words[a:b])
                if key in seen:
                    gone |= falls
                seen.add(key)
        lost = {at[k] for k in gone}
        left = [x for i, x in enumerate(lines) if i not in lost]
        runs = sum(k - 1 not in gone for k in gone)
        out[doc_id] = (len(lines), len(places), runs, len(gone), hashlib.sha256("\n".join(left).encode()).hexdigest())
    return sorted(((d, *v) for d, v in out.items()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, rows, seed):
    rng = random.Random(seed)
    passages = [[f"p{k} line {i}" for i in range(rng.randint(2, 14))] for k in range(6)]
    data = []
    for d in range(120):
        lines = [f"own {d} {i}" for i in range(rng.randint(0, 9))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = rng.choice(passages)
        data.append((d, "\n".join(lines)))
    data.append((500, None))
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(6)
    assert rows(line_dedup.decide(df)) == by_hand_lines(data)


@pytest.mark.parametrize("length", [3, 4, 5, 9])
def test_a_shared_passage_leaves_one_copy(spark, rows, length):
    """Whatever stands around it, with blank lines inside it, and without a line of the rest."""
    passage = [f"shared {length} {i}" for i in range(length)]
    data, whole = [], []
    for d in range(20):
        before, after = [f"before {d} {i}" for i in range(d % 6)], [f"after {d} {i}" for i in range(d % 4)]
        inner = [x for line in passage for x in ([line, ""] if d % 3 == 0 else [line])]
        data.append((d, "\n".join([*before, *inner, *after])))
        whole.append("\n".join([*before, *(inner if d == 0 else [x for x in inner if not x]), *after]))
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    assert rows(line_dedup.clean(df)) == sorted(zip(range(20), whole), key=repr)
    assert rows(line_dedup.decide(df)) == by_hand_lines(data)


def test_lines_with_one_key_are_keyed_anew(spark, rows, monkeypatch):
    """Keys that clash are noticed by comparing bytes; the result is that of the bytes."""
    data = [(d, f"one {d}\ntwo {d}\nthree {d}") for d in range(8)] + [(9, "one 3\ntwo 3\nthree 3")]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    good, salts = line_dedup.line_key, []

    def clashing(line, salt=""):
        salts.append(salt)
        return good(line, salt) if salt else F.substring(line, 1, 3).cast("binary")

    monkeypatch.setattr(line_dedup, "line_key", clashing)
    assert rows(line_dedup.decide(df)) == by_hand_lines(data)
    assert "1" in salts


def test_line_cases(awkward):
    got = line_dedup.decide(awkward).collect()
    assert len(got) == awkward.count()
    cleaned = line_dedup.clean(awkward)
    assert cleaned.columns == awkward.columns
    by = defaultdict(set)
    for r in cleaned.collect():
        by[r.doc_id].add(r.text)
    assert len(by[1]) == 1 and by[3] == {None} and by[2] == {""} and by[7] == {"twice", "two texts of one id"}


def test_blocks_keep_slices_nulls_and_long_texts():
    array = pa.array(["drop", "a b", None, "", "é" * 5, "c"]).slice(1)
    found = list(blocks(array, 4))
    texts = [bytes(b.data[b.offsets[i]: b.offsets[i + 1]]).decode() for b in found for i in range(b.rows)]
    assert texts == ["a b", "", "", "é" * 5, "c"] and [b.lo for b in found][0] == 0
    assert list(blocks(pa.array([], pa.string()))) == []
    assert np.concatenate([np.diff(b.offsets) for b in found]).tolist() == [3, 0, 0, 10, 1]


def test_two_texts_of_one_id_in_one_component(spark):
    words = [f"w{i}" for i in range(120)]
    near = [*words[:60], "other", *words[61:]]
    df = spark.createDataFrame([(5, " ".join(words)), (5, " ".join(near)), (9, " ".join(near))], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.decide(df).collect())
    assert got == [(5, 5, True), (5, 5, True), (9, 5, False)]
    assert near_dedup.deduplicate(df).count() == 1


def test_digests_below_the_share_are_summed_before_they_meet(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 900).cast("string")).alias("text"))
    out = exact_dedup.decide(df)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("kept").count() == 900 and out.where("group_size not in (3, 4)").count() == 0
