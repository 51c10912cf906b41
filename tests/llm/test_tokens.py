"""Edit-aware counts against full encodings."""

import random

from pyspark.sql import functions as F

from shelfline.llm import token_counts as T

TEXTS = [
    "", " ", "a", "  a b  c ", "a" * 2000, " ".join("ab" for _ in range(1500)), "x\n\n y " * 300, "don't 's we'll " * 200,
    "\x1c \x1c a b" * 150, "é à  b " * 250, "日本語 テキスト " * 120, "12345 6 78 " * 200,
]


def full(text):
    return len(T.encoder(T.RANKS).encode_ordinary(text))


def test_leaves_add_up_to_the_whole():
    for size in (2, 16, 512):
        for text in TEXTS:
            leaves = T.cut_leaves(text, size)
            assert "".join(leaves) == text and sum(map(full, leaves)) == full(text)


def test_edits_give_the_count_of_the_edited_text():
    rng = random.Random(5)
    encoded = total = 0
    for size in (3, 64, 512):
        for text in TEXTS:
            leaves = T.cut_leaves(text, size)
            chars, tokens = T.heap([len(x) for x in leaves]), T.heap([full(x) for x in leaves])
            for _ in range(4):
                edits = []
                for _ in range(rng.randint(1, 4)):
                    a = rng.randint(0, len(text) + 3)
                    edits.append({"start": a, "stop": a + rng.choice([-1, 0, 1, 2, 5, 60]), "replacement": rng.choice([None, "", " ", "x", " x", "x ", "\n", "12 34", "'s"])})
                merged = T.merged_edits(edits, len(text))
                now = list(tokens)
                runs = T.touched_runs(text, chars, merged)
                for first, last, body in runs:
                    T.set_leaf(now, first, full(body))
                    for leaf in range(first + 1, last + 1):
                        T.set_leaf(now, leaf, 0)
                assert now[1] == full(T.edited_text(text, merged)), (size, text[:40], merged)
                encoded += sum(last - first + 1 for first, last, _ in runs)
                total += len(leaves)
    assert encoded < 0.2 * total  # most leaves are never touched


def test_a_leaf_is_found_by_character():
    chars = T.heap([3, 0, 2, 4, 1])
    assert [T.find_leaf(chars, p)[0] for p in range(11)] == [0, 0, 0, 2, 2, 3, 3, 3, 3, 4, 4]


def test_query_equals_full_encodings(documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    got = T.decide(documents.repartition(6)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.doc_id]
        assert (r.n_tokens, r.n_tokens_edited, r.n_edits) == (full(text), full(T.MASKED.sub(T.MASK, text)), len(T.MASKED.findall(text)))
        assert r.encoded_leaves <= r.n_leaves


def test_given_edits_and_awkward_rows(spark, awkward, nothing):
    df = spark.createDataFrame([(1, "one two", [(0, 3, "three")]), (2, "one two", None), (3, None, [(0, 5, "x y")]), (4, "a", [(9, 12, " b")])],
                               "doc_id bigint, text string, e array<struct<start:bigint,stop:bigint,replacement:string>>")
    out = df.withColumn("t", T.build_tree(F.col("text"))).withColumn("c", T.apply_edits(F.col("text"), F.col("t"), F.col("e")))
    got = {r.doc_id: r.c.tokens for r in out.collect()}
    assert got == {1: full("three two"), 2: full("one two"), 3: full("x y"), 4: full("a b")}
    counted = T.decide(awkward)
    assert counted.count() == awkward.count() and counted.where("n_tokens is null").count() == 0
    assert {r.n_tokens for r in counted.where("doc_id in (2, 3)").collect()} == {0}
    assert T.decide(nothing).count() == 0


def test_edits_follow_each_other(spark):
    rng = random.Random(8)
    rows = []
    for i, text in enumerate([*TEXTS, None, "word " * 3000]):
        many = [[(rng.randint(0, 4000), 0, rng.choice(["x", " y ", "", None, "12 34", " z" * 900])) for _ in range(rng.randint(0, 3))] for _ in range(3)]
        rows.append((i, text, *[[(a, a + rng.choice([0, 1, 40, 900]), r) for a, _, r in edits] for edits in many]))
    kind = "array<struct<start:bigint,stop:bigint,replacement:string>>"
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, e0 {kind}, e1 {kind}, e2 {kind}")
    step = df.select("doc_id", "e0", "e1", "e2", F.struct("text", T.build_tree(F.col("text")).alias("tree")).alias("s"))
    for k in range(3):
        step = step.withColumn("s", T.edit_tree(F.col("s.text"), F.col("s.tree"), F.col(f"e{k}")))
    for r in step.collect():
        body = rows[r.doc_id][1] or ""
        for edits in rows[r.doc_id][2:]:
            body = T.edited_text(body, T.merged_edits([dict(zip(("start", "stop", "replacement"), e)) for e in edits], len(body)))
        assert (r.s.text or "") == body and r.s.tree.tokens[1] == full(body) and r.s.tree.chars[1] == len(body)
        width = len(r.s.tree.chars) // 2
        leaves = [c for c in r.s.tree.chars[width:] if c]
        assert not body or max(leaves) <= max(len(x) for x in T.cut_leaves(body)) + 3 * T.LEAF_CHARS or " " not in body
