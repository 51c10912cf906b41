"""Quality rules: measures against brute force, and the cascade."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force(spark):
    rng = random.Random(7)
    data = []
    for i in range(150):
        n = rng.choice([0, 1, 2, 3, 5, 40, 200])
        words = [rng.choice(["a", "b", "c#", "é*", "<d>", f"w{rng.randint(0, 30)}"]) for _ in range(n)]
        text = "".join(w + rng.choice([" ", "  ", "\n", "\n\n", "\t", " \n "]) for w in words)
        data.append((i, text))
    data += [(900, None), (901, "a a a a"), (902, "x\nx\n\n \nx"), (903, "a b   c")]
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in Q.judge(df).collect()}
    for doc_id, text in data:
        n_words, word_chars, n_symbols, n_dup, n_repeat = by_hand(text)
        failed = n_words < 50 or 100 * n_repeat > 50 * n_words
        assert got[doc_id][:6] == (n_words, word_chars, n_symbols, n_dup, n_repeat, failed), text
        assert not (failed and got[doc_id][6])


def test_awkward_rows_and_empty_tables(awkward, nothing):
    out = Q.judge(awkward)
    assert out.count() == awkward.count() and out.where("n_words is null or kept is null").count() == 0
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert Q.judge(nothing).count() == 0


def test_the_order_of_the_rules_changes_no_verdict(spark):
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), "id", F.lit(" ")), 60).alias("text"))
    rules = [Q.Rule("odd", F.col("doc_id") % 2 == 1), Q.Rule("third", F.col("doc_id") % 3 == 0), Q.Rule("null", F.lit(None).cast("boolean"))]
    wanted = {i for i in range(60) if i % 2 == 0 and i % 3}
    for costs in ((1.0, 2.0, 3.0), (3.0, 2.0, 1.0)):
        guess = [(r.name, 0.5, c) for r, c in zip(rules, costs)]
        assert {r.doc_id for r in df.where(Q.cascade(rules, guess)).collect()} == wanted


def test_the_cascade_stops_at_the_first_rule_that_fires(spark):
    df = spark.range(10).select(F.col("id").alias("doc_id"))
    broken = Q.Rule("broken", F.raise_error(F.lit("evaluated")).cast("boolean"))
    cheap = Q.Rule("cheap", F.col("doc_id") >= 0)
    assert df.where(Q.cascade([broken, cheap], [("broken", 0.1, 9.0), ("cheap", 1.0, 0.1)])).count() == 0
    with pytest.raises(Exception, match="evaluated"):
        df.where(Q.cascade([broken, cheap], [("broken", 1.0, 0.1), ("cheap", 0.1, 9.0)])).count()


def test_rules_with_more_rejection_per_cost_come_first(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("t"), "id").alias("text"))
    none, most = Q.Rule("none", F.length("text") > 99), Q.Rule("most", F.col("id") % 10 > 0)
    found = {name: share for name, share, seconds in Q.estimate(df, [none, most], ["id"], rows=500) if seconds > 0}
    assert found["none"] == 0 and 0.8 < found["most"] < 0.99


def test_junk_goes_and_clean_documents_stay(documents, labels):
    judged = Q.judge(documents).join(labels, "doc_id").where("not base_failed")
    assert judged.where("quality = 1 and not kept").count() == 0
    assert judged.where("quality = 0 and kept").count() == 0
