"""Trees, calibration and the two classifiers."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline.llm import labelled, quality_model, toxicity
from shelfline.llm.boosted import isotonic, train
from shelfline.llm.textbuf import blocks
from shelfline.llm.textstats import quality_features, toxicity_features

SF = "/root/testdata/sf0.01"


def one_by_one(model, row):
    """A tree walk per row and tree, as a check of the flattened one."""
    total = model.base
    for feature, limit, leaf in zip(model.feature, model.limit, model.leaf):
        node = 0
        for _ in range(model.depth):
            node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
        total += leaf[node - len(feature)]
    return total


def test_trees_learn_and_the_flattened_walk_equals_the_plain_one():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    model = train(x[:600], y[:600], trees=40)
    assert np.allclose(model.raw(x[:50]), [one_by_one(model, r) for r in x[:50]])
    assert ((model.probability(x[600:]) > 0.5) == (y[600:] > 0.5)).mean() > 0.93


def test_trees_without_rows_or_with_one_class():
    assert train(np.zeros((0, 3)), np.zeros(0)).probability(np.ones((2, 3))).tolist() == [0.5, 0.5]
    sure = train(np.ones((50, 2)), np.ones(50)).probability(np.ones((1, 2)))[0]
    assert sure > 0.9


def test_isotonic_rises_and_equals_the_least_squares_fit():
    rng = np.random.default_rng(5)
    score = np.sort(rng.random(60))
    y = (rng.random(60) < score).astype(float)
    fitted = isotonic(score, y, prior_rows=0.0)
    assert (np.diff(fitted.value) >= 0).all()
    # brute force: the max-min formula of isotonic regression
    want = [max(min(y[a: b + 1].mean() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    pools = {round(float(w), 12) for w in want}
    assert {round(float(v), 12) for v in fitted.value} == pools
    assert isotonic(np.zeros(0), np.zeros(0))(np.array([0.2]))[0] == 0.2


def test_the_held_out_fold_is_crc32_of_the_id(spark):
    df = spark.range(500).select("id", labelled.held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in df.collect())
    assert spark.range(1).select(labelled.held_out(F.lit(None).cast("bigint"))).first()[0] is False


def test_features_do_not_depend_on_the_block():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["You", "idiot!", "the", "1d1ot", "#x", "Añb", "a\nb"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    array = pa.array([*texts, None, ""])
    learnt = np.sort(np.array([1, 2, 3], np.uint64))
    for features in (quality_features, lambda b: toxicity_features(b, learnt)):
        small = np.concatenate([features(b) for b in blocks(array, 50)])
        large = np.concatenate([features(b) for b in blocks(array)])
        assert small.shape == large.shape and np.allclose(small, large) and np.isfinite(large).all()


def test_toxicity_features_see_what_they_should():
    texts = ["you are an idiot", "the weather is nice", "an 1d1ot", "IDIOT! MORON!", "far idiot a b c d e f g you"]
    block = next(blocks(pa.array(texts)))
    x = toxicity_features(block, np.zeros(0, np.uint64))
    insults, near, loud, hidden = x[:, 1], x[:, 9], x[:, 11], x[:, 18]
    assert insults.tolist() == [1, 0, 0, 2, 1] and (near > 0).tolist() == [True, False, False, False, False]
    assert (loud > 0).tolist() == [False, False, False, True, False] and hidden.tolist() == [0, 0, 1, 0, 0]


@pytest.mark.parametrize("decide", [quality_model.decide, toxicity.decide])
def test_awkward_rows_empty_tables_and_missing_labels(spark, awkward, nothing, labels, decide):
    out = decide(awkward, labels)
    assert out.count() == awkward.count() and out.where("score is null or not score between 0 and 1").count() == 0
    assert decide(nothing, labels).count() == 0
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in decide(awkward, none).collect()} == {0.5}
    assert {r.score for r in decide(awkward, none.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("decide, label, least", [(quality_model.decide, "quality", 0.95), (toxicity.decide, "toxic", 0.9)])
def test_held_out_accuracy_and_reruns(spark, decide, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    out = decide(docs, labels)
    first = {(r.doc_id, r.score) for r in out.collect()}
    held = out.where("held_out").join(labels, "doc_id")
    right = held.where(F.col("predicted") == F.col(label)).count() / held.count()
    assert right >= least
    again = decide(docs.repartition(7), labels.repartition(3))
    assert {(r.doc_id, r.score) for r in again.collect()} == first


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, r.score) for r in quality_model.decide(docs, part).collect()) for part in (labels, flipped))
    assert one == two


def test_keep_good_keeps_all_columns(awkward, labels):
    assert quality_model.keep_good(awkward, labels, limit=0.0).columns == awkward.columns
    assert quality_model.keep_good(awkward, labels, limit=0.0).count() == awkward.count()
    assert quality_model.keep_good(awkward, labels, limit=1.01).count() == 0


def test_training_rows_are_bounded_where_one_id_has_many_rows(spark):
    """Rows of the same id and text are one; an id of many texts brings no more rows than the sample may have."""
    labels = spark.range(1, 101).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    hot = next(i for i in range(1, 101) if zlib.crc32(str(i).encode()) % 5)
    rows = [(i, f"text {i}") for i in range(1, 101) for _ in range(2)] + [(hot, f"another text {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r._id, r.text) for r in labelled.training_texts(docs, labels, "quality", rows=400).collect()]
    assert len(got) == len(set(got)) and 250 < len(got) < 550
    small = labelled.training_texts(docs.where("text like 'text %'"), labels, "quality", rows=400)
    assert small.count() == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(1, 101))
