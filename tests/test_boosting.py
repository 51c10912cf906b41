"""The boosted trees against a plain row-by-row fit, and their scores against a walk of the node table."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.catalog import runnable
from shelfline.operators import boosting as B
from shelfline.operators import features as M


def plain_fit(x, y, rounds, depth, rate=0.2, weight=6.0, min_gain=4.0, ridge=1.0):
    """Exact greedy trees as nested tuples, every distinct value a cut; splits below `min_gain` are pruned from below."""
    margin = [0.0] * len(x)
    trees = []

    def leaf(rows, g, h):
        return ("leaf", -rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge))

    def quality(rows, g, h):
        return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + ridge)

    def grow(rows, g, h, left):
        if not left:
            return leaf(rows, g, h)
        best = None
        for f in range(len(x[0])):
            values = sorted({x[i][f] for i in range(len(x)) if not math.isnan(x[i][f])})
            for cut in values[:-1]:
                for missing_left in (False, True):
                    a = [i for i in rows if (missing_left if math.isnan(x[i][f]) else x[i][f] <= cut)]
                    inside = set(a)
                    b = [i for i in rows if i not in inside]
                    if min(sum(h[i] for i in a), sum(h[i] for i in b)) < weight:
                        continue
                    gain = quality(a, g, h) + quality(b, g, h) - quality(rows, g, h)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, cut, missing_left, a, b)
        if best is None or best[0] <= 1e-6:
            return leaf(rows, g, h)
        gain, f, cut, missing_left, a, b = best
        children = grow(a, g, h, left - 1), grow(b, g, h, left - 1)
        if gain < min_gain and all(c[0] == "leaf" for c in children):
            return leaf(rows, g, h)
        return ("split", f, cut, missing_left, gain, *children)

    def value(tree, row):
        while tree[0] == "split":
            v = row[tree[1]]
            tree = tree[5] if (tree[3] if math.isnan(v) else v <= tree[2]) else tree[6]
        return tree[1]

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]
        tree = grow(range(len(x)), g, h, depth)
        trees.append(tree)
        margin = [m + value(tree, row) for m, row in zip(margin, x)]
    return trees, margin


def same(tree, node, plain):
    if plain[0] == "leaf":
        return tree.feature[node] < 0 and math.isclose(tree.value[node], plain[1], abs_tol=1e-5)
    return (
        tree.feature[node] == plain[1] and math.isclose(tree.gain[node], plain[4], abs_tol=1e-3)
        and same(tree, 2 * node + 1, plain[5]) and same(tree, 2 * node + 2, plain[6])
    )


def data(n, seed, missing=True):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (n, 3)), 2)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.4, n)) > 0).astype(float)
    if missing:
        x[rng.random((n, 3)) < 0.1] = np.nan
    return x, y


@pytest.mark.parametrize("seed", [1, 2])
def test_splits_and_leaf_values_equal_a_plain_fit(spark, seed):
    x, y = data(220, seed)
    rows = [(*[None if math.isnan(v) else float(v) for v in r], int(b)) for r, b in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int").repartition(5)
    model = B.train(df, ["a", "b", "c"], "y", rounds=4, depth=3, share=1.0)
    plain, margin = plain_fit(x.tolist(), y.tolist(), 4, 3)
    assert all(same(t, 0, p) for t, p in zip(model.trees, plain)) and any(p[0] == "split" for p in plain)
    got = {r.asDict()["k"]: r.p for r in M.score(model, spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, a double, b double, c double, y int")).collect()}
    assert all(math.isclose(got[i], 1 / (1 + math.exp(-m)), abs_tol=1e-5) for i, m in enumerate(margin))


def test_child_weight_and_gain_bound_every_split(spark):
    x, y = data(400, 3)
    df = spark.createDataFrame([(*map(float, r), int(b)) for r, b in zip(x, y)], "a double, b double, c double, y int")
    model = B.train(df, ["a", "b", "c"], "y", rounds=12)
    table = {(r.tree, r.node): r for r in B.nodes(model, spark).collect()}
    assert any(r.feature for r in table.values())
    for (tree, node), r in table.items():
        assert (r.feature is None) != (r.value is None)
        if r.feature:
            children = [table[tree, 2 * node + 1], table[tree, 2 * node + 2]]
            assert all(c.weight >= 6 - 1e-6 for c in children)
            assert math.isclose(sum(c.weight for c in children), r.weight, rel_tol=1e-6)
            assert r.gain >= 4 or any(c.feature for c in children)
    shares = dict(B.importance(model))
    gains = {f: sum(r.gain for r in table.values() if r.feature == f) for f in "abc"}
    assert all(math.isclose(shares[f], gains[f] / sum(gains.values())) for f in "abc")


def test_the_model_does_not_depend_on_the_partitioning(spark):
    x, y = data(300, 4)
    df = spark.createDataFrame([(*map(float, r), int(b)) for r, b in zip(x, y)], "a double, b double, c double, y int")
    tables = [sorted(map(tuple, B.nodes(B.train(d, ["a", "b", "c"], "y", rounds=11), spark).collect()), key=repr) for d in (df.coalesce(1), df.repartition(7))]
    assert tables[0] == tables[1]


def test_edges(spark):
    shape = "a double, y int"
    even = B.score(B.train(spark.createDataFrame([], shape), ["a"], "y", rounds=2), spark.createDataFrame([(1.0, 1)], shape))
    assert even.first().p == 0.5
    one = B.train(spark.createDataFrame([(1.0, 1)] * 50 + [(None, None)], shape), ["a"], "y", rounds=3)
    assert all(t.feature[0] < 0 for t in one.trees) and B.score(one, spark.createDataFrame([(None, 0)], shape)).first().p > 0.5
    assert dict(B.importance(one)) == {"a": 0.0}


def walk(nodes, row):
    total = 0.0
    for tree in {t for t, _ in nodes}:
        at = 0
        while nodes[tree, at].feature:
            n = nodes[tree, at]
            v = row[n.feature]
            left = n.missing_left if v is None or math.isnan(v) else v <= n.cut
            at = 2 * at + 1 if left else 2 * at + 2
        total += nodes[tree, at].value
    return 1 / (1 + math.exp(-total))


def test_the_queries_return_the_values_of_the_model(spark):
    folder = "/root/testdata/sf0.01"  # fewer train rows hold no split of the least child weight
    from shelfline.catalog.features import FEATURES, labelled_documents
    from shelfline.views import Tables

    queries = runnable()
    nodes = {(r.tree, r.node): r for r in queries["train_classifier"](spark, folder).collect()}
    scored = {r.doc_id: r for r in queries["score_table"](spark, folder).collect()}
    held = {r.doc_id: r.asDict() for r in labelled_documents(Tables(spark, folder)).where("part = 'test'").collect()}
    assert len({t for t, _ in nodes}) == 50 and set(scored) == set(held) and scored
    for doc_id, r in scored.items():
        assert math.isclose(r.p, walk(nodes, held[doc_id]), abs_tol=1e-9) and r.predicted == int(r.p > 0.5) and r.quality == held[doc_id]["quality"]
    right = sum(r.predicted == r.quality for r in scored.values()) / len(scored)
    assert right > 0.8 and any(n.feature for n in nodes.values())
    shares = {r.feature: r.importance for r in queries["feature_importance"](spark, folder).collect()}
    gains = {f: sum(n.gain for n in nodes.values() if n.feature == f) for f in FEATURES}
    assert set(shares) == set(FEATURES) and all(math.isclose(shares[f], gains[f] / sum(gains.values())) for f in FEATURES)


def test_bins_travel_as_binary_cells():
    import numpy as np
    import pyarrow as pa

    from shelfline.operators import boosting

    bins = np.array([[0, -1, 255], [7, 300, 2], [-1, -1, -1], [5, 6, 7]], np.int16)
    packed = boosting._packed(bins)
    assert packed.type == pa.binary() and (boosting._unpacked(packed, 3) == bins).all()
    assert (boosting._unpacked(packed.slice(1, 2), 3) == bins[1:3]).all()
    assert boosting._unpacked(packed.slice(4), 3).shape == (0, 3)


def test_rows_travel_in_blocks_and_a_level_deals_out_nothing(spark, monkeypatch):
    x, y = data(2500, 5)
    df = spark.createDataFrame([(*map(float, r), int(b)) for r, b in zip(x, y)], "a double, b double, c double, y int")
    monkeypatch.setattr(B, "BLOCK", 1000)
    cuts = B.cut_points(df, ["a", "b", "c"])
    rows = B._block_rows(df.coalesce(1), ["a", "b", "c"], "y", cuts)
    blocks = sorted(rows.collect(), key=lambda r: -len(r.y))
    assert [len(r.y) // 8 for r in blocks] == [1000, 1000, 500] and [len(r.bins) // 6 for r in blocks] == [1000, 1000, 500]
    seen = []
    to_arrow = type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow", lambda self: seen.append(self._jdf.queryExecution().executedPlan().toString()) or to_arrow(self))
    model = B.train(df.repartition(7), ["a", "b", "c"], "y", rounds=2)
    assert 2 < len(seen) <= 10 and not any("Exchange" in plan or "Aggregate" in plan for plan in seen)
    # more sums than one place adds up are added by tasks, to the same model
    monkeypatch.setattr(B, "MERGED", 2)
    again = B.train(df.repartition(7), ["a", "b", "c"], "y", rounds=2)
    assert "Exchange" in seen[-1] and B.nodes(again, spark).collect() == B.nodes(model, spark).collect()


def test_deep_trees_end_where_a_walk_ends():
    rng = np.random.default_rng(6)
    bins = rng.integers(-1, 6, (300, 3)).astype(np.int16)
    for depth in (0, 1, 5, 8):
        tree = B.Tree(depth)
        inner = 2**depth - 1
        tree.feature[:inner] = rng.integers(-1, 3, inner)
        tree.cut[:inner], tree.missing_left[:inner] = rng.integers(0, 5, inner), rng.random(inner) < 0.5

        def end(row):
            node = 0
            while (f := tree.feature[node]) >= 0:
                node = 2 * node + (1 if (tree.missing_left[node] if row[f] == B.MISSING else row[f] <= tree.cut[node]) else 2)
            return node

        assert tree.node_of(np.ascontiguousarray(bins.T)).tolist() == [end(r) for r in bins]


def test_features_of_documents_are_those_of_the_patterns_and_texts_stay_where_they_are(spark, monkeypatch):
    from types import SimpleNamespace

    from shelfline.catalog import features as C
    from shelfline.functions import text as X

    texts = ["", " ", "\n", "a", " a  b\t\nc ", "é ü x y", "😀1 2\r\n\x0b\x0c3", "_a-b, 4٣!", "\x00\x1f\x7f", None, "x" * 3000 + " . ", "", "end\n"] * 3 + [None, ""]
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts)) if i % 5], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, t, None if i == 7 else len(t or ""), "en" if i % 2 else None) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, lang string")
    monkeypatch.setattr(X, "PIECE", 4)
    t = F.col("text")
    left = {"n_digits": "[0-9]", "n_marks": r"[^\w\s]"}
    wanted = docs.select(
        "doc_id", F.size(F.split(t, r"\s+")).alias("n_words"), F.size(F.split(t, "\n")).alias("n_lines"),
        *[(F.length(t) - F.length(F.regexp_replace(t, p, ""))).alias(c) for c, p in left.items()])
    got = docs.coalesce(1).select("doc_id", X.text_counts(t).alias("c")).select("doc_id", "c.*")
    assert got.orderBy("doc_id").collect() == wanted.orderBy("doc_id").collect()

    plans, cut = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = C.labelled_documents(SimpleNamespace(documents=docs, labels=labels)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == labels.count()
    above = plans[0].split("ArrowEvalPython")[0]
    assert "SortMergeJoin" in above and "Exchange" in above and "text" not in above.replace("text_counts", "")
