"""Encodings, scaling, the classifier and its evaluation."""

import datetime as dt

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.functions.text import text_counts
from shelfline.operators import features as M
from shelfline.operators.sampling import train_test
from shelfline.plans.ordered import cut_lineage
from shelfline.views import KW, SCORED, keyword_traffic, scored_labels


@query(
    "target_encode",
    """WITH tr AS (SELECT * FROM lineitem WHERE l_shipdate < DATE '1999-01-01'), prior AS (SELECT avg(l_quantity) AS p FROM tr),
            s AS (SELECT l_partkey, avg(l_quantity) AS m, 1 / (1 + exp(-(count(l_quantity) - 20.0) / 10.0)) AS w FROM tr GROUP BY 1)
       SELECT j.l_orderkey, j.l_linenumber, j.l_partkey, round(coalesce(p * (1 - w) + m * w, p), 6) AS encoded
       FROM lineitem j CROSS JOIN prior LEFT JOIN s USING (l_partkey) WHERE l_shipdate >= DATE '1999-01-01'""",
)
def _(t):
    # the older lines train, all later ones are encoded
    cut = F.lit(dt.date(1999, 1, 1))
    train = t.lineitem.where(F.col("l_shipdate") < cut).select("l_partkey", "l_quantity")
    test = t.lineitem.where(F.col("l_shipdate") >= cut).select("l_orderkey", "l_linenumber", "l_partkey")
    return M.target_encode(train, test, "l_partkey", "l_quantity").withColumn("encoded", F.round("encoded", 6))


@query(
    "one_hot",
    """SELECT event_id, CAST(event_type = 'click' AS INTEGER) AS event_type_click, CAST(event_type = 'error' AS INTEGER) AS event_type_error,
              CAST(event_type = 'purchase' AS INTEGER) AS event_type_purchase, CAST(event_type = 'signup' AS INTEGER) AS event_type_signup,
              CAST(event_type = 'view' AS INTEGER) AS event_type_view FROM events""",
)
def _(t):
    kinds = ["click", "error", "purchase", "signup", "view"]
    return M.one_hot(t.events.select("event_id", "event_type"), "event_type", kinds).drop("event_type")


@query("one_hot_long", "SELECT event_id, 'event_type_' || event_type AS feature, 1.0::DOUBLE AS value FROM events WHERE event_type IS NOT NULL")
def _(t):
    return M.indicator_rows(t.events, ["event_id"], "event_type")


@query(
    "min_max_scale",
    f"""WITH {KW}, a AS (SELECT *, min(impressions) OVER () AS lo, max(impressions) OVER () AS hi,
              min(impressions) OVER (PARTITION BY product_type) AS glo, max(impressions) OVER (PARTITION BY product_type) AS ghi FROM kw)
        SELECT keywords, product_type, stream, impressions, round((impressions - lo) / (hi - lo), 6) AS scaled,
               round((impressions - glo) / (ghi - glo), 6) AS scaled_in_group FROM a""",
)
def _(t):
    overall = M.min_max_scale(cut_lineage(keyword_traffic(t)), "impressions")
    both = M.min_max_scale(overall, "impressions", ["product_type"], "scaled_in_group")
    return both.withColumns({c: F.round(c, 6) for c in ("scaled", "scaled_in_group")})


FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_marks", "word_length", "is_en"]


def labelled_documents(t):
    """Numeric features of every labelled document, its quality label and its split. They are made before the join, which so deals out no texts."""
    counts = F.col("counts")
    documents = t.documents.select("doc_id", "n_chars", "lang", text_counts(F.col("text")).alias("counts")).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        counts.n_words.cast("double").alias("n_words"),
        counts.n_lines.cast("double").alias("n_lines"),
        counts.n_digits.cast("double").alias("n_digits"),
        counts.n_marks.cast("double").alias("n_marks"),
        (F.col("n_chars") / counts.n_words).alias("word_length"),
        (F.col("lang") == "en").cast("double").alias("is_en"),
    )
    rows = documents.join(t.labels.select("doc_id", "quality"), "doc_id").select("doc_id", "quality", *FEATURES)
    return train_test(cut_lineage(rows), ["doc_id"], 1729)


def _model(t):
    """Documents with their split, and a model of the train part. Each query trains its own."""
    rows = labelled_documents(t)
    return rows, M.train_classifier(rows.where("part = 'train'"), FEATURES, "quality")


# Trained trees are not SQL; tests/test_boosting.py holds splits, leaf values, scores and shares against brute force.
@query("train_classifier")
def _(t):
    return M.tree_nodes(_model(t)[1], t.labels)


@query("score_table")
def _(t):
    rows, model = _model(t)
    scored = M.score(model, rows.where("part = 'test'"))
    return scored.select("doc_id", "quality", "p", M.predicted_class(F.col("p")).alias("predicted"))


@query("feature_importance")
def _(t):
    return M.feature_importance(_model(t)[1], t.labels)


@query(
    "classification_report",
    f"""WITH {SCORED}, c AS (
          SELECT count(*) FILTER (WHERE observed = 0 AND p <= 0.5) AS tn, count(*) FILTER (WHERE observed = 0 AND p > 0.5) AS fp,
                 count(*) FILTER (WHERE observed = 1 AND p <= 0.5) AS fn, count(*) FILTER (WHERE observed = 1 AND p > 0.5) AS tp FROM scored)
        SELECT *, round((tp + tn) * 100.0 / (tp + tn + fp + fn), 6)::DOUBLE AS overall, round(tn * 100.0 / (tn + fn), 6)::DOUBLE AS column_0_right,
               round(tp * 100.0 / (tp + fp), 6)::DOUBLE AS column_1_right, round(tn * 100.0 / (tn + fp), 6)::DOUBLE AS row_0_right,
               round(tp * 100.0 / (tp + fn), 6)::DOUBLE AS row_1_right FROM c""",
)
def _(t):
    report = M.classification_report(scored_labels(t), "observed", "p")
    rates = ["overall", "column_0_right", "column_1_right", "row_0_right", "row_1_right"]
    return report.withColumns({c: F.round(c, 6) for c in rates})
