"""Hand-made frames for the semantics that are easy to get wrong."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfline.functions import dates, maps, paths, text
from shelfline.operators import aggregates, columns, features, filters, joins, sampling, sets, timeseries, windows
from shelfline.operators.enrich import explode_labels, parse_reply, request_body
from shelfline.operators.keywords import reduce_keywords
from shelfline.plans.ordered import exact_quantiles, positions, running_sum
from shelfline.session import scratch_path
from shelfline.sources import files, sinks

KW = "keywords string, product_type string, impressions double"


def test_week_number_counts_from_the_first_monday(spark, rows):
    df = spark.createDataFrame([(2024, 3), (2023, 1), (2024, 1), (2019, 53)], "y int, w int")
    got = rows(df.select("y", "w", dates.week_start(F.col("y"), F.col("w")).alias("d")))
    assert got == sorted(
        ((y, w, dt.datetime.strptime(f"{y}-W{w}-1", "%Y-W%W-%w").date()) for y, w in [(2024, 3), (2023, 1), (2024, 1), (2019, 53)]),
        key=repr,
    )


def test_top_keeps_exactly_k_and_breaks_ties_by_name(spark, rows):
    df = spark.createDataFrame([("b", "X", 5.0), ("a", "X", 5.0), ("c", "X", 9.0), ("d", "X", 1.0)], KW)
    out = windows.top_per_group(df, ["product_type"], [F.desc("impressions"), F.asc("keywords")], 2)
    assert rows(out, "keywords", "rank") == [("a", 2), ("c", 1)]


def test_reduction_per_file_keeps_k_rows_of_each_file(spark, rows):
    data = [(f"k{i}{f}", "X", float(i), f) for f in ("f1", "f2") for i in range(1, 7)]
    df = spark.createDataFrame(data, KW + ", file string")
    overall = reduce_keywords(df, statistic="min", phrases=["sale"], k=2)
    per_file = reduce_keywords(df, statistic="min", phrases=["sale"], k=2, per_file="file")
    assert rows(overall, "keywords") == [("k6f1",), ("k6f2",)]
    assert rows(per_file, "keywords") == [("k5f1",), ("k5f2",), ("k6f1",), ("k6f2",)]


def test_stop_phrases_word_and_literal_form(spark, rows):
    words = ["pens on sale now", "sale pens", "wholesale pens", "Offer pens", "low Price pens", None, "two words"]
    df = spark.createDataFrame([(w,) for w in words], "k string")
    assert rows(filters.without_stop_phrases(df, "k")) == [("two words",), ("wholesale pens",), (None,)]
    literal = rows(filters.without_stop_phrases(df, "k", literal=True))
    assert literal == sorted([("sale pens",), ("wholesale pens",), ("Offer pens",), ("two words",), (None,)], key=repr)


def test_a_phrase_is_removed_wherever_it_stands(spark, rows):
    df = spark.createDataFrame([("pen - Genuine",), (" - Genuine",), ("pen",), ("pen - Genuine leather",), (None,)], "k string")
    assert rows(df.select(text.strip_phrase(F.col("k"), " - Genuine"))) == sorted([("",), ("pen",), ("pen",), ("pen leather",), (None,)], key=repr)


def test_null_keys_form_no_group(spark, rows):
    df = spark.createDataFrame([("a", None, 1.0), ("b", "X", 2.0)], KW)
    assert rows(aggregates.describe(df, ["product_type"], "impressions", ["n", "min"])) == [("X", 1, 2.0)]
    assert rows(aggregates.value_counts(df, "product_type")) == [("X", 1)]
    running = running_sum(df, ["product_type"], [F.asc("keywords")], "impressions", "cum")
    assert rows(running, "keywords", "cum") == [("b", 2.0)]


def test_null_keys_meet_in_the_null_safe_join(spark, rows):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, l int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, r int")
    assert rows(joins.join_null_safe(left, right, ["k"]), "l", "r") == [(1, 10), (2, 20)]
    assert rows(left.join(right, "k", "left"), "l", "r") == [(1, None), (2, 20)]


def test_describe_of_one_row_and_interpolated_quartiles(spark):
    df = spark.createDataFrame([("a", "one", 7.0)] + [(str(v), "four", float(v)) for v in (1, 2, 3, 10)], KW)
    got = {r["product_type"]: r for r in aggregates.describe(df, ["product_type"], "impressions").collect()}
    assert got["one"]["std"] == 7.0 and got["one"]["p75"] == 7.0
    assert got["four"]["p75"] == 4.75 and got["four"]["p25"] == 1.75 and got["four"]["p50"] == 2.5
    assert math.isclose(got["four"]["std"], 4.08248290463863)
    assert (got["four"]["n"], got["four"]["mean"], got["four"]["min"], got["four"]["max"]) == (4, 4.0, 1.0, 10.0)


def test_threshold_on_the_minimum_removes_nulls_only(spark, rows):
    df = spark.createDataFrame([("a", "X", 1.0), ("b", "X", 4.0), ("c", "X", None)], KW)
    assert rows(filters.above_group_statistic(df, ["product_type"], "impressions", "min"), "keywords") == [("a",), ("b",)]
    assert rows(filters.above_group_statistic(df, ["product_type"], "impressions", "mean"), "keywords") == [("b",)]


def test_sentinels_with_and_without_trim(spark, rows):
    df = spark.createDataFrame([("color, NA,NA,size",), (None,), ("[]",)], "reply string")
    split = df.select(F.explode_outer(F.split("reply", ",")).alias("a"))
    assert rows(filters.without_sentinels(split, "a")) == [("color",), ("size",)]
    assert rows(filters.without_sentinels(split, "a", trim=False)) == [(" NA",), ("color",), ("size",)]
    assert rows(explode_labels(df, "reply", "a"), "a") == [("color",), ("size",)]


@pytest.mark.parametrize(
    "reply, expected",
    [
        ("<res>a</res> <res>b</res>", "a,b"), ("x <res>a, b", "a, b"), ("nothing", ""),
        ("<RES>\na &amp; b</RES>", "a & b"), ("<res><item>a</item></res>", "a"),
    ],
)
def test_tag_text(spark, reply, expected):
    df = spark.createDataFrame([(reply,)], "r string")
    assert df.select(text.tag_text(F.col("r"), "res")).first()[0] == expected


def test_no_answers_are_null(spark, rows):
    df = spark.createDataFrame([("<c>NA</c>",), ("<c>NONE OF THE ABOVE</c>",), ("<c> x </c>",)], "r string")
    assert rows(df.select(parse_reply("r", {"c": "c"})["c"])) == [("x",), (None,), (None,)]


def test_one_large_keyword_empties_its_group_unless_the_crossing_row_is_kept(spark, rows):
    df = spark.createDataFrame([("big", "X", 60.0), ("small", "X", 40.0), ("y", "Y", 1.0), ("z", "Y", 1.0), ("w", "Y", 1.0)], KW)
    assert rows(windows.pareto_head(df, ["product_type"], "impressions", ["keywords"]), "keywords") == [("w",)]
    crossing = windows.pareto_head(df, ["product_type"], "impressions", ["keywords"], include_crossing=True)
    assert rows(crossing, "keywords") == [("big",), ("w",), ("y",)]


def test_running_weight_ends_in_the_plain_sum(spark, rows):
    df = spark.createDataFrame([("X", "color", s) for s in ("FAQ", "Other", "Refinement")], "c string, a string, s string")
    weights = {"FAQ": 0.2, "Customer_Search": 0.2, "Refinement": 0.2}
    out = windows.running_weight(df, ["c", "a"], "s", weights, 0.4).select("s", F.round("cum_weight", 6))
    assert rows(out) == [("FAQ", 0.2), ("Other", 0.6), ("Refinement", 0.8)]
    assert rows(windows.combine_channels(df.withColumn("w", F.lit(0.2)), ["c", "a"], "s", "w"), "streams", "cum_weight") == [
        ("FAQ, Other, Refinement", 0.6)
    ]


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v int")
    assert [r.id for r in sets.sorted_by(df, ["v"]).collect()] == [2, 3, 1]
    assert [r.id for r in sets.sorted_by(df, ["v"], descending=True).collect()] == [3, 2, 1]


def test_running_sum_is_null_at_a_null_and_goes_on(spark, rows):
    df = spark.createDataFrame([("a", "X", 1.0), ("b", "X", None), ("c", "X", 2.0)], KW)
    out = running_sum(df, ["product_type"], [F.asc("keywords")], "impressions", "cum")
    assert rows(out, "keywords", "cum") == [("a", 1.0), ("b", None), ("c", 3.0)]


def test_one_half_rounds_to_the_even_class_and_both_rates_are_named(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.9), (0, 0.8), (0, 0.1)], "y int, p double")
    r = features.classification_report(df, "y", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 1, 1, 1)
    assert math.isclose(r.column_0_right, 200 / 3) and r.column_1_right == 50.0
    assert math.isclose(r.row_0_right, 200 / 3) and r.row_1_right == 50.0 and r.overall == 60.0


def test_target_encoding_is_learnt_on_train_only(spark, rows):
    train = spark.createDataFrame([("a", 1.0)] * 40 + [("b", 3.0)] * 40, "brand string, y double")
    test = spark.createDataFrame([("a",), ("new",), (None,)], "brand string")
    got = dict(rows(features.target_encode(train, test, "brand", "y")))
    trust = 1 / (1 + math.exp(-(40 - 20) / 10))
    assert math.isclose(got["a"], 2.0 * (1 - trust) + trust) and got["new"] == 2.0 and got[None] == 2.0


def test_replace_in_place_reads_and_replaces_the_same_path(spark, rows):
    path = scratch_path(spark, "t")
    sinks.write_parquet(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), path)
    staged = sinks.replace_in_place(spark.read.parquet(path).groupBy("k").agg(F.sum("v").alias("v")), path)
    assert rows(spark.read.parquet(path)) == [("a", 3)] == rows(spark.read.parquet(staged))


def test_suffix_of_a_column_name_is_no_pattern(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["gv", "gv1", "gv.1"])
    assert columns.drop_suffixed(df, ".1").columns == ["gv", "gv1"]
    assert columns.columns_matching(df.drop("gv.1"), "gv.?").columns == ["gv", "gv1"]
    assert columns.columns_matching(df.select("gv", "gv1"), "gv", anchored=True).columns == ["gv"]


def test_top_and_bottom_with_k_above_the_row_count(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, v double")
    assert sets.top_and_bottom(df, "v", ["id"], 10).count() == 4


def test_containment_ignores_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "y int")
    assert tuple(sets.containment(a, "x", b, "y").first()) == (True, 0)
    assert tuple(sets.containment(b, "y", a, "x").first()) == (False, 1)


def test_all_given_request_parameters_are_sent(spark, rows):
    df = spark.createDataFrame([("model-chat", "hi"), ("model-text", "hi")], "m string, p string")
    body = request_body("m", "p", 20, temperature=0.1, top_k=8, stop=["x"])
    got = [r[0] for r in df.select(body).collect()]
    assert got == [
        '{"max_tokens":20,"messages":[{"role":"user","content":"hi"}],"temperature":0.1,"top_k":8,"stop_sequences":["x"]}',
        '{"prompt":"hi","max_tokens_to_sample":20,"temperature":0.1,"top_k":8,"stop_sequences":["x"]}',
    ]


def test_missing_column_policies(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    wanted = {"a": "string", "z": "double"}
    with pytest.raises(ValueError):
        columns.select_wanted(df, wanted)
    assert columns.select_wanted(df, wanted, "skip").columns == ["a"]
    assert tuple(columns.select_wanted(df, wanted, "null").first()) == ("1", None)
    with pytest.raises(ValueError):
        columns.first_columns(df, ["nope"])


def test_labels_match_after_normalisation_and_the_first_wins(spark, rows):
    left = spark.createDataFrame([("Gift Card",), ("gift-card",), ("GIFT_CARD",), ("other",)], "label string")
    right = spark.createDataFrame([("gift_card",), ("giftcard",)], "name string")
    assert rows(joins.join_normalised(left, right, "label", "name")) == sorted(
        [("Gift Card", "gift_card"), ("gift-card", "gift_card"), ("GIFT_CARD", "gift_card"), ("other", None)], key=repr
    )
    shown = left.select(text.display_label(F.lit("KING_OF-the Road"))).first()[0]
    assert shown == "King of the Road"


def test_paths(spark):
    df = spark.createDataFrame([("[A, B, C]",), ("[A]",)], "p string")
    got = [tuple(r) for r in df.select(paths.first_part(F.col("p")), paths.tail(F.col("p"))).collect()]
    assert got == [("A", "B, C"), ("A", None)]


def test_maps(spark):
    df = spark.sql("select map('A', 'x', 'b', null) m, map('b', '1', 'c', '2') d")
    got = df.select(
        maps.keys_cased(F.col("m")).alias("lower"),
        maps.with_defaults(F.col("m"), F.col("d")).alias("filled"),
        maps.keep_keys_matching(F.col("m"), "[a-z]").alias("small"),
        maps.drop_null_values(F.col("m")).alias("full"),
        maps.keep_keys(F.col("m"), ["A"]).alias("kept"),
        maps.with_key_copies(F.col("m"), prefix="p_").alias("copied"),
    ).first()
    assert got.lower == {"a": "x", "b": None}
    assert got.filled == {"A": "x", "b": None, "c": "2"}
    assert got.small == {"b": None} and got.full == {"A": "x"} and got.kept == {"A": "x"}
    assert got.copied == {"A": "x", "b": None, "p_A": "x", "p_b": None}


def test_typed_values(spark):
    values = ["true", " 12 ", "1.5", "1e3", "1d", "nan", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    kinds = [r[0] for r in df.select(maps.typed_rungs(F.col("v"))["kind"]).collect()]
    assert kinds == ["bool", "int", "float", "float", "text", "text", "text", None]


def test_measures(spark):
    df = spark.createDataFrame([("2.5 MB",), ("1kb",), ("3 furlongs",), ("x",), ("2 YB",)], "v string")
    assert [r[0] for r in df.select(text.measure(F.col("v"), text.SIZE_UNITS, upper=True)).collect()] == [
        2.5 * 1024**2, 1024.0, None, None, 2.0 * 1024**8
    ]
    spans = spark.createDataFrame([("2 hours",), ("3 mins",), ("4 d",), ("5 us",), ("6 seconds",), ("7 ns",)], "v string")
    got = [r[0] for r in spans.select(text.measure(F.col("v"), text.TIME_UNITS)).collect()]
    assert got == [7200.0, 180.0, 345600.0, 5 * 1e-6, 6.0, 7 * 1e-9]


def test_gap_fill_modes(spark, rows):
    d = lambda s: dt.date.fromisoformat(s)
    data = [("a", d("2024-01-01"), 2.0), ("a", d("2024-01-15"), 4.0), ("b", d("2024-01-22"), 1.0)]
    df = spark.createDataFrame(data, "item string, week date, y double")
    common = timeseries.gap_fill(df, ["item"], "week", "y")
    assert sorted(rows(common.where("item = 'a'"), "week", "y")) == [
        (d("2024-01-01"), 2.0), (d("2024-01-08"), 0.0), (d("2024-01-15"), 4.0), (d("2024-01-22"), 0.0)
    ]
    own = timeseries.gap_fill(df, ["item"], "week", "y", to_common_end=False, fill="mean")
    assert rows(own.where("item = 'a'"), "y") == [(2.0,), (3.0,), (4.0,)]


def test_csv_round_trip_keeps_line_ends_quotes_and_empty_text(spark, rows):
    path = scratch_path(spark, "c")
    df = spark.createDataFrame([(1, 'a "b"\nc,d'), (2, ""), (3, None), (4, "tab\tx")], "id int, t string")
    sinks.write_delimited(df, path)
    assert rows(files.read_delimited(spark, path, "id int, t string", line_ends_in_cells=True)) == rows(df)


def test_empty_input(spark):
    df = spark.createDataFrame([], KW)
    assert running_sum(df, ["product_type"], [F.asc("keywords")], "impressions", "c").count() == 0
    assert positions(df, [F.asc("keywords")], "i").count() == 0
    assert exact_quantiles(df, ["product_type"], "impressions", [0.5]).count() == 0
    assert sampling.sample_rows(df, ["keywords"], 1, n=3).count() == 0


def test_sample_edges(spark):
    df = spark.range(50)
    assert sampling.sample_rows(df, ["id"], 1, n=0).count() == 0
    assert sampling.sample_rows(df, ["id"], 1, n=500).count() == 50
    parts = {r.part: r["count"] for r in sampling.train_test(df, ["id"], 1, ceil_test=True).groupBy("part").count().collect()}
    assert parts == {"train": 35, "test": 15}


def test_readable_values_in_a_column_profile(spark):
    from shelfline.operators.profiles import column_types

    data = [("1", "2024-02-30", "0x1p3"), (" 22 ", "2024-02-28T10:00", "1e3"), (None, "2024-02-28x", "Infinity"), ("+3", "2024-02-28", "2f")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    got = {r.column_name: (r.n, r.n_null, r.n_int, r.n_float, r.n_date, r.narrowest) for r in column_types(df).collect()}
    assert got == {"a": (4, 1, 3, 3, 0, "int"), "b": (4, 0, 0, 0, 2, "text"), "c": (4, 0, 0, 1, 0, "text")}


def test_templates(spark):
    template = "<t>{title}</t> {title} {n}"
    assert text.template_fields(template) == ["title", "n"]
    df = spark.createDataFrame([("a{n}", None)], "title string, n int")
    assert df.select(text.render_template(template, title="title", n="n")).first()[0] == "<t>a{n}</t> a{n} "


def test_the_largest_running_total_is_not_the_sum(spark, rows):
    df = spark.createDataFrame([("a", "X", 5.0), ("b", "X", 3.0), ("c", "X", -4.0)], KW)
    running = running_sum(df, ["product_type"], [F.desc("impressions")], "impressions", "cum")
    assert rows(running.groupBy("product_type").agg(F.max("cum"))) == [("X", 8.0)]


def test_running_sums_of_whole_numbers_decimals_and_hot_groups(spark, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("g"), "id", (F.col("id") - 1500).alias("v"))
    for kind in ("bigint", "int", "double", "decimal(12,2)"):
        out = running_sum(df.withColumn("v", F.col("v").cast(kind)), ["g"], [F.asc("id")], "v", "cum").toPandas().sort_values(["g", "id"])
        assert (out["cum"].astype(float) == out.groupby("g")["v"].transform(lambda v: v.astype(float).cumsum())).all(), kind


def test_hash_cuts_are_refined_until_the_bucket_is_small(spark, monkeypatch):
    from shelfline.plans import ordered

    df = spark.range(5000)
    wide = {r.id for r in sampling.sample_rows(df, ["id"], 2, n=1234).collect()}
    monkeypatch.setattr(ordered, "RANKED_ROWS", 1)
    monkeypatch.setattr(ordered, "DIGITS", 1)
    assert {r.id for r in sampling.sample_rows(df, ["id"], 2, n=1234).collect()} == wide and len(wide) == 1234


@pytest.mark.parametrize("fraction", [0.3, 12.0, 40.0])
def test_draws_with_replacement_have_the_mean_of_the_fraction(spark, fraction):
    n = sampling.sample_with_replacement(spark.range(2000), ["id"], 7, fraction=fraction).count()
    assert abs(n / 2000 - fraction) < 4 * math.sqrt(fraction / 2000)


def test_exactly_n_draws_with_replacement(spark):
    drawn = sampling.sample_with_replacement(spark.range(10), ["id"], 7, n=500)
    assert drawn.count() == 500 and drawn.select("draw").distinct().count() == 500 and drawn.select("id").distinct().count() == 10
    assert sampling.sample_with_replacement(spark.range(0), ["id"], 7, n=5).count() == 0


def test_a_missing_feature_loses_no_row(spark):
    data = [(float(i), None if i % 9 == 0 else float(i % 7), int(i > 40)) for i in range(80)] + [(float("nan"), 1.0, 1), (None, None, 0)]
    df = spark.createDataFrame(data, "a double, b double, y int")
    model = features.train_classifier(df, ["a", "b"], "y", rounds=3)
    out = features.score(model, df)
    assert out.count() == 82 and out.where("p is null or isnan(p)").count() == 0 and out.columns == ["a", "b", "y", "p"]
    assert len(model.trees) == 3 and model.trees[0].feature[0] == 0


def test_an_ended_item_is_tested_on_its_own_last_weeks_and_stays_in_the_blend(spark):
    d = lambda i: dt.date(2024, 1, 1) + dt.timedelta(weeks=i)
    data = [("on", d(i), 1.0 + i) for i in range(40)] + [("ended", d(i), 2.0 * i) for i in range(20)] + [("one", d(3), 5.0)]
    df = spark.createDataFrame(data, "item string, week date, y double")
    held = timeseries.backtest(df, ["item"], "week", "y")
    assert {r.item for r in held.select("item").distinct().collect()} == {"on", "ended"}
    assert held.where("item = 'ended'").agg(F.max("week")).first()[0] == d(19)
    errors = timeseries.model_errors(timeseries.window_errors(held, ["item"], "y"), ["item"])
    blend = timeseries.ensemble_blend({"trend": timeseries.forecast_trend(df, ["item"], "week", "y", 2)}, errors, ["item"], "week")
    got = {(r.item, r.week): r.yhat for r in blend.collect()}
    assert len(got) == 6 and math.isclose(got[("ended", d(20))], 40.0) and math.isclose(got[("one", d(4))], 5.0)


def test_redelivered_null_keys_are_stored_once(spark, rows):
    from shelfline.streaming.master import merge_batch, read_master

    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    master = scratch_path(spark, "nulls")
    for batch in range(3):
        merge_batch(df, batch, master, ["a", "b"], df.schema)
    assert rows(read_master(spark, master)) == rows(df)


def test_prefixes_may_end_inside_an_element(spark, rows):
    roots = spark.createDataFrame([("AS",), ("ASIA, J",), ("EU",)], "root string")
    nodes = spark.createDataFrame([("ASIA, JAPAN",), ("ASIA",), ("A",), (None,)], "path string")
    assert rows(joins.leaves_under(roots, nodes, "root", "path"), "root", "path") == [("AS", "ASIA"), ("AS", "ASIA, JAPAN"), ("ASIA, J", "ASIA, JAPAN")]


def test_nested_defaults_and_flattening_at_any_depth(spark):
    from shelfline.functions import arrays

    df = spark.sql("""select map('a', map('b', map('c', '1')), 'n', null) m,
                             map('a', map('b', map('c', '0', 'd', '2'), 'e', map('f', '3')), 'z', map('y', map('x', '4'))) d,
                             array(array(array(1, 2), null), array(), array(array(3))) deep""")
    assert maps.map_levels(df.schema["m"].dataType) == 3
    got = df.select(maps.with_nested_defaults(F.col("m"), F.col("d"), 3)).first()[0]
    assert got == {"a": {"b": {"c": "1", "d": "2"}, "e": {"f": "3"}}, "n": None, "z": {"y": {"x": "4"}}}
    levels = arrays.array_levels(df.schema["deep"].dataType)
    assert df.select(arrays.flatten_all(F.col("deep"), levels)).first()[0] == [1, 2, 3]
    assert df.select(arrays.flatten_inner(F.col("deep"), levels)).first()[0] == [[1, 2], [], [3]]


def test_extremes_have_a_position_a_place_and_a_direction(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 9.0, None, 1.0, 9.0])], "id int, v double")
    out = sets.top_and_bottom(df, "v", ["id"], 2, position=[F.asc("id")])
    got = {(r.side, r.place): (r.id, r.position) for r in out.collect()}
    assert got == {("largest", 0): (1, 1), ("largest", 1): (4, 4), ("smallest", 0): (3, 3), ("smallest", 1): (0, 0)}
    rising = {r.place: r.v for r in sets.k_extremes(df, "v", ["id"], 3, "max", ascending=True).collect()}
    assert rising == {0: 5.0, 1: 9.0, 2: 9.0}


def test_combinations_are_distinct_random_and_bounded(spark):
    sides = [(spark.range(n).withColumnRenamed("id", c), [F.asc(c)]) for n, c in ((30, "a"), (7, "b"), (5, "c"))]
    some = joins.sample_combinations(sides, 100, 5)
    assert some.count() == 100 == some.distinct().count() and sorted(some.columns) == ["a", "b", "c"]
    every = joins.sample_combinations(sides, 1050, 5)
    assert every.distinct().count() == 1050
    with pytest.raises(ValueError):
        joins.sample_combinations(sides, 1051, 5)


def test_a_profile_by_sample_and_by_type(spark):
    from shelfline.operators.profiles import column_types

    df = spark.range(1000).select("id", (F.col("id") / 2).alias("d"), (F.col("id") % 2 == 0).alias("b"), F.lit("x").alias("t"))
    got = {r.column_name: r.narrowest for r in column_types(df).collect()}
    assert got == {"id": "int", "d": "float", "b": "bool", "t": "text"}
    assert {r.n for r in column_types(df, sample=37, keys=["id"]).collect()} == {37}
    assert 40 < column_types(df, ["id"], sample=0.1, keys=["id"]).first()["n"] < 170


def test_strategies_agree_with_their_definitions(spark):
    df = spark.createDataFrame([("a", 2.0, 5), ("a", 1.0, 4), ("a", 2.0, 6), ("a", None, 1), ("b", 7.0, 1)], "k string, v double, at int")
    got = {r.k: r for r in aggregates.by_strategies(df, ["k"], "v", "at").collect()}
    assert (got["a"]["sum"], got["a"]["first"], got["a"]["median"], got["a"]["mode"], got["a"]["min"], got["a"]["max"]) == (5.0, 1.0, 2.0, 2.0, 1.0, 2.0)
    assert math.isclose(got["a"]["average"], 5 / 3) and got["b"]["mode"] == 7.0


def test_an_unanswered_tag_is_passed_over(spark):
    df = spark.createDataFrame([("<c><item>NA</item></c><c><item>b</item></c>",), ("<c>a</c> <c>b</c>",), ("none",), (None,)], "r string")
    assert [r[0] for r in df.select(text.first_answer(F.col("r"), "c")).collect()] == ["b", "a", None, None]
