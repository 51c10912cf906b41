"""String, array, map, JSON and taxonomy work over table columns."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.functions import arrays, dates, maps, paths, text
from shelfline.operators.aggregates import join_texts
from shelfline.operators.columns import all_strings, conform_text_columns
from shelfline.operators.profiles import column_types, path_rollup
from shelfline.views import TAXO, taxonomy

TAGS_SQL = "|".join(text.DESCRIPTION_TAGS)


@query(
    "clean_literal_list",
    f"SELECT page_id, regexp_replace(html, '{TAGS_SQL}', '', 'g') AS html FROM pages",
)
def _(t):
    return t.pages.select("page_id", text.strip_literals(F.col("html"), text.DESCRIPTION_TAGS).alias("html"))


@query(
    "dots_to_underscores",
    """SELECT p_partkey, replace(lower(p_type), '.', '_') || '_' || lower(p_brand) AS attribute, p_name
       FROM part""",
)
def _(t):
    marker = F.when(F.col("p_size") > 25, ".standardized_values").otherwise("?standardized_values")
    dotted = t.part.select(
        "p_partkey",
        F.concat(F.lower("p_type"), F.lit("."), F.lower("p_brand"), marker).alias("attribute"),
        "p_name",
    )
    return conform_text_columns(dotted, text.conform_name)


@query(
    "strip_suffix_phrase",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN p_name || ' leather' ELSE p_name END AS p_name, replace(p_type, '/', '') AS channel FROM part""",
)
def _(t):
    # at the end of a name, and inside it
    marked = (
        F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" - Genuine leather")))
        .when(F.col("p_size") > 25, F.concat("p_name", F.lit(" - Genuine"))).otherwise(F.col("p_name"))
    )
    folder = F.concat("p_type", F.lit("/"))
    return t.part.select(
        "p_partkey",
        text.strip_phrase(marked, " - Genuine").alias("p_name"),
        text.strip_all(folder, ["/"]).alias("channel"),
    )


@query("number_from_text", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def _(t):
    return t.orders.select("o_orderkey", text.number_from_text(F.format_number("o_totalprice", 2)).alias("price"))


@query(
    "extract_tags",
    r"""SELECT page_id, replace(replace(regexp_extract(html, '(?is)<title>(.*?)(?:</title>|$)', 1), chr(10), ''),
               '&amp;', '&') AS title,
               len(regexp_extract_all(html, '(?is)<h1>(.*?)(?:</h1>|$)', 1)) AS n_heads FROM pages""",
)
def _(t):
    return t.pages.select(
        "page_id",
        text.tag_text(F.col("html"), "title").alias("title"),
        F.size(text.tag_values(F.col("html"), "h1")).cast("bigint").alias("n_heads"),
    )


@query(
    "split_explode",
    """SELECT doc_id, trim(unnest(string_split(text, ','))) AS part FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", F.explode(F.split("text", ",")).alias("part")).withColumn(
        "part", F.trim("part")
    )


BARE = "replace(replace(path, '[', ''), ']', '')"


@query(
    "path_first_element",
    f"""WITH {TAXO} SELECT node_key, string_split({BARE}, ', ')[2] AS root_node,
        '<item>' || string_split({BARE}, ', ')[2] || '</item>' AS root FROM taxo""",
)
def _(t):
    inside = F.regexp_replace("path", r"^\[World, ", "")
    root = paths.first_part(inside)
    return taxonomy(t).select("node_key", root.alias("root_node"), paths.as_item(root).alias("root"))


@query(
    "path_tail_join",
    f"""WITH {TAXO} SELECT node_key, nullif(array_to_string(string_split({BARE}, ', ')[3:], ', '), '') AS leaf_path
        FROM taxo""",
)
def _(t):
    inside = F.regexp_replace("path", r"^\[World, ", "")
    return taxonomy(t).select("node_key", paths.tail(inside).alias("leaf_path"))


URL_PARTS = r"string_split(rtrim(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), '/'), '/')"


@query(
    "taxonomy_rollup",
    f"""WITH p AS (SELECT {URL_PARTS} AS parts FROM pages),
             n AS (SELECT array_to_string(parts, '/') AS full_path, parts, unnest(range(1, len(parts) + 1)) AS depth FROM p),
             a AS (SELECT full_path, CAST(depth AS INTEGER) AS depth, array_to_string(parts[1:depth], '/') AS node FROM n),
             g AS (SELECT node, depth, count(*) AS n_rows, count(DISTINCT full_path) AS n_paths,
                          bool_or(full_path = node) AS is_path FROM a GROUP BY 1, 2)
        SELECT *, is_path AND n_paths > 1 AS is_inner_path FROM g""",
)
def _(t):
    bare = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    return path_rollup(t.pages, F.split(F.rtrim(bare, F.lit("/")), "/"), "/")


@query(
    "option_markup",
    """SELECT p_type, string_agg('<item>' || p_brand || '</item>', chr(10) ORDER BY '<item>' || p_brand || '</item>') AS options
       FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY 1""",
)
def _(t):
    marked = t.part.select("p_type", paths.as_item(F.col("p_brand")).alias("item"))
    return join_texts(marked, ["p_type"], "item", "\n", "options")


@query(
    "normalise_label",
    """SELECT o_orderkey, regexp_replace(lower(o_orderpriority), '[ _-]', '', 'g') AS label,
              CASE o_orderpriority WHEN '1-URGENT' THEN '1 Urgent' WHEN '2-HIGH' THEN '2 High'
                WHEN '3-MEDIUM' THEN '3 Medium' WHEN '4-NOT SPECIFIED' THEN '4 Not Specified'
                WHEN '5-LOW' THEN '5 Low' END AS shown,
              regexp_replace(lower(o_orderpriority), '[ /-]', '_', 'g') AS underscored
       FROM orders""",
)
def _(t):
    label = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        text.normalise_label(label).alias("label"),
        text.display_label(label).alias("shown"),
        text.underscore_label(label).alias("underscored"),
    )


@query(
    "collapse_repeats",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, ' {2,}', ' ', 'g'), '\n{2,}', chr(10), 'g') AS text
        FROM documents""",
)
def _(t):
    spaces = text.collapse_repeats(F.col("text"), " ")
    return t.documents.select("doc_id", text.collapse_repeats(spaces, "\n").alias("text"))


def _profile_sql(columns):
    parts = []
    for c in columns:
        v = f"CAST({c} AS VARCHAR)"
        parts.append(
            f"""SELECT '{c}' AS column_name, count(*) AS n, count(*) FILTER ({v} IS NULL) AS n_null,
              count(*) FILTER (lower(trim({v})) IN ('true', 'false')) AS n_bool,
              count(*) FILTER (regexp_matches({v}, '^\\s*[+-]?[0-9]+\\s*$') AND TRY_CAST({v} AS BIGINT) IS NOT NULL) AS n_int,
              count(*) FILTER (TRY_CAST({v} AS DOUBLE) IS NOT NULL) AS n_float,
              count(*) FILTER (TRY_CAST(substr({v}, 1, 10) AS DATE) IS NOT NULL AND contains({v}, '-')) AS n_date
            FROM src"""
        )
    return " UNION ALL ".join(parts)


PROFILED = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(
    "column_type_profile",
    f"""WITH src AS (SELECT {', '.join(PROFILED)} FROM lineitem), c AS ({_profile_sql(PROFILED)})
        SELECT *, CASE WHEN n = n_null THEN 'null' WHEN n_bool = n - n_null THEN 'bool'
          WHEN n_int = n - n_null THEN 'int' WHEN n_float = n - n_null THEN 'float'
          WHEN n_date = n - n_null THEN 'date' ELSE 'text' END AS narrowest FROM c""",
)
def _(t):
    # the typed columns answer from their type, the same columns as text from each value; both agree
    typed = t.lineitem.select(*PROFILED)
    as_text = all_strings(typed.select("l_linenumber", "l_discount", "l_returnflag", "l_shipdate"))
    from_text = column_types(as_text)
    return column_types(typed).join(from_text.select("column_name"), "column_name", "left_anti").unionByName(from_text)


@query(
    "array_flatten_any",
    r"""WITH n AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda l: list_transform(string_split(l, '. '),
                      lambda s: string_split(s, ' '))) AS nested FROM documents),
            f AS (SELECT doc_id, flatten(flatten(nested)) AS words, list_transform(nested, lambda l: flatten(l)) AS lines FROM n)
       SELECT doc_id, len(words) AS n_words, array_to_string(words, '|') AS words, len(lines) AS n_lines,
              array_to_string(list_transform(lines, lambda l: CAST(len(l) AS VARCHAR)), ',') AS words_per_line FROM f""",
)
def _(t):
    sentences = F.transform(F.split("text", "\n"), lambda line: F.transform(F.split(line, r"\. "), lambda s: F.split(s, " ")))
    nested = t.documents.select("doc_id", sentences.alias("nested"))
    levels = arrays.array_levels(nested.schema["nested"].dataType)
    flat = nested.select(
        "doc_id", arrays.flatten_all(F.col("nested"), levels).alias("words"), arrays.flatten_inner(F.col("nested"), levels).alias("lines"))
    return flat.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.array_join("words", "|").alias("words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.array_join(F.transform("lines", lambda x: F.size(x).cast("string")), ",").alias("words_per_line"),
    )


def _event_map():
    return F.map_concat(
        F.from_json("props", "map<string,string>"),
        F.create_map(
            F.lit("Event"), F.col("event_type"),
            F.lit("User"), F.col("user_id").cast("string"),
            F.lit("void"), F.lit(None).cast("string"),
        ),
    )


@query(
    "map_key_conform",
    """SELECT event_id,
              'EVENT=' || event_type || ';K=' || json_extract_string(props, '$.k') || ';USER=' || CAST(user_id AS VARCHAR) AS upper_keys,
              'event=' || upper(event_type) || ';event_x=' || upper(event_type) || ';user=' || CAST(user_id AS VARCHAR)
                || ';user_x=' || CAST(user_id AS VARCHAR) AS copied,
              'k=' || json_extract_string(props, '$.k') AS matched,
              CASE WHEN event_type IN ('click', 'view') THEN 'Event=' || event_type ELSE '' END AS valued
       FROM events""",
)
def _(t):
    # named step by step, so the JSON text is parsed once per row
    mapped = t.events.select("event_id", _event_map().alias("m"))
    filled = mapped.select("event_id", maps.drop_null_values(F.col("m")).alias("filled"))
    both = filled.withColumn("users", maps.drop_keys(maps.keys_cased(F.col("filled")), ["k"]))
    filled, users = F.col("filled"), F.col("users")
    return both.select(
        "event_id",
        maps.as_text(maps.keys_cased(filled, upper=True)).alias("upper_keys"),
        maps.as_text(maps.with_key_copies(maps.values_cased(users, upper=True), suffix="_x")).alias("copied"),
        maps.as_text(maps.keep_keys_matching(filled, "[a-k]")).alias("matched"),
        maps.as_text(maps.keep_values(filled, ["click", "view"])).alias("valued"),
    )


@query(
    "map_defaults_deep",
    """SELECT event_id, 'k=' || json_extract_string(props, '$.k') || ';unit=pct' AS flat,
              'k=' || json_extract_string(props, '$.k') || ';unit=pct' AS inner_props, 'name=' || event_type AS inner_event,
              'name=web' AS inner_source, 'kind=' || event_type || ';owner=ops' AS deepest
       FROM events""",
)
def _(t):
    props = F.from_json("props", "map<string,string>")
    defaults = F.create_map(F.lit("k"), F.lit("0"), F.lit("unit"), F.lit("pct"))
    named = lambda key, value: F.create_map(F.lit(key), value)
    inner = F.create_map(F.lit("props"), F.col("m"), F.lit("event"), named("name", F.col("event_type")), F.lit("tag"), named("kind", F.col("event_type")))
    inner_defaults = F.create_map(
        F.lit("props"), defaults, F.lit("source"), named("name", F.lit("web")),
        F.lit("tag"), F.create_map(F.lit("kind"), F.lit("none"), F.lit("owner"), F.lit("ops")),
    )
    parsed = t.events.select("event_id", "event_type", props.alias("m")).withColumn("given", named("all", inner))
    levels = maps.map_levels(parsed.schema["given"].dataType)
    deep = maps.with_nested_defaults(F.col("given"), named("all", inner_defaults), levels)
    at = lambda key: maps.as_text(F.try_element_at(F.try_element_at("deep", F.lit("all")), F.lit(key)))
    return parsed.withColumn("deep", deep).select(
        "event_id",
        maps.as_text(maps.with_defaults(F.col("m"), defaults)).alias("flat"),
        at("props").alias("inner_props"), at("event").alias("inner_event"), at("source").alias("inner_source"), at("tag").alias("deepest"),
    )


@query(
    "nested_get",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent
       FROM events""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.get_json_object("props", "$.k.inner.deep").alias("absent"),
    )


@query(
    "typed_values_from_text",
    """SELECT event_id, 'props' AS field, 'int' AS kind, NULL::BOOLEAN AS as_bool,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_int, NULL::DOUBLE AS as_float, NULL::VARCHAR AS as_text FROM events
       UNION ALL SELECT event_id, 'value', 'float', NULL, NULL, value, NULL FROM events
       UNION ALL SELECT event_id, 'large', 'bool', value > 100, NULL, NULL, NULL FROM events
       UNION ALL SELECT event_id, 'event_type', 'text', NULL, NULL, NULL, event_type FROM events""",
)
def _(t):
    fields = F.array(
        F.struct(F.lit("props").alias("field"), F.get_json_object("props", "$.k").alias("text")),
        F.struct(F.lit("value").alias("field"), F.col("value").cast("string").alias("text")),
        F.struct(F.lit("large").alias("field"), (F.col("value") > 100).cast("string").alias("text")),
        F.struct(F.lit("event_type").alias("field"), F.col("event_type").alias("text")),
    )
    long = t.events.select("event_id", F.inline(fields))
    rungs = maps.typed_rungs(F.col("text"))
    return long.select(
        "event_id", "field", *[c.alias(n) for n, c in rungs.items()],
        F.when(rungs["kind"] == "text", F.col("text")).alias("as_text"),
    )


@query(
    "row_fingerprint",
    """WITH f AS (SELECT doc_id, sha256('lang:' || length(lang) || '=' || lang || chr(10) || 'text:' || length(text) || '=' || text) AS fingerprint FROM documents)
       SELECT fingerprint, count(*) AS n_rows, min(doc_id) AS first_doc FROM f GROUP BY 1""",
)
def _(t):
    marked = t.documents.select("doc_id", text.fingerprint(["text", "lang"]).alias("fingerprint"))
    return marked.groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_doc")
    )


@query(
    "json_rows",
    """SELECT CAST(to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_brand': p_brand, 'p_type': p_type,
              'p_size': p_size, 'p_retailprice': p_retailprice}) AS VARCHAR) AS line FROM part""",
)
def _(t):
    return t.part.select(F.to_json(F.struct("*")).alias("line"))


@query(
    "pad_ids",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), (SELECT len(CAST(max(c_custkey) AS VARCHAR))::INTEGER FROM customer), '0') AS padded,
              c_name FROM customer""",
)
def _(t):
    width = t.customer.agg(F.length(F.max("c_custkey").cast("string"))).scalar()
    ids = t.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    return ids.select(F.lpad("id", width, F.lit("0")).alias("padded"), "c_name")


@query(
    "measure_to_base_unit",
    """SELECT p_partkey, CAST(p_size + 0.5 AS DOUBLE) * CASE p_type WHEN 'ECONOMY' THEN 1024 WHEN 'PROMO' THEN 1048576
                 WHEN 'LARGE' THEN 1125899906842624 WHEN 'SMALL' THEN 1 END::DOUBLE AS bytes,
              CAST(p_size AS DOUBLE) * CASE p_type WHEN 'LARGE' THEN 3600 WHEN 'PROMO' THEN 86400 WHEN 'SMALL' THEN 1 ELSE 60 END AS seconds
       FROM part""",
)
def _(t):
    by_type = lambda names, other: F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("p_type")], F.lit(other))
    unit = by_type({"ECONOMY": "KB", "PROMO": "mb", "LARGE": "PB", "SMALL": "B"}, "parsecs")
    size = F.concat((F.col("p_size") + 0.5).cast("string"), F.lit(" "), unit)
    span = F.concat(F.col("p_size").cast("string"), F.lit(" "), by_type({"LARGE": "hours", "PROMO": "d", "SMALL": "seconds"}, "mins"))
    return t.part.select(
        "p_partkey",
        text.measure(size, text.SIZE_UNITS, upper=True).alias("bytes"),
        text.measure(span, text.TIME_UNITS).alias("seconds"),
    )


@query(
    "parse_format_timestamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def _(t):
    written = F.when(F.col("event_type") == "view", F.unix_timestamp("ts").cast("string")).otherwise(
        F.col("ts").cast("string")
    )
    parsed = t.events.select("event_id", dates.timestamp_from_text(written).alias("at"))
    return parsed.select("event_id", dates.stamp_text("at").alias("stamp"), dates.date_text("at").alias("day"))
