"""Bulk enrichment through a (stub) text model."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.catalog.stub_clients import attribute_tagger, option_picker
from shelfline.operators import enrich as E
from shelfline.operators.classify import classify_root_then_leaf
from shelfline.views import ITEMS, LLM_OUT, TAXO, WEIGHTS, attribute_weights, items_to_classify, model_replies, taxonomy

TEMPLATE = "<att>{options}</att>\n<inp>{inp}</inp>"
NO_WAIT = {"wait": 0.0, "jitter": 0.0}


def _calls(t):
    """As many tasks as there are cores call the model; the stub answers at once."""
    return {**NO_WAIT, "partitions": t.spark.sparkContext.defaultParallelism}


OPTIONS = f"{WEIGHTS}, opts AS (SELECT product_type, string_agg(sa_name, chr(10) ORDER BY sa_name) AS options FROM weights GROUP BY 1)"


def keyword_prompts(t):
    rows = t.part.select("p_partkey", "p_name", F.col("p_type").alias("product_type"))
    return E.build_prompts(rows, TEMPLATE, attribute_weights(t), ["product_type"], "sa_name", inp="p_name")


@query(
    "build_prompts",
    f"""WITH {OPTIONS} SELECT p_partkey, p_name, p_type AS product_type,
          '<att>' || coalesce(options, '') || '</att>' || chr(10) || '<inp>' || p_name || '</inp>' AS prompt
        FROM part LEFT JOIN opts ON p_type = product_type""",
)
def _(t):
    return keyword_prompts(t)


TAGGED = f"""{WEIGHTS}, words AS (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS word FROM part),
  found AS (SELECT p_partkey, string_agg(word, ', ' ORDER BY word) AS labels FROM words
            JOIN weights ON p_type = product_type AND word = sa_name GROUP BY 1)"""


@query(
    "batch_infer",
    f"""WITH {TAGGED} SELECT p_partkey, '<res>' || coalesce(labels, 'NA') || '</res>' AS generated_text
        FROM part LEFT JOIN found USING (p_partkey)""",
)
def _(t):
    # the rows are dealt out before their prompts are built
    calls = _calls(t)
    rows = t.part.select("p_partkey", "p_name", F.col("p_type").alias("product_type")).repartition(calls["partitions"])
    prompts = E.build_prompts(rows, TEMPLATE, attribute_weights(t), ["product_type"], "sa_name", inp="p_name")
    return E.batch_infer(prompts, "prompt", attribute_tagger, spread=False, **calls).select("p_partkey", "generated_text")


def asked_once(t):
    rows = t.part.select("p_partkey", "p_name", F.col("p_type").alias("product_type"))
    return E.infer_inputs(
        rows, ["product_type", "p_name"], TEMPLATE, attribute_tagger, attribute_weights(t), ["product_type"], "sa_name",
        columns={"inp": "p_name"}, **_calls(t),
    )


@query(
    "dedupe_before_infer",
    f"""WITH {TAGGED} SELECT p_partkey, p_type AS product_type, '<res>' || coalesce(labels, 'NA') || '</res>' AS generated_text
        FROM part LEFT JOIN found USING (p_partkey)""",
)
def _(t):
    return asked_once(t).select("p_partkey", "product_type", "generated_text")


@query(
    "label_keywords",
    f"""WITH {TAGGED} SELECT p_partkey, p_type AS product_type, word AS attributes FROM words
        JOIN weights ON p_type = product_type AND word = sa_name""",
)
def _(t):
    parsed = asked_once(t).withColumn("labels", E.parse_reply("generated_text", {"labels": "res"})["labels"])
    return E.explode_labels(parsed, "labels", "attributes").select("p_partkey", "product_type", "attributes")


@query(
    "request_params_by_model",
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'chat' ELSE 'plain' END AS format, text AS content,
              CASE WHEN role = 'user' THEN 200 END::INTEGER AS max_tokens, CASE WHEN role <> 'user' THEN 200 END::INTEGER AS max_sampled,
              0.1::DOUBLE AS temperature, 8::INTEGER AS top_k, CASE WHEN role = 'user' THEN 'label the text' END AS system
       FROM conversations""",
)
def _(t):
    model = F.when(F.col("role") == "user", "model-chat-large").otherwise("model-text-small")
    body = E.request_body("model", "text", 200, temperature=0.1, top_k=8, system="label the text")
    sent = t.conversations.withColumn("model", model).select("conv_id", "turn", body.alias("body"))

    def field(path):
        return F.get_json_object("body", path)

    return sent.select(
        "conv_id", "turn",
        F.when(field("$.messages").isNotNull(), "chat").otherwise("plain").alias("format"),
        F.coalesce(field("$.messages[0].content"), field("$.prompt")).alias("content"),
        field("$.max_tokens").cast("int").alias("max_tokens"),
        field("$.max_tokens_to_sample").cast("int").alias("max_sampled"),
        field("$.temperature").cast("double").alias("temperature"),
        field("$.top_k").cast("int").alias("top_k"),
        field("$.system").alias("system"),
    )


@query(
    "parse_outputs",
    f"""WITH {LLM_OUT}, d AS (SELECT doc_id AS id, lang, source FROM documents)
        SELECT id, CASE lang WHEN 'de' THEN NULL WHEN 'es' THEN source || ',NA' ELSE source END AS category,
               'written in ' || lang || ' & taken from ' || source AS thinking,
               CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN 'low' ELSE 'high' END AS confidence
        FROM llm_out JOIN d USING (id)""",
)
def _(t):
    tags = {"category": "category", "thinking": "thinking", "confidence": "confidence"}
    return model_replies(t).select("id", *[c.alias(n) for n, c in E.parse_reply("output", tags).items()])


@query(
    "classify_root_then_leaf",
    f"""WITH {TAXO}, {ITEMS},
        roots AS (SELECT list(r ORDER BY r) AS rs FROM (SELECT DISTINCT r_name AS r FROM leafs)),
        leaves AS (SELECT r_name AS root_category, list(p ORDER BY p) AS ps FROM
                   (SELECT r_name, r_name || ', ' || n_name || ', ' || c_mktsegment AS p FROM leafs) GROUP BY 1),
        said AS (SELECT item, length(title) + length(coalesce(description, fallback)) AS n FROM items),
        first_stage AS (SELECT item, n, rs[n % len(rs) + 1] AS root_category FROM said, roots),
        second_stage AS (SELECT item, root_category, ps[n % len(ps) + 1] AS category, len(ps) AS k
                         FROM first_stage JOIN leaves USING (root_category))
        SELECT item, root_category, category, k || ' options' AS thinking, 'high' AS confidence, node_key
        FROM second_stage LEFT JOIN taxo ON path = '[World, ' || category || ']'""",
)
def _(t):
    items = items_to_classify(t).select("item", "title", F.coalesce("description", "fallback").alias("description"))
    out = classify_root_then_leaf(items, taxonomy(t), option_picker, root_prefix="World, ", **_calls(t))
    return out.select("item", "root_category", "category", "thinking", "confidence", "node_key")
