"""Two-stage classification of items into a taxonomy: root first, then a leaf below it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.paths import as_item, first_part
from shelfline.functions.text import DESCRIPTION_TAGS, strip_literals
from shelfline.operators.aggregates import join_texts
from shelfline.operators.enrich import ClientFactory, infer_inputs, parse_reply
from shelfline.operators.joins import join_renamed, leaves_under
from shelfline.plans.ordered import cut_lineage

ROOT_TEMPLATE = "<options>\n{options}\n</options>\n<title>{title}</title>\n<description>{description}</description>"
LEAF_TEMPLATE = "<root>{root_category}</root>\n" + ROOT_TEMPLATE
TAGS = {"category": "category", "thinking": "thinking", "confidence": "confidence"}


def classify_root_then_leaf(
    items: DataFrame, nodes: DataFrame, client_factory: ClientFactory, root_prefix: str = "", **call
) -> DataFrame:
    """items(item, title, description), nodes(path, node_key, is_leaf) → category and node key.

    Both stages are one plan over all items: the options of a root are joined to its items
    where the model is called, there is no loop over roots. Equal items are sent once.
    """
    # the taxonomy is read four times below
    below = cut_lineage(nodes.withColumn("path", F.regexp_replace("path", rf"^\[{root_prefix}|\]$", "")))
    roots = below.select(first_part(F.col("path")).alias("root_category")).distinct()
    described = items.withColumn("description", strip_literals(F.col("description"), DESCRIPTION_TAGS))

    # one option list for all items, so it is a value of the plan and meets no row in a join
    every = roots.select(F.lit(0).alias("_all"), as_item(F.col("root_category")).alias("root"))
    listed = cut_lineage(join_texts(every, ["_all"], "root", "\n", "options")).agg(F.max("options")).scalar()
    replied = infer_inputs(
        described, ["title", "description"], ROOT_TEMPLATE, client_factory,
        columns={"options": listed, "title": "title", "description": "description"}, **call,
    )
    with_root = described_with(replied, parse_reply("generated_text", {"root_category": "category"}))

    inner = roots.withColumn("_prefix", F.concat("root_category", F.lit(", ")))
    leaves = leaves_under(inner, below.where("is_leaf").select("path", "node_key"), "_prefix", "path")
    options = leaves.select("root_category", as_item(F.col("path")).alias("leaf"))
    leaf_replied = infer_inputs(
        with_root, ["root_category", "title", "description"], LEAF_TEMPLATE, client_factory, options, ["root_category"], "leaf", **call)
    parsed = leaf_replied.select(
        "item", "title", "description", "root_category",
        *[c.alias(n) for n, c in parse_reply("generated_text", TAGS).items()],
    )
    keyed = below.select("path", "node_key")
    return join_renamed(parsed, keyed, {"category": "path"})


def described_with(replied: DataFrame, columns) -> DataFrame:
    """Keep the item columns and the parsed root; the first-stage reply is done with."""
    return cut_lineage(
        replied.select("item", "title", "description", *[c.alias(n) for n, c in columns.items()])
    )
