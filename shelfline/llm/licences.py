"""License scan: an exact set-similarity join between text blocks and license templates.

A template is a fixed notice of k words; a block is any run of k consecutive words of a whole text (of all its words
where it has fewer), across line breaks. Both are sets of words. A block matches when it holds `share` of a template's
words and all of its names, the words that say which license it is. The join is exact and never compares all
blocks with all templates:

* The template words are ordered by how often the whole corpus holds them, rarest first.
* Prefix filter: a match needs `need` of the template's words, so it holds one of the first
  size - need + 1. Only stretches around such a word are emitted, and they meet templates
  by equi-join on prefix words.
* Length filter: the stretch holds at least `need` template words.
* Positional filter: from the shared word on, both sides must still have `need` words left.
* What is left is verified block by block on the whole sets.

The template side is a parameter of at most `MOST_TEMPLATE_WORDS` words, checked, so it is broadcast.

The base scan looks for phrases at consecutive words of the whole text.

Defined cases: null and empty texts have no words and no labels ("" and score 0); ties between templates
give both labels; rows that repeat id and text share one result; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import cut_lineage, whole_text
from shelfline.llm.textbuf import LOWER_VALUES, Block, blocks, prefix_sums, row_bounds, span_hashes, spans, word_hash
from shelfline.llm.textstats import TOKEN

# The phrases of the base scan with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Well-known public notices as (label, words that name the license, notice).
TEMPLATES = (
    ("apache-2", "apache 2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "apache 2",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "redistribution permitted",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "redistributions copyright",
     "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
     "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution."),
    ("cc-by-4", "creative attribution 4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4", "by nc 4", "Licensed under CC BY-NC 4.0"),
    ("gpl-3", "gnu general 3", "Licensed under the GNU General Public License, version 3"),
    ("gpl-3", "gnu general 3",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "permission fee",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
     "above copyright notice and this permission notice appear in all copies."),
    ("mit", "mit", "Released under the MIT License"),
    ("mit", "permission granted charge",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "permission granted charge sublicense",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
     "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mpl-2", "mozilla 2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
SHARE_PERCENT = 80
MOST_TEMPLATE_WORDS = 100_000


def template_words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass(frozen=True)
class Needles:
    """Hashes the tasks look for: template words by rank, which ranks are prefix words, and the phrases."""

    ordered: np.ndarray
    rank: np.ndarray
    prefix: np.ndarray
    reach: int
    phrases: tuple[tuple[int, ...], ...]


def _words(block: Block):
    starts, ends, rows = spans(block, TOKEN)
    return starts, rows, span_hashes(prefix_sums(block.data, LOWER_VALUES), starts, ends)


def _template_hits(rows, hashes, ordered: np.ndarray, rank: np.ndarray):
    """Every template word of a block of texts as (index of the word, rank), in text order."""
    if not len(ordered):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
    hit = np.flatnonzero(ordered[at] == hashes)
    return hit, rank[at[hit]]


def _stretches(rows, hit, rank, prefix: np.ndarray, reach: int):
    """Which hits stand within `reach` words of a prefix word of their text, and where a new stretch begins among them."""
    if not len(hit):
        return hit, rank, np.zeros(0, np.int64)
    far = 2 * reach + len(rows)
    last = np.maximum.accumulate(np.where(prefix[rank], hit, -far))
    coming = np.minimum.accumulate(np.where(prefix[rank], hit, 2 * far)[::-1])[::-1]
    same = lambda other: (other >= 0) & (other < len(rows)) & (rows[np.clip(other, 0, len(rows) - 1)] == rows[hit])
    near = ((hit - last < reach) & same(last)) | ((coming - hit < reach) & same(coming))
    hit, rank = hit[near], rank[near]
    begins = np.ones(len(hit), bool)
    begins[1:] = (rows[hit[1:]] != rows[hit[:-1]]) | (hit[1:] - hit[:-1] >= reach)
    return hit, rank, np.flatnonzero(begins)


def word_frequencies(docs: DataFrame, text_col: str, words: Sequence[str]) -> dict[str, int]:
    """How often the corpus holds each template word; one short row per word comes back."""
    hashes = np.array([word_hash(w.encode()) for w in words], np.uint64)
    order = np.argsort(hashes)
    ordered = hashes[order]

    def count(batches):
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, rows, found = _words(block)
                _, ids = _template_hits(rows, found, ordered, order)
                total += np.bincount(ids, minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total)], ["word", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {words[r["word"]]: r["n"] for r in found.collect()}


def _scan(needles: Needles):
    kind = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,found:array<int>,"
            "stretches:array<struct<number:int,hits:array<int>,at:array<int>,ranks:array<int>>>>")

    @F.arrow_udf(kind)
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for block in blocks(texts):
            n = block.rows
            starts, rows, hashes = _words(block)
            bounds = row_bounds(rows, n)
            count, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            found = np.zeros((n, len(needles.phrases)), bool)
            for p, phrase in enumerate(needles.phrases):
                k = len(phrase)
                if len(hashes) < k:
                    continue
                match = rows[: len(rows) - k + 1] == rows[k - 1:]
                for j, word in enumerate(phrase):
                    match &= hashes[j: len(hashes) - k + 1 + j] == np.uint64(word)
                where = np.flatnonzero(match)
                row, place = rows[where], where - bounds[rows[where]]
                count += np.bincount(row, minlength=n)
                np.minimum.at(first, row, place)
                np.maximum.at(last, row, place)
                found[row, p] = True
            hit, rank, edge = _stretches(rows, *_template_hits(rows, hashes, needles.ordered, needles.rank), needles.prefix, needles.reach)
            stretches: list[list] = [[] for _ in range(n)]
            for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(hit)]):
                mine = stretches[rows[hit[a]]]
                mine.append({"number": len(mine), "hits": np.unique(rank[a:b]).tolist(), "at": (hit[a:b] - bounds[rows[hit[a]]]).tolist(), "ranks": rank[a:b].tolist()})
            for r in range(n):
                out.append({
                    "n_words": int(bounds[r + 1] - bounds[r]), "n_base": int(count[r]),
                    "first_word": int(first[r]) if count[r] else None, "last_word": int(last[r]) if count[r] else None,
                    "found": np.flatnonzero(found[r]).tolist(), "stretches": stretches[r],
                })
        fields = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                  ("found", pa.list_(pa.int32())), ("stretches", pa.list_(pa.struct([("number", pa.int32()), *[(c, pa.list_(pa.int32())) for c in ("hits", "at", "ranks")]])))]
        return pa.array(out, pa.struct(fields))

    return scan


@F.arrow_udf(T.IntegerType())
def _most_shared(at: pa.Array, ranks: pa.Array, words: pa.Array, names: pa.Array, length: pa.Array) -> pa.Array:
    """The most template words that a block of `length` words with all names holds; null without such a block."""
    out = []
    for places, hits, wanted, named, k in zip(*(c.to_pylist() for c in (at, ranks, words, names, length))):
        wanted, named = set(wanted), set(named)
        inside = [(p, r) for p, r in zip(places, hits) if r in wanted]
        held, best, lo = Counter(), None, 0
        for place, rank in inside:
            held[rank] += 1
            while inside[lo][0] <= place - k:
                held[inside[lo][1]] -= 1
                if not held[inside[lo][1]]:
                    del held[inside[lo][1]]
                lo += 1
            if all(n in held for n in named):
                best = max(best or 0, len(held))
        out.append(best)
    return pa.array(out, pa.int32())


def decide(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str, str]] = TEMPLATES, share_percent: int = SHARE_PERCENT,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is 1 with a base phrase, else the largest share of a matched template.
    """
    spark = docs.sparkSession
    bodies = [(label, template_words(names), template_words(text)) for label, names, text in templates]
    vocabulary = sorted({w for _, _, words in bodies for w in words})
    if len(vocabulary) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"{len(vocabulary)} template words; the template side is broadcast and bounded by {MOST_TEMPLATE_WORDS}")
    seen = word_frequencies(docs, text_col, vocabulary)
    by_rarity = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(by_rarity)}
    whole, index = [], []
    for t, (label, names, words) in enumerate(bodies):
        ids = sorted({rank[w] for w in words})
        need = max(1, -(-len(ids) * share_percent // 100))
        whole.append((t, label, ids, [rank[w] for w in names], len(words), need))
        index += [(word, t, place, len(ids), need) for place, word in enumerate(ids[: len(ids) - need + 1])]
    hashes = np.array([word_hash(w.encode()) for w in by_rarity], np.uint64)
    order = np.argsort(hashes)
    prefix = np.zeros(len(by_rarity), bool)
    prefix[[word for word, *_ in index]] = True
    reach = max((len(words) for _, _, words in bodies), default=1)
    needles = Needles(hashes[order], order, prefix, reach, tuple(tuple(word_hash(w.encode()) for w in p.split()) for p in phrases))

    slim = cut_lineage(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(whole_text(text_col)).alias("_th"), _scan(needles)(F.col(text_col).cast("string")).alias("k"))
        .select("doc_id", "_th", "k.*")
    )
    prefixes = F.broadcast(spark.createDataFrame(index, "word int, template int, place int, size int, need int"))
    wholes = F.broadcast(spark.createDataFrame(whole, "template int, label string, words array<int>, names array<int>, length int, need int"))
    left = F.least(F.size("hits") - F.col("pos"), F.col("size") - F.col("place"))
    candidates = (
        slim.select("doc_id", "_th", F.explode("stretches").alias("b")).select("doc_id", "_th", "b.*")
        .select("*", F.posexplode("hits").alias("pos", "word"))
        .join(prefixes, "word")
        .where((F.size("hits") >= F.col("need")) & (left >= F.col("need")))
        .select("doc_id", "_th", "number", "at", "ranks", "template").dropDuplicates(["doc_id", "_th", "number", "template"])
    )
    matches = (
        candidates.join(wholes, "template").withColumn("_shared", _most_shared("at", "ranks", "words", "names", "length"))
        .where(F.col("_shared") >= F.col("need"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_mth"))
        .agg(F.collect_set("label").alias("_labels"), F.max(F.col("_shared") / F.size("words")).alias("_score"))
    )
    names = F.array(*[F.lit(label) for label in phrases.values()])
    base = F.array_distinct(F.array_sort(F.transform("found", lambda i: F.get(names, i))))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return (
        slim.drop("stretches").withColumn("_base", base)
        .join(matches, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_mth")), "left")
        .select(
            "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("_base")).alias("base_labels"),
            joined(F.concat("_base", F.coalesce("_labels", F.array().cast("array<string>")))).alias("labels"),
            F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
        )
    )


def oracle() -> str:
    """The same result by looking at every block of every text that holds enough words at all."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    words = lambda text: f"[{', '.join(quote(w) for w in sorted(set(template_words(text))))}]"
    rows = [f"({t}, {quote(label)}, {words(text)}, {words(names)}, {len(template_words(text))})" for t, (label, names, text) in enumerate(TEMPLATES)]
    phrases = [f"({quote(label)}, [{', '.join(quote(w) for w in p.split())}])" for p, label in PHRASES.items()]
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all({lower}, {word}) AS w FROM documents),
        p(label, words) AS (VALUES {', '.join(phrases)}),
        t(id, label, words, names, k) AS (VALUES {', '.join(rows)}),
        h AS (SELECT doc_id, label, i - 1 AS i FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d), p
              WHERE w[i : i + len(words) - 1] = words),
        b AS (SELECT doc_id, count(*) AS n, min(i) AS first_word, max(i) AS last_word, list_sort(list_distinct(list(label))) AS labels FROM h GROUP BY doc_id),
        c AS (SELECT doc_id, w, label, words, names, k FROM d, t WHERE 100 * len(list_intersect(w, words)) >= {SHARE_PERCENT} * len(words)),
        l AS (SELECT doc_id, label, words, names, w[i : i + k - 1] AS w
              FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - k + 1, 1))) AS i FROM c)),
        m AS (SELECT doc_id, label, len(list_intersect(w, words)) / len(words) AS share FROM l
              WHERE 100 * len(list_intersect(w, words)) >= {SHARE_PERCENT} * len(words) AND list_has_all(w, names)),
        x AS (SELECT doc_id, list(label) AS labels, max(share) AS score FROM m GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word,
               array_to_string(coalesce(b.labels, []), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(x.labels, [])))), ',') AS labels,
               CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(x.score, 0.0::DOUBLE) END AS score
        FROM d LEFT JOIN b USING (doc_id) LEFT JOIN x USING (doc_id)"""
