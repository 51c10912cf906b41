"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from shelfline.llm import (
    centroids, exact_dedup, licences, line_dedup, mixing, near_dedup, pieces, quality_model, quality_rules, substring_dedup,
    token_alignment, token_counts, toxicity,
)
from shelfline.llm.common import table
from shelfline.llm.registry import QUERIES, SQL, query  # noqa: F401


@query(
    "op1_line_dedup",
    r"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
             l AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM d)),
             w AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
                          CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
             r AS (SELECT doc_id, k, lag(line) OVER o AS a, line AS b, lead(line) OVER o AS c, lead(line, 2) OVER o AS d,
                          (h * 65599 + lead(h) OVER o) % 4294967291 AS r FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
             p AS (SELECT * FROM (SELECT *, r <= coalesce(lag(r) OVER o, r) OR r <= coalesce(lead(r) OVER o, r) AS opens FROM r
                   WINDOW o AS (PARTITION BY doc_id ORDER BY k)) WHERE opens),
             f AS (SELECT doc_id, k, row_number() OVER (PARTITION BY b, c ORDER BY doc_id, k) > 1 AS late,
                          a IS NOT NULL AND row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) > 1 AS late_left,
                          d IS NOT NULL AND row_number() OVER (PARTITION BY b, c, d ORDER BY doc_id, k) > 1 AS late_right FROM p),
             g AS (SELECT doc_id, k FROM f WHERE late UNION SELECT doc_id, k + 1 FROM f WHERE late
                   UNION SELECT doc_id, k - 1 FROM f WHERE late_left UNION SELECT doc_id, k + 2 FROM f WHERE late_right),
             t AS (SELECT l.doc_id, count(*) AS n_lines, count(g.k) AS removed_lines,
                          sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.k IS NULL), '')) AS text_sha256
                   FROM l LEFT JOIN w USING (doc_id, i) LEFT JOIN g ON g.doc_id = w.doc_id AND g.k = w.k GROUP BY l.doc_id),
             n AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id),
             m AS (SELECT doc_id, count(*) AS n FROM g WHERE NOT EXISTS (FROM g x WHERE x.doc_id = g.doc_id AND x.k = g.k - 1) GROUP BY doc_id)
        SELECT t.doc_id, n_lines, coalesce(n.n, 0) AS n_chunks, coalesce(m.n, 0) AS removed_chunks, removed_lines, text_sha256
        FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN m ON m.doc_id = t.doc_id""",
)
def _(spark, sf_dir):
    return line_dedup.decide(table(spark, sf_dir, "documents"))


@query("op2_entropy_mixing")
def _(spark, sf_dir):
    return mixing.decide(table(spark, sf_dir, "documents"))


@query(
    "op3_quality_rules",
    r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
                   FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)),
             v AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1)
                   GROUP BY doc_id),
             l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
             m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                          CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                          CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                          CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                          CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words,
                          len(regexp_extract_all(t, '!!')) AS shouts, length(t) AS chars, len(ls) AS n_lines,
                          len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) AS same_as_before
                   FROM d JOIN l USING (doc_id) LEFT JOIN v USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 15 * n_words
                    OR 100 * shouts > 15 * n_words OR chars > 30 * n_words OR 100 * same_as_before > 20 * n_words
                    OR 100 * n_dup_lines > 40 * n_lines) AS kept FROM m""",
)
def _(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def _(spark, sf_dir):
    return quality_model.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_sampled_pieces")
def _(spark, sf_dir):
    return pieces.decide(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def _(spark, sf_dir):
    return toxicity.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_license_scan", licences.oracle())
def _(spark, sf_dir):
    return licences.decide(table(spark, sf_dir, "documents"))


@query(
    "op8_minhash_near_dedup",
    r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
             e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
             r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.c = e.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(c) AS c FROM r GROUP BY a) c ON c.a = d.doc_id""",
)
def _(spark, sf_dir):
    return near_dedup.decide(table(spark, sf_dir, "documents"))


@query("op9_token_counts")
def _(spark, sf_dir):
    return token_counts.decide(table(spark, sf_dir, "documents"))


@query(
    "op10_exact_dedup",
    r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
             k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""",
)
def _(spark, sf_dir):
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def _clustering_sql(k: int = centroids.CENTROIDS, rounds: int = centroids.ROUNDS) -> str:
    """The rounds written out one after the other: a(r) assigns all vectors to the centroids c(r)."""
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                 WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS cluster, v AS c FROM v
                 QUALIFY cluster < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
                 SELECT vec_id, v, cluster, CAST(list_sum(list_transform(generate_series(1, 64), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d
                 FROM v, c{r}) GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
                 SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
                     SELECT cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, generate_series(1, 64) AS g(i) GROUP BY cluster, i)
                 GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
        SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (cluster)"""


@query("op11_centroid_clustering", _clustering_sql())
def _(spark, sf_dir):
    return centroids.decide(table(spark, sf_dir, "embeddings"))


@query("op12_token_alignment")
def _(spark, sf_dir):
    return token_alignment.decide(table(spark, sf_dir, "documents"))


@query(
    "op13_substring_dedup",
    r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
                   FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)),
             m AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
             r AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM s JOIN m USING (g) WHERE doc_id > first),
             x AS (SELECT doc_id, list(p) AS p FROM r GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed,
               sha256(array_to_string(list_transform(list_filter(generate_series(1, len(w)), lambda i: NOT list_contains(coalesce(p, []), i)),
                                                     lambda i: w[i]), ' ')) AS kept_sha256
        FROM d LEFT JOIN x USING (doc_id)""",
)
def _(spark, sf_dir):
    return substring_dedup.decide(table(spark, sf_dir, "documents"))
