"""The corpus pipeline, stage by stage, against the brute-force versions."""

import hashlib
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_dedup import WHITE, by_hand_near

import corpus_pipeline
from shelfline.llm import mixing, pieces, quality_model
from shelfline.plans.ordered import cut_lineage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], SF)))
    return out


def test_all_but_the_last_return_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(s.dtypes == stages[0].dtypes for s in stages[1:-1])


def test_the_classifier_decides(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    decided = quality_model.decide(stages[0], labels)
    kept = {r.doc_id for r in decided.where("predicted = 1").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept
    clean = labels.where("quality = 1").join(stages[0], "doc_id")
    assert clean.join(stages[1], "doc_id", "left_anti").count() == 0


def test_one_row_of_each_text_stays(stages):
    best = {}
    for r in stages[1].collect():
        bare = WHITE.sub("", r.text or "")
        best[bare] = min(best.get(bare, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert {r.doc_id for r in stages[2].collect()} == {d for _, d in best.values()}


def test_one_document_of_each_near_group_stays(stages):
    data = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert {r.doc_id for r in stages[3].collect()} == {d for d, _, _, kept in by_hand_near(data) if kept}


def test_the_mix_takes_what_was_decided(stages):
    copies = {r.doc_id: r.copies for r in mixing.decide(stages[3]).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()} == copies


def test_pieces_spell_the_text_of_every_row(stages):
    coded = stages[5]
    assert coded.count() == stages[4].count()
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    for r in coded.collect():
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_pieces == len(r.pieces)
    back = coded.withColumn("back", pieces.decode(F.col("pieces"))).select("doc_id", "back")
    assert {(r.doc_id, r.back) for r in back.collect()} == set(texts.items())


def test_awkward_rows_pass_every_stage(spark, awkward, nothing):
    for docs in (awkward, nothing):
        left = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = cut_lineage(stage(spark, left, SF))
            assert after.columns == left.columns, name
            left = after
        last = corpus_pipeline.STAGES[-1][1](spark, left, SF)
        assert last.count() == left.count()


def test_run_is_the_chain_of_the_stages(spark, stages, rows):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages[5])


def test_registered_queries_and_their_names():
    code = (
        "import sys; sys.path.insert(0, '/root/repo'); import __spark_entry__ as e; "
        "print(*[q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"
    )
    names = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in names
