"""The pipeline's stages on the given documents and on odd rows."""

import itertools
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from changeflow.llm import certified_packing, language_mixture, secret_forest, simhash_mih, weak_rules
from changeflow.llm.common import stored, table

from .test_simhash_mih import brute

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and output over the whole table."""
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SF_DIR), name)
        out[name] = (docs, made)
        docs = made
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_are_five_in_order_and_registered(steps):
    assert list(steps) == ["quality_rules", "language_id", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
    assert all(made.columns == COLUMNS for made in [m for _, m in steps.values()][:-1])
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    assert {n for n in range(1, 11)} == {int(q[2:].split("_")[0]) for q in queries() if q[:2] == "op" and q[2].isdigit()}


def test_quality_keeps_what_the_operator_keeps(steps):
    docs, made = steps["quality_rules"]
    assert ids(made) == ids(weak_rules.judge(docs).filter("kept")) and 0 < made.count() < docs.count()
    assert made.exceptAll(docs).count() == 0


def test_language_keeps_what_the_operator_answers(steps):
    docs, made = steps["language_id"]
    known = language_mixture.identify(docs).filter("lang_pred <> 'und' and score >= 0.4")
    assert ids(made) == ids(known) and made.exceptAll(docs).count() == 0


def test_one_document_of_each_group_stays(steps):
    docs, made = steps["simhash_near_dedup"]
    pairs = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert ids(made) == sorted({c for _, _, c in brute(pairs)}) and made.exceptAll(docs).count() == 0


def test_no_secret_is_left_and_all_else_stays(steps):
    docs, made = steps["secret_scans"]
    assert ids(made) == ids(docs)
    assert docs.filter(F.col("text").rlike('token = "[0-9a-f]{40}"')).count() > 0
    assert made.filter(F.col("text").rlike('token = "[0-9a-f]{40}"')).count() == 0
    same = docs.join(made.withColumnRenamed("text", "after"), "doc_id").filter("text = after").count()
    assert same == docs.count() - secret_forest.scan(docs).filter("is_secret").select("doc_id").distinct().count()


def test_everything_left_is_packed(steps):
    docs, made = steps["best_fit_packing"]
    rows = made.collect()
    fills, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        fills[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
    assert sorted(by_doc) == ids(docs)
    for spans in fills.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= certified_packing.CAPACITY
        assert all(o + n == p for (o, n), (p, _) in itertools.pairwise(spans))
    for parts in by_doc.values():
        parts.sort()
        assert parts[0][0] == 0 and all(s + n == t for (s, n), (t, _) in itertools.pairwise(parts))


def test_odd_rows_pass_through_every_stage(spark, sf_dir):
    prose = "The old house by the river was full of light and the people of the town went to see it. "
    rows = [(1, prose * 5), (1, prose * 5), (2, None), (3, ""), (None, prose * 7), (4, prose * 3000), (5, "\n".join([prose] * 2 + ["x | y"]))]
    df = stored(spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"), "odd")
    for kept in (df, df.limit(0)):
        docs = stored(kept, "kept")
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf_dir), "stage")
        assert docs.columns[:2] == ["doc_id", "piece"]


def test_simhash_contract_is_that_of_the_query(spark):
    assert (simhash_mih.WORDS_PER_SHINGLE, simhash_mih.MAX_DISTANCE) == (3, 3)
