import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import language_mixture as lm
from changeflow.llm.common import table

SYLLABLES = {"aa": ["ka", "ko", "tu", "mi"], "bb": ["sch", "ei", "burg", "ung"], "cc": ["ñe", "llo", "ción", "ará"]}


def text_of(rng, language, words):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(x, text_of(rng, x, 80)) for x in SYLLABLES for _ in range(30)] + [(None, "ka ko"), ("aa", None), ("bb", "")]
    return lm.fit(spark.createDataFrame(rows, "lang string, text string"))


def test_training_counts_what_a_plain_count_finds(spark, model):
    assert model.languages == ("aa", "bb", "cc")
    assert np.exp(model.logs).sum(axis=0) == pytest.approx(np.ones(3))
    assert model.prior == pytest.approx(np.array([31, 32, 31]) / 94)


def plain_choice(model, text):
    """Every set of languages tried one by one; the proportions of the best."""
    buckets = lm.trigram_buckets(text) % len(model.logs)
    best, shares = -np.inf, None
    for size in range(1, len(model.languages) + 1):
        for chosen in combinations(range(len(model.languages)), size):
            p = np.exp(model.logs[buckets][:, chosen])
            share = np.full(size, 1 / size)
            for _ in range(lm.ROUNDS):
                part = p * share
                share = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
            worth = np.log(p @ share).sum() - (size - 1) * lm.PENALTY * np.log(len(buckets) + 1) / lm.EVIDENCE
            if size == 1:
                worth += np.log(model.prior[chosen[0]]) / lm.EVIDENCE
            if worth > best:
                best, shares = worth, {model.languages[c]: s for c, s in zip(chosen, share, strict=True)}
    return shares


def test_mixtures_equal_a_search_over_all_sets(model):
    rng = random.Random(4)
    texts = []
    for n in range(60):
        kinds = rng.sample(sorted(SYLLABLES), rng.choice([1, 1, 2, 3]))
        texts.append(" ".join(text_of(rng, k, rng.randint(1, 60)) for k in kinds))
    shares, _ = lm.infer(model, texts)
    for text, row in zip(texts, shares, strict=True):
        want = plain_choice(model, text)
        got = {model.languages[k]: row[k] for k in np.flatnonzero(row)}
        assert got == pytest.approx(want, abs=1e-6)


def test_batches_do_not_change_answers(model):
    rng = random.Random(9)
    texts = [text_of(rng, "aa", 5) + " " + text_of(rng, "bb", n) for n in range(20)] + ["", "1 2 3"]
    together, _ = lm.infer(model, texts)
    for text, row in zip(texts, together, strict=True):
        assert lm.infer(model, [text])[0][0] == pytest.approx(row)


def test_odd_texts_and_clashing_columns(spark, model):
    long_text = text_of(random.Random(1), "cc", 100_000)
    rows = [(1, None), (2, ""), (3, "12 %% 3"), (4, "ñello"), (4, "ñello"), (None, "sch ei burg"), (5, long_text), (6, "ℂ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("Letters", F.lit(1))
    seen, lang, score, _ = lm.with_languages(df, model)
    got = sorted(((r["doc_id"], r[lang], 0 <= r[score] <= 1) for r in seen.collect()), key=str)
    want = [(1, "und", True), (2, "und", True), (3, "und", True), (4, "cc", True), (4, "cc", True), (5, "cc", True), (6, "bb", True), (None, "bb", True)]
    assert got == sorted(want, key=str)
    assert seen.columns[:4] == df.columns and lang == "lang_pred" and score == "_score"


def test_nothing_to_learn_from(docs_of):
    df = docs_of([(1, "some text"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lm.identify(df).collect()} == {"und"}
    assert lm.identify(docs_of([])).count() == 0


def test_held_out_accuracy_and_rule(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = lm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested) > 0


def test_rows_kept_are_whole(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = lm.rows_with_language(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    assert kept.count() >= 0.95 * docs.count()


def test_groups_of_bounded_cells_give_the_same_shares(monkeypatch):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz     "))
    texts = ["".join(rng.choice(letters, size)) for size in (40, 0, 3000, 200, 5000, 10, 700)] + ["", "1 2 3"]
    logs = np.log(rng.dirichlet(np.ones(lm.BUCKETS), 5).T + 1e-9)
    model = lm.LanguageModel(tuple("vwxyz"), logs, np.full(5, 0.2))
    whole, numbers = lm.infer(model, texts)
    seen = []
    inner = lm._infer
    monkeypatch.setattr(lm, "_infer", lambda m, found: seen.append(sum(len(f[0]) for f in found) * 5) or inner(m, found))
    monkeypatch.setattr(lm, "CELLS", 4000)
    shares, n = lm.infer(model, texts)
    assert len(seen) > 3 and all(cells <= max(4000, 5 * 5000) for cells in seen)
    assert np.allclose(shares, whole) and (n == numbers).all() and shares.shape == (len(texts), 5)
    assert lm.infer(model, [])[0].shape == (0, 5)
