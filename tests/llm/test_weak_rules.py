import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changeflow.llm import weak_rules
from changeflow.llm.common import table


def base(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {x for x, n in Counter(windows).items() if n > 1}
    covered = {i + d for i, x in enumerate(windows) if x in often for d in range(3)}
    symbols = len(re.findall("[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


PROSE = "The ship went to the north and it was there that we saw the light of the old town for a long time, as told by him."


def corpus():
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choice("the of and river stone walked under bright tree said house with that".split()) for _ in range(12)).capitalize() + "."
    good = ["\n".join(sentence() for _ in range(rng.randint(6, 20))) for _ in range(60)]
    noisy = [re.sub(r"(\w+)", r"\1%%%", g) for g in good[:8]]
    loud = [re.sub(r"(\w+)", r"\1!!", g).upper() for g in good[8:14]]
    again = ["\n".join([sentence()] * 30) for _ in range(5)]
    odd = [None, "", "  \n ", "one", "a b c a b c a b c", "x\r\ny\x0bz\x0c\tz", "é ü 😀😀 ## &&", "same\nsame\n\nsame \n", PROSE * 2000]
    return good, noisy + loud + again, odd


def test_base_counts_equal_a_plain_version(docs_of):
    good, bad, odd = corpus()
    texts = good + bad + odd
    pairs = list(enumerate(texts)) + [(0, texts[0]), (None, "no id here")]
    rows = weak_rules.judge(docs_of(pairs)).collect()
    got = sorted((str(r["doc_id"]), *(r[c] for c in weak_rules.BASE)) for r in rows)
    assert got == sorted((str(i), *base(t)) for i, t in pairs)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"]) and 0 <= r["quality"] <= 1


@pytest.mark.parametrize("bits", [3, 24, 62])
def test_repeated_words_whatever_hashes_are_shared(docs_of, monkeypatch, bits):
    """With 62 bits of place a hash has two left, so most windows share one; with three, eight words are too many to pack."""
    monkeypatch.setattr(weak_rules, "PLACE_BITS", bits)
    good, bad, odd = corpus()
    texts = [*good[:12], *bad, *odd, "a b c d e a b c", "a b a b a b a", "c d a b c d", "ab c d a bc d"]
    rows = weak_rules.judge(docs_of(list(enumerate(texts)))).select("doc_id", "n_repeat_words").collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in rows} == {i: base(t)[4] for i, t in enumerate(texts)}


def test_posterior_keeps_prose_and_rejects_each_way_of_being_bad(docs_of):
    good, bad, _ = corpus()
    rows = weak_rules.judge(docs_of(list(enumerate(good + bad)))).collect()
    kept = {r["doc_id"] for r in rows if r["kept"] or r["base_failed"] and r["doc_id"] < len(good)}
    assert kept == set(range(len(good)))


def plain_fit(patterns, names, kinds, rounds=20_000):
    """The same estimate over (votes, texts) pairs, one pattern after another."""
    model = first = weak_rules.start(kinds, names)
    for _ in range(rounds):
        found = Counter()
        cast = Counter()
        for votes, n in patterns:
            joint = []
            for k in model.share:
                p = model.share[k]
                for r, v in zip(names, votes, strict=True):
                    p *= 1 if v is None else model.bad_vote[k][r] if v == 0 else 1 - model.bad_vote[k][r]
                joint.append(p)
            for k, p in enumerate(joint):
                for j, v in enumerate([*votes, 0]):
                    if v is not None:
                        cast[k, j] += n * p / sum(joint)
                        found[k, j] += n * p / sum(joint) * (v == 0)
        new = weak_rules._estimate({x: (found[x], cast[x]) for x in cast}, first, kinds, names)
        moved = max([abs(new.bad_vote[k][r] - model.bad_vote[k][r]) for k in new.share for r in names] + [abs(new.share[k] - model.share[k]) for k in new.share])
        model = new
        if moved < 1e-7:
            break
    return model


def test_estimate_equals_a_plain_version(spark, docs_of):
    good, bad, odd = corpus()
    voted, _, votes = weak_rules.with_votes(docs_of(list(enumerate(good + bad + odd))))
    names = [f.name for f in voted.schema[votes].dataType.fields]
    counts = Counter(tuple(r[0][n] for n in names) for r in voted.select(votes).collect())
    got, want = weak_rules.fit(voted, votes), plain_fit(list(counts.items()), names, weak_rules.KINDS)
    assert got.share == pytest.approx(want.share, abs=2e-3)
    for k in want.share:
        assert got.bad_vote[k] == pytest.approx(want.bad_vote[k], abs=2e-3)


def test_an_estimate_that_does_not_settle_is_an_error(docs_of):
    good, bad, _ = corpus()
    voted, _, votes = weak_rules.with_votes(docs_of(list(enumerate(good + bad))))
    with pytest.raises(RuntimeError, match="still move"):
        weak_rules.fit(voted, votes, patience=2)


def test_agrees_with_labels_it_never_saw(spark, sf_dir):
    judged = weak_rules.judge(table(spark, sf_dir, "documents")).filter("not base_failed").select("doc_id", "kept")
    both = judged.join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("truth")), "doc_id")
    right = both.filter(F.col("kept") == (F.col("truth") == 1)).count()
    assert right >= 0.97 * both.count() > 0


def test_rows_kept_have_the_columns_of_the_input(docs_of):
    df = docs_of([(1, PROSE * 3), (1, PROSE * 3), (2, None)]).withColumn("votes", F.lit(1)).withColumn("Signals", F.lit(2))
    kept = weak_rules.good_rows(df)
    assert kept.columns == df.columns
    assert weak_rules.good_rows(df.limit(0)).count() == 0 and weak_rules.judge(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = weak_rules.judge(docs_of([(1, PROSE)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
