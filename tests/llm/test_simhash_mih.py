import random
import re

import xxhash
from pyspark.sql import functions as F

from changeflow.llm import simhash_mih
from changeflow.llm.components import connected_components


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    """Smallest node that each node reaches, by repeated scanning."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def brute(pairs):
    prints = [(i, fingerprint(t)) for i, t in pairs]
    kinds = sorted({p for _, p in prints})
    links = [(a, b) for k, a in enumerate(kinds) for b in kinds[k + 1 :] if (a ^ b).bit_count() <= 3]
    low = classes(kinds, links)
    first = {}
    for i, p in prints:
        if i is not None:
            first[low[p]] = min(first.get(low[p], i), i)
    return sorted(((i, f"{p:016x}", first.get(low[p])) for i, p in prints), key=str)


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{n}" for n in range(60)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 400))]
        texts.append(" ".join(base))
        for _ in range(4):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(" \t".join(near).upper())
    texts += [None, "", " \n\t ", "one", "one", "one two", "Ä Ö Ü ß", "long " * 50_000, "a\xa0b c d"]
    return list(enumerate(texts)) + [(3, texts[3]), (None, "without id"), (None, None)]


def test_equals_brute_force(docs_of):
    pairs = corpus()
    got = simhash_mih.near_duplicates(docs_of(pairs))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(pairs)


def test_links_find_every_pair_of_three_flipped_bits(spark):
    rng = random.Random(3)
    found = set()
    for _ in range(40):
        word = rng.getrandbits(64)
        found.add(word)
        for _ in range(6):
            found.add(word ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    signed = {x - (1 << 64) if x >> 63 else x for x in found}
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    got = {tuple(r) for r in simhash_mih.fingerprint_links(df).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert want and got == want


def test_one_of_each_keeps_the_smallest_id_once(docs_of):
    text = " ".join(f"word{n}" for n in range(300))
    pairs = [(5, text), (2, text), (2, text), (9, text + " end"), (7, "something else"), (None, None), (None, ""), (None, "alone")]
    kept = simhash_mih.one_of_each(docs_of(pairs))
    assert kept.columns == docs_of(pairs).columns
    rows = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = {(2, text), (7, "something else"), (None, "alone")}
    assert want <= set(rows) and len(rows) == (4 if (9, text + " end") not in rows else 5)


def test_empty_table(docs_of):
    assert simhash_mih.near_duplicates(docs_of([])).count() == 0
    assert simhash_mih.one_of_each(docs_of([])).count() == 0


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(1)
    edges = [(n, n + 1) for n in range(0, 70)] + [(100, n) for n in range(101, 160)] + [(200, 200), (150, 150), (101, 102)]
    edges += [(rng.randrange(300, 420), rng.randrange(300, 420)) for _ in range(80)]
    rng.shuffle(edges)
    edges += edges[:20]
    df = spark.createDataFrame([*edges, (None, 3)], "l long, r long")
    got = {r["node"]: r["component"] for r in connected_components(df, "l", "r").collect()}
    assert got == classes({n for e in edges for n in e}, edges)


def test_plan_has_no_cross_join(spark):
    df = spark.createDataFrame([(n,) for n in range(10)], "fingerprint long").withColumn("fingerprint", F.col("fingerprint") * 7)
    plan = simhash_mih.fingerprint_links(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
