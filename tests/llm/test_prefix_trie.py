import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from changeflow.llm import prefix_trie as pt
from check_oracles import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_order(row):
    role, text = row[2] or "", row[3] or ""
    digest = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
    return (row[1] is not None, row[1] or 0, digest)


def rebuilt(rows):
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=turn_order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def plain(sequences):
    """``sequences``: member -> list of (role, text)."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(sequences[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(children[node]), leaves[node], saved[node], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(n=300):
    rng = random.Random(5)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        kind = rng.random()
        if kind < 0.3:  # a hot group of equal conversations
            turns = [("user", "hot"), ("assistant", "same é")] * 2
        else:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "long " * 50])) for _ in range(rng.randrange(1, 14))]
        rows += [(c, t, role, text) for t, (role, text) in enumerate(turns)]
    rows += [(3, None, "user", "first"), (7, 2, "user", "twice"), (7, 2, "user", "twice"), (None, 1, "user", "of none"), (-7, 0, "user", "a"), (-5, 0, "user", "b")]
    rows += [(40_001, t, "user", f"turn {t % 3}") for t in range(500)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [{}, {"shard_nodes": 6, "least_paths": 4}, {"shard_nodes": 40, "least_paths": 4}])
def test_trie_equals_a_plain_version_whatever_the_shards(spark, shards):
    rows = conversations()
    got = answer(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), **shards))
    assert got == plain(rebuilt(rows))


def test_paths_of_many_shards(spark):
    rng = random.Random(8)
    sequences = {c: [("u", rng.choice("abc")) for _ in range(rng.randrange(0, 9))] for c in range(900)}
    digest = {x: sha256(x.encode()).digest()[:16] for x in "abc"}
    rows = [(b"".join(digest[t] for _, t in turns), c, [1] * len(turns)) for c, turns in sequences.items()]
    df = spark.createDataFrame(rows, "path binary, member long, sizes array<long>")
    assert answer(pt.trie(df, shard_nodes=10, least_paths=4)) == plain(sequences)


def test_conversations_without_turns_belong_to_the_root(spark):
    # each is cut at its own beginning and its group has no first conversation
    rows = [(c, 0, "user", "x") for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0]
    ids = [r[0] for r in rows]
    (row,) = answer(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert row == (min(ids), 0, None, len(ids), 0, 1, 0, sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_empty_table_and_clashing_columns(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pt.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    rows = conversations(20)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "position", "digest", "size", "path", "h", "base", "total")})
    assert answer(pt.prefix_trie(df)) == plain(rebuilt(rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=400), st.sampled_from([2, 3, 8]), st.sampled_from([2, 5]))
def test_findclose_finds_the_matching_parenthesis(steps, block, group):
    bits, open_now = [1], 1
    for up in steps:
        if up or open_now == 1:
            bits.append(1)
            open_now += 1
        else:
            bits.append(0)
            open_now -= 1
    bits += [0] * open_now
    string = pt.Parentheses(np.array(bits), block, group)
    stack = []
    for at, bit in enumerate(bits):
        if bit:
            stack.append(at)
        else:
            assert string.findclose(stack.pop()) == at


def test_query_equals_its_sql(spark, sf_dir):
    name = "op13_prefix_trie"
    assert name in queries() and name in oracle_sql()
    good, note = compare(spark, connect(sf_dir), name, sf_dir)
    assert good, note
