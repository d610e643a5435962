import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import queries
from changeflow.llm import token_store as ts

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]]
ODD = [chr(c) for c in (0x1C, 0x1F, 0x85, 0xA0, 0x300, 0x301, 0x130, 0x3A3, 0x3C2, 0x2028, 0x3000, 0xB5, 0xAA, 0x1F600, 0x4E00)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def expected(library, rows):
    """Rows in id order, NULL first."""
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*ids_of(library, text), 2], dtype="<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def corpus():
    rng = random.Random(2)
    texts = [None, "", "   ", "Hello, World's 123 don't", "naïve café ÉCOLE ß", "<|endoftext|> x<|startoftext|>y", "tab\tnew\nline\x0b\x1cend", "x" * 5000, "日本語 текст Σας"]
    return [(i, texts[i % len(texts)] if i % 3 else " ".join("".join(rng.choices(PLAIN, k=rng.randrange(1, 9))) for _ in range(60))) for i in range(300)]


def test_encoder_equals_the_library(library):
    encoder, rng = ts.WordEncoder(PATH, remembered=500), random.Random(7)
    pools = [PLAIN, [*PLAIN, *ODD, " ", "\t", "\n", "'s", "'RE", "<|endoftext|>"]]
    for n in range(6000):
        text = "".join(rng.choice(pools[n % 2]) for _ in range(rng.randrange(1, 14)))
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids_of(library, text), repr(text)


def test_every_character_of_the_lower_planes(library):
    encoder = ts.WordEncoder(PATH)
    for c in [*range(1, 0x600), *range(0x600, 0x20000, 41)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)}"
            assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids_of(library, text), hex(c)


def test_a_word_not_seen_yet_is_made_when_it_is_looked_up(library):
    encoder, long = ts.WordEncoder(PATH, remembered=3), "ab" * 60
    for word in ("hello", "été", long):
        assert np.frombuffer(encoder.words[word], dtype="<u4").tolist() == ids_of(library, word)
    assert set(encoder.words) == {"hello", "été"}
    for text in ("one two three four", "five", "hello one"):
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids_of(library, text)


def test_round_trip_says_what_a_plain_version_says(spark, library):
    rows = corpus() + [(None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert answer(ts.round_trip(df, PATH)) == expected(library, rows)


def test_repeated_ids_and_rows_fill_the_places_without_gaps(spark, library):
    rows = [(1, "same"), (1, "same"), (1, "other words here"), (1, None), (0, "zero")] + [(2, "copy")] * 50
    got = answer(ts.round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), PATH))
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((r[0], r[2], r[3]) for r in expected(library, rows))
    places = sorted((r[1], r[2]) for r in got)
    assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()]
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == [0, 1, 1, 1, 1] + [2] * 50


def test_empty_table_and_clashing_columns(spark, library):
    schema = "doc_id long, text string"
    assert ts.round_trip(spark.createDataFrame([], schema), PATH).count() == 0
    rows = corpus()[:20]
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("key", "hash", "part", "ids", "start", "n_tokens")})
    assert answer(ts.round_trip(df, PATH)) == expected(library, rows)


def test_files_are_coded_cut_and_indexed(spark, library, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=4)) for _ in range(5000)]
    rows = [(i, f"document {i} says {' '.join(rng.choices(words, k=150))}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    store = ts.write_tokens(df, PATH, str(tmp_path / "s"), row_group_bytes=1 << 17, page_bytes=1 << 12)
    low = -1
    groups = 0
    for path in sorted(glob.glob(f"{tmp_path}/s/ids/*.parquet")):
        meta = pq.ParquetFile(path).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(k).path_in_schema: meta.row_group(g).column(k) for k in range(meta.num_columns)}
            ids = next(c for name, c in columns.items() if name.startswith("ids."))
            assert any("DICTIONARY" in e for e in ids.encodings)
            assert "DELTA_BINARY_PACKED" in columns["part_start"].encodings and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
            assert columns["doc_id"].statistics.min > low
            low = columns["doc_id"].statistics.max
    assert groups > 4
    index = store.index()
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan and index.count() == 3000
    some = store.tokens(1000, 1004)
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,1000)" in some._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r["ids"] for r in some.collect()}
    assert got == {i: [*ids_of(library, rows[i][1]), 2] for i in range(1000, 1005)}


def test_query_over_the_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert answer(queries()["op12_token_parquet"](spark, sf_dir)) == expected(library, [tuple(r) for r in docs])
