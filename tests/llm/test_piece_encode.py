import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from changeflow.llm import piece_encode as pe
from changeflow.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=500, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \t\n'aeiotnsrhl0.,▁éß中हिन्दी")), max_size=60))
def test_ids_equal_the_library(text):
    assert pe.encoder(PATH).encode(text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdeinorst"), min_size=1, max_size=40))
def test_backtracking_equals_merging(part):
    own = pe.encoder(PATH)
    assert own.backtrack(part) == own.merge(part)
    assert own.backtrack(f"▁{part}") == LIBRARY.encode(part, out_type=str)


@pytest.mark.parametrize("text", ["", " ", "  ", " " * 37, " " * 5000 + "x", "a" * 3001, "ab" * 4000, "<s> </s> <unk> <0x41>", "▁▁ ▁", "\x00\x01", "😀👍🏽", "=" * 500])
def test_odd_texts_equal_the_library(text):
    assert pe.encoder(PATH).encode(text) == LIBRARY.encode(text)


def test_memory_is_bounded_and_changes_nothing():
    own = pe.Encoder(PATH, remembered=50)
    rng = random.Random(1)
    for _ in range(300):
        text = " ".join("".join(rng.choice("aeistnr") for _ in range(rng.randint(1, 9))) for _ in range(20))
        assert own.encode(text) == LIBRARY.encode(text)
    assert len(own.memory) <= 50 and len(own.memory.old) <= 50


def digests(text):
    ids = LIBRARY.encode(text or "")
    decoded = LIBRARY.decode(ids) if ids else ""
    return len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()


def test_rows_equal_the_library(docs_of):
    pairs = [(1, None), (2, ""), (3, " lead and trail "), (3, " lead and trail "), (None, "x\ny"), (4, "word " * 50_000), (5, "z" * 100_000)]
    df = docs_of(pairs)
    rows = pe.encode(df, PATH, with_ids=True).collect()
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows), key=str)
    assert got == sorted(((i, *digests(t)) for i, t in pairs), key=str)
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
    assert pe.encode(docs_of([]), PATH).count() == 0


def test_given_documents_equal_the_library(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = {r["doc_id"]: digests(r["text"]) for r in docs.select("doc_id", "text").collect()}
    rows = pe.encode(docs, PATH).collect()
    assert len(rows) == len(want) and all(want[r["doc_id"]] == (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
