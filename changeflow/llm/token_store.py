"""Token ids of documents as Parquet list columns that can be read selectively.

A store is a folder of Parquet files in id order: one row per document with ``doc_id``, ``part`` (the file's place in the
order), ``part_start`` (ids before it in its part), ``n_tokens`` and the list ``ids``. Ids are dictionary-coded (pages whose
dictionary grows too large fall back to delta coding, as do the sorted numbers), row groups and pages are cut small, and
page indexes are written, so that the columns about documents are read without any ids, and a few documents' ids from
the pages that hold them. Next to the files lies ``parts``, one row per part with the number of ids before it: that makes
global places out of places in a part, so the ids are encoded, ordered and written in one pass.

Encoding is the ``tokenizers`` library's. Its words never cross white space, and equal words have equal ids. A text of plain
Latin letters, digits and signs is divided into words here, which the library's model merges; of any other text, the chunks
between blanks are taken so, and chunks with other characters are encoded by the library whole. Words and chunks seen
before are looked up in tables of bounded size.
"""

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import Struct, pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.session import shared_dir

from .common import arrow, fresh

END = 2
ROW_GROUP_BYTES = 1 << 24
PAGE_BYTES = 1 << 16
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
SLICE_CHARACTERS = 1 << 20

#: Characters whose lower-casing, composition and class are the same in every Unicode version: printable ASCII and the
#: letters of Latin-1 (fixed values).
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
#: How the vocabulary's file divides text into words (fixed value), for plain characters.
_WORDS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r a-z0-9ß-öø-ÿ]+")
#: Python takes these as blanks, the library does not.
_NO_BLANKS = re.compile("[\x1c-\x1f]")
#: How few ids are packed; the formats are parsed once.
_PACKED = [Struct(f"<{n}I").pack for n in range(33)]


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet for plain characters: printable ones stand for themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}


class _Remembered(dict):
    """Ids by word; what is not there yet is asked of ``make``, which may put it in."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        return self.make(word)


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.remembered = remembered
        # the chunks and words of now, and those of the generation before
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = _Remembered(self._word)
        self.old_chunks: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """A word that is not among those of now."""
        found = self.old_words.get(word)
        if found is None:
            tokens = self.model.tokenize(word if word.isascii() else word.translate(self.letters))
            found = _PACKED[len(tokens)](*[t.id for t in tokens]) if len(tokens) < len(_PACKED) else pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(word) <= LONGEST_REMEMBERED:
            self.words[word] = found
        return found

    def _is_plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))

    def _chunk(self, chunk: str) -> bytes:
        found = self.old_chunks.get(chunk)
        if found is None and self._is_plain(chunk):
            found = self._plain(chunk)
        if found is None:
            found = np.array(self.library.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(chunk) <= LONGEST_REMEMBERED:
            self.chunks[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        if len(self.words) > self.remembered:
            self.words, self.old_words = _Remembered(self._word), self.words
        if self._is_plain(text):
            return self._plain(text)
        if _NO_BLANKS.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.chunks) > self.remembered:
            self.chunks, self.old_chunks = {}, self.chunks
        known = self.chunks
        return b"".join([known[c] if c in known else self._chunk(c) for c in text.split()])


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One encoder per worker process, so that its tasks share what it has seen."""
    return WordEncoder(path)


def encoded(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """``doc_id, part, part_start, n_tokens, ids`` in id order (NULL ids first), partition by partition.

    NULL and empty texts have the end id alone. Rows of one id stand by a hash of their texts, and repeated rows in any
    order; they are divided among partitions like any others.
    """
    kind = docs.schema[id_column].dataType
    (key,) = fresh(docs, "key")
    slim = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slim = slim.withColumn("hash", F.xxhash64("text")).withColumn(key, F.monotonically_increasing_id())
    order = ["doc_id", "hash", key]
    placed = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = encoder_of(tokenizer), TaskContext.get().partitionId(), 0
        close = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column(1)
            at = 0
            while at < batch.num_rows:
                first, made, size = at, [], 0
                while at < batch.num_rows and size < SLICE_CHARACTERS:
                    value = texts[at].as_py()
                    made.append(encoder.encode(value) + close)
                    size += len(value) + 1
                    at += 1
                counts = np.array([len(m) // 4 for m in made], dtype=np.int64)
                ends = np.cumsum(counts)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.frombuffer(b"".join(made), dtype="<i4"))
                )
                columns = [batch.column(0).slice(first, len(made)), np.full(len(made), part, dtype=np.int32), start + ends - counts, counts, ids]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["doc_id", "part", "part_start", "n_tokens", "ids"])
                start += int(ends[-1])

    return arrow(placed, run, f"doc_id {kind.simpleString()}, part int, part_start long, n_tokens long, ids array<int>")


class TokenStore:
    """A folder of token ids; ``write`` makes one, the readers take no more columns and pages of it than they need."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, rows: DataFrame, row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> "TokenStore":
        """Write ``encoded`` rows as they lie, then the parts' starts from the counts in the files."""
        options = {
            "compression": "zstd",
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(row_group_bytes),
            "parquet.page.size": str(page_bytes),
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": "true",
            "parquet.dictionary.page.size": str(1 << 18),
        }
        rows.write.options(**options).parquet(f"{self.folder}/ids")
        sums = self._files().groupBy("part").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
        starts = sums.withColumn("starts_at", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
        starts.coalesce(1).write.parquet(f"{self.folder}/parts")
        return self

    def _files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/ids")

    def parts(self) -> DataFrame:
        """A row per part: its number of documents and ids, and the number of ids before it."""
        return self.spark.read.parquet(f"{self.folder}/parts")

    def _placed(self, rows: DataFrame) -> DataFrame:
        starts = self.parts().select("part", "starts_at")
        return rows.join(starts, "part").withColumn("start", F.col("starts_at") + F.col("part_start"))

    def index(self) -> DataFrame:
        """``doc_id, start, n_tokens``; no ids are read."""
        return self._placed(self._files().select("doc_id", "part", "part_start", "n_tokens")).select("doc_id", "start", "n_tokens")

    def tokens(self, first=None, last=None) -> DataFrame:
        """``doc_id, start, n_tokens, ids`` of all documents, or of those with ids from ``first`` to ``last``: row groups and
        pages that hold no such id are skipped by their statistics and indexes."""
        rows = self._files()
        if first is not None:
            rows = rows.filter(F.col("doc_id") >= first)
        if last is not None:
            rows = rows.filter(F.col("doc_id") <= last)
        return self._placed(rows).select("doc_id", "start", "n_tokens", "ids")


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, id_column: str = "doc_id", text: str = "text", **layout) -> TokenStore:
    """Encode ``docs`` into a new store, by default in the shared folder."""
    spark = docs.sparkSession
    store = TokenStore(spark, folder or shared_dir(spark, "tokens"))
    return store.write(encoded(docs, tokenizer, id_column, text), **layout)


def with_crc(rows: DataFrame, ids: str = "ids", to: str = "ids_crc32") -> DataFrame:
    """``rows`` with the unsigned CRC-32 of each row's ids, as little-endian unsigned 32-bit integers, in place of them."""
    kept = [c for c in rows.columns if c != ids]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != ids], f"`{to}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            values = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
            ends = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=[*kept, to])

    return arrow(rows, run, schema)


def round_trip(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", **layout) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every row of ``docs``, from a store written and read back."""
    read = with_crc(write_tokens(docs, tokenizer, None, id_column, text, **layout).tokens())
    return read.withColumnRenamed("doc_id", id_column)
