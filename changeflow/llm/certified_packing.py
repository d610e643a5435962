"""Packing of documents into sequences by best-fit decreasing, with a proven bound for each partition.

Tokens of a document that do not fill whole sequences form one remainder, and only remainders need packing. They are
dealt into groups; each group packs its own by best-fit decreasing and computes a lower bound for the number of its bins
by dual-feasible functions. A group whose count meets its bound is certified: no packing of its remainders takes fewer
bins. In the others the bins that are not full are taken apart, as is the emptiest bin of a certified group (what
rounding up leaves open in each group may add up to whole bins); their remainders are dealt anew over fewer groups, so
that documents change places between groups, and packed again, until one group holds them all or a round gains nothing,
in which case its bins stay as they were. Where no bin at all may stay, groups are merged, two into one; only then do they
grow beyond their size, up to ``MOST_ITEMS``. No remainder is ever cut further.

The same bound over the lengths of all remainders, of which there are fewer than a sequence has tokens, certifies the
whole: once all bins together are no more than it, no exchange can gain one, and it ends.
"""

import json
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import count
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from .common import arrow, ship, stored

CAPACITY = 1024
END_ID = 2
GROUP_ITEMS = 20_000
#: What merging groups may bring one to. Beyond it, remainders only change places by being dealt anew.
MOST_ITEMS = 640_000
#: A stretch without a break of this many characters is left to the tokenizers library.
LONG_STRETCH = 2_000

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of a byte-level BPE file as the tokenizers library gives them, encoded by tiktoken, which is faster.

    The file's vocabulary ranks merges by id, which is what tiktoken needs. Texts with special tokens or with very long
    unbroken stretches go through the tokenizers library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {_bytes_of(token): at for token, at in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("ids", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = regex.compile(rf"\S{{{LONG_STRETCH},}}|\s{{{LONG_STRETCH},}}")

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or len(text) >= LONG_STRETCH and self.slow.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


#: Fixed value: how byte-level BPE splits a text before merging.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of(token: str) -> bytes:
    """Byte-level vocabularies write each byte as a printable character: itself if printable, else the next from U+0100."""
    if not _characters:
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        _characters.update({chr(b): b for b in plain})
        _characters.update({chr(0x100 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)})
    return bytes(_characters[c] for c in token)


_characters: dict[str, int] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces_of(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Id, ``piece, start, length, ids_crc32`` (and ``ids``): a document's tokens, then ``end_id``, cut for packing.

    Pieces after the first are full; the first takes what is left over. A NULL text is an empty one: the end id alone.
    """
    fields = [docs.schema[id_column], *_fields("piece int, start long, length long, ids_crc32 long")]
    fields += _fields("ids array<int>") if with_ids else []
    names = [f.name for f in fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                made: list[tuple] = []
                kept: list[np.ndarray] = []
                for row, words in enumerate(part.column(1).to_pylist()):
                    ids = np.append(encode(words or ""), np.uint32(end_id)).astype("<u4")
                    start, length = 0, len(ids) % capacity or capacity
                    for piece in range((len(ids) + capacity - 1) // capacity):
                        own = ids[start : start + length]
                        made.append((row, piece, start, length, crc32(own.tobytes())))
                        if with_ids:
                            kept.append(own.astype(np.int32))
                        start, length = start + length, capacity
                columns = list(zip(*made, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                arrays[0] = part.column(0).take(arrays[0])
                if with_ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return arrow(docs.select(id_column, text), cut, StructType(fields))


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, each into the fullest bin with room for it."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    open_by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # sorted; those of bins that are not full
    count = 0
    for at in order.tolist():
        need = int(lengths[at])
        k = bisect_left(rooms, need)
        if k == len(rooms):
            room, which = capacity, count
            count += 1
        else:
            room = rooms[k]
            which = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room], rooms[k]
        bins[at], offsets[at] = which, capacity - room
        left = room - need
        if left:
            if left not in open_by_room:
                open_by_room[left] = []
                insort(rooms, left)
            open_by_room[left].append(which)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing of these lengths takes fewer bins.

    The largest of the sums under three families of dual-feasible functions, each taken over all useful parameters: the
    lengths themselves; rounding to multiples of 1/(k+1) of a bin; and dropping lengths of at most t while lengths above
    capacity - t count as whole bins. A sum is worked out once per different length.
    """
    return bound_of_counts(Counter(lengths.tolist()), capacity)


def bound_of_counts(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """``lower_bound`` of lengths given as how often each occurs."""
    if not counts:
        return 0
    x = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[v] for v in x.tolist()], dtype=np.int64)
    best = -(-int((x * n).sum()) // capacity)
    for k in range(1, 21):
        whole, rest = np.divmod(x * (k + 1), capacity)
        # in units of 1 / (capacity * k): exact multiples keep their length, others are rounded down to k-ths
        value = np.where(rest == 0, x * k, whole * capacity)
        best = max(best, -(-int((value * n).sum()) // (capacity * k)))
    for t in x[2 * x <= capacity].tolist():
        value = np.where(x > capacity - t, capacity, np.where(x >= t, x, 0))
        best = max(best, -(-int((value * n).sum()) // capacity))
    return best


def _pack_groups(items: DataFrame, groups: int, salt: int, capacity: int) -> DataFrame:
    """``items`` dealt over ``groups`` by a hash, each group packed: with ``grp, bin, offset, bound, bins, filled``."""
    dealt = items.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(groups)).cast("int"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "uid"], ascending=[False, True], kind="stable").reset_index(drop=True)
        lengths = group["length"].to_numpy(dtype=np.int64)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        return group.assign(bin=bins, offset=offsets, bound=lower_bound(lengths, capacity), bins=len(filled), filled=filled[bins], emptiest=int(filled.argmin()))

    ship(items.sparkSession)
    made = [StructField(c, LongType()) for c in ("bin", "offset", "bound", "bins", "filled", "emptiest")]
    return dealt.groupBy("grp").applyInPandas(pack, StructType([*dealt.schema.fields, *made]))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``pieces`` with ``sequence_id`` and ``offset``, and the certificates: a row per round and group.

    ``pieces`` needs ``length`` (1 to ``capacity``) and must be stored, for it is read more than once; rows may repeat.
    ``rounds``, if given, ends the exchange early. A certificate tells a group's bins, its bound, and how many of its bins stayed (``kept``) rather than being taken apart;
    ``total_bound`` is the bound of all remainders together, so the bins that stayed in all rounds cannot be fewer.
    """
    payload = pieces.columns
    inner = [f"c{n}" for n in range(len(payload))]
    length = F.col(inner[payload.index("length")])
    # a number of its own for every row, so that repeated rows stay apart; written before it is used
    small = pieces.toDF(*inner).filter(length < capacity)
    left_over = stored(small.select(*inner, length.cast("long").alias("length"), F.monotonically_increasing_id().alias("uid")), "remainders")
    items = left_over.columns
    done, certificates = [], []
    counts = {r["length"]: r["count"] for r in left_over.groupBy("length").count().collect()}  # fewer than ``capacity``
    total = bound_of_counts(counts, capacity)
    left, taken, apart, stayed = sum(counts.values()), None, 0, 0
    for turn in count():
        groups = max(1, -(-left // group_items))
        packed = stored(_pack_groups(left_over, groups, turn, capacity), "packed").withColumn("round", F.lit(turn))
        loose = (F.col("filled") < capacity) & ((F.col("bins") > F.col("bound")) | (F.col("bin") == F.col("emptiest")))
        found = packed.groupBy("grp", "bin").agg(F.count("*").alias("n"), F.first(loose).alias("loose"))
        bins = found.agg(
            F.count("*").alias("all"), F.count_if("loose").alias("loose"), F.sum(F.when(F.col("loose"), F.col("n")).otherwise(0)).alias("items")
        ).first()
        if taken is not None and bins["all"] >= apart:
            done.append(taken)
            break
        before, left = left, bins["items"] or 0
        last = groups == 1 or turn + 1 == rounds or left == 0 or stayed + bins["all"] <= total
        keep = F.lit(True) if last else ~loose
        certificates.append(
            packed.groupBy("round", "grp").agg(
                F.max("bins").alias("bins"), F.max("bound").alias("bound"), F.countDistinct(F.when(keep, F.col("bin"))).alias("kept"), F.lit(total).cast("long").alias("total_bound")
            )
        )
        done.append(packed.filter(keep))
        if last:
            break
        if left == before:
            group_items = max(group_items, min(2 * group_items, MOST_ITEMS))
        taken, apart = packed.filter(loose), bins["loose"] or 0
        stayed += bins["all"] - apart
        left_over = taken.select(items)
    full = pieces.filter(F.col("length") == capacity)
    # full pieces take even numbers, bins of remainders odd ones: round, group and bin in separate bits
    out = full.select(*payload, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    number = F.col("round").cast("long") * F.lit(1 << 49) + F.col("grp").cast("long") * F.lit(1 << 25) + F.col("bin") * 2 + 1
    for part in done:
        named = [F.col(c).alias(name) for c, name in zip(inner, payload, strict=True)]
        out = out.unionByName(part.select(*named, number.alias("sequence_id"), "offset"))
    return out, reduce(DataFrame.unionByName, certificates)


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> tuple[DataFrame, DataFrame]:
    """Pieces of ``docs`` with their sequences, and the certificates. NULL texts are packed as their end id alone."""
    group = {k: options.pop(k) for k in ("group_items", "rounds") if k in options}
    pieces = stored(pieces_of(docs, tokenizer, **options), "pieces")
    return pack(pieces, options.get("capacity", CAPACITY), **group)
