"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has the bits that more than half of its shingles' hashes have. Fingerprints that differ in at
most three bits link. A pair within distance three differs in at most one bit in one of its two 32-bit halves, so each
fingerprint looks up the 33 keys of the ball of radius one around each half in a table by halves and verifies the
complete distance. Half the word as the segment keeps a bucket small up to billions of fingerprints, where 16-bit
segments would fill every bucket. Equal texts share a fingerprint, and only different fingerprints enter the search,
so a group of copies costs one entry, whatever its size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import arrow, fresh, let, lower_ascii, stored, words
from .components import connected_components

WORDS_PER_SHINGLE = 3
MAX_DISTANCE = 3
HALF = 32


def shingle_hashes(text: Column, width: int = WORDS_PER_SHINGLE) -> Column:
    """XXH64 (seed 42) of each run of ``width`` words of the lower-cased text; of the whole sequence if it is shorter."""

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - width)
        runs = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, width), " ")))
        whole = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= width, runs).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return let(words(lower_ascii(text)), of)


def _majority(hashes: pa.ListArray) -> pa.Array:
    """Per list the 64-bit word of the bits set in more than half of its entries; zero for an empty list."""
    offsets = hashes.offsets.to_numpy().astype(np.int64)
    values = hashes.values.to_numpy(zero_copy_only=False)
    out = np.zeros(len(hashes), dtype=np.uint64)
    weights = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    step = 1 << 16
    for row, (start, end) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        count = np.zeros(64, dtype=np.int64)
        for at in range(start, end, step):  # bounded memory for a text of any length
            block = np.ascontiguousarray(values[at : min(end, at + step)]).view(np.uint8).reshape(-1, 8)
            count += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[row] = weights[2 * count > end - start].sum(dtype=np.uint64)
    return pa.array(out.view(np.int64), pa.int64())


def with_fingerprint(df: DataFrame, text: str = "text", to: str = "fingerprint", width: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as a long. NULL, empty and blank texts get zero."""
    (hashes,) = fresh(df, "hashes")
    kept = df.columns
    schema = StructType([*df.schema.fields, StructField(to, LongType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _majority(batch.columns[-1])], names=[*kept, to])

    return arrow(df.withColumn(hashes, shingle_hashes(F.col(text), width)), run, schema)


def _halves(fingerprint: Column) -> Column:
    low = fingerprint.bitwiseAND(F.lit((1 << HALF) - 1))
    return F.array(
        F.struct(F.lit(0).alias("half"), low.alias("key")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(fingerprint, HALF).alias("key")),
    )


def fingerprint_links(fingerprints: DataFrame, column: str = "fingerprint", max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``a, b`` (a < b): every pair of different fingerprints that differ in at most ``max_distance`` bits.

    ``fingerprints`` must be distinct. ``max_distance`` up to three needs a radius of one per half.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("two halves with balls of radius one prove links up to distance 3")
    radius_one = F.array(F.lit(0).cast("long"), *[F.lit(1 << bit) for bit in range(HALF)]) if max_distance > 1 else F.array(F.lit(0).cast("long"))
    table = fingerprints.select(F.col(column).alias("b"), F.explode(_halves(F.col(column))).alias("at")).select("b", "at.half", "at.key")
    probes = (
        fingerprints.select(F.col(column).alias("a"), F.explode(_halves(F.col(column))).alias("at"))
        .select("a", "at.half", F.explode(radius_one).alias("flip"), F.col("at.key").alias("own"))
        .select("a", "half", F.col("own").bitwiseXOR(F.col("flip")).alias("key"))
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    # the optimizer does not see that exploding multiplies the rows and might broadcast them
    return probes.join(table.hint("merge"), ["half", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WORDS_PER_SHINGLE, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """``id, fingerprint, component_id`` for every row of ``docs``, which may have any other columns.

    ``fingerprint`` is 16 hexadecimal digits; ``component_id`` is the smallest id that links of fingerprints reach from
    the row's fingerprint, the row itself included. Repeated rows are answered each; NULL, empty and blank texts share
    fingerprint zero and link like others. A row without id is answered too, and its component's id is NULL if no row
    of the component has one.
    """
    marked = stored(with_fingerprint(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")), "text", "fp", width).select("doc_id", "fp"), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = stored(classes, "classes")
    components = connected_components(fingerprint_links(classes, "fp", max_distance), "a", "b")
    placed = classes.join(components, classes["fp"] == components["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    answers = placed.join(smallest, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(answers, "fp").select(
        F.col("doc_id").alias(id_column), digits.alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **contract) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one row, that with the smallest id.

    Rows without id come after all others; among rows with equal id and text any one stays. The search runs on a slim
    table of ids, hashes of texts (which tell rows of one id apart) and fingerprints; the texts move once, to be joined
    with the rows that stay. Those grow with the table, so they are never broadcast.
    """
    key, digest, rank = fresh(docs, "id_key", "text_hash", "rank_of_row")
    told = {key: F.coalesce(F.col(id_column).cast("string"), F.lit("")), digest: F.xxhash64(text)}
    own = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), told[key].alias("key"), told[digest].alias("digest"))
    slim = with_fingerprint(own, "text", "fp", contract.get("width", WORDS_PER_SHINGLE)).select("id", "key", "digest", "fp")
    slim = stored(slim, "slim")
    row = F.struct(F.col("id").isNull().alias("lacks"), "id", "key", "digest")
    classes = stored(slim.groupBy("fp").agg(F.min(row).alias("least")), "classes")
    components = connected_components(fingerprint_links(classes, "fp", contract.get("max_distance", MAX_DISTANCE)), "a", "b")
    placed = classes.join(components, classes["fp"] == components["node"], "left")
    least = placed.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("least").alias("least"))
    stay = least.select(F.col("least.key").alias(key), F.col("least.digest").alias(digest))
    once = Window.partitionBy(key, digest).orderBy(F.lit(1))
    kept = docs.withColumns(told).join(stay.hint("merge"), [key, digest], "left_semi")
    return kept.withColumn(rank, F.row_number().over(once)).filter(F.col(rank) == 1).select(docs.columns)
