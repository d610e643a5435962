"""A Merkle manifest of a dataset: every row's leaf, its proof up to the root, and whether a row still fits the root.

A row's leaf digests its columns. Leaves of one group (a source) form a tree in id order, in runs of ``ARITY``; the groups'
roots, in group order, form another one. A superblock is what ``levels`` rounds of runs make one node of: ``ARITY ** levels``
consecutive nodes. On the way up, each superblock is reduced to its node, and those nodes are the leaves of the next,
far smaller layer. On the way down, a superblock's nodes are cogrouped with the outer nodes that it needs (the siblings
above it), and one function reduces it again, joins inner and outer siblings to each node's proof and folds the proof.
So no task sees more than one superblock, whatever the size of a group, and nothing but the size of the largest group
reaches the driver.
"""

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, lower_ascii, ranked, ship, stored

ARITY = 16
LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def depth(total: int) -> int:
    """Rounds of runs that leave one of ``total`` nodes."""
    rounds = 0
    while ARITY**rounds < total:
        rounds += 1
    return rounds


def _rounds(nodes: list[str], total: int, levels: int) -> list[list[str]]:
    """The nodes of a superblock level by level, from its own to the one that is left of it."""
    out = [nodes]
    for _ in range(min(levels, depth(total))):
        nodes = [_hash("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
        out.append(nodes)
    return out


def _siblings(rounds: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """Per level and node, the digests to its left and to its right in its run, as texts."""
    out = []
    for nodes in rounds[:-1]:
        left, right = [], []
        for i in range(len(nodes)):
            start = i - i % ARITY
            left.append("".join(nodes[start:i]))
            right.append("".join(nodes[i + 1 : start + ARITY]))
        out.append((left, right))
    return out


def _above(nodes: DataFrame, levels: int) -> DataFrame:
    """The layer of the superblocks' nodes: ``tree, position, total, digest``."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        total = int(block["total"].iloc[0])
        (node,) = _rounds(list(block["digest"]), total, levels)[-1]
        at = int(block["position"].iloc[0]) // ARITY**levels
        return pd.DataFrame({"tree": [block["tree"].iloc[0]], "position": [at], "total": [-(-total // ARITY**levels)], "digest": [node]})

    block = F.expr(f"position div {ARITY**levels}").alias("block")
    slim = nodes.select("tree", "position", "total", "digest", block)
    return slim.groupBy("tree", "block").applyInPandas(reduce, "tree string, position long, total long, digest string")


PATH = "lefts array<string>, rights array<string>"


def _climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The layers of all trees, lowest first, and the trees' roots: ``tree, digest``."""
    layers = [nodes]
    while (layers[-1].agg(F.max("total")).first()[0] or 0) > ARITY**levels:
        layers.append(stored(_above(layers[-1], levels), "superblocks"))
    return layers, stored(_above(layers[-1], levels).select("tree", "digest"), "roots")


def _exchange(nodes: DataFrame, outer: DataFrame, levels: int, finish, schema: str) -> DataFrame:
    """``finish`` over each superblock of ``nodes`` cogrouped with its one row of ``outer`` (``tree, block, lefts, rights``
    and more), given the block, its inner siblings per level and the outer row."""

    def work(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position").reset_index(drop=True)
        rounds = _rounds(list(block["digest"]), int(block["total"].iloc[0]), levels)
        return finish(block, _siblings(rounds), above.iloc[0])

    spread = nodes.withColumn("block", F.expr(f"position div {ARITY**levels}"))
    return spread.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(work, schema)


def _path(i: int, siblings: list, above: pd.Series) -> tuple[list[str], list[str]]:
    """Digests left and right of node ``i`` on its way to the root, level by level."""
    lefts = [left[i // ARITY**k] for k, (left, _) in enumerate(siblings)]
    rights = [right[i // ARITY**k] for k, (_, right) in enumerate(siblings)]
    return lefts + list(above["lefts"]), rights + list(above["rights"])


def _descend(layers: list[DataFrame], outer: DataFrame, levels: int) -> DataFrame:
    """Outer rows of the lowest layer's superblocks, from those of the topmost layer's."""
    kept = [c for c in outer.columns if c not in ("tree", "block", "lefts", "rights")]

    def paths(block: pd.DataFrame, siblings: list, above: pd.Series) -> pd.DataFrame:
        both = [_path(i, siblings, above) for i in range(len(block))]
        out = {"tree": block["tree"], "block": block["position"], "lefts": [x for x, _ in both], "rights": [x for _, x in both]}
        return pd.DataFrame(out | {c: [above[c]] * len(block) for c in kept})

    schema = f"tree string, block long, {PATH}" + "".join(f", {c} string" for c in kept)
    for nodes in reversed(layers[1:]):
        outer = stored(_exchange(nodes, outer, levels, paths, schema), "paths")
    return outer


def _fold(node: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights, strict=True):
        node = _hash(left + node + right)
    return node


def manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    group: str = "source",
    columns: Sequence[str] = COLUMNS,
    changed: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    ``columns`` enter the leaf in their order; ``changed`` gives what stands in some of them when the rows are verified (a
    tampered or later copy of the data), as it is by default. ``folded_root`` folds the leaf of that with the original
    siblings; ``verified`` says whether it is ``root``. ``proof_sha256`` digests the siblings from the row's run upwards.

    Groups may be NULL (they come first) and of any size. Rows of a group stand by id, NULL ids first, and of equal ids by
    leaf; equal rows each have their own leaf, and any of them may have any of their places. NULL and empty values are
    told apart. Very long texts are digested where they lie; digests alone are shuffled. An empty table gives no row.
    """
    ship(docs.sparkSession)
    changed = changed or {}
    original = leaf([F.col(c) for c in columns])
    later = leaf([changed.get(c, F.col(c)) for c in columns]) if changed else F.lit(None).cast("string")
    name = F.col(group).cast("string")
    tree = F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name))
    slim = docs.select(F.col(id_column).alias("id"), tree.alias("tree"), original.alias("digest"), later.alias("later"))
    slim = slim.withColumn("later", F.when(F.col("later") != F.col("digest"), F.col("later")))
    leaves = ranked(stored(slim, "leaves"), "tree", ["id", "digest"], "ordered").withColumn("id", F.col("id").cast("string"))
    leaves = stored(leaves, "placed")

    layers, subroots = _climb(leaves, levels)
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    named = stored(ranked(named, "tree", ["member"], "groups"), "groups")
    group_layers, top = _climb(named, levels)
    nothing = F.array().cast("array<string>")
    ends = top.select("tree", F.lit(0).cast("long").alias("block"), nothing.alias("lefts"), nothing.alias("rights"), F.col("digest").alias("root"))
    outer = _descend(group_layers, ends, levels)

    def group_paths(block: pd.DataFrame, siblings: list, above: pd.Series) -> pd.DataFrame:
        both = [_path(i, siblings, above) for i in range(len(block))]
        return pd.DataFrame(
            {"tree": block["member"], "block": 0, "lefts": [x for x, _ in both], "rights": [x for _, x in both], "subroot": block["digest"], "root": above["root"]}
        )

    outer = _exchange(named, outer, levels, group_paths, f"tree string, block long, {PATH}, subroot string, root string")
    outer = _descend(layers, stored(outer, "paths"), levels)

    def proofs(block: pd.DataFrame, siblings: list, above: pd.Series) -> pd.DataFrame:
        proof, folded = [], []
        for i, (digest, other) in enumerate(zip(block["digest"], block["later"], strict=True)):
            lefts, rights = _path(i, siblings, above)
            proof.append(_hash("".join(x + y for x, y in zip(lefts, rights, strict=True))))
            folded.append(_fold(other if isinstance(other, str) else digest, lefts, rights))
        out = pd.DataFrame({"id": block["id"], "leaf": block["digest"], "subroot": above["subroot"], "root": above["root"], "proof_sha256": proof})
        out["folded_root"] = folded
        return out

    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    out = _exchange(leaves, outer, levels, proofs, schema)
    kind = docs.schema[id_column].dataType
    (own,) = fresh(out.drop("id"), id_column)
    return out.select(F.col("id").cast(kind).alias(own), *out.columns[1:]).withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_where_crc_divides(id_column: str, text: str, divisor: int = 5) -> Column:
    """The text, with its letters A-Z lower-cased where the unsigned CRC-32 of the decimal id is a multiple of ``divisor``."""
    hit = F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor == 0
    return F.when(hit, lower_ascii(F.col(text))).otherwise(F.col(text))
