"""The prefix trie of conversations, built in shards as balanced parentheses.

A conversation is a path of turns; equal beginnings share nodes. Paths are sorted over the cluster, so each shard (a bounded
run of them) holds a contiguous piece of the trie. A shard's piece is a string of parentheses in depth-first order: the
place where a node's parenthesis closes, found through blocks of least and greatest excess, delimits its subtree; ranks of
leaf pairs ``()`` count leaves, and differences of cumulative arrays give members and savings.

Nodes on a shard's first or last path may go on in a neighbouring shard; all others are done. Those two paths, the spines,
carry for each of their nodes what the shard knows of it (members, smallest member, children and subtree sums of the nodes
that are done), and are themselves sorted paths: they are merged by the same code, with ever fewer shards, until one holds
them all.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, ranked, stored

WIDTH = 16
SHARD_NODES = 1 << 16
LEAST_PATHS = 64
SHARED = 9
GROUP = 5

_ROW = "path binary, member long, sizes array<long>"
_KNOWN = ("members", "least", "children", "leaves", "saved", "ends")
_SPINE = "path binary, sizes array<long>, " + ", ".join(f"{c} array<long>" for c in _KNOWN)
_NODE = (
    "conv_id long, depth long, key binary, parent_key binary, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, has_ends boolean"
)


class Parentheses:
    """A balanced string, 1 for an opening and 0 for a closing parenthesis, with blocks of least and greatest excess."""

    def __init__(self, bits: np.ndarray, block: int = 256, group: int = 64):
        self.block, self.group = block, group
        self.opened = np.cumsum(bits)
        self.excess = 2 * self.opened - np.arange(1, len(bits) + 1)
        cuts = np.arange(0, len(bits), block)
        self.low, self.high = np.minimum.reduceat(self.excess, cuts), np.maximum.reduceat(self.excess, cuts)
        cuts = np.arange(0, len(self.low), group)
        self.group_low, self.group_high = np.minimum.reduceat(self.low, cuts), np.maximum.reduceat(self.high, cuts)
        self.opens = np.flatnonzero(bits)
        pairs = np.zeros(len(bits), dtype=bool)
        pairs[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.leaf = pairs[self.opens]

    @staticmethod
    def _first(low: np.ndarray, high: np.ndarray, start: int, stop: int, target: int) -> int:
        hit = (low[start:stop] <= target) & (high[start:stop] >= target)
        at = int(hit.argmax()) if stop > start else 0
        return start + at if stop > start and hit[at] else -1

    def findclose(self, at: int) -> int:
        """Where the parenthesis that opens at ``at`` closes: the next place with one excess less."""
        target = int(self.excess[at]) - 1
        here = at // self.block
        found = self._first(self.excess, self.excess, at + 1, min((here + 1) * self.block, len(self.excess)), target)
        if found >= 0:
            return found
        own = here // self.group
        block = self._first(self.low, self.high, here + 1, min((own + 1) * self.group, len(self.low)), target)
        if block < 0:
            beyond = self._first(self.group_low, self.group_high, own + 1, len(self.group_low), target)
            block = self._first(self.low, self.high, beyond * self.group, min((beyond + 1) * self.group, len(self.low)), target)
        return self._first(self.excess, self.excess, block * self.block, min((block + 1) * self.block, len(self.excess)), target)

    def last_inside(self) -> np.ndarray:
        """Per node in depth-first order, the number of nodes up to the end of its subtree."""
        ends = np.arange(1, len(self.opens) + 1)
        for node in np.flatnonzero(~self.leaf):
            ends[node] = self.opened[self.findclose(int(self.opens[node]))]
        return ends


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[: middle * WIDTH] == b[: middle * WIDTH] else (low, middle)
    return low


class Shard:
    """A contiguous piece of the trie, fed with sorted paths."""

    def __init__(self, first_path: bytes):
        self.first_path = first_path
        self.bits: list[int] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.size: list[int] = []
        self.key: list[bytes] = []
        self.ends: list[int] = []
        self.own: list[int | None] = []
        self.known = {c: {} for c in _KNOWN}
        self.paths = 0
        self.path: bytes | None = None
        self.first_end, self.stack, self.hashes = 0, [], []
        self._open(0, sha256())

    def _open(self, size: int, state) -> None:
        node = len(self.depth)
        self.bits.append(1)
        self.depth.append(len(self.stack))
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.size.append(size)
        self.key.append(state.digest())
        self.ends.append(0)
        self.own.append(None)
        self.stack.append(node)
        self.hashes.append(state)

    def add(self, path: bytes, sizes: list[int], member: int | None = None, known: dict[str, list] | None = None) -> None:
        """A path that ends at one more member, or one whose nodes something is known of already."""
        if path != self.path:
            same = _common(path, self.path) if self.path is not None else 0
            while len(self.stack) > same + 1:
                self.bits.append(0)
                self.stack.pop()
                self.hashes.pop()
            for d in range(same, len(path) // WIDTH):
                state = self.hashes[-1].copy()
                state.update(path[d * WIDTH : (d + 1) * WIDTH])
                self._open(sizes[d], state)
            self.paths += 1
            if self.path is None:
                self.first_end = self.stack[-1]
            self.path = path
        if member is not None:
            node = self.stack[-1]
            self.ends[node] += 1
            self.own[node] = member if self.own[node] is None else min(self.own[node], member)
        for name, values in (known or {}).items():
            column = self.known[name]
            for node, value in zip(self.stack, values, strict=True):
                if value is not None:
                    old = column.get(node)
                    column[node] = value if old is None else min(old, value) if name == "least" else old + value

    def _column(self, name: str) -> np.ndarray:
        out = np.zeros(len(self.depth), dtype=np.int64)
        if self.known[name]:
            out[list(self.known[name])] = list(self.known[name].values())
        return out

    def _up(self, node: int) -> list[int]:
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]

    def finish(self, whole: bool) -> tuple[list[tuple], list[dict]]:
        """Rows of the nodes that are done, and the spines (none if the shard is the whole trie)."""
        last = self._up(self.stack[-1])
        first = self._up(self.first_end)
        string = Parentheses(np.array(self.bits + [0] * len(self.stack), dtype=np.int64))
        n = len(self.depth)
        parent, size = np.array(self.parent), np.array(self.size, dtype=np.int64)
        start, stop = np.arange(n), string.last_inside()

        def inside(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[stop] - total[start]

        spine = np.zeros(n, dtype=bool)
        if not whole:
            spine[first] = spine[last] = True
        ends = np.array(self.ends, dtype=np.int64)
        members = inside(ends) + self._column("members")
        all_ends = ends + self._column("ends")
        below = self._column("children")
        least = list(self.own)
        for node, value in self.known["least"].items():
            least[node] = value if least[node] is None else min(least[node], value)
        for node in range(n - 1, 0, -1):
            up = self.parent[node]
            if least[node] is not None and (least[up] is None or least[node] < least[up]):
                least[up] = least[node]
        done = ~spine
        children = below + np.bincount(parent[1:][done[1:]], minlength=n)
        leaf = string.leaf & (below == 0) & done
        leaves = inside(leaf.astype(np.int64)) + self._column("leaves")
        own_savings = np.where(done, (members - 1) * size, 0)
        saved = inside(own_savings) + self._column("saved")
        has_known = bool(self.known["members"])

        rows = []
        for node in np.flatnonzero(done).tolist():
            up = self.parent[node]
            open_parent = up >= 0 and spine[up]
            rows.append((
                least[node], self.depth[node], self.key[node] if has_known or all_ends[node] else None, self.key[up] if open_parent else None,
                least[up] if up >= 0 and not open_parent else None, int(members[node]), int(children[node]), int(leaves[node]), int(saved[node]),
                bool(all_ends[node]),
            ))
        if whole:
            return rows, []
        told: set[int] = set()
        spines = []
        for nodes, path in ((first, self.first_path), (last, self.path)):
            fresh = [node not in told for node in nodes]
            columns = {"members": members, "least": least, "children": children, "leaves": leaves, "saved": saved, "ends": all_ends}
            spines.append(
                {"path": path, "sizes": [int(size[x]) for x in nodes[1:]]}
                | {c: [None if not new or v[x] is None else int(v[x]) for x, new in zip(nodes, fresh, strict=True)] for c, v in columns.items()}
            )
            told.update(nodes)
            if first == last:
                break
        return rows, spines


def _build(rows: DataFrame, whole: bool, shard_nodes: int, least_paths: int) -> DataFrame:
    """``rows`` (sorted within range partitions) to rows of either kind: ``node`` structs and ``spine`` structs."""
    of_members = "member" in rows.columns
    schema = f"node struct<{', '.join(x.replace(' ', ': ', 1) for x in _NODE.split(', '))}>, spine struct<{', '.join(x.replace(' ', ': ', 1) for x in _SPINE.split(', '))}>"
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    node_names, node_kinds = zip(*[(n, kinds[k]) for n, k in (x.split() for x in _NODE.split(", "))], strict=True)
    spine_type = pa.struct([(n, kinds[k]) for n, k in (x.split() for x in _SPINE.split(", "))])
    node_type = pa.struct(list(zip(node_names, node_kinds, strict=True)))

    def batch_of(nodes: list[tuple], spines: list[dict]) -> pa.RecordBatch:
        columns = zip(*nodes, strict=True) if nodes else [()] * len(node_names)
        made = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, node_kinds, strict=True)], names=list(node_names))
        made = pa.concat_arrays([made.cast(node_type), pa.nulls(len(spines), node_type)])
        return pa.RecordBatch.from_arrays([made, pa.concat_arrays([pa.nulls(len(nodes), spine_type), pa.array(spines, spine_type)])], names=["node", "spine"])

    def close(shard: Shard) -> Iterator[pa.RecordBatch]:
        nodes, spines = shard.finish(whole)
        for at in range(0, len(nodes), 10_000):
            yield batch_of(nodes[at : at + 10_000], [])
        if spines:
            yield batch_of([], spines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
                if shard is not None and not whole and len(shard.depth) >= shard_nodes and shard.paths >= least_paths:
                    yield from close(shard)
                    shard = None
                if shard is None:
                    shard = Shard(row["path"])
                if of_members:
                    shard.add(row["path"], row["sizes"], row["member"])
                else:
                    shard.add(row["path"], row["sizes"], known={c: row[c] for c in _KNOWN})
        if shard is not None:
            yield from close(shard)

    return arrow(rows, run, schema)


def _end_digests(paths: DataFrame) -> DataFrame:
    """``key, ends_sha256``: per distinct path the SHA-256 of its members' numbers, ascending and comma-joined.

    A digest is serial by nature, so a path's numbers pass through one task; they are streamed, sorted and spilled by Spark.
    """
    slim = paths.select(F.unhex(F.sha2("path", 256)).alias("key"), "member")
    placed = slim.repartition("key").sortWithinPartitions("key", "member")
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for k, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if state is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = k, sha256(str(member).encode())
                else:
                    state.update(f",{member}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    return arrow(placed, run, "key binary, ends_sha256 string")


def rebuilt(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """``path, member, sizes`` per conversation after its beginning is replaced by that of its group's first one.

    Conversation c begins with the first h turns of conversation c - c % ``group`` (none if there is none, all if it has
    fewer) and goes on with its own turns after its first h, h being the CRC-32 of c's digits modulo ``shared``. ``path``
    is 16 bytes per turn that digest role and text, ``sizes`` the texts' UTF-8 bytes. Turns stand by ``turn``, NULL first,
    equal ones by their digest; NULL roles and texts are empty; rows without ``conv_id`` belong to no conversation.
    A conversation's path and sizes (24 bytes a turn) are one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
    )
    turns = stored(ranked(turns, "conv", ["turn", "digest"], "turns").select("conv", "position", "digest", "size"), "numbered")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    heads = turns.filter("position = 0").select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), h.alias("h"))
    starts = turns.filter((F.col("position") < shared - 1) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
    begun = heads.join(starts, "base").filter("position < h").select("conv", "position", "digest", "size")
    own = turns.filter(F.col("position") >= h).select("conv", "position", "digest", "size")
    # a row before all others keeps conversations that have no turn left
    mark = heads.select("conv", F.lit(-1).cast("long").alias("position"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("size"))
    every = own.unionByName(begun).unionByName(mark)
    whole = every.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("position", "digest", "size"))).alias("turns"))
    return whole.select(
        F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path"),
        F.col("conv").alias("member"),
        F.slice("turns.size", F.lit(2), F.size("turns") - 1).alias("sizes"),
    )


def trie(paths: DataFrame, shard_nodes: int = SHARD_NODES, least_paths: int = LEAST_PATHS) -> DataFrame:
    """A row per node of the trie of ``path, member, sizes`` rows (a member per row).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (childless nodes of its subtree), ``saved_tokens`` (over its subtree, members but one times the size of the
    last turn) and ``ends_sha256`` (of the members that end here). The root, without a turn, is there if any path is.

    A shard closes at ``shard_nodes`` nodes, but not before it has ``least_paths`` different paths, so that the spines, two
    paths of each shard, become fewer from level to level; a task holds four times as many of the longest paths at most.
    """
    if least_paths < 4:
        raise ValueError("with fewer than four paths a shard the spines would not become fewer")
    paths = stored(paths, "paths")
    level, rows, done, later = 1, paths, [], []
    before = partitions = None
    while True:
        whole = False
        if level > 1:
            count = rows.agg(F.count("*").alias("paths"), F.sum(F.size("sizes") + 1).alias("nodes")).first()
            if not count["paths"]:
                break
            whole = count["nodes"] <= shard_nodes or count["paths"] <= 4 * least_paths
            if before is not None and count["paths"] >= before:
                raise RuntimeError(f"{count['paths']} spines after {before}")
            before, partitions = count["paths"], max(2, count["paths"] // (16 * least_paths))
        order = ["path", "member"] if level == 1 else ["path"]
        if whole:
            placed = rows.coalesce(1)
        else:
            placed = rows.repartitionByRange(*([partitions] if partitions else []), *order)
        built = stored(_build(placed.sortWithinPartitions(*order), whole, shard_nodes, least_paths), "shards")
        done.append(built.filter("node is not null").select("node.*"))
        if level > 1:
            later.append(done[-1].select("key", F.col("conv_id").alias("parent")))
        if whole:
            break
        rows = built.filter("spine is not null").select("spine.*")
        level += 1

    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    if later:
        known = later[0]
        for more in later[1:]:
            known = known.unionByName(more)
        found = nodes.filter("parent_key is not null").join(known.withColumnRenamed("key", "parent_key"), "parent_key")
        found = found.withColumn("parent_conv_id", F.col("parent")).select(nodes.columns)
        nodes = nodes.filter("parent_key is null").unionByName(found)
    nodes = stored(nodes, "nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ended = nodes.filter("has_ends").join(_end_digests(paths), "key").select(columns)
    passed = nodes.filter("not has_ends").withColumn("ends_sha256", F.lit(sha256().hexdigest())).select(columns)
    return ended.unionByName(passed)


def prefix_trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED, **shards: int) -> DataFrame:
    """The trie of the ``rebuilt`` conversations; an empty table gives no node, extra columns are ignored."""
    return trie(rebuilt(conversations, group, shared), **shards)
