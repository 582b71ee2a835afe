"""Conversation prefix trie (operator 13): LCP-aware external mergesort, and a stack of open nodes over the merged stream.

A turn is a token, 16 bytes of a digest of role and text.  A conversation's key is its tokens joined, so keys sort as sequences of
turns, and the longest common prefix (LCP) of two neighbours is the depth of the last node that they share.

1. Each task sorts its conversations in runs, equal ones in one row, each row with the LCP to the row before.  The runs are a
   table in the shared folder.
2. Keys are dealt by ranges.  A task merges the runs of its range by a loser tree that compares LCPs first, and turns only where
   LCPs are equal and from there on: turns that are shared are not looked at again.
3. The merged stream goes over a stack, the nodes of the current path.  A node is finished, and told, when the stream leaves it.
   Nodes on the paths of a range's first and last keys may go on in the ranges beside it.  They are told as parts, and a pass
   over these alone, two paths a range, finishes them by a stack of the same kind.
4. Nodes are told after their children.  Read backwards (a sort inside each task) they come before them and hand on their
   members' least id.

The digests of members' ids are made apart: ids are sorted by node and number over all tasks, however many a node has.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_settled, enter, settle, width

#: Bytes of a turn's token.
TOKEN = 16
#: Rows of a batch that a task gives on.
GIVEN = 4096
EMPTY = hashlib.sha256(b"").hexdigest()
RUNS = {"run": pa.int64(), "nth": pa.int64(), "key": pa.binary(), "chars": pa.binary(), "lcp": pa.int32(), "n": pa.int64(), "low": pa.int64(), "ids": pa.list_(pa.int64())}
NODES = {
    "part": pa.int32(), "nth": pa.int64(), "edge": pa.bool_(), "branch": pa.int32(), "node": pa.binary(), "ended": pa.binary(), "depth": pa.int32(), "chars": pa.int64(),
    "n": pa.int64(), "low": pa.int64(), "children": pa.int64(), "leaves": pa.int64(), "saved": pa.int64(),
}
TOLD = NODES | {"parent_conv_id": pa.int64(), "parent": pa.binary()}
PIECES = {"ended": pa.binary(), "part": pa.int32(), "nth": pa.int64(), "ids": pa.string(), "digest": pa.string()}
NAMES = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int64()): "array<long>"}


@dataclass(frozen=True)
class Sizes:
    """Bounds of memory: bytes of keys sorted or merged at once (beyond it a merging task keeps its runs in a file of its own), rows of such a
    run read at once, turns that ranges are told apart by (keys that agree in so many share a range), ids hashed in one piece.
    """

    run_bytes: int = 1 << 25
    block_rows: int = 256
    range_turns: int = 64
    piece_ids: int = 1 << 16


def ddl(fields: dict) -> str:
    return ", ".join(f"{k} {NAMES[v]}" for k, v in fields.items())


def given(rows: Iterator[tuple], fields: dict) -> Iterator[pa.RecordBatch]:
    """Rows in batches."""

    def batch(some: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), fields.values())], list(fields))

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == GIVEN:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


# sequences


def turn_sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, tokens (array<binary>) and chars (array<long>, code points of the texts) of each conversation, in the order of its turns.

    A null turn comes first; rows of one turn number come in the order of their tokens.  Null role and text are empty.  Rows without a
    conversation id belong to none and are left out.  A conversation is one row, of some 40 bytes a turn whatever its texts.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    token = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, TOKEN)
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), token.alias("token"), F.length(text).cast("long").alias("chars"))
    rows = turns.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), turn.alias("t")).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.col("t.token").alias("tokens"), F.col("t.chars").alias("chars"))


def spliced(sequences: DataFrame, share: int = 100, most: int = 6) -> DataFrame:
    """Sequences that begin with the first h turns of conversation c - c % share (all it has, none if there is none) and go on with c's own turns
    after its first h; h is the CRC-32 of c's digits modulo `most`.
    """
    own = sequences.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")).withColumn("base", F.expr(f"conv_id - conv_id % {share}"))
    bases = sequences.where(f"conv_id % {share} = 0").select(F.col("conv_id").alias("base"), *[F.slice(c, 1, most - 1).alias(f"base_{c}") for c in ("tokens", "chars")])

    def joined(c: str, kind: str):
        head = F.coalesce(F.slice(f"base_{c}", 1, F.col("h")), F.array().cast(f"array<{kind}>"))
        return F.concat(head, F.slice(c, F.col("h") + 1, F.size(c))).alias(c)

    return own.join(bases, "base", "left").select("conv_id", joined("tokens", "binary"), joined("chars", "long"))


# sorted runs and their merge


def shared(a: bytes, b: bytes, depth: int) -> int:
    """Turns that two keys share, known to be `depth` at least."""
    end, at = min(len(a), len(b)), depth * TOKEN
    while at < end and a[at : at + TOKEN] == b[at : at + TOKEN]:
        at += TOKEN
    return at // TOKEN


def sorted_runs(rows: Iterator[tuple], task: int, sizes: Sizes) -> Iterator[tuple]:
    """RUNS of rows (conv_id, tokens, chars): keys rising, equal ones in one row with all their ids."""

    def told(held: list[tuple], run: int) -> Iterator[tuple]:
        held.sort(key=lambda r: (r[0], r[2]))
        before, nth, at = b"", 0, 0
        while at < len(held):
            key, chars, low = held[at]
            end = at + 1
            while end < len(held) and held[end][0] == key:
                end += 1
            yield task << 32 | run, nth, key, chars.tobytes(), shared(before, key, 0), end - at, low, [r[2] for r in held[at:end]]
            before, nth, at = key, nth + 1, end

    held, size, run = [], 0, 0
    for own, tokens, chars in rows:
        held.append((b"".join(tokens), array("I", chars), own))
        size += 10 * TOKEN + 4 * TOKEN * len(tokens)
        if size >= sizes.run_bytes:
            yield from told(held, run)
            held, size, run = [], 0, run + 1
    yield from told(held, run)


class Runs:
    """The runs of one range, fed run after run; beyond `run_bytes` in a file that no one else sees and that is gone with the task."""

    def __init__(self, rows: Iterator[tuple], sizes: Sizes):
        self.blocks: list[list] = []
        self.file, size, last = None, 0, None
        for run, _, *row in rows:
            if run != last:
                self.blocks.append([[]])
                last = run
            elif len(self.blocks[-1][-1]) >= sizes.block_rows:
                self.blocks[-1].append([])
            self.blocks[-1][-1].append(row)
            size += 10 * TOKEN + 2 * len(row[0])
            if size >= sizes.run_bytes:
                self.spill()
                self.blocks[-1].append([])
                size = 0

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for blocks in self.blocks:
            for k, block in enumerate(blocks):
                if not isinstance(block, int):
                    blocks[k] = self.file.seek(0, 2)
                    pickle.dump(block, self.file)

    def readers(self) -> list[Iterator[list]]:
        return [self.read(blocks) for blocks in self.blocks]

    def read(self, blocks: list) -> Iterator[list]:
        for block in blocks:
            if isinstance(block, int):
                self.file.seek(block)
                block = pickle.load(self.file)
            yield from block


def merged(runs: list[Iterator[list]]) -> Iterator[tuple[list, int]]:
    """The rows of all runs by rising keys, each with its LCP to the row before: a tournament tree of losers.

    A run's LCP is that of its head to the row told last.  The head with the longer one is the smaller key; only heads with
    equal ones are compared, behind what they share, and the loser learns its LCP to the winner.
    """
    k = len(runs)
    if not k:
        return
    heads = [next(r, None) for r in runs]
    lcps = [0] * k

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser."""
        a, b = heads[i], heads[j]
        if b is None or a is not None and lcps[i] > lcps[j]:
            return i, j
        if a is None or lcps[i] < lcps[j]:
            return j, i
        depth = shared(a[0], b[0], lcps[i])
        at = depth * TOKEN
        if a[0][at : at + TOKEN] <= b[0][at : at + TOKEN]:
            lcps[j] = depth
            return i, j
        lcps[i] = depth
        return j, i

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if k > 1 else 0
    while heads[best] is not None:
        yield heads[best], lcps[best]
        heads[best] = next(runs[best], None)
        lcps[best] = heads[best][2] if heads[best] is not None else 0
        node = (best + k) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


# nodes


class Node:
    __slots__ = ("branch", "chars", "children", "depth", "edge", "ended", "leaves", "low", "n", "node", "saved")

    def __init__(self, node: bytes, depth: int, chars: int, edge: bool, branch: int = 0):
        self.node, self.depth, self.chars, self.edge, self.branch = node, depth, chars, edge, branch
        self.ended, self.low = None, None
        self.n = self.children = self.leaves = self.saved = 0

    def count(self, n: int, low: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)

    def close(self, parent: Node | None) -> None:
        """All members are counted: the sums over the subtree, handed on to the parent."""
        self.saved += (self.n - 1) * self.chars
        self.leaves = self.leaves or 1
        if parent is not None:
            parent.children += 1
            parent.leaves += self.leaves
            parent.saved += self.saved

    def row(self, part: int, nth: int) -> tuple:
        return part, nth, self.edge, self.branch, self.node, self.ended, self.depth, self.chars, self.n, self.low, self.children, self.leaves, self.saved


def finished_nodes(stream: Iterator[tuple[list, int]], part: int) -> Iterator[tuple]:
    """NODES of a range's merged rows ([key, chars, lcp, n, low], LCP), each when the stream has left it.

    An edge node's children, leaves and saved are those of its finished children that are no edge nodes; n and low are of all members in the range.
    """
    path: list[Node] = []
    nth = 0

    def leave(node: Node) -> tuple:
        nonlocal nth
        parent = path[-1] if path else None
        if not node.edge:
            node.close(parent)
        if parent is not None:
            parent.count(node.n, node.low)
        nth += 1
        return node.row(part, nth)

    first = True
    for (key, chars, _, n, low), lcp in stream:
        while len(path) > lcp + 1:
            yield leave(path.pop())
        if not path:
            path.append(Node(b"", 0, 0, True))
        lengths = memoryview(chars).cast("I")
        for depth in range(len(path), len(key) // TOKEN + 1):
            token = key[(depth - 1) * TOKEN : depth * TOKEN]
            path.append(Node(hashlib.sha256(path[-1].node + token).digest()[:TOKEN], depth, lengths[depth - 1], first))
        path[-1].count(n, low)
        path[-1].ended = path[-1].ended or hashlib.sha256(key).digest()
        first = False
    for node in path:
        node.edge, node.branch = True, node.branch if node.edge else 1
    while path:
        yield leave(path.pop())


def joined_edges(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The edge nodes of all ranges, by range, branch and depth, with their parts put together: NODES, no longer edges."""
    path: list[Node] = []
    nth = 0

    def leave(node: Node) -> tuple:
        nonlocal nth
        node.close(path[-1] if path else None)
        nth += 1
        return node.row(-1, nth)

    for row in rows:
        part = dict(zip(NODES, row))
        at = part["depth"]
        if len(path) <= at or path[at].node != part["node"]:
            while len(path) > at:
                yield leave(path.pop())
            path.append(Node(part["node"], at, part["chars"], False))
        node = path[at]
        node.count(part["n"], part["low"])
        node.ended = node.ended or part["ended"]
        node.children += part["children"]
        node.leaves += part["leaves"]
        node.saved += part["saved"]
    while path:
        yield leave(path.pop())


def with_parents(rows: Iterator[tuple]) -> Iterator[tuple]:
    """TOLD of NODES that come before their children: the parent's least id, or the parent itself where it is an edge node."""
    above: list[tuple] = []
    low, node, edge, depth = (list(NODES).index(c) for c in ("low", "node", "edge", "depth"))
    for row in rows:
        del above[row[depth] :]
        parent = above[-1] if above else None
        yield *row, None if parent is None or parent[edge] else parent[low], parent[node] if parent is not None and parent[edge] else None
        above.append(row)


# digests of ids


def id_pieces(rows: Iterator[tuple], part: int, sizes: Sizes) -> Iterator[tuple]:
    """PIECES of (ended, conv_id) in order: a node's digest where all its ids must be here, else its ids in pieces, in order."""
    last, ids, nth, cut = None, [], 0, True

    def piece() -> tuple:
        nonlocal nth
        nth += 1
        return last, part, nth, ",".join(map(str, ids)), None

    for ended, own in rows:
        if ended != last:
            if last is not None:
                yield piece() if cut else (last, part, 0, None, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            # the first node of a task may have begun in the one before
            last, ids, cut = ended, [], last is None
        elif len(ids) >= sizes.piece_ids:
            yield piece()
            ids, cut = [], True
        ids.append(own)
    if last is not None:
        yield piece()


def piece_digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(ended, digest) of pieces in order; a node's ids go through one hash, piece by piece, as SHA-256 asks for."""
    last, state = None, None
    for ended, ids in rows:
        if ended != last:
            if last is not None:
                yield last, state.hexdigest()
            last, state = ended, hashlib.sha256(ids.encode())
        else:
            state.update(b"," + ids.encode())
    if last is not None:
        yield last, state.hexdigest()


def id_digests(runs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """ended, ends_sha256: of the ids of the conversations that are a node's own sequence, rising, joined by commas."""
    ids = runs.select(F.unhex(F.sha2("key", 256)).alias("ended"), F.explode("ids").alias("conv_id"))
    dealt = ids.repartitionByRange(width(runs.sparkSession), "ended", "conv_id").sortWithinPartitions("ended", "conv_id")
    pieces = settle(dealt.mapInArrow(lambda b: given(id_pieces(rows_of(b), TaskContext.get().partitionId(), sizes), PIECES), ddl(PIECES)))
    cut = pieces.where("ids is not null").repartition("ended").sortWithinPartitions("ended", "part", "nth").select("ended", "ids")
    whole = cut.mapInArrow(lambda b: given(piece_digests(rows_of(b)), {"ended": pa.binary(), "digest": pa.string()}), "ended binary, digest string")
    return pieces.where("digest is not null").select("ended", "digest").unionByName(whole).withColumnRenamed("digest", "ends_sha256")


def prefix_trie(sequences: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """A row for each distinct sequence of first turns of sequences (conv_id, tokens, chars; ids distinct and not null).

    node (a digest of the path; empty for the root), conv_id (least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.  Sequences without turns end at the root.  No sequences: no node.
    """
    spark = sequences.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("conversation_trie")
        return given(sorted_runs(rows_of(batches), TaskContext.get().partitionId(), sizes), RUNS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("conversation_trie")
        return given(finished_nodes(merged(Runs(rows_of(batches), sizes).readers()), TaskContext.get().partitionId()), NODES)

    def parents(nodes: DataFrame) -> DataFrame:
        return nodes.sortWithinPartitions(F.desc("nth")).mapInArrow(lambda b: given(with_parents(rows_of(b)), TOLD), ddl(TOLD))

    runs = settle(sequences.select("conv_id", "tokens", "chars").mapInArrow(run, ddl(RUNS)))
    ranges = runs.drop("ids").repartitionByRange(width(spark), F.substring("key", 1, sizes.range_turns * TOKEN)).sortWithinPartitions("run", "nth")
    nodes = settle(parents(ranges.mapInArrow(merge, ddl(NODES))))
    digests = id_digests(runs, sizes)
    edges = nodes.where("edge").select(*NODES).repartition(1).sortWithinPartitions("part", "branch", "depth")
    edges = settle(parents(edges.mapInArrow(lambda b: given(joined_edges(rows_of(b)), NODES), ddl(NODES))))
    drop_settled(runs)
    inner = nodes.where("not edge")
    lows = edges.select(F.col("node").alias("parent"), F.col("low").alias("parent_low"))
    below = inner.where("parent is not null").join(lows, "parent").withColumn("parent_conv_id", F.col("parent_low"))
    columns = ["node", "ended", "low", "depth", "parent_conv_id", "n", "children", "leaves", "saved"]
    found = inner.where("parent is null").select(columns).unionByName(below.select(columns)).unionByName(edges.select(columns))
    # nodes where no sequence ends look for themselves, so that no key is common
    found = found.withColumn("key", F.coalesce("ended", F.concat(F.lit("node").cast("binary"), "node"))).join(digests.withColumnRenamed("ended", "key"), "key", "left")
    return found.select(
        "node", F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
