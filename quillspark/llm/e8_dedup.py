"""Embedding near-dedup (operator 7): lattice hashing with E8.

Each table projects unit vectors to eight random dimensions and decodes them to the nearest point of the
E8 lattice.  A vector is stored in its own cell and looks also into neighbouring cells, those of the
lattice's minimal vectors that come nearest to it.  Pairs that meet are thinned out by a
bit sketch and verified by cosine in double precision.  A row carries its own cells of all tables, so a pair that has some in common
is verified in the first of these, where both vectors lie, and nowhere else: no row is made of it.  Pairs that meet in a neighbouring
cell alone, a few hundredths, are joined to their vectors.

Equal vectors form one class with a count, so copies are never paired with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, settle, width

COSINE = 0.95
TABLES = 8
PROBES = 6
#: Length of the cell's unit after projection: unit vectors at cosine 0.95 are 0.32 apart.  At this length 97 % of
#: pairs at cosine 0.95 itself meet in one of the tables, and more of nearer ones.
CELL = 0.8
SEED = 8
#: Vectors whose links a task counts before it tells them.
TOLD = 1 << 18
SKETCH_BITS = 256
#: Bits of the sketch in which a pair may differ: 26 expected at cosine 0.95, deviation 5.
SKETCH_MOST = 64
#: Rows of a cell compared at once, and pairs of them verified at once.
BLOCK = 2048
PAIRS = 1 << 14
#: Stored rows of a cell that one task holds; a cell with more is dealt in parts of about so many.
PART_ROWS = 1 << 14


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-1, 1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with integer coordinates of even sum."""
    y = np.rint(x)
    off = x - y
    odd = np.flatnonzero(y.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    y[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return y


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: of D8 and of D8 moved by a half."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


class Hasher:
    """Projections of all tables for vectors of one dimension."""

    def __init__(self, dim: int, tables: int, probes: int):
        draw = np.random.default_rng([SEED, dim])
        self.planes = draw.normal(size=(tables, dim, 8)) / CELL
        self.shift = draw.uniform(-1, 1, size=(tables, 8))
        self.sketch = draw.normal(size=(dim, SKETCH_BITS))
        self.odd = draw.integers(1, 2**63, size=8, dtype=np.int64).view(np.uint64) | np.uint64(1)
        self.minimal, self.probes = minimal_vectors(), probes

    def key(self, table: int, points: np.ndarray) -> np.ndarray:
        twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
        h = (twice * self.odd).sum(axis=1, dtype=np.uint64) + np.uint64((table + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        return (h ^ (h >> np.uint64(27))).view(np.int64)

    def cells(self, unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each table the own cell's keys, and the keys of neighbouring cells (a column for each)."""
        for t in range(len(self.planes)):
            x = unit @ self.planes[t] + self.shift[t]
            own = nearest_e8(x)
            if not self.probes:
                yield self.key(t, own), np.empty((len(x), 0), np.int64)
                continue
            toward = (x - own) @ self.minimal.T
            best = np.argpartition(-toward, self.probes, axis=1)[:, : self.probes]
            near = [self.key(t, own + self.minimal[best[:, j]]) for j in range(self.probes)]
            yield self.key(t, own), np.stack(near, axis=1)

    def bits(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits(unit @ self.sketch > 0, axis=1)


def byte_strings(rows: np.ndarray) -> pa.Array:
    """Each row's bytes, as an array of byte strings."""
    n, size = len(rows), rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(size)), pa.py_buffer(np.ascontiguousarray(rows))])


def numbers(column: pa.Array, dtype) -> np.ndarray:
    """byte_strings() back: one row for each byte string, all of one length."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(dtype).reshape(len(column), -1)


def hashed_columns(kind: str) -> str:
    """Of hash_classes(): cells holds 32 bits of the own cells of all tables, nth is the table; rows that only look have no vector."""
    return f"key long, looks boolean, id long, sketch binary, cells binary, nth byte, copies long, v array<{kind}>"


def hash_classes(batches: Iterator[pa.RecordBatch], tables: int, probes: int) -> Iterator[pa.RecordBatch]:
    """From (id, vector, copies): a row for the own cell of each table, where the vector is stored, and one for each cell that it looks into."""
    hashers: dict[int, Hasher] = {}
    for batch in batches:
        ids, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
        by_dim: dict[int, list[int]] = {}
        vectors = [np.asarray(v.values) for v in batch.column(1)]
        for i, v in enumerate(vectors):
            by_dim.setdefault(len(v), []).append(i)
        for dim, rows in by_dim.items():
            h = hashers.setdefault(dim, Hasher(dim, tables, probes))
            raw = np.stack([vectors[i] for i in rows])
            x = raw.astype(np.float64)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            sketch = h.bits(unit)
            cells = list(h.cells(unit))
            owns = np.stack([own for own, _ in cells], axis=1).astype(np.uint32)
            offsets, n = np.arange(len(rows) + 1, dtype=np.int32) * dim, len(rows)
            for nth, (own, near) in enumerate(cells):
                key = np.concatenate([own, near.T.reshape(-1)])
                looks = np.r_[np.zeros(n, bool), np.ones(near.size, bool)]
                times = 1 + near.shape[1]
                stored = pa.ListArray.from_arrays(np.r_[offsets, np.full(near.size, offsets[-1], np.int32)], raw.reshape(-1), mask=pa.array(looks))
                columns = [pa.array(key), pa.array(looks), pa.array(np.tile(ids[rows], times)), byte_strings(np.tile(sketch, (times, 1))), byte_strings(np.tile(owns, (times, 1))), pa.array(np.full(len(key), nth, np.int8)), pa.array(np.tile(copies[rows], times)), stored]
                yield pa.RecordBatch.from_arrays(columns, ["key", "looks", "id", "sketch", "cells", "nth", "copies", "v"])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, in double precision."""
    x, y = (v.astype(np.float64) for v in (x, y))
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    dot = lambda p, q: np.einsum("ij,ij->i", p, q)
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


class Links:
    """What verified links come to: rows (a, a, n) tell that a is linked to n vectors more, rows (a, b, 0) that a hangs together with b, the least vector
    of those that the links seen here join.  Links themselves, whose number may grow as the square of a cluster, are not told one by one,
    and tasks that see parts of one cluster tell much the same rows.
    """

    def __init__(self) -> None:
        self.counts: dict[int, int] = {}
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    def add(self, a: np.ndarray, b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray) -> None:
        counts = self.counts
        for x, y, n, m in zip(a.tolist(), b.tolist(), copies_a.tolist(), copies_b.tolist()):
            counts[x] = counts.get(x, 0) + m
            counts[y] = counts.get(y, 0) + n
            x, y = self.root(x), self.root(y)
            if x != y:
                self.above[max(x, y)] = min(x, y)

    def rows(self) -> tuple[list[int], list[int], list[int]]:
        ids, a = list(self.counts), list(self.above)
        out = ids + a, ids + [self.root(x) for x in a], list(self.counts.values()) + [0] * len(a)
        self.counts, self.above = {}, {}
        return out


TOLD_ROWS = "a long, b long, n long"


def told_rows(a: list[int], b: list[int], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])


@dataclass
class Rows:
    """Rows of one cell: ids, sketches, own cells, tables, copies, and the vectors of those that have one (as many columns as they are long)."""

    ids: np.ndarray
    sketch: np.ndarray
    cells: np.ndarray
    nth: np.ndarray
    copies: np.ndarray
    v: np.ndarray | None

    def part(self, a: int, b: int) -> Rows:
        return Rows(*(x if x is None else x[a:b] for x in (self.ids, self.sketch, self.cells, self.nth, self.copies, self.v)))


def meet(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """From rows in the order of (key, looks): Links, and rows (a, b, -1) of pairs that are still to be verified.

    Pairs in a cell whose sketches are near are looked at.  One with a common own cell is verified where both are stored, in the first such
    cell; one without is told, wherever it meets.  A part's stored rows are held; those that look into it are compared as they come.
    """
    at: int | None = None
    stored: list[Rows] = []
    links = Links()

    def compared(x: Rows, y: Rows, found: list) -> None:
        far = np.bitwise_count(x.sketch[:, None, :] ^ y.sketch[None, :, :]).sum(axis=2, dtype=np.uint16)
        i, j = np.nonzero(far <= SKETCH_MOST)
        i, j = (k[x.ids[i] != y.ids[j]] for k in (i, j))
        for lo in range(0, len(i), PAIRS):
            p, q = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
            common = x.cells[p] == y.cells[q]
            some = common.any(axis=1)
            found.append(np.stack([x.ids[p[~some]], y.ids[q[~some]]]))
            if x.v is None or y.v is None or x.v.shape[1] != y.v.shape[1]:
                continue
            # the first of the common own cells is the one for this pair; both are stored there
            here = some & (common.argmax(axis=1) == x.nth[p])
            p, q = p[here], q[here]
            near = cosines(x.v[p], y.v[q]) >= cosine
            links.add(x.ids[p[near]], y.ids[q[near]], x.copies[p[near]], y.copies[q[near]])

    for batch in batches:
        key, looks, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(key):
            continue
        sketch, cells = numbers(batch.column(3), np.uint64), numbers(batch.column(4), np.uint32)
        nth, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (5, 6))
        sizes = batch.column(7).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        values, begins = batch.column(7).flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
        # stretches of one cell, of rows that look or don't, with vectors of one length or none
        turns = (key[1:] != key[:-1]) | (looks[1:] != looks[:-1]) | (sizes[1:] != sizes[:-1])
        cuts = np.flatnonzero(np.r_[True, turns, True])
        alone = np.r_[True, key[1:] != key[:-1], True]
        found: list[np.ndarray] = [np.empty((2, 0), np.int64)]
        for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
            if key[lo] != at:
                at, stored = int(key[lo]), []
            if looks[lo] and not stored:
                continue
            size = int(sizes[lo])
            v = values[begins[lo] : begins[lo] + size * (hi - lo)].reshape(hi - lo, size) if size else None
            rows = Rows(ids[lo:hi], sketch[lo:hi], cells[lo:hi], nth[lo:hi], copies[lo:hi], v)
            if not looks[lo]:
                stored.append(rows)
                if len(stored) == 1 and hi - lo == 1 and alone[lo] and alone[hi] and hi < len(key):
                    continue  # one row by itself, as most are
            for a in range(0, hi - lo, BLOCK):
                some = rows.part(a, a + BLOCK)
                for other in stored:
                    # stored rows meet each other once: those of a stretch those before them
                    most = a + BLOCK if other is rows else len(other.ids)
                    for c in range(0, most, BLOCK):
                        block = other.part(c, min(c + BLOCK, most))
                        if other is rows and c == a:
                            within(some, compared, found)
                        elif len(block.ids):
                            compared(some, block, found)
        pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
        yield told_rows(pairs[0].tolist(), pairs[1].tolist(), [-1] * pairs.shape[1])
        if len(links.counts) > TOLD:
            yield told_rows(*links.rows())
    yield told_rows(*links.rows())


def within(rows: Rows, compared, found: list) -> None:
    """The pairs of one block, each once: halves against each other, down to single rows."""
    stack = [(0, len(rows.ids))]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        mid = (a + b) // 2
        compared(rows.part(mid, b), rows.part(a, mid), found)
        stack += [(a, mid), (mid, b)]


def verified(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """From pairs (a, b, ca, cb, va, vb) with the copies and vectors of both: Links."""
    links = Links()
    for batch in batches:
        a, b, ca, cb = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        x, y = batch.column(4), batch.column(5)
        n, m = (v.value_lengths().to_numpy(zero_copy_only=False) for v in (x, y))
        for dim in np.unique(n[n == m]).tolist():
            rows = np.flatnonzero((n == dim) & (m == dim))
            near = rows[cosines(*(v.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) for v in (x, y))) >= cosine]
            links.add(a[near], b[near], ca[near], cb[near])
        if len(links.counts) > TOLD:
            yield told_rows(*links.rows())
    yield told_rows(*links.rows())


def in_parts(points: DataFrame, tables: int, probes: int) -> DataFrame:
    """hash_classes() of (id, v, copies), with cells of over PART_ROWS stored rows dealt in parts.

    A part stores some of a cell's rows; all that look into the cell look into each part, and a stored row looks
    into the parts after its own, so a pair still meets, and stored rows meet once.
    """
    columns = hashed_columns(dict(points.dtypes)["v"][6:-1])
    hashed = points.mapInArrow(lambda it: hash_classes(it, tables, probes), columns)
    stored = points.mapInArrow(lambda it: hash_classes(it, tables, 0), columns)
    hot = settle(stored.groupBy("key").count().where(F.col("count") > PART_ROWS).select("key", F.ceil(F.col("count") / PART_ROWS).alias("parts")))
    if hot.isEmpty():
        return hashed
    own = F.when(~F.col("looks"), F.pmod(F.xxhash64("id"), F.col("parts")))
    dealt = hashed.join(hot, "key", "left").withColumn("own", own)
    # the parts from a stored row's own on, or all
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.coalesce("own", F.lit(0).cast("long")), F.col("parts") - 1))))
    looks = F.col("looks") | (F.col("parts").isNotNull() & (F.col("part") > F.col("own")))
    return dealt.select(F.when(F.col("parts").isNull(), F.col("key")).otherwise(F.xxhash64("key", "part")).alias("key"), looks.alias("looks"), "id", "sketch", "cells", "nth", "copies", "v")


def dedup_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row, linked at cosine >= `cosine`.

    n_links counts the other vectors linked directly, copies included; component_id is the least id
    reachable, the own id without links; kept marks the row that has its component's id.  Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing; vectors of different length do not
    link.  Repeated rows (same id and vector) count as vectors of their own.  A null id keeps its row,
    with its links but a null component if alone.  Ties at the threshold are links.  An empty table gives an empty
    one; extra columns, whatever their names, are not read.

    Links are found by hashing: `tables` and `probes` set the recall (measured in the tests against
    brute force), and every link reported is verified.
    """
    n = width(vectors.sparkSession)
    v = F.col("v")
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # vectors of floats travel as such, which is half as much, and are doubles where they are reckoned with
    kind = "float" if vectors.select(F.col(vector_col)).dtypes[0][1] == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    # -0.0 and 0.0 are one value
    rows = rows.select("id", F.when(F.coalesce(usable, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0).cast(kind))).alias("v"))
    rows = settle(rows.select("id", "v", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256)).alias("h")))
    classes = settle(rows.where("h is not null").groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")).where("rep is not null"))
    points = classes.select(F.col("rep").alias("id"), "v", "copies")
    cells = in_parts(points, tables, probes).repartition(n, "key").sortWithinPartitions("key", "looks")
    met = settle(cells.mapInArrow(lambda it: meet(it, cosine), TOLD_ROWS))
    one = met.where("n < 0").select("a", "b").distinct().join(points.toDF("a", "va", "ca"), "a")
    two = one.join(points.toDF("b", "vb", "cb"), "b").select("a", "b", "ca", "cb", "va", "vb")
    links = met.where("n >= 0").unionByName(settle(two.mapInArrow(lambda it: verified(it, cosine), TOLD_ROWS)))
    linked = components(links.where("n = 0").select("a", "b"))
    beyond = links.where("n > 0").groupBy("a").agg(F.sum("n").alias("beyond"))
    named = classes.join(linked, classes["rep"] == linked["node"], "left").join(beyond, classes["rep"] == beyond["a"], "left")
    named = named.select("h", (F.col("copies") - 1 + F.coalesce("beyond", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    out = rows.select("id", "h").join(named, "h", "left")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component_id"), F.coalesce(F.coalesce("c", "id") == F.col("id"), F.lit(False)).alias("kept"))
