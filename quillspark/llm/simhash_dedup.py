"""SimHash near-dedup (operator 5): deletion-variant signatures.

Two 64-bit fingerprints at most 3 bits apart, cut into 2 segments, have a segment that differs in at
most one bit.  A segment is indexed under its 32 variants with one bit replaced by a wildcard, so
such segments share a variant: an equality on (wildcard, variant) finds all candidates, and the
whole fingerprints are then compared.

Only distinct fingerprints are linked, whatever documents they stand for.  In a bucket the
linked ones are told as a spanning forest, not as pairs: a search from member to member compares
each with those not yet reached.  A bucket of more than BUCKET members is dealt again by the
four bytes of the other segment, of which one at least is equal in any pair to be linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, enter, settle, width

SEED = 42
BITS = 3
SHINGLE = 3
#: Members of a bucket from which on it is dealt again by bytes of the other segment.
BUCKET = 4096
#: Shingles whose bits are counted at once.
STRETCH = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit majority of the XXH64 of all word shingles; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words)))
    # a word's end in the joined text: its letters and one space for each word before it
    ends = [e + i for i, e in enumerate(ends)]
    starts = [0, *(e + 1 for e in ends[:-shingle])]
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])), "<u8", n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, STRETCH):
        part = hashes[a : a + STRETCH]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and text_hash (which tells rows of one id apart) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("simhash_dedup")
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), batch.column(2)], ["doc_id", "fp", "text_hash"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"), F.xxhash64(text_col)).mapInArrow(run, "doc_id long, fp long, text_hash long")


def forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Tree edges (positions) of the graph that joins fingerprints at most `bits` apart."""
    left = np.arange(len(fp))
    edges: list[tuple[int, int]] = []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        at = queue.pop()
        near = np.bitwise_count(fp[left] ^ fp[at]) <= bits
        found = left[near]
        edges += [(at, int(x)) for x in found]
        queue += found.tolist()
        left = left[~near]
    return edges


def link_sorted(batches: Iterator[pa.RecordBatch], bits: int, limit: float) -> Iterator[pa.RecordBatch]:
    """From (key, fp, path) in the order of key: edges between fingerprints, and the members of too large buckets."""

    def solved(key: np.ndarray, fp: np.ndarray, path: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits]
        a, b, again = [fp[two]], [fp[two + 1]], [np.empty(0, int)]
        for at in np.flatnonzero(size > 2):
            lo, hi = cut[at], cut[at + 1]
            if hi - lo > limit:
                again.append(np.arange(lo, hi))
            elif edges := forest(fp[lo:hi], bits):
                x = np.array(edges) + lo
                a.append(fp[x[:, 0]])
                b.append(fp[x[:, 1]])
        pairs = np.unique(np.sort(np.stack([np.concatenate(a), np.concatenate(b)]), axis=0), axis=1)
        more, n = np.concatenate(again), pairs.shape[1]
        left, right = np.r_[pairs[0], fp[more]].view(np.int64), np.r_[pairs[1], fp[more]].view(np.int64)
        columns = [left, right, np.r_[np.zeros(n, np.int64), key[more]], np.r_[np.zeros(n, np.int64), path[more]], np.r_[np.zeros(n, bool), np.ones(len(more), bool)]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "key", "path", "again"])

    rest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp, path = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        rest.append((key, fp.view(np.uint64), path))
        if len(rest) > 1 and rest[-2][0][-1] == key[-1]:
            continue
        key, fp, path = (np.concatenate(x) for x in zip(*rest))
        open_at = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
        if open_at:
            yield solved(key[:open_at], fp[:open_at], path[:open_at])
        rest = [(key[open_at:], fp[open_at:], path[open_at:])]
    if rest:
        yield solved(*(np.concatenate(x) for x in zip(*rest)))


LINKS = "a long, b long, key long, path long, again boolean"
#: Parts that the bits of the other segment are cut in when a bucket is dealt again: of four parts with three differing bits at most one is equal.
PARTS = 4
#: How often: 32 bits leave 24, 18, 14 and 11 that may differ, so the last buckets have 2,048 members at most, 4,096 with the wildcard.
DEALS = 4


def masks(path: int, deal: int) -> list[int]:
    """The parts of the bits that are open at this deal, the parts chosen before being the digits of path."""
    left = list(range(32))
    for k in range(deal):
        nth = path // PARTS ** (deal - 1 - k) % PARTS
        left = [b for i, b in enumerate(left) if i % PARTS != nth]
    return [sum(1 << b for i, b in enumerate(left) if i % PARTS == nth) for nth in range(PARTS)]


def near_edges(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) that join all of them at most 3 bits apart."""
    if bits > 3:
        raise ValueError("two segments with one wildcard find pairs of at most 3 differing bits")
    n = width(prints.sparkSession)
    half = F.when(F.col("bit") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    within = F.expr("shiftleft(1L, cast(bit % 32 as int))")
    variant = half.bitwiseAND(F.bitwise_not(within))
    signed = prints.select("fp", F.explode(F.expr("sequence(0L, 63L)")).alias("bit"))
    signed = signed.select(F.expr("shiftleft(bit, 32)").bitwiseOR(variant).alias("key"), "fp", F.lit(0).cast("long").alias("path"))

    def linked(dealt: DataFrame, limit: float) -> DataFrame:
        # a bucket is one sorted stretch of a partition, so a task holds one bucket and not its partition
        return dealt.repartition(n, "key").sortWithinPartitions("key").mapInArrow(lambda it: link_sorted(it, bits, limit), LINKS)

    found = settle(linked(signed, BUCKET))
    edges = found.where("not again").select("a", "b")
    # which segment the signature leaves open; from the second deal on it is in the path, above the digits
    lower = F.shiftrightunsigned("key", 32) >= 32
    again = found.where("again").select("key", F.col("a").alias("fp"), F.when(lower, F.lit(1 << 40)).otherwise(F.lit(0)).cast("long").alias("path"))
    for deal in range(DEALS):
        if again.isEmpty():
            return edges.distinct()
        other = F.when(F.col("path") >= 1 << 40, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
        open_bits = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks(p, deal)]) for p in range(PARTS**deal)])
        parts = again.select("key", "fp", "path", other.alias("other"), F.posexplode(F.get(open_bits, (F.col("path") % F.lit(1 << 40)).cast("int"))).alias("nth", "mask"))
        value = F.xxhash64("key", "nth", F.col("other").bitwiseAND(F.col("mask")))
        digits = F.col("path") % F.lit(1 << 40)
        dealt = parts.select(value.alias("key"), "fp", (F.col("path") - digits + digits * PARTS + F.col("nth")).alias("path"))
        found = linked(dealt, BUCKET if deal + 1 < DEALS else float("inf"))
        if deal + 1 < DEALS:
            found = settle(found)
        edges = edges.unionByName(found.where("not again").select("a", "b"))
        again = found.where("again").select("key", F.col("a").alias("fp"), "path")
    return edges.distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, text_hash, group_id and component_id (least doc_id reachable by links of at most `bits` bits) of each row.

    group_id, the least fingerprint reachable, tells groups apart even where no row has an id.

    Whole texts, A-Z in lower case, words between ASCII white space, shingles of `shingle` words with
    repeats, counted in stretches in very long texts; a shorter text is one shingle; null, empty and blank texts
    have fingerprint 0 and are linked like any other.  Repeated rows keep their rows.  A null doc_id is linked, and
    links others, but is never the least: it is the component only where no other id is.  An empty table gives an
    empty one; extra columns, whatever their names, are not read.
    """
    prints = settle(fingerprints(docs, id_col, text_col, shingle))
    classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(near_edges(classes.select("fp"), bits))
    placed = classes.join(linked, classes["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    # two columns of one plan of the classes: written once
    placed = settle(placed)
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("fp", F.col("component").alias("group_id"), "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "text_hash", "group_id", "component_id")


def fingerprint_hex(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
