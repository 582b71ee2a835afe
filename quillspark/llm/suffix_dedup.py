"""Suffix-array dedup (operator 2): a depth-limited radix sort of suffixes, distributed.

Suffixes are ordered only through the first `WINDOW` bytes, most significant digit first, and a group
of equal suffixes is exactly a repeated window.  The passes:

1. The leading digit is a stretch of 35 bytes.  In each window the gram of GRAM bytes with the least
   hash is its anchor (equal windows have equal anchors), and windows that share an anchor form a run.  The
   windows of a run that begin SIDE bytes or more before the anchor all hold these bytes and the gram, the
   others the gram and SIDE bytes after it.  Both stretches are exchanged as 32-bit tags in buckets of
   tags, and answered by a bit each.  Stretches in a single document retire: no later digit revives them.
2. Windows around surviving stretches are exchanged as contexts (one for each run, equal contexts of a
   block collapsed) and sorted by digits of eight bytes; a window that is alone after a digit retires.
   What remains is equal in all bytes, so hashes only thin out candidates and never decide.
3. Each context learns which of its windows also start in a smaller document, and each document merges
   the bytes they cover.

Documents sit in blocks by the hash of their id, and all three passes use that one exchange.  Contexts
of a stretch found in very many documents are dealt by window, so no group lands in one task.

What is exchanged takes disk until the result is written, so it is packed: texts and contexts by
zstandard, sorted numbers by their steps.  Answers name no context or tag; they hold to the order in which
a block, which finds its stretches and contexts anew in each pass, has told them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import enter, width

WINDOW = 50
GRAM = 20
#: Grams in a window, so windows that may share one; their flags fit a 32-bit word.
SPAN = WINDOW - GRAM + 1
#: Bytes of a stretch beside its gram.
SIDE = (SPAN - 1) // 2
#: Text that one step of array work holds, in bytes: its arrays fit a core's cache.
CHUNK_BYTES = 1 << 17
#: Text of a block, about; a block is what one Python call holds.
BLOCK_BYTES = 8 << 20
#: A block of up to so many bytes keeps its runs for a second look; those of a larger one are found again.
KEPT_BYTES = 4 * BLOCK_BYTES
#: zstandard's level for what is exchanged.
LEVEL = 3
#: Documents with a stretch (of a block 255 count at most) from which on its windows are dealt one by one.
HOT_DOCUMENTS = 2000
#: Windows that one sorting step holds.
SORT_WINDOWS = 200_000
NULL_ID = np.iinfo(np.int64).max
U = np.uint64
LOW = U(0xFFFFFFFF)
FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD], U)
#: Digits of the longest context, and the bits of a digit that its first 0 to 8 bytes have.
DIGITS = -(-(WINDOW + SPAN - 1) // 8)
FRONT = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(31))
    x *= U(0x7FB5D329728EA185)
    x ^= x >> U(27)
    x *= U(0x81DADEF4BC2DD44D)
    x ^= x >> U(33)
    return x


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one integer."""
    return np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).astype(U)


def digits(data: np.ndarray, begin: np.ndarray, size: np.ndarray, n: int = DIGITS) -> np.ndarray:
    """For each stretch of bytes a row of n digits of eight bytes, zero behind its end; data goes on for 8 * n bytes behind the last begin."""
    at = 8 * np.arange(n)
    x = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))[begin[:, None] + at].astype(U, copy=False)
    x &= FRONT[np.clip(size[:, None] - at, 0, 8)]
    return x


def alike(x: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that are the first of their like, in their order, and for each row the place of its like among them.

    Rows are alike in all digits and in what more is told of them.  A hash finds them, and all are compared.
    """
    more = [m.astype(U) for m in more]
    h = np.zeros(len(x), U)
    for column in (*more, *x.T):
        h = mixed(h + column * U(0x9E3779B97F4A7C15))
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    like = first[which]
    if not ((x == x[like]).all() and all((m == m[like]).all() for m in more)):
        _, first, which = np.unique(np.column_stack([x, *more]), axis=0, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return first[order], place[which.ravel()]


def drawn_out(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row as often as it counts, and how many of it came before."""
    return np.repeat(np.arange(len(count)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def coded(h: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket in the upper 32 bits and a tag in the lower."""
    g = mixed(h)
    return (((g >> U(32)) * U(buckets)) >> U(32) << U(32)) | (g & LOW)


def shrunk(*columns: np.ndarray) -> bytes:
    """Columns of numbers, packed byte place by byte place."""
    planes = [binary(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T) for x in columns]
    return zstandard.compress(b"".join(planes), LEVEL)


def grown(packed: bytes, *types) -> list[np.ndarray]:
    """What shrunk() has packed."""
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    sizes = [np.dtype(t).itemsize for t in types]
    planes, at, out = planes.reshape(sum(sizes), -1), 0, []
    for t, size in zip(types, sizes):
        out.append(np.ascontiguousarray(planes[at : at + size].T).view(t).ravel())
        at += size
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """What each number adds to the one before; np.cumsum gives the numbers back."""
    return np.diff(x, prepend=x.dtype.type(0))


def runs_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that share their anchor: first and last start, last start of the left
    side, hash of the gram, and hashes of the left and the right stretch (0 where no window has it).

    data: texts one after another; ends: where each of them ends.
    """
    none = np.empty(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none, none.astype(U), none.astype(U), none.astype(U)
    # eight bytes count by sums of products: folded first, as the upper bytes of a product depend on all below
    x = lanes(data)
    x ^= x >> U(32)
    n = len(data) - GRAM + 1
    h = x[:n] * FACTORS[0]
    h += x[8 : n + 8] * FACTORS[1]
    h += x[12 : n + 12] * FACTORS[2]
    h = mixed(h)
    least = h & ~LOW
    least |= np.arange(n, dtype=U)
    for step in (1, 2, 4, 8):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: 16 - SPAN], least[SPAN - 16 :])
    at = (least & LOW).astype(np.int64)
    whole = np.ones(len(at), bool)
    begin = 0
    for end in ends:
        whole[max(begin, end - WINDOW + 1) : end] = False
        begin = end
    starts = np.flatnonzero(whole)
    if not len(starts):
        return none, none, none, none.astype(U), none.astype(U), none.astype(U)
    at = at[starts]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first, last, anchor = starts[new], starts[np.r_[new[1:], len(starts)] - 1], at[new]
    turn = np.clip(anchor - SIDE, first - 1, last)

    def stretch(begin: np.ndarray, there: np.ndarray, salt: int) -> np.ndarray:
        begin = np.where(there, begin, 0)
        out = np.full(len(begin), salt, U)
        for factor, step in zip(FACTORS, (*range(0, GRAM + SIDE - 7, 8), GRAM + SIDE - 8)):
            out += x[np.minimum(begin + step, len(x) - 1)] * factor
        return np.where(there, mixed(out) | U(1), U(0))

    return first, last, turn, h[anchor], stretch(anchor - SIDE, turn >= first, 1), stretch(anchor, turn < last, 2)


class Block:
    """The documents of a block in the order of their ids, and their runs."""

    USES = ("number", "start", "end", "own")

    def __init__(self, docs: pa.Table):
        ids, at, size = (docs[c].to_numpy().astype(np.int64) for c in ("_id", "_at", "_size"))
        # packs hold the texts in the order of _at, which also settles the order of equal ids
        told = np.argsort(at)
        raw = pa.py_buffer(b"".join(zstandard.decompress(p) for p in docs["_pack"].take(pa.array(told)).drop_null().to_pylist()))
        ends = np.cumsum(size[told])
        rank = np.argsort(ids[told], kind="stable")
        self.order = told[rank]
        self.ids = ids[self.order]
        self.texts = [raw.slice(end - n, n) for end, n in zip(ends[rank].tolist(), size[self.order].tolist())]

    def pieces(self):
        """Stretches of at most CHUNK_BYTES: (bytes, ends, document numbers, offsets in the documents)."""
        held: list[np.ndarray] = []
        at: list[tuple[int, int]] = []
        size = 0
        for k, buffer in enumerate(self.texts):
            text = np.frombuffer(buffer, np.uint8)
            for a in range(0, max(len(text) - WINDOW + 1, 0), CHUNK_BYTES):
                part = text[a : a + CHUNK_BYTES + WINDOW - 1]
                if size and size + len(part) > CHUNK_BYTES:
                    yield self.joined(held, at)
                    held, at, size = [], [], 0
                held.append(part)
                at.append((k, a))
                size += len(part)
        if held:
            yield self.joined(held, at)

    @staticmethod
    def joined(held, at):
        ends = np.cumsum([len(x) for x in held])
        return np.concatenate(held), ends, np.array([k for k, _ in at]), np.array([a for _, a in at])

    def runs(self):
        """For each part of the block: its bytes, then for each run document number, offset, and runs_of()."""
        for data, ends, docs, offsets in self.pieces():
            found = runs_of(data, ends)
            part = np.searchsorted(ends, found[0], side="right")
            shift = offsets[part] - np.r_[0, ends[:-1]][part]
            yield data, docs[part], shift, *found

    def contexts(self, answers: list[tuple[int, bytes, bytes]], buckets: int) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.RecordBatch]:
        """Distinct contexts of stretches that survive, of each the smallest id and the code, and their uses (document number, start, end, context).

        answers: for each bucket a bit for each distinct code of the block there, in their order, and the
        same for hot ones, or nothing if none is.
        """
        codes = hot = np.empty(0, U)
        parts = self.runs
        if any(map(any, (keep for _, keep, _ in answers))):
            if sum(t.size for t in self.texts) <= KEPT_BYTES:
                kept = list(self.runs())
                parts = lambda: kept
            codes = np.concatenate([coded(x[x != 0], buckets) for *_, left, right in parts() for x in (left, right)])
            codes.sort()
            codes = codes[np.r_[True, codes[1:] != codes[:-1]]]
            whole, whole_hot = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
            for bucket, keep, hot in answers:
                a, b = np.searchsorted(codes, [U(bucket << 32), U(bucket + 1 << 32)])
                whole[a:b] = np.unpackbits(np.frombuffer(keep, np.uint8), count=b - a)
                if hot:
                    whole_hot[a:b] = np.unpackbits(np.frombuffer(hot, np.uint8), count=b - a)
            codes, hot = codes[whole], whole_hot[whole]
        def among(stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            code = coded(stretch, buckets)
            place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            there = (codes[place] == code) & (stretch != 0)
            return there, there & hot[place]

        # of each part its distinct contexts (digits, size, dealt alone, document number, code) and their uses
        told: list[tuple[np.ndarray, ...]] = []
        uses: list[tuple[np.ndarray, ...]] = []
        count = 0
        for data, docs, shift, first, last, turn, h, left, right in parts() if len(codes) else ():
            (on_left, hot_left), (on_right, hot_right) = among(left), among(right)
            both = on_left & on_right & ~hot_left & ~hot_right
            # a window's side decides how it is dealt, as equal windows are on one side
            side = np.flatnonzero(np.column_stack([on_left, on_right & ~both]))
            run, right_side = side >> 1, side & 1 == 1
            low = np.where(right_side, turn[run] + 1, first[run])
            high = np.where(right_side | both[run], last[run], turn[run])
            alone = np.where(right_side, hot_right[run], hot_left[run])
            row, nth = drawn_out(np.where(alone, high - low + 1, 1))
            run, low, alone = run[row], low[row] + nth, alone[row]
            size = np.where(alone, low, high[row]) - low + WINDOW
            x = digits(np.r_[data, np.zeros(8 * DIGITS, np.uint8)], low, size)
            # a window dealt alone and a context that looks the same are told apart
            new, own = alike(x, size, alone)
            number, start = docs[run], low + shift[run]
            uses.append((number.astype(np.int32), start, start + size, own + count))
            told.append((x[new], size[new].astype(np.uint8), alone[new], number[new], coded(h[run[new]], buckets)))
            count += len(new)
        if not count:
            none = np.empty(0, np.int64)
            return pa.array([], pa.large_binary()), none, none.astype(U), pa.record_batch([none.astype(np.int32), none, none, none], names=list(self.USES))
        number, start, end, own = map(np.concatenate, zip(*uses))
        x, size, alone, owner, code = map(np.concatenate, zip(*told))
        if len(told) > 1:
            new, like = alike(x, size, alone)
            own, x, size, alone, owner, code = like[own], x[new], size[new], alone[new], owner[new], code[new]
        code[alone] = coded(mixed(x[alone, :6]).sum(axis=1, dtype=U), buckets)
        ends = np.r_[0, np.cumsum(size, dtype=np.int64)]
        body = x.astype("<u8", copy=False).view(np.uint8)[np.arange(8 * DIGITS) < size[:, None]]
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(body)])
        return texts, self.ids[owner], code, pa.record_batch([number, start, end, own], names=list(self.USES))


def split_by_bucket(code: np.ndarray, order: np.ndarray | None = None):
    """(bucket, positions) for each bucket among codes."""
    order = np.argsort(code, kind="stable") if order is None else order
    bucket = (code[order] >> U(32)).astype(np.int64)
    cuts = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)] if len(bucket) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield int(bucket[a]), order[a:b]


def in_buckets(code: np.ndarray):
    """split_by_bucket() with the positions of each bucket in their order."""
    return split_by_bucket(code, np.argsort(code >> U(32), kind="stable"))


def equal_windows(digits: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit passes over rows of digits in groups: the rows that have an equal, and their new group.

    A pass splits each group by the next digit and retires rows that are alone.
    """
    live = np.arange(len(digits))
    for j in range(digits.shape[1]):
        _, rank = np.unique(digits[live, j], return_inverse=True)
        _, again, count = np.unique((group << 32) | rank, return_inverse=True, return_counts=True)
        keep = count[again] > 1
        live, group = live[keep], again[keep]
        if not len(live):
            break
    return live, group


def flag_smaller(code: np.ndarray, doc: np.ndarray, size: np.ndarray, begin: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each context a bit for each window: whether an equal one belongs to a smaller document."""
    flags = np.zeros(len(code), np.uint32)
    order = np.argsort(code, kind="stable")
    new = np.r_[True, code[order][1:] != code[order][:-1]][: len(order)]
    group = np.cumsum(new) - 1
    often = np.bincount(group)[group] > 1 if len(group) else new
    order, group = order[often], group[often]
    if not len(order):
        return flags
    data = np.r_[data, np.zeros(8 * DIGITS, np.uint8)]
    # a step holds whole groups
    windows = np.cumsum(size[order] - WINDOW + 1)
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    step = (windows[heads] // SORT_WINDOWS).repeat(np.diff(np.r_[heads, len(group)]))
    cuts = np.flatnonzero(np.r_[True, step[1:] != step[:-1], True])
    for a, b in zip(cuts, cuts[1:]):
        rows, of = order[a:b], group[a:b]
        first, kind = alike(digits(data, begin[rows], size[rows]), size[rows], of)
        least = np.full(len(first), NULL_ID)
        np.minimum.at(least, kind, doc[rows])
        some = np.zeros(len(first), np.uint32)
        # of equal contexts the later ones lose all; the first one's windows are compared with those of other contexts
        of = of[first] - of[0]
        mixed_groups = np.flatnonzero(np.bincount(of)[of] > 1)
        if len(mixed_groups):
            at, wide = begin[rows[first[mixed_groups]]], size[rows[first[mixed_groups]]]
            row, nth = drawn_out(wide - WINDOW + 1)
            live, same = equal_windows(digits(data, at[row] + nth, np.full(len(row), WINDOW), (WINDOW + 7) // 8), of[mixed_groups[row]])
            row, nth = mixed_groups[row[live]], nth[live]
            if len(live):
                smallest = np.full(same.max() + 1, NULL_ID)
                np.minimum.at(smallest, same, least[row])
                hit = smallest[same] < least[row]
                np.bitwise_or.at(some, row[hit], np.uint32(1) << nth[hit].astype(np.uint32))
        whole = ((U(1) << (size[rows] - WINDOW + 1).astype(U)) - U(1)).astype(np.uint32)
        flags[rows] = np.where(doc[rows] > least[kind], whole, some[kind])
    return flags


def binary(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def gathered(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of byte strings, and how many are in each."""
    parts = [np.frombuffer(x, dtype) for x in column.to_pylist()]
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), np.array([len(x) for x in parts], int)


def flagged(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the bits that are set."""
    rows, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(SPAN):
        there = np.flatnonzero(flags >> np.uint32(i) & np.uint32(1))
        rows.append(there)
        places.append(np.full(len(there), i))
    return np.concatenate(rows), np.concatenate(places)


def cut_out(texts: list[pa.Buffer], number: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[pa.Array, list[bytes]]:
    """The maximal stretches of each text that the ones from begin to end in text `number` cover, and what they leave."""
    size = np.array([t.size for t in texts], np.int64)
    # texts as one, a byte apart, so that stretches of two texts do not touch
    base = np.cumsum(size + 1) - size - 1
    order = np.argsort(base[number] + begin, kind="stable")
    begin, end, number = (base[number] + begin)[order], np.maximum.accumulate((base[number] + end)[order]), number[order]
    new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]][: len(begin)])
    number = number[new]
    start, stop = begin[new] - base[number], end[np.r_[new[1:], len(end)][: len(new)] - 1] - base[number]
    offsets = np.searchsorted(number, np.arange(len(texts) + 1))
    spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(stop, pa.int64())], ["start", "end"]))
    kept = []
    for text, a, b in zip(texts, offsets.tolist(), offsets[1:].tolist()):
        whole = text.to_pybytes()
        if a < b:
            edges = zip([0, *stop[a:b].tolist()], [*start[a:b].tolist(), len(whole)])
            whole = b"".join([whole[x:y] for x, y in edges])
        kept.append(whole)
    return spans, kept


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """Remove bytes of texts that repeat, in WINDOW bytes or more, what a smaller document holds.

    Texts count as UTF-8 bytes, matches never cross documents, and windows are judged on the input.
    Returns the carried columns (all by default), then n_bytes, spans (array of start and end of the
    maximal removed runs) and kept (binary, the other bytes; with as_text a string, without the
    bytes of characters that were cut in part).  One row per input row.

    A null text is empty; texts shorter than a window lose nothing.  A null id counts as the largest.
    Rows with equal ids do not remove each other's bytes.  Very long texts are read in overlapping
    stretches.  An empty table gives an empty one.  Extra columns may have any names; a carried
    column of a result's name gives way.
    """
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("n_bytes", "spans", "kept")]
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    total = docs.select(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0
    buckets = width(spark)
    blocks = max(buckets, -(-total // BLOCK_BYTES))
    held = [f"c{i}" for i in range(len(carry))]
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]

    def pack(batches):
        """The texts of a batch that go to one block travel together, with the first of their rows."""
        enter("suffix_dedup")
        for batch in batches:
            block, texts = batch["block"].to_numpy(), batch["_bytes"]
            order = np.argsort(block, kind="stable")
            packs: list[bytes | None] = [None] * len(order)
            for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                if len(rows):
                    packs[rows[0]] = zstandard.compress(b"".join(texts.take(pa.array(rows)).to_pylist()), LEVEL)
            yield pa.RecordBatch.from_arrays(
                [batch["block"], batch["_id"], batch["_at"], pc.binary_length(texts).cast(pa.int64()), pa.array(packs, pa.binary()), *[batch[c] for c in held]],
                names=["block", "_id", "_at", "_size", "_pack", *held],
            )

    placed = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(blocks)).alias("block"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NULL_ID))).alias("_id"), F.monotonically_increasing_id().alias("_at"), body.alias("_bytes"), *carried,
    ).mapInArrow(pack, T.StructType([*T.StructType.fromDDL("block long, _id long, _at long, _size long, _pack binary").fields, *fields])).repartition(blocks, "block")

    def tags(key, table):
        enter("suffix_dedup")
        code_parts, doc_parts = [], []
        block = Block(table)
        for _, numbers, _, _, _, _, _, left, right in block.runs():
            for stretch in (left, right):
                there = np.flatnonzero(stretch)
                code_parts.append(coded(stretch[there], buckets))
                doc_parts.append(block.ids[numbers[there]])
        code = np.concatenate(code_parts) if code_parts else np.empty(0, U)
        doc = np.concatenate(doc_parts) if doc_parts else np.empty(0, np.int64)
        order = np.argsort(doc, kind="stable")
        order = order[np.argsort(code[order], kind="stable")]
        code, doc = code[order], doc[order]
        other = np.r_[True, code[1:] != code[:-1]][: len(code)]
        first = np.flatnonzero(other)
        # documents with the code, up to 255
        count = np.add.reduceat(other | np.r_[True, doc[1:] != doc[:-1]], first, dtype=np.int64) if len(code) else np.empty(0, int)
        count = np.minimum(count, 255).astype(np.uint8)
        code = code[first]
        rows = []
        for b, p in split_by_bucket(code, np.arange(len(code))):
            step = steps((code[p] & LOW).astype(np.uint32))
            # the lower half of a step is noise
            rows.append((b, binary(step.astype(np.uint16)), shrunk((step >> 16).astype(np.uint16), count[p])))
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int64()), "low": pa.array(columns[1], pa.binary()), "high": pa.array(columns[2], pa.binary())})

    def shared(key, table):
        tag_parts, count_parts = [], []
        for low, high in zip(table["low"].to_pylist(), table["high"].to_pylist()):
            above, count = grown(high, np.uint16, np.uint8)
            tag_parts.append(np.cumsum(above.astype(np.uint32) << 16 | np.frombuffer(low, np.uint16), dtype=np.uint32))
            count_parts.append(count)
        tag, count, sizes = np.concatenate(tag_parts), np.concatenate(count_parts), [len(x) for x in tag_parts]
        kinds, which = np.unique(tag, return_inverse=True)
        total = np.bincount(which, count, len(kinds))[which]
        keep, hot = total > 1, total >= HOT_DOCUMENTS
        out_keep, out_hot, at = [], [], 0
        for n in sizes:
            some = hot[at : at + n]
            out_keep.append(binary(np.packbits(keep[at : at + n])))
            out_hot.append(binary(np.packbits(some)) if some.any() else b"")
            at += n
        return pa.table({"block": table["block"].combine_chunks(), "bucket": table["bucket"].combine_chunks(), "told": pa.array(out_keep, pa.binary()), "hot": pa.array(out_hot, pa.binary())})

    def answers(replies: pa.Table) -> list[tuple[int, bytes, bytes]]:
        return list(zip(*(replies[c].to_pylist() for c in ("bucket", "told", "hot"))))

    def offered(key, table, replies):
        enter("suffix_dedup")
        rows = []
        if table.num_rows:
            texts, owner, code, _ = Block(table).contexts(answers(replies), buckets)
            order = np.argsort(code >> U(32), kind="stable")
            texts, owner, code = texts.take(pa.array(order)), owner[order], code[order]
            size, body = pc.binary_length(texts).to_numpy(), texts.buffers()[2]
            ends = np.cumsum(size)
            for b, p in split_by_bucket(code, np.arange(len(code))):
                # contexts are numbered in the order of their owners
                a, z = p[0], p[-1] + 1
                held = body[int(ends[a] - size[a]) : int(ends[z - 1])]
                rows.append((b, binary((code[a:z] & LOW).astype(np.uint32)), shrunk(size[a:z].astype(np.uint8), steps(owner[a:z])), zstandard.compress(held, LEVEL)))
        columns = list(zip(*rows)) or [[]] * 4
        names = ["tags", "owner", "data"]
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int64())} | {n: pa.array(c, pa.binary()) for n, c in zip(names, columns[1:])})

    def judged(key, table):
        enter("suffix_dedup")
        tag, sizes = gathered(table["tags"], np.uint32)
        size_parts, owner_parts = zip(*(grown(x, np.uint8, np.int64) for x in table["owner"].to_pylist()))
        size = np.concatenate(size_parts).astype(np.int64)
        owner = np.concatenate([np.cumsum(x) for x in owner_parts])
        data = np.frombuffer(b"".join(zstandard.decompress(x) for x in table["data"].to_pylist()), np.uint8)
        flags = flag_smaller(tag, owner, size, np.cumsum(size) - size, data)
        told = [shrunk(x) for x in np.split(flags, np.cumsum(sizes)[:-1])]
        # a bucket's judgements are told from its replies by a number below zero
        return pa.table({"block": table["block"].combine_chunks(), "bucket": pc.bit_wise_not(table["bucket"].combine_chunks()), "told": pa.array(told, pa.binary()), "hot": pa.array([b""] * len(told), pa.binary())})

    def merged(key, table, replies):
        enter("suffix_dedup")
        judgement = pc.less(replies["bucket"], 0)
        block = Block(table)
        _, owner, code, uses = block.contexts(answers(replies.filter(pc.invert(judgement))), buckets)
        judged_bucket = {~b: told for b, told, _ in answers(replies.filter(judgement))}
        flags = np.zeros(len(owner), np.uint32)
        for b, p in in_buckets(code):
            flags[p] = grown(judged_bucket[b], np.uint32)[0]
        number, start, end, own = (uses[c].to_numpy() for c in Block.USES)
        later = block.ids[number] > owner[own]
        row, bit = flagged(np.where(later, np.uint32(0), flags[own]))
        begin, end = np.r_[start[later], start[row] + bit], np.r_[end[later], start[row] + bit + WINDOW]
        spans, kept = cut_out(block.texts, np.r_[number[later], number[row]], begin, end)
        rest = table.take(pa.array(block.order))
        return pa.table({f"c{i}": rest[f"c{i}"].combine_chunks() for i in range(len(carry))} | {"n_bytes": pa.array([t.size for t in block.texts], pa.int64()), "spans": spans, "kept": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())})

    by_block = "block long, bucket int, told binary, hot binary"
    # a bucket is a partition: by a hash of their numbers some tasks would get several and others none
    asked = placed.groupBy("block").applyInArrow(tags, "bucket int, block long, low binary, high binary")
    replies = asked.repartitionById(buckets, F.col("bucket")).groupBy("bucket").applyInArrow(shared, by_block)
    offers = placed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(offered, "bucket int, block long, tags binary, owner binary, data binary")
    judgements = offers.repartitionById(buckets, F.col("bucket")).groupBy("bucket").applyInArrow(judged, by_block)
    schema = T.StructType([*fields, *T.StructType.fromDDL("n_bytes long, spans array<struct<start:long,end:long>>, kept " + ("string" if as_text else "binary")).fields])
    out = placed.groupBy("block").cogroup(replies.unionByName(judgements).groupBy("block")).applyInArrow(merged, schema)
    return out.toDF(*carry, "n_bytes", "spans", "kept")
