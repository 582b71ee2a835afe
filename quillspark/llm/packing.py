"""Best-fit packing (operator 3): bound-certified repacking.

Documents are tokenised, pieces longer than a sequence are cut, and each partition packs its
pieces by best-fit decreasing.  Dual feasible functions give a lower bound on the number of sequences of a
partition: where the packing meets it, it is certified.  A partition with a gap gives up its emptiest
sequences, as many as the gap calls for but at most the share GIVEN, and every partition gives up its two
emptiest ones; the pieces given up meet those of other partitions in a smaller number of partitions, and best fit
runs again.  So a later round's partition is at most about half of an earlier one's, whatever the mix of lengths,
and the last one is a single partition of that kind.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, enter, settle, width

CAPACITY = 4096
END_ID = 1
#: Partitions whose rest meets in one of the next round.
FAN_IN = 8
#: Share of its sequences that a partition gives up at most, so that a round's partitions are half of the last one's.
GIVEN = 1 / (2 * FAN_IN)
#: Texts of these characters alone are split and lower-cased here exactly as by the tokenizer file.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ÿ]*")
#: The tokenizer file's own pattern, with its classes written out for lower-cased texts of these characters.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")


#: How the tokenizer's byte level spells bytes, printable ones as they are, the others in their order from U+0100 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
SPELLED = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


def as_bytes(ids) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordIds:
    """Little-endian 32-bit ids by the tokenizer file at `path`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the file's own tokens are found in raw text, before it is split
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.model = self.tokenizer.model
        self.words = Remembered(self.of_word)

    def of_text(self, text: str) -> bytes:
        return as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of_word(self, word: str) -> bytes:
        """What is left of of_text() for a word that is split off and in lower case: byte level and merges."""
        return as_bytes(t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(SPELLED)))


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_bytes(text: str, known: WordIds) -> bytes:
    """The text's ids.  The tokenizer joins no words, so their ids can be looked up one by one."""
    if PLAIN.fullmatch(text) and not known.added.search(text):
        return b"".join(map(known.words.__getitem__, SPLIT.findall(text.lower())))
    return known.of_text(text)


def pieces_of(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces; a null text has the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("packing", word_ids.cache_clear)
        words = word_ids(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(token_bytes(text.as_py() or "", words) + end)
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a : a + 4 * capacity]
                    rows.append((doc, k, a // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The least number of bins for counts[length] items, by two families of dual feasible functions."""
    sizes = np.arange(capacity + 1)
    upto, weight = np.cumsum(counts), np.cumsum(counts * sizes)
    best = -(-int(weight[-1]) // capacity)
    # items over capacity - e fill a bin, items under e count nothing, the others count as they are
    e = np.arange(1, capacity // 2 + 1)
    big = (upto[-1] - upto[capacity - e]) * capacity
    best = max(best, int((-(-(big + weight[capacity - e] - weight[e - 1]) // capacity)).max()))
    # with k + 1 times the size rounded down to multiples of the capacity, but for exact multiples
    for k in range(1, 33):
        times = (k + 1) * sizes
        value = np.where(times % capacity == 0, sizes * k, times // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lengths in falling order: each item's bin and offset there, and the bins' fills."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room left
    mask = 0  # the rooms that some bin has
    fills: list[int] = []
    bins, offsets = [], []
    for n in lengths.tolist():
        fits = mask >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(fills)
            fills.append(0)
        bins.append(b)
        offsets.append(fills[b])
        fills[b] += n
        left -= n
        if left:
            room[left].append(b)
            mask |= 1 << left
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(fills, np.int64)


def pack_partition(batches: Iterator[pa.RecordBatch], capacity: int, last: bool, level: int) -> Iterator[pa.RecordBatch]:
    """Pack all pieces of a partition; `open` marks those of sequences that are given up."""
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    # a retried task gets its rows in another order and must come to the same result
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
    lengths = table["length"].to_numpy()
    bins, offsets, fills = best_fit_decreasing(lengths, capacity)
    bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    gap = len(fills) - bound
    given = np.zeros(len(fills), bool)
    if not last:
        emptiest = np.argsort(fills, kind="stable")[: max(2, min(2 + 2 * gap, int(GIVEN * len(fills))))]
        given[emptiest[fills[emptiest] < capacity]] = True
    part = TaskContext.get().partitionId()
    table = table.append_column("sequence_id", pa.array((np.int64(level) << 58) + (np.int64(part) << 32) + bins))
    table = table.append_column("offset", pa.array(offsets)).append_column("open", pa.array(given[bins]))
    yield from table.to_batches(max_chunksize=1 << 16)


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset, in few sequences of at most `capacity`.

    Needs the columns of pieces_of(), lengths from 1 to `capacity`.  Repeated rows are packed each.
    Rounds are written to the shared folder, as what is given up must be what is packed anew.
    """
    n, level, done = width(pieces.sparkSession), 0, []
    rest = pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    while True:
        last = n == 1
        dealt = rest.repartition(1) if last else rest.repartition(n, "doc_id", "piece", "ids_crc32")
        placed = settle(dealt.mapInArrow(lambda it, last=last, level=level: pack_partition(it, capacity, last, level), PLACED))
        done.append(placed.where("not open").drop("open"))
        if last:
            break
        rest = placed.where("open").drop("sequence_id", "offset", "open")
        n, level = -(-n // FAN_IN), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    The whole text is tokenised by the file at `path` and followed by the end id; only longer
    documents are cut.  The strings of the file's special tokens are those tokens, as the library reads them.
    Null and empty texts are the end id alone, a null id is kept, repeated rows are packed each, an empty table
    gives an empty one, and extra columns are not read.  Pieces of one length are taken in the order of
    doc_id, piece and CRC; rows equal in all these are interchangeable.  A text of any length is held once, with its ids.
    """
    return pack(pieces_of(docs, path, id_col, text_col, capacity), capacity)


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> dict[str, int]:
    """Sequences used, and the certified lower bound for all pieces together (from at most `capacity` counts)."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in packed.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    return {"sequences": packed.select("sequence_id").distinct().count(), "bound": lower_bound(counts, capacity)}


