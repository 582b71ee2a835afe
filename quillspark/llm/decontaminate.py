"""Benchmark decontamination (operator 11): a generalised suffix automaton of the test items, streamed over by the training words.

The automaton of all items' words tells, for each word of a text, the longest run of words ending there that some item holds.
States are marked with the windows of items that end in them; where the running match is as long as a marked window, the
window's words are hit.  Texts stream by in stretches, so memory does not depend on their length.

Items go in parts of PART_BYTES, each with an automaton of its own that every worker builds from the part's words; documents
stream over one part after the other.  One part is enough for some ten thousand items.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_settled, enter, settle

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other characters; the rest parts words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
#: Bytes of text whose words are held at once.
STRETCH = 1 << 20
#: Words of an item that go together; a longer item is many pieces, each beginning with the last words of the one before.
PIECE = 1 << 14
#: Bytes of words and ids of a part of the items: what a worker builds an automaton of, and the driver broadcasts at once.
PART_BYTES = 1 << 21
FIELDS = "n_words long, n_hit long, longest long, spans array<struct<first:long,last:long>>, items array<string>"
NONE = 1 << 30


@dataclass(frozen=True)
class Limits:
    """Words in a row that count as taken from an item, and the share of an item's words that does so for short ones."""

    length: int = 10
    coverage: float = 1.0

    def of(self, n: int) -> int:
        """The window of an item of n words."""
        return min(self.length, max(1, -int(-n * self.coverage // 1)))


def stretches(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, normalised, about STRETCH bytes at a time."""
    text = text.translate(WORDS)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + STRETCH)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Automaton:
    """All runs of words that the items hold, as states; `link` is the state of the longest suffix that other places share."""

    def __init__(self, items: list[tuple[str | None, bytes, int]]):
        """Of rows (id, words joined by spaces, window)."""
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        kinds: dict[tuple[bytes, int], int] = {}
        self.ids: list[list[str]] = []
        for own, words, window in items:
            kind = kinds.setdefault((words, window), len(kinds))
            if kind == len(self.ids):
                self.ids.append([])
            if own is not None:
                self.ids[kind].append(own)
        for words, _ in kinds:
            last = 0
            for w in words.split():
                last = self.after(last, w)
        marks: dict[int, dict[int, set[int]]] = {}
        for (words, window), kind in kinds.items():
            state = held = 0
            for w in words.split():
                state = self.next[state][w]
                held = min(held + 1, window)
                while self.length[self.link[state]] >= held:
                    state = self.link[state]
                if held == window:
                    marks.setdefault(state, {}).setdefault(window, set()).add(kind)
        #: windows ending in a state, shortest first; the next marked state among its suffixes; its shortest window
        self.marks = {s: sorted(m.items()) for s, m in marks.items()}
        self.up, self.least = [-1] * len(self.link), [NONE] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            p = self.link[s]
            self.up[s] = p if p in self.marks else self.up[p]
            self.least[s] = min(self.least[p], self.marks[s][0][0] if s in self.marks else NONE)

    def state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def split(self, before: int, word: bytes, old: int) -> int:
        """A copy of `old` for its runs that are no longer than the one of `before` with the word."""
        made = self.state(self.length[before] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = made
        while before >= 0 and self.next[before].get(word) == old:
            self.next[before][word] = made
            before = self.link[before]
        return made

    def after(self, last: int, word: bytes) -> int:
        """The state of the run of `last` with the word behind it, made if no item has had it."""
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self.split(last, word, known)
        made = self.state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = made
            last = self.link[last]
        if last >= 0:
            old = self.next[last][word]
            self.link[made] = old if self.length[old] == self.length[last] + 1 else self.split(last, word, old)
        return made

    def scan(self, text: bytes) -> tuple[int, int, list[list[int]], set[str]]:
        """Number of words, longest match, spans [first, last] of hit words (apart, rising), and ids of items with windows in the text."""
        following, link, length, least = self.next, self.link, self.length, self.least
        spans: list[list[int]] = []
        kinds: set[int] = set()
        state = held = longest = at = 0
        for words in stretches(text):
            for at, w in enumerate(words, at):
                to = following[state].get(w)
                if to is None:
                    while to is None and state:
                        state = link[state]
                        held = length[state]
                        to = following[state].get(w)
                    if to is None:
                        continue
                state = to
                held += 1
                if held > longest:
                    longest = held
                if held >= least[state]:
                    first = at + 1 - self.windows(state, held, kinds)
                    while spans and spans[-1][1] >= first - 1:
                        first = min(first, spans.pop()[0])
                    spans.append([first, at])
            at += bool(words)
        return at, longest, spans, {i for k in kinds for i in self.ids[k]}

    def windows(self, state: int, held: int, kinds: set[int]) -> int:
        """The longest window that ends here; adds the items' kinds."""
        best = 0
        state = state if state in self.marks else self.up[state]
        while state >= 0:
            for window, found in self.marks[state]:
                if window <= held:
                    best = max(best, window)
                    kinds |= found
            state = self.up[state]
        return best


def cut_out(text: bytes, spans: list[list[int]]) -> str:
    """The text without the spans' words and what lies between them."""
    if not spans:
        return text.decode("utf-8", "replace")
    out, kept, todo = [], 0, iter(spans)
    first, last = next(todo, (-1, -1))
    start = 0
    for n, m in enumerate(re.finditer(rb"[^ ]+", text.translate(WORDS))):
        if n == first:
            start = m.start()
        if n == last:
            out.append(text[kept:start])
            kept = m.end()
            first, last = next(todo, (-1, -1))
    return b"".join([*out, text[kept:]]).decode("utf-8", "replace")


def item_pieces(items: DataFrame, limits: Limits, id_col: str, text_col: str) -> DataFrame:
    """own, words (joined by a space) and window of the pieces of items that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("decontaminate")
        for batch in batches:
            rows: list[tuple] = []
            for own, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.translate(WORDS).split()
                window = limits.of(len(words))
                step = max(1, PIECE - window + 1)
                for a in range(0, len(words) - window + 1, step) if words else ():
                    rows.append((own, b" ".join(words[a : a + step + window - 1]), window))
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.binary(), pa.int32()))], ["own", "words", "window"])

    own, text = F.col(f"`{id_col}`").cast("string"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return items.select(own.alias("own"), text.alias("text")).mapInArrow(run, "own string, words binary, window int")


def item_parts(pieces: DataFrame) -> Iterator[list[tuple]]:
    """The distinct pieces in parts of at most about PART_BYTES, one after the other: sizes are counted before anything is collected."""
    rows = pieces.distinct()
    size = F.octet_length("words") + F.coalesce(F.octet_length("own"), F.lit(0)) + 16
    total = rows.agg(F.sum(size)).first()[0] or 0
    count = -(-total // PART_BYTES)
    while count > 1:  # a hash deals them evenly, which is checked
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("own", "words"), F.lit(count)))
        if (dealt.groupBy("part").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0] or 0) <= PART_BYTES * 5 // 4:
            break
        count += -(-count // 4)
    for k in range(count):
        part = rows if count == 1 else dealt.where(F.col("part") == k).drop("part")
        yield [(r["own"], bytes(r["words"]), r["window"]) for r in part.collect()]


_BUILT: dict[str, Automaton] = {}


def automaton_of(key: str, items: list[tuple]) -> Automaton:
    """The automaton of a part, built once in each worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items)
    return _BUILT[key]


def streamed(docs: DataFrame, part: list[tuple], again: bool) -> DataFrame:
    """docs (c0, .., text, and the fields of FIELDS if `again`) with the fields, those of this part's items added."""
    names = [f.split()[0] for f in re.split(r", (?=\w+ )", FIELDS)]
    plain = [c for c in docs.columns if c not in names]
    held, key = docs.sparkSession.sparkContext.broadcast(part), uuid.uuid4().hex
    at = plain.index("text")
    schema = ", ".join([f"{n} {t}" for n, t in docs.dtypes if n in plain] + [FIELDS])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("decontaminate", _BUILT.clear)
        known = automaton_of(key, held.value)
        for batch in batches:
            rows = []
            before = zip(*(batch.column(len(plain) + k).to_pylist() for k in range(5))) if again else None
            for text in batch.column(at):
                n, longest, spans, items = known.scan(text.as_py())
                if before:
                    _, _, length, places, ids = next(before)
                    longest, items = max(longest, length), items | set(ids)
                    spans = merged(spans + [[p["first"], p["last"]] for p in places])
                rows.append((n, sum(b - a + 1 for a, b in spans), longest, [{"first": a, "last": b} for a, b in spans], sorted(items)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(plain)], *(pa.array(c, k) for c, k in zip(columns, kinds))], [*plain, *names])

    return docs.select(*plain, *(names if again else [])).mapInArrow(run, schema)


def merged(spans: list[list[int]]) -> list[list[int]]:
    """Spans in order, those that meet joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, limits: Limits = Limits(), id_col: str = "item_id", text_col: str = "text", item_text: str = "text",
    carry: list[str] | None = None, clean: bool = True,
) -> DataFrame:
    """The carried columns (all by default), then n_words, n_hit, longest, spans, items and, with `clean`, `cleaned`.

    A window of an item is `limits.length` words in a row, or the share `limits.coverage` of a shorter item.  Words inside
    an occurrence of a window are hit: spans are the maximal runs of them, first and last word from 0.  items are the distinct ids (as
    strings, sorted) of items with occurring windows, longest is the longest run of words found in an item, and cleaned is the text
    without the spans.  Null texts, of documents and items, have no words; an item without words has no window.  An item without an
    id marks words and is not listed; rows of one item id are one item.  Columns of a result's name give way.  No items: no hits.
    One row for each document; an empty table gives an empty one.
    """
    names = [f.split()[0] for f in re.split(r", (?=\w+ )", FIELDS)] + (["cleaned"] if clean else [])
    carry = [c for c in (docs.columns if carry is None else carry) if c not in names]
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], body.alias("text"))
    pieces, before = settle(item_pieces(items, limits, id_col, item_text)), None
    for k, part in enumerate(item_parts(pieces)):
        if k:  # the one before is written, so each task holds one automaton
            last, before = before, settle(out)
            out = before
            if last is not None:
                drop_settled(last)
        out = streamed(out, part, again=k > 0)
    if pieces.isEmpty():
        out = streamed(out, [], again=False)
    drop_settled(pieces)
    if clean:
        cleaned = F.udf(lambda text, spans: cut_out(bytes(text), [[s["first"], s["last"]] for s in spans or []]), "string", useArrow=True)
        out = out.withColumn("cleaned", cleaned("text", "spans"))
    return out.select(*[f"c{i}" for i in range(len(carry))], *names).toDF(*carry, *names)
