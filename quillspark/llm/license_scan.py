"""License scans (operator 1): exact phrases, then fuzzy notices by pigeonhole seeds and bounded edits.

A notice of n characters found with at most k edits holds at least one of k + 1 pieces of it
unchanged.  The pieces are searched as plain strings; only the neighbourhood of each place is
given to the regex library's bounded-error matching, which confirms the edits and reports spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The phrases and labels whose places are counted exactly.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices searched with edits: phrase, label, edits allowed.
NOTICES = [
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu library general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("gplv2", "gpl", 0),
    ("gplv3", "gpl", 0),
    ("lgplv2", "lgpl", 0),
    ("lgplv3", "lgpl", 0),
    ("agplv3", "agpl", 0),
    ("apache license", "apache", 2),
    ("licensed under the apache license version 2", "apache", 4),
    ("mit license", "mit", 1),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("bsd license", "bsd", 1),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 6),
    ("redistribution and use in source and binary forms are permitted", "bsd", 5),
    ("isc license", "isc", 1),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 6),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("european union public licence", "eupl", 3),
    ("common development and distribution license", "cddl", 4),
    ("boost software license", "bsl", 2),
    ("this software is provided as is without any express or implied warranty", "zlib", 5),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5),
    ("creative commons attribution", "cc-by", 3),
    ("creative commons attribution sharealike", "cc-by-sa", 3),
    ("creative commons attribution noncommercial", "cc-by-nc", 3),
    ("creative commons attribution noderivatives", "cc-by-nd", 3),
    ("creative commons attribution noncommercial sharealike", "cc-by-nc-sa", 3),
    ("creative commons attribution noncommercial noderivatives", "cc-by-nc-nd", 3),
    ("creative commons zero", "cc0", 2),
]
#: A tag searched with edits, and the labels of the words that must follow it unchanged (the longest counts).  More of them may follow, joined by
#: JOINS, behind VERSIONS and an EXCEPTION.
TAG, TAG_EDITS = "spdx license identifier", 2
TAG_WORDS = {
    "0bsd": "bsd", "agpl": "agpl", "apache": "apache", "bsd": "bsd", "bsl": "bsl", "cc by": "cc-by", "cc by nc": "cc-by-nc", "cc by nc nd": "cc-by-nc-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa",
    "cc0": "cc0", "cddl": "cddl", "epl": "epl", "eupl": "eupl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "unlicense", "zlib": "zlib",
}
JOINS = re.compile(r" (?:and|or)(?= )")
VERSIONS = re.compile(r"(?: (?:\d+|v\d+|only|plus|clause))*(?: or later)?(?= |$)")
EXCEPTION = re.compile(r" with(?: (?!and |or )\S+){0,5}? exception(?: \d+)*(?= |$)")
#: Leading words of up to this length are short; a phrase of at least LONG characters may have one of its edits in these, others none.
SHORT_WORD, LONG = 3, 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


class Notice:
    """One phrase with its seeds and its bounded-error pattern; `after` maps words that must follow it to labels."""

    def __init__(self, phrase: str, label: str, edits: int, after: dict[str, str] | None = None):
        self.phrase, self.label, self.edits, self.after = phrase, label, edits, after
        self.longest = sorted(after or (), key=len, reverse=True)
        cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
        self.seeds = [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]
        words = phrase.split(" ")
        fixed = 0
        while fixed < len(words) and len(words[fixed]) <= SHORT_WORD:
            fixed += 1
        self.head, self.tail = "".join(w + " " for w in words[:fixed]), " ".join(words[fixed:])
        # a short word changed at will is any other word: most of a phrase's edits must be in the rest
        self.head_edits = min(1, edits) if self.head and len(phrase) >= LONG else 0
        ways = [f"{re.escape(self.head)}(?:{re.escape(self.tail)}){{e<={edits}}}"]
        if self.head_edits:
            ways.append(f"(?:{re.escape(self.head)}){{e<=1}}(?:{re.escape(self.tail)}){{e<={edits - 1}}}")
        self.patterns = [regex.compile(rf"(?b)(?<![^ ]){way}(?![^ ])") for way in ways]

    def verify(self, joined: str, a: int, b: int) -> tuple[int, int, int] | None:
        """(start, end, edits) of the place in a window that begins and ends where words do."""
        best = None
        for pattern in self.patterns:
            m = pattern.search(joined, a, b)
            if m and (best is None or sum(m.fuzzy_counts) < best[2]):
                best = (*m.span(), sum(m.fuzzy_counts))
        return best

    def search(self, joined: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of its places in words joined by single spaces, in their order.

        Each seed is verified in a window of its own, too short for two places: best matching would
        pass over an edited place for a better one behind it, and the work is linear in the seeds.
        Of overlapping places the one with fewest edits stays.
        """
        slack = self.edits + 2
        starts = set()
        for at, seed in self.seeds:
            found = joined.find(seed)
            while found >= 0:
                starts.add(found - at)
                found = joined.find(seed, found + 1)
        held: tuple[int, int, int] | None = None
        for start in sorted(starts):
            a, b = max(0, start - slack), start + len(self.phrase) + slack
            if a and joined[a - 1] != " ":
                a = joined.find(" ", a) + 1 or len(joined)
            if b < len(joined):
                b = joined.rfind(" ", a, b + 1)
            place = self.verify(joined, a, b) if b > a else None
            if not place:
                continue
            if held is None or place[0] >= held[1]:
                if held:
                    yield held
                held = place
            elif place[2] < held[2]:
                held = place
        if held:
            yield held

    def labels_at(self, joined: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
        """(label, start, end) of a place; of a tag's, one for each of the words that follow it."""
        if self.after is None:
            yield self.label, start, end
            return
        while True:
            words = next((w for w in self.longest if joined.startswith(f" {w}", end) and joined[end + len(w) + 1 : end + len(w) + 2] in ("", " ")), None)
            if words is None:
                return
            yield self.after[words], start, end + len(words) + 1
            end += len(words) + 1
            for part in (VERSIONS, EXCEPTION):
                m = part.match(joined, end)
                end = m.end() if m else end
            m = JOINS.match(joined, end)
            if not m:
                return
            start, end = m.end() + 1, m.end()


def compiled(notices: list[tuple[str, str, int]], tag: tuple[str, int, dict[str, str]] | None) -> list[Notice]:
    return [Notice(*n) for n in notices] + ([Notice(tag[0], "", tag[1], tag[2])] if tag else [])


def scan_text(text: str | None, base: dict[str, str], notices: list[Notice]) -> tuple:
    """n_words, base places as word starts, base labels, fuzzy hits (label, start, end, edits, text), the best hit's share of unchanged characters."""
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    joined = " ".join(words)
    padded = f" {joined} "
    starts: list[int] = []
    labels = set()
    for phrase, label in base.items():
        at, last, spaces = padded.find(f" {phrase} "), 0, 0
        while at >= 0:
            spaces += padded.count(" ", last, at)
            starts.append(spaces)
            labels.add(label)
            last, at = at, padded.find(f" {phrase} ", at + 1)
    hits, share = [], 0.0
    for order, n in enumerate(notices):
        last, spaces = 0, 0
        for a, b, edits in n.search(joined):
            for label, x, y in n.labels_at(joined, a, b):
                spaces += joined.count(" ", last, x)
                hits.append((order, label, spaces, spaces + joined.count(" ", x, y), edits, joined[x:y], 1 - edits / len(n.phrase)))
                last = x
    # a place inside a longer one is part of it: the longest notice counts
    end, kept = (-1, -1), []
    for hit in sorted(hits, key=lambda h: (h[2], -h[3])):
        if hit[3] > end[1] or (hit[2], hit[3]) == end:
            end = hit[2], hit[3]
            kept.append(hit)
    share = max((h[6] for h in kept), default=0.0)
    return len(words), starts, labels, [h[1:6] for h in sorted(kept)], share


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, hits array<struct<label:string,first_word:long,last_word:long,edits:int,text:string>>"
)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE_PHRASES,
    notices: list[tuple[str, str, int]] = NOTICES,
    tag: tuple[str, int, dict[str, str]] | None = (TAG, TAG_EDITS, TAG_WORDS),
) -> DataFrame:
    """License labels of each whole text, one row per input row, in one pass without a shuffle.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and hits, the
    places found with edits as word spans with their text.  score is 1 with a base label, else the
    best hit's share of unchanged characters, else 0.  A null or empty text has no words, no places,
    null first_word and last_word, empty labels.  Of overlapping places of one notice the one with fewest edits
    stays, the first in a tie; a place that lies inside a longer one, of whatever notice, is part of that and tells nothing; other
    places of different notices may overlap.  All ids of a tag's expression count.  A text of any length is read whole, in
    time linear in its seeds.  Repeated rows each get their row; other columns, whatever their names, are not
    read; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = compiled(notices, tag)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, starts, labels, hits, share = scan_text(text.as_py(), base, known)
                rows.append((
                    doc, n, len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {h[0] for h in hits})), 1.0 if starts else share,
                    [dict(zip(("label", "first_word", "last_word", "edits", "text"), h)) for h in hits],
                ))
            hit = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("text", pa.string())])
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(hit)]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "hits"]
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, RESULT)
