"""SentencePiece encoding and decoding (operator 9): streaming Viterbi.

The best segmentation of a text is found while it streams by.  Only a window of a few times `longest`
characters, `longest` being the longest piece, is kept of the scores; ids are committed as soon as the
backpointer paths of all positions that are still open run through one boundary.  Memory so depends
on the lattice's ambiguity and not on the text's length.

Pieces that may hold a space do so only at their start or as runs of spaces, so all paths meet before each run
of spaces.  The stream is cut there, and what it commits for a word is kept in a bounded table.  Scores are whole
numbers, so sums are exact and the cuts change nothing: streaming a text whole gives the same ids.
"""

from __future__ import annotations

import functools
import math
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, enter

SPACE = "▁"
#: Scores are counted in whole units of this share of a nat.
UNITS = 1 << 16
#: Below every sum of scores.
NEVER = -(1 << 60)


class PieceModel:
    """Pieces and their log-probabilities, read from a model file's vocabulary.

    A vocabulary of merges has ranks in place of probabilities; then a piece of rank r scores
    -log(r + 10), the law of Zipf up to a constant.  Characters outside the vocabulary become byte pieces.
    """

    def __init__(self, pieces: list[str], scores: list[float], ranked: bool, byte_ids: dict[int, int], unknown: int, special: set[int]):
        self.ids: dict[str, int] = {}
        self.pieces = pieces
        self.byte_ids, self.unknown, self.special = byte_ids, unknown, special
        self.bytes_of = {i: b for b, i in byte_ids.items()}
        self.score: dict[str, float] = {}
        for i, p in enumerate(pieces):
            if i not in special and i not in self.bytes_of and p:
                self.ids[p] = i
                self.score[p] = round(UNITS * (-math.log(10 - scores[i]) if ranked else scores[i]))
        self.longest = max(map(len, self.ids), default=1)
        self.fallback = min(self.score.values(), default=-UNITS) - 10 * UNITS
        # pieces by their characters; a piece's score is under the empty string where it ends
        self.tree: dict = {}
        for p, s in self.score.items():
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = s

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        scores = [sp.get_score(i) for i in range(n)]
        byte_ids = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        # words are cut before their spaces, which no piece may then span
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for i, p in enumerate(pieces) if i not in special):
            raise ValueError("a piece has a space after another character")
        ranked = min(scores, default=0) < -1000
        return cls(pieces, scores, ranked, byte_ids, sp.unk_id(), special)

    def spelled(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.replace(LITERAL, SPACE).encode()]

    def advance(self, text: str, best: list[int], back: list[int], begin: int, end: int) -> None:
        """Take up all pieces that start at begin, .. end - 1 of a text."""
        tree, fallback = self.tree, self.fallback
        for a in range(begin, end):
            own, node, b = best[a], tree, a
            for c in text[a:]:
                node = node.get(c)
                if node is None:
                    break
                b += 1
                if "" in node:
                    value = own + node[""]
                    if value > best[b]:
                        best[b], back[b] = value, a
            if own + fallback > best[a + 1]:
                best[a + 1], back[a + 1] = own + fallback, a

    def stream(self, text: str) -> Iterator[list[int]]:
        """Committed ids, in parts, of a text with its spaces as SPACE."""
        longest, n, begin = self.longest, len(text), 0
        # of the characters after the last committed boundary: how many starts are taken up,
        # and each boundary's best score and where the last piece to it starts
        done, best, back = 0, [0], [0]
        while begin < n:
            stop = min(n - begin, done + longest)
            window = text[begin : begin + stop + longest]
            room = len(window) + 1 - len(best)
            best += [NEVER] * room
            back += [0] * room
            self.advance(window, best, back, done, stop)
            if begin + stop == n:
                yield self.path(window, back)
                return
            # what follows goes on from one of the boundaries reached: where all their paths meet is final
            live = {i for i in range(stop, len(best)) if best[i] > NEVER}
            while len(live) > 1:
                top = max(live)
                live.discard(top)
                live.add(back[top])
            meet = live.pop()
            done = stop - meet
            if meet:
                yield self.path(window[:meet], back)
                base = best[meet]
                best = [x - base if x > NEVER else x for x in best[meet:]]
                back = [max(0, x - meet) for x in back[meet:]]
                begin += meet

    def path(self, text: str, back: list[int]) -> list[int]:
        """The ids along the backpointers from the text's end, in order."""
        out: list[int] = []
        ids, end = self.ids, len(text)
        while end:
            start = back[end]
            own = ids.get(text[start:end])
            if own is not None:
                out.append(own)
            else:
                out += reversed(self.spelled(text[start:end]))
            end = start
        out.reverse()
        return out


#: Stands for SPACE in a text itself, which is spelled in bytes; no valid text holds this code point.
LITERAL = "\udfff"
#: Words with the spaces before them: no piece holds SPACE after another character, so the lattice
#: has a boundary before each run of spaces.
RUN = re.compile(f"{SPACE}+[^{SPACE}]*")


def prepared(text: str) -> str:
    """Spaces as SPACE, one in front: nothing else is normalised, so decoding gives the text back."""
    return SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)


class Words:
    """What the stream commits for words (a run of SPACE and what follows), as little-endian 32-bit ids."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.known = Remembered(self.ids_of)

    def ids_of(self, word: str) -> bytes:
        ids = array("I")
        for part in self.model.stream(word):
            ids.extend(part)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


@functools.lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(PieceModel.load(path))


def encode(text: str, words: Words) -> bytes:
    """The text's ids as bytes; words are streamed once and then looked up."""
    return b"".join(map(words.known.__getitem__, RUN.findall(prepared(text)))) if text else b""


@functools.lru_cache(maxsize=2)
def spelling(model: PieceModel) -> list[bytes]:
    """The bytes of each id."""
    return [bytes([model.bytes_of[i]]) if i in model.bytes_of else b"" if i in model.special else p.replace(SPACE, " ").encode() for i, p in enumerate(model.pieces)]


def decode(ids: bytes, model: PieceModel) -> str:
    """The text of ids that encode() made."""
    return b"".join(map(spelling(model).__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")[1:]


def forget() -> None:
    words_of.cache_clear()
    spelling.cache_clear()


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of each whole text; no ids for null or empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("piece_coding", forget)
        words = words_of(path)
        for batch in batches:
            ids = [encode(t.as_py() or "", words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows that encode_pieces() made; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("piece_coding", forget)
        model = words_of(path).model
        for batch in batches:
            texts = [decode(x.as_py() or b"", model) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long"), F.col(ids_col)).mapInArrow(run, "doc_id long, text string")


def code_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids_crc32 and round_trip (decoding gives the text back) of each whole text.

    A null text is empty: no ids, CRC 0, a round trip.  One row per input row, repeated rows too; of equally good
    segmentations the one with the longer last piece counts; a word of any length streams in windows; an empty table
    gives an empty one; extra columns, whatever their names, are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("piece_coding", forget)
        words = words_of(path)
        for batch in batches:
            rows = []
            for t in batch.column(1):
                text = t.as_py() or ""
                ids = encode(text, words)
                back = decode(ids, words.model)
                rows.append((len(ids) // 4, zlib.crc32(ids), back == text))
            columns = list(zip(*rows)) or [[], [], []]
            new = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *new], ["doc_id", "n_ids", "ids_crc32", "round_trip"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
