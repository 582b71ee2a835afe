"""Fill-in-middle transformation (operator 12): texts cut in three at unit ends and put in another order.

An Arrow-batched pandas UDF: finditer of the regex library collects the end offsets of a text's units in a compact array,
two lookups there give the cuts, and the seeds of the draws are groups of a SHA-256 digest, so a document's form
depends on its id and text alone, not on partitions or order.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import enter

#: White space and the word behind it, or the white space that ends a text.  Possessive, so runs of spaces cost linear time.
UNIT = regex.compile(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIELDS = "n long, form string, prefix_chars long, middle_chars long"
OUTPUT, DIGESTS = "output string", "output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Draw:
    """Seed of all draws, percent of texts that are transformed, and percent of these that begin with the suffix."""

    seed: int = 42
    rate: int = 50
    suffix_first: int = 80


def unit_ends(text: str) -> array:
    """Offsets, in code points, behind each unit; four bytes a unit."""
    return array("I", (m.end() for m in UNIT.finditer(text)))


def transformed(own: str, text: str, draw: Draw = Draw()) -> tuple[int, str, int | None, int | None, str]:
    """n units, form, code points of prefix and middle, and the output of one text."""
    ends = unit_ends(text)
    n = len(ends)
    h = hashlib.sha256(f"{draw.seed}:{own}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or h3 % 100 >= draw.rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    head, body, tail = text[:a], text[a:b], text[b:]
    if h4 % 100 < draw.suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{body}"
    return n, "psm", a, b - a, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{body}"


def restored(output: str, form: str) -> str:
    """The text that was transformed.  No mark can straddle a cut, as a mark's first and last characters occur in it once."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    at, end = output.index(second), output.index(MIDDLE)
    one, two, body = output[len(first) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return two + body + one if form == "spm" else one + body + two


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", draw: Draw = Draw(), carry: list[str] | None = None, output: bool = True, digests: bool = False
) -> DataFrame:
    """The carried columns (all by default), then n, form (plain, psm or spm), prefix_chars, middle_chars, and output or its digests or both.

    The digests are output_sha256 and restored_sha256, of the output and of the text rebuilt from output and form.
    A null text is empty; empty texts, texts that hold a mark and those that are not drawn are plain, with null
    lengths.  A null id draws as the empty string; rows of one id draw alike, each for its own text.  A carried column
    of a result's name gives way.  One row for each input row; an empty table gives an empty one.
    """
    fields = ", ".join([FIELDS, *([OUTPUT] if output else []), *([DIGESTS] if digests else [])])
    names = [f.split()[0] for f in fields.split(", ")]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in names]

    def row(own: str, text: str) -> tuple:
        *told, made = transformed(own, text, draw)
        return *told, *([made] if output else []), *((sha256(made), sha256(restored(made, told[1]))) if digests else ())

    @F.pandas_udf(fields)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        enter("fill_middle")
        for own, text in batches:
            rows = pd.DataFrame([row(i, t) for i, t in zip(own, text)], columns=names)
            yield rows.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    own = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], run(own, body).alias("_made"))
    return plain.select(*[f"c{i}" for i in range(len(carry))], "_made.*").toDF(*carry, *names)
