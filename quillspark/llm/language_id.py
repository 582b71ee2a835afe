"""Language ID (operator 8): compression classification with zstandard.

A language's dictionary is raw content: labelled texts of it, up to DICTIONARY_BYTES.  A text is cut in
blocks, each block compressed with each language's dictionary, and the language with the smallest sum is
chosen.  Texts whose best two sums are close are rejected.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import enter

#: Bounds of the sample that a model is made of: bytes and texts of a language, bytes of a text, bytes of the model, languages.
DICTIONARY_BYTES = 1 << 16
SAMPLE_TEXTS = 400
TEXT_BYTES = 1 << 11
MODEL_BYTES = 1 << 24
LABELS = 1 << 14
#: zstandard's level and its shortest match: matches of three bytes tell short texts apart.
LEVEL, MATCH = 9, 3
#: Bytes of text compressed at once; a longer text is many blocks, so each is coded by the dictionary.
BLOCK = 1 << 11
#: The second best sum exceeds the best by less than this share of it: rejected.
MARGIN = 0.005
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def held_out(id_col: str = "doc_id") -> Column:
    """Never null: a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language of the labelled rows (text and lang not null).

    Every label has its dictionary, an empty line where all its texts are empty.  The sample of a language is of its distinct
    texts, in the order of a hash of the text: at most SAMPLE_TEXTS of them and as many as fill the dictionary.  Ids play no part,
    so repeated and null ids change nothing, and a text that many rows repeat counts once.  Distinct texts are estimated
    over all rows first, so that about twice as many as are wanted are looked at; a language of few texts keeps all.  What
    is collected is as large as the model, MODEL_BYTES at most; beyond LABELS languages a ValueError says so.
    Without labelled rows the model is empty.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.where(text.isNotNull() & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.xxhash64(text, F.lit(8)).alias("h"), F.substring(text.cast("binary"), 1, TEXT_BYTES).alias("t")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(LABELS + 1).collect()}
    if len(counts) > LABELS:
        raise ValueError(f"more than {LABELS} languages")
    if not counts:
        return {}
    room = min(DICTIONARY_BYTES, MODEL_BYTES // len(counts))
    # about twice the texts wanted pass, evenly over the range of the hash
    bar = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * SAMPLE_TEXTS / max(1, n)))])
    passed = rows.where((F.col("h") / F.lit(2.0**63)) <= F.try_element_at(bar, F.col("lang")) * 2 - 1)
    texts = passed.groupBy("lang", "h").agg(F.min("t").alias("t"))
    order = Window.partitionBy("lang").orderBy("h")
    placed = texts.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_TEXTS)
    before = F.coalesce(F.sum(F.octet_length("t") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    model: dict[str, list[bytes]] = {k: [] for k in counts}
    for r in placed.withColumn("before", before).where(F.col("before") < room).select("lang", "nth", "t").orderBy("lang", "nth").collect():
        model[r["lang"]].append(bytes(r["t"]).decode("utf-8", "ignore").lower().encode())
    # the end of a dictionary is the cheapest to refer to; all texts end in a line end
    return {lang: b"\n".join(found)[:room] or b"\n" for lang, found in sorted(model.items())}


@functools.lru_cache(maxsize=4)
def coders(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MATCH, write_content_size=False, write_checksum=False, write_dict_id=False)
    for lang, content in model:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(compression_params=how)
        out.append((lang, zstandard.ZstdCompressor(compression_params=how, dict_data=kept)))
    return out


def classify(text: str, model: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """The language, a score (the margin over the second best), and whether it is rejected."""
    if not model or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    text = text.lower().encode()
    sums = []
    parts = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    for lang, coder in model:
        sums.append((sum(len(coder.compress(p)) for p in parts), lang))
    sums.sort()
    if len(sums) == 1:
        return sums[0][1], 1.0, False
    margin = (sums[1][0] - sums[0][0]) / max(1, sums[0][0])
    return sums[0][1], min(1.0, margin), margin < MARGIN


def identify(docs: DataFrame, model: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default), then lang_pred, score and rejected, from the whole text alone.

    A null text, or one without a letter, is `und`, rejected, score 0; so is every text under an empty
    model.  A carried column of a result's name gives way.  Ties go to the language first in the alphabet and are rejected.  One row per input row.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("lang_pred", "score", "rejected")]
    parts = docs.sparkSession.sparkContext.broadcast(tuple(model.items()))
    schema = docs.select(*[F.col(f"`{c}`") for c in carry]).schema
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("language_id", coders.cache_clear)
        known = coders(parts.value)
        for batch in batches:
            found = [classify(t.as_py(), known) for t in batch.column(batch.num_columns - 1)]
            columns = list(zip(*found)) or [[], [], []]
            new = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [f"c{i}" for i in range(len(carry))] + ["lang_pred", "score", "rejected"])

    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], body.alias("_body"))
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    return plain.mapInArrow(run, f"{fields}{', ' if fields else ''}lang_pred string, score double, rejected boolean").toDF(*carry, "lang_pred", "score", "rejected")
