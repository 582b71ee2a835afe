"""Line dedup (operator 10): overlapping windows of three lines.

Every run of three consecutive lines is hashed to 128 bits; of equal windows the first in the
order (doc_id, line) stays, and the lines that later ones cover are removed together.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

LINES = 3


def windows(lines: Column, size: int) -> Column:
    """Hash pairs of the windows of an array of lines; blank windows (white space only) get nulls."""

    def hashed(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(size)]
        blank = F.length(F.trim(F.translate(F.concat(*part), "\t\r ", "   "))) == 0
        a = F.xxhash64(*part)
        return F.when(~blank, F.struct(a.alias("a"), F.xxhash64(F.lit(7), *part[::-1]).alias("b")))

    n = F.size(lines) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), hashed))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = LINES) -> DataFrame:
    """Remove the lines of later occurrences of repeated windows of `size` lines.

    Returns the input columns with the text replaced, then n_lines and n_removed (input columns of these two
    names give way).  Lines end at \\n.  Texts of fewer lines, null and empty texts stay as they are; windows
    of blank lines alone do not count; windows never cross documents but repeats within one do
    count.  Documents whose lines are all removed keep an empty text.  Rows of equal id are told apart
    by their text's hash only, so exact repeats of a row with the same id are treated alike.  A null id
    sorts first.  An empty table gives an empty one.

    The windows are exchanged as two hashes, id and line, partially reduced to the first of each window;
    texts move once, when the removed lines are joined to them.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # inner names of our own, whatever the input's are
    inner = {c: f"c{i}" for i, c in enumerate(names)}
    plain = docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in names])
    text = F.col(inner[text_col])
    lines, key = F.split(text, "\n", -1), F.struct(F.col(inner[id_col]).alias("i"), F.xxhash64(text).alias("t"))
    # the array is a column of its own: inside a lambda an expression would be computed for each line
    split = plain.select(key.alias("_k"), lines.alias("_lines"))
    placed = split.select("_k", F.posexplode(windows(F.col("_lines"), size)).alias("_at", "_w")).where("_w is not null")
    # read twice below, so written once: four numbers a line
    placed = settle(placed.select("_k", "_at", F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b")))
    first = placed.groupBy("_a", "_b").agg(F.min(F.struct("_k", "_at")).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    later = placed.join(first, ["_a", "_b"]).where(~F.struct("_k", "_at").eqNullSafe(F.col("_first")))
    # sets of line numbers, at most one for each line of a document
    gone = later.groupBy(F.col("_k").alias("_g")).agg(F.collect_set("_at").alias("_starts"))
    joined = plain.withColumn("_k", key).join(gone, F.col("_k").eqNullSafe(F.col("_g")), "left").withColumn("_lines", lines)
    covered = F.array_distinct(F.flatten(F.transform("_starts", lambda i: F.sequence(i, i + (size - 1)))))
    joined = joined.withColumn("_covered", covered)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_covered")
    rest = F.when(F.col("_starts").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n"))
    out = joined.select(
        *[rest.alias(inner[c]) if c == text_col else F.col(inner[c]) for c in names],
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long"), F.coalesce(F.size("_covered"), F.lit(0)).cast("long"),
    )
    return out.toDF(*names, "n_lines", "n_removed")
