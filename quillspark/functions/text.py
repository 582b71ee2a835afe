"""Text as column expressions, without Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.strip() removes: the Unicode white space of Java's \s and the four separators U+001C..U+001F.
SPACE = r"[\s\x1c-\x1f]"
SIGNATURE_CHARS = 160


def nfkc(c: Column | str) -> Column:
    """NFKC by the ICU library that Spark has for its collations, text by text: no batch of texts is ever held.

    As unicodedata has it; characters that Unicode took up after Python's version go by ICU's.  reflect() counts as
    nondeterministic, so filters stay above it.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c.cast("string"), F.lit(True)))


def py_strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^﻿+", "")


def neutralize(c: Column, strict: bool = True) -> Column:
    """Tabs and line ends as single spaces; carriage returns too unless strict."""
    return F.translate(c, "\t\n" if strict else "\t\n\r", "  " if strict else "   ")


def error_signature(c: Column) -> Column:
    return F.substring(F.regexp_replace(py_strip(c), rf"(?U){SPACE}+", " "), 1, SIGNATURE_CHARS)


def first_tab(c: Column) -> tuple[Column, Column]:
    """Before and after the first tab; empty text if there is none."""
    parts = F.split(c, "\t", 2)
    return F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


def bangkok(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.from_utc_timestamp(ts, "Asia/Bangkok"), pattern)
