import sys
import unicodedata
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import ids, measures, text
from quillspark.operators import combine


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_ids(spark):
    assert column(spark, ["148-148801-11", "a-b-", "a-b-c-d", "", "148", "148-148801", "-148801-11", "148--11", "   "], ids.is_valid_id) == [True, True, True, False, False, False, False, False, False]
    assert column(spark, ["148-148801-11"], lambda c: ids.audio_path(c, "/r")) == ["/r/train/148/148801/148-148801-11.wav"]
    assert column(spark, ["148-148801-11"], ids.shard_of) == ["148"]
    with pytest.raises(Exception, match="no shard"):
        column(spark, ["-1-2"], ids.shard_of)


def test_stem(spark):
    assert column(spark, ["/a/b.c/x.tar.gz", "x.wav", "/a/.hidden", "b.", "/a/x/", "plain"], ids.stem) == ["x.tar", "x", ".hidden", "b.", "x", "plain"]


def test_nfkc_folds_and_is_idempotent(spark):
    values = ["คำ", "คํา", "é", "ﬁ", "ａ", None, "plain"]
    got = column(spark, values, lambda c: text.nfkc(c))
    assert got == [None if v is None else unicodedata.normalize("NFKC", v) for v in values]
    assert got[0] == got[1]
    assert column(spark, got, lambda c: text.nfkc(c)) == got


def test_nfkc_is_pythons_for_all_characters_without_python_workers(spark):
    """Each character that Python knows, alone and behind a letter and a mark; a batch of texts in a worker took memory by the texts' length."""
    known = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    values = [x for i in range(0, len(known), 50) for x in (" ".join(known[i : i + 50]), "".join(f"e{k}\u0301\u0323 " for k in known[i : i + 50]))]
    assert column(spark, values, lambda c: text.nfkc(c)) == [unicodedata.normalize("NFKC", v) for v in values]
    rows = spark.createDataFrame([(0, "a", "ﬁ")], "seq long, segment_id string, text string")
    both = combine.combine(rows, rows.select("segment_id", "seq", F.lit("ａ").alias("pred_text")), merge=True)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert [tuple(r) for r in both.collect()] == [(0, "a", "fi", "a")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \t\n\x1c\x85\xa0 ab-")), max_size=8), min_size=1, max_size=20))
def test_strip_is_python_strip(spark, values):
    assert column(spark, values, text.py_strip) == [v.strip() for v in values]


def test_neutralize_and_signature(spark):
    assert column(spark, ["a\tb\nc\rd"], text.neutralize) == ["a b c\rd"]
    assert column(spark, ["a\rb"], lambda c: text.neutralize(c, strict=False)) == ["a b"]
    assert column(spark, ["  x \n  y\t" + "z" * 300], text.error_signature) == [("x y " + "z" * 300)[:160]]


def test_measures(spark):
    assert column(spark, [30.0, 30.01, None], measures.exceeds_window, "double") == [False, True, False]
    assert column(spark, [0, 44, 32044, None], measures.estimate_duration, "bigint") == [0.0, 0.0, 1.0, 0.0]
    assert column(spark, [0.0, 2.0], lambda c: measures.realtime_factor(F.lit(10.0), c), "double") == [0.0, 5.0]
    assert column(spark, [0, 10], lambda c: measures.duration_seconds(F.lit(5), c), "int") == [None, 0.5]


def test_bangkok(spark):
    assert column(spark, [datetime(2024, 1, 1, 20, 0, 5)], text.bangkok, "timestamp") == ["2024-01-02 03:00:05"]
