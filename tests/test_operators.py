import random
import unicodedata
from datetime import datetime, timedelta
from functools import partial

import pytest

from quillspark.operators import batching, combine, inference, resume, status

NFKC = partial(unicodedata.normalize, "NFKC")
REC, PRED = "seq long, segment_id string, text string", "segment_id string, pred_text string, seq long"


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("seq").collect()]


def test_combining_starts_no_python_workers(spark):
    """Whatever the join, and with long texts, null and empty ones on both sides."""
    long = "คํา ﬁ " * 50_000
    rec = spark.createDataFrame([(0, "a-b-0", long), (1, "a-b-1", None), (2, "a-b-2", "")], REC)
    pred = spark.createDataFrame([("a-b-0", None, 0), ("a-b-1", long, 1)], PRED)
    for hint in (None, "broadcast", "shuffle_hash"):
        out = combine.combine(rec.hint(hint) if hint else rec, pred)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "InArrow" not in plan
        assert rows(out, "orig_text", "pred_text") == [(NFKC(long), ""), (None, NFKC(long)), ("", "")]


@pytest.mark.parametrize("merge", [False, True])
def test_combine(spark, merge):
    rec = spark.createDataFrame([(0, "a-b-0", "é"), (1, "a-b-1", "คํา"), (2, "a-b-2", "x"), (3, "a-b-0", "again")], REC)
    pred = spark.createDataFrame([("a-b-1", "คำ", 0), ("a-b-0", "first", 1), ("9-9-9", "orphan", 2), ("a-b-0", "second", 3)], PRED)
    got = rows(combine.combine(rec, pred, merge=merge), "segment_id", "orig_text", "pred_text")
    assert got == [("a-b-0", "é", "second"), ("a-b-1", NFKC("คำ"), NFKC("คำ")), ("a-b-2", "x", ""), ("a-b-0", "again", "second")]
    assert combine.stats_frame(rec, pred).first().asDict() == {"total_input": 4, "matched": 3, "missing_prediction": 1, "extra_prediction": 1}
    assert rows(combine.missing(rec, pred), "segment_id") == [("a-b-2",)]


def test_empty_prediction_matches(spark):
    rec = spark.createDataFrame([(0, "a-b-0", "x")], REC)
    assert combine.stats_frame(rec, spark.createDataFrame([("a-b-0", "", 0)], PRED)).first()["matched"] == 1


def packed(spark, durations, size, buffer, cap):
    df = spark.createDataFrame([(10 * i, float(d)) for i, d in enumerate(durations)], "seq long, duration double")
    out = batching.assign_batches(df, size, buffer, cap).toPandas()
    return out, [g["duration"].tolist() for _, g in out.sort_values(["win", "batch_no", "slot"]).groupby(["win", "batch_no"])]


def test_batches(spark):
    assert [len(b) for b in packed(spark, [1] * 10, 4, 64, 1e9)[1]] == [4, 4, 2]
    for b in packed(spark, [30, 0.5, 29, 0.6, 28, 0.7], 3, 6, 1e9)[1]:
        assert max(b) - min(b) < 5
    assert all(max(b) * len(b) <= 250 or len(b) == 1 for b in packed(spark, [100] * 4, 16, 64, 250)[1])
    random.seed(1234)
    out, parts = packed(spark, [random.uniform(0.1, 30) for _ in range(257)], 16, 64, 480)
    assert len(out) == 257 and out["seq"].is_unique and all(len(b) <= 16 for b in parts)


def test_dense_position_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(batching, "STRETCH", 8)
    df = spark.range(0, 300, 3).withColumnRenamed("id", "seq")
    assert [r["position"] for r in batching.dense_position(df).orderBy("seq").collect()] == list(range(100))


class Calls:
    def __init__(self, say):
        self.say, self.sizes = say, []

    def transcribe_batch(self, paths):
        self.sizes.append(len(paths))
        return [self.say(p) for p in paths]


def boom(p):
    if "boom" in p:
        raise RuntimeError(f"bad {p}")
    return p


def test_isolation():
    model = Calls(boom)
    assert [e is None for _, e in inference.isolate(model, ["a", "boom"])] == [True, False] and model.sizes == [2, 1, 1]
    assert inference.isolate(model, []) == []
    short = type("Short", (), {"transcribe_batch": lambda self, p: p[1:]})()
    assert all(e for _, e in inference.isolate(short, ["a", "b"]))


def outcomes(spark, spec):
    data = [(i, "x", 0, b, "", s, e, None, None) for i, (b, s, e) in enumerate(spec)]
    return spark.createDataFrame(data, inference.OUTCOME)


def test_gates(spark):
    same = [(b, "failed", "CUDA  gone") for b in (0, 0, 1, 1)]
    with pytest.raises(inference.SystematicFailureError, match="CUDA gone"):
        inference.check_outcomes(outcomes(spark, same))
    differ = [(b, "failed", f"clip {i}") for i, b in enumerate((0, 0, 1, 1))]
    inference.check_outcomes(outcomes(spark, differ))
    with pytest.raises(inference.DeadContextError):
        inference.check_outcomes(outcomes(spark, differ), most=2)
    single = [(b, "failed", "same") for b in (0, 1)]
    inference.check_outcomes(outcomes(spark, single))
    reset = [(0, "failed", "a"), (0, "failed", "a"), (1, "ok", None), (2, "failed", "a"), (2, "failed", "a")]
    inference.check_outcomes(outcomes(spark, reset), most=2)


def test_gates_go_on_over_windows_and_chunks(spark):
    def made(spec, win):
        return spark.createDataFrame([(i, "x", w, b, "", "failed" if e else "ok", e, None, None) for i, (w, b, e) in enumerate(spec)], inference.OUTCOME)

    one = [(0, 0, None), (0, 0, "a"), (0, 1, "p"), (0, 1, "q"), (1, 0, "r"), (1, 0, "s"), (2, 0, "same"), (2, 0, "same")]
    tail = inference.check_outcomes(made(one, 0), most=4)
    assert tail == inference.Tail(3, "same")
    with pytest.raises(inference.DeadContextError, match="3 batches"):
        inference.check_outcomes(made(one, 0), most=3)
    with pytest.raises(inference.SystematicFailureError, match="same"):
        inference.check_outcomes(made([(3, 0, "same"), (3, 0, "same")], 3), most=9, before=tail)
    with pytest.raises(inference.DeadContextError, match="4 batches"):
        inference.check_outcomes(made([(3, 0, "x"), (3, 0, "y"), (3, 1, None)], 3), most=4, before=tail)
    assert inference.check_outcomes(made([(3, 0, "x"), (3, 0, "y"), (3, 1, None)], 3), most=5, before=tail) == inference.Tail(0, None)
    assert inference.check_outcomes(made([], 0), before=tail) == tail


def test_text_ledger(spark, tmp_path):
    (tmp_path / "shard-100.done").write_text("100-1-0\n\ngarbage\n100-1-1\n100-1-1", encoding="utf-8")
    (tmp_path / "shard-7.done").write_text("7-1-0\n", encoding="utf-8")
    (tmp_path / "other.txt").write_text("7-1-9\n")
    got = [tuple(r) for r in resume.read_text_ledger(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted([("100-1-0", "100", None), ("", None, "blank"), ("garbage", None, "malformed"), ("100-1-1", "100", None), ("100-1-1", None, "cut"), ("7-1-0", "7", None)], key=repr)


def test_pending_and_last_attempts(spark):
    rec = spark.createDataFrame([(0, "a-b-0", "x"), (1, "a-b-1", "y"), (2, "c-b-1", "z")], REC)
    when = datetime(2024, 1, 1)
    done = spark.createDataFrame([("r", 0, "a-b-0", "", "failed", "e", None, None, when, 0, 0, "a"), ("r", 1, "a-b-1", "p", "ok", None, None, None, when, 0, 0, "a"), ("s", 1, "a-b-1", "q", "ok", None, None, None, when + timedelta(seconds=1), 0, 0, "a")], resume.LEDGER)
    assert rows(resume.pending(rec, done), "segment_id") == [("c-b-1",)]
    assert rows(resume.pending(rec, done, retry_failed=True), "segment_id") == [("a-b-0",), ("c-b-1",)]
    assert {r["segment_id"]: r["pred_text"] for r in resume.last_attempts(done).collect()} == {"a-b-0": "", "a-b-1": "q"}
    row = status.progress(done).first()
    assert (row["completed"], row["distinct_ids"], row["failed"], row["empty"], row["alarm"]) == (3, 2, 1, 1, False)


def test_manifest_guard(spark, tmp_path):
    p = tmp_path / "in.tsv"
    p.write_text("a-b-0\tx\n")
    ledger = resume.Ledger(spark, str(tmp_path / "c"), str(p))
    ledger.guard(resume.manifest(spark, str(p), "tsv", "f"))
    ledger.guard(resume.manifest(spark, str(p), "tsv", "f"))
    with pytest.raises(resume.CheckpointMismatchError, match="config_fingerprint"):
        ledger.guard(resume.manifest(spark, str(p), "tsv", "g"))
    ledger.guard(resume.manifest(spark, str(p), "tsv", "g"), force=True)
    ledger.guard(resume.manifest(spark, str(p), "tsv", "g"))
    off = resume.Ledger(spark, str(tmp_path / "d"), str(p), enabled=False)
    off.guard(resume.manifest(spark, str(p), "tsv", "f"))
    assert not (tmp_path / "d").exists() and off.read().count() == 0


def test_an_id_without_its_parts_is_an_error_of_its_own():
    from quillspark.functions import ids

    assert ids.path_of("1-2-3-4", "/r") == "/r/train/1/2/1-2-3-4.wav" and ids.path_of("1-2-", "/r").endswith("/1-2-.wav")
    for bad in ("", "148", "148-148801", "-148801-11", "148--11"):
        with pytest.raises(ids.MalformedSegmentIdError):
            ids.path_of(bad, "/r")


def test_models_are_loaded_from_folder_or_hub(monkeypatch, tmp_path):
    import sys
    import types

    from conftest import tone

    from quillspark.operators import inference, models

    options = {"device": "cpu", "model": "/m", "local": True, "lang": "th", "task": "transcribe", "dtype": "float16", "max_new_tokens": 7, "sampling_rate": 16000}
    monkeypatch.setitem(sys.modules, "torch", None)
    with pytest.raises(inference.ModelLoadError, match="torch"):
        models.SpeechModel(options)
    asked = []

    class Part:
        def __init__(self, **parts):
            self.parts = parts

        @classmethod
        def from_pretrained(cls, source, **how):
            asked.append((source, how))
            if source == "/none":
                raise OSError("no folder")
            return cls()

        def to(self, *where):
            asked.append(where)
            return self

        def eval(self):
            return self

        def __call__(self, clips, **how):
            self.input_features, self.n = self, len(clips)
            return self

        def generate(self, heard, **how):
            asked.append(how)
            return heard.n

        def batch_decode(self, n, skip_special_tokens):
            return [" text "] * n

    names = ("WhisperFeatureExtractor", "WhisperTokenizer", "WhisperProcessor", "WhisperForConditionalGeneration")
    import contextlib

    monkeypatch.setitem(sys.modules, "torch", types.SimpleNamespace(float16="half", bfloat16="brain", float32="whole", no_grad=contextlib.nullcontext))
    monkeypatch.setitem(sys.modules, "transformers", types.SimpleNamespace(**{n: Part for n in names}))
    model = models.SpeechModel(options)
    clip = str(tone(tmp_path / "a.wav", 800))
    assert inference.isolate(model, [clip, clip]) == [("text", None)] * 2 and model.transcribe_batch([]) == []
    assert ("/m", {"torch_dtype": "half", "local_files_only": True}) in asked and {"language": "th", "task": "transcribe", "max_new_tokens": 7} in asked
    for change in ({"model": "/none"}, {"dtype": "int4"}):
        with pytest.raises(inference.ModelLoadError):
            models.SpeechModel(options | change)
