import pytest
from conftest import dump, tone

from quillspark.sources import audio, sinks, transcripts


def records(spark, path, fmt=None):
    kept, bad = transcripts.read_transcripts(spark, str(path), "/r", fmt)
    return [r.asDict() for r in kept.orderBy("seq").collect()], {r["reject_reason"]: r["seq"] for r in bad.collect()}


def test_messy_tsv(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text("\n﻿no tab\n   \n100-1-0\tx\n \ttext\nnope\ty\n100-1-1\ta\tb\n100-1-2\t\n", encoding="utf-8")
    kept, bad = records(spark, p)
    assert [(r["segment_id"], r["text"]) for r in kept] == [("100-1-0", "x"), ("100-1-1", "a\tb"), ("100-1-2", "")]
    assert [r["seq"] for r in kept] == [3, 6, 7]
    assert set(bad) == {"blank", "no_tab", "empty_id", "malformed_id"}
    assert kept[0]["audio_filepath"] == "/r/train/100/1/100-1-0.wav"


def test_byte_order_mark_and_order_over_splits(spark, tmp_path):
    p = tmp_path / "b.tsv"
    p.write_text("﻿﻿" + "".join(f"1-2-{i}\tt{i}\n" for i in range(5000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        kept, _ = records(spark, p)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["seq"], r["text"]) for r in kept] == [(i, f"t{i}") for i in range(5000)]


def test_jsonl(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"audio_filepath": "/x/a-1.wav", "text": "t", "duration": 0.5}\nnot json\n\n[1]\n{"audio_filepath": "s/b.tar.gz", "text": null, "duration": "1"}\n{"text": "x"}\n{"audio_filepath": "/c.wav", "text": true, "duration": true}\n{"audio_filepath": "/-c.wav"}\n{"audio_filepath": 5}\n{"audio_filepath": "/d.wav", "duration": 3}\n')
    kept, bad = records(spark, p)
    assert [(r["segment_id"], r["text"], r["audio_filepath"], r["duration"]) for r in kept] == [
        ("a-1", "t", "/x/a-1.wav", 0.5), ("b.tar", "", "/r/s/b.tar.gz", None), ("c", "True", "/c.wav", 1.0), ("d", "", "/d.wav", 3.0)]
    assert set(bad) == {"blank", "invalid_json", "no_path", "no_shard"}


def test_detection(spark, tmp_path):
    p = dump(tmp_path / "misnamed.tsv", [{"audio_filepath": "/a.wav"}])
    assert transcripts.detect_format(spark, p) == "jsonl"
    (tmp_path / "empty.JSONL").write_text("")
    assert transcripts.detect_format(spark, str(tmp_path / "empty.JSONL")) == "jsonl"
    assert transcripts.detect_format(spark, str(tmp_path / "absent.txt")) == "tsv"
    with pytest.raises(ValueError):
        transcripts.read_transcripts(spark, p, "/r", "csv")


def test_probe_and_decode(spark, tmp_path):
    ok, stereo, slow = tone(tmp_path / "a.wav", 1600), tone(tmp_path / "b.wav", 1600, channels=2), tone(tmp_path / "c.wav", 4000, rate=8000)
    (tmp_path / "bad.wav").write_text("no audio")
    paths = [str(ok), str(stereo), str(slow), str(tmp_path / "bad.wav"), str(tmp_path / "none.wav"), None]
    df = audio.probe(spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "seq long, audio_filepath string"))
    got = {r["seq"]: r for r in df.collect()}
    assert [got[i]["is_readable"] for i in range(6)] == [True, True, True, False, False, False]
    assert got[2]["probe"]["sample_rate"] == 8000 and got[2]["probe"]["duration_seconds"] == 0.5
    assert got[4]["probe"]["error"] == "missing" and not got[4]["probe"]["exists"] and got[3]["probe"]["exists"]
    plan = {r["seq"]: (r["action"], r["over_window"]) for r in audio.plan_decoding(df, limit=0.4).collect()}
    assert [plan[i] for i in range(6)] == [("pass", False), ("convert", False), ("convert", True), ("reject", False), ("reject", False), ("reject", False)]
    assert audio.plan_decoding(df, resample=False).where("action = 'reject'").count() == 5
    row = audio.summarize(df).first()
    assert (row["readable"], row["missing"], row["non_conforming"], row["over_window"]) == (3, 3, 2, 0)
    assert len(audio.load_samples(str(slow))) == 8000 and audio.load_samples(str(stereo)).ndim == 1
    with pytest.raises(audio.AudioError):
        audio.load_samples(str(tmp_path / "bad.wav"))


def test_convert(tmp_path):
    made = audio.convert(str(tone(tmp_path / "in" / "c.v2.wav", 4000, rate=8000, channels=2)), str(tmp_path / "out"), audio.Shape())
    assert made == str(tmp_path / "out" / "c.v2.wav") and audio.probe_file(made)[:4] == (True, 16000, 1, 0.5)
    samples = audio.load_samples(made)
    assert 0.2 < abs(samples).max() < 0.3  # the tone is there, at its loudness
    (tmp_path / "odd.mp3").write_text("no audio")
    with pytest.raises(audio.AudioError, match="odd.mp3"):
        audio.convert(str(tmp_path / "odd.mp3"), str(tmp_path / "out"), audio.Shape(program="no-such-program"))


@pytest.mark.parametrize("body,left,gone", [(b"a\nb", b"a\n", 1), (b"a\n", b"a\n", 0), (b"abc", b"", 3), (b"", b"", 0), (b"x\n" + b"y" * 20000, b"x\n", 20000)])
def test_tail_repair(tmp_path, body, left, gone):
    p = tmp_path / "f"
    p.write_bytes(body)
    assert sinks.drop_cut_tail(str(p)) == gone and p.read_bytes() == left
    assert sinks.drop_cut_tail(str(tmp_path / "none")) == 0


def test_lines_have_one_tab_and_keep_fields(spark):
    df = spark.createDataFrame([(0, "1-2-3", "a\tb\nc", None, 0.5)], "seq long, segment_id string, pred_text string, audio_filepath string, duration double")
    assert sinks.prediction_lines(df, "tsv").first()["value"] == "1-2-3\ta b c"
    assert sinks.prediction_lines(df, "jsonl").first()["value"] == '{"audio_filepath":"","text":"a\\tb\\nc","duration":0.5}'


def test_registered_format(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1-2-3;a\n")

    def parse(lines, root):
        return transcripts.parse_tsv(lines.selectExpr("seq", "replace(value, ';', '\t') as value"), root)

    transcripts.register_format("semicolon", parse)
    kept, _ = records(spark, tmp_path / "x.csv", "semicolon")
    assert [(r["segment_id"], r["text"]) for r in kept] == [("1-2-3", "a")]
