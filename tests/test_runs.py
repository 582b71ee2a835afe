import glob

import pytest
from conftest import IDS, tone

from quillspark.operators import inference
from quillspark.plans import cli, config, runs
from quillspark.streaming import folder


class NeverBuilt:
    def __init__(self, options):
        raise AssertionError("built")


def ledger(spark, cfg, path):
    return {r["segment_id"]: (r["status"], r["pred_text"]) for r in runs.ledger_of(spark, cfg, str(path)).latest().collect()}


def text_of(path):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_limit_resume_and_rerun(spark, corpus):
    path, cfg, _ = corpus
    one = runs.run_inference(spark, str(path), cfg, limit=2)
    assert (one["seen"], one["ok"], one["resumed"]) == (2, 2, 0)
    two = runs.run_inference(spark, str(path), cfg)
    assert (two["resumed"], two["ok"]) == (2, 3)
    three = runs.run_inference(spark, str(path), cfg)
    assert (three["resumed"], three["ok"], three["seen"]) == (5, 0, 0)
    again = runs.run_inference(spark, str(path), cfg, use_resume=False)
    assert again["ok"] == 5 and ledger(spark, cfg, path)[IDS[0]] == ("ok", f"pred:{IDS[0]}")
    assert runs.told(runs.run_combine(spark, str(path), cfg)) == "total_input=5 matched=5 missing_prediction=0 extra_prediction=0"
    lines = text_of(f"{cfg.paths.output_dir}/combined-in.tsv").splitlines()
    assert lines[0] == "segment_id\torig_text\tpred_text" and [x.split("\t")[0] for x in lines[1:]] == IDS
    assert len(text_of(runs.export_predictions(spark, str(path), cfg)).splitlines()) == 5


def test_ids_of_a_text_ledger_are_done(spark, corpus):
    path, cfg, tmp = corpus
    (tmp / "ckpt" / "in").mkdir(parents=True)
    (tmp / "ckpt" / "in" / "shard-7.done").write_text(f"{IDS[0]}\n{IDS[1]}\n{IDS[2]}")
    row = runs.run_inference(spark, str(path), cfg)
    assert (row["resumed"], row["ok"]) == (2, 3) and set(ledger(spark, cfg, path)) == set(IDS[2:])


def test_a_ledger_switched_off_resumes_nothing_and_keeps_predictions(spark, corpus):
    path, cfg, _ = corpus
    cfg.checkpoint.enabled = False
    for _ in range(2):
        row = runs.run_inference(spark, str(path), cfg)
        assert (row["ok"], row["resumed"]) == (5, 0)
    made = runs.ledger_of(spark, cfg, str(path))
    assert made.read().count() == 5 and made.done().count() == 0 and not made.spark.sparkContext._jvm.java.io.File(made.manifest_path).exists()
    assert runs.run_combine(spark, str(path), cfg)["matched"] == 5


def test_missing_audio_and_poison(spark, corpus):
    path, cfg, tmp = corpus
    (tmp / "audio/train/7/31" / f"{IDS[0]}.wav").unlink()
    bad = "22-5-boom"
    (tmp / "audio/train/22/5" / f"{IDS[3]}.wav").rename(tmp / "audio/train/22/5" / f"{bad}.wav")
    path.write_text(path.read_text().replace(IDS[3] + "\t", bad + "\t"))
    stats = runs.run_inference(spark, str(path), cfg)
    assert (stats["unreadable"], stats["failed"], stats["ok"]) == (1, 1, 3)
    got = ledger(spark, cfg, path)
    assert got[bad] == ("failed", "") and IDS[0] not in got
    assert runs.run_inference(spark, str(path), cfg)["resumed"] == 4
    runs.run_combine(spark, str(path), cfg)
    assert text_of(f"{cfg.paths.log_dir}/missing-in.txt") == f"{IDS[0]}\n"


def test_dead_model_commits_nothing(spark, corpus):
    path, cfg, _ = corpus

    class Broken:  # local, so that workers get it by value
        def __init__(self, options):
            pass

        def transcribe_batch(self, paths):
            raise RuntimeError("device lost")

    with pytest.raises((inference.DeadContextError, inference.SystematicFailureError)):
        runs.run_inference(spark, str(path), cfg, Broken)
    assert ledger(spark, cfg, path) == {}


def test_clips_are_converted_and_options_arrive(spark, corpus):
    path, cfg, tmp = corpus
    tone(tmp / "audio/train/7/31" / f"{IDS[1]}.wav", 4000, rate=8000, channels=2)
    cfg.model.dtype, cfg.model.max_new_tokens = "float32", 17

    class Telling:  # what it was given: options, and the shape of each clip
        def __init__(self, options):
            self.options = options

        def transcribe_batch(self, paths):
            from quillspark.sources import audio

            return [f"{audio.probe_file(p)[1:3]} {self.options['dtype']} {self.options['max_new_tokens']} {self.options['sampling_rate']}" for p in paths]

    row = runs.run_inference(spark, str(path), cfg, Telling)
    assert row["ok"] == 5 and set(ledger(spark, cfg, path).values()) == {("ok", "(16000, 1) float32 17 16000")}
    cfg.audio.resample_on_the_fly = False
    assert runs.run_inference(spark, str(path), cfg, Telling, use_resume=False)["ok"] == 4


def test_chunks_commit_on_the_way_and_leave_no_tables(spark, corpus, caplog):
    path, cfg, tmp = corpus
    cfg.batch.sort_buffer_size, cfg.checkpoint.flush_every_n, cfg.runtime.progress_every_n = 2, 1, 2
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(glob.glob(f"{shared}/*"))
    with caplog.at_level("INFO", logger="quillspark"):
        assert runs.run_inference(spark, str(path), cfg, chunk=1)["ok"] == 5
    assert sum("clips done" in r.getMessage() for r in caplog.records) >= 2
    assert set(glob.glob(f"{shared}/*")) == before
    pace = runs.Pace(cfg, 4)
    assert pace.windows == 2 and pace.grain == 1
    pace.took(cfg.checkpoint.flush_every_seconds / 10)
    assert pace.windows == 4
    for wanted in (2, 1, 1):
        pace.took(cfg.checkpoint.flush_every_seconds * 10)
        assert pace.windows == wanted
    wide = runs.Pace(cfg, 640)
    assert (wide.windows, wide.grain, wide.grains()) == (320, 20, 16)
    for _ in range(9):
        wide.took(cfg.checkpoint.flush_every_seconds * 10)
    assert (wide.windows, wide.grains()) == (20, 1)  # below what was guessed first


def test_clips_over_the_window_are_journalled_and_transcribed(spark, corpus):
    import json

    path, cfg, tmp = corpus
    tone(tmp / "audio/train/7/31" / f"{IDS[0]}.wav", 31 * 16000)
    tone(tmp / "audio/train/7/31" / f"{IDS[1]}.wav", 30 * 16000)
    row = runs.run_inference(spark, str(path), cfg)
    assert (row["ok"], row["over_window"]) == (5, 1) and ledger(spark, cfg, path)[IDS[0]][0] == "ok"
    told = [json.loads(x) for p in glob.glob(f"{cfg.paths.log_dir}/errors/part-*") for x in open(p)]
    assert [(t["segment_id"], t["reason"]) for t in told] == [(IDS[0], "31.0 s is over the window of 30.0 s, the text may be cut")]
    assert told[0]["audio_path"].endswith(f"{IDS[0]}.wav")


def test_a_dead_model_stops_its_chunk_early(spark, tmp_path):
    """Of 64 batches in 16 windows each worker tries a few, then the job is cancelled; nothing of it is left."""
    from pyspark.sql import functions as F

    calls = str(tmp_path / "calls")

    class Dying:
        def __init__(self, options):
            pass

        def transcribe_batch(self, paths):
            import time

            open(calls, "a").write("x\n" * (len(paths) > 1))
            time.sleep(0.05)
            raise RuntimeError(f"lost {paths}")

    clips = spark.range(256).select(F.col("id").alias("seq"), F.concat(F.lit("1-1-"), "id").alias("segment_id"), F.concat(F.lit("/x/"), "id").alias("audio_filepath"), F.lit(1.0).alias("duration"))
    batches = clips.withColumns({"win": F.expr("seq div 16"), "batch_no": F.expr("seq % 16 div 4"), "slot": F.expr("seq % 4")})
    with pytest.raises(inference.DeadContextError, match="3 batches in a row failed"):
        with inference.guarded(spark, 3, "run-x") as guard:
            inference.transcribe(batches, Dying, tasks=8, guard=guard).write.parquet(str(tmp_path / "out"))
    assert len(open(calls).readlines()) < 32
    same = type("Same", (Dying,), {"transcribe_batch": lambda self, paths: (_ for _ in ()).throw(RuntimeError("all alike"))})
    with pytest.raises(inference.SystematicFailureError, match="all alike"):
        with inference.guarded(spark, 3, "run-y") as guard:
            inference.transcribe(batches, same, tasks=4, guard=guard).count()
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None and spark.range(3).count() == 3


def test_a_model_that_cannot_be_loaded(spark, corpus):
    path, cfg, _ = corpus

    class Absent:
        def __init__(self, options):
            raise OSError("no such folder")

    with pytest.raises(inference.ModelLoadError, match="no such folder"):
        runs.run_inference(spark, str(path), cfg, Absent)
    cfg.model.dtype = "bf8"
    with pytest.raises(inference.ModelLoadError, match="bf8"):
        runs.run_inference(spark, str(path), cfg)


def test_clips_of_the_next_batch_are_made_ready_meanwhile(tmp_path, monkeypatch):
    import os
    import time

    import pandas as pd

    from quillspark.sources import audio

    made = []

    def convert(path, folder, shape):
        made.append((path, time.time()))
        os.makedirs(folder)
        where = os.path.join(folder, "clip.wav")
        open(where, "w").write(path)
        if path == "b1":
            raise audio.AudioError("cannot")
        return where

    monkeypatch.setattr(audio, "convert", convert)
    parts = [pd.DataFrame({"p": [f"{b}{k}" for k in range(4)], "action": ["convert"] * 3 + ["pass"]}) for b in "abc"]
    folders, ends = set(), []
    for part, ready in inference.ready_batches(iter(parts), "p", audio.Shape(), 3):
        time.sleep(0.2)
        ends.append(time.time())
        own = part["p"].tolist()
        assert [e is None for _, e in ready] == [p != "b1" for p in own] and ready[3] == (own[3], None)
        assert [open(w).read() for (w, e), p in zip(ready[:3], own) if e is None] == [p for p in own[:3] if p != "b1"]
        folders |= {os.path.dirname(os.path.dirname(w)) for w, e in ready[:3] if e is None}
        assert sum(os.path.isdir(f) for f in folders) == 1  # of the batches before nothing is left
    begun = {p: t for p, t in made}
    assert len(folders) == 3 and max(begun[p] for p in ("b0", "b1", "b2")) < ends[0] and max(begun[p] for p in ("c0", "c1", "c2")) < ends[1]
    assert len(list(inference.ready_batches(iter([]), "p", audio.Shape(), 3))) == 0


def test_a_task_takes_the_gpu_that_it_is_given(monkeypatch):
    profile = inference.gpu_profile(0.5)
    assert profile.taskResources["gpu"].amount == 0.5
    given = type("Given", (), {"addresses": ["3"]})
    monkeypatch.setattr(inference.TaskContext, "get", classmethod(lambda cls: type("T", (), {"resources": lambda self: {"gpu": given}})()))
    assert inference.placed({"device": "cuda:0", "x": 1}) == {"device": "cuda:3", "x": 1}
    monkeypatch.setattr(inference.TaskContext, "get", classmethod(lambda cls: None))
    assert inference.placed({"device": "cpu"}) == {"device": "cpu"}


def test_dry_run_builds_no_model_and_leaves_no_trace(spark, corpus):
    path, cfg, tmp = corpus
    stats = runs.run_inference(spark, str(path), cfg, NeverBuilt, dry_run=True)
    assert (stats["seen"], stats["unreadable"]) == (5, 0) and round(stats["seconds"], 2) == 0.8
    assert not (tmp / "ckpt").exists()


def test_cli(spark, corpus, tmp_path, capsys):
    import json

    path, cfg, tmp = corpus
    conf = tmp / "c.json"
    conf.write_text(json.dumps({"paths": vars(cfg.paths), "device": {"prefer": ["cpu"]}, "batch": {"batch_size": 2}}))
    args = ["--config", str(conf), "--input", str(path)]
    assert cli.main(["status", *args], spark) == 0
    assert cli.main(["combine", *args], spark) == 2
    assert cli.main(["validate", *args], spark) == 0
    assert cli.main(["run", *args], spark) == 0
    assert cli.main(["combine", *args, "--low-memory", "--format", "jsonl", "--output", str(tmp / "o.jsonl")], spark) == 0
    assert json.loads(text_of(tmp / "o.jsonl").splitlines()[0])["pred_text"] == f"pred:{IDS[0]}"
    assert cli.main(["status", *args], spark) == 0
    said = capsys.readouterr().out
    assert "completed=5" in said and "ledger file:" in said and " MB" in said
    assert cli.main(["transcribe", *args, "--device", "cuda:0"], spark) == 4 or not config.cuda_devices() == 0
    assert cli.main(["transcribe", *args, "--cuda-index", "0"], spark) == 4 or not config.cuda_devices() == 0
    path.write_text(path.read_text() + "7-31-z\tnew\n")
    assert cli.main(["transcribe", *args], spark) == 3
    assert cli.main(["transcribe", *args, "--force-resume"], spark) == 0
    assert cli.main(["validate", *args], spark) == 1
    assert cli.main(["status", "--config", str(tmp / "none"), "--input", str(path)], spark) == 2
    assert cli.main(["status", "--config", str(conf), "--input", str(tmp / "none")], spark) == 2


def test_config(tmp_path):
    cfg = config.load(None, {"batch": {"batch_size": None, "sort_buffer_size": "7"}, "checkpoint": {"enabled": "false"}, "device": {"prefer": ["cpu"]}})
    assert (cfg.batch.batch_size, cfg.batch.sort_buffer_size, cfg.checkpoint.enabled) == (16, 7, False)
    assert config.merged({"a": {"b": 1, "c": [1]}}, {"a": {"b": None, "c": [2]}}) == {"a": {"b": 1, "c": [2]}}
    assert len(cfg.fingerprint()) == 16 and cfg.fingerprint() == config.load(None, {"model": {"dtype": "float32"}}).fingerprint()
    assert config.parse_device(" CUDA:3 ") == ("cuda", 3)
    for bad in ("gpu", "cuda:x", "cpu:1", ""):
        with pytest.raises(config.DeviceConfigError):
            config.parse_device(bad)
    assert config.resolve_device(config.Device(["mps", "cpu"])) == "cpu"
    with pytest.raises(config.DeviceConfigError):
        config.resolve_device(config.Device(["mps"]), explicit=True)


def test_streaming_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table, kinds = str(tmp_path / "table"), {"first": (folder.first_of_each, "append"), "forget": (lambda p: folder.first_of_each(p, "1 day"), "append"), "last": (folder.last_of_each, "update")}
    for k, body in enumerate(["1-2-0\ta\nbad\n1-2-0\ta\n", "1-2-1\tb\n1-2-0\trepeat\n1-2-1\tb\n", "1-2-0\trepeat\n"]):
        (tmp_path / "in" / f"{k}.tsv").write_text(body)
        for name, (keep, mode) in kinds.items():
            parsed = keep(folder.read_stream(spark, str(tmp_path / "in"), "/r"))
            folder.start(parsed, str(tmp_path / f"ck-{name}"), folder.append_to(f"{table}-{name}"), mode=mode).awaitTermination()
    for name in ("first", "forget"):
        got = sorted((r["segment_id"], r["text"]) for r in folder.read_table(spark, f"{table}-{name}").collect())
        assert got == [("1-2-0", "a"), ("1-2-1", "b")]
    got = sorted((r["segment_id"], r["arrival"], r["text"]) for r in folder.read_table(spark, f"{table}-last").collect())
    assert got == [("1-2-0", 0, "a"), ("1-2-0", 1, "repeat"), ("1-2-1", 0, "b")]


def test_an_epoch_that_comes_again_changes_nothing(spark, tmp_path):
    process, rows = folder.append_to(str(tmp_path / "t")), spark.createDataFrame([("1-2-3", "x", None, None, 0)], folder.RECORD)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    for epoch in (0, 1, 1, 0):
        process(rows, epoch)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    process(rows, 0)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert folder.read_table(spark, str(tmp_path / "t")).count() == 3 and folder.read_table(spark, str(tmp_path / "none")).count() == 0


def test_session_log(tmp_path):
    import logging
    from datetime import datetime, timezone

    from quillspark.plans import logs

    assert logs.stamp_of(datetime(2024, 1, 1, 20, 0, 5, tzinfo=timezone.utc).timestamp()) == "20240102-030005"
    path = logs.begin_session(str(tmp_path / "l"))
    logging.getLogger("quillspark.x").info("hello")
    assert "INFO quillspark.x hello" in open(path).read()
