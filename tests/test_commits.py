"""The log of commits: chunks are there wholly, once, or not at all."""

import glob
import threading

import pytest
from conftest import IDS
from pyspark.sql import functions as F

from quillspark.operators import commits, resume
from quillspark.plans import runs
from quillspark.sources import files


def rows(spark, low, high, run="r"):
    own = F.concat((F.col("id") % 5).cast("string"), F.lit("-1-"), F.col("id").cast("string"))
    return spark.range(low, high).select(
        F.lit(run).alias("run_id"), F.col("id").alias("seq"), own.alias("segment_id"), F.lit("t").alias("pred_text"), F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit("/a").alias("audio_filepath"), F.lit(1.0).alias("duration"), F.current_timestamp().alias("attempt_ts"),
    )


@pytest.fixture
def made(spark, tmp_path):
    return resume.Ledger(spark, str(tmp_path / "ckpt"), "in.tsv")


def test_a_chunk_counts_once_and_only_when_entered(spark, made):
    assert made.read().count() == 0 and not made.started()
    left = made.stage(rows(spark, 0, 10), "dead writer's")
    assert made.read().count() == 0 and not made.started()
    assert made.commit(rows(spark, 0, 10), "a", 0, 1) and not made.commit(rows(spark, 0, 10), "a", 0, 1)
    assert made.commit(rows(spark, 10, 15), "b", 1, 2)
    assert made.read().count() == 15 and [(c.low, c.high) for c in made.live()] == [(0, 1), (1, 2)]
    assert made.log.vacuum(0) == 1 and not files.exists(spark, files.join(made.log.table, left.folder)) and made.read().count() == 15
    assert made.commit(rows(spark, 0, 3), "new run", replace=True) and made.read().count() == 3
    assert not made.commit(rows(spark, 0, 10), "a")


def test_entries_cut_off_or_repeated_count_for_nothing(spark, made):
    made.commit(rows(spark, 0, 10), "a")
    again = made.stage(rows(spark, 0, 10), "a")
    whole = commits.sealed(commits.asdict(again))
    for k, body in ((1, whole), (2, whole.replace('"a"', '"c"')), (3, whole[:-20]), (4, ""), (5, "{}\nx\n")):
        assert files.create_text(spark, files.join(made.log.folder, f"{k:012d}.json"), body)
    assert made.read().count() == 10 and made.log.state().version == 5
    assert made.commit(rows(spark, 10, 20), "b") and made.read().count() == 20 and made.log.state().version == 6
    assert not files.create_text(spark, files.join(made.log.folder, f"{6:012d}.json"), "other") and made.read().count() == 20


def test_writers_that_race_lose_nothing(spark, made):
    staged = [made.stage(rows(spark, 10 * k, 10 * k + 10), f"c{k % 4}") for k in range(8)]
    entered = []
    threads = [threading.Thread(target=lambda c=c: entered.append(made.log.add(c))) for c in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(entered) == 4 and made.read().count() == 40 and len(made.live()) == 4


def test_summaries_stand_for_the_entries_before(spark, made, monkeypatch):
    monkeypatch.setattr(commits, "SUMMARY_EVERY", 3)
    for k in range(7):
        made.commit(rows(spark, k, k + 1), f"c{k}")
    names = files.listed(spark, made.log.folder)
    assert sum(n.endswith(".summary") for n in names) == 2
    for n in names:
        if n.endswith(".json") and int(n.split(".")[0]) <= 5:
            files.delete(spark, files.join(made.log.folder, n))
    assert made.read().count() == 7 and not made.commit(rows(spark, 0, 1), "c0") and made.log.state().version == 6
    newest = max(n for n in names if n.endswith(".summary"))
    files.write_text(spark, files.join(made.log.folder, newest), "cut")
    assert made.log.state().told >= {"c0", "c1", "c2", "c6"}  # from the summary before it


def test_merged_chunks_are_joined_where_they_lie(spark, made):
    made.commit(rows(spark, 0, 100), "a")
    made.commit(rows(spark, 50, 120, "r2"), "b")
    assert made.compact() and not made.compact() and made.read().count() == 170
    assert made.latest().count() == 120 and made.latest().where("run_id = 'r2'").count() == 70
    made.commit(rows(spark, 120, 130), "c")
    assert len(made.live()) == 2 and made.log.vacuum(0) == 2
    left = made.pending(rows(spark, 0, 150).select("seq", "segment_id"))
    assert sorted(r["seq"] for r in left.collect()) == list(range(130, 150))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = made.pending(rows(spark, 0, 150).select("seq", "segment_id"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    scan = next(k for k, x in enumerate(lines) if "Bucketed: true" in x)
    depth, way = lines[scan].index("FileScan"), []
    for line in reversed(lines[:scan]):  # the nodes above the scan, from it upward
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            way.append(line)
    join = next(k for k, x in enumerate(way) if "Join" in x)
    assert not any("Exchange" in x for x in way[:join])
    late = made.compact(share=100.0)
    assert not late and made.compact(share=0.0)
    assert len(made.live()) == 1 and made.read().count() == 180


def test_manifest_is_there_old_or_new(spark, tmp_path):
    path = str(tmp_path / "m.json")
    files.write_text(spark, path, "old")
    files.write_text(spark, path, "new")
    assert files.read_text(spark, path) == "new" and not glob.glob(f"{path}.*new")
    assert not files.create_text(spark, path, "third") and files.read_text(spark, path) == "new"


def test_a_run_killed_before_the_log_leaves_nothing(spark, corpus, monkeypatch):
    path, cfg, _ = corpus
    cfg.batch.sort_buffer_size = 2

    class Killed(BaseException):
        pass

    honest, entered = commits.CommitLog.add, []

    def die(self, commit):
        if len(entered) == 1:
            raise Killed
        entered.append(commit)
        return honest(self, commit)

    monkeypatch.setattr(commits.CommitLog, "add", die)
    with pytest.raises(Killed):
        runs.run_inference(spark, str(path), cfg, chunk=1)
    ledger = runs.ledger_of(spark, cfg, str(path))
    assert ledger.read().count() == 2
    monkeypatch.setattr(commits.CommitLog, "add", honest)
    row = runs.run_inference(spark, str(path), cfg, chunk=1)
    assert (row["resumed"], row["ok"]) == (2, 3)
    assert sorted(r["segment_id"] for r in ledger.read().collect()) == sorted(IDS)
    assert not honest(ledger.log, entered[0]) and ledger.read().count() == 5


def test_without_resume_the_old_ledger_counts_until_the_new_run_commits(spark, corpus):
    path, cfg, _ = corpus
    assert runs.run_inference(spark, str(path), cfg)["ok"] == 5

    class Broken:
        def __init__(self, options):
            pass

        def transcribe_batch(self, paths):
            raise RuntimeError("device lost")

    with pytest.raises(Exception, match="device lost|in a row"):
        runs.run_inference(spark, str(path), cfg, Broken, use_resume=False)
    ledger = runs.ledger_of(spark, cfg, str(path))
    assert ledger.read().where("status = 'ok'").count() == 5
    assert runs.run_inference(spark, str(path), cfg, use_resume=False)["ok"] == 5 and ledger.read().count() == 5
