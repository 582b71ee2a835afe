"""Named queries over the test tables, with equivalent SQL for DuckDB."""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import ids, measures, text
from .operators import batching, combine, commits, inference, resume, status
from .plans import config
from .sources import datasource, files, ranges, sinks, transcripts
from .streaming import folder

ROOT = "/data/audio"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The derived relations, as common table expressions: utterances, predictions, finished ids.
UTT = "utt AS (SELECT doc_id AS seq, (doc_id % 7) || '-' || (doc_id % 50) || '-' || doc_id AS segment_id, text, CAST(n_chars AS DOUBLE) / 15 AS duration FROM documents)"
PRED = """pred AS (SELECT segment_id, lower(text) AS pred_text, seq, 1 AS attempt FROM utt WHERE seq % 10 <> 3
  UNION ALL SELECT segment_id, reverse(text), seq, 2 FROM utt WHERE seq % 10 = 1
  UNION ALL SELECT '999-999-' || seq, 'orphan', seq, 1 FROM utt WHERE seq % 50 = 0)"""
LAST = "latest AS (SELECT segment_id, arg_max(pred_text, attempt) AS pred_text FROM pred GROUP BY segment_id)"
DONE = "done AS (SELECT segment_id FROM utt WHERE seq % 4 = 0)"


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    own = F.concat_ws("-", F.col("doc_id") % 7, F.col("doc_id") % 50, F.col("doc_id"))
    return d.select(F.col("doc_id").alias("seq"), own.alias("segment_id"), "text", (F.col("n_chars").cast("double") / 15).alias("duration"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = utterances(spark, sf_dir)
    one = u.where("seq % 10 <> 3").select("segment_id", F.lower("text").alias("pred_text"), "seq", F.lit(1).alias("attempt"))
    two = u.where("seq % 10 = 1").select("segment_id", F.reverse("text").alias("pred_text"), "seq", F.lit(2).alias("attempt"))
    orphans = u.where("seq % 50 = 0").select(F.concat(F.lit("999-999-"), "seq").alias("segment_id"), F.lit("orphan").alias("pred_text"), "seq", F.lit(1).alias("attempt"))
    return one.unionByName(two).unionByName(orphans)


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = utterances(spark, sf_dir).where("seq % 4 = 0").select("segment_id")
    return own.withColumn("shard", ids.shard_of(F.col("segment_id")))


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = utterances(spark, sf_dir)
    body = F.translate("text", "\n", " ")
    value = (
        F.when(F.expr("seq % 13 = 0"), body).when(F.expr("seq % 17 = 0"), F.lit(" \t ")).when(F.expr("seq % 19 = 0"), F.concat(F.lit("  \t"), body))
        .when(F.expr("seq % 23 = 0"), F.concat(F.lit("12-34\t"), body)).when(F.expr("seq % 29 = 0"), F.concat(F.lit(" "), "segment_id", F.lit(" \ta\tb")))
        .otherwise(F.concat("segment_id", F.lit("\t"), body))
    )
    return u.select("seq", value.alias("value"))


LINES = f"""{UTT}, lines AS (SELECT seq, CASE WHEN seq % 13 = 0 THEN body WHEN seq % 17 = 0 THEN ' ' || chr(9) || ' ' WHEN seq % 19 = 0 THEN '  ' || chr(9) || body
  WHEN seq % 23 = 0 THEN '12-34' || chr(9) || body WHEN seq % 29 = 0 THEN ' ' || segment_id || ' ' || chr(9) || 'a' || chr(9) || 'b' ELSE segment_id || chr(9) || body END AS value
  FROM (SELECT *, replace(text, chr(10), ' ') AS body FROM utt)),
parts AS (SELECT seq, value, CASE WHEN instr(value, chr(9)) > 0 THEN trim(substr(value, 1, instr(value, chr(9)) - 1)) ELSE trim(value) END AS id, instr(value, chr(9)) AS tab FROM lines),
parsed AS (SELECT seq, id, value, tab, CASE WHEN trim(replace(value, chr(9), ' ')) = '' THEN 'blank' WHEN tab = 0 THEN 'no_tab' WHEN id = '' THEN 'empty_id'
  WHEN NOT regexp_matches(id, '^[^-]+-[^-]+-') THEN 'malformed_id' END AS reject_reason FROM parts)"""


@query(f"WITH {LINES} SELECT seq, id AS segment_id, substr(value, tab + 1) AS text, '{ROOT}/train/' || split_part(id, '-', 1) || '/' || split_part(id, '-', 2) || '/' || id || '.wav' AS audio_filepath FROM parsed WHERE reject_reason IS NULL")
def parse_tsv_lines(spark, sf_dir):
    return transcripts.parse_tsv(faulty_lines(spark, sf_dir), ROOT).where("reject_reason is null").select("seq", "segment_id", "text", "audio_filepath")


@query(f"WITH {LINES} SELECT coalesce(reject_reason, 'kept') AS reason, CAST(count(*) AS BIGINT) AS n FROM parsed GROUP BY 1")
def reject_reason_counts(spark, sf_dir):
    return transcripts.parse_tsv(faulty_lines(spark, sf_dir), ROOT).groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""SELECT doc_id AS seq, CASE WHEN doc_id % 9 = 4 THEN 'clip' || doc_id ELSE 'abs' || doc_id END AS segment_id,
  CASE WHEN doc_id % 6 = 0 THEN '' WHEN doc_id % 6 = 1 THEN '42' ELSE lang END AS text,
  CASE WHEN doc_id % 9 = 4 THEN '{ROOT}/sub/clip' || doc_id || '.wav' ELSE '/abs/abs' || doc_id || '.wav' END AS audio_filepath,
  CASE WHEN doc_id % 4 = 0 THEN CAST(n_chars AS DOUBLE) END AS duration, CASE WHEN doc_id % 11 = 5 THEN 'no_path' END AS reject_reason
FROM documents WHERE doc_id % 11 <> 5""")
def parse_jsonl_manifest(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    name = F.when(F.expr("doc_id % 9 = 4"), F.concat(F.lit('"sub/clip'), "doc_id", F.lit('.wav"'))).otherwise(F.concat(F.lit('"/abs/abs'), "doc_id", F.lit('.wav"')))
    body = F.when(F.expr("doc_id % 6 = 0"), F.lit("null")).when(F.expr("doc_id % 6 = 1"), F.lit("42")).otherwise(F.concat(F.lit('"'), "lang", F.lit('"')))
    length = F.when(F.expr("doc_id % 4 = 0"), F.col("n_chars").cast("string")).otherwise(F.lit('"long"'))
    value = F.when(F.expr("doc_id % 11 = 5"), F.lit('{"text": "x"}')).otherwise(F.concat(F.lit('{"audio_filepath": '), name, F.lit(', "text": '), body, F.lit(', "duration": '), length, F.lit("}")))
    lines = d.select(F.col("doc_id").alias("seq"), value.alias("value"))
    return transcripts.parse_jsonl(lines, ROOT).where("reject_reason is null").select("seq", "segment_id", "text", "audio_filepath", "duration", "reject_reason")


@query(f"WITH {UTT} SELECT segment_id, split_part(segment_id, '-', 1) AS shard, '{ROOT}/train/' || split_part(segment_id, '-', 1) || '/' || split_part(segment_id, '-', 2) || '/' || segment_id || '.wav' AS path, true AS valid FROM utt")
def audio_path_rule(spark, sf_dir):
    c = F.col("segment_id")
    return utterances(spark, sf_dir).select(c, ids.shard_of(c).alias("shard"), ids.audio_path(c, ROOT).alias("path"), ids.is_valid_id(c).alias("valid"))


@query(f"WITH {UTT} SELECT seq, segment_id || CASE WHEN seq % 3 = 0 THEN '.tar' ELSE '' END AS stem FROM utt")
def segment_id_from_path(spark, sf_dir):
    u = utterances(spark, sf_dir)
    path = F.concat(F.lit("/a.b/c/"), "segment_id", F.when(F.expr("seq % 3 = 0"), ".tar.gz").when(F.expr("seq % 3 = 1"), ".wav").otherwise(""))
    return u.select("seq", ids.stem(path).alias("stem"))


@query("SELECT doc_id, 'abcfi' || nfc_normalize(text) AS folded FROM documents")
def nfkc_fold_roundtrip(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.nfkc(F.concat(F.lit("ａｂｃﬁ"), "text")).alias("folded"))


@query("SELECT doc_id, chr(3588) || chr(3661) || chr(3634) || lang AS a, true AS same FROM documents")
def sara_am_equal(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    one, two = F.concat(F.lit("คำ"), "lang"), F.concat(F.lit("คํา"), "lang")
    return d.select("doc_id", text.nfkc(one).alias("a"), (text.nfkc(one) == text.nfkc(two)).alias("same"))


@query("SELECT doc_id, replace(replace(text || chr(9), chr(9), ' '), chr(10), ' ') AS line FROM documents")
def neutralize_tabs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.neutralize(F.concat("text", F.lit("\t"))).alias("line"))


COMBINE = f"WITH {UTT}, {PRED}, {LAST} SELECT u.seq, u.segment_id, u.text AS orig_text, coalesce(l.pred_text, '') AS pred_text FROM utt u LEFT JOIN latest l USING (segment_id)"


@query(COMBINE)
def combine_left_join(spark, sf_dir):
    return combine.combine(utterances(spark, sf_dir), attempts(spark, sf_dir), "attempt")


@query(COMBINE)
def combine_merge_join(spark, sf_dir):
    return combine.combine(utterances(spark, sf_dir), attempts(spark, sf_dir), "attempt", merge=True)


@query(f"WITH {UTT}, {PRED} SELECT DISTINCT segment_id FROM pred WHERE segment_id NOT IN (SELECT segment_id FROM utt)")
def combine_extra(spark, sf_dir):
    return combine.extra(utterances(spark, sf_dir), attempts(spark, sf_dir))


@query(f"WITH {UTT}, {PRED} SELECT segment_id, seq FROM utt WHERE segment_id NOT IN (SELECT segment_id FROM pred)")
def combine_missing(spark, sf_dir):
    return combine.missing(utterances(spark, sf_dir), attempts(spark, sf_dir))


@query(f"""WITH {UTT}, {PRED}, {LAST}, j AS (SELECT l.segment_id AS hit FROM utt u LEFT JOIN latest l USING (segment_id))
SELECT CAST(count(*) AS BIGINT) AS total_input, CAST(count(hit) AS BIGINT) AS matched, CAST(count(*) - count(hit) AS BIGINT) AS missing_prediction,
  (SELECT CAST(count(*) AS BIGINT) FROM latest WHERE segment_id NOT IN (SELECT segment_id FROM utt)) AS extra_prediction FROM j""")
def combine_stats(spark, sf_dir):
    return combine.stats_frame(utterances(spark, sf_dir), attempts(spark, sf_dir))


@query(f"WITH {UTT}, {PRED}, {LAST} SELECT segment_id, pred_text FROM latest")
def dedupe_last_wins(spark, sf_dir):
    return combine.last_wins(attempts(spark, sf_dir), "attempt")


@query(f"WITH {UTT}, {DONE} SELECT seq, segment_id, text, duration FROM utt WHERE segment_id NOT IN (SELECT segment_id FROM done)")
def resume_left_anti(spark, sf_dir):
    return resume.pending(utterances(spark, sf_dir), finished(spark, sf_dir)).select("seq", "segment_id", "text", "duration")


@query(f"WITH {UTT}, {DONE} SELECT seq, segment_id FROM utt WHERE segment_id NOT IN (SELECT segment_id FROM done) ORDER BY seq LIMIT 25")
def resume_limit(spark, sf_dir):
    """The limit of a run: the first rows still to do."""
    return resume.take_first(resume.pending(utterances(spark, sf_dir), finished(spark, sf_dir)), 25).select("seq", "segment_id")


@query(f"WITH {UTT} SELECT split_part(segment_id, '-', 1) AS shard, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT segment_id) AS BIGINT) AS n_ids FROM utt GROUP BY 1")
def shard_counts(spark, sf_dir):
    return utterances(spark, sf_dir).groupBy(ids.shard_of(F.col("segment_id")).alias("shard")).agg(F.count("*").alias("n"), F.countDistinct("segment_id").alias("n_ids"))


@query(f"WITH {UTT} SELECT segment_id, duration > 30 AS over FROM utt")
def exceeds_window_flag(spark, sf_dir):
    return utterances(spark, sf_dir).select("segment_id", measures.exceeds_window(F.col("duration")).alias("over"))


@query(f"""WITH {UTT}, p AS (SELECT u.*, coalesce(l.quality, 0) = 1 AS readable, coalesce(l.toxic, 0) AS toxic FROM utt u LEFT JOIN labels l ON l.doc_id = u.seq)
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (readable) AS BIGINT) AS readable, CAST(count(*) FILTER (NOT readable) AS BIGINT) AS missing,
  CAST(count(*) FILTER (readable AND toxic = 1) AS BIGINT) AS non_conforming, CAST(count(*) FILTER (readable AND duration > 30) AS BIGINT) AS over_window,
  round(coalesce(sum(duration) FILTER (readable), 0), 3) AS seconds FROM p""")
def dry_run_stats(spark, sf_dir):
    from .sources import audio

    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"), "quality", "toxic")
    rows = utterances(spark, sf_dir).join(labels, "seq", "left").select(
        (F.coalesce("quality", F.lit(0)) == 1).alias("is_readable"),
        F.struct(F.when(F.col("toxic") == 1, 8000).otherwise(16000).alias("sample_rate"), F.lit(1).alias("channels"), F.col("duration").alias("duration_seconds")).alias("probe"),
    )
    return audio.summarize(rows).withColumn("seconds", F.round("seconds", 3))


@query("SELECT doc_id, CAST(greatest(n_chars - 44, 0) AS DOUBLE) / 32000 AS estimate, CAST(n_chars AS DOUBLE) / 16000 AS seconds FROM documents")
def estimate_duration(spark, sf_dir):
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", measures.estimate_duration(n).alias("estimate"), measures.duration_seconds(n, F.lit(16000)).alias("seconds"))


PACK = """WITH RECURSIVE o AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS p FROM events),
s AS (SELECT event_id, value, p // 256 AS win, row_number() OVER (PARTITION BY p // 256 ORDER BY value, p) AS k FROM o),
f AS (SELECT event_id, value, win, k, CAST(0 AS BIGINT) AS batch_no, CAST(0 AS BIGINT) AS slot FROM s WHERE k = 1
  UNION ALL SELECT s.event_id, s.value, s.win, s.k,
    CASE WHEN f.slot + 1 >= 16 OR greatest(f.value, s.value) * (f.slot + 2) > 480 THEN f.batch_no + 1 ELSE f.batch_no END,
    CASE WHEN f.slot + 1 >= 16 OR greatest(f.value, s.value) * (f.slot + 2) > 480 THEN 0 ELSE f.slot + 1 END
  FROM f JOIN s ON s.win = f.win AND s.k = f.k + 1)"""


def packed_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("value").alias("duration"))
    return batching.assign_batches(e, 16, 256, 480.0)


@query(f"{PACK} SELECT event_id, win, batch_no, slot FROM f")
def batch_greedy_pack(spark, sf_dir):
    return packed_events(spark, sf_dir).select(F.col("seq").alias("event_id"), "win", "batch_no", "slot")


@query(f"{PACK} SELECT win, batch_no, CAST(count(*) AS BIGINT) AS n, max(value) AS longest, round(max(value) * count(*), 6) AS padded_cost FROM f GROUP BY win, batch_no")
def batch_stats(spark, sf_dir):
    return batching.batch_stats(packed_events(spark, sf_dir)).withColumn("padded_cost", F.round("padded_cost", 6))


@query("""WITH g AS (SELECT event_id, user_id, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
SELECT event_id, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM g""")
def failure_streaks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("event_type") == "error").alias("bad"))
    return inference.failure_streaks(e, ["event_id"], "bad", ["user_id"]).select("event_id", F.col("streak").cast("long").alias("streak"))


@query("""SELECT event_id, sig, coalesce(sig = lag(sig) OVER (PARTITION BY user_id ORDER BY event_id), false) AS repeated
FROM (SELECT event_id, user_id, CASE WHEN event_type IN ('error', 'click') THEN event_type || ' failed' END AS sig FROM events)""")
def systematic_streaks(spark, sf_dir):
    sig = F.when(F.col("event_type").isin("error", "click"), text.error_signature(F.concat(F.lit(" "), "event_type", F.lit("\n  failed "))))
    e = table(spark, sf_dir, "events").select("event_id", "user_id", sig.alias("sig"))
    return inference.systematic_streaks(e, ["event_id"], "sig", ["user_id"]).select("event_id", "sig", "repeated")


@query("""SELECT doc_id AS seq, CASE WHEN doc_id % 37 = 5 THEN '' ELSE 'pred:' || name END AS pred_text, CASE WHEN doc_id % 37 = 5 THEN 'failed' ELSE 'ok' END AS status
FROM (SELECT doc_id, CASE WHEN doc_id % 37 = 5 THEN 'boom' ELSE 'clip' END || doc_id AS name FROM documents)""")
def isolation_outcomes(spark, sf_dir):
    path = F.concat(F.lit("/a/"), F.when(F.expr("seq % 37 = 5"), "boom").otherwise("clip"), "seq", F.lit(".wav"))
    u = utterances(spark, sf_dir).select("seq", "segment_id", "duration", path.alias("audio_filepath"))
    return inference.transcribe(batching.assign_batches(u, 8, 512)).select("seq", "pred_text", "status")


@query("""SELECT CAST(count(*) AS BIGINT) AS completed, CAST(count(DISTINCT doc_id % 400) AS BIGINT) AS distinct_ids, CAST(count(*) FILTER (doc_id % 37 = 5) AS BIGINT) AS failed,
  CAST(count(*) FILTER (doc_id % 3 = 0) AS BIGINT) AS empty, round(count(*) FILTER (doc_id % 3 = 0) / CAST(count(*) AS DOUBLE), 6) AS empty_ratio, count(*) FILTER (doc_id % 3 = 0) / CAST(count(*) AS DOUBLE) > 0.5 AS alarm FROM documents""")
def empty_prediction_rate(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        F.expr("doc_id % 400").cast("string").alias("segment_id"), F.when(F.expr("doc_id % 3 = 0"), F.lit("  \x1c")).otherwise(F.lit("x")).alias("pred_text"),
        F.when(F.expr("doc_id % 37 = 5"), "failed").otherwise("ok").alias("status"),
    )
    return status.progress(d).withColumn("empty_ratio", F.round("empty_ratio", 6))


@query("SELECT event_type, round(CASE WHEN sum(value) - 100 > 0 THEN sum(value) * 3 / (sum(value) - 100) ELSE 0 END, 6) AS factor FROM events GROUP BY event_type")
def realtime_factor(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum("value").alias("s"))
    return e.select("event_type", F.round(measures.realtime_factor(F.col("s") * 3, F.col("s") - 100), 6).alias("factor"))


@query("SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time, strftime(ts + INTERVAL 7 HOUR, '%Y%m%d-%H%M%S') AS stamp FROM events")
def bangkok_timestamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.bangkok(F.col("ts")).alias("local_time"), text.bangkok(F.col("ts"), "yyyyMMdd-HHmmss").alias("stamp"))


@query("""SELECT DISTINCT lang, source, left(sha256('{"audio_root": "/data/' || source || '", "hf_repo_id": "m", "target_lang": "' || lang || '", "task": "transcribe"}'), 16) AS fingerprint
FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL""")
def config_fingerprint(spark, sf_dir):
    """Fingerprints of the settings of runs, one for each language and source of the documents."""
    d = table(spark, sf_dir, "documents").where("lang is not null and source is not null").select("lang", "source").distinct()
    return d.select("lang", "source", resume.fingerprints(F.concat(F.lit("/data/"), "source"), F.col("lang"), F.lit("transcribe"), F.lit("m")).alias("fingerprint"))


@query("""SELECT doc_id, k, before, after FROM (SELECT doc_id, 'input_path' AS k, source AS before, CASE WHEN doc_id % 3 = 0 THEN source ELSE source || '/new' END AS after FROM documents
UNION ALL SELECT doc_id, 'input_size', CAST(n_chars AS VARCHAR), CASE WHEN doc_id % 4 = 0 THEN CAST(n_chars + 1 AS VARCHAR) ELSE CAST(n_chars AS VARCHAR) END FROM documents
UNION ALL SELECT doc_id, 'input_format', CASE WHEN doc_id % 5 <> 0 THEN 'tsv' END, 'tsv' FROM documents) WHERE before IS DISTINCT FROM after""")
def manifest_diff(spark, sf_dir):
    """What changed between two manifests of each document; a key that was not there before has changed, one that is there no more has not."""
    d = table(spark, sf_dir, "documents")
    size = F.col("n_chars").cast("string")
    both = F.create_map(F.lit("input_path"), "source", F.lit("input_size"), size, F.lit("gone"), F.lit("x"))
    old = F.when(F.expr("doc_id % 5 <> 0"), F.map_concat(both, F.create_map(F.lit("input_format"), F.lit("tsv")))).otherwise(both)
    new = F.create_map(
        F.lit("input_path"), F.when(F.expr("doc_id % 3 = 0"), F.col("source")).otherwise(F.concat("source", F.lit("/new"))),
        F.lit("input_size"), F.when(F.expr("doc_id % 4 = 0"), (F.col("n_chars") + 1).cast("string")).otherwise(size), F.lit("input_format"), F.lit("tsv"),
    )
    return d.select("doc_id", F.explode(resume.manifest_diffs(old, new)).alias("k", "v")).select("doc_id", "k", "v.before", "v.after")


@query("""SELECT doc_id, lang AS target_lang, CASE WHEN doc_id % 2 = 0 THEN 'translate' ELSE 'transcribe' END AS task, CASE WHEN doc_id % 3 = 0 THEN '8' ELSE '16' END AS batch_size, source AS extra FROM documents""")
def merged_settings(spark, sf_dir):
    """Settings over defaults, document by document: nulls are passed over, new keys come in."""
    one, two = F.expr("doc_id % 2 = 0"), F.expr("doc_id % 3 = 0")
    base = F.create_map(F.lit("task"), F.lit("transcribe"), F.lit("batch_size"), F.lit("16"), F.lit("target_lang"), F.col("lang"))
    over = F.create_map(F.lit("task"), F.when(one, "translate"), F.lit("batch_size"), F.when(two, "8"), F.lit("extra"), F.col("source"))
    got = config.merged_maps(base, over)
    return table(spark, sf_dir, "documents").select("doc_id", *[F.try_element_at(got, F.lit(k)).alias(k) for k in ("target_lang", "task", "batch_size", "extra")])


@query("SELECT conv_id || '-' || role || '-' || turn AS segment_id, CAST(conv_id AS VARCHAR) AS shard FROM conversations")
def conversation_segments(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("segment_id", F.concat_ws("-", "conv_id", "role", "turn"))
    return c.select("segment_id", ids.shard_of(F.col("segment_id")).alias("shard"))


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS position FROM events")
def dense_positions(spark, sf_dir):
    return batching.dense_position(table(spark, sf_dir, "events").select("event_id"), "event_id")


def ledger_rows(spark, sf_dir) -> DataFrame:
    """All attempts as rows of a ledger; run1 and run2 are their runs."""
    return attempts(spark, sf_dir).select(
        F.concat(F.lit("run"), "attempt").alias("run_id"), "seq", "segment_id", "pred_text", F.when(F.expr("seq % 11 = 2"), "failed").otherwise("ok").alias("status"), F.lit(None).cast("string").alias("error"),
        F.concat(F.lit("/a/"), "segment_id").alias("audio_filepath"), F.lit(1.0).alias("duration"), F.timestamp_seconds(F.lit(1700000000) + F.col("attempt")).alias("attempt_ts"),
    )


def two_runs(spark, sf_dir) -> resume.Ledger:
    """A ledger in the shared folder that two runs have appended to."""
    made = resume.Ledger(spark, files.shared_folder(spark), "in.tsv")
    for run in ("run1", "run2"):
        made.commit(ledger_rows(spark, sf_dir).where(F.col("run_id") == run), run)
    return made


@query(f"WITH {UTT}, {PRED} SELECT segment_id, split_part(segment_id, '-', 1) AS shard, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY segment_id")
def append_runs_union(spark, sf_dir):
    """All attempts of two runs, as the ledger keeps them."""
    return two_runs(spark, sf_dir).read().groupBy("segment_id", "shard").agg(F.count("*").alias("n"))


@query(f"WITH {UTT}, {PRED} SELECT segment_id, arg_max(pred_text, attempt) AS pred_text, 'run' || max(attempt) AS run_id FROM pred GROUP BY segment_id")
def ledger_latest(spark, sf_dir):
    return two_runs(spark, sf_dir).latest().select("segment_id", "pred_text", "run_id")


@query(f"""WITH {UTT}, {PRED}, latest AS (SELECT segment_id, arg_max(seq % 11 = 2, attempt) AS bad FROM pred GROUP BY segment_id)
SELECT seq, segment_id FROM utt WHERE segment_id NOT IN (SELECT segment_id FROM latest WHERE NOT bad)""")
def resume_retry_failed(spark, sf_dir):
    return resume.pending(utterances(spark, sf_dir), two_runs(spark, sf_dir).read(), retry_failed=True).select("seq", "segment_id")


@query(f"WITH {UTT}, {PRED} SELECT segment_id FROM utt EXCEPT SELECT segment_id FROM pred")
def except_ids(spark, sf_dir):
    return combine.extra(attempts(spark, sf_dir).select("segment_id"), utterances(spark, sf_dir).select("segment_id"))


@query(f"""WITH {UTT}, {PRED}, {LAST} SELECT seq, segment_id || chr(9) || replace(replace(text, chr(9), ' '), chr(10), ' ') || chr(9) || replace(replace(coalesce(pred_text, ''), chr(9), ' '), chr(10), ' ') AS value
FROM utt LEFT JOIN latest USING (segment_id) UNION ALL SELECT -1, 'segment_id' || chr(9) || 'orig_text' || chr(9) || 'pred_text'""")
def combined_tsv_lines(spark, sf_dir):
    return sinks.combined_lines(combine.combine(utterances(spark, sf_dir), attempts(spark, sf_dir), "attempt"), "tsv")


@query(f"WITH {UTT} SELECT seq, segment_id || chr(9) || replace(replace(text, chr(9), ' '), chr(10), ' ') AS value FROM utt")
def prediction_tsv_lines(spark, sf_dir):
    return sinks.prediction_lines(utterances(spark, sf_dir).withColumnRenamed("text", "pred_text"), "tsv")


@query("SELECT doc_id, n_chars % 2 = 0 AND lang <> 'de' AS conforms FROM documents")
def audio_conforms(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", measures.conforms(F.expr("n_chars % 2 = 0"), F.lit(16000), F.when(F.col("lang") == "de", 2).otherwise(1)).alias("conforms"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS segment_id, arg_max(l_returnflag, l_linenumber || l_returnflag) AS pred_text FROM lineitem GROUP BY 1")
def last_wins_volume(spark, sf_dir):
    """The last-wins aggregate at volume: line items as attempts of their orders."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("segment_id"), F.col("l_returnflag").alias("pred_text"), "l_linenumber")
    return combine.last_wins(x, ["l_linenumber", "pred_text"])


# files: written to the shared folder and read again


def plain_lines(spark, sf_dir) -> DataFrame:
    return faulty_lines(spark, sf_dir).withColumn("value", F.translate("value", "\r\n", "  "))


NUMBERED = """numbered AS (SELECT p.*, CAST(row_number() OVER (ORDER BY p.seq) - 1 AS BIGINT) AS nth FROM (SELECT seq, id, tab, replace(value, chr(13), ' ') AS value, reject_reason FROM parsed) p)"""


@query(f"WITH {LINES}, {NUMBERED} SELECT nth AS seq, id AS segment_id, substr(value, tab + 1) AS text FROM numbered WHERE reject_reason IS NULL")
def read_tsv_file(spark, sf_dir):
    """Lines in a file's order, numbered without gaps; the format is found out."""
    path = files.join(files.shared_folder(spark), "in.tsv")
    sinks.write_lines(plain_lines(spark, sf_dir), path)
    kept, _ = transcripts.read_transcripts(spark, path, ROOT)
    return kept.select("seq", "segment_id", "text")


@query(f"WITH {LINES}, {NUMBERED} SELECT nth AS seq, reject_reason FROM numbered WHERE reject_reason IS NOT NULL")
def read_tsv_rejects(spark, sf_dir):
    path = files.join(files.shared_folder(spark), "in.tsv")
    sinks.write_lines(plain_lines(spark, sf_dir), path)
    return transcripts.read_transcripts(spark, path, ROOT)[1].select("seq", "reject_reason")


@query("""SELECT CASE WHEN doc_id % 12 = 7 THEN 'invalid_json' WHEN doc_id % 12 = 3 THEN 'no_path' WHEN doc_id % 12 = 5 THEN 'blank' WHEN doc_id % 12 = 9 THEN 'no_shard' ELSE 'kept' END AS reason, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1""")
def read_jsonl_file(spark, sf_dir):
    kind = F.expr("doc_id % 12")
    line = (
        F.when(kind == 7, F.lit("not json")).when(kind == 3, F.lit('{"text": "x", "duration": 1}')).when(kind == 5, F.lit("  ")).when(kind == 9, F.lit('{"audio_filepath": "/a/-b.wav"}'))
        .otherwise(F.concat(F.lit('{"audio_filepath": "/a/'), "doc_id", F.lit('.wav", "text": "t"}')))
    )
    path = files.join(files.shared_folder(spark), "in.txt")
    sinks.write_lines(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), line.alias("value")), path)
    kept, bad = transcripts.read_transcripts(spark, path, ROOT)
    return kept.select(F.lit("kept").alias("reason")).unionByName(bad.select(F.col("reject_reason").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT kind || '-' || part || suffix AS name, CASE suffix WHEN '.tsv' THEN 'tsv' ELSE 'jsonl' END AS by_suffix, CASE kind WHEN 'json' THEN 'jsonl' WHEN 'text' THEN 'tsv' WHEN 'none' THEN CASE suffix WHEN '.tsv' THEN 'tsv' ELSE 'jsonl' END END AS found
FROM (SELECT DISTINCT CASE doc_id % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'text' ELSE 'none' END AS kind, doc_id % 12 AS part, CASE WHEN doc_id % 2 = 0 THEN '.tsv' ELSE '.JSONL' END AS suffix FROM documents)""")
def detected_formats(spark, sf_dir):
    """By suffix, and by the first line that is not blank, of files that hold all documents."""
    base = files.join(files.shared_folder(spark), "in")
    d = table(spark, sf_dir, "documents")
    kind = F.expr("case doc_id % 3 when 0 then 'json' when 1 then 'text' else 'none' end")
    line = F.when(kind == "json", F.to_json(F.struct("doc_id", "text"))).when(kind == "text", F.concat(F.lit("1-2-"), "doc_id", F.lit("\t"), F.translate("text", "\r\n", "  "))).otherwise("  ")
    name = F.concat_ws("-", kind, F.expr("doc_id % 12"), F.expr("case when doc_id % 2 = 0 then '.tsv' else '.JSONL' end"))
    rows = d.select(F.regexp_replace(name, "-[.]", ".").alias("name"), F.explode(F.array(F.lit(" "), line)).alias("value"), "doc_id", F.when(line == F.col("value"), 1).otherwise(0).alias("late"))
    rows.repartition("name").sortWithinPartitions("name", "late", "doc_id").select("name", "value").write.partitionBy("name").text(base)
    # Spark names folders, a file of one has the suffix of its own: the folder's name stands for the file's
    found = transcripts.detect_formats(spark, base, F.regexp_extract(F.col("_metadata.file_path"), "name=([^/]+)/", 1))
    return found.select(F.col("file").alias("name"), "by_suffix", "found")


@query(f"WITH {UTT} SELECT segment_id, 'predicted-' || segment_id || '.tsv' AS predicted, 'combined-' || segment_id || '.tsv' AS combined FROM utt")
def output_names(spark, sf_dir):
    """Names of the outputs of one input a document."""
    path = F.concat(F.lit("/in/put/"), "segment_id", F.lit(".tsv"))
    return utterances(spark, sf_dir).select("segment_id", sinks.named_after(path, "predicted").alias("predicted"), sinks.named_after(path, "combined").alias("combined"))


@query(f"WITH {UTT} SELECT seq, '/a/' || segment_id AS audio_filepath, text, round(duration, 6) AS duration FROM utt")
def prediction_jsonl_lines(spark, sf_dir):
    """JSON lines, read again."""
    u = utterances(spark, sf_dir).select("seq", "segment_id", F.col("text").alias("pred_text"), F.concat(F.lit("/a/"), "segment_id").alias("audio_filepath"), "duration")
    back = sinks.prediction_lines(u, "jsonl").select("seq", F.from_json("value", "audio_filepath string, text string, duration double").alias("d"))
    return back.select("seq", "d.audio_filepath", "d.text", F.round("d.duration", 6).alias("duration"))


@query(COMBINE)
def combined_jsonl_lines(spark, sf_dir):
    lines = sinks.combined_lines(combine.combine(utterances(spark, sf_dir), attempts(spark, sf_dir), "attempt"), "jsonl")
    return lines.select("seq", F.from_json("value", "segment_id string, orig_text string, pred_text string").alias("d")).select("seq", "d.*")


@query(f"WITH {UTT}, {PRED} SELECT CAST(row_number() OVER (ORDER BY seq) - 1 AS BIGINT) AS line, segment_id FROM utt WHERE segment_id NOT IN (SELECT segment_id FROM pred)")
def missing_report(spark, sf_dir):
    """The report of missing ids, as lines in input order."""
    path = files.join(files.shared_folder(spark), "lines")
    sinks.write_missing(combine.missing(utterances(spark, sf_dir), attempts(spark, sf_dir)), path)
    return transcripts.read_lines(spark, path).select(F.col("seq").alias("line"), F.col("value").alias("segment_id"))


@query(f"WITH {UTT} SELECT segment_id, '/a/' || segment_id AS audio_path, 'no. ' || seq AS reason FROM utt WHERE seq % 5 < 2")
def error_journal(spark, sf_dir):
    """Two appended batches of failures."""
    path = files.join(files.shared_folder(spark), "lines")
    u = utterances(spark, sf_dir).select("seq", "segment_id", F.concat(F.lit("/a/"), "segment_id").alias("audio_filepath"), F.concat(F.lit("no. "), "seq").alias("error"))
    for k in (0, 1):
        sinks.write_journal(u.where(F.col("seq") % 5 == k), path)
    return spark.read.schema("ts string, segment_id string, audio_path string, reason string").json(path).select("segment_id", "audio_path", "reason")


@query(f"""WITH {UTT} SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN seq % 9 = 4 THEN 'malformed' WHEN seq % 9 = 5 THEN 'blank' ELSE 'done' END AS reason FROM utt
UNION ALL SELECT 'cut' FROM (SELECT DISTINCT split_part(segment_id, '-', 1), seq // 500 FROM utt)) GROUP BY reason""")
def text_ledger(spark, sf_dir):
    """Files of ids as text, of 500 lines at most, with lines that are blank or malformed and a last line without its end."""
    u = utterances(spark, sf_dir)
    line = F.when(F.expr("seq % 9 = 4"), "garbage").when(F.expr("seq % 9 = 5"), " ").otherwise(F.col("segment_id"))
    pieces = u.select(ids.shard_of(F.col("segment_id")).alias("shard"), F.expr("seq div 500").alias("piece"), line.alias("line"))
    shards = pieces.groupBy("shard", "piece").agg(F.concat(F.array_join(F.collect_list("line"), "\n"), F.lit("\n1-1-")).alias("value"))
    path = files.join(files.shared_folder(spark), "done")
    shards.write.option("lineSep", "0").partitionBy("shard", "piece").text(path)
    return resume.read_text_ledger(spark, path, "*.txt").groupBy(F.coalesce("reason", F.lit("done")).alias("reason")).agg(F.count("*").alias("n"))


def arrivals(spark, sf_dir, base: str, parts: list[DataFrame], keep, mode: str = "append") -> DataFrame:
    """The table that a folder's files have been appended to, files arriving part by part."""
    for part in parts:
        part.select("value").write.mode("append").text(f"{base}/in")
        folder.start(keep(folder.read_stream(spark, f"{base}/in", ROOT)), f"{base}/state", folder.append_to(f"{base}/out"), mode=mode).awaitTermination()
    return folder.read_table(spark, f"{base}/out")


@query(f"WITH {UTT} SELECT segment_id, translate(text, chr(13) || chr(10) || chr(9), '   ') AS text FROM utt WHERE seq % 2 = 0")
def streamed_folder(spark, sf_dir):
    """Two arrivals in a folder, the second with all ids of the first again and all its own twice: each id is appended once."""
    u = utterances(spark, sf_dir).withColumn("text", F.translate("text", "\r\n\t", "   "))
    lines = u.where("seq % 2 = 0").select("seq", F.concat("segment_id", F.lit("\t"), "text").alias("value"))
    parts = [lines.where("seq % 4 = 0"), lines.unionByName(lines)]
    return arrivals(spark, sf_dir, files.shared_folder(spark), parts, folder.first_of_each).select("segment_id", "text")


@query(f"""WITH {UTT} SELECT segment_id, CASE WHEN seq % 4 = 0 THEN 'v2' ELSE 'v1' END AS text, CAST(CASE WHEN seq % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS told FROM utt WHERE seq % 2 = 0""")
def streamed_last_texts(spark, sf_dir):
    """Arrivals in which texts change: the last text of each id, and how often it was told; what comes again unchanged is not."""
    lines = utterances(spark, sf_dir).where("seq % 2 = 0").select("seq", F.concat("segment_id", F.lit("\tv1")).alias("value"))
    again = utterances(spark, sf_dir).where("seq % 2 = 0").select(F.concat("segment_id", F.when(F.expr("seq % 4 = 0"), F.lit("\tv2")).otherwise("\tv1")).alias("value"))
    out = arrivals(spark, sf_dir, files.shared_folder(spark), [lines, again], folder.last_of_each, "update")
    return out.groupBy("segment_id").agg(F.max_by("text", "arrival").alias("text"), F.count("*").alias("told"))


@query(f"""WITH {UTT}, {PRED} SELECT segment_id, CAST(count(*) AS BIGINT) AS n, min(attempt) AS first_attempt FROM pred GROUP BY segment_id""")
def committed_chunks(spark, sf_dir):
    """A ledger of two chunks, which its log also tells of: a chunk entered twice, one cut off in the log, and one whose writer died before the log."""
    made = resume.Ledger(spark, files.shared_folder(spark), "in.tsv")
    tries = ledger_rows(spark, sf_dir)
    made.commit(tries.where("seq % 2 = 0"), "even", 0, 1)
    made.commit(tries.where("seq % 2 = 0"), "even", 0, 1)
    twice = made.stage(tries.where("seq % 2 = 0"), "even", 0, 1)
    made.stage(tries, "never entered")
    made.commit(tries.where("seq % 2 = 1"), "odd", 1, 2)
    version = made.log.state().version
    files.create_text(spark, files.join(made.log.folder, f"{version + 1:012d}.json"), commits.sealed(asdict(twice)))
    files.create_text(spark, files.join(made.log.folder, f"{version + 2:012d}.json"), commits.sealed(asdict(replace(twice, chunk="cut")))[:-9])
    made.compact()
    return made.read().groupBy("segment_id").agg(F.count("*").alias("n"), F.min(F.substring("run_id", 4, 9).cast("int")).alias("first_attempt"))


@query(f"WITH {UTT}, {PRED} SELECT seq, segment_id FROM utt WHERE segment_id NOT IN (SELECT segment_id FROM pred)")
def resume_from_ledger(spark, sf_dir):
    """What a ledger of a merged chunk and a later one leaves to do: the merged one is joined where it lies."""
    made = resume.Ledger(spark, files.shared_folder(spark), "in.tsv")
    tries = ledger_rows(spark, sf_dir)
    made.commit(tries.where("attempt_ts <= timestamp_seconds(1700000001)"), "one")
    made.compact()
    made.commit(tries.where("attempt_ts > timestamp_seconds(1700000001)"), "two")
    return made.pending(utterances(spark, sf_dir).select("seq", "segment_id")).select("seq", "segment_id")


# the named formats


@query(f"WITH {LINES}, {NUMBERED} SELECT nth AS seq, id AS segment_id, substr(value, tab + 1) AS text FROM numbered WHERE reject_reason IS NULL")
def read_format_transcripts(spark, sf_dir):
    """The rows of read_tsv_file by the named format, files read in ranges of 64 KiB."""
    datasource.register(spark)
    path = files.join(files.shared_folder(spark), "in.tsv")
    sinks.write_lines(plain_lines(spark, sf_dir), path)
    rows = spark.read.format("transcripts").option("audio_root", ROOT).option("range_bytes", 1 << 16).load(path)
    return datasource.numbered(rows).where("reject_reason is null").select("seq", "segment_id", "text")


@query(f"WITH {UTT} SELECT segment_id, translate(text, chr(9) || chr(10), '  ') AS text FROM utt WHERE NOT contains(text, chr(13))")
def write_format_predictions(spark, sf_dir):
    """Predictions written by the named format and read again."""
    datasource.register(spark)
    path = files.join(files.shared_folder(spark), "out")
    u = utterances(spark, sf_dir).where(~F.contains("text", F.lit("\r"))).select("segment_id", F.col("text").alias("pred_text"))
    u.write.format("predictions").mode("append").save(path)
    return transcripts.read_transcripts(spark, path, ROOT)[0].select("segment_id", "text")


@query("""SELECT s_suppkey || '.wav' AS name, 8000 * (1 + s_suppkey % 3) AS sample_rate, 1 + s_suppkey % 2 AS channels, round((s_suppkey % 50) / CAST(8000 * (1 + s_suppkey % 3) AS DOUBLE), 9) AS seconds FROM supplier""")
def clip_headers(spark, sf_dir):
    """Headers of clips, one for each supplier, by the named format."""
    datasource.register(spark)
    base = files.join(files.shared_folder(spark), "clips")
    table(spark, sf_dir, "supplier").select("s_suppkey").foreachPartition(lambda rows: [write_clip(f"{base}/{r[0]}.wav", 8000 * (1 + r[0] % 3), 1 + r[0] % 2, r[0] % 50) for r in rows] and None)
    out = spark.read.format("wav_headers").option("clips_per_task", 50).load(base)
    return out.select(F.substring_index("path", "/", -1).alias("name"), "sample_rate", "channels", F.round("duration_seconds", 9).alias("seconds"))


def write_clip(path: str, rate: int, channels: int, frames: int) -> None:
    """A silent clip."""
    system, where = ranges.located(path)
    system.create_dir(where.rpartition("/")[0], recursive=True)
    size = 2 * channels * frames
    with system.open_output_stream(where) as out:
        out.write(b"RIFF" + struct.pack("<I4s4sIHHIIHH4sI", 36 + size, b"WAVE", b"fmt ", 16, 1, channels, rate, 2 * channels * rate, 2 * channels, 16, b"data", size) + bytes(size))


# gates


def event_outcomes(spark, sf_dir) -> DataFrame:
    """Events as clips: batches of 2 in windows of 32; errors and clicks fail, clicks with one message."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    error = F.when(kind == "click", F.lit("lost  device")).when(kind == "error", F.concat(F.lit("bad "), "event_id"))
    return e.select(
        F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("segment_id"), F.expr("event_id div 32").alias("win"), F.expr("event_id % 32 div 2").alias("batch_no"),
        F.lit("").alias("pred_text"), F.when(error.isNull(), "ok").otherwise("failed").alias("status"), error.alias("error"),
    )


BATCHES = """c AS (SELECT event_id // 32 AS win, event_id % 32 // 2 AS batch_no, CASE event_type WHEN 'click' THEN 'lost device' WHEN 'error' THEN 'bad ' || event_id END AS sig FROM events),
b AS (SELECT win, batch_no, count(*) AS n, count(sig) AS failed, CASE WHEN count(*) > 1 AND count(sig) = count(*) AND min(sig) = max(sig) THEN min(sig) END AS systematic_error FROM c GROUP BY win, batch_no)"""


@query(f"WITH {BATCHES} SELECT win, batch_no, CAST(n AS BIGINT) AS n, CAST(failed AS BIGINT) AS failed, n = failed AS whole_failed, systematic_error FROM b")
def batch_outcome_rows(spark, sf_dir):
    return inference.batch_outcomes(event_outcomes(spark, sf_dir))


@query(f"""WITH {BATCHES}, g AS (SELECT *, sum(CASE WHEN n = failed THEN 0 ELSE 1 END) OVER (ORDER BY win, batch_no) AS g FROM b),
s AS (SELECT win, batch_no, sum(CASE WHEN n = failed THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY win, batch_no) AS streak, coalesce(systematic_error = lag(systematic_error) OVER (ORDER BY win, batch_no), false) AS again FROM g)
SELECT win, CAST(max(streak) AS BIGINT) AS streak, bool_or(again) AS again, CAST(arg_max(streak, batch_no) AS BIGINT) AS ending FROM s GROUP BY win""")
def streaks_over_windows(spark, sf_dir):
    """The gates' streaks, which go on from window to window though no task sees the batches of all."""
    told = inference.joined_streaks(inference.window_streaks(event_outcomes(spark, sf_dir)))
    return told.select("win", F.col("streak").cast("long").alias("streak"), "again", F.col("ending").cast("long").alias("ending"))


@query(f"""WITH {BATCHES}, g AS (SELECT *, sum(CASE WHEN n = failed THEN 0 ELSE 1 END) OVER (ORDER BY win, batch_no) AS g FROM b),
s AS (SELECT win, batch_no, sum(CASE WHEN n = failed THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY win, batch_no) AS streak, coalesce(systematic_error = lag(systematic_error) OVER (ORDER BY win, batch_no), false) AS again FROM g)
SELECT win, CASE WHEN bool_or(again) THEN 'systematic' WHEN max(streak) >= 3 THEN 'dead' END AS verdict FROM s GROUP BY win""")
def gate_verdicts(spark, sf_dir):
    """After which of all windows a run would be stopped, and why; three failed batches in a row are the end here."""
    return inference.verdicts(event_outcomes(spark, sf_dir), most=3).select("win", "verdict")
