"""Resume: the predictions dataset is the ledger, chunks get into it by a log of commits, and a manifest guards it."""

from __future__ import annotations

import hashlib
import json
import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import is_valid_id, shard_of
from ..functions.text import py_strip
from ..sources import files
from .commits import Commit, CommitLog

LOG = logging.getLogger(__name__)

SCHEMA_VERSION = 1
LEDGER = "run_id string, seq bigint, segment_id string, pred_text string, status string, error string, audio_filepath string, duration double, attempt_ts timestamp, win bigint, batch_no bigint, shard string"


class CheckpointMismatchError(Exception):
    """The ledger was written for another input or configuration."""


def fingerprint(audio_root: str, target_lang: str, task: str, model_id: str) -> str:
    """16 hex digits of the settings that may not change between runs of one ledger."""
    settings = {"audio_root": audio_root, "target_lang": target_lang, "task": task, "hf_repo_id": model_id}
    return hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def fingerprints(audio_root: Column, target_lang: Column, task: Column, model_id: Column) -> Column:
    """fingerprint() of settings in columns, for tables of runs; texts must need no escape in JSON."""
    named = {"audio_root": audio_root, "hf_repo_id": model_id, "target_lang": target_lang, "task": task}
    body = F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": "'), c, F.lit('"')) for k, c in named.items()])
    return F.left(F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256), F.lit(16))


def manifest(spark: SparkSession, path: str, fmt: str, config: str) -> dict:
    where, size, changed = files.described(spark, path)
    return {"schema_version": SCHEMA_VERSION, "input_path": where, "input_size": size, "input_mtime": changed, "input_format": fmt, "config_fingerprint": config}


def manifest_diff(old: dict, new: dict) -> dict:
    return {k: (old.get(k), v) for k, v in new.items() if old.get(k) != v}


def manifest_diffs(old: Column, new: Column) -> Column:
    """manifest_diff() of maps in columns: for each key of the new one whose value differs, both values."""
    both = F.map_zip_with(old, new, lambda k, a, b: F.struct(a.alias("before"), b.alias("after")))
    return F.map_filter(both, lambda k, v: F.map_contains_key(new, k) & ~v["before"].eqNullSafe(v["after"]))


class Ledger:
    """Predictions as Parquet, in chunks that the log of commits names; each attempt is a row, the last one of an id counts.

    One that is switched off has nothing done for a run and no manifest: runs begin anew, and their predictions take the old ones' place.
    """

    def __init__(self, spark: SparkSession, root: str, input_path: str, enabled: bool = True):
        self.spark, self.enabled = spark, enabled
        name = input_path.rstrip("/").rsplit("/", 1)[-1]
        self.dir = files.join(root, name.rsplit(".", 1)[0] if "." in name[1:] else name)
        self.data, self.manifest_path = files.join(self.dir, "predictions"), files.join(self.dir, "manifest.json")
        self.log = CommitLog(spark, self.data)

    def guard(self, payload: dict, force: bool = False) -> None:
        if not self.enabled:
            return
        old = None
        if files.exists(self.spark, self.manifest_path):
            try:
                old = json.loads(files.read_text(self.spark, self.manifest_path))
            except ValueError:
                LOG.warning("unreadable manifest %s is written anew", self.manifest_path)
        changed = manifest_diff(old, payload) if old is not None else {}
        if changed and not force:
            raise CheckpointMismatchError("; ".join(f"{k}: {a!r} -> {b!r}" for k, (a, b) in sorted(changed.items())))
        if old is None or changed:
            files.write_text(self.spark, self.manifest_path, json.dumps(payload, ensure_ascii=False))

    def started(self) -> bool:
        return bool(self.log.state().live)

    def read(self) -> DataFrame:
        """All attempts of the live chunks."""
        live = self.live()
        return self._rows(live) if live else self.spark.createDataFrame([], LEDGER)

    def live(self) -> list[Commit]:
        return list(self.log.state().live.values())

    def _rows(self, commits: list[Commit]) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(*self.log.paths(commits))

    def _bucketed(self, commit: Commit) -> DataFrame:
        """A merged chunk as a table whose buckets Spark knows, so that joins and groups by shard and id don't move it."""
        name = f"quillspark_{uuid.uuid4().hex}"
        where = files.described(self.spark, files.join(self.log.table, commit.folder))[0].replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({LEDGER}) USING parquet CLUSTERED BY (shard, segment_id) INTO {commit.buckets} BUCKETS LOCATION '{where}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # the name alone; the files stay

    def _parts(self) -> list[DataFrame]:
        """The merged chunk, if there is one, then the rows of the chunks after it, then the ids of text shards (*.done) in the ledger's folder."""
        if not self.enabled:
            return []
        live = self.live()
        late = [c for c in live if not c.buckets]
        out = [self._bucketed(c) for c in live if c.buckets]
        if late:
            out.append(self._rows(late))
        if files.any_like(self.spark, files.join(self.dir, "*.done")):
            out.append(read_text_ledger(self.spark, self.dir).where("reason is null"))
        return out

    def done(self) -> DataFrame:
        """shard and segment_id of what needs no attempt."""
        out = self.spark.createDataFrame([], "shard string, segment_id string")
        for part in self._parts():
            out = out.unionByName(part.select("shard", "segment_id"))
        return out

    def pending(self, records: DataFrame, retry_failed: bool = False) -> DataFrame:
        """Records without a prediction yet.  The merged chunk is joined where it lies; only what came after it is moved."""
        if retry_failed:
            return pending(records, self.read(), retry_failed=True)
        out = records.withColumn("shard", F.substring_index("segment_id", "-", 1))
        for part in self._parts():
            out = out.join(part.select("shard", "segment_id"), ["shard", "segment_id"], "left_anti")
        return out.drop("shard")

    def commit(self, outcomes: DataFrame, chunk: str, low: int | None = None, high: int | None = None, replace: bool = False) -> bool:
        """Enter a chunk of attempts; a chunk of a name that is there already changes nothing (False).

        With `replace` the ledger begins anew with this chunk: until it is entered readers find the old one.
        """
        return self.enter(self.stage(outcomes, chunk, low, high, replace))

    def stage(self, outcomes: DataFrame, chunk: str, low: int | None = None, high: int | None = None, replace: bool = False) -> Commit:
        """Write a chunk's attempts where they are to stay; they count for nothing until they are entered."""
        return self.log.stage(outcomes.withColumn("shard", shard_of(F.col("segment_id"))), chunk, low, high, replace)

    def staged(self, commit: Commit) -> DataFrame:
        paths = self.log.paths([commit])
        return self.spark.read.schema(LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER)

    def enter(self, commit: Commit) -> bool:
        if not self.log.add(commit):
            self.drop(commit)
            return False
        return True

    def drop(self, commit: Commit) -> None:
        files.delete(self.spark, files.join(self.log.table, commit.folder))

    def vacuum(self, older_than: float = 86400.0) -> int:
        return self.log.vacuum(older_than)

    def compact(self, share: float = 0.5, bucket_bytes: int = 1 << 27) -> bool:
        """Merge all live chunks in one of buckets by shard and id, if those since the last merge have `share` of its bytes; whether it did.

        Merging only by such shares, a ledger is rewritten a number of times that grows as the logarithm of its size.
        """
        live = self.live()
        size = lambda cs: sum(sum(c.files.values()) for c in cs)
        late = [c for c in live if not c.buckets]
        if not late or size(late) < share * size([c for c in live if c.buckets]):
            return False
        buckets = max(1, -(-size(live) // bucket_bytes), int(self.spark.conf.get("spark.sql.shuffle.partitions", "200")))
        folder, name = f"chunk-{uuid.uuid4().hex}", f"quillspark_{uuid.uuid4().hex}"
        where = files.join(self.log.table, folder)
        rows = self._rows(live).repartition(buckets, "shard", "segment_id")
        rows.write.bucketBy(buckets, "shard", "segment_id").sortBy("shard", "segment_id").option("path", where).format("parquet").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        merged = Commit(f"merged-{folder}", folder, files.sizes(self.spark, where), merged=[c.chunk for c in live], buckets=buckets)
        return self.log.add(merged)

    def latest(self) -> DataFrame:
        return last_attempts(self.read())


def last_attempts(rows: DataFrame) -> DataFrame:
    """The last attempt of each id."""
    rest = [c for c in rows.columns if c not in ("segment_id", "shard")]
    best = rows.groupBy("shard", "segment_id").agg(F.max_by(F.struct(*rest), F.struct("attempt_ts", "seq")).alias("_r"))
    return best.select("segment_id", "shard", "_r.*")


def read_text_ledger(spark: SparkSession, folder: str, names: str = "*.done") -> DataFrame:
    """segment_id, shard and `reason` of the lines of a text ledger: files of these names with an id a line.

    reason is null for ids that are done; blank lines, ids that are malformed and a last line without its end
    (`cut`: the run that wrote it died there) are kept with their reason, to be counted and left out.
    """
    lines = spark.read.option("pathGlobFilter", names).option("recursiveFileLookup", "true").option("lineSep", "\n").text(folder)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), at.alias("at"))
    # a file with one byte less than its lines with their ends has a last line without one
    whole = lines.groupBy("file").agg((F.sum(F.octet_length("value") + 1) > F.max("size")).alias("open"), F.max("at").alias("last"))
    own = py_strip(F.col("value"))
    reason = F.when(F.col("open") & (F.col("at") == F.col("last")), "cut").when(own == "", "blank").when(~is_valid_id(own), "malformed")
    told = lines.join(whole, "file").select(own.alias("segment_id"), reason.alias("reason"))
    return told.select("segment_id", F.when(F.col("reason").isNull(), shard_of(F.col("segment_id"))).alias("shard"), "reason")


def pending(records: DataFrame, done: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Records without a prediction yet, as of the start of the run: an anti-join on shard and id."""
    if retry_failed:
        done = last_attempts(done).where("status <> 'failed'")
    by_shard = records.withColumn("shard", F.substring_index("segment_id", "-", 1))
    return by_shard.join(done.select("shard", "segment_id"), ["shard", "segment_id"], "left_anti").drop("shard")


def take_first(records: DataFrame, limit: int | None) -> DataFrame:
    return records if limit is None else records.orderBy("seq").limit(max(0, limit))
