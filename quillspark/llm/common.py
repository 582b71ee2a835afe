"""Helpers shared by the training-data operators."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Longest stretch of text, in bytes, that vectorised code handles at once.
CHUNK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which deployments size to their data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Where a session has none (tests, local mode) a temporary folder of the driver is set once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        base = sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quillspark-"))
            base = sc.getCheckpointDir()
    return base.rstrip("/")


class _Settled(threading.local):
    """Paths of the tables that settle() has written in this thread and that are not deleted yet, in their order: pipelines in several
    threads do not see each other's.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []


_SETTLED = _Settled()


def settle(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and return a read of it: cuts the lineage.

    The table outlives any executor.  drop_settled() removes one that is no longer needed, drop_settled_since()
    all that this thread has written since a mark; what is left goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillspark-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_path = path
    _SETTLED.paths.append(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
    return out


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def drop_settled(df: DataFrame) -> None:
    """Delete the table behind a DataFrame that settle() returned."""
    path = getattr(df, "_settled_path", None)
    if path in _SETTLED.paths:
        _SETTLED.paths.remove(path)
        delete_folder(df.sparkSession, path)


def settled_mark() -> int:
    """For drop_settled_since()."""
    return len(_SETTLED.paths)


def drop_settled_since(spark: SparkSession, mark: int, keep: DataFrame | None = None) -> None:
    """Delete the tables settled since the mark but the one behind `keep`: once a result is written, what it was made from can go."""
    kept = getattr(keep, "_settled_path", None)
    for path in _SETTLED.paths[mark:]:
        if path != kept:
            _SETTLED.paths.remove(path)
            delete_folder(spark, path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, component), component the least node.

    Alternating large-star and small-star contraction.  Minima are partial aggregates and the
    joins are sort-merge joins that adaptive execution can split, so hubs are no hot spot.  Each
    round is written to the shared folder and takes the place of the one before.
    Self-loops and nulls are ignored; an empty table gives an empty table.
    """
    links = settle(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    state = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component")).unionByName(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            )
        state = seen
        # large star: each neighbour above a node is tied to the least of the node's neighbourhood
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi > lo").distinct()
        )
        # small star: a node and its lower neighbours are tied to the least of these
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        after = settle(
            small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi > lo")
            .unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
        )
        drop_settled(links)
        links = after


class Remembered(dict):
    """A bounded table of make(word): two generations of `half` words, the older one is dropped for the younger."""

    def __init__(self, make, half: int = 250_000, longest: int = 64):
        self.make, self.half, self.longest, self.older = make, half, longest, {}

    def __missing__(self, word):
        value = self.older.pop(word, None)
        if value is None:
            value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


_HELD: dict[str, object] = {}


def enter(operator: str, forget=None) -> None:
    """Called by an operator's code in a Python worker: drops what other operators have kept there.

    Workers live on from stage to stage; forget() is what the next operator calls to free this one's tables.
    """
    for other in [x for x in _HELD if x != operator]:
        _HELD.pop(other)()
    if forget:
        _HELD[operator] = forget
