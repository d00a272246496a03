"""Spark session helpers shared by tests, bench and the query catalogue."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Configs that matter for every ordo plan. AQE coalesces the many small
# post-shuffle partitions of per-query aggregates and splits skewed join
# partitions at runtime; the broadcast threshold stays at Spark's default so
# only sides with a known small size are broadcast without an explicit check.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ordo", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with ordo's defaults.

    Master, shuffle partitions and driver memory are set only when they are
    passed; else they stay as spark-submit or the cluster config has them, and
    so does every setting of ``DEFAULT_CONF`` that was given there. The
    checkpoint folder comes from ``spark.checkpoint.dir``; a scratch folder is
    made only in local mode and only when that is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    given = dict(SparkConf().getAll())
    if SparkSession.getActiveSession() is None:
        for k, v in DEFAULT_CONF.items():
            if k not in given:
                builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not cur:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and "
                               "round-trip files must survive the loss of any executor")
        cur = tempfile.mkdtemp(prefix="ordo-ckpt-")   # local mode only (tests, bench)
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def materialize(df):
    """Cut lineage at an expensive intermediate that several consumers read
    (e.g. the feature matrix: group-size check, rank, NDCG). Writes it once to
    the shared ``spark.checkpoint.dir`` (reliable, survives executor loss;
    never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def arrow_batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Inside, batches that go to Python workers end with the row that passes ``most`` bytes; for jobs that
    run there. A vector of a whole default batch is grown by copies, in memory that an executor's
    allocator doesn't give back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Generations:
    """Tables of a loop, as Parquet in a folder of their own under ``spark.checkpoint.dir``.

    A checkpoint keeps the size estimate of the plan that it cut, so estimates multiply
    from join to join; a table that is read back has its real size. ``drop`` removes a
    table that nothing will read any more, so a loop of many rounds holds the disk of
    the tables in use only."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back."""
        path = f"{self.base}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = (back, path)
        return back

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove tables that ``keep`` returned; others, and None, are passed over."""
        for table in tables:
            held = self._paths.pop(id(table), None)
            if held is not None:
                self._delete(held[1])

    def keep_only(self, *tables: DataFrame) -> None:
        """Remove all tables but these."""
        mine = {id(t) for t in tables}
        self.drop(*[t for t, _ in self._paths.values() if id(t) not in mine])

    def close(self) -> None:
        """Remove the folder with all its tables."""
        self._paths.clear()
        self._delete(self.base)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
