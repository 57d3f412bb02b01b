"""Spark session settings used by tests, the bench and the query registry.

On a cluster the session normally exists already (spark-submit, notebooks): its settings are taken as they are, besides
``guard``. Set spark.sql.session.timeZone to UTC there if dates are rendered from timestamps, and
spark.cleaner.referenceTracking.cleanCheckpoints to true, so that checkpoint files go with the frames that read them.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins at runtime (broadcast when a side turns out
# small, splits skewed partitions, coalesces tiny ones); the reconcile fast paths rely on it for hot 1×m keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Correctness guard. With Spark 4.1's default ``unionOutputPartitioning=true`` a Union of key-partitioned children
# reports that partitioning, a later repartition on the key is dropped, and under AQE the children are coalesced
# differently -- rows of one key then land in different tasks. Observed here as a wrong reconcile result at sf0.1.
GUARD_CONF = {"spark.sql.unionOutputPartitioning": "false"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "recheck",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session builder; on a cluster use the provided session."""
    master = master or os.environ.get("RECHECK_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf.update(GUARD_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("RECHECK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def guard(spark: SparkSession) -> None:
    """Apply the correctness guards (always, whatever the cluster default)."""
    for k, v in GUARD_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 -- older Spark without this setting
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared (HDFS/object-store) folder there. A scratch folder is made only where nothing is set and
    the master is local, as in tests; elsewhere a folder of the driver's own would be out of the executors' sight.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not d and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="recheck-ckpt-", dir=os.environ.get("RECHECK_SCRATCH", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and continue from there (lineage cut, survives executor loss).

    For computed inputs that feed several branches of one flow. It is not pre-partitioned by a key: that would send
    a hot key to a single task, and with AQE on a checkpoint does not keep its partitioning anyway. Plain parquet
    scans are cheaper to re-read than to copy.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Scratch:
    """A folder of this run's own under spark.checkpoint.dir, for tables that several branches read: Parquet, so that
    each reads only its columns. ``drop`` removes it; what is still there when Python ends is removed then."""

    _open: list = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.path = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
        self._place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not Scratch._open:
            atexit.register(Scratch._drop_all)
        Scratch._open.append(self)

    def written(self, df, name: str, by: tuple[str, ...] = ()):
        """``df`` written (a folder for each value of ``by``) and read again."""
        path = f"{self.path}/{name}"
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def has(self, name: str) -> bool:
        return self._files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"))

    def remove(self, name: str) -> None:
        """Removes one table that nothing reads any more."""
        self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def drop(self) -> None:
        if self in Scratch._open:
            Scratch._open.remove(self)
        self._files.delete(self._place, True)

    @staticmethod
    def _drop_all() -> None:
        for s in list(Scratch._open):
            try:
                s.drop()
            except Exception:  # noqa: BLE001 -- the session may be gone: the folder stays
                pass
