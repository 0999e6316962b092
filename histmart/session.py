"""Session construction and cluster-facing settings.

Lineage cuts go to ``spark.checkpoint.dir``, the shared folder a cluster
names. Where it is unset, a local master gets a temporary folder (driver and
tasks share the machine there); on a cluster that is an error.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job of this engine relies on.
#  * UTC session zone: all engine timestamps are TIMESTAMP_NTZ, but a few
#    built-ins round-trip through the session zone; UTC makes that exact.
#  * AQE with skew-join splitting: the fact side of the card join can carry
#    one very hot card.
#  * Static broadcast by *estimated* size is off; broadcasts are either
#    measured by AQE at runtime or chosen by ``operators.joins`` after an
#    explicit size check.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # files of finished lineage cuts go when the driver drops their DataFrame
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "histmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    # static: one process runs many distinct plans (dimensions, facts, rules);
    # keep their compiled stages instead of recompiling after 100 entries
    conf["spark.sql.codegen.cache.maxEntries"] = "2000"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable engine settings to an existing session."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep theirs
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, set on the context if it is not yet."""
    sc = spark.sparkContext
    held = sc.getCheckpointDir()
    if held:
        return held
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="histmart-checkpoint-"))
    return sc.getCheckpointDir()


class Rows:
    """Number of rows that pass a plan's top while it is written: no second job reads them again.

    ``of`` must be the last step before the action, so that it runs in the job's result stage, whose tasks
    count once however often executors are lost; below a shuffle repeated tasks could count twice."""

    def __init__(self):
        self._seen = Observation()

    def of(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count(F.lit(1)).alias("n"))

    @property
    def n(self) -> int:
        """The count, after the action."""
        return int(self._seen.get.get("n", 0))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
