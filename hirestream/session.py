"""Session defaults and the one place that knows about checkpoint storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "hirestream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables: ``spark.checkpoint.dir``.

    Where that is not set, a folder below the warehouse, which all executors
    share as well.
    """
    key = "spark.checkpoint.dir"
    conf = spark.sparkContext.getConf().get(key, None) or spark.conf.get(key, None)
    return (conf or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table one job hands to the next."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


#: Paths of the tables staged by this driver, in order.
STAGED: list[str] = []


def remove_stages(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables staged after the first ``since`` ones; frames that read them can't be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in STAGED[since:]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    del STAGED[since:]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that several later steps read, and read it back.

    The table survives the loss of executors, keeps later plans short, and its
    columns can still be pruned.
    """
    path = scratch_path(df.sparkSession, name)
    STAGED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
