"""Session helpers: a local session for tests/bench and the checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "urlsight", **conf) -> SparkSession:
    parts = str(os.cpu_count() or 8) if str(cpus) == "*" else str(cpus)
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", parts)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("URLSIGHT_DRIVER_MEMORY", "12g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               # whole documents go through the entropy UDF: keep Arrow batches small
               .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session without one
    (tests) gets a fresh scratch folder; a cluster session without one is an
    error, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="urlsight-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where a table is re-read by many jobs (model fitting): it is
    computed once, survives executor loss, and later jobs start from files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Evaluates the input once; what follows reads columns from shared files,
    so it survives lost executors. A job removes its tables with
    :func:`discard_written` when its results are stored.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def tables_written() -> int:
    """How many tables this process has made with :func:`written` and not discarded."""
    return len(_written)


def discard_written(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables made with :func:`written` after the first ``since`` ones; how many there were.

    For the end of a job: DataFrames that still read such a table fail afterwards.
    """
    conf, n = spark._jsparkSession.sessionState().newHadoopConf(), len(_written) - since
    while len(_written) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
