"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "gristmill", cpus: str = "*", partitions: int = 8, **conf) -> SparkSession:
    """A single-machine session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets its own.

    On a cluster a folder of this machine would be of no use to the executors, so
    there an unset one is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='gristmill-')}"
    spark.sparkContext.setCheckpointDir(made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy outlives lost executors, cuts the lineage, and has exact sizes for
    the planner. An empty frame comes back empty with its schema.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/gristmill/{label}-{uuid.uuid4().hex}"
    # what the finished job shuffled is of no more use to anyone
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._gristmill_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a frame that ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_gristmill_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
