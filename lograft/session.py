"""Session construction, session-level settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (log times carry no zone),
# adaptive execution for runtime re-planning (partition coalescing, skew
# splitting, broadcast of joins whose measured side is small), no UI server.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "lograft",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``shuffle_partitions`` should be sized to the data: about one partition per
    128-256 MB of shuffled bytes on a cluster (AQE coalesces the small ones),
    about the number of cores in local mode.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def s3a_conf(credential_providers: list[str] | None = None) -> dict[str, str]:
    """Settings for reading ``s3a://`` paths (SRC8), to pass as ``build_session(conf=...)``.

    The object-store connector jars come with the deployment; nothing here
    opens a connection until a path is read.
    """
    conf = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if credential_providers:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = ",".join(credential_providers)
    return conf


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names this folder (HDFS, object store); it is read from the
    session. ``default`` is only applied when nothing is set, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if default is None:
        raise RuntimeError("spark.checkpoint.dir is not set for this session")
    sc.setCheckpointDir(default)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return the re-read frame.

    Reliable checkpoint files survive the loss of any executor, unlike cached
    blocks; later actions re-read them instead of recomputing the input scan.
    """
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small intermediate that several later steps read, once.

    Spark only reuses a shared sub-plan when every consumer prunes and filters
    it identically, which rarely holds (a window on one side, an aggregate on
    the other). The result is written to the shared folder that the session
    names (``spark.checkpoint.dir``), so it survives the loss of any executor; a
    folder of our own is set only where the session names none, as in tests.
    Use it for results that are small next to their input (one row per
    application, per group), not for raw-scale data, which is cheaper to re-scan.
    """
    shared_folder(df.sparkSession)
    return cut_lineage(df)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it names none, one of our own in local mode, as in tests; on
    a cluster, whose executors share no local folder, that is an error."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named or not sc.master.startswith("local"):
        return checkpoint_dir(spark)
    return checkpoint_dir(spark, default=tempfile.mkdtemp(prefix="lograft-"))
