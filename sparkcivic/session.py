"""Session construction and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours gets. AQE re-plans joins from runtime sizes
# (broadcast only when the materialised side is below the threshold), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "sparkcivic",
                  shuffle_partitions: int | None = None, checkpoint_dir: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with our settings. Master, partition count and shared folder
    are those given at submit time unless the caller names others."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir is not None:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a distributed file
    system path every executor can reach); it is an error if it is not. Only
    when the master is local do we create a folder of our own and register it.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sparkcivic-ckpt-")
        sc.setCheckpointDir(path)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_scopes = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    path = f"{root}{sep}sparkcivic/{name}-{uuid.uuid4().hex[:12]}"
    for paths in getattr(_scopes, "stack", ()):
        paths.append(path)
    return path


def delete_paths(spark: SparkSession, paths) -> None:
    """Recursively delete folders on whatever file system holds them (the
    Hadoop file system of each path, as Spark's own writers resolve it)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)


def switch(spark: SparkSession, staged: str, target: str) -> None:
    """Put the folder ``staged`` in the place of ``target``. What was there is
    taken aside first, put back if the switch fails, and deleted after it."""
    jvm = spark.sparkContext._jvm
    new, at, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target, f"{staged}-old"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at.getParent())
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise IOError(f"cannot take {target} aside")
    try:
        if not fs.rename(new, at):
            raise IOError(f"cannot put {staged} in the place of {target}")
    except Exception:
        if had and not fs.exists(at):
            fs.rename(old, at)
        raise
    if had:
        fs.delete(old, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete every scratch folder made inside the block when it ends.

    Frames returned inside the block (e.g. from ``nearest_sites``) read from
    these folders, so run every action on them before leaving the block.
    Yields the list of folders made so far.
    """
    stack = _scopes.__dict__.setdefault("stack", [])
    paths: list[str] = []
    stack.append(paths)
    try:
        yield paths
    finally:
        stack.pop()
        delete_paths(spark, paths)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_arrow_batches(spark: SparkSession, rows: int) -> None:
    """From now on, Python workers of this session get at most ``rows`` rows at a
    time; a smaller bound of the session stays. Results do not depend on it."""
    now = int(spark.conf.get(ARROW_ROWS))
    if now <= 0 or now > rows:  # 0 and less: no bound
        spark.conf.set(ARROW_ROWS, str(rows))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df: DataFrame, name: str, metrics: dict | None = None):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return a frame that reads it back.

    This cuts lineage like ``checkpoint()`` (a lost executor never forces a
    recompute of the upstream plan), but stores columnar, compressed data
    instead of serialized rows, and the read-back gets Parquet statistics.

    ``metrics`` ({name: aggregate Column}) are computed by the same write job
    through ``DataFrame.observe``; then ``(frame, {name: value})`` is returned.
    """
    path = scratch_path(df.sparkSession, name)
    obs = None
    if metrics:
        from pyspark.sql import Observation
        obs = Observation(f"materialize-{name}")
        df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    df.write.mode("overwrite").parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)  # known, so no job reads the footers
    return (frame, obs.get) if obs is not None else frame
