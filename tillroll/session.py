"""Session construction and the shared working folder.

Nothing here hard-codes a file system: every path is a parameter, so the
same code runs on a laptop (``file:``), on HDFS or on an object store.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale.  AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting handles a hot key in a
# sort-merge join.  Everything can be overridden through ``conf``.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` is the starting width of every shuffle; AQE
    coalesces small ones, so on a cluster start high (a few times the core
    count) and let the runtime shrink it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at storage every
    executor can reach; without it we refuse, since a folder of one machine is
    not seen by the others.  Only in local mode do we create a folder of our
    own and register it, so ``DataFrame.checkpoint`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def default_parallelism(spark: SparkSession) -> int:
    """Cores the session can run tasks on (shuffle width as a fallback)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root.

    What is still there when the session ends is deleted then.
    """
    path = f"{checkpoint_root(spark)}/tillroll/{name}-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, on whatever file system it is."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target
