"""Session helpers: one place for the configuration the operators assume."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_SHIPPED = "spark.orrery.shipped"
_STAGES: set[str] = set()


def get_session(master: str | None = None, app: str = "orrery",
                shuffle_partitions: int | None = None,
                driver_memory: str = "16g") -> SparkSession:
    """Build (or fetch) a session with AQE on and a pinned UTC clock.

    On a cluster the master and checkpoint directory come from spark-submit;
    ``master`` is only used for local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", driver_memory))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM without separate executors (``local-cluster`` is a cluster)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    *and* the master is local (tests, laptops) do we create one of our own;
    on a cluster an unset value is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    if not is_local(spark):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="orrery-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(CHECKPOINT_KEY, path)
    sc.setCheckpointDir(path)
    return path


def stage_path(spark: SparkSession, name: str = "stage") -> str:
    """A new folder name under the shared checkpoint folder. It is removed by
    ``drop_stage``, or at the end of the application at the latest."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _STAGES:
        atexit.register(_drop_all, spark)
    _STAGES.add(path)
    return path


def drop_stage(spark: SparkSession, *paths: str) -> None:
    """Delete stage folders whose readers are done."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        _STAGES.discard(path)


def _drop_all(spark: SparkSession) -> None:
    with suppress(Exception):  # the JVM may be gone already; nothing is left to do then
        drop_stage(spark, *list(_STAGES))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now; they
    are kept for as long as the driver's garbage holds their plans."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def stages(spark: SparkSession):
    """Scope for intermediate tables: ``keep(df, name)`` writes one under the
    shared folder and returns it reread; every table written in the scope is
    deleted when the scope ends, so a scope must write what it returns
    elsewhere (``cut_lineage``) or collect it first."""
    paths: list[str] = []

    def keep(df: DataFrame, name: str = "stage") -> DataFrame:
        paths.append(stage_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        drop_stage(spark, *paths)


@contextmanager
def set_for(spark: SparkSession, **settings: str):
    """Session settings (dots as two underscores) that hold for the plans made in the scope."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` once as parquet under the shared checkpoint folder
    and continue from the written table.

    A reliable ``checkpoint()`` of an unpersisted plan computes it twice (the
    action, then the checkpoint write); a parquet write computes it once,
    stores it columnar and compressed, and survives executor loss. Never a
    machine-local folder, never ``localCheckpoint``."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that the
    functions that run in Python workers can be imported there. Nothing to do
    for a local master; harmless beside ``--py-files``."""
    if is_local(spark) or spark.conf.get(_SHIPPED, None):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="orrery-ship-"), "orrery_ship.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("orrery", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    spark.conf.set(_SHIPPED, "true")

