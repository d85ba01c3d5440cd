"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from multiprocessing.pool import ThreadPool

from pyspark.sql import SparkSession


def build_session(master: str | None = None, partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Local session for tests and the bench.

    On a cluster the session comes from spark-submit and only the
    analytics settings below matter: AQE on (coalesce + skew join), UTC
    session time, Arrow for the few pandas hops.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``; only a local session
    (tests, bench) with nothing configured gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_folder(spark: SparkSession) -> str:
    """The configured shared folder itself, the same for every application; ``checkpoint_dir`` is this application's part."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    return (path or checkpoint_dir(spark)).rstrip("/")


def tables_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def materialize(df):
    """Cut lineage: write ``df`` once as a Parquet table in the shared
    checkpoint folder and read it back.

    Used before plans that read their input more than once (bucketed windows,
    iterative algorithms): the upstream is computed exactly once (an eager
    ``checkpoint()`` computes it twice unless cached), later reads prune
    columns and carry real size statistics, and a lost executor re-reads the
    files instead of recomputing the lineage. A returned DataFrame may read
    such tables until it is consumed; ``release_tables`` deletes them then.
    """
    import uuid

    path = f"{tables_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def release_tables(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; call it when no result that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def at_once(calls, parallelism: int = 8) -> list:
    """The results of ``calls``, ``parallelism`` of them at a time: a fit is a chain of small jobs that leaves the
    executors idle between them, so several share them."""
    with ThreadPool(max(1, parallelism)) as pool:
        return pool.map(lambda call: call(), list(calls), chunksize=1)


def spread(df, rows: int = 20_000):
    """``df`` over at least a partition per ``rows`` rows, for work that is heavy per row: a narrow table lies in few
    files however many rows it has. One that has that many partitions, or is small, stays as it is."""
    parts = -(-df.count() // rows)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (pandas UDFs, mapInPandas).

    On a local master the package is zipped into a scratch folder and added
    with ``addPyFile``; on a cluster it is expected to be shipped with
    ``--py-files`` (or installed on the executors).
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    if sc.master.startswith("local"):
        import zipfile

        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        out = os.path.join(tempfile.mkdtemp(prefix="tidemark-pkg-"), "tidemark.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
    _SHIPPED.add(key)
