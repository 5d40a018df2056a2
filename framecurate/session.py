"""Spark session helpers.

The library never builds its own session inside an operator: every public
function takes a DataFrame (or a ``SparkSession``) from the caller.  This
module only provides a convenience builder for tests, benches and scripts,
plus the checkpoint-directory lookup that long lineages use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain public Spark options.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python close at 4096 rows OR 64 MiB, whichever comes
    # first: compact routing rows batch by count, multi-MB frames by bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "framecurate", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``framecurate`` importable by Python workers (once per application).

    UDF and mapInPandas functions are pickled by reference to this package,
    so workers must import it: the package is zipped and distributed with
    ``SparkContext.addPyFile`` (Spark's own file distribution)."""
    import zipfile
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:                  # no SparkContext in this client (e.g. Spark Connect)
        sc, app = None, f"session-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="framecurate-pkg-"), "framecurate.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is read as-is.
    Only when it is unset (local tests) a private scratch folder is created and
    given to the SparkContext, which keeps it for later calls: the setting
    itself cannot be changed in a running session.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                               "distributed file system); a machine-local folder does not survive "
                               "executor loss")
        d = tempfile.mkdtemp(prefix="framecurate-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def folder(spark: SparkSession, tag: str) -> str:
    """The path of a new folder in the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder at the path, if there is none, by Spark's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def stage(df, tag: str):
    """``df`` written to a new folder of the shared checkpoint folder and read
    back, so that what is built on it does not run its upstream again."""
    path = folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*staged) -> None:
    """Remove the folders of staged tables that nothing reads any more.

    Takes DataFrames as ``stage`` returned them.  Only folders inside the
    shared checkpoint folder are touched, through Spark's own file system."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            discard_folder(df.sparkSession, folder)


def discard_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is inside the shared checkpoint folder."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    root = to_path(checkpoint_dir(spark)).toUri().getPath().rstrip("/")
    path = to_path(folder)
    if path.toUri().getPath().startswith(root + "/"):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folders_before(spark: SparkSession, path: str, part: str, number: int):
    """The folders ``part=<n>`` under ``path`` with n below ``number``, as one table,
    or None where nothing has been written."""
    from pyspark.errors import AnalysisException
    from pyspark.sql import functions as F
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return df.where(F.col(part) < number)
