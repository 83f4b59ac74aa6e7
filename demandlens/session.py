"""Session settings and shared-storage helpers."""

from __future__ import annotations

import contextlib
import contextvars
import io
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (text stamps are UTC), ANSI casts
# (bad input fails instead of turning into NULL), AQE for runtime re-planning and
# skewed-join splitting.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "demandlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset and let the launcher decide; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Hold these SQL settings for the jobs that run inside this scope."""
    was = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in was.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set and the master is local (tests, local runs) a fresh
    temporary folder is registered; on a cluster a missing setting is an error,
    never a machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not str(master).startswith("local"):
                raise RuntimeError(
                    "set spark.checkpoint.dir to a folder every executor can reach; "
                    "intermediate tables are written there")
            root = tempfile.mkdtemp(prefix="demandlens-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of a session's executors, once: a zip of its
    sources under the shared checkpoint folder, added as a Python file. Needed by jobs with
    Python functions where the package is not installed on the executors."""
    sc = spark.sparkContext
    if getattr(sc, "_demandlens_shipped", False):
        return
    here = pathlib.Path(__file__).parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(here.rglob("*.py")):
            z.write(source, str(source.relative_to(here.parent)))
    target = f"{checkpoint_root(spark)}/demandlens-{uuid.uuid4().hex[:12]}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(target)
    sc._demandlens_shipped = True


# Bytes of input that one task of an explicit repartitioning should get.
TASK_BYTES = 128 * 1024 * 1024


def partitions_for(df: DataFrame) -> int:
    """Partition count for an explicit repartitioning of ``df``: by the bytes its plan scans
    (estimates of joined sizes multiply and say nothing), and not below the session's
    shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
        size = 0
        while leaves.hasNext():
            size += int(str(leaves.next().stats().sizeInBytes()))
    except Exception:  # no plan access (Spark Connect)
        return least
    # a leaf without statistics claims an endless size
    return least if size >= 1 << 60 else max(least, -(-size // TASK_BYTES))


# Open scratch scopes, innermost last; each lists the folders written inside it.
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("demandlens_scratch", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Own the intermediate tables of a job: those that materialize() writes inside this
    scope (in this thread) are deleted when it ends, also by an error. Frames that read
    them must have been consumed by then."""
    folders: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), folders))
    try:
        yield folders
    finally:
        _SCOPES.reset(token)
        delete_folders(spark, folders)


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


# The exchanges of a written frame go as soon as it is written, not when the driver happens to collect garbage.
FREE_EXCHANGES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def materialize(df: DataFrame, name: str, rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.
    ``rows_per_file`` bounds what a writer or reader holds of very large rows: Parquet looks
    at the size of a row group only every hundred rows.

    Cuts lineage (a lost executor re-reads the files instead of recomputing the plan) and
    gives the planner exact file sizes, so later joins pick broadcast or shuffle from real
    statistics. The folder belongs to the innermost open scratch() scope; outside of one
    the caller's frame still reads it, and it stays until the checkpoint folder is cleared.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/demandlens/{name}-{uuid.uuid4().hex}"
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)
    with settings(spark, FREE_EXCHANGES):
        df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file or 0).parquet(path)
    return spark.read.parquet(path)
