"""The folder all executors share, and tables written there to cut lineage."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict = {}
_tried: dict = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder. On a
    cluster a bare path goes to whatever file system is the default, which may be each machine's
    own, so it is tried out before it is taken (``tried_folder``). ``file:`` is taken at its word
    as a mount that all machines share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = re.match(r"local(\[|$)", context.master)
    if configured and (local or re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", configured)):
        return configured.rstrip("/")
    if configured:
        return tried_folder(spark, configured)
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="cataloom-")
    return _local_dirs[app]


def tried_folder(spark: SparkSession, folder: str) -> str:
    """A folder named without a scheme, with that of the default file system.

    If this is the machines' own, tasks write a small table there, which the driver has to find
    and tasks have to read; again whenever executors came since. Else a scheme is needed.
    """
    try:
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path)
        named = path.toString().rstrip("/")
        if path.toUri().getScheme() != "file":
            return named
        infos = context._jsc.sc().statusTracker().getExecutorInfos()
        known = _tried.setdefault((context.applicationId, named), set())
        if executors := {(x.host(), x.port()) for x in infos} - known:
            trial = f"{named}/cataloom/{uuid.uuid4().hex}/trial"
            tasks = 8 * context.defaultParallelism
            spark.range(0, tasks, 1, tasks).write.parquet(trial)
            found = spark.read.schema("id bigint").parquet(trial).count()
            if found != tasks:
                raise OSError(f"of {tasks} files of tasks the driver finds {found}")
            known |= executors
    except Exception as failed:
        raise RuntimeError(f"spark.checkpoint.dir needs a scheme, it is {folder}") from failed
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path, never used before, below the shared folder."""
    return f"{shared_dir(spark)}/cataloom/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Later uses prune columns, survive lost executors, and let the optimizer see the
    real size when it chooses between a broadcast and a shuffle.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if any(path.startswith(f"{named}/") for _, named in _tried):
        shared_dir(spark)  # executors that came meanwhile have to reach the folder too
    return spark.read.schema(df.schema).parquet(path)
