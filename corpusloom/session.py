"""Session defaults and the shared folder used for materialised tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="corpusloom-")
    return _local_dirs[app]


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/corpusloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in this application's part of the shared folder, never used before."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, path: str | None = None, form: str = "parquet") -> DataFrame:
    """Write ``df`` as Parquet to ``path`` (a fresh shared path if none) and read it back.

    The copy survives lost executors, and later jobs start from it instead of the inputs. ``form`` may
    name another format; ORC suits thousands of columns, since its writer collects rows before it encodes.
    """
    target = path or fresh_path(df.sparkSession, name)
    df.write.format(form).save(target)
    return df.sparkSession.read.schema(df.schema).format(form).load(target)


def clean_up(spark: SparkSession) -> None:
    """Delete the tables this application has materialised without a path of its own."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
