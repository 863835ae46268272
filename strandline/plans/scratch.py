"""The scratch area: tables in the cluster's shared folder that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir.

    Where the session has none, a temporary folder serves a local master; on a
    cluster that would be a folder other machines can't see, so it is an error.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = conf.get("spark.master", "")
    if not master.startswith("local[") and master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="strandline-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the scratch area, remembered for release()."""
    app = spark.sparkContext.applicationId
    path = f"{scratch_dir(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(app, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the scratch area and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize() gave and that nothing reads any more; others are left alone."""
    for df in tables:
        path = df.__dict__.get("_scratch_path")
        if path:
            release(df.sparkSession, [path])


def written(spark: SparkSession) -> list[str]:
    """Scratch paths of this application that release() has not deleted."""
    return list(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete scratch tables that this application wrote, all or those given; results that read them must be stored first."""
    app, jvm, done = spark.sparkContext.applicationId, spark.sparkContext._jvm, 0
    for path in written(spark) if paths is None else paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        done += bool(fs.delete(target, True))
        if path in _WRITTEN.get(app, []):
            _WRITTEN[app].remove(path)
    return done
