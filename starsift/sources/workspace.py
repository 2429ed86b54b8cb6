"""Tables written between stages of one job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session, whose executors share the driver's disk, may go without
    the setting; it then gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
        if context.applicationId not in _local:
            _local[context.applicationId] = tempfile.mkdtemp(prefix="starsift-")
        folder = _local[context.applicationId]
    return folder.rstrip("/")


def session_folder(spark: SparkSession) -> str:
    """Folder of the tables this application writes."""
    return f"{shared_folder(spark)}/starsift/{spark.sparkContext.applicationId}"


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table in the shared folder."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and the file sizes give the
    optimizer true statistics to choose join strategies by.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table from :func:`materialize` once it is replaced."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/starsift/" in folder:
            _delete(df.sparkSession, folder)


def clear_workspace(spark: SparkSession) -> None:
    """Delete every table this application has written to the shared folder.

    For the end of a job, when no result that reads them is needed any more.
    """
    _delete(spark, session_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer splits than there are.

    For small files whose rows need much work. A large input has splits enough and
    is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
