"""The shared folder for tables that a job writes on its way."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="towerlens-")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the cluster in ``spark.checkpoint.dir``.

    Where it is unset, a folder of our own, but only if all of Spark runs on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


_made: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/towerlens/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def forget_written(spark: SparkSession) -> int:
    """Deletes the tables this session has written on its way, and says how many.

    To be called when the results that read them have been saved; until then nothing is removed. Bucketed ones go
    from the session's catalog too.
    """
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = _made.pop(spark.sparkContext.applicationId, [])
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(settings).delete(path, True)
    return len(paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet in the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives the optimizer the true size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, name: str, buckets: int, *columns: str) -> DataFrame:
    """As ``written``, in buckets by ``columns``, so that joins and groups by them leave the rows where they are."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    df.write.bucketBy(buckets, *columns).option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)
