"""Result tables of very many experiments: rows in hashed buckets, reloaded experiment by experiment.

A table is a folder of buckets, named after their number and how many there are. The uid is a column of the files, so it stays
the text it is, and the number of folders does not grow with the experiments. A reload rewrites the buckets of the
reloaded experiments from their other rows and the new ones, by way of a staging table: until that is complete the table
is untouched, and afterwards the same rows can be written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from seqtables.session import shared_folder

#: Buckets of a new table. A reload reads and writes this share of the table for each bucket it touches.
BUCKETS = 256
_BUCKET = "bucket"


def bucket(uid: Column, count: int) -> Column:
    """The folder value of an experiment: count and number, as text that no reader takes for a number."""
    return F.format_string(f"{count}n%05d", F.pmod(F.xxhash64(uid), F.lit(count)))


def _with_bucket(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add(_BUCKET, StringType())


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def _present(spark: SparkSession, path: str) -> list[str]:
    """The bucket values of a table; none where there is no table. Their number is the table's bucket count at most."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = (entry.getPath().getName() for entry in system.listStatus(folder))
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{_BUCKET}=")]


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table's rows with the declared schema; no rows where no table has been written."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not _present(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(_with_bucket(schema)).parquet(path).drop(_BUCKET)


def replace(rows: DataFrame, path: str, reloaded: DataFrame | None = None, order: Sequence[str] = (), count: int | None = None) -> None:
    """Replace whole experiments: those in ``rows`` and those in ``reloaded`` (uid), which without rows lose theirs.

    ``rows`` are read twice: write them first where that is dear. ``count`` is the number of buckets of a new table; for
    one that is there it must be the table's own. The rebalance hint splits a large experiment over tasks and gathers
    small ones; rows are ordered inside each file.
    """
    spark = rows.sparkSession
    there = _present(spark, path)
    own = int(there[0].split("n")[0]) if there else None
    if own and count and own != count:
        raise ValueError(f"the table has {own} buckets, not {count}")
    count = own or count or BUCKETS
    uids = rows.select("uid")
    uids = (uids.unionByName(reloaded.select("uid")) if reloaded is not None else uids).distinct()
    touched = sorted(r[0] for r in uids.select(bucket(F.col("uid"), count)).distinct().collect())
    if not touched:
        return
    new = rows.withColumn(_BUCKET, bucket(F.col("uid"), count))
    if there:
        old = spark.read.schema(_with_bucket(rows.schema)).parquet(path).filter(F.col(_BUCKET).isin(touched))
        gone = uids.withColumnRenamed("uid", "reloaded_uid")
        old = old.join(gone, F.col("uid").eqNullSafe(F.col("reloaded_uid")), "left_anti")
        new = old.select(*new.columns).unionByName(new)
    staging = shared_folder(spark, "bucket-staging")
    _write(new.hint("rebalance", _BUCKET), staging, order)
    filled = _present(spark, staging)
    if filled:  # files are large or few already, so they are copied as they are dealt
        _write(spark.read.schema(_with_bucket(rows.schema)).parquet(staging), path, order)
    system, folder = _folder(spark, path)
    for value in set(touched) & set(there) - set(filled):
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{_BUCKET}={value}"), True)
    system, folder = _folder(spark, staging)
    system.delete(folder, True)


def _write(rows: DataFrame, path: str, order: Sequence[str]) -> None:
    (rows.sortWithinPartitions(_BUCKET, "uid", *order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path))
