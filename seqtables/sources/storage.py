"""Result tables on shared storage: replacing experiments, layout, text output, file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from seqtables import schemas
from seqtables.sources import inventory


def replace_experiments(rows: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Write a result table so that each experiment present in ``rows`` is replaced whole.

    Other experiments stay. The rebalance hint lets adaptive execution gather small experiments
    into few files and split a large one over several tasks; rows are ordered inside each file, so
    Parquet statistics prune on ``order``. One folder an experiment: for few large ones, read with a declared schema, as
    a folder's name does not tell text from a number. ``sources/buckets.py`` is for many, and clears emptied ones.
    """
    (
        rows.hint("rebalance", "uid")
        .sortWithinPartitions("uid", *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("uid")
        .parquet(path)
    )


def write_clustered(rows: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write a result table of very many small experiments: no folder per uid, ranges of (uid, order)."""
    rows.repartitionByRange("uid", *order).sortWithinPartitions("uid", *order).write.mode("overwrite").parquet(path)


def rebuild_layout(spark: SparkSession, path: str, experiments: DataFrame, order: Sequence[str], staging: str) -> None:
    """Rewrite the chosen experiments of a table in its sorted layout.

    The rows go to ``staging`` first, so a lost job never leaves the table without them.
    """
    # a uid of digits must stay the text it is
    text = [StructField(f.name, StringType()) if f.name == "uid" else f for f in spark.read.parquet(path).schema.fields]
    chosen = spark.read.schema(StructType(text)).parquet(path).join(experiments.select("uid").distinct(), "uid", "left_semi")
    replace_experiments(chosen, staging, order)
    replace_experiments(spark.read.schema(chosen.schema).parquet(staging), path, order)


def write_lines(lines: DataFrame, path: str, *keys: str) -> None:
    """Write numbered lines as text, one folder per key value, in line order across its files."""
    order = (*keys, "line_no")
    (
        lines.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*keys, "value").write.mode("overwrite").partitionBy(*keys).text(path)
    )


def listing(spark: SparkSession, path: str, uid_pattern: str) -> DataFrame:
    """uid, path and length of the files below ``path``, from an inventory; their contents are not read.

    ``uid_pattern`` is a regular expression over the file path whose first group is the uid.
    """
    return inventory.of_experiments(inventory.inventory(spark, path), uid_pattern)


def footprint_kib(files: DataFrame) -> DataFrame:
    """File sizes summed per experiment, in KiB, from (uid, path, length). A path listed twice counts once."""
    once = files.groupBy("uid", "path").agg(F.max("length").alias("length"))
    return once.groupBy("uid").agg((F.sum("length") / 1024).alias("size"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(uid, mate) of the read files below ``path``, from an inventory; see ``inventory.read_files``."""
    return inventory.read_files(inventory.inventory(spark, path))


def catalogue_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A catalogue table with its declared schema, without inference."""
    return spark.read.schema(schemas.CATALOGUE_TABLES[name]).parquet(path)
