"""FASTQ text: line numbers across splits, the record check, and merging of sources.

A line's number within its file is not known to the task that reads one split of it. Each split
counts its lines, the counts are summed over the splits before it, and only these one-row-per-split
totals are shuffled. The record check needs the line number modulo 4 alone, so it folds each split
to eight counters first and never numbers the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtables.functions import text

RECORD_LINES = 4
# only leading blanks may come before the mark
_HEAD, _PLUS = r"^[ \t]*@", r"^[ \t]*\+"


def fastq_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of FASTQ files (plain, gz or bz2) with file, split start and an id rising within a split."""
    return spark.read.text(path).select(
        text.decoded(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )


def experiment_and_mate(path: Column) -> list[Column]:
    """The uid and mate in a name like ``{uid}.fastq.bz2`` or ``{uid}_2.fastq``; an empty uid for
    other files."""
    pattern = r"([^/]+?)(_2)?\.fastq(\.bz2|\.gz)?$"
    mate = F.when(F.regexp_extract(path, pattern, 2) == "_2", 2).otherwise(1)
    return [F.regexp_extract(path, pattern, 1).alias("uid"), mate.alias("mate")]


def experiment_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Numbered lines of the experiments' FASTQ files: uid, mate, line_no, value."""
    lines = numbered(fastq_lines(spark, path))
    return lines.select(*experiment_and_mate(F.col("file")), "line_no", "value").filter("uid <> ''")


def _lines_before(splits: DataFrame) -> DataFrame:
    """Splits with the number of lines in the splits before them in the same file."""
    earlier = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with their number in the file, from 0."""
    splits = lines.groupBy("file", "split_start").agg(F.count("*").alias("n"), F.min("line_id").alias("first_id"))
    offsets = _lines_before(splits).select("file", "split_start", (F.col("before") - F.col("first_id")).alias("shift"))
    return lines.join(offsets, ["file", "split_start"]).select(
        "file", (F.col("line_id") + F.col("shift")).alias("line_no"), "value"
    )


def _verdict(heads: Column, pluses: Column) -> list[Column]:
    return [heads.alias("n_heads"), pluses.alias("n_pluses"), (heads == pluses).alias("valid")]


def check_files(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The record check per file, from ``fastq_lines``: as many '@' on lines 1, 5, .. as '+' on
    lines 3, 7, .. One scan.

    An empty file is not scanned; it appears, as valid, when ``files`` names it.
    """
    residue = F.pmod("line_id", F.lit(RECORD_LINES))
    counters = [
        F.count_if((residue == r) & F.col("value").rlike(mark)).alias(f"{name}{r}")
        for name, mark in (("head", _HEAD), ("plus", _PLUS)) for r in range(RECORD_LINES)
    ]
    splits = _lines_before(lines.groupBy("file", "split_start").agg(
        F.count("*").alias("n"), F.min("line_id").alias("first_id"), *counters
    ))
    # a line at record position p has id residue (p - before + first_id) mod 4
    def at(name: str, position: int) -> Column:
        wanted = F.pmod(F.col("first_id") - F.col("before") + position, F.lit(RECORD_LINES))
        return F.get(F.array(*[F.col(f"{name}{r}") for r in range(RECORD_LINES)]), wanted.cast("int"))

    counts = splits.groupBy("file").agg(F.sum(at("head", 0)).alias("heads"), F.sum(at("plus", 2)).alias("pluses"))
    if files is not None:
        counts = files.join(counts, "file", "left")
    zero = F.lit(0).cast("bigint")
    return counts.select("file", *_verdict(F.coalesce("heads", zero), F.coalesce("pluses", zero)))


def check_numbered(lines: DataFrame, *keys: str) -> DataFrame:
    """The record check over lines that already carry ``line_no``, per ``keys``."""
    position = F.pmod("line_no", F.lit(RECORD_LINES))
    return lines.groupBy(*keys).agg(
        F.count_if((position == 0) & F.col("value").rlike(_HEAD)).alias("heads"),
        F.count_if((position == 2) & F.col("value").rlike(_PLUS)).alias("pluses"),
    ).select(*keys, *_verdict(F.col("heads"), F.col("pluses")))


def merge_sources(copies: DataFrame, lines: DataFrame) -> DataFrame:
    """Each copying experiment's reads: the lines of its sources, in list order, per mate.

    ``copies`` has uid, pair, position, source_uid; ``lines`` has uid, mate, line_no, value. Line
    numbers run on across sources. The offsets come from one count per (source, mate); the lines
    are joined once and not sorted: the sink orders them by (uid, mate, line_no).
    """
    sizes = lines.groupBy(F.col("uid").alias("source_uid"), "mate").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("uid", "mate").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        copies.join(sizes, "source_uid")
        .filter((F.col("mate") == 1) | F.col("pair"))
        .select("uid", "source_uid", "mate", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    return lines.withColumnRenamed("uid", "source_uid").join(offsets, ["source_uid", "mate"]).select(
        "uid", "mate", (F.col("line_no") + F.col("before")).alias("line_no"), "value"
    )


def record_lines(records: DataFrame) -> DataFrame:
    """Records (uid, mate, record_no, l1..l4) as numbered lines."""
    four = F.array("l1", "l2", "l3", "l4")
    return records.select("uid", "mate", "record_no", F.posexplode(four).alias("i", "value")).select(
        "uid", "mate", (F.col("record_no") * RECORD_LINES + F.col("i")).alias("line_no"), "value"
    )
