"""Readers of per-experiment result files.

A reader takes lines (``uid``, ``value``) of any number of files and gives typed rows plus a
``reject`` column: null for a good row, else the line that cannot be loaded. ``accepted`` and
``rejected`` split the two. Header lines are recognised by a substring anywhere in the line, so
a data line holding that text is skipped too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtables.fixed import RESULT_FILES
from seqtables.functions import text

ISOFORM_FIELDS = (
    ("refseq_id", "string"), ("gene_id", "string"), ("chrom", "string"), ("tx_start", "int"),
    ("tx_end", "int"), ("strand", "string"), ("tot_r_0", "double"), ("rpkm_0", "double"),
)
PEAK_FIELDS = (
    ("refseq_id", "string"), ("gene_id", "string"), ("tx_start", "int"), ("tx_end", "int"),
    ("strand", "string"), ("chrom", "string"), ("start_pos", "bigint"), ("end_pos", "bigint"),
    ("length", "bigint"), ("abssummit", "int"), ("pileup", "double"), ("log10p", "double"),
    ("foldenrich", "double"), ("log10q", "double"), ("region", "string"),
)
PROFILE_FIELDS = (("x", "int"), ("y", "double"))
ALIGN_FIELDS = tuple((c, "bigint") for c in ("tagstotal", "tagsmapped", "tagsribo", "tagssuppressed", "tagsused"))
FRAGMENT_FIELDS = tuple((c, "bigint") for c in ("fragmentsize", "fragmentsizeest", "islandcount"))

# ids longer than this are shortened on load, as their columns are 500 characters wide
LONG_ID, SHORT_ID = 499, 450


def result_lines(spark: SparkSession, path: str | Sequence[str], suffix: str) -> DataFrame:
    """Lines of result files named ``{uid}{suffix}``; large plain files are read in splits."""
    return _named(spark.read.text(path), suffix)


def result_bodies(spark: SparkSession, path: str | Sequence[str], suffix: str) -> DataFrame:
    """Whole bodies of one-record result files named ``{uid}{suffix}``."""
    return _named(spark.read.text(path, wholetext=True), suffix)


def _named(files: DataFrame, suffix: str) -> DataFrame:
    name = text.decoded(F.col("_metadata.file_name"))
    uid = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    return files.filter(F.endswith(name, F.lit(suffix))).select(uid.alias("uid"), "value")


def _words(value: Column) -> Column:
    """Text with one space between words and none at its ends.

    Lines normally have single tabs or spaces already, which byte-wise replacement handles; the
    regular expression runs only on the others.
    """
    spaced = F.trim(F.replace(value, F.lit("\t"), F.lit(" ")))
    unusual = F.contains(spaced, F.lit("  "))
    for blank in ("\r", "\n", "\x0b", "\x0c"):
        unusual = unusual | F.contains(value, F.lit(blank))
    return F.when(unusual, F.trim(F.regexp_replace(value, r"\s+", " "))).otherwise(spaced)


def _typed(
    lines: DataFrame, line: Column, fields: Sequence[tuple[str, str]], separator: str, null_word: str | None = None
) -> DataFrame:
    """Separated text as typed columns; ``reject`` holds the text of a line with a wrong field
    count or an unreadable number.

    The columns come out of one generator over one struct, so that a filter on ``reject`` stays
    above it and the line is parsed once.
    """
    schema = ", ".join(f"{name} {kind}" for name, kind in fields) + ", reject string"
    options = {
        "sep": separator, "quote": "", "nullValue": null_word or "\u0001",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "reject",
    }
    rows = lines.select("uid", line.alias("text")).select("uid", F.inline(F.array(F.from_csv("text", schema, options))))
    if null_word:
        return rows
    # an empty field is empty text, or null where a number belongs
    return rows.withColumns({name: F.coalesce(name, F.lit("")) for name, kind in fields if kind == "string"})


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter("reject is null").drop("reject")


def rejected(rows: DataFrame) -> DataFrame:
    """Lines that could not be loaded: uid and the line."""
    return rows.filter("reject is not null").select("uid", F.col("reject").alias("line"))


def _without(lines: DataFrame, *words: str) -> DataFrame:
    """Lines that are not blank and contain none of the words."""
    kept = F.col("value").rlike(r"\S")
    for word in words:
        kept = kept & ~F.contains("value", F.lit(word))
    return lines.filter(kept)


def isoforms(lines: DataFrame) -> DataFrame:
    """Isoform counts: comma-separated, 8 fields."""
    return _typed(_without(lines, "RefseqId", "GeneId"), F.col("value"), ISOFORM_FIELDS, ",")


def peaks(lines: DataFrame) -> DataFrame:
    """Annotated peaks: 15 fields between blanks, 'NULL' is null, long ids shortened."""
    rows = _typed(_without(lines, "gene_id", "pileup"), _words(F.col("value")), PEAK_FIELDS, " ", "NULL")
    short = lambda c: F.when(F.length(c) > LONG_ID, F.substring(c, 1, SHORT_ID)).otherwise(F.col(c))
    return rows.withColumns({c: short(c) for c in ("refseq_id", "gene_id")})


def profile(lines: DataFrame) -> DataFrame:
    """Average tag density: X and Y between blanks."""
    return _typed(_without(lines, "X", "Y"), _words(F.col("value")), PROFILE_FIELDS, " ")


def align_stat(bodies: DataFrame) -> DataFrame:
    """Alignment counts, one body per experiment: 5 numbers, or 4 where ribo equals suppressed."""
    tokens = F.split(_words(F.col("value")), " ")
    split = bodies.select("uid", tokens.alias("t"))
    five = F.when(F.size("t") == 4, F.array_insert("t", 3, F.get("t", F.lit(2)))).otherwise(F.col("t"))
    return _typed(split, F.array_join(five, " "), ALIGN_FIELDS, " ")


def fragment_stat(bodies: DataFrame) -> DataFrame:
    """Fragment statistics, one body per experiment: 3 numbers."""
    return _typed(bodies, _words(F.col("value")), FRAGMENT_FIELDS, " ")


# loader name -> reader, for the loaders whose files hold rows
READERS = {
    "upload_rpkm": isoforms,
    "upload_iaintersect_result": peaks,
    "upload_atdp": profile,
    "upload_get_stat": align_stat,
    "upload_macs2_fragment_stat": fragment_stat,
}
WHOLE_FILE = ("upload_get_stat", "upload_macs2_fragment_stat")


def load(spark: SparkSession, rule: str, path: str | Sequence[str]) -> DataFrame:
    """Rows of all files a loader reads below ``path``, with rejects marked."""
    suffix = RESULT_FILES[rule].removeprefix("{}")
    files = result_bodies if rule in WHOLE_FILE else result_lines
    return READERS[rule](files(spark, path, suffix))
