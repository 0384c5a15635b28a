"""Genome-browser tracks of all experiments and genomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtables import fixed
from seqtables.functions import text


def _track(suffix, shown, kind, visibility, priority, colour, alternative, can_pack, settings) -> Column:
    """One track as a struct of the 21 browser columns; null when it is not shown."""
    name, group = F.col("browser_uid"), F.col("egroup_id")
    null = F.lit(None).cast("string")
    numbers = dict(zip(("colorR", "colorG", "colorB", "altColorR", "altColorG", "altColorB"), colour + alternative))
    columns = {
        "tableName": F.concat(name, F.lit(suffix)),
        "shortLabel": F.col("name4browser"),
        "type": F.lit(kind),
        "longLabel": F.col("name4browser"),
        "visibility": F.lit(visibility),
        "priority": F.lit(priority),
        **{k: F.lit(v) for k, v in numbers.items()},
        "useScore": F.lit(0), "private": F.lit(0), "restrictCount": F.lit(0),
        "restrictList": null, "url": null, "html": null,
        "grp": group,
        "canPack": F.lit(can_pack),
        "settings": text.filled_lines(settings, {"b": name, "g": group}),
    }
    return F.when(F.col(shown), F.struct(*[c.alias(k) for k, c in columns.items()]))


def track_db(
    labdata: DataFrame, experimenttype: DataFrame, genome: DataFrame,
    views: Sequence[tuple[str, str]] = fixed.GENOME_VIEWS,
) -> DataFrame:
    """The browser tracks of every genome view, told apart by ``genome_db``.

    One scan of the experiments. The track kinds an experiment shows are folded to flags per
    (view, name, label, group) before the tracks are listed, so the listed rows need no
    de-duplication.
    """
    shown_in = F.filter(
        F.array(*[F.when(F.startswith("db", F.lit(prefix)), F.lit(view)) for view, prefix in views]),
        lambda v: v.isNotNull(),
    )
    genome_views = genome.select(F.col("id").alias("genome_id"), F.explode(shown_in).alias("genome_db"))
    etype = F.col("etype")
    kinds = experimenttype.select(
        F.col("id").alias("experimenttype_id"),
        etype.like("%RNA%").alias("rna"), etype.like("%DNA%").alias("dna"),
        etype.like("%dUTP%").alias("dutp"), etype.like("%RNA%dUTP%").alias("rna_dutp"),
    )
    visible = labdata.filter(
        (F.col("deleted") == 0) & F.col("libstatus").between(10, 99) & F.col("egroup_id").isNotNull()
    ).select("experimenttype_id", "genome_id", text.browser_name(F.col("uid")).alias("browser_uid"),
             "name4browser", "egroup_id")
    stranded = F.col("dutp") & ~F.col("genome_db").isin(*fixed.PLAIN_BEDGRAPH_VIEWS)
    flags = (
        visible.join(kinds, "experimenttype_id").join(genome_views, "genome_id")
        .groupBy("genome_db", "browser_uid", "name4browser", "egroup_id")
        .agg(
            F.bool_or(F.col("rna") & stranded).alias("rna_stranded"),
            F.bool_or(F.col("rna") & ~stranded).alias("rna_plain"),
            F.bool_or(F.col("rna") & ~F.col("dutp")).alias("rna_unstranded"),
            F.bool_or("rna_dutp").alias("rna_dutp"),
            F.bool_or("dna").alias("dna"),
        )
    )
    tracks = F.filter(F.array(*[_track(*t) for t in fixed.TRACKS]), lambda t: t.isNotNull())
    return flags.select("genome_db", F.inline(tracks))
