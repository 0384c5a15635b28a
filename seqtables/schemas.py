"""Stored schemas. Results are computed in doubles and narrowed to these types when written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_TRANSCRIPTS = (
    "uid string, refseq_id string, gene_id string, chrom string, tx_start int, tx_end int, strand string, "
    "tot_r_0 float, rpkm_0 float"
)

RESULT_TABLES = {
    "isoforms": _TRANSCRIPTS,
    "genes": _TRANSCRIPTS,
    "common_tss": _TRANSCRIPTS,
    "islands": (
        "uid string, refseq_id string, gene_id string, tx_start int, tx_end int, strand string, chrom string, "
        "start_pos bigint, end_pos bigint, length bigint, abssummit int, pileup float, log10p float, "
        "foldenrich float, log10q float, region string"
    ),
    "browser_islands": (
        "uid string, bin int, chrom string, chrom_start bigint, chrom_end bigint, name string, score int"
    ),
    "atdp": "uid string, x int, y float",
    "coverage": "uid string, strand string, genome_db string, table_name string, file_name string",
}

CATALOGUE_TABLES = {
    "experimenttype": "id int, etype string, workflow string, template string, upload_rules string",
    "genome": "id int, db string, findex string, annotation string, annottable string, genome string, gsize string",
    "antibody": "id int, properties int",
    "worker": "id int, email string",
    "plugintype": "id int, ptype string, workflow string, etype_id string",
    "settings": "k string, v string",
    "labdata": (
        "id bigint, uid string, name4browser string, experimenttype_id bigint, genome_id bigint, "
        "antibody_id bigint, worker_id bigint, libstatus int, libstatustxt string, deleted int, forcerun int, "
        "egroup_id string, url string, params string, trim5 int, trim3 int, fragmentsizeexp int, "
        "fragmentsizeforceuse int, rmdup int, control int, control_id string, tagstotal bigint, tagsmapped bigint, "
        "tagsribo bigint, tagssuppressed bigint, tagsused bigint, fragmentsize bigint, fragmentsizeest bigint, "
        "islandcount bigint, size double, dateanalyzes timestamp_ntz, dateanalyzed timestamp_ntz, "
        "dateanalyzee timestamp_ntz, datedel date"
    ),
}


def stored(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the column order and types of a result table."""
    schema = StructType.fromDDL(RESULT_TABLES[table])
    narrowed = []
    for field in schema.fields:
        column = F.col(field.name)
        if field.dataType.typeName() == "string" and rows.schema[field.name].dataType.typeName() == "double":
            column = column.cast("float")  # numbers become text with the digits of the stored type
        narrowed.append(column.cast(field.dataType).alias(field.name))
    return rows.select(*narrowed)
