"""Domain tables derived from the driver's parquet tables.

Each entry is plain SQL that runs unchanged in Spark and in DuckDB. The catalogue tables follow
FIXTURES.md section 4; names ending in ``_full`` add the nullable columns the experiment
dimension reads.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from seqtables import fixed

BASE_TABLES = ("nation", "orders", "lineitem", "events", "documents", "part")

_TYPES = ", ".join(f"({i}, '{etype}', '{workflow}')" for i, (etype, workflow, _) in enumerate(fixed.EXPERIMENT_TYPES, 1))


def _names(rules: tuple[str, ...]) -> str:
    return json.dumps(rules, separators=(",", ":"))


ADAPTERS: dict[str, str] = {
    "experimenttype": f"select * from (values {_TYPES}) t(id, etype, workflow)",
    "upload_rules": f"""
select id as experimenttype_id, etype,
  case when etype like '%DNA%' then '{_names(fixed.RULES_DNA)}'
       when etype like '%dUTP%' then '{_names(fixed.RULES_RNA_STRANDED)}'
       else '{_names(fixed.RULES_RNA)}' end as upload_rules
from experimenttype""",
    "genome": """
select * from (values (1,'hg19','hg19'),(2,'mm10','mm10'),(3,'dm3','dm3'),(4,'rn5','rn5'),
 (5,'rheMac8','rheMac8_spike'),(6,'xenLae9','xenLae9'),(7,'xenTro3','xenTro3'),
 (8,'xenTro7_1','xenTro7_1'),(9,'xenTro9','xenTro9')) t(id, db, findex)""",
    "genome_full": """
select id, db, findex, findex as genome, concat(db, '_refgene') as annotation,
  concat('ann_', db) as annottable,
  case db when 'hg19' then 'hs' when 'mm10' then 'mm' when 'dm3' then 'dm' else '1.5e9' end as gsize
from genome""",
    "antibody": """
select * from (values (1,0),(2,1),(3,2),(4,2),(5,0),(6,1)) t(id, properties)""",
    "worker": """
select n_nationkey as id, concat(lower(n_name), '@example.org') as email from nation""",
    "plugintype": """
select * from (values (1,'deseq','deseq.advanced.cwl','[1,2,3]'),(2,'heat','heat.cwl','[7,8]'),
 (3,'pca','pca.cwl','[1,7,14]')) t(id, ptype, workflow, etype_id)""",
    "settings": """
select * from (values ('wardrobe','/wardrobe'),('preliminary','/raw_data'),('upload','/upload'),
 ('indices','/indices'),('maxthreads','4'),('experimentsdb','experiments')) t(k, v)""",
    "labdata": """
select o_orderkey as id, concat('exp-', cast(o_orderkey as string)) as uid,
  concat('Sample ', cast(o_orderkey as string)) as name4browser,
  o_orderkey % 14 + 1 as experimenttype_id, o_orderkey % 9 + 1 as genome_id,
  case when o_orderkey % 5 = 0 then null else o_custkey % 7 + 1 end as antibody_id,
  case when o_orderkey % 11 = 0 then null else o_custkey % 25 end as worker_id,
  case o_custkey % 8 when 0 then 0 when 1 then 1 when 2 then 10 when 3 then 11 when 4 then 12
    when 5 then 1000 when 6 then 2000 else 2010 end as libstatus,
  case o_custkey % 10 when 0 then 1 when 1 then 2 else 0 end as deleted,
  case when o_custkey % 3 = 0 then 1 else 0 end as forcerun,
  case when o_orderkey % 6 = 0 then null else concat('grp', cast(o_custkey % 4 as string)) end as egroup_id,
  case o_orderkey % 6 when 0 then 'SRR123 GSM45' when 1 then 'https://h.example/x.fastq.gz'
    when 2 then concat(cast(o_orderkey - 2 as string), ' ', cast(o_orderkey + 12 as string), ' ', cast(o_orderkey + 28 as string))
    when 3 then concat('lane', cast(o_custkey % 50 as string), '_sample') when 4 then '' else null end as url,
  case o_orderkey % 3 when 0 then null when 1 then '{}' else '{"promoter":500}' end as params,
  case when o_orderkey % 4 = 0 then null else cast(o_custkey % 2 as int) end as rmdup,
  o_orderdate as dateanalyzed
from orders""",
    "labdata_full": """
select l.*,
  cast(case when id % 4 = 1 then null else id % 3 end as int) as trim5,
  cast(case when id % 5 = 1 then null else id % 4 end as int) as trim3,
  cast(case when id % 3 = 1 then null else 150 + id % 50 end as int) as fragmentsizeexp,
  cast(case when id % 7 = 1 then null else id % 2 end as int) as fragmentsizeforceuse,
  cast(case when id % 9 = 1 then null else id % 2 end as int) as control,
  case when id % 8 = 0 then null when id % 8 < 5 then '' else concat('exp-', cast(id - 5 as string)) end as control_id,
  case when id % 2 = 0 then 'loaded' else null end as libstatustxt,
  cast(case when id % 3 = 0 then null else id + 1000 end as bigint) as tagstotal,
  cast(case when id % 3 = 0 then null else id + 900 end as bigint) as tagsmapped,
  cast(case when id % 3 = 0 then null else 9 end as bigint) as tagsribo,
  cast(case when id % 3 = 0 then null else 8 end as bigint) as tagssuppressed,
  cast(case when id % 3 = 0 then null else id + 800 end as bigint) as tagsused,
  cast(case when id % 2 = 0 then null else 180 end as bigint) as fragmentsize,
  cast(case when id % 2 = 0 then null else 175 end as bigint) as fragmentsizeest,
  cast(case when id % 2 = 0 then null else 40 end as bigint) as islandcount,
  cast(case when id % 4 = 0 then null else 12.5 end as double) as size
from labdata l""",
    "isoforms": """
select concat('exp-', cast(l_orderkey % 2 as string)) as uid,
  concat('NM_', cast(l_suppkey as string)) as refseq_id,
  concat('G', cast(l_partkey - l_partkey % 4 as string)) as gene_id,
  concat('chr', cast(l_linenumber % 2 + 1 as string)) as chrom,
  cast(l_partkey * 100 as int) as tx_start, cast(l_partkey * 100 + 1000 + (l_suppkey % 5) * 10 as int) as tx_end,
  case l_returnflag when 'A' then '+' when 'R' then '-' else '.' end as strand,
  l_quantity as tot_r_0, l_extendedprice as rpkm_0
from lineitem""",
    "islands": """
select concat('exp-', cast(l_orderkey % 2 as string)) as uid, concat('chr', cast(l_linenumber as string)) as chrom,
  cast(l_partkey * 1000 as int) as start_pos, cast(l_partkey * 1000 + 500 as int) as end_pos,
  l_quantity as pileup, l_discount * 1000 as log10p, l_tax * 1000 / 7 as log10q,
  case when l_linenumber = 1 then 'promoter' when l_linenumber < 4 then 'exon' else 'intron' end as region
from lineitem""",
    "peaks": """
select concat('exp-', cast(l_orderkey % 2 as string)) as uid,
  case when l_suppkey % 9 = 0 then null when l_suppkey % 17 = 0 then repeat(concat('NM_', cast(l_suppkey as string), ','), 120)
    else concat('NM_', cast(l_suppkey as string)) end as refseq_id,
  case when l_suppkey % 9 = 0 then null else concat('G', cast(l_partkey as string)) end as gene_id,
  case when l_suppkey % 9 = 0 then null else cast(l_partkey * 100 as int) end as tx_start,
  case when l_suppkey % 9 = 0 then null else cast(l_partkey * 100 + 1000 as int) end as tx_end,
  case when l_suppkey % 9 = 0 then null when l_returnflag = 'A' then '+' else '-' end as strand,
  concat('chr', cast(l_linenumber as string)) as chrom,
  cast(l_partkey * 1000 as bigint) as start_pos, cast(l_partkey * 1000 + 500 as bigint) as end_pos,
  cast(500 as bigint) as length, cast(l_partkey * 1000 + 250 as int) as abssummit,
  l_quantity as pileup, l_discount * 1000 as log10p, l_extendedprice as foldenrich, l_tax * 1000 as log10q,
  case when l_linenumber = 1 then 'promoter' when l_linenumber < 4 then 'exon' else 'intron' end as region
from lineitem""",
    "atdp": """
select concat('exp-', cast(user_id as string)) as uid, cast(event_id % 201 - 100 as int) as x, value as y from events""",
    "stat_tokens": """
select o_orderkey as id, concat('exp-', cast(o_orderkey as string)) as uid,
  case when o_orderkey % 14 between 6 and 9 then concat(cast(o_custkey + 100 as string), ' ', cast(o_custkey + 50 as string), ' 7 ', cast(o_custkey as string))
       else concat(cast(o_custkey + 100 as string), ' ', cast(o_custkey + 50 as string), ' 3 7 ', cast(o_custkey as string)) end as body
from orders""",
    "fragment_tokens": """
select concat('exp-', cast(o_orderkey as string)) as uid,
  concat(cast(o_custkey % 300 as string), ' ', cast(o_custkey % 200 + 50 as string), ' ', cast(o_orderkey as string)) as body
from orders""",
    "fastq_records": """
select doc_id, concat('exp-', cast(cast((doc_id - doc_id % 4) / 4 as bigint) as string)) as uid,
  cast(doc_id % 2 + 1 as int) as mate, cast((doc_id % 4 - doc_id % 2) / 2 as bigint) as record_no,
  concat(case when doc_id % 10 = 0 then '>' else '@' end, 'r', cast(doc_id as string)) as l1,
  replace(text, chr(10), ' ') as l2, '+' as l3, repeat('I', length(text)) as l4
from documents""",
    "status_events": """
select concat('exp-', cast(user_id as string)) as uid, ts, event_id,
  case event_type when 'signup' then 0 when 'view' then 10 when 'click' then 11 when 'purchase' then 12 else 2010 end as libstatus
from events""",
    "last_events": """
select uid, event_id from (
  select uid, event_id, row_number() over (partition by uid order by ts desc, event_id desc) as n from status_events) t
where n = 1""",
    "launch_log": """
select l.uid, 'download' as job, concat('download:', cast(case when l.id % 3 = 0 then coalesce(e.event_id, 0) else -1 end as string)) as cause,
  cast(2 as int) as attempt
from labdata l left join last_events e on e.uid = l.uid where l.id % 3 < 2
union all
select l.uid, replace(t.workflow, '.cwl', '') as job, case when l.id % 2 = 0 then 'analysis:-7' else 'reprocess:-7' end as cause, cast(3 as int) as attempt
from labdata l join experimenttype t on t.id = l.experimenttype_id where l.id % 5 = 1""",
    "lifecycle_log": """
select concat('exp-', cast(user_id as string)) as uid, ts, event_id,
  case event_type when 'signup' then 'queued' when 'view' then 'downloaded' when 'click' then 'started'
    when 'purchase' then 'completed' else 'failed' end as event,
  case when event_type = 'error' then concat('can''t read ', cast(event_id as string)) else null end as message
from events""",
    "file_listing": """
select concat('exp-', cast(doc_id % 50 as string)) as uid,
  concat('/wardrobe/raw/exp-', cast(doc_id % 50 as string), '/', source, '_', cast(doc_id as string), '.bin') as path,
  cast(n_chars as bigint) as length
from documents
union all
select concat('exp-', cast(doc_id % 50 as string)),
  concat('/wardrobe/raw/exp-', cast(doc_id % 50 as string), '/', source, '_', cast(doc_id as string), '.bin'),
  cast(n_chars as bigint)
from documents where doc_id % 10 = 3""",
    "local_paths": """
select concat('/wardrobe/upload/lane', cast(n_nationkey as string), '_sample_R1.fastq.gz') as path from nation
union all
select concat('/wardrobe/upload/lane', cast(n_nationkey as string), '_sample_R2.fastq.gz') as path from nation
where n_nationkey % 2 = 0
union all
select concat('/wardrobe/upload/lane', cast(n_nationkey as string), '_sample_R3.fastq.gz') as path from nation
where n_nationkey % 4 = 0""",
    "fastq_files": """
select concat('exp-', cast(o_orderkey as string)) as uid, 1 as mate from orders where o_orderkey % 3 <> 0
union all
select concat('exp-', cast(o_orderkey as string)) as uid, 2 as mate from orders where o_orderkey % 4 <> 0""",
    "current_types": """
select p_partkey + 1000 as id, concat('Custom ', p_name, ' ', cast(p_partkey as string)) as etype,
  concat(lower(p_brand), '.cwl') as workflow, p_type as template, '[]' as upload_rules
from part
union all
select id, etype, '' as workflow, '' as template, '' as upload_rules
from experimenttype where etype not like '%Trim Galore%' and etype not like '%Mitochondrial%'""",
    "read_file_paths": """
select concat('/wardrobe/raw_data/', uid, '/', uid, case when mate = 2 then '_2' else '' end, '.fastq.bz2') as path,
  cast(mate - 1 as bigint) as length
from fastq_files
union all
select concat('/wardrobe/raw_data/', uid, '/kept/', uid, '.fastq.bz2') as path, cast(9 as bigint) as length
from fastq_files where mate = 2""",
    "fetched": """
select uid, cast(1 as int) as mate, case id % 7 when 0 then 'HTML' when 1 then 'bzip2' when 2 then 'ASCII' else 'gzip' end as file_type
from labdata where id % 12 <> 5
union all
select uid, cast(2 as int) as mate, case id % 5 when 0 then 'PDF' when 1 then 'Zip' else 'gzip' end as file_type
from labdata where id % 10 <> 1""",
    "finished": """
select id, uid, experimenttype_id, case when id % 37 = 8 then null else genome_id end as genome_id
from labdata where libstatus = 11""",
    "result_files": """
select concat('/wardrobe/raw_data/', uid, '/', uid, '_fragment_stat.tsv') as path, cast(30 as bigint) as length
from labdata where id % 17 <> 3
union all
select concat('/wardrobe/raw_data/', uid, '/', uid, '_macs_peaks_iaintersect.tsv'), cast(9000 as bigint)
from labdata where id % 19 <> 4
union all
select concat('/wardrobe/raw_data/', uid, '/', uid, '.stat'), cast(25 as bigint) from labdata where id % 23 <> 5
union all
select concat('/wardrobe/raw_data/', uid, '/', uid, '_atdp.tsv'), cast(4000 as bigint) from labdata where id % 29 <> 6
union all
select concat('/wardrobe/raw_data/', uid, '/', uid, '.isoforms.csv'), cast(70000 as bigint) from labdata where id % 31 <> 7
union all
select concat('/wardrobe/raw_data/', uid, '/', uid, '.bigWig'), cast(0 as bigint) from labdata""",
    "stat_bodies": """
select uid, case when id % 13 = 2 then concat(body, ' x') else body end as body from stat_tokens""",
    "fragment_bodies": """
select concat('exp-', cast(o_orderkey as string)) as uid,
  concat(cast(o_custkey % 300 as string), ' 50 ', cast(o_orderkey as string), case when o_orderkey % 11 = 3 then ' 9' else '' end) as body
from orders""",
    "atdp_lines": """
select concat('exp-', cast(user_id as string)) as uid,
  concat(cast(event_id % 201 - 100 as string), ' ', case when event_id % 50 = 7 then 'bad' else '1.5' end) as value
from events""",
    "store_files": """
select path, length from result_files
union all
select path, length from read_file_paths
union all
select concat('/wardrobe/raw_data/', uid, '/tophat/run', cast(id % 3 as string), '/a.fastq.gz'), cast(5 as bigint)
from labdata where id % 4 = 1
union all
select concat('/wardrobe/raw_data/', uid, '/', uid, '.fastq'), cast(7 as bigint) from labdata where id % 3 = 1
union all
select concat('/wardrobe/raw_data/', uid, '/sub/', uid, '_x.fastq'), cast(7 as bigint) from labdata where id % 5 = 2
union all
select concat('/wardrobe/raw_data/other/', uid, '.bin'), cast(7 as bigint) from labdata where id % 9 = 2""",
    "job_results": """
select uid, concat('{"total":', cast(id as string), ',"log":{"class":"File","location":"/out/', uid, '.log"}}') as result
from labdata""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _chain(names: tuple[str, ...]) -> list[str]:
    """The named adapters and all they read, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        words = _WORD.findall(re.sub(r"'[^']*'", "", ADAPTERS[name]))
        for dep in dict.fromkeys(words):
            if dep in ADAPTERS and dep != name:
                visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_clause(*names: str) -> str:
    """``with a as (...), b as (...)`` for an oracle that reads the named adapters."""
    return "with " + ",\n".join(f"{n} as ({ADAPTERS[n]})" for n in _chain(names)) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str, stream: str | None = None) -> DataFrame:
    """One domain table as a DataFrame over the parquet files in ``sf_dir``.

    ``stream`` names a base table to read as a stream.
    """
    chain = _chain((name,))
    words = set(_WORD.findall(" ".join(ADAPTERS[n] for n in chain)))
    base = []
    for t in BASE_TABLES:
        if t not in words:
            continue
        path, source = f"{sf_dir}/{t}.parquet", f"parquet.`{sf_dir}/{t}.parquet`"
        if t == stream:
            source = f"{t}_stream"
            schema = spark.read.parquet(path).schema
            # a glob, as a streaming source takes a single file only through one
            spark.readStream.schema(schema).parquet(f"{sf_dir}/{t}[.]parquet").createOrReplaceTempView(source)
        base.append(f"{t} as (select * from {source})")
    ctes = base + [f"{n} as ({ADAPTERS[n]})" for n in chain]
    return spark.sql("with " + ",\n".join(ctes) + f"\nselect * from {name}")
