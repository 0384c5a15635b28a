"""The same queries as plain SQL over the driver's tables, for checking results.

The SQL states each result directly (unions, CASE chains, brute-force joins) rather than the way
the Spark code computes it.
"""

from __future__ import annotations

from seqtables import fixed
from seqtables.plans.registry import CLOCK
from seqtables.sources.adapters import with_clause

ORACLES: dict[str, str] = {}


def _add(name: str, tables: str, body: str, extra: str = "") -> None:
    ORACLES[name] = with_clause(*tables.split()) + (", " + extra if extra else "") + body


# --- readers -------------------------------------------------------------------------------

_add("read_isoforms", "isoforms", "select * from isoforms")
_add("read_peaks", "peaks", """
select uid, case when length(refseq_id) > 499 then substr(refseq_id, 1, 450) else refseq_id end as refseq_id,
  case when length(gene_id) > 499 then substr(gene_id, 1, 450) else gene_id end as gene_id,
  tx_start, tx_end, strand, chrom, start_pos, end_pos, length, abssummit, pileup, log10p, foldenrich, log10q, region
from peaks""")
_add("read_atdp", "atdp", "select uid, x, y from atdp")
_STAT = """stat as (
select uid, string_split(body, ' ') as t from stat_tokens), counts as (
select uid, cast(t[1] as bigint) as tagstotal, cast(t[2] as bigint) as tagsmapped, cast(t[3] as bigint) as tagsribo,
  cast(case when len(t) = 4 then t[3] else t[4] end as bigint) as tagssuppressed,
  cast(t[len(t)] as bigint) as tagsused from stat)
"""
_add("read_align_stat", "stat_tokens", "select * from counts", _STAT)
_FRAGMENT = """frag as (
select uid, cast(split_part(body, ' ', 1) as bigint) as fragmentsize,
  cast(split_part(body, ' ', 2) as bigint) as fragmentsizeest,
  cast(split_part(body, ' ', 3) as bigint) as islandcount from fragment_tokens)
"""
_add("read_fragment_stat", "fragment_tokens", "select * from frag", _FRAGMENT)

# --- rollups -------------------------------------------------------------------------------

_add("genes", "isoforms", """
select uid, gene_id, string_agg(distinct refseq_id, ',' order by refseq_id) as refseq_id, max(chrom) as chrom,
  max(tx_start) as tx_start, max(tx_end) as tx_end, max(strand) as strand,
  round(coalesce(sum(tot_r_0), 0), 2) as tot_r_0, round(coalesce(sum(rpkm_0), 0), 2) as rpkm_0
from isoforms group by uid, gene_id""")
_add("common_tss", "isoforms", """
select uid, chrom, strand, string_agg(distinct refseq_id, ',' order by refseq_id) as refseq_id,
  string_agg(distinct gene_id, ',' order by gene_id) as gene_id, tx_start, max(tx_end) as tx_end,
  round(coalesce(sum(tot_r_0), 0), 2) as tot_r_0, round(coalesce(sum(rpkm_0), 0), 2) as rpkm_0
from isoforms where strand = '+' group by uid, chrom, tx_start, strand
union
select uid, chrom, strand, string_agg(distinct refseq_id, ',' order by refseq_id) as refseq_id,
  string_agg(distinct gene_id, ',' order by gene_id) as gene_id, min(tx_start) as tx_start, tx_end,
  round(coalesce(sum(tot_r_0), 0), 2) as tot_r_0, round(coalesce(sum(rpkm_0), 0), 2) as rpkm_0
from isoforms where strand = '-' group by uid, chrom, tx_end, strand""")
_add("peaks_bed", "islands", """
select uid, 0 as bin, chrom, cast(start_pos as bigint) as chrom_start, cast(end_pos as bigint) as chrom_end,
  round(max(log10p), 2) as name, cast(round_even(max(log10q), 0) as int) as score
from islands group by uid, chrom, start_pos, end_pos""")

# --- experiments ---------------------------------------------------------------------------

_DIM_TABLES = "labdata_full experimenttype genome_full antibody worker"
_DIM = """dim as (
select l.id, l.uid, e.etype, e.workflow, g.db, g.findex, g.genome, g.annotation, g.annottable,
  g.gsize as genome_size, l.url, l.deleted, l.libstatus,
  case when coalesce(l.params, '') = '' then '{}' else l.params end as params,
  coalesce(l.trim5, 0) as clip_5p_end, coalesce(l.trim3, 0) as clip_3p_end,
  coalesce(l.fragmentsizeexp, 0) as exp_fragment_size, coalesce(l.control, 0) as control,
  coalesce(l.control_id, '') as control_id, coalesce(w.email, '') as email,
  e.etype like '%pair%' as pair, e.etype like '%dUTP%' as dutp, l.forcerun = 1 as forcerun,
  g.genome like '%spike%' as spike, coalesce(l.fragmentsizeforceuse, 0) = 1 as force_fragment_size,
  coalesce(a.properties, 0) = 2 as broad_peak, coalesce(l.rmdup, 0) = 1 as remove_duplicates
from labdata_full l join experimenttype e on e.id = l.experimenttype_id join genome_full g on g.id = l.genome_id
left join antibody a on a.id = l.antibody_id left join worker w on w.id = l.worker_id)
"""
_add("experiment_dim", _DIM_TABLES, "select * from dim", _DIM)
_PATHS = _DIM + """, paths as (
select *, '/wardrobe/raw_data' as raw_data, '/wardrobe/upload' as upload, '/wardrobe/indices' as indices,
  '4' as threads, 'experiments' as experimentsdb,
  '/wardrobe/raw_data/' || uid || '/' || uid || '.fastq.bz2' as fastq_file_upstream,
  '/wardrobe/raw_data/' || uid || '/' || uid || '_2.fastq.bz2' as fastq_file_downstream,
  '/wardrobe/indices/STAR/' || findex as star_indices_folder,
  '/wardrobe/indices/bowtie/' || findex as bowtie_indices_folder,
  '/wardrobe/indices/bowtie/' || findex || '_ribo' as bowtie_indices_folder_ribo,
  '/wardrobe/indices/bowtie/' || findex || '/chrNameLength.txt' as chrom_length,
  '/wardrobe/indices/annotations/' || findex || '/refgene.tsv' as annotation_input_file,
  case when spike then 'control' else '' end as exclude_chr,
  '/wardrobe/raw_data/' || uid as output_folder,
  case when control_id <> '' then '/wardrobe/raw_data/' || control_id || '/' || control_id || '.bam' end as control_file
from dim)
"""
_add("experiment_paths", _DIM_TABLES, """
select uid, raw_data, upload, indices, threads, experimentsdb, fastq_file_upstream, fastq_file_downstream,
  star_indices_folder, bowtie_indices_folder, bowtie_indices_folder_ribo, chrom_length, annotation_input_file,
  exclude_chr, output_folder, control_file from paths""", _PATHS)
_add("experiment_genome", "labdata genome", """
select l.uid, g.db, g.db is not null as found from labdata l left join genome g on g.id = l.genome_id""")


def _file(key: str, kind: str, path: str) -> str:
    return f"""'"{key}":{{"class":"File","format":"{fixed.EDAM_FORMAT}{kind}","location":"' || {path} || '"}}'"""


def _dir(key: str, path: str) -> str:
    return f"""'"{key}":{{"class":"Directory","location":"' || {path} || '"}}'"""


def _num(key: str, column: str) -> str:
    return f"""'"{key}":' || {column}"""


def _str(key: str, column: str) -> str:
    return f"""'"{key}":"' || {column} || '"'"""


_FASTQ = ("case when pair then " + _file("fastq_file_downstream", "1930", "fastq_file_downstream") + " || ',' || "
          + _file("fastq_file_upstream", "1930", "fastq_file_upstream")
          + " else " + _file("fastq_file", "1930", "fastq_file_upstream") + " end")
_JOB_RNA = " || ',' || ".join([
    _file("annotation_file", "3475", "annotation_input_file"),
    _dir("bowtie_indices_folder", "bowtie_indices_folder_ribo"),
    _file("chrom_length_file", "2330", "chrom_length"),
    _num("clip_3p_end", "clip_3p_end"), _num("clip_5p_end", "clip_5p_end"), _str("exclude_chr", "exclude_chr"),
    _FASTQ, _str("output_folder", "output_folder"), _dir("star_indices_folder", "star_indices_folder"),
]) + (" || case when etype like '%Mitochondrial%' then ',' || "
      + _dir("star_indices_folder_mitochondrial", "star_indices_folder || '-mitochondrial'")
      + " else '' end || ',' || " + _num("threads", "threads") + " || ',' || " + _str("uid", "uid"))
_JOB_DNA = " || ',' || ".join([
    _file("annotation_file", "3475", "annotation_input_file"), _num("broad_peak", "broad_peak"),
    _file("chrom_length", "2330", "chrom_length"),
    _num("clip_3p_end", "clip_3p_end"), _num("clip_5p_end", "clip_5p_end"),
]) + (" || case when control_file is null then '' else ',' || " + _file("control_file", "2572", "control_file")
      + " end || ',' || ") + " || ',' || ".join([
    _num("exp_fragment_size", "exp_fragment_size"), _FASTQ, _num("force_fragment_size", "force_fragment_size"),
    _str("genome_size", "genome_size"), _dir("indices_folder", "bowtie_indices_folder"),
    _str("output_folder", "output_folder"), _num("remove_duplicates", "remove_duplicates"),
    _num("threads", "threads"), _str("uid", "uid"),
])
_add("job_inputs", _DIM_TABLES, f"""
select uid, etype, workflow, case when etype like '%DNA%' then '{{' || {_JOB_DNA} || '}}'
  else '{{' || {_JOB_RNA} || '}}' end as job from paths""", _PATHS)
_PARAMS = """new_params as (
select l.uid, substr(r.result, 1, length(r.result) - 1) || ',"promoter":' || case when l.params like '%promoter%' then '500' else '1000' end || '}' as params
from labdata l join job_results r on r.uid = l.uid)
"""
_add("result_params", "labdata job_results", "select * from new_params", _PARAMS)

# --- browser tracks ------------------------------------------------------------------------

_CONSTANTS = """0 as "useScore", 0 as "private", 0 as "restrictCount", cast(null as varchar) as "restrictList",
  cast(null as varchar) as url, cast(null as varchar) as html"""
_BLUE, _GREEN, _NAVY = "30,70,150", "30,150,70", "0,30,100"


def _branch(view, prefix, suffix, when, kind, visibility, priority, colour, alternative, can_pack, settings) -> str:
    rgb = dict(zip(("colorR", "colorG", "colorB", "altColorR", "altColorG", "altColorB"),
                   (colour + "," + alternative).split(",")))
    colours = ", ".join(f'{v} as "{k}"' for k, v in rgb.items())
    name = "replace(s.uid, '-', '_') || '" + suffix + "'"
    lines = " || chr(10) || ".join(settings)
    return f"""
select '{view}' as genome_db, {name} as "tableName", s.name4browser as "shortLabel", {kind} as "type",
  s.name4browser as "longLabel", {visibility} as visibility, {priority} as priority, {colours}, {_CONSTANTS},
  s.egroup_id as grp, {can_pack} as "canPack", {lines} as settings
from shown s where starts_with(s.db, '{prefix}') and ({when})"""


_SHOWN = """shown as (
select l.uid, l.name4browser, l.egroup_id, t.etype, g.db
from (select * from labdata where egroup_id is not null and deleted = 0 and libstatus >= 10 and libstatus < 100) l
inner join genome g on g.id = l.genome_id inner join experimenttype t on t.id = l.experimenttype_id),
"""


def _view(view: str, prefix: str) -> list[str]:
    ref = lambda word, suffix: f"'{word} ' || replace(s.uid, '-', '_') || '{suffix}'"
    group = "'group ' || s.egroup_id"
    stranded = "'bedGraph 4'" if view == "rn5" else \
        "case when s.etype like '%dUTP%' then 'PbedGraph 4' else 'bedGraph 4' end"
    auto, top, hide = "'autoScale on'", "'windowingFunction maximum'", "'visibility hide'"
    full, dense = "'visibility full'", "'visibility dense'"
    rna, dna, both = "s.etype like '%RNA%'", "s.etype like '%DNA%'", "s.etype like '%RNA%dUTP%'"
    big, bed, graph = "'bigWig'", "'bed 4 +'", "'bedGraph 4'"
    rows = [
        ("_wtrack", rna, stranded, 0, 10, _BLUE, _BLUE, 0, [auto, top]),
        ("_f_wtrack", rna + " and s.etype not like '%dUTP%'", big, 0, 2, _BLUE, _BLUE, 0,
         [ref("track", "_f_wtrack"), auto, hide, top]),
        ("_multi_f_wtrack", both, big, 0, 2, _BLUE, _BLUE, 0,
         [ref("track", "_multi_f_wtrack"), group, "'container multiWig'", auto, hide, top]),
        ("_upstream_f_wtrack", both, big, 0, 2, _BLUE, _GREEN, 0,
         [ref("track", "_upstream_f_wtrack"), ref("parent", "_multi_f_wtrack")]),
        ("_downstream_f_wtrack", both, big, 0, 2, _BLUE, _GREEN, 0,
         [ref("track", "_downstream_f_wtrack"), ref("parent", "_multi_f_wtrack")]),
        ("_grp", dna, bed, 0, 10, _BLUE, _BLUE, 0,
         ["'compositeTrack on'", hide, "'subGroup1 view Views GCVRG=GenomeCoverage ILNDS=Islands'", group,
          ref("track", "_grp")]),
        ("_gcvrg", dna, graph, 2, 1, _BLUE, _BLUE, 0,
         [ref("parent", "_grp"), ref("track", "_gcvrg"), "'view GCVRG'", full]),
        ("_ilnds", dna, bed, 1, 1, _BLUE, _BLUE, 0,
         [ref("parent", "_grp"), ref("track", "_ilnds"), "'view ILNDS'", dense]),
        ("_wtrack", dna, graph, 2, 1, _BLUE, _BLUE, 0,
         [ref("parent", "_gcvrg"), ref("track", "_wtrack"), "'subGroups view=GCVRG'", auto, full, top]),
        ("_islands", dna, bed, 1, 3, _NAVY, _BLUE, 1,
         [ref("parent", "_ilnds"), ref("track", "_islands"), "'subGroups view=ILNDS'", dense]),
        ("_f_wtrack", dna, big, 2, 2, _BLUE, _BLUE, 0,
         [ref("parent", "_gcvrg"), ref("track", "_f_wtrack"), "'subGroups view=GCVRG'", auto, full, top]),
    ]
    return [_branch(view, prefix, *r) for r in rows]


def _tracks(views) -> str:
    return "\nunion\n".join(b for view, prefix in views for b in _view(view, prefix))


_VIEWS = [("hg19", "hg"), ("mm10", "mm"), ("dm3", "dm"), ("rn5", "rn"), ("rheMac8", "rheMac8"),
          ("xenLae9", "xenLae9"), ("xenTro3", "xenTro"), ("xenTro7_1", "xenTro7"), ("xenTro9", "xenTro9")]
_add("track_db", "labdata experimenttype genome",
     "select * exclude (genome_db) from tracks", _SHOWN + f"tracks as ({_tracks(_VIEWS[:1])})")
_add("track_db_all_genomes", "labdata experimenttype genome",
     "select * from tracks", _SHOWN + f"tracks as ({_tracks(_VIEWS)})")

# --- manifests -----------------------------------------------------------------------------

_RULES = """listed as (
select l.uid, g.db, generate_subscripts(from_json(r.upload_rules, '["varchar"]'), 1) - 1 as position,
  unnest(from_json(r.upload_rules, '["varchar"]')) as rule
from labdata l join upload_rules r on r.experimenttype_id = l.experimenttype_id join genome g on g.id = l.genome_id),
manifest as (
select uid, db, cast(position as int) as position, rule, '/wardrobe/raw_data/' || uid || '/' || case rule
    when 'upload_macs2_fragment_stat' then uid || '_fragment_stat.tsv'
    when 'upload_iaintersect_result' then uid || '_macs_peaks_iaintersect.tsv'
    when 'upload_get_stat' then uid || '.stat' when 'upload_atdp' then uid || '_atdp.tsv'
    when 'upload_bigwig' then uid || '.bigWig' when 'upload_bigwig_upstream' then uid || '_upstream.bigWig'
    when 'upload_bigwig_downstream' then uid || '_downstream.bigWig'
    when 'upload_rpkm' then uid || '.isoforms.csv' when 'upload_folder_size' then 'upload_folder_size'
    when 'delete_files' then uid || '*.fastq' end as path
from listed)
"""
_add("output_manifest", "labdata upload_rules genome", "select uid, position, rule, path from manifest", _RULES)
_add("track_registry", "labdata upload_rules genome", """
select uid, case rule when 'upload_bigwig_upstream' then '+' when 'upload_bigwig_downstream' then '-' end as strand,
  db as genome_db, replace(uid, '-', '_') || case rule when 'upload_bigwig' then '_f_wtrack'
    when 'upload_bigwig_upstream' then '_upstream_f_wtrack' else '_downstream_f_wtrack' end as table_name,
  path as file_name
from manifest where rule like 'upload_bigwig%'""", _RULES)
_PRESENT = """present as (
select l.uid, case when l.deleted = 1 then 'delete' else 'reprocess' end as action, e.etype like '%pair%' as pair, e.workflow,
  exists (select 1 from fastq_files f where f.uid = l.uid and f.mate = 1)
  and (e.etype not like '%pair%' or exists (select 1 from fastq_files f where f.uid = l.uid and f.mate = 2)) as present
from labdata l join experimenttype e on e.id = l.experimenttype_id
where (l.forcerun = 1 and l.libstatus > 11 and l.deleted = 0) or l.deleted = 1),
ready as (select * from present where action = 'delete' or present)
"""
_add("files_present", "labdata experimenttype fastq_files", "select * from present", _PRESENT)
_add("cleanup_manifest", "labdata experimenttype fastq_files genome", """
select r.uid, d.db, replace(r.uid, '-', '_') || s.suffix as name, s.kind
from ready r, (select distinct db from genome) d,
  (values ('_wtrack','table'),('_islands','table'),('_f_wtrack','table'),('_upstream_f_wtrack','table'),
    ('_downstream_f_wtrack','table'),('_islands','view')) s(suffix, kind)
union all
select r.uid, 'experiments' as db, r.uid || s.suffix as name, s.kind
from ready r, (values ('_islands','table'),('_atdp','table'),('_atdph','table'),('_isoforms','table'),
  ('_genes','table'),('_common_tss','table'),('_genes','view'),('_common_tss','view')) s(suffix, kind)""", _PRESENT)

# --- uploads -------------------------------------------------------------------------------

_UPLOADS = """steps as (
select f.uid, f.genome_id, generate_subscripts(from_json(r.upload_rules, '["varchar"]'), 1) - 1 as position,
  unnest(from_json(r.upload_rules, '["varchar"]')) as rule
from finished f join upload_rules r on r.experimenttype_id = f.experimenttype_id),
placed as (
select *, '/wardrobe/raw_data/' || uid || '/' || case rule when 'upload_macs2_fragment_stat' then uid || '_fragment_stat.tsv'
    when 'upload_iaintersect_result' then uid || '_macs_peaks_iaintersect.tsv' when 'upload_get_stat' then uid || '.stat'
    when 'upload_atdp' then uid || '_atdp.tsv' when 'upload_rpkm' then uid || '.isoforms.csv' end as path from steps),
bad as (
select uid, 'upload_get_stat' as rule, body as line from stat_bodies where body like '% x'
union all
select uid, 'upload_macs2_fragment_stat', body from fragment_bodies where body like '% 9' and len(string_split(body, ' ')) = 4
union all
select uid, 'upload_atdp', min(value) from atdp_lines where value like '%bad' group by uid),
judged as (
select p.uid, p.position, p.rule,
  case when (p.rule like 'upload_bigwig%' or p.rule = 'upload_iaintersect_result')
      and not exists (select 1 from genome g where g.id = p.genome_id) then 'DB not found'
    when p.path is not null and not exists (select 1 from result_files s where s.path = p.path)
      then '[Errno 2] No such file or directory: ''' || p.path || ''''
    when b.line is not null then 'cannot load ''' || b.line || '''' end as why
from placed p left join bad b on b.uid = p.uid and b.rule = p.rule),
failing as (select * from judged where why is not null qualify row_number() over (partition by uid order by position) = 1),
outcome as (
select f.uid, case when x.uid is null then 'completed' else 'failed' end as event, cast(x.position as int) as position, x.rule,
  'Failed to upload ' || x.rule || ' : ' || x.uid || ' : ' || x.why as message
from finished f left join failing x on x.uid = f.uid)
"""
_UPLOAD_TABLES = "finished upload_rules genome result_files stat_bodies fragment_bodies atdp_lines"
_add("upload_outcome", _UPLOAD_TABLES, "select * from outcome", _UPLOADS)
_add("cleanup_files", _UPLOAD_TABLES + " labdata experimenttype fastq_files store_files", """
select q.uid, q.reason, 'file' as kind, f.path
from doomed q join store_files f on split_part(f.path, '/', 4) = q.uid and starts_with(f.path, '/wardrobe/raw_data/')
where case q.reason when 'delete' then true
  when 'reprocess' then split_part(f.path, '/', -1) not like '%fastq%' or f.path like '%/tophat/%'
  else f.path like '/wardrobe/raw_data/' || q.uid || '/' || q.uid || '%.fastq' end
union all
select uid, reason, 'folder', '/wardrobe/raw_data/' || uid || case reason when 'delete' then '' else '/tophat' end
from doomed where reason <> 'upload'""", _UPLOADS + ", " + _PRESENT + """, doomed as (
select uid, action as reason from present
union all
select uid, 'upload' from outcome where event = 'completed')""")

# --- queues --------------------------------------------------------------------------------

_add("download_queue", "labdata", """
select id, uid, url from labdata where libstatus = 0 and deleted = 0 and url is not null and url <> ''""")
_add("reprocess_queue", "labdata", """
select uid, case when deleted = 1 then 'delete' else 'reprocess' end as action from labdata
where (forcerun = 1 and libstatus > 11 and deleted = 0) or deleted = 1""")
_add("rna_completed", "labdata experimenttype", """
select l.uid, e.etype from labdata l, experimenttype e
where e.id = l.experimenttype_id and l.libstatus = 12 and l.deleted = 0 and e.etype like 'RNA%'""")
_ROUTE = """case when regexp_matches({u}, '^(GSM|SR[ARX])[0-9]+( (GSM|SR[ARX])[0-9]+)*$') then 'sra'
  when regexp_matches({u}, '^https?://|^s?ftp://|^-') then 'url'
  when regexp_matches({u}, '^[0-9]+( [0-9]+)*$') then 'copy' else 'local' end"""
_add("route_source", "labdata", f"select uid, url, {_ROUTE.format(u='url')} as route from labdata where url is not null")
_add("fetch_tasks", _DIM_TABLES, """
select uid, route, cast(position as int) as position, source, cast(null as int) as mate, '' as suffix from (
  select uid, route, generate_subscripts(string_split(url, ' '), 1) - 1 as position,
    unnest(string_split(url, ' ')) as source from routed where route = 'sra')
union all
select uid, route, 0, case when pair then nullif(split_part(url, ';', 1), '') else url end, 1, '' from routed
where route = 'url'
union all
select uid, route, 1, nullif(split_part(url, ';', 2), ''), 2, '_2' from routed where route = 'url' and pair""",
     _DIM + f", routed as (select uid, pair, url, {_ROUTE.format(u='url')} as route from dim where url is not null)")
_COPIES = _DIM + """, wanted as (
select uid, pair, unnest(string_split(url, ' ')) as source, generate_subscripts(string_split(url, ' '), 1) - 1 as p
from dim where regexp_matches(url, '^[0-9]+( [0-9]+)*$')),
copies as (
select w.uid, w.pair, cast(min(w.p) as int) as position, d.id as source_id, d.uid as source_uid
from wanted w join dim d on d.id = cast(w.source as bigint) and d.pair = w.pair group by w.uid, w.pair, d.id, d.uid)
"""
_add("copy_sources", _DIM_TABLES, "select * from copies", _COPIES)
_add("local_files", "labdata local_paths", f"""
select l.uid, l.url, count(p.path) as n_files,
  case when count(p.path) = 0 then 'skip' when count(p.path) <= 2 then 'use' else 'error' end as action,
  case when count(p.path) between 1 and 2 then min(p.path) end as mate_1,
  case when count(p.path) = 2 then max(p.path) end as mate_2
from labdata l left join local_paths p on contains(split_part(p.path, '/', -1), l.url)
where l.url <> '' and {_ROUTE.format(u='l.url')} = 'local' group by l.uid, l.url""")
_add("download_outcome", _DIM_TABLES + " local_paths fetched fastq_records fastq_files", """
select uid, case when why is null then 'downloaded' else 'download_failed' end as event, why as message
from (select uid, min(mate) filter (state <> 'ok') as stop, arg_min(why, mate) filter (state = 'failed') as why,
    arg_min(state, mate) filter (state <> 'ok') as said from steps group by uid)
where stop is null or said = 'failed'
union all
select u.uid, 'downloaded', null from underway u
where u.route in ('sra', 'copy') and exists (select 1 from fastq_files f where f.uid = u.uid and f.mate = 1)
  and (not u.pair or exists (select 1 from fastq_files f where f.uid = u.uid and f.mate = 2))""",
     _DIM + f""", underway as (select *, {_ROUTE.format(u='url')} as route from dim where libstatus = 1 and url is not null),
matched as (
select u.uid, count(p.path) as n from underway u left join local_paths p on contains(split_part(p.path, '/', -1), u.url)
where u.route = 'local' and u.url <> '' group by u.uid),
bad_fastq as (
select uid, mate from fastq_records group by uid, mate
having count(*) filter (regexp_matches(l1, '^[ \\t]*@')) <> count(*) filter (regexp_matches(l3, '^[ \\t]*\\+'))),
awaited as (
select uid, m as mate, case when m = 2 and split_part(url, ';', 2) = '' then 'Error: no address'
    when m = 1 and pair and split_part(url, ';', 1) = '' then 'Error: no address' end as refused
from underway, (values (1), (2)) v(m) where route = 'url' and (m = 1 or pair)
union all
select uid, m, case when n = 0 then 'Skip local: File not found 0' when n > 2 then 'Error: Bad filter' end
from matched, (values (1), (2)) v(m) where m = 1 or n = 2),
judged_files as (
select a.uid, a.mate, f.file_type,
  case when a.refused is not null then a.refused
    when f.file_type is not null and f.file_type not in ('bzip2', 'gzip', 'Zip', 'ASCII') then 'Error: file type unknown'
    when f.file_type is not null and exists (select 1 from bad_fastq b where b.uid = a.uid and b.mate = a.mate) then 'Error: not a fastq' end as why
from awaited a left join fetched f on f.uid = a.uid and f.mate = a.mate),
steps as (
select *, case when why is not null then 'failed' when file_type is null then 'awaited' else 'ok' end as state from judged_files)
""")
_PLUGINS = """plugins as (
select l.uid, p.ptype, replace(regexp_replace(p.workflow, '\\.[^.]*$', ''), '.', '_dot_') as job, l.libstatus
from labdata l join experimenttype e on e.id = l.experimenttype_id
join plugintype p on list_contains(from_json(p.etype_id, '["int"]'), e.id))
"""
_add("plugin_match", "labdata experimenttype plugintype", "select uid, ptype, job from plugins", _PLUGINS)
_add("launch_requests", "labdata experimenttype plugintype fastq_files genome last_events launch_log", """
select uid, kind, job, cause, attempt, prefix || '__' || uid || '__' || sha256(job || ':' || uid || ':' || attempt) as run_id
from (
  select w.*, cast(coalesce((select min(g.attempt) from launch_log g where g.uid = w.uid and g.job = w.job and g.cause = w.cause),
    coalesce((select max(g.attempt) from launch_log g where g.uid = w.uid and g.job = w.job), 0)
    + (select count(distinct o.cause) from wanted o where o.uid = w.uid and o.job = w.job and o.cause <= w.cause
       and not exists (select 1 from launch_log g where g.uid = o.uid and g.job = o.job and g.cause = o.cause))) as int) as attempt
  from wanted w)""", _PRESENT + ", " + _PLUGINS + """, queued as (
  select uid, 'download' as kind, 'download' as job, 'trig' as prefix from labdata
  where libstatus = 0 and deleted = 0 and url <> ''
  union all
  select l.uid, 'analysis', replace(e.workflow, '.cwl', ''), 'trig' from labdata l
  join experimenttype e on e.id = l.experimenttype_id where l.libstatus = 10
  union all
  select r.uid, 'reprocess', replace(e.workflow, '.cwl', ''), 'forcerun' from ready r
  join labdata l on l.uid = r.uid join experimenttype e on e.id = l.experimenttype_id where r.action = 'reprocess'
  union all
  select uid, 'plugin', job, 'trig' from plugins where libstatus = 12),
wanted as (
  select q.*, q.kind || ':' || coalesce(e.event_id, 0) as cause from queued q left join last_events e on e.uid = q.uid)""")

_SIZES = "sizes as (select uid, sum(length) / 1024 as size from (select distinct * from file_listing) group by uid)"
_add("footprint_kib", "file_listing", "select uid, size from sizes", _SIZES)

# --- state ---------------------------------------------------------------------------------

_LATEST = """
select uid, libstatus, event_id from (
  select *, row_number() over (partition by uid order by ts desc, event_id desc) as n from status_events) where n = 1"""
_add("status_latest", "status_events", _LATEST)
_add("status_latest_stream", "status_events", _LATEST)
_add("status_current_stream", "status_events", _LATEST)
_add("queue_claim", "labdata", """
select uid, url, 1 as attempt, 'download' as job, 'trig__' || uid || '__' || sha256('download:' || uid || ':1') as run_id
from labdata where libstatus = 0 and deleted = 0 and url is not null and url <> ''""")
_add("lifecycle_next", "labdata_full experimenttype fastq_files lifecycle_log job_results", """
select l.uid, s.event, s.applied_ts, s.applied_id, coalesce(s.status, l.libstatus) as libstatus,
  coalesce(s.txt, l.libstatustxt) as libstatustxt, coalesce(s.deleted, l.deleted) as deleted,
  case when s.runs then 0 else l.forcerun end as forcerun, s.last_start as dateanalyzes,
  coalesce(l.dateanalyzed, s.first_start) as dateanalyzed, s.last_end as dateanalyzee,
  strftime(s.gone, '%Y-%m-%d') as datedel,
  case when s.last_end is not null then coalesce(n.params, l.params) else l.params end as params,
  case when s.reset then 0 else l.tagstotal end as tagstotal,
  case when s.reset then 0 else l.tagsmapped end as tagsmapped,
  case when s.reset then 0 else l.tagsribo end as tagsribo,
  case when s.reset then 0 else l.tagssuppressed end as tagssuppressed,
  case when s.reset then 0 else l.tagsused end as tagsused
from labdata_full l left join replayed s on s.uid = l.uid left join new_params n on n.uid = l.uid""",
     _PRESENT + ", " + _PARAMS + f""", happened as (
select uid, ts, event_id, event, message from lifecycle_log
union all select uid, timestamp '{CLOCK}', null, action, null from ready
union all select uid, timestamp '{CLOCK}', null, 'queued', null from labdata_full
  where libstatus = 0 and deleted = 0 and url <> ''),
ordered as (
select h.*, row_number() over (partition by h.uid order by h.ts, h.event_id nulls last) as turn
from happened h join labdata_full l on l.uid = h.uid
where h.event <> 'queued' or (l.libstatus = 0 and l.deleted = 0 and l.url <> '')),
replayed as (
select uid, arg_max(event, turn) as event,
  arg_max(case event when 'queued' then 1 when 'downloaded' then 10 when 'started' then 11 when 'completed' then 12
    when 'failed' then 2010 else 10 end, turn) filter (event <> 'delete') as status,
  arg_max(case event when 'downloaded' then 'downloaded' when 'started' then 'Analysing'
    when 'completed' then 'Complete:upgraded' when 'failed' then 'Fail:' || replace(message, '''', '"')
    when 'reprocess' then 'Ready to be reanalyzed' else 'Deleted' end, turn) filter (event <> 'queued') as txt,
  arg_max(case event when 'queued' then 0 else 2 end, turn) filter (event in ('queued', 'delete')) as deleted,
  bool_or(event in ('started', 'reprocess')) as runs, bool_or(event = 'reprocess') as reset,
  max(ts) filter (event = 'started') as last_start, min(ts) filter (event = 'started') as first_start,
  max(ts) filter (event in ('completed', 'failed')) as last_end, max(ts) filter (event = 'delete') as gone,
  arg_max(ts, turn) filter (event_id is not null) as applied_ts,
  arg_max(event_id, turn) filter (event_id is not null) as applied_id
from ordered group by uid)
""")
_add("apply_metrics", "labdata_full stat_tokens fragment_tokens experimenttype file_listing", """
select l.uid, c.tagstotal, c.tagsmapped, c.tagsribo, c.tagssuppressed, c.tagsused,
  case when e.etype like '%DNA%' then f.fragmentsize else l.fragmentsize end as fragmentsize,
  case when e.etype like '%DNA%' then f.fragmentsizeest else l.fragmentsizeest end as fragmentsizeest,
  case when e.etype like '%DNA%' then f.islandcount else l.islandcount end as islandcount, coalesce(z.size, l.size) as size
from labdata_full l join experimenttype e on e.id = l.experimenttype_id
join counts c on c.uid = l.uid join frag f on f.uid = l.uid left join sizes z on z.uid = l.uid""",
     _STAT + ", " + _FRAGMENT + ", " + _SIZES)


def _catalogue() -> str:
    from seqtables.operators.catalogue import job_template, upload_rules

    rows = []
    for i, (etype, workflow, inserted) in enumerate(fixed.EXPERIMENT_TYPES):
        rules = "[" + ",".join(f'"{r}"' for r in upload_rules(etype)) + "]"
        rows.append(f"({i}, '{etype}', '{workflow}', '{job_template(etype)}', '{rules}', {inserted})")
    return "seed(n, etype, workflow, template, upload_rules, inserted) as (values " + ",\n".join(rows) + ")\n"


_add("catalogue_upsert", "current_types", """
select c.id, c.etype, coalesce(s.workflow, c.workflow) as workflow, coalesce(s.template, c.template) as template,
  coalesce(s.upload_rules, c.upload_rules) as upload_rules
from current_types c left join seed s on s.etype = c.etype
union all
select (select max(id) from current_types) + row_number() over (order by n), etype, workflow, template, upload_rules
from seed where inserted and etype not in (select etype from current_types)""", _catalogue())

# --- storage and FASTQ ---------------------------------------------------------------------

_add("replace_partition", "isoforms", """
select uid, refseq_id, gene_id, chrom, tx_start, tx_end, strand,
  case when uid = 'exp-1' then tot_r_0 * 2 else tot_r_0 end as tot_r_0, rpkm_0 from isoforms""")
_add("reload_experiments", "atdp", """
select uid, x, case when n % 7 = 3 then y * 2 else y end as y
from (select *, cast(regexp_extract(uid, '([0-9]+)$', 1) as bigint) as n from atdp) where n % 7 <> 3 or n % 2 = 0""")
_HEADS = """count(*) filter (regexp_matches(l1, '^[ \\t]*@')) as n_heads,
  count(*) filter (regexp_matches(l3, '^[ \\t]*\\+')) as n_pluses"""
_add("fastq_valid", "fastq_records", f"""
select uid, mate, n_heads, n_pluses, n_heads = n_pluses as valid
from (select uid, mate, {_HEADS} from fastq_records group by uid, mate)""")
_add("fastq_file_check", "fastq_records", f"select mate, {_HEADS} from fastq_records group by mate")
_add("fastq_merge", _DIM_TABLES + " fastq_records", """
select c.uid, r.mate, 4 * (r.record_no + coalesce((
    select count(*) from copies b join fastq_records q on q.uid = b.source_uid
    where b.uid = c.uid and b.position < c.position and q.mate = r.mate), 0)) + k.i as line_no,
  case k.i when 0 then r.l1 when 1 then r.l2 when 2 then r.l3 else r.l4 end as value
from copies c join fastq_records r on r.uid = c.source_uid and (r.mate = 1 or c.pair),
  (values (0), (1), (2), (3)) k(i)""", _COPIES)
