"""Merkle fixity audit of WARC replicas.

Every record is hashed with SHA-256. Records are laid out by id in volumes of ``VOLUME`` ids, and in each volume in
ranges of ``FANOUT`` ids: a range's hash covers its records' ids, lengths and hashes in order, each node above covers the
hashes and byte lengths of up to ``FANOUT`` ordered ranges below it, up to one root. The audit compares
the replicas' roots and goes down only where nodes differ; in the last ranges it names the records
that changed, are missing or are extra, with the offsets they have in their volume.

A tree level is one aggregate over the level below, so hashing is done where the records are and a level shrinks
by the fan-out. Offsets come from range lengths and at most ``FANOUT`` records in a range.

Defined cases: a null payload is an empty one, a null url an empty address; null ids are left out; records that repeat an id are told apart by their
hash; replicas that agree give no rows, and an empty replica is missing everything. Only id, url and payload are looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtables.llm.common import saved

FANOUT = 16
VOLUME = FANOUT ** 3


def records(pages: DataFrame) -> DataFrame:
    """record_id and the bytes of each page's response record, as text."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    page = F.col("page_id").cast("string")
    record = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), page, F.lit(">\r\nWARC-Target-URI: "), url,
                      F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    return pages.filter("page_id is not null").select(F.col("page_id").cast("long").alias("record_id"), record.alias("record"))


def hashed(recs: DataFrame) -> DataFrame:
    """record_id, length and hash of each record."""
    return saved(recs.select("record_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash")), "records")


def _range(leaves: DataFrame) -> DataFrame:
    """Level 1: node, bytes and hash of each range of ids."""
    # a range has FANOUT ids, and more rows only where records repeat an id
    items = F.array_sort(F.collect_list(F.struct("record_id", "hash", "length")))
    text = F.transform(items, lambda x: F.concat_ws(":", x["record_id"].cast("string"), x["length"].cast("string"), x["hash"]))
    return (leaves.groupBy(F.floor(F.col("record_id") / FANOUT).alias("node"))
            .agg(F.sum("length").alias("bytes"), F.sha2(F.array_join(text, "\n"), 256).alias("hash")))


def _above(level: DataFrame) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("node", "bytes", "hash")))
    text = F.transform(items, lambda x: F.concat_ws(":", x["node"].cast("string"), x["bytes"].cast("string"), x["hash"]))
    return (level.groupBy(F.floor(F.col("node") / FANOUT).alias("node"))
            .agg(F.sum("bytes").alias("bytes"), F.sha2(F.array_join(text, "\n"), 256).alias("hash")))


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Levels 1 to the root."""
    found = [saved(_range(leaves), "tree")]
    while len(found) < levels:
        found.append(saved(_above(found[-1]), "tree"))
    return found


def height(*replicas: DataFrame) -> int:
    """Levels until every replica's ids meet in one node (two nodes where ids of both signs occur)."""
    most = 0
    for r in replicas:
        ends = r.agg(F.min("record_id"), F.max("record_id")).first()
        most = max(most, *(abs(x or 0) for x in ends))
    levels = 1
    while most >= FANOUT ** levels:
        levels += 1
    return levels


def offsets(leaves: DataFrame, ranges: DataFrame) -> DataFrame:
    """record_id, hash, length and the record's offset in its volume; for the leaves and ranges given (ranges of whole volumes)."""
    per_volume = VOLUME // FANOUT
    before = Window.partitionBy(F.floor(F.col("node") / per_volume)).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    begin = ranges.select("node", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy("node").orderBy("record_id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return (leaves.withColumn("node", F.floor(F.col("record_id") / FANOUT)).join(begin, "node")
            .withColumn("offset", F.col("_begin") + F.coalesce(F.sum("length").over(inside), F.lit(0)))
            .select("node", "record_id", "hash", "length", "offset"))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """record_id, volume, status, and the record's offset, length and hash in both; inputs: record_id and record."""
    a, b = hashed(primary), hashed(replica)
    levels = height(a, b)
    ours, theirs = tree(a, levels), tree(b, levels)
    wrong = None
    for x, y in zip(reversed(ours), reversed(theirs)):
        if wrong is not None:
            x, y = (t.withColumn("_parent", F.floor(F.col("node") / FANOUT)).join(wrong.withColumnRenamed("node", "_parent"), "_parent", "left_semi")
                    for t in (x, y))
        y = y.select("node", F.col("hash").alias("_hash"), F.col("bytes").alias("_bytes"))
        wrong = x.join(y, "node", "full").filter("not (hash <=> _hash) or not (bytes <=> _bytes)").select("node")
    wrong = saved(wrong, "mismatches")
    per_volume = VOLUME // FANOUT
    volumes = wrong.select(F.floor(F.col("node") / per_volume).alias("_volume")).distinct()

    def located(leaves: DataFrame, ranges: DataFrame, suffix: str) -> DataFrame:
        near = ranges.withColumn("_volume", F.floor(F.col("node") / per_volume)).join(volumes, "_volume", "left_semi").drop("_volume")
        some = leaves.withColumn("node", F.floor(F.col("record_id") / FANOUT)).join(wrong, "node", "left_semi").drop("node")
        number = F.row_number().over(Window.partitionBy("node", "record_id").orderBy("hash"))
        return offsets(some, near).withColumn("_n", number).select(
            "record_id", "_n", *[F.col(c).alias(f"{c}{suffix}") for c in ("offset", "length", "hash")])

    both = located(a, ours[0], "").join(located(b, theirs[0], "_replica"), ["record_id", "_n"], "full")
    status = F.when(F.col("hash").isNull(), "extra").when(F.col("hash_replica").isNull(), "missing").otherwise("changed")
    return both.filter("not (hash <=> hash_replica)").select(
        "record_id", F.floor(F.col("record_id") / VOLUME).alias("volume"), status.alias("status"), F.col("offset"), F.col("length"), "hash",
        "offset_replica", "length_replica", "hash_replica")


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of the pages with some flipped, some lost and some foreign pages, for the query."""
    p = F.col("page_id")
    return (pages.filter(~(p % 331 == 17)).select(
        F.when(p % 499 == 100, -p).otherwise(p).alias("page_id"), "url",
        F.when(p % 97 == 13, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html")).alias("html")))


def oracle() -> str:
    return f"""
with replica as (
  select case when page_id % 499 = 100 then -page_id else page_id end as page_id, url,
         case when page_id % 97 = 13 then '#' || substr(html, 2) else html end as html
  from pages where not (page_id % 331 = 17)),
a as (
  select page_id as record_id, 'WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:' || page_id || '>\r\nWARC-Target-URI: ' || url
    || '\r\nContent-Length: ' || strlen(html) || '\r\n\r\n' || html || '\r\n\r\n' as record from pages),
b as (
  select page_id as record_id, 'WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:' || page_id || '>\r\nWARC-Target-URI: ' || url
    || '\r\nContent-Length: ' || strlen(html) || '\r\n\r\n' || html || '\r\n\r\n' as record from replica),
x as (
  select record_id, sha256(record) as hash, strlen(record)::BIGINT as length,
         (coalesce(sum(strlen(record)) over (partition by floor(record_id / {VOLUME}.0) order by record_id rows between unbounded preceding and 1 preceding), 0))::BIGINT as offset from a),
y as (
  select record_id, sha256(record) as hash_replica, strlen(record)::BIGINT as length_replica,
         (coalesce(sum(strlen(record)) over (partition by floor(record_id / {VOLUME}.0) order by record_id rows between unbounded preceding and 1 preceding), 0))::BIGINT as offset_replica from b)
select record_id, floor(record_id / {VOLUME}.0)::BIGINT as volume,
       case when hash is null then 'extra' when hash_replica is null then 'missing' else 'changed' end as status,
       "offset", length, hash, offset_replica, length_replica, hash_replica
from x full join y using (record_id) where hash is distinct from hash_replica
"""
