"""Exact top-k search among binary codes by incremental multi-index hashing.

A code is cut into segments of about log2(codes) bits, and each segment's value is indexed. A query probes, round by
round, the segment values at distance 0, 1, 2 ... from its own. A code not met yet differs in each segment by more than the
segment's radius, so with segments of radius r and some of r + 1 all codes within the sum of (radius + 1) over the segments,
less one, have been met; a query is done when its k-th verified distance is covered. A round widens one segment more for
each bit that the k-th distance so far is beyond what is covered, and all of them only while that is more than there are:
the last round of a query is no wider than it must be.

The index is dealt by segment and by the first bits of the segment's value, so many that a group holds about ``GROUP_CODES``
codes; a group of very many, whose codes are alike there, is dealt over several. A query goes to the groups within the
radius of its own first bits, one row for each, and what is left of the radius it spends inside the group: there the masks of
the other bits are arrays, not rows, and what is met is verified on whole codes against the query's k-th
distance so far. Of a group only the nearest that can be among the k go on. So rows grow with the groups a query comes to,
not with the masks of its radius.

Equal codes are one entry with their least ids (as many as can be asked for; ties go to the lesser id), so neither
a code shared by very many rows nor a query asked very often is ever joined row by row.

Defined cases: rows without id or vector are left out; a vector shorter than the longest has zero bits at its end, as have null elements;
repeated ids count once for each different code; a query finds all others if there are fewer than k; an empty table gives no
rows. Only the id and vector columns are looked at.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtables.llm.common import saved

K = 10
EVERY = 50
#: codes of a group, about, and the most of one that is not dealt over several; values compared at once
GROUP_CODES = 1 << 12
MOST_CODES = 1 << 14
AT_ONCE = 1 << 19


def codes(vectors: DataFrame, ident: str, vector: str) -> tuple[DataFrame, list[int]]:
    """id and code (an array with a number for each segment) of each row: the signs of its elements; the segments' widths."""
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v")).filter("id is not null and v is not null")
    found = rows.agg(F.max(F.size("v")).alias("bits"), F.count("*").alias("n")).first()
    bits, n = max(1, found["bits"] or 1), max(2, found["n"])
    count = max(1, min(bits, round(bits / max(4.0, math.log2(n)))))
    edges = [bits * i // count for i in range(count + 1)]

    def segment(begin: int, end: int) -> Column:
        signs = F.transform(F.sequence(F.lit(begin), F.lit(end - 1)), lambda i: F.coalesce(F.get("v", i) > 0, F.lit(False)).cast("long"))
        return F.aggregate(signs, F.lit(0).cast("long"), lambda a, x: a * 2 + x)

    widths = [e - b for b, e in zip(edges[:-1], edges[1:])]
    return rows.select("id", F.array(*[segment(b, e) for b, e in zip(edges[:-1], edges[1:])]).alias("code")), widths


def _least_ids(rows: DataFrame, most: int) -> DataFrame:
    """One row per code with its least ids. The filter on the row number is applied before the shuffle too."""
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    return (rows.distinct().withColumn("_place", place).filter(F.col("_place") <= most)
            .groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")))


def _flips(width: int, radius: int) -> Column:
    """The masks of so many bits within a segment."""
    masks = F.array(F.lit(0).cast("long"))
    for _ in range(radius):
        masks = F.flatten(F.transform(masks, lambda m: F.transform(
            F.filter(F.array(*[F.lit(1 << i).cast("long") for i in range(width)]), lambda b: b > m), lambda b: m + b)))
    return masks


def _masks(width: int, radius: int) -> np.ndarray:
    """The masks of so many bits, as numbers."""
    return np.array([sum(1 << i for i in bits) for bits in combinations(range(width), radius)], np.int64)


def _numbers(column: pa.ChunkedArray, segments: int) -> np.ndarray:
    """A row for each code, a column for each segment."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, segments)


def _nearest(asking: np.ndarray, distance: np.ndarray, least: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows whose (distance, least id) is among the first so many different ones of their query."""
    order = np.lexsort((least, distance, asking))
    asking, distance, least = asking[order], distance[order], least[order]
    other = np.ones(len(order), bool)
    other[1:] = asking[1:] != asking[:-1]
    begin = np.flatnonzero(other)
    fresh = other.copy()
    fresh[1:] |= (distance[1:] != distance[:-1]) | (least[1:] != least[:-1])
    place = np.cumsum(fresh)
    return order[place - np.repeat(place[begin], np.diff(np.append(begin, len(order)))) < most]


def _meeting(widths: list[int], lead: int, radius: int, k: int):
    """What the queries that came to a group meet there at the radius: query, code, ids, distance."""
    segments = len(widths)

    def meet(key, index: pa.Table, asked: pa.Table) -> pa.Table:
        segment = key[0].as_py()
        rest = widths[segment] - min(lead, widths[segment])
        low = np.int64((1 << rest) - 1)
        codes, queries = _numbers(index.column("code"), segments), _numbers(asked.column("query"), segments)
        least = index.column("ids").combine_chunks()
        least = least.flatten().to_numpy(zero_copy_only=False)[np.cumsum(np.append(0, least.value_lengths().to_numpy(zero_copy_only=False)))[:-1]]
        bound, spent = asked.column("bound").to_numpy(), asked.column("spent").to_numpy()
        order = np.argsort(codes[:, segment] & low, kind="stable")
        held = (codes[:, segment] & low)[order]
        found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32),)]
        for so_far in np.unique(spent).tolist():
            if radius - so_far > rest:
                continue
            masks, some = _masks(rest, radius - so_far), np.flatnonzero(spent == so_far)
            step = max(1, AT_ONCE // max(len(masks), len(held)))
            for begin in range(0, len(some), step):
                mine = some[begin:begin + step]
                values = ((queries[mine, segment] & low)[:, None] ^ masks).ravel()
                first = np.searchsorted(held, values, "left")
                times = np.searchsorted(held, values, "right") - first
                asking = np.repeat(np.repeat(mine, len(masks)), times)
                entry = order[np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())]
                distance = np.zeros(len(entry), np.int32)
                for i in range(segments):
                    distance += np.bitwise_count(codes[entry, i] ^ queries[asking, i])
                near = np.flatnonzero(distance <= bound[asking])
                near = near[_nearest(asking[near], distance[near], least[entry[near]], k + 1)]
                found.append((asking[near], entry[near], distance[near]))
        asking, entry, distance = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query": asked.column("query").take(asking), "code": index.column("code").take(entry),
                         "ids": index.column("ids").take(entry), "distance": pa.array(distance, pa.int32())})

    return meet


def search(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, neighbour_id, distance: the k nearest others of every row whose id is divisible by ``every``."""
    rows, widths = codes(vectors, ident, vector)
    rows, m = saved(rows, "codes"), len(widths)
    entries = saved(_least_ids(rows, k + 1), "code-entries")
    lead = max(0, math.ceil(math.log2(max(1, entries.count()) / GROUP_CODES)))
    leads = [min(lead, w) for w in widths]
    rest = F.element_at(F.array(*[F.lit(w - p) for w, p in zip(widths, leads)]), F.col("segment") + 1)
    index = (entries.select("code", "ids", F.posexplode("code").alias("segment", "value"))
             .withColumn("rest", rest).withColumn("first", F.expr("shiftright(value, rest)")))
    groups = saved(index.groupBy("segment", "first").agg(F.ceil(F.count("*") / MOST_CODES).alias("blocks")), "code-groups")
    # either side of a join here grows with the codes, so neither is broadcast
    index = saved(index.join(groups.hint("merge"), ["segment", "first"])
                  .select("segment", "first", F.pmod(F.xxhash64("code"), "blocks").alias("block"), "code", "ids"), "code-index")
    place = ("segment", "first", "block")
    queries = rows.filter(F.col("id") % every == 0)
    open_queries = saved(queries.select(F.col("code").alias("query")).distinct()
                         .withColumn("bound", F.lit(sum(widths))).withColumn("need", F.lit(m)), "queries")
    best, done = None, []
    for radius in range(max(widths) + 1):
        flips = F.array(*[F.concat(*[_flips(p, r) for r in range(min(radius, p) + 1)]) for p in leads])
        probes = (open_queries.select("query", "bound", "need", F.posexplode("query").alias("segment", "own")).filter("segment < need")
                  .withColumn("rest", rest).select("*", F.explode(F.element_at(flips, F.col("segment") + 1)).alias("mask"))
                  .select("query", "bound", "segment", "rest", F.expr("shiftright(own, rest)").bitwiseXOR(F.col("mask")).alias("first"),
                          F.bit_count("mask").alias("spent")).filter(f"spent + rest >= {radius}")
                  .join(groups.hint("merge"), ["segment", "first"])
                  .select("segment", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "query", "bound", "spent"))
        met = (index.groupBy(*place).cogroup(probes.groupBy(*place))
               .applyInArrow(_meeting(widths, lead, radius, k), "query array<long>, code array<long>, ids array<long>, distance int")
               .dropDuplicates(["query", "code"]))
        found = met.select("query", "distance", F.explode("ids").alias("id"))
        if best is not None:
            found = found.unionByName(best).distinct()
        nearest = Window.partitionBy("query").orderBy("distance", "id")
        best = saved(found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k + 1).drop("rank"), "nearest")
        state = best.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("far")).join(open_queries.select("query", "need"), "query")
        covered = F.least(F.col("need"), F.lit(m)) + (m * radius - 1)
        over = (F.col("n") > k) & (F.col("far") <= covered) | F.lit(radius >= max(widths))
        finished = saved(state.select("query", over.alias("over"), F.when(F.col("n") > k, F.col("far")).otherwise(sum(widths)).alias("bound"),
                                      F.when(F.col("n") > k, F.col("far") - (m * (radius + 1) - 1)).otherwise(m).alias("need")), "covered")
        done.append(best.join(finished.filter("over").select("query"), "query", "left_semi"))
        open_queries = finished.filter("not over").select("query", "bound", "need")
        best = best.join(open_queries.select("query"), "query", "left_semi")
        if open_queries.isEmpty():
            break
    answer = done[0]
    for more in done[1:]:
        answer = answer.unionByName(more)
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return (asked.join(answer, "query").filter("id <> query_id").withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance"))


def oracle(k: int = K, every: int = EVERY) -> str:
    return f"""
with pairs as (
  select q.vec_id as query_id, n.vec_id as neighbour_id,
         cast(list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: case when (q.embedding[i] > 0) <> (n.embedding[i] > 0) then 1 else 0 end)) as integer) as distance
  from embeddings q join embeddings n on q.vec_id % {every} = 0 and q.vec_id <> n.vec_id)
select query_id, cast(row_number() over (partition by query_id order by distance, neighbour_id) as integer) as rank, neighbour_id, distance
from pairs qualify rank <= {k}
"""
