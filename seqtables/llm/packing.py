"""Mixture-controlled packing of documents into sequences of fixed length.

Documents wait in one queue per source, in order of doc_id. The packer fills mixture windows of
``WINDOW_SEQUENCES`` sequences by deficit round-robin: in each window a source sends tokens up to its quantum, its
target share of the window's tokens, and a document goes on in the next window where the quantum ends. A queue has
sent, after any number of windows, exactly its quanta so far (rounded down). So the windows of a document's tokens follow
from the tokens before it in its queue alone. The targets are the sources' shares of all tokens, which empties all
queues in the last window, or given weights: when a queue is empty the others share what was its part by their
weights, and sources of no weight follow by their shares of the rest.

The windows' pieces, source after source, make one stream that is cut every ``LENGTH`` tokens: only the last
sequence can need padding.

Running totals over the queues and over the stream are sums over sorted partitions plus one row per partition
and source; no task sees a whole queue.

Defined cases: null and empty texts are the end id alone; null source is a source of its own; rows of one id are
told apart by their place in the input; an empty table gives no rows; a negative
weight is an error. Columns other than doc_id, source and text are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtables.llm.common import lean, saved, slices
from seqtables.llm.tokens import KEPT, SLICE, encoder, vocabulary

LENGTH = 1024
WINDOW_SEQUENCES = 64
END = 0


def running_totals(rows: DataFrame, group: str, order: list[str], value: str, kept: list[str]) -> tuple[DataFrame, DataFrame]:
    """The kept columns with ``before``, the sum of the group's values before the row in the given order; and
    each group's total. The rows are sorted over all tasks; a task sums its own, and one row per group
    and task carries what lies in the tasks before."""
    columns = list(dict.fromkeys([group, *order, value, *kept]))
    sorted_rows = rows.select(*columns).repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    schema = "_part int, _before long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_rows.schema)

    def sum_up(batches):
        last, total = object(), 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            groups, values = batch.column(group).to_pylist(), batch.column(value).to_numpy()
            before = np.zeros(len(values), np.int64)
            begin = 0
            while begin < len(values):
                end = begin + 1
                while end < len(values) and groups[end] == groups[begin]:
                    end += 1
                total = total if groups[begin] == last else 0
                ends = total + np.cumsum(values[begin:end])
                before[begin:end] = ends - values[begin:end]
                last, total, begin = groups[begin], int(ends[-1]), end
            part = pa.array(np.full(len(values), TaskContext.get().partitionId(), np.int32))
            yield pa.RecordBatch.from_arrays([part, pa.array(before), *batch.columns], ["_part", "_before", *batch.schema.names])

    local = saved(sorted_rows.mapInArrow(lean(sum_up, KEPT), schema), "running")
    parts = local.groupBy(group, "_part").agg(F.sum(value).alias("_sum"))
    queue = Window.partitionBy(group).orderBy("_part")
    bases = parts.select(F.col(group).alias("_group"), F.col("_part").alias("_place"),
                         (F.sum("_sum").over(queue) - F.col("_sum")).alias("_base"),
                         F.sum("_sum").over(Window.partitionBy(group)).alias("total"))
    joined = local.join(bases, (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_part") == F.col("_place")))
    return (joined.select(*[F.col(c) for c in dict.fromkeys([group, *order, *kept])], (F.col("_base") + F.col("_before")).alias("before"), "total"),
            bases.groupBy("_group").agg(F.max("total").alias("total")))


def tokenised(docs: DataFrame, path: str, end: int) -> DataFrame:
    """row (a number of its own), doc_id, source, n and the ids' bytes of every document."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")}

    def encode(batches):
        coder = encoder(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = coder.encode([t or "" for t in part.column("text").to_pylist()], end)
                n = np.array([len(x) for x in ids]) // coder.dtype.itemsize
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("source"), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    ["row", "doc_id", "source", "n", "ids"])

    rows = docs.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("row"))
    return saved(rows.mapInArrow(lean(encode, KEPT), f"row long, doc_id {kinds['doc_id']}, source {kinds['source']}, n long, ids binary"), "packed-ids")


def schedules(weights: dict, totals: dict, in_all: int, windows: int) -> tuple[dict, int]:
    """For each source with a weight its phases, and the tokens of all of them.

    A phase lasts until the next queue is empty: (first token, first window, a, b, d), where the token at place p is sent
    when (a * (p + 1) + b) / d windows are full.
    """
    share = {s: Fraction(w) for s, w in weights.items() if w and totals.get(s)}
    empty = {s: totals[s] / w for s, w in share.items()}  # each turn sends w tokens of a source
    steps, sent = [], Fraction(0)
    begin = Fraction(0)
    for turn in sorted(set(empty.values())):
        active = sum(w for s, w in share.items() if empty[s] > begin)
        steps.append((begin, active, sent))
        sent += (turn - begin) * active
        begin = turn
    full = Fraction(windows, in_all or 1)
    found = {}
    for s, w in share.items():
        found[s] = []
        for begin, active, before in steps:
            if begin < empty[s]:
                slope, shift = active * full / w, (before - begin * active) * full
                d = slope.denominator * shift.denominator
                found[s].append((int(begin * w), before * full, int(slope * d), int(shift * d), d))
    return found, sum(totals[s] for s in share)


def pieces(phases: list, before: int, n: int) -> list[tuple[int, int, int]]:
    """(start, length, window) of a document's parts, from the tokens before it in its queue."""
    out, at, end = [], before, before + n
    while at < end:
        _, _, a, b, d = phases[bisect_right(phases, at, key=lambda x: x[0]) - 1]
        window = -(-(a * (at + 1) + b) // d) - 1
        _, _, a, b, d = phases[bisect_right(phases, window + 1, key=lambda x: x[1]) - 1]
        stop = min(end, max(at + 1, ((window + 1) * d - b) // a))
        out.append((at - before, stop - at, window))
        at = stop
    return out


def layout(tokens: DataFrame, length: int = LENGTH, window: int = WINDOW_SEQUENCES, weights: dict | None = None) -> DataFrame:
    """row, start and n of a document's piece, its place in the stream and mixture window."""
    weights = weights or {}
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    queues, totals = running_totals(tokens, "source", ["doc_id", "row"], "n", ["n"])
    tokens_in_all = totals.agg(F.sum("total")).first()[0] or 0
    windows = max(1, -(-tokens_in_all // (length * window)))
    named = [s for s in weights if s is not None]
    asked = F.col("_group").isin(named) | (F.col("_group").isNull() & F.lit(None in weights)) if weights else F.lit(False)
    known = {r[0]: r[1] for r in totals.filter(asked).collect()} if weights else {}
    planned, early = schedules(weights, known, tokens_in_all, windows)
    kind = tokens.schema["source"].dataType.simpleString()

    def deal(batches):
        for batch in batches:
            rows, numbers = [], []
            for i, (source, before, n, total) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source", "before", "n", "total")))):
                # sources of no weight are sent after the others, all by their shares
                phases = planned.get(source) or [(0, 0, (tokens_in_all - early) * windows, early * windows * total, tokens_in_all * total)]
                found = pieces(phases, before, n)
                rows += [i] * len(found)
                numbers += [(start, k, w, before + start) for start, k, w in found]
            table = np.array(numbers, np.int64).reshape(-1, 4)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row").take(at), batch.column("source").take(at), *(pa.array(c) for c in table.T.copy())],
                                             ["row", "source", "start", "n", "window", "sent"])

    sent = queues.select("row", "source", "before", "n", "total").mapInArrow(
        lean(deal, KEPT), f"row long, source {kind}, start long, n long, window long, sent long")
    stream, _ = running_totals(sent.withColumn("_all", F.lit(0)), "_all", ["window", "source", "sent", "row"], "n", ["n", "start"])
    return stream.select("row", "start", "n", F.col("before").alias("place"), "window")


def pack(docs: DataFrame, length: int = LENGTH, window: int = WINDOW_SEQUENCES, path: str | None = None, end: int = END,
         weights: dict | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window.

    weights: target share of each source, of any sum; without them the sources' shares of all tokens.
    """
    path = path or vocabulary()
    tokens = tokenised(docs, path, end)
    parts = (layout(tokens, length, window, weights).groupBy("row")
             .agg(F.collect_list(F.struct("start", "n", "place", "window")).alias("parts")))
    placed = tokens.select("row", "doc_id", "n", "ids").join(parts, "row")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        dtype = encoder(path).dtype
        for batch in batches:
            if batch.num_rows == 0:
                continue
            parts = batch.column("parts")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(parts.offsets.to_numpy()))
            own = dict(zip(("start", "n", "place", "window"), (x.to_numpy(zero_copy_only=False) for x in parts.flatten().flatten())))
            n, start, place = own["n"], own["start"], own["place"]
            first, last = place // length, (place + n - 1) // length
            count = last - first + 1
            part = np.repeat(np.arange(len(n)), count)
            doc = owner[part]
            sequence = first[part] + np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(sequence * length, place[part]) - place[part]
            stop = np.minimum((sequence + 1) * length, place[part] + n[part]) - place[part]
            offset = place[part] + begin - sequence * length
            begin, stop = begin + start[part], stop + start[part]
            whole = batch.column("n").to_numpy()
            crc, at = np.zeros(len(doc), np.int64), -1
            for i, (d, b, e) in enumerate(zip(doc.tolist(), begin.tolist(), stop.tolist())):
                if d != at:
                    wide, at = np.frombuffer(batch.column("ids")[d].as_buffer(), dtype).astype("<u4"), d
                crc[i] = zlib.crc32(wide[b:e])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)), pa.array(begin), pa.array(stop - begin), pa.array(crc), pa.array(whole[doc]),
                pa.array(sequence), pa.array(offset), pa.array(own["window"][part])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window"])

    return placed.select("doc_id", "n", "ids", "parts").mapInArrow(
        lean(cut, KEPT), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long")
