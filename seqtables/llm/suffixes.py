"""Repeated passages by a sparse suffix array.

Of every text only the suffixes at minimiser positions are kept: the places where a ``GRAM``-word hash is least
among ``WINDOW`` neighbours. Equal passages of ``PASSAGE`` words keep the same suffixes, and at least
``PASSAGE - WINDOW + 1`` of the words behind the first one lie in the passage. The suffixes of all texts
are sorted by these words over all tasks, and neighbours are compared: a suffix unlike both neighbours is
in no repeated passage. What is left is extended: for each way a passage of ``PASSAGE`` words can lie about a kept
suffix (so many words to its left, the rest to its right) the passage is hashed, and it repeats if the hash does.
Of equal passages the one least by (doc_id, text, place) is the first; overlapping passages merge to spans.

The range sort splits a passage shared by very many documents over tasks, as rows differ in document and place; passages
are counted with partial aggregation. Exact copies are analysed once: the sort brings them together.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D, compared as they stand.

Defined cases: null, empty and shorter texts have no passage; null ids are neither reported nor compared; rows of one
id and text count as one, and texts that share an id are told apart by their text; copies of one text repeat
it whole, the least id being first; an empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables.llm.common import Words, lean, saved, signed, slices, span_hashes, utf8, runs_hashed, windows_hashed

PASSAGE = 50
WINDOW = 26
GRAM = 4
_BEHIND = PASSAGE - WINDOW + 1
_PLACE_BITS = np.uint64(30)


class _Marked:
    """Texts with the suffix each passage is found by."""

    def __init__(self, texts: pa.Array):
        raw, places = utf8(texts)
        self.classes = signed(span_hashes(raw, places[:-1], places[1:]))
        words = Words(raw, places)
        self.first = words.first
        self.hashes = words.hashes()
        n = len(self.hashes)
        owner = np.repeat(np.arange(len(places) - 1), np.diff(self.first))
        self.starts = np.zeros(0, np.int64)  # places of passages, in all words of the slice
        self.suffix = np.zeros(0, np.int64)  # the suffix kept for each
        if n >= PASSAGE:
            ranked = (runs_hashed(self.hashes, GRAM) >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
            least, reach = ranked, 1
            while 2 * reach <= WINDOW:
                least = np.minimum(least[:-reach], least[reach:])
                reach *= 2
            count = n - PASSAGE + 1
            least = np.minimum(least[:count], least[WINDOW - reach:WINDOW - reach + count])
            whole = np.flatnonzero(owner[:count] == owner[PASSAGE - 1:])
            self.starts = whole
            self.suffix = (least[whole] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        self.owner = owner


def _suffixes(docs: DataFrame) -> DataFrame:
    """key, class, doc_id, place of every kept suffix; and for every document a row without key, place its words."""
    def keep(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                marked = _Marked(part.column("text"))
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(ids), pa.int64()), pa.array(marked.classes), pa.array(ids), pa.array(np.diff(marked.first).astype(np.int32))],
                    ["key", "class", "doc_id", "place"])
                at = np.unique(marked.suffix)
                if len(at):
                    of = marked.owner[at]
                    key = signed(windows_hashed(marked.hashes, _BEHIND))[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(marked.classes[of]), pa.array(ids[of]), pa.array((at - marked.first[of]).astype(np.int32))],
                        ["key", "class", "doc_id", "place"])

    return saved(docs.mapInArrow(lean(keep), "key long, class long, doc_id long, place int"), "suffixes")


def _shared(suffixes: DataFrame) -> DataFrame:
    """doc_id, class, place of the suffixes like a neighbour in the sorted order; of exact copies the first one's."""
    order = ["key", "class", "place", "doc_id"]
    parts = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def neighbours(batches):
        """A row is decided when its successor is seen; the first and last rows of a task are kept, as their
        neighbours may lie in another."""
        held, first = None, True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            c = {n: batch.column(n).to_numpy() for n in order}
            if held is not None:
                c = {n: np.concatenate([held[n], c[n]]) for n in order}
            # held: the row before the undecided one, and the undecided one, both without copies
            fresh = np.ones(len(c["key"]), bool)
            fresh[1:] = (c["key"][1:] != c["key"][:-1]) | (c["class"][1:] != c["class"][:-1]) | (c["place"][1:] != c["place"][:-1])
            c = {n: v[fresh] for n, v in c.items()}
            like = c["key"][1:] == c["key"][:-1]
            keep = np.zeros(len(c["key"]), bool)
            keep[:-1] |= like
            keep[1:] |= like
            if first:
                keep[0], first = True, False
            elif len(keep) > 1:
                keep[0] = False  # decided before, or held only to be compared with
            keep[-1] = False
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(c[n][at]) for n in ("doc_id", "class", "place")], ["doc_id", "class", "place"])
            held = {n: v[-2:] for n, v in c.items()}
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(held[n][-1:]) for n in ("doc_id", "class", "place")], ["doc_id", "class", "place"])

    return (suffixes.filter("key is not null").select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .mapInArrow(lean(neighbours), "doc_id long, class long, place int"))


def _passages(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """hash, doc_id, class, start of every passage about a shared suffix."""
    wanted = shared.groupBy("doc_id", "class").agg(F.collect_list("place").alias("places"))

    def extend(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                marked = _Marked(part.column("text"))
                hashes = signed(windows_hashed(marked.hashes, PASSAGE))
                wanted = part.column("places")
                rows = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
                good = marked.classes == part.column("class").to_numpy()
                at = (wanted.flatten().to_numpy() + marked.first[rows])[good[rows]]
                of = np.flatnonzero(np.isin(marked.suffix, at))
                starts = marked.starts[of]
                owner = marked.owner[starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[starts]), pa.array(part.column("doc_id").to_numpy()[owner]), pa.array(marked.classes[owner]),
                     pa.array((starts - marked.first[owner]).astype(np.int32))],
                    ["hash", "doc_id", "class", "start"])

    return saved(docs.join(wanted, "doc_id").select("doc_id", "class", "text", "places")
                 .mapInArrow(lean(extend), "hash long, doc_id long, class long, start int"), "passages")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, start and n_words of each span of repeated passages; first: whether it is where they stand first.

    Of several texts under one id each has spans of its own, by the places of its words.
    """
    return _spans(docs).drop("class")


def _spans(docs: DataFrame) -> DataFrame:
    """The spans with the class of the text that they lie in."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    suffixes = _suffixes(texts)
    passages = _passages(texts, _shared(suffixes))
    # rows that repeat a document stand at the same place of the same text, and so do not make a passage repeat
    place = F.struct("doc_id", "class", "start")
    firsts = passages.groupBy("hash").agg(F.min(place).alias("least"), F.max(place).alias("most")).filter("least < most").select("hash", "least")
    starts = passages.join(firsts, "hash").select(
        "doc_id", "class", "start", F.lit(PASSAGE).alias("n_words"), (place == F.col("least")).alias("first"))
    # exact copies: each repeats the text whole, and the least id has it first
    whole = suffixes.filter((F.col("key").isNull()) & (F.col("place") >= PASSAGE)).select("class", "doc_id", F.col("place").alias("n_words")).distinct()
    least = whole.groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1").select("class", "least")
    copies = whole.join(least, "class").select("doc_id", "class", F.lit(0).alias("start"), "n_words", (F.col("doc_id") == F.col("least")).alias("first"))

    def merge(batches):
        for batch in batches:
            doc, text, begin, length, kind = [], [], [], [], []
            for i in range(batch.num_rows):
                found = batch.column("parts")[i].values
                s, n, f = (found.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                for first in (True, False):
                    some = np.flatnonzero(f == first)
                    if not len(some):
                        continue
                    some = some[np.argsort(s[some], kind="stable")]
                    ends = np.maximum.accumulate(s[some] + n[some])
                    new = np.ones(len(some), bool)
                    new[1:] = s[some][1:] > ends[:-1]
                    at = np.flatnonzero(new)
                    stop = ends[np.append(at[1:] - 1, len(some) - 1)]
                    doc += [batch.column("doc_id")[i].as_py()] * len(at)
                    text += [batch.column("class")[i].as_py()] * len(at)
                    begin.append(s[some][at])
                    length.append(stop - s[some][at])
                    kind += [first] * len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(text, pa.int64()), pa.array(np.concatenate(begin or [np.zeros(0)]).astype(np.int32)),
                 pa.array(np.concatenate(length or [np.zeros(0)]).astype(np.int32)), pa.array(kind, pa.bool_())],
                ["doc_id", "class", "start", "n_words", "first"])

    return (starts.unionByName(copies).groupBy("doc_id", "class").agg(F.collect_list(F.struct("start", "n_words", "first")).alias("parts"))
            .mapInArrow(lean(merge), "doc_id long, class long, start int, n_words int, first boolean"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the words of passages that stand somewhere before; what is left empty goes.

    The words and white space outside such passages stay as they are, and so do null ids and all other columns;
    a column n_chars follows the text.
    """
    spans = (_spans(docs).filter("not first").groupBy("doc_id")
             .agg(F.collect_list(F.struct("class", "start", "n_words")).alias("_spans")).withColumnRenamed("doc_id", "_doc"))
    at, names = docs.columns.index("text"), docs.columns
    counted = names.index("n_chars") if "n_chars" in names else None
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    joined = docs.select(row, F.col("doc_id").cast("long").alias("_id")).join(spans, F.col("_id") == F.col("_doc"), "left")

    def cut(batches):
        for part in (p for batch in batches for p in slices(batch, batch.column("_row").field(at))):
            held = part.column("_row")
            spans, texts, keep = part.column("_spans").to_pylist(), held.field(at).to_pylist(), []
            sizes = held.field(counted).to_pylist() if counted is not None else []
            for i, (text, found) in enumerate(zip(texts, spans)):
                keep.append(True)
                if not found or not text:
                    continue
                raw = np.frombuffer(text.encode(), np.uint8)
                own = int(signed(span_hashes(raw, np.array([0]), np.array([len(raw)])))[0])
                found = [s for s in found if s["class"] == own]  # the others lie in another text of this id
                if not found:
                    continue
                words = Words(raw, np.array([0, len(raw)]))
                stays = np.ones(len(raw), bool)
                for s in found:
                    stays[words.starts[s["start"]]:words.ends[s["start"] + s["n_words"] - 1]] = False
                texts[i] = raw[stays].tobytes().decode()
                keep[-1] = bool(texts[i].strip())
                if counted is not None:
                    sizes[i] = len(texts[i])
            new = {at: texts, counted: sizes}
            columns = [pa.array(new[k], held.field(k).type) if k in new else held.field(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    return joined.select("_row", "_spans").mapInArrow(lean(cut), docs.schema)
