"""Document fingerprints from closed syncmers.

A k-mer of bytes is chosen when the least hash among its s-mers stands at its first or last place. That depends
on the k-mer alone, so an edit elsewhere in the text moves no choice. A chosen k-mer is hashed with the number of
equal ones before it in the text, so that repeated passages count as often as they stand. A fingerprint holds the
``ANCHORS`` of least hash in the order they stand in the text, as hexadecimal: twelve digits of hash, four of place (in
units of 16 bytes, in a text over 1 MB of a 65,536th of its length). Two fingerprints are alike by the anchors they share
in the same order, whatever the length of the texts: with j the share of common anchors among the least of both, the likeness is 2j / (1 + j).

Each document is also compared with the next one by id and with an edited text that borrows from it. Documents
are dealt into ranges of ids, and the first document of each range is handed to the range before as well, so
every task sees the successor of its last document; the text is shuffled once.

Defined cases: a null text is empty; an empty text has the empty fingerprint, alike (1) to another empty one and
unlike (0) to any other; a text too short for a small anchor is one as a whole; null ids come first; rows of one id
are ordered by text; a table of one document is its own successor; an empty table gives no rows. Columns other
than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables.llm.common import SLICE_BYTES, buckets_wanted, cut_points, mixed, range_of, span_hashes, utf8

#: Bytes of a k-mer and of the s-mers in it, of either kind.
LARGE, SMALL = (16, 8), (5, 2)
K, S = LARGE
ANCHORS = 64
SHORT, LONG = 32, 64
_UNIT = 16
_PLACE_BITS = np.uint64(16)
_SMALL_BIT = np.uint64(1 << 63)
_LEAST = np.iinfo(np.int64).min


def _smers(raw: np.ndarray, s: int) -> np.ndarray:
    """Hashes of the s bytes from each place on, for s of 2, 4 or 8."""
    count = len(raw) - s + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    numbers = np.lib.stride_tricks.sliding_window_view(raw, s).reshape(-1)[:count * s].view(f"<u{s}")
    return mixed(numbers.astype(np.uint64))


def _chosen(raw: np.ndarray, places: np.ndarray, k: int, s: int) -> np.ndarray:
    """Where the closed syncmers of the texts begin."""
    width, count = k - s + 1, len(raw) - k + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    small = _smers(raw, s)
    least, reach = small, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[:count], least[width - reach:width - reach + count])
    at = np.flatnonzero((least == small[:count]) | (least == small[width - 1:width - 1 + count]))
    return at[at + k <= places[np.searchsorted(places, at, side="right")]]  # a chosen k-mer lies in one text


def _sketched(raw: np.ndarray, places: np.ndarray, at: np.ndarray, ends: np.ndarray, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The text of each anchor that its fingerprint keeps, and the anchor: hash above place, in the order of the text."""
    mark = span_hashes(raw, at, ends)
    owner = np.searchsorted(places, at, side="right") - 1
    order = np.lexsort((at, mark, owner))
    at, mark, owner = at[order], mark[order], owner[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (mark[1:] != mark[:-1])
    begun = np.flatnonzero(fresh)
    earlier = (np.arange(len(at)) - begun[np.cumsum(fresh) - 1]).astype(np.uint64)
    mark = mixed(mark + earlier) >> (_PLACE_BITS + np.uint64(1))
    order = np.lexsort((at, mark, owner))
    at, mark, owner = at[order], mark[order], owner[order]
    kept = np.ones(len(at), bool)
    kept[1:] = (owner[1:] != owner[:-1]) | (mark[1:] != mark[:-1])
    at, mark, owner = at[kept], mark[kept], owner[kept]
    if most is not None:
        least = np.arange(len(owner)) - np.searchsorted(owner, owner) < most
        at, mark, owner = at[least], mark[least], owner[least]
    order = np.lexsort((at, owner))
    at, mark, owner = at[order], mark[order], owner[order]
    unit = np.maximum(_UNIT, -(-np.diff(places) // (1 << int(_PLACE_BITS))))
    where = ((at - places[owner]) // unit[owner]).astype(np.uint64)
    return owner, (mark << _PLACE_BITS) | where


def anchors(texts: pa.Array, most: int | None = ANCHORS) -> list[np.ndarray]:
    """For each text its anchors, hash above place, in the order of the text: the large ones, then the small ones."""
    raw, places = utf8(texts)
    lengths, chars = np.diff(places), pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    of = lambda at: np.searchsorted(places, at, side="right") - 1
    large = _chosen(raw, places, *LARGE)
    large = large[chars[of(large)] >= SHORT]
    brief = (chars < LONG) & (lengths > 0)
    small = np.zeros(0, np.int64)
    if brief.any():
        # only the short texts' bytes, one after another
        own = np.flatnonzero(np.repeat(brief, lengths))
        edges = np.concatenate([[0], np.cumsum(np.where(brief, lengths, 0))])
        small = own[_chosen(raw[own], edges, *SMALL)]
    ends = small + SMALL[0]
    bare = np.setdiff1d(np.flatnonzero(brief), of(small))
    small, ends = np.concatenate([small, places[bare]]), np.concatenate([ends, places[bare + 1]])
    found = [_sketched(raw, places, large, large + K, most), _sketched(raw, places, small, ends, most)]
    cuts = [np.searchsorted(owner, np.arange(len(texts) + 1)) for owner, _ in found]
    return [np.concatenate([found[0][1][cuts[0][i]:cuts[0][i + 1]], found[1][1][cuts[1][i]:cuts[1][i + 1]] | _SMALL_BIT]) for i in range(len(texts))]


def text_of(found: np.ndarray) -> str:
    return found.astype(">u8").view(np.uint8).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, most: int | None = ANCHORS) -> float:
    """0 to 1; from anchors as ``anchors`` gives them with the same ``most``."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    kinds = [(x[x < _SMALL_BIT], x[x >= _SMALL_BIT]) for x in (a, b)]
    for kind in (1, 0):
        a, b = kinds[0][kind], kinds[1][kind]
        if len(a) and len(b):
            return _alike(a, b, most)
    return 0.0


def _alike(a: np.ndarray, b: np.ndarray, most: int | None) -> float:
    x, y = a >> _PLACE_BITS, b >> _PLACE_BITS
    # the least hashes of both together, up to a full sketch, but never beyond what a full sketch knows
    both = np.union1d(x, y)
    if most is not None and max(len(x), len(y)) >= most:
        both = both[:most]
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    known = common <= both[-1]
    i, j = i[known], j[known]
    rising: list[int] = []
    for place in j[np.argsort(i)].tolist():
        k = bisect_right(rising, place)
        rising[k:k + 1] = [place]
    share = len(rising) / len(both)
    return 2 * share / (1 + share)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the following one's beginning."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _dealt(docs: DataFrame, ranges: int) -> DataFrame:
    """Documents by range, and in each range, marked ahead, the first document of the next one."""
    light = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"))
    cuts = cut_points(light, "key", ranges)

    def place(batches):
        for batch in batches:
            found = range_of(batch.column(0).to_numpy(), cuts)
            edges, where = np.unique(found, return_index=True)
            least = [int(batch.column(0).to_numpy()[found == e].min()) for e in edges]
            yield pa.RecordBatch.from_arrays([pa.array(edges, pa.int32()), pa.array(least, pa.int64())], ["range", "least"])

    firsts = sorted((r["range"], r["least"]) for r in light.mapInArrow(place, "range int, least long")
                    .groupBy("range").agg(F.min("least").alias("least")).collect())
    before = {least: firsts[i - 1][0] for i, (_, least) in enumerate(firsts)}
    heads = np.array(sorted(before), dtype=np.int64)

    def deal(batches):
        for batch in batches:
            key = pc.fill_null(batch.column("doc_id").cast(pa.int64()), _LEAST).to_numpy(zero_copy_only=False)
            extra = np.flatnonzero(np.isin(key, heads))
            number = np.concatenate([range_of(key, cuts), np.array([before[k] for k in key[extra].tolist()], np.int32)])
            ahead = np.arange(len(number)) >= batch.num_rows
            for rows, a, b in ((batch, 0, batch.num_rows), (batch.take(pa.array(extra)), batch.num_rows, len(number))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[a:b], pa.int32()), pa.array(ahead[a:b]), rows.column("doc_id"), rows.column("text")],
                    ["range", "ahead", "doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(deal, f"range int, ahead boolean, doc_id {kind}, text string")


def fingerprints(docs: DataFrame, most: int | None = ANCHORS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    ``most`` is the number of anchors a fingerprint keeps of either kind, None for all.
    """
    spark = docs.sparkSession
    dealt = _dealt(docs, buckets_wanted(spark))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "ahead", "doc_id", "text")
    kind = docs.schema["doc_id"].dataType

    def digest(rows):
        """rows: (range, ahead, id, text) in order; every row but those ahead and the last has its successor after it."""
        texts = [r[3] or "" for r in rows]
        changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:])]
        found = anchors(pa.array(texts + changed, pa.large_string()), most)
        own, other = found[:len(texts)], found[len(texts):]
        kept = [i for i in range(len(rows) - 1) if not rows[i][1]]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in kept], arrow_id),
            pa.array([len(texts[i]) for i in kept], pa.int64()),
            pa.array([hashlib.sha256(changed[i].encode()).hexdigest() for i in kept], pa.string()),
            pa.array([text_of(own[i]) for i in kept], pa.string()),
            pa.array([text_of(other[i]) for i in kept], pa.string()),
            pa.array([likeness(own[i], other[i], most) for i in kept], pa.float64()),
            pa.array([likeness(own[i], own[i + 1], most) for i in kept], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(kind)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held and held[-1][1] and row[1] and row[0] == held[-1][0]:
                    continue  # a second row of the id that begins the next range
                held.append(row)
                size += len(row[3] or "")
                if size >= SLICE_BYTES // 2 and len(held) > 1:
                    yield digest(held)
                    held, size = held[-1:], len(held[-1][3] or "")
        if len(held) > 1:
            yield digest(held)

    return ordered.mapInArrow(run, f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")
