"""Token-id files: frequency-ranked ids in byte-aligned variable-length code.

An id is replaced by its rank among the ids of the whole corpus, most frequent first, so that common ids take one
byte. Ranks are written with 1 to 4 bytes each in one stream, and their lengths, two bits each, in a separate
stream of control bytes; decoding looks up each control byte's four lengths in a table and gathers the bytes
with numpy. A file row is a block of whole documents in ascending id order: range, block, first (tokens before it
in its range), n, doc_ids, lengths, controls, data; the rank table is a file beside the blocks.

Documents are dealt into ranges of ids by sampled cut points, each range is sorted and written by one task, and
a document's start is its range's start (a sum over at most 4,096 ranges), its block's and its own.

Defined cases: a null or empty text is the end id alone; null ids come first; rows of one id are ordered by their
token bytes; an empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtables.llm.common import buckets_wanted, cut_points, lean, range_of, saved, slices, working_folder
from seqtables.llm.tokens import KEPT, SLICE, encoder, vocabulary

END = 2
BLOCK_TOKENS = 1 << 18
_LEAST = np.iinfo(np.int64).min
#: the four lengths behind each control byte
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype(np.uint32)
    lengths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = lengths - 1
    fours = padded.reshape(-1, 4)
    controls = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    ends = np.cumsum(lengths, dtype=np.int64)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    begins = ends - lengths
    for k in range(int(lengths.max(initial=0))):
        some = lengths > k
        data[begins[some] + k] = (ranks[some] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return controls.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(controls: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(controls, np.uint8)].reshape(-1)[:count]
    raw = np.frombuffer(data, np.uint8)
    begins = np.cumsum(lengths, dtype=np.int64) - lengths
    ranks = raw[begins].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=0))):
        some = np.flatnonzero(lengths > k)
        ranks[some] |= raw[begins[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


@dataclass
class TokenFiles:
    blocks: DataFrame
    ranked: np.ndarray
    path: str


def _tokenised(docs: DataFrame, path: str, end: int, cuts: list[int]) -> DataFrame:
    """range, doc_id, n and the ids' bytes of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        coder = encoder(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = coder.encode([t or "" for t in part.column("text").to_pylist()], end)
                key = pc.fill_null(part.column("doc_id").cast(pa.int64()), _LEAST).to_numpy(zero_copy_only=False)
                n = np.array([len(x) for x in ids]) // coder.dtype.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range_of(key, cuts)), part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    ["range", "doc_id", "n", "ids"])

    return saved(docs.select("doc_id", "text").mapInArrow(lean(encode, KEPT), f"range int, doc_id {kind}, n long, ids binary"), "tokens")


def frequencies(tokens: DataFrame, path: str) -> np.ndarray:
    """How often each id of the vocabulary occurs. One row per id reaches the driver, whatever the corpus holds."""
    def count(batches):
        coder = encoder(path)
        total = np.zeros(coder.tokenizer.get_vocab_size(), np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                found = np.bincount(np.frombuffer(ids.as_buffer(), coder.dtype))
                total[:len(found)] += found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(lean(count, KEPT), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    total[rows["id"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return total


def write(docs: DataFrame, folder: str | None = None, path: str | None = None, end: int = END) -> str:
    """Writes blocks and ranks below the folder and returns it."""
    spark = docs.sparkSession
    path, folder = path or vocabulary(), folder or working_folder(spark, "token-files")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))
    cuts = cut_points(docs.select(key.alias("key")), "key", buckets_wanted(spark))
    tokens = _tokenised(docs, path, end, cuts)
    seen = frequencies(tokens, path)
    ranked = np.lexsort((np.arange(len(seen)), -seen))[:int((seen > 0).sum())]
    rank = np.zeros(max(len(seen), 1), np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        dtype = encoder(path).dtype
        place, number, before, held, size = None, 0, 0, [], 0

        def block():
            ranks = rank[np.frombuffer(b"".join(ids for _, _, ids in held), dtype)]
            controls, data = encode_ranks(ranks)
            return pa.RecordBatch.from_arrays([
                pa.array([place], pa.int32()), pa.array([number], pa.int64()), pa.array([before], pa.int64()),
                pa.array([size], pa.int64()), pa.array([[d for d, _, _ in held]], pa.list_(id_type)),
                pa.array([[n for _, n, _ in held]], pa.list_(pa.int64())), pa.array([controls], pa.binary()),
                pa.array([data], pa.binary())], ["range", "block", "first", "n", "doc_ids", "lengths", "controls", "data"])

        for batch in batches:
            id_type = batch.column("doc_id").type
            for where, doc, n, ids in zip(*(batch.column(c).to_pylist() for c in ("range", "doc_id", "n", "ids"))):
                if held and (where != place or size + n > BLOCK_TOKENS):
                    yield block()
                    number, before, held, size = number + 1, before + size, [], 0
                if where != place:
                    place, number, before = where, 0, 0
                held.append((doc, n, ids))
                size += n
        if held:
            yield block()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tokens.repartition(parts, "range").sortWithinPartitions("range", "doc_id", "ids")
     .mapInArrow(lean(pack, KEPT), f"range int, block long, first long, n long, doc_ids array<{kind}>, lengths array<long>, controls binary, data binary")
     .write.option("compression", "none").parquet(f"{folder}/blocks"))
    spark.createDataFrame([(int(i), int(t)) for i, t in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and the ids of each document in the files.

    The rank table has one row per id of the vocabulary, the range totals one per range.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    ranks = spark.read.parquet(f"{folder}/ranks").toPandas().sort_values("rank")["id"].to_numpy(dtype=np.uint32)
    totals = sorted((r["range"], r["n"]) for r in blocks.groupBy("range").agg(F.sum("n").alias("n")).collect())
    begins, total = {}, 0
    for place, n in totals:
        begins[place], total = total, total + n
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                lengths = row["lengths"].values.to_numpy(zero_copy_only=False).astype(np.int64)
                ids = ranks[decode_ranks(row["controls"].as_py(), row["data"].as_py(), int(lengths.sum()))]
                ends = np.cumsum(lengths)
                starts = begins[row["range"].as_py()] + row["first"].as_py() + ends - lengths
                raw = memoryview(ids.astype("<u4").tobytes())
                own = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([
                    row["doc_ids"].values, pa.array(starts), pa.array(lengths),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()), pa.array([bytes(x) for x in own], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return blocks.mapInArrow(lean(unpack, KEPT), f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, ids binary")
