"""Phrase collocation mining by relations of occurrences.

The relation of a length holds every place where a phrase of that length stands, in the order of the corpus. It is kept
by slices of a few million words: a slice's rows hold phrase numbers of the slice, in order of place, and whether the
next row is the next place of the same piece. For each length:

1. count: each slice's phrases and how often they stand there are grouped by phrase over all slices;
2. semi-join: what stays of the frequent groups goes back to the slices, which drop all other occurrences;
3. merge-join: occurrences at adjacent places of a piece join to those of the next length, whose phrase is the pair of
   the two. A phrase can be frequent only if both are.

Only a slice's distinct phrases are shuffled for counting, so a word that fills a third of the corpus is one row a
slice. A phrase's identity is the least (slice, number) that holds it: exact, without hashing. Each relation is written
to the shared folder and the one before it is removed.

Defined cases: a null or empty text has no words; a null lang is ``und``, together with a lang of that name; every row
counts, repeated rows and ids too; a very long text is one piece of work but any number of pieces; ties are ordered by
the phrase's bytes; an empty table gives no rows. Columns other than lang and text are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtables.llm.common import Workspace, lowered, slices, utf8

#: Words of a slice: what one task holds of a relation, and what a phrase costs one row for.
SLICE_WORDS = 1 << 22
#: Parts, by a checksum of the phrase, in which phrases of two words and more are counted one after another: what the disks hold
#: at once of the shuffled phrases.
PASSES = 2
#: Entries of an array in a row of the working tables.
CHUNK = 1 << 16
TEXT_BYTES = 1 << 21
UNKNOWN = "und"

_PIECE_ENDS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8))
_BLANKS = np.isin(np.arange(256), np.frombuffer(b"\x20\x09", np.uint8))
_FIELDS = pa.schema([
    ("slice", pa.int64()), ("first", pa.int32()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
    ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("codes", pa.binary()), ("follows", pa.binary())])
_SCHEMA = "slice long, first int, lang string, words array<string>, left array<long>, right array<long>, " \
          "counts array<long>, codes binary, follows binary"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts, and whether the next word follows in the same piece."""
    raw, places = utf8(texts)
    raw = lowered(raw)
    ends_piece = _PIECE_ENDS[raw]
    spoken = ~(ends_piece | _BLANKS[raw])
    heads = np.zeros(len(raw), bool)
    heads[places[:-1][places[:-1] < places[1:]]] = True
    begins = spoken.copy()
    begins[1:] &= ~spoken[:-1] | heads[1:]
    starts = np.flatnonzero(begins)
    before = np.cumsum(spoken, dtype=np.int64)
    edges = np.append(before[starts] - 1, before[-1] if len(before) else 0)
    if len(raw) >= 1 << 31:
        raise ValueError("a text of over 2 GB")
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw[spoken])])
    pieces = np.cumsum(ends_piece | heads)[starts]
    follows = np.zeros(len(starts), bool)
    follows[:-1] = pieces[1:] == pieces[:-1]
    return words, follows


def _chunks(count: int):
    return [(i, min(i + CHUNK, count)) for i in range(0, count, CHUNK)]


def _lists(values: pa.Array, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def _row(slice_id: int, first: int, **columns) -> dict[str, pa.Array]:
    made = {f.name: pa.nulls(1, f.type) for f in _FIELDS}
    return made | {"slice": pa.array([slice_id], pa.int64()), "first": pa.array([first], pa.int32())} | columns


def _batch(row: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([row[f.name] for f in _FIELDS], schema=_FIELDS)


def _sequence(slice_id: int, codes: np.ndarray, follows: np.ndarray):
    for a, b in _chunks(len(codes)):
        yield _batch(_row(slice_id, a, codes=pa.array([codes[a:b].astype("<i4").tobytes()], pa.binary()),
                          follows=pa.array([np.packbits(follows[a:b]).tobytes()], pa.binary())))


def occurrences(docs: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """The relation of length 1: rows of codes by slice, and rows of the words that the codes stand for."""
    def read(batches):
        task, number, held, size = TaskContext.get().partitionId(), 0, {}, 0

        def flushed():
            slice_id, base = (task << 20) + number, 0
            for lang, parts in held.items():
                coded = pa.chunked_array([w for w, _ in parts]).combine_chunks().dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                counts = np.bincount(codes, minlength=len(coded.dictionary))
                for a, b in _chunks(len(counts)):
                    yield _batch(_row(slice_id, base + a, lang=pa.array([lang], pa.string()),
                                      words=_lists(coded.dictionary[a:b], pa.string()), counts=_lists(pa.array(counts[a:b]), pa.int64())))
                held[lang] = (codes + base, np.concatenate([f for _, f in parts]))
                base += len(counts)
            if held:
                yield from _sequence(slice_id, np.concatenate([c for c, _ in held.values()]), np.concatenate([f for _, f in held.values()]))
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                langs = pc.fill_null(part.column("lang"), UNKNOWN)
                for lang in pc.unique(langs).to_pylist():
                    words, follows = split_words(part.filter(pc.equal(langs, lang)).column("text"))
                    if len(words):
                        held.setdefault(lang, []).append((words, follows))
                        size += len(words)
                if size >= slice_words:
                    yield from flushed()
                    number, held, size = number + 1, {}, 0
        yield from flushed()

    return docs.select("lang", "text").mapInArrow(read, _SCHEMA)


def joined(slice_id: int, chunks: list, number: np.ndarray, gid: np.ndarray):
    """One slice: the occurrences whose phrase is frequent, joined with those at the next place of the piece."""
    if not chunks or not len(number):
        return
    chunks.sort()
    codes = np.concatenate([np.frombuffer(c, "<i4") for _, c, _ in chunks])
    follows = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(c) // 4) for _, c, f in chunks]).astype(bool)
    kept = np.full(max(int(codes.max()), int(number.max())) + 1, -1, np.int32)
    kept[number] = np.arange(len(number), dtype=np.int32)
    codes = kept[codes]
    places = np.flatnonzero(follows[:-1] & (codes[:-1] >= 0) & (codes[1:] >= 0))
    pairs, codes, counts = np.unique(codes[places].astype(np.int64) * len(number) + codes[places + 1], return_inverse=True, return_counts=True)
    for a, b in _chunks(len(pairs)):
        yield _batch(_row(slice_id, a, left=_lists(pa.array(gid[pairs[a:b] // len(number)]), pa.int64()),
                          right=_lists(pa.array(gid[pairs[a:b] % len(number)]), pa.int64()), counts=_lists(pa.array(counts[a:b]), pa.int64())))
    following = np.zeros(len(places), bool)
    following[:-1] = places[1:] == places[:-1] + 1
    yield from _sequence(slice_id, codes.reshape(-1), following)


def _next_relation(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """Slices side by side with their frequent phrases, joined one after another."""
    sequences = relation.filter("codes is not null").select("slice", "first", "codes", "follows")
    both = (sequences.withColumns({"number": F.lit(None).cast("long"), "gid": F.lit(None).cast("long")})
            .unionByName(frequent.select((F.shiftright("ref", 23)).alias("slice"), F.col("ref").bitwiseAND((1 << 23) - 1).alias("number"), "gid"),
                         allowMissingColumns=True))
    parts = int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        own, chunks, numbers, gids = None, [], [], []

        def done():
            empty = [np.zeros(0, np.int64)]
            yield from joined(own, chunks, np.concatenate(numbers or empty), np.concatenate(gids or empty))
            pa.default_memory_pool().release_unused()

        for batch in batches:
            ids = batch.column("slice").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)] if len(ids) else []
            for a, b in zip(edges, edges[1:]):
                if ids[a] != own:
                    if own is not None:
                        yield from done()
                    own, chunks, numbers, gids = int(ids[a]), [], [], []
                part = batch.slice(a, b - a)
                words = part.filter(pc.is_valid(part.column("codes")))
                chunks += zip(*(words.column(c).to_pylist() for c in ("first", "codes", "follows")))
                listed = part.filter(pc.is_valid(part.column("number")))
                numbers.append(listed.column("number").to_numpy(zero_copy_only=False))
                gids.append(listed.column("gid").to_numpy(zero_copy_only=False))
        if own is not None:
            yield from done()

    return both.repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(run, _SCHEMA)


def _counted(relation: DataFrame, key: list[str], least: int, part: int = 0, parts: int = 1) -> DataFrame:
    """ref (slice and number), gid, f and the key of the phrases that stand at least so often: a row for each slice that holds them.

    Only phrases of the given part, by a checksum of the key, are looked at.
    """
    names = {"word": "words", "left": "left", "right": "right"}
    arrays = F.arrays_zip(*[F.col(names[k]).alias(k) for k in key if k in names], F.col("counts").alias("n"))
    rows = (relation.filter("counts is not null").select("slice", "first", *[k for k in key if k == "lang"], F.posexplode(arrays))
            .select(*[k if k == "lang" else F.col(f"col.{k}").alias(k) for k in key], F.col("col.n").cast("int").alias("n"),
                    F.shiftleft("slice", 23).bitwiseOR(F.col("first") + F.col("pos")).alias("ref")))
    if parts > 1:
        rows = rows.filter(F.pmod(F.xxhash64(*key), F.lit(parts)) == part)
    same = Window.partitionBy(*key)
    return (rows.withColumn("f", F.sum("n").over(same)).withColumn("gid", F.min("ref").over(same))
            .filter(F.col("f") >= least).drop("n"))


def _phrases(frequent: DataFrame) -> DataFrame:
    return frequent.filter("ref = gid")


def mine(docs: DataFrame, least: int = 30, longest: int = 4, best: int = 2000, inside: int = 80,
         slice_words: int = SLICE_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first collocations.

    A slice may hold more than ``slice_words`` by the words of 2 MB of text or of one longer text; its numbers must stay
    below 2^23, which is checked.
    """
    work = Workspace(docs.sparkSession, "collocations")
    relation = work.save("relation-1", occurrences(docs, slice_words))
    totals = (relation.filter("lang is not null").groupBy("lang")
              .agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")))
    totals = work.save("totals", totals)
    most = relation.filter("counts is not null").agg(F.max(F.col("first") + F.size("counts"))).first()[0] or 0
    if most > 1 << 23:
        raise ValueError(f"a slice holds {most} distinct words; set slice_words lower")
    names = ["frequent-1"]
    frequent = work.save("frequent-1", _counted(relation, ["lang", "word"], least))
    known = _phrases(frequent).select("gid", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.lit(1).alias("words"), "f")
    found = [work.save("phrases-1", known)]
    for length in range(2, longest + 1):
        relation = work.save(f"relation-{length}", _next_relation(relation, frequent))
        work.remove(f"relation-{length - 1}")
        work.remove(*names)
        names = [f"frequent-{length}-{part}" for part in range(PASSES)]
        parts = [work.save(name, _counted(relation, ["left", "right"], least, part, PASSES)) for part, name in enumerate(names)]
        frequent, before = reduce(DataFrame.unionByName, parts), found[-1]
        whole = (_phrases(frequent).join(before.select(F.col("gid").alias("left"), "lang", F.col("phrase").alias("head")), "left")
                 .join(before.select(F.col("gid").alias("right"), "last"), "right")
                 .select("gid", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", F.lit(length).alias("words"), "f"))
        found.append(work.save(f"phrases-{length}", whole))
    known = found[0]
    for more in found[1:]:
        known = known.unionByName(more)
    result = work.save("result", _ranked(known.select("lang", "phrase", "words", "f"), totals, best, inside))
    work.remove_others("result")
    return result


def _ranked(known: DataFrame, totals: DataFrame, best: int, inside: int) -> DataFrame:
    """Scores at the cheapest cut, without phrases that mostly stand inside a longer one, the best of each language."""
    counts = known.select("lang", "phrase", "f")
    parts = F.split("phrase", " ")
    phrases = known.filter("words >= 2").withColumn("parts", parts)
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", F.col("f").alias("a"), "k",
                    F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("head"),
                    F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
            .join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
            .withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div cast(l + r as decimal(20,0))")))
    scored = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    within = (phrases.filter("words >= 3").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
              .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)))
              .groupBy("lang", F.array_join(F.slice("parts", F.col("at"), F.col("length")), " ").alias("phrase"))
              .agg(F.max("f").alias("longer")))
    left = (scored.join(within, ["lang", "phrase"], "left")
            .filter(f"longer is null or cast(longer as decimal(19,0)) * 100 < cast(a as decimal(19,0)) * {int(inside)}"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def oracle(least: int = 30, longest: int = 4, best: int = 2000, inside: int = 80) -> str:
    grams = " union all ".join(
        f"select lang, {k} as words, array_to_string(w[i:i + {k - 1}], ' ') as phrase "
        f"from (select lang, w, unnest(range(1, len(w) - {k - 2})) as i from pieces)" for k in range(1, longest + 1))
    return f"""
    with texts as (
        select coalesce(lang, '{UNKNOWN}') as lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as s from documents),
    cut as (select lang, unnest(regexp_split_to_array(s, '[.,;:!?\\x0A-\\x0D]')) as piece from texts),
    pieces as (
        select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from cut),
    f as (select lang, words, phrase, count(*) as f from ({grams}) group by all),
    n as (select lang, sum(f) as n from f where words = 1 group by lang),
    known as (select * from f where f >= {least}),
    split as (select *, string_split(phrase, ' ') as w from known where words >= 2),
    cuts as (
        select lang, phrase, words, f as a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:], ' ') as rest
        from (select *, unnest(range(1, words)) as k from split)),
    scored as (
        select c.lang, c.phrase, c.a, c.k, h.f as l, r.f as r, (2000000::hugeint * c.a) // (h.f + r.f) as score
        from cuts c join known h on h.lang = c.lang and h.phrase = c.head join known r on r.lang = c.lang and r.phrase = c.rest),
    lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inner_parts as (
        select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(f) as longer
        from (select *, unnest(range(1, words - k + 2)) as i from (select *, unnest(range(2, words)) as k from split where words >= 3))
        group by all),
    kept as (
        select s.* from lowest s left join inner_parts p on p.lang = s.lang and p.phrase = s.phrase
        where p.longer is null or 100 * p.longer::hugeint < {inside} * s.a::hugeint)
    select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
    from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    join n using (lang) where rank <= {best}
    """
