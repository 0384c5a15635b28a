"""N-gram Jaccard join with signature trees.

A document's set holds its distinct five-word shingles. Two documents link when 100 * common >= 75 * united.

Sets are first folded to classes of equal sets. Classes meet where they share one of their first tokens in
one order of all tokens, the most frequent ones last: two sets this alike always share one among the first
n - ceil(0.75 n) + 1, whatever the order. Each token's classes are a bucket, spread over several where
the token is very frequent.

1. Each class is compared with the bucket leader it meets most often, and components are formed of the links found.
   Copies that differ a little, however many, are mostly one component after this.
2. In buckets that still hold several components each class is compared with the one before it that it meets most often, in a
   few orders of the classes: near copies out of reach of their leaders come together in such chains.
3. In buckets that then hold several a signature tree is built: leaves are the classes in order of
   size, and each node above holds the OR of the token bitmaps below it, their size range and the most
   tokens that share a bit. The tree is traversed against itself; a pair of nodes is dropped when its sizes are too far
   apart, when both are of one component, or when the bits in common cannot make the overlap needed. Pairs that meet
   in too few buckets for that overlap are dropped as well. A bucket of more than ``BLOCK_ROWS`` rows is dealt by pairs of
   blocks: a cell holds two blocks of classes and compares each of the one with each of the other, and the largest
   component's blocks meet the others' only. So what a task holds is bounded whatever the token.

Pairs that remain are compared on whole sets, in rounds: each component proposes its most promising pairs, and those that
link join components before the next round. Texts travel to the comparison by star: a star's centre is read once for
all its partners, and stars of many partners are split. Lists of ids grow with the corpus, so their joins
are merge joins at every size.

Defined cases: null and wordless texts have an empty set, no links and themselves as component; a null id has no
component (null) and no links; rows of one id are one document with every text's links; ties and repeated rows are
equal sets; an empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtables.llm.common import Words, Workspace, lean, lowered, mixed, runs_hashed, signed, slices, utf8
from seqtables.llm.components import components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
#: A token in this share of all documents is frequent and goes to the end of the order; one in the second share is
#: very frequent, goes last, and its bucket is split. At most (mean tokens of a document) / FREQUENT tokens are either.
#: Counts are summed over the chunks in which a token has that share and LEAST_SEEN documents; one counted short by this
#: stays among the rarer ones, which changes no link.
FREQUENT = 0.0005
VERY_FREQUENT = 0.005
LEAST_SEEN = 6
CHUNK_TOKENS = 1 << 22
SIGNATURE_BITS = 512
SALTS = 16
STAR_SPLITS = 32
FANOUT = 8
#: rows a block of a split bucket holds, about, and rows of the buckets that one leader brings to a task, about
BLOCK_ROWS = 1 << 12
LEADER_ROWS = 1 << 16
#: rounds of chains, and the share of a round's pairs that must link for another one
MOST_CHAINS = 4
CHAIN_SHARE = 0.05
#: a component proposes one pair in the first round, and this many times more in each round after
MORE_PROPOSALS = 16

_TIER = np.uint64(62)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes."""
    raw, places = utf8(texts)
    words = Words(lowered(raw), places)
    hashes = words.hashes()
    runs = runs_hashed(hashes, SHINGLE)
    found = []
    for b, e in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if e - b >= SHINGLE:
            found.append(np.unique(runs[b:e - SHINGLE + 1]))
        elif e > b:
            found.append(runs_hashed(hashes[b:e], e - b)[:1])
        else:
            found.append(hashes[:0])
    return found


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    if DENOMINATOR * min(len(x), len(y)) < NUMERATOR * max(len(x), len(y)) or not len(x):
        return False
    common = len(x) + len(y) - len(np.union1d(x, y))
    return DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common)


def class_of(tokens: np.ndarray) -> int:
    """One number for equal sets."""
    return int(signed(mixed(np.array([tokens.sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)))[0])


def prefix(tokens: np.ndarray, frequent: np.ndarray, tier: np.ndarray) -> np.ndarray:
    """The tokens a set must share one of with any set it links to; in the top bits their tier, which leads the
    order: 0, 1 for frequent, 3 for very frequent ones, which so are negative as signed numbers."""
    ordered = tokens >> np.uint64(2)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        ordered = ordered | np.where(frequent[at] == tokens, tier[at], np.uint64(0)) << _TIER
    n = len(tokens)
    keep = n - -(-NUMERATOR * n // DENOMINATOR) + 1
    return np.partition(ordered, keep - 1)[:keep] if keep < n else ordered


def signature(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIGNATURE_BITS, np.uint8)
    bits[(tokens >> np.uint64(20)) % np.uint64(SIGNATURE_BITS)] = 1
    return np.packbits(bits)


def repeated(chunk: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that occur so often in a chunk, in order, and how often; the chunk is emptied. Besides the chunk and one sorted
    copy only what is frequent is held."""
    tokens = np.concatenate(chunk)
    chunk.clear()
    tokens.sort()
    behind = max(1, int(np.ceil(least))) - 1
    ends = tokens[behind:]
    found = np.unique(ends[ends == tokens[:len(ends)]])
    return found, np.searchsorted(tokens, found, "right") - np.searchsorted(tokens, found, "left")


def _described(docs: DataFrame, work: Workspace | None = None) -> DataFrame:
    """A row per document (doc_id, n, class, bits) and rows of tokens frequent in a chunk (token, and as n its documents there)."""
    work = work or Workspace(docs.sparkSession, "jaccard")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches):
        chunk, held, rows = [], 0, 0

        def frequent():
            token, n = repeated(chunk, max(LEAST_SEEN, FREQUENT * rows))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(token), arrow_id), pa.array(n, pa.int64()),
                 pa.nulls(len(token), pa.int64()), pa.nulls(len(token), pa.binary()), pa.array(signed(token))],
                ["doc_id", "n", "class", "bits", "token"])

        for batch in batches:
            arrow_id = batch.column("doc_id").type
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([class_of(s) for s in sets], pa.int64()), pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                     pa.nulls(len(sets), pa.int64())],
                    ["doc_id", "n", "class", "bits", "token"])
                chunk.append(np.concatenate(sets))  # few large arrays go back to the system when they are dropped, many small ones do not
                held, rows = held + sum(map(len, sets)), rows + len(sets)
                if held >= CHUNK_TOKENS:
                    yield frequent()
                    held, rows = 0, 0
        if chunk:
            yield frequent()

    return work.save("sets", docs.select("doc_id", "text").mapInArrow(lean(describe), f"doc_id {kind}, n long, class long, bits binary, token long"))


def _frequent(described: DataFrame) -> DataFrame:
    """token and tier of the tokens frequent in the whole corpus."""
    documents = described.filter("token is null").count()
    counted = described.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    return (counted.filter(F.col("n") >= max(LEAST_SEEN, FREQUENT * documents))
            .select("token", F.when(F.col("n") >= VERY_FREQUENT * documents, 3).otherwise(1).alias("tier")))


def _prefix_rows(docs: DataFrame, frequent: np.ndarray, tier: np.ndarray) -> DataFrame:
    """token, salt, rep (an id of the class), class and size, for the first document of each class in each task."""
    def emit(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                token, rep, cls, size = [], [], [], []
                for doc, tokens in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"))):
                    number = class_of(tokens)
                    if not len(tokens) or doc is None or number in seen:
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(number)
                    first = prefix(tokens, frequent, tier)
                    token.append(first)
                    rep.append(np.full(len(first), doc, np.int64))
                    cls.append(np.full(len(first), number, np.int64))
                    size.append(np.full(len(first), len(tokens), np.int32))
                if token:
                    columns = [np.concatenate(x) for x in (token, rep, cls, size)]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(columns[0])), *map(pa.array, columns[1:])],
                                                     ["token", "rep", "class", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(emit), "token long, rep long, class long, n int")
    return rows.withColumn("salt", F.when(F.col("token") < 0, F.pmod("class", F.lit(SALTS))).otherwise(0).cast("int"))


def _buckets(rows: DataFrame, work: Workspace) -> DataFrame:
    """Rows of buckets with several classes (of frequent tokens all), with the bucket's first class as hub."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def several(batches):
        names, hub_names = ("token", "salt", "rep", "class", "n"), ("rep", "class", "n")
        last, shown = None, True  # the first row of the bucket the batch before ended in, and whether it was passed on
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = {c: batch.column(c).to_numpy() for c in names}
            if last is not None:  # the bucket may go on
                column = {c: np.concatenate([last[c], column[c]]) for c in names}
            fresh = np.ones(len(column["token"]), bool)
            fresh[1:] = (column["token"][1:] != column["token"][:-1]) | (column["salt"][1:] != column["salt"][:-1])
            begin, of = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            keep = (np.bincount(of)[of] > 1) | (column["token"] < 0)
            final = begin[-1]
            passed = bool(keep[final])
            if last is not None:
                passed = passed or (len(begin) == 1 and shown)
                keep[0] &= not shown
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(column[c][at]) for c in names] + [pa.array(column[c][begin[of[at]]]) for c in hub_names],
                                             [*names, *(f"hub_{c}" for c in hub_names)])
            last, shown = {c: column[c][final:final + 1] for c in names}, passed

    return work.save("buckets", rows.repartition(parts, "token", "salt").sortWithinPartitions("token", "salt", "rep", "class")
                     .select("token", "salt", "rep", "class", "n")
                     .mapInArrow(lean(several), "token long, salt int, rep long, class long, n int, hub_rep long, hub_class long, hub_n int"))


_NEAR_SIZES = f"{DENOMINATOR} * least(n_a, n_b) >= {NUMERATOR} * greatest(n_a, n_b)"


def _first_pairs(buckets: DataFrame, work: Workspace) -> DataFrame:
    """Each class with the hub it meets most often (also the hubs of a very frequent token's buckets with one of them).

    This only finds most links cheaply: what it leaves is met again in the second step.
    """
    stars = buckets.filter("class <> hub_class").select(
        F.col("hub_rep").alias("rep_a"), F.col("hub_class").alias("a"), F.col("hub_n").alias("n_a"),
        F.col("rep").alias("rep_b"), F.col("class").alias("b"), F.col("n").alias("n_b"))
    hubs = buckets.filter("token < 0").select("token", "hub_rep", "hub_class", "hub_n").distinct()
    first = hubs.groupBy("token").agg(F.min(F.struct("hub_rep", "hub_class", "hub_n")).alias("first"))
    between = hubs.join(first.hint("merge"), "token").filter("hub_class <> first.hub_class").select(
        F.col("first.hub_rep").alias("rep_a"), F.col("first.hub_class").alias("a"), F.col("first.hub_n").alias("n_a"),
        F.col("hub_rep").alias("rep_b"), F.col("hub_class").alias("b"), F.col("hub_n").alias("n_b"))
    met = (stars.unionByName(between).filter(_NEAR_SIZES).groupBy("b", "a")
           .agg(F.min("rep_a").alias("rep_a"), F.min("rep_b").alias("rep_b"), F.min("n_b").alias("n"), F.count("*").alias("shared")))
    best = met.groupBy("b").agg(F.max(F.struct("shared", F.negative("rep_a").alias("_last"), "a", "rep_a", "rep_b", "n")).alias("best"))
    # a hub met at under a twentieth of the tokens is rather one that shares a passage
    return work.save("hubs", best.filter("best.shared * 20 >= best.n").select("best.a", "b", "best.rep_a", "best.rep_b"))


def _distinct(pairs: DataFrame, work: Workspace) -> DataFrame:
    """Each pair once, if it shares enough first tokens.

    Of the set whose first tokens end first, every common token up to that end is among both sets' first tokens, and
    the set has ceil(0.75 n) - 1 others. So linked sets share at least the overlap needed less that many.
    """
    rest = lambda n: f"ceil({NUMERATOR} * {n} / {DENOMINATOR}) - 1"
    enough = f"shared + greatest({rest('n_a')}, {rest('n_b')}) >= {NUMERATOR} * (n_a + n_b) / {NUMERATOR + DENOMINATOR} - 1e-6"
    counted = pairs.groupBy("a", "b").agg(F.min("rep_a").alias("rep_a"), F.min("rep_b").alias("rep_b"), F.min("n_a").alias("n_a"),
                                          F.min("n_b").alias("n_b"), F.sum("times").alias("shared"))
    return work.save("pairs", counted.filter(enough).select("a", "b", "rep_a", "rep_b", "shared"))


def _verified(docs: DataFrame, pairs: DataFrame, work: Workspace) -> DataFrame:
    """The pairs (a, b) of classes that link, compared on whole sets."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.withColumn("split", F.pmod(F.xxhash64("b"), F.lit(STAR_SPLITS)).cast("int"))
    centres = pairs.groupBy("a", "split").agg(F.min("rep_a").alias("rep")).select("rep", F.col("a").alias("class"), F.col("a").alias("star"), "split", F.lit(0).alias("role"))
    rims = pairs.select(F.col("rep_b").alias("rep"), F.col("b").alias("class"), F.col("a").alias("star"), "split", F.lit(1).alias("role"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").filter("rep is not null")
    sent = centres.unionByName(rims).hint("merge").join(texts, "rep")
    stars = sent.repartition(parts, "star", "split").sortWithinPartitions("star", "split", "role", "class")

    def compare(batches):
        place, centre = None, None
        for batch in batches:
            for part in slices(batch, "text"):
                a, b = [], []
                sets = shingle_sets(part.column("text"))
                keys = zip(*(part.column(c).to_pylist() for c in ("star", "split", "role", "class")))
                for tokens, (star, split, role, cls) in zip(sets, keys):
                    if class_of(tokens) != cls:
                        continue  # another text under the same id
                    if role == 0:
                        place, centre = (star, split), tokens
                    elif place == (star, split) and alike(centre, tokens):
                        a.append(star)
                        b.append(cls)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return work.save(work.number("verified"), stars.select("star", "split", "role", "class", "text").mapInArrow(lean(compare), "a long, b long").distinct())


#: the least overlap of linked sets, as a share of the sum of their sizes
_SHARE = NUMERATOR / (NUMERATOR + DENOMINATOR)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.int32)


#: no component has this number, as they are hashes; node pairs handled at once
_SEVERAL = np.iinfo(np.int64).min
_AT_ONCE = 1 << 14
_COUNTED_AT_ONCE = 1 << 19
#: more than the blocks of any bucket
_STRIDE = 1 << 24


def possible(i, j, sizes, bits, doubled, component):
    """Of the pairs i, j (sizes rising from i to j) those of different components that may overlap enough."""
    ok = (component[i] != component[j]) & (DENOMINATOR * sizes[i] >= NUMERATOR * sizes[j])
    i, j = i[ok], j[ok]
    bound = _ONES[bits[i] & bits[j]].sum(axis=1) + np.minimum(doubled[i], doubled[j])
    ok = bound >= _SHARE * (sizes[i] + sizes[j]) - 1e-6
    return i[ok], j[ok]


def _levels(sizes, bits, doubled, met, component) -> list[tuple]:
    """The tree from its rows up: bits, least and most size, most doubled, most buckets met in, and the component where
    there is one only."""
    levels = [(bits, sizes, sizes, doubled, met, component)]
    while len(levels[-1][0]) > 1:
        below, least, most, twice, met, own = levels[-1]
        heads = np.arange(0, len(below), FANOUT)
        low, high = np.minimum.reduceat(own, heads), np.maximum.reduceat(own, heads)
        levels.append((np.bitwise_or.reduceat(below, heads, axis=0), np.minimum.reduceat(least, heads), np.maximum.reduceat(most, heads),
                       np.maximum.reduceat(twice, heads), np.maximum.reduceat(met, heads),
                       np.where((low == high) & (low != _SEVERAL), low, _SEVERAL)))
    return levels


def _crossed(one: list[tuple], two: list[tuple]):
    """Runs of pairs of a row of the first tree and one of the second (of one tree: with a later row) that may link.

    The trees are traversed level by level, node pairs of a level in runs of bounded length.
    """
    depth, same = max(len(one), len(two)), one is two
    one, two = (levels + [levels[-1]] * (depth - len(levels)) for levels in (one, two))
    stack = [(depth - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    step = np.arange(FANOUT)
    while stack:
        depth, x, y = stack.pop()
        if len(x) > _AT_ONCE:
            stack += [(depth, x[k:k + _AT_ONCE], y[k:k + _AT_ONCE]) for k in range(0, len(x), _AT_ONCE)]
            continue
        (below_a, least_a, most_a, twice_a, met_a, own_a), (below_b, least_b, most_b, twice_b, met_b, own_b) = one[depth], two[depth]
        ok = (DENOMINATOR * most_a[x] >= NUMERATOR * least_b[y]) & (DENOMINATOR * most_b[y] >= NUMERATOR * least_a[x])
        ok &= (own_a[x] != own_b[y]) | (own_a[x] == _SEVERAL)
        x, y = x[ok], y[ok]
        needed = _SHARE * (least_a[x] + least_b[y]) - 1e-6
        ok = np.minimum(met_a[x], met_b[y]) + -(-NUMERATOR * np.maximum(most_a[x], most_b[y]) // DENOMINATOR) - 1 >= needed
        x, y, needed = x[ok], y[ok], needed[ok]
        bound = _ONES[below_a[x] & below_b[y]].sum(axis=1) + np.minimum(twice_a[x], twice_b[y])
        ok = bound >= needed
        if same:
            ok |= x == y
        x, y = x[ok], y[ok]
        if depth == 0:
            if same:
                x, y = x[x != y], y[x != y]
            if len(x):
                yield x, y
        elif len(x):
            i = np.repeat((FANOUT * x[:, None] + step).reshape(-1, FANOUT, 1), FANOUT, axis=2).ravel()
            j = np.repeat((FANOUT * y[:, None] + step).reshape(-1, 1, FANOUT), FANOUT, axis=1).ravel()
            ok = (i < len(one[depth - 1][0])) & (j < len(two[depth - 1][0]))
            if same:
                ok &= i <= j
            stack.append((depth - 1, i[ok], j[ok]))


def _tree(sizes, bits, component, met=None) -> list[tuple]:
    return _levels(sizes, bits, sizes - _ONES[bits].sum(axis=1), sizes if met is None else met, component)


def tree_pairs(sizes: np.ndarray, bits: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components that may overlap enough. sizes ascending; bits: a packed row for each."""
    tree = _tree(sizes, bits, component)
    found = list(_crossed(tree, tree))
    none = np.zeros(0, np.int64)
    return (np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])) if found else (none, none)


def _celled(rows: DataFrame) -> DataFrame:
    """Each row in all cells it belongs to, with ``cell`` and ``side``; rows has class, main, and its token's ``bulk`` (rows of the
    largest component) and ``others``.

    Two rows of a token that are not both of the largest component meet in exactly one cell: on side 0, or on sides 1 and 2.
    """
    blocks = lambda n: f"cast(shiftleft(1L, cast(ceil(log2(greatest({n}, {BLOCK_ROWS}) / {BLOCK_ROWS})) as int)) as bigint)"
    split = rows.withColumn("_few", F.expr(f"bulk + others <= {BLOCK_ROWS}")).withColumn("_of", F.expr(blocks("others"))).withColumn("_over", F.expr(blocks("bulk")))
    own = lambda p, q: f"struct(least({p}, {q}) * {_STRIDE} + greatest({p}, {q}) as cell, case when {p} = {q} then 0 when {p} < {q} then 1 else 2 end as side)"
    cross = lambda m, q, side: f"struct(({_STRIDE} + {m}) * {_STRIDE} + {q} as cell, {side} as side)"
    cells = F.expr(f"""
        case when _few then array(struct(0L as cell, 0 as side))
             when main then transform(sequence(0L, _of - 1), q -> {cross("pmod(class, _over)", "q", 1)})
             else concat(transform(sequence(0L, _of - 1), q -> {own("pmod(class, _of)", "q")}),
                         transform(sequence(0L, _over - 1), m -> {cross("m", "pmod(class, _of)", 2)})) end""")
    return split.withColumn("_cell", F.explode(cells)).select(*rows.columns, "_cell.cell", "_cell.side")


def _mixed(rows: DataFrame) -> DataFrame:
    """token and several columns on the tokens whose buckets hold more than one component; rows has the hub of the bucket's first row."""
    held = rows.groupBy("token", "component").agg(F.count("*").alias("rows"), F.min("hub").alias("hub"))
    return (held.groupBy("token").agg(F.count("*").alias("components"), F.max(F.struct("rows", "component")).alias("top"),
                                      F.sum("rows").alias("rows"), F.min("hub").alias("hub"))
            .filter("components > 1").select("token", F.col("top.component").alias("main"), F.col("top.rows").alias("bulk"),
                                             (F.col("rows") - F.col("top.rows")).alias("others"), F.col("hub.hub_class").alias("lead")))


def _chained(docs: DataFrame, rows: DataFrame, work: Workspace) -> tuple[DataFrame, list[DataFrame]]:
    """The rows with components joined by chains, and the links that joined them.

    In each round the classes of a bucket stand in the order of a hash of their own, the same in all buckets, and each meets the
    one before it. Of all it meets in any bucket it is compared with the one it meets most often, so near copies out of reach of
    their buckets' leaders at least halve their components in a round, at one pair a row. It goes on while a round
    joins more than ``CHAIN_SHARE`` of what it met; what it leaves is met again in the trees.
    """
    links, name = [], work.number("chain")
    rows = work.save(name, rows)
    for step in range(MOST_CHAINS):
        order = Window.partitionBy("token", "salt").orderBy(F.xxhash64("class", F.lit(step)), "class")
        before = F.lag(F.struct("rep", "class", "n", "component")).over(order)
        met = (rows.withColumn("_before", before).filter("_before.component <> component").select(
            F.col("_before.rep").alias("rep_a"), F.col("_before.class").alias("a"), F.col("_before.n").alias("n_a"),
            F.col("_before.component").alias("of_a"), F.col("rep").alias("rep_b"), F.col("class").alias("b"), F.col("n").alias("n_b"),
            F.col("component").alias("of_b")).filter(_NEAR_SIZES))
        counted = met.groupBy("a", "b").agg(F.count("*").alias("shared"), *[F.min(c).alias(c) for c in ("rep_a", "rep_b", "n_a", "n_b", "of_a", "of_b")])
        counted = work.save(work.number("met"), counted.filter("shared * 20 >= least(n_a, n_b)"))
        pair = F.struct("shared", "a", "b")
        ends = counted.select(F.col("a").alias("end"), pair.alias("pair")).unionByName(counted.select(F.col("b").alias("end"), pair.alias("pair")))
        best = ends.groupBy("end").agg(F.max("pair").alias("best")).select("best.a", "best.b").distinct()
        proposed = work.save(work.number("proposed"), counted.join(best.hint("merge"), ["a", "b"]))
        found = _verified(docs, proposed.select("a", "b", "rep_a", "rep_b"), work)
        joining = work.save(work.number("joining"), proposed.join(found.hint("merge"), ["a", "b"])
                            .groupBy(F.least("of_a", "of_b").alias("low"), F.greatest("of_a", "of_b").alias("high"))
                            .agg(F.min(F.struct("a", "b")).alias("link")).select("low", "high", "link.a", "link.b"))
        links.append(joining.select("a", "b"))
        tried, done = proposed.count(), joining.count()
        if not done:
            break
        moved = work.save(work.number("now"), _hooked(joining))
        last, name = name, work.number("chain")
        rows = work.save(name, rows.join(moved.hint("merge"), F.col("component") == F.col("u"), "left")
                         .withColumn("component", F.coalesce("label", "component")).drop("u", "label"))
        work.remove(last)
        if done < CHAIN_SHARE * tried:
            break
    return rows, links


def _second_pairs(docs: DataFrame, described: DataFrame, buckets: DataFrame, links: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Components of classes in buckets that hold several, pairs of different components from the trees of such buckets, and the
    links found on the way."""
    parts = int(described.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = components(links, work=work)
    rows = (buckets.select("token", "salt", "rep", "class", "n", F.struct("hub_rep", "hub_class").alias("hub"))
            .join(own.hint("merge"), F.col("class") == F.col("node"), "left")
            .withColumn("component", F.coalesce("component", "class")).drop("node"))
    rows = rows.join(_mixed(rows).select("token").hint("merge"), "token", "left_semi")
    rows, more = _chained(docs, rows, work)
    found = rows.groupBy(F.col("class").alias("node")).agg(F.min("component").alias("component"))
    mixed_tokens = work.save("tokens", _mixed(rows))
    # a leader of many rows is split by token, by as much as it has rows
    shares = mixed_tokens.groupBy("lead").agg(F.ceil(F.sum(F.col("bulk") + F.col("others")) / LEADER_ROWS).alias("shares"))
    mixed_tokens = (mixed_tokens.join(shares.hint("merge"), "lead")
                    .withColumn("share", F.pmod(F.xxhash64("token"), F.col("shares")).cast("int")).drop("shares"))
    rows = work.save("mixed", rows.select("token", "rep", "class", "n", "component").join(mixed_tokens.hint("merge"), "token")
                     .withColumn("main", F.col("component") == F.col("main")))
    # how many tokens a class may share at most with others it is not linked with yet
    met = rows.groupBy("class").agg(F.count("*").alias("met"))
    bits = described.filter("n > 0").groupBy("class").agg(F.min("bits").alias("bits")).join(met.hint("merge"), "class")
    sent = (_celled(rows.join(bits.hint("merge"), "class"))
            .select("lead", "share", "token", "cell", "side", "n", "rep", "class", "component", F.col("met").cast("int").alias("met"), "bits"))
    # the tokens two near copies share mostly have one leader, so their pairs are counted before they are shuffled
    cells = sent.repartition(parts, "lead", "share", "cell").sortWithinPartitions("token", "cell", "side", "n", "class").drop("lead", "share")

    names = ("token", "cell", "side", "n", "rep", "class", "component", "met")

    def pairs(column, bits):
        """Runs of pairs. Cells of one leaf are compared all at once, row by row with the rows after; the others by trees."""
        fresh = np.ones(len(column["token"]), bool)
        fresh[1:] = (column["token"][1:] != column["token"][:-1]) | (column["cell"][1:] != column["cell"][:-1])
        begin, of = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        size = np.diff(np.append(begin, len(fresh)))
        leaf = (size <= FANOUT) & (column["side"][begin] == 0)
        small = leaf[of]
        doubled = column["n"] - _ONES[bits].sum(axis=1)
        for step in range(1, FANOUT):
            i = np.flatnonzero(small[:-step] & (of[step:] == of[:-step]))
            i, j = possible(i, i + step, column["n"], bits, doubled, column["component"])
            yield enough(column, i, j)
        for b in np.flatnonzero(~leaf):
            first, last = begin[b], begin[b] + size[b]
            middle = first + int(np.searchsorted(column["side"][first:last], 2))
            sides = [(first, middle), (middle, last)] if column["side"][first] == 1 else [(first, last)]
            if column["side"][first] == 2 or middle == last and len(sides) == 2:
                continue  # the other block is empty
            trees = [_tree(*(x[p:q] for x in (column["n"], bits, column["component"], column["met"]))) for p, q in sides]
            for i, j in _crossed(trees[0], trees[-1]):
                yield enough(column, i + sides[0][0], j + sides[-1][0])

    def enough(column, i, j):
        n = column["n"]
        most = np.minimum(column["met"][i], column["met"][j])
        ok = most + -(-NUMERATOR * np.maximum(n[i], n[j]) // DENOMINATOR) - 1 >= _SHARE * (n[i] + n[j]) - 1e-6
        return [column[c][k] for k in (i[ok], j[ok]) for c in ("rep", "class", "n")]

    def traverse(batches):
        """Whole cells at once; the last one of a batch waits for the next. Equal pairs are counted on the way, and go on
        only at the end or when there are very many different ones."""
        made, size, held = [], 0, None
        for ready in whole(batches):
            for run in pairs(*numbers(ready)):
                made.append([*run, np.ones(len(run[0]), np.int64)])
                size += len(run[0])
                if size >= _COUNTED_AT_ONCE:
                    held = counted(made if held is None else [held, *made])
                    made, size = [], 0
                    if len(held[0]) >= _COUNTED_AT_ONCE:
                        yield batch_of(held)
                        held = None
        if made or held is not None:
            yield batch_of(counted(made if held is None else [held, *made]))

    def whole(batches):
        tail, place = [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            token, cell = batch.column("token").to_numpy(), batch.column("cell").to_numpy()
            others = np.flatnonzero((token != token[-1]) | (cell != cell[-1]))
            last = int(others[-1]) + 1 if len(others) else 0
            if last == 0 and place == (token[-1], cell[-1]):
                tail.append(batch)
                continue
            ready = pa.Table.from_batches([*tail, batch.slice(0, last)]).combine_chunks()
            tail, place = [batch.slice(last)], (token[-1], cell[-1])
            if ready.num_rows:
                yield ready
        if tail:
            yield pa.Table.from_batches(tail).combine_chunks()

    def counted(made):
        """Each pair once, in order of a and b, and how often it was met."""
        rep_a, a, n_a, rep_b, b, n_b, times = (np.concatenate(x) for x in zip(*made))
        swap = a > b
        for x, y in ((rep_a, rep_b), (a, b), (n_a, n_b)):
            x[swap], y[swap] = y[swap].copy(), x[swap].copy()
        order = np.lexsort((b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(times[order], at) if len(at) else times
        return [x[order][at] for x in (rep_a, a, n_a, rep_b, b, n_b)] + [total]

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["rep_a", "a", "n_a", "rep_b", "b", "n_b", "times"])

    def numbers(table):
        packed = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        return {c: table.column(c).to_numpy().astype(np.int64) for c in names}, packed

    return found, _distinct(cells.mapInArrow(lean(traverse), "rep_a long, a long, n_a long, rep_b long, b long, n_b long, times long"), work), more


def linked(docs: DataFrame, work: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, class) and links (a, b) between classes that connect what is connected: at most two for each
    class from the first step, and for each round after it links between components that it joined."""
    work = work or Workspace(docs.sparkSession, "jaccard")
    described = _described(docs, work)
    often = _frequent(described).toPandas()
    frequent = often["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(frequent)
    buckets = _buckets(_prefix_rows(docs, frequent[order], often["tier"].to_numpy(dtype=np.uint64)[order]), work)
    first = _verified(docs, _first_pairs(buckets, work), work)
    found, pairs, more = _second_pairs(docs, described, buckets, first, work)
    work.remove("buckets", "mixed", "tokens", "hubs")
    links = reduce(DataFrame.unionByName, [first, *more, _united(docs, pairs, found, work)])
    return described.filter("token is null").select("doc_id", "n", "class"), links


def _united(docs: DataFrame, pairs: DataFrame, found: DataFrame, work: Workspace) -> DataFrame:
    """Links (a, b) between components, found in rounds.

    Each component proposes its most promising pairs not yet compared, one at first; the pairs proposed are compared, the
    components they join become one, and pairs inside one component need no look any more. Components left apart propose
    more in each round, until no pair is left. So a group in c pieces is joined by about c comparisons, not by one for
    each two pieces, and every pair between components that stay apart is compared once.
    """
    live = work.number("live")
    left = work.save(live, _in_components(pairs, found).filter("of_a <> of_b"))
    links, many = docs.sparkSession.createDataFrame([], "a long, b long"), 1
    while not left.isEmpty():
        ends = left.select(F.col("of_a").alias("of"), "shared", "a", "b").unionByName(left.select(F.col("of_b").alias("of"), "shared", "a", "b"))
        if many == 1:
            chosen = ends.groupBy("of").agg(F.max(F.struct("shared", "a", "b")).alias("best")).select("best.a", "best.b")
        else:
            first = Window.partitionBy("of").orderBy(F.desc("shared"), "a", "b")
            chosen = ends.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= many)
        proposed = work.save(work.number("proposed"), left.join(chosen.select("a", "b").distinct().hint("merge"), ["a", "b"]))
        joining = (proposed.join(_verified(docs, proposed.select("a", "b", "rep_a", "rep_b"), work).hint("merge"), ["a", "b"])
                   .groupBy(F.least("of_a", "of_b").alias("low"), F.greatest("of_a", "of_b").alias("high"))
                   .agg(F.min(F.struct("a", "b")).alias("link")))
        joining = work.save(work.number("joining"), joining.select("low", "high", "link.a", "link.b"))
        links = links.unionByName(joining.select("a", "b"))
        rest = left.join(proposed.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        now = work.save(work.number("now"), _hooked(joining))
        for side in ("of_a", "of_b"):
            moved = now.select(F.col("u").alias(f"_{side}"), F.col("label").alias(f"new_{side}"))
            rest = (rest.join(moved.hint("merge"), F.col(side) == F.col(f"_{side}"), "left")
                    .withColumn(side, F.coalesce(f"new_{side}", side)).drop(f"_{side}", f"new_{side}"))
        before, live = live, work.number("live")
        left = work.save(live, rest.filter("of_a <> of_b"))
        work.remove(before)
        many *= MORE_PROPOSALS
    return links


def _hooked(joining: DataFrame) -> DataFrame:
    """u and label: for each component joined with others (low, high) the least one within two links.

    Most groups come together by this. Where a longer chain does not, its parts go on as several components, and
    a pair between them is compared though it need not be.
    """
    both = joining.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(joining.select(F.col("high").alias("u"), F.col("low").alias("v")))
    near = both.groupBy("u").agg(F.least("u", F.min("v")).alias("label"))
    return both.join(near.withColumnRenamed("u", "v").hint("merge"), "v").groupBy("u").agg(F.min("label").alias("label"))


def _in_components(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs with the components of both classes."""
    for side in ("a", "b"):
        own = found.select(F.col("node").alias(f"node_{side}"), F.col("component").alias(f"of_{side}"))
        pairs = (pairs.join(own.hint("merge"), F.col(side) == F.col(f"node_{side}"), "left").drop(f"node_{side}")
                 .withColumn(f"of_{side}", F.coalesce(f"of_{side}", side)))
    return pairs


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    work = Workspace(docs.sparkSession, "jaccard")
    described, links = linked(docs, work)
    # an empty set is a class of its own for each document; several texts under one id hold all their classes together
    owned = described.filter("n > 0 and doc_id is not null").select("doc_id", "class")
    several = owned.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).filter("a <> z").select("doc_id", "a")
    ties = owned.join(several, "doc_id").select("a", F.col("class").alias("b")).filter("a <> b").distinct()
    found = components(links.unionByName(ties), work=work)
    labelled = (described.filter("n > 0 and doc_id is not null").join(found, F.col("class") == F.col("node"), "left")
                .select("doc_id", F.col("n"), F.coalesce("component", "class").alias("label")))
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = labelled.join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = described.filter("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    result = work.save("result", full.unionByName(empty))
    work.remove_others("result")
    return result


def representatives(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group of near copies, that of the least id; empty texts and null ids stay.

    Of rows that repeat an id the first by text, and then by the other columns, stays.
    """
    keep = join(docs).filter("component_id = doc_id").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).join(keep, F.col("doc_id") == F.col("_kept"), "left_semi")
    first = named.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("_first"))
    one = first.select(*["doc_id" if c == "doc_id" else F.col("_first")[c].alias(c) for c in docs.columns])
    return one.unionByName(docs.filter(F.col("doc_id").isNull()))
