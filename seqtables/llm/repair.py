"""Conversation structure repair by an auction shortest-path algorithm.

A conversation's rows, in order of turn, form a lattice: a node is a number of rows read and a state (nothing yet, after
a system row, after a user row, after an assistant row); its arcs are the edits Delete, Insert, Keep and Rerole with
their integer costs, and every path to an accepted end is a repair. Node prices start at 0 and never exceed the cost
of an arc plus the price of its head. From an origin a path is extended along an arc whose price holds with equality, and
where none does, the price of its last node rises to the least one and the path is contracted by it. Origins are taken
from the end backwards, so a path ends at the first node whose price is final. The converged prices are
the least costs to the end; the arcs that hold with equality are all arcs of cheapest repairs, and following the least
letter among them spells the first of the cheapest edit sequences.

A conversation is read in blocks of rows of the sorted table, each by some task. Blocks of longer conversations give
the cost from each state before to each state after them, again by auctions; these lattices of blocks, grouped by
``FAN`` level upon level, give each block the prices behind it and the state before it. So no task holds more than a
block or a group of blocks, however long the conversation. What the result holds for one conversation (its audit, and the
digest over its repaired text, which reads it from front to end) is one value of one row.

Defined cases: null conv_ids are one conversation; a null turn comes first; a null role or text is one space; rows of
one turn come by role and then by the text's SHA-256, so repeated rows stand side by side and the first of them is the
original; a role that begins with none of s, u and a (an empty one, too) can only be changed or deleted; a conversation
without rows has no edits; an empty table gives no rows. Columns other than conv_id, turn, role and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtables.llm.common import Workspace

#: Rows of a block, as a power of two, and blocks or groups of blocks that are read together.
BLOCK_BITS = 10
FAN = 64
REMEMBERED = 100_000

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
NEVER = 1 << 60
FRESH, SYSTEM, USER, ASSISTANT = range(4)
#: Least cost to end after the last row, by state, and the edits that do it.
ENDS = (0, 2 * INSERT, INSERT, 0)
CLOSING = ("", "II", "I", "")
NAMES = {USER: "user", ASSISTANT: "assistant"}
_CLASSES = "sua"
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_SPACES = " \t\n\x0b\f\r"


def _next(state: int) -> int:
    """The state that an inserted or changed row leads to."""
    return ASSISTANT if state == USER else USER


def _arcs() -> list[list[list[tuple[str, int, int]]]]:
    """By code and state: the edits in ASCII order with the step to the node they lead to and their cost.

    A code is three times the role's class (s, u, a, other) plus 0 for a sound row, 1 for a cut-off one, 2 for one that must go.
    """
    table = []
    for code in range(12):
        role, fault = divmod(code, 3)
        rows = []
        for state in range(4):
            arcs = [("D", 4, DELETE), ("I", _next(state) - state, INSERT)]
            if fault < 2:
                more = CUT_OFF * fault
                if (role == 0 and state == FRESH) or (role == 1 and state != USER) or (role == 2 and state == USER):
                    arcs.append(("K", 4 + role + 1 - state, KEEP + more))
                arcs.append(("R", 4 + _next(state) - state, REROLE + more))
            rows.append(arcs)
        table.append(rows)
    return table


ARCS = _arcs()


def row_layers(codes: str):
    return [ARCS[ord(c) - 97] for c in codes]


def block_layers(matrices):
    """One layer a block: from each state to each, at the cost of the block's matrix."""
    return [[[("", 4 + e - q, m[4 * q + e]) for e in range(4) if m[4 * q + e] < NEVER] for q in range(4)] for m in matrices]


def converged(layers, after) -> list[int]:
    """The prices of all nodes, where the nodes behind the last layer have the prices ``after``."""
    count = 4 * len(layers)
    price, final = [0] * count + list(after), bytearray(count) + b"\1\1\1\1"
    if after[USER] >= NEVER and after[ASSISTANT] >= NEVER:  # no edit leads back from these two
        for v in range(0, count, 4):
            price[v + USER] = price[v + ASSISTANT] = NEVER
            final[v + USER] = final[v + ASSISTANT] = 1
    for origin in range(count - 1, -1, -1):
        path = [] if final[origin] else [origin]
        while path:
            v = path[-1]
            best, head = NEVER, -1
            for _, step, cost in layers[v >> 2][v & 3]:
                if cost + price[v + step] < best:
                    best, head = cost + price[v + step], v + step
            if head < 0:
                price[v], final[v] = NEVER, 1
                path.pop()
            elif price[v] < best:
                price[v] = best
                if v != origin:
                    path.pop()
            elif final[head]:
                for x in path:
                    final[x] = 1
                path = []
            else:
                path.append(head)
    return price


def traced(layers, price, state: int) -> tuple[str, int, int] | None:
    """Along tight arcs of the least letters: the edits, their cost and the state at the end; None where no path leads."""
    v, count, edits, total = state, 4 * len(layers), [], 0
    while v < count:
        if price[v] >= NEVER:
            return None
        edit, step, cost = next(a for a in layers[v >> 2][v & 3] if a[2] + price[v + a[1]] == price[v])
        edits.append(edit)
        total, v = total + cost, v + step
    return ("".join(edits), total, v - count) if price[v] < NEVER else None


def _illegal(codes: str, before: int) -> int:
    """Adjacent rows that may not follow each other; ``before`` is the class of the row in front, -1 for none."""
    classes = [before] + [(ord(c) - 97) // 3 for c in codes]
    return sum(a >= 0 and (a, b) not in _LEGAL for a, b in zip(classes, classes[1:]))


def _goals():
    return [[0 if q == e else NEVER for q in range(4)] for e in range(4)]


def matrix(layers) -> list[int]:
    """Least costs from each state before to each state behind the layers."""
    columns = [converged(layers, goal)[:4] for goal in _goals()]
    return [columns[e][q] for q in range(4) for e in range(4)]


def _walk_prices(matrices, after):
    price = converged(block_layers(matrices), after)
    return [price[4 * i + 4:4 * i + 8] for i in range(len(matrices))]


def _fold_states(maps):
    ends = list(range(4))
    for m in maps:
        ends = [m[q] if q >= 0 else -1 for q in ends]
    return [*ends, maps[-1][4]]


def _walk_states(maps, seed):
    seeds = [list(seed)]
    for m in maps[:-1]:
        seeds.append([m[seeds[-1][0]], m[4]])
    return seeds


# --- relations --------------------------------------------------------------------------------

def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which null keys are equal."""
    other = right.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"_{k}"])
    return left.join(other, on, how).drop(*[f"_{k}" for k in keys])


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, chosen by a checksum of conversation and turn, and whether the row is there at all."""
    mark = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                                (F.crc32(mark.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def plain(conversations: DataFrame) -> DataFrame:
    """The rows as they are, each once."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                                F.lit(1).alias("copies"))


_ORDER = ["conv_id", "turn", "role", "digest"]


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.filter("copies > 0").withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _faults(rows: DataFrame) -> DataFrame:
    """One row for each different row of a conversation and turn: how often it stands there, and its faults."""
    tail = F.right(F.rtrim(F.col("text"), F.lit(_SPACES)), F.lit(1))
    slim = _with_digest(rows).select(*_ORDER, "copies", (tail == "").alias("blank"), (~tail.isin("", ".", "!", "?")).alias("cut"))
    folded = slim.groupBy(*_ORDER, "blank", "cut").agg(F.sum("copies").cast("long").alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeated = (folded.filter("not blank").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("place"), F.count("*").alias("places"))
                .filter("places > 1").select("conv_id", "role", "digest", F.col("place.turn").alias("first_turn"), F.lit(True).alias("again")))
    marked = null_safe(folded, repeated, ["conv_id", "role", "digest"], "left")
    return marked.select(*_ORDER, "copies", "blank", "cut",
                         (F.coalesce("again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))).alias("seen"))


def _code(copy: Column) -> Column:
    role = F.instr(F.lit(_CLASSES), F.left("role", F.lit(1)))
    role = F.when((F.col("role") == "") | (role == 0), 3).otherwise(role - 1)
    fault = F.when(F.col("blank") | F.col("seen") | (copy > 1), 2).when(F.col("cut"), 1).otherwise(0)
    return F.char(97 + 3 * role + fault)


def _counts(faults: DataFrame) -> DataFrame:
    """By conversation: rows of each fault and turns that are missing between the first and the last one."""
    said, first = ~F.col("blank"), F.when(F.col("seen"), 0).otherwise(1)
    turns = faults.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(said, F.col("copies") - first).otherwise(0)).alias("duplicate"),
        F.sum(F.when(said & F.col("cut"), first).otherwise(0)).alias("truncated"))
    whole = "decimal(20,0)"
    gaps = F.max("turn").cast(whole) - F.min("turn").cast(whole) + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(
        F.coalesce(gaps.try_cast("long"), F.when(F.count("turn") == 0, 0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def _mapped(rows: DataFrame, kept: list[str], read: list[str], made: dict[str, tuple[str, pa.DataType]], one: Callable) -> DataFrame:
    """The kept columns and what ``one`` gives for the read ones of each row; a result of None drops the row."""
    def run(batches):
        for batch in batches:
            found = [one(*values) for values in zip(*(batch.column(c).to_pylist() for c in read))]
            some = pa.array([x is not None for x in found], pa.bool_())
            columns = [batch.column(c).filter(some) for c in kept]
            found = [x for x in found if x is not None]
            columns += [pa.array([x[i] for x in found], kind) for i, (_, kind) in enumerate(made.values())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *made])

    schema = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept] + [f"{c} {t}" for c, (t, _) in made.items()]
    return rows.select(*dict.fromkeys(kept + read)).mapInArrow(run, ", ".join(schema))


_LONGS = ("array<long>", pa.list_(pa.int64()))


def _carried(work: Workspace, name: str, nodes: DataFrame, fold: Callable, walk: Callable, seed: list[int], fan: int) -> DataFrame:
    """conv_id, node and the seed of each node (conv_id, node, value): its conversation's seed carried over the nodes to it.

    Groups of nodes are folded to one, level upon level, until a conversation has no more than ``fan``; then seeds are
    carried down again.
    """
    most = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    bits = fan.bit_length() - 1
    group = F.shiftright("node", bits) if most > fan else F.lit(0).cast("long")
    groups = (nodes.groupBy("conv_id", group.alias("parent")).agg(F.array_sort(F.collect_list(F.struct("node", "value"))).alias("list"))
              .select("conv_id", "parent", F.col("list.node").alias("nodes"), F.col("list.value").alias("values")))
    if most > fan:
        groups = work.save(f"{name}-{most}", groups)
        above = _mapped(groups, ["conv_id", "parent"], ["values"], {"value": _LONGS}, lambda values: (fold(values),))
        above = work.save(f"{name}-{most}-folded", above.withColumnRenamed("parent", "node"))
        seeds = _carried(work, name, above, fold, walk, seed, fan).withColumnRenamed("node", "parent")
        groups = null_safe(groups, seeds, ["conv_id", "parent"])
    else:
        groups = groups.withColumn("seed", F.array(*[F.lit(x).cast("long") for x in seed]))
    found = _mapped(groups, ["conv_id", "nodes"], ["values", "seed"], {"seeds": ("array<array<long>>", pa.list_(_LONGS[1]))},
                    lambda values, given: (walk(values, given),))
    return found.select("conv_id", F.explode(F.arrays_zip("nodes", "seeds")).alias("x")).select("conv_id", F.col("x.nodes").alias("node"), F.col("x.seeds").alias("seed"))


def audits(work: Workspace, faults: DataFrame, block_bits: int = BLOCK_BITS, fan: int = FAN) -> DataFrame:
    """conv_id, node, edits, cost and illegal pairs of each block of rows; the blocks of a conversation in order of node."""
    parts = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    rows = faults.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    order = [*_ORDER, "copy"]
    rows = (rows.select(*order, _code(F.col("copy")).alias("code")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .select("conv_id", "code", F.monotonically_increasing_id().alias("place")))
    rows = work.save("rows", rows)
    blocks = (rows.groupBy("conv_id", F.shiftright("place", block_bits).alias("node"))
              .agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("list"))
              .select("conv_id", "node", F.array_join("list.code", "").alias("codes")))
    sizes = blocks.groupBy("conv_id").agg(F.count("*").alias("blocks"), F.max("node").alias("last"))
    blocks = work.save("blocks", null_safe(blocks, sizes, ["conv_id"]))
    many = blocks.filter("blocks > 1")

    matrices = work.save("matrices", _mapped(many, ["conv_id", "node"], ["codes"], {"value": _LONGS}, lambda c: (matrix(row_layers(c)),)))
    after = _carried(work, "prices", matrices, lambda m: matrix(block_layers(m)), _walk_prices, list(ENDS), fan)
    after = work.save("after", after.withColumnRenamed("seed", "after"))

    def ends(codes, prices):
        layers = row_layers(codes)
        price = converged(layers, prices)
        paths = [traced(layers, price, q) for q in range(4)]
        return [p[2] if p else -1 for p in paths] + [(ord(codes[-1]) - 97) // 3],

    known = null_safe(many, after, ["conv_id", "node"])
    maps = work.save("maps", _mapped(known, ["conv_id", "node"], ["codes", "after"], {"value": _LONGS}, ends))
    start = _carried(work, "states", maps, _fold_states, _walk_states, [FRESH, -1], fan).withColumnRenamed("seed", "start")
    known = null_safe(known, work.save("start", start), ["conv_id", "node"])
    known = known.unionByName(blocks.filter("blocks = 1").withColumn("after", F.array(*[F.lit(x).cast("long") for x in ENDS]))
                              .withColumn("start", F.array(F.lit(FRESH).cast("long"), F.lit(-1).cast("long"))))
    remembered: dict = {}

    def edits(codes, prices, begin, is_last):
        key = (codes, *prices, *begin, is_last)
        if key not in remembered:
            if len(remembered) >= REMEMBERED:
                remembered.clear()
            layers = row_layers(codes)
            found, cost, end = traced(layers, converged(layers, prices), begin[0])
            if is_last:
                found, cost = found + CLOSING[end], cost + ENDS[end]
            remembered[key] = (found, cost, _illegal(codes, begin[1]))
        return remembered[key]

    return _mapped(known.withColumn("is_last", F.col("node") == F.col("last")), ["conv_id", "node"], ["codes", "after", "start", "is_last"],
                   {"edits": ("string", pa.string()), "cost": ("long", pa.int64()), "illegal": ("long", pa.int64())}, edits)


def _edited(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """Each conversation's edits and then its rows in order, side by side in one partition."""
    texts = _with_digest(rows).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    none = {"edits": "string", "turn": texts.schema["turn"].dataType, "role": "string", "text": "string", "digest": "binary"}
    both = (texts.withColumn("edits", F.lit(None).cast("string")).select("conv_id", "edits", "turn", "role", "digest", "text")
            .unionByName(whole.select("conv_id", "edits", *[F.lit(None).cast(t).alias(c) for c, t in none.items() if c != "edits"])))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (both.repartition(parts, "conv_id")
            .sortWithinPartitions("conv_id", F.col("edits").isNull(), "turn", "role", "digest").select("conv_id", "edits", "turn", "role", "text"))


def _replayed(batches):
    """(conv_id, turn, edit, role, text) of each edit in order, and (conv_id, None, None, None, None) before each conversation."""
    conv, edits, at, state = None, "", 0, FRESH

    def inserted():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            at, state = at + 1, _next(state)
            yield conv, None, "I", NAMES[state], ""

    for batch in batches:
        for found, header, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edits", "turn", "role", "text"))):
            if header is not None:
                yield from inserted()
                conv, edits, at, state = found, header, 0, FRESH
                yield conv, None, None, None, None
                continue
            yield from inserted()
            edit, at = edits[at], at + 1
            if edit == "K":
                state = _CLASSES.index(role[0]) + 1
            elif edit == "R":
                state = _next(state)
                role = NAMES[state]
            yield conv, turn, edit, role, text
    yield from inserted()


def _whole(blocks: DataFrame) -> DataFrame:
    listed = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("node", "edits"))).alias("list"),
                                           F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    return listed.select("conv_id", F.array_join("list.edits", "").alias("edits"), "cost", "illegal")


def repaired(rows: DataFrame, block_bits: int = BLOCK_BITS, fan: int = FAN) -> DataFrame:
    """conv_id, position (from 0), turn (null for inserted rows), edit, role, text: the repaired conversations.

    ``rows`` are those of ``plain`` or ``damaged``.
    """
    work = Workspace(rows.sparkSession, "repair")
    whole = work.save("edits", _whole(audits(work, work.save("faults", _faults(rows)), block_bits, fan)))
    stream = _edited(rows, whole)
    kinds = {c: stream.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def run(batches):
        def batch(held):
            return pa.RecordBatch.from_pylist(held, schema)

        def typed(source):
            nonlocal schema
            for b in source:
                schema = pa.schema([("conv_id", b.column("conv_id").type), ("position", pa.int64()), ("turn", b.column("turn").type),
                                    ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
                yield b

        schema, held, size, position = None, [], 0, 0
        for conv, turn, edit, role, text in _replayed(typed(batches)):
            if edit is None:
                position = 0
            elif edit != "D":
                held.append({"conv_id": conv, "position": position, "turn": turn, "edit": edit, "role": role, "text": text})
                position, size = position + 1, size + len(text)
                if len(held) >= 1 << 14 or size >= 1 << 22:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    return stream.mapInArrow(run, f"conv_id {kinds['conv_id']}, position long, turn {kinds['turn']}, edit string, role string, text string")


def _digests(stream: DataFrame) -> DataFrame:
    """conv_id and the digest of its repaired rows, each written role:text, a line each."""
    def run(batches):
        kind, conv, digest, begun, done = None, None, None, False, []

        def typed(source):
            nonlocal kind
            for b in source:
                kind = b.column("conv_id").type
                yield b

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([d for _, d in done])], ["conv_id", "repaired_sha256"])

        for found, _, edit, role, text in _replayed(typed(batches)):
            if edit is None:
                if digest:
                    done.append((conv, digest.hexdigest()))
                    if len(done) >= 1 << 14:
                        yield batch()
                        done = []
                conv, digest, begun = found, hashlib.sha256(), False
            elif edit != "D":
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        if digest:
            done.append((conv, digest.hexdigest()))
            yield batch()

    return stream.mapInArrow(run, f"conv_id {stream.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def audit(rows: DataFrame, block_bits: int = BLOCK_BITS, fan: int = FAN) -> DataFrame:
    """A row for each conversation, those without rows included: its faults, and the cheapest repair.

    ``rows`` are those of ``plain`` or ``damaged``.
    """
    work = Workspace(rows.sparkSession, "repair")
    faults = work.save("faults", _faults(rows))
    whole = work.save("edits", _whole(audits(work, faults, block_bits, fan)))
    parts = [rows.select("conv_id").distinct(), _counts(faults), whole, _digests(_edited(rows, whole))]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    number = lambda c: F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c)
    one = lambda c: F.first(c, ignorenulls=True)
    return every.groupBy("conv_id").agg(
        number("gaps"), number("blank"), number("duplicate"), number("truncated"), number("illegal"), number("cost"),
        F.coalesce(one("edits"), F.lit("")).alias("audit"),
        F.coalesce(one("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
