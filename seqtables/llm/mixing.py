"""Mixing sources to target weights.

Tokens are summed per source, the source's repetition rate follows from its target, and each document is
taken floor(rate) times plus once more with probability equal to the rate's fraction, decided by a digest of
its id. Everything is DataFrame functions.

Of ``SEEDS`` digest seeds each source uses the one whose taken words come nearest to its target. In a source of many
documents this leaves each document's chance at about the rate's fraction and takes away the miss that one seed has by
chance. In a source of a few documents the choice is near to a rounding of its target: a source of one document of rate 0.4
is always left out, and one of 1.6 always taken twice. With ``seeds=1`` the draw is one plain Bernoulli trial a document.

Defined cases: null text has size 0 and null source is a source of its own, last in order; a source without
words has target 0 and takes nothing; null ids draw as the empty text; repeated rows each count, and as they
share an id they share the draw; an empty table gives no rows. Columns besides the three named are kept by
``mixed_documents`` whatever their names, as nothing is added to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtables.llm.common import saved

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEEDS = 32


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of each document."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select("doc_id", "source", F.coalesce(words.cast("long"), F.lit(0).cast("long")).alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source with its size and target.

    Resharing what exceeds a source's most, over and over, ends at one water level: each target is the lesser
    of the most and level times weight. The level is found among the sources in order of most per weight.
    The windows run over one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.row_number().over(ordered) - 1) % len(weights) + 1)
    weighed = per_source.withColumns({"weight": cycle, "most": F.col("source_size") * float(most)})
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = weighed.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    return (levels.withColumn("water", F.coalesce(F.first(fits, ignorenulls=True).over(every), F.lit(0.0)))
            .select("source", "source_size", F.least(F.col("most"), F.col("water") * F.col("weight")).alias("target")))


def draw(seed: int):
    """A number in [0, 1) from the document's id: eight hex digits of a digest, four seeds in each digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed // 4)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1 + 8 * (seed % 4), 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seeds: int = SEEDS) -> DataFrame:
    """One row per source: size, target, whole copies, fraction and the seed it draws with."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets(sized, weights, most).withColumn("rate", rate).withColumns({
        "whole": F.floor("rate").cast("long"), "fraction": F.col("rate") - F.floor("rate")})
    tried = (_join(sized, plan.select("source", "fraction"))
             .groupBy("source")
             .agg(*[F.sum(F.when(draw(k) < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"drawn_{k}") for k in range(seeds)]))
    tried = tried.select("source", F.array(*[F.col(f"drawn_{k}") for k in range(seeds)]).alias("drawn"))
    miss = F.transform("drawn", lambda x: F.abs(F.col("source_size") * F.col("whole") + x - F.col("target")))
    return (_join(plan, tried).withColumn("missed", miss)
            .withColumn("seed", (F.array_position("missed", F.array_min("missed")) - 1).cast("int"))
            .select("source", "source_size", "target", "whole", "fraction", "seed"))


def _join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on source, where null is a source too."""
    renamed = right.withColumnRenamed("source", "_other_source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("_other_source"))).drop("_other_source")


def _copies(seeds: int):
    own = F.element_at(F.array(*[draw(k) for k in range(seeds)]), F.col("seed") + 1)
    return F.col("whole") + F.when(own < F.col("fraction"), 1).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seeds: int = SEEDS) -> DataFrame:
    """One row per document: its size, its source's size and target, the copies and the words taken."""
    sized = saved(sizes(docs), "sizes")
    return (_join(sized, rates(sized, weights, most, seeds))
            .withColumn("copies", _copies(seeds))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "copies"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seeds: int = SEEDS) -> DataFrame:
    """The documents as the mix has them: each row as often as it is taken, with its own columns."""
    names = [c for c in docs.columns]
    plan = rates(saved(sizes(docs), "sizes"), weights, most, seeds)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "doc_id", "source")
    return (_join(kept, plan).withColumn("copies", _copies(seeds)).filter("copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
            .select("_row.*"))


def oracle(seeds: int = SEEDS) -> str:
    """DuckDB SQL for the mix of ``documents``."""
    drawn = ", ".join(
        f"(('0x' || substr(md5('{k // 4}:' || coalesce(cast(doc_id as varchar), '')), {1 + 8 * (k % 4)}, 8))::UBIGINT)::DOUBLE / 4294967296.0"
        for k in range(seeds))
    return f"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT as size, [{drawn}] as u
  from documents),
per_source as (
  select source, sum(size)::BIGINT as source_size,
         [1.0, 2.0, 3.0][1 + (row_number() over (order by source asc nulls last) - 1) % 3]::DOUBLE as weight
  from sized group by source),
candidates as (
  select p.*, 3.0::DOUBLE * source_size as most from per_source p),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, source nulls last
               rows between unbounded preceding and 1 preceding), 0))::DOUBLE
            / sum(weight) over (order by most / weight, source nulls last rows between current row and unbounded following) as level,
         row_number() over (order by most / weight, source nulls last) as rank
  from candidates),
water as (select coalesce(arg_min(level, rank), 0)::DOUBLE as water from levels where level <= most / weight),
planned as (
  select source, source_size, least(most, water * weight)::DOUBLE as target,
         case when source_size > 0 then least(most, water * weight) / source_size else 0 end::DOUBLE as rate
  from levels, water),
tried as (
  select p.source, i as seed, sum(case when u[i + 1] < rate - floor(rate) then size else 0 end) as drawn
  from sized s join planned p on s.source is not distinct from p.source, range({seeds}) r(i) group by all),
chosen as (
  select p.source, arg_min(t.seed, (abs(p.source_size * floor(p.rate) + t.drawn - p.target), t.seed)) as seed
  from planned p join tried t on p.source is not distinct from t.source group by all)
select s.doc_id, s.size, p.source_size, p.target,
       (s.size * (floor(p.rate)::BIGINT + case when s.u[c.seed + 1] < p.rate - floor(p.rate) then 1 else 0 end))::BIGINT as taken,
       (floor(p.rate)::BIGINT + case when s.u[c.seed + 1] < p.rate - floor(p.rate) then 1 else 0 end)::BIGINT as copies
from sized s join planned p on s.source is not distinct from p.source join chosen c on s.source is not distinct from c.source
"""
