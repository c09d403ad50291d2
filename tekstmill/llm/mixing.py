"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected as often as the source's target has words for each of its own. The expected
copies are summed up along the source (documents by size, largest first, then by id), one random offset per source is
added, and a document is emitted once for each integer that its interval of the sum passes. Sizes close to each other
share a stretch of the sum, so the words taken differ from the target by about the largest document at most. As that
is much in a small source, several offsets are drawn and the one whose words come nearest to the target is added.

The running sum needs no task that sees a whole source: rows are range partitioned and sorted, a row's place in its
partition is counted while it is written, and the partitions' row counts, one small row each, are summed up.

Inputs: NULL and empty texts have size 0; they take a place in the sum and may be emitted, with no words. The NULL
source is a source of its own, the last one. Repeated rows are sampled each by itself. A NULL id sorts last among equal
sizes. An empty table or one without any word has targets of 0 and emits nothing. Extra columns pass through; those
named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut_lineage, read_table

SIZE_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
# No document is emitted more often than this.
MOST_COPIES = 3
SEED = "mix-1"
# Random offsets drawn per source.
DRAWS = 16
ROW_BITS = 33


def text_size(text: str = "text") -> Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SIZE_PATTERN)), F.lit(0)).cast("bigint")


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: a row's place, from 0, in the order of all rows.

    The table is written with each row's partition and place in it (the two parts of Spark's own row id after a
    range shuffle and a sort), then the rows before each partition are added from one row per partition.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = cut_lineage(placed, "placed")
    part = F.shiftright("__at", ROW_BITS)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # As many rows as there are partitions.
    joined = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    place = F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return joined.withColumn(name, F.col("__before") + place).drop("__at", "__part", "__before")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, n_docs, source_size); sources by code point, NULL last.

    Sources share all words by weight. A target stops at ``most`` times its source; what is left over is shared
    by weight among the others until none is above. Each round is one sum over the sources.
    """
    ordered = global_rank(sizes, [F.col("source").asc_nulls_last()], "__k")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__k") % len(weights) + 1).cast("int"))
    ordered = cut_lineage(ordered.withColumn("weight", weight.cast("bigint")), "sources")
    limit = F.col("source_size") * most
    level: float | None = None
    while True:
        # A share above its limit stays above it, as later rounds only raise the shares of the others.
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        totals = ordered.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, limit).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)).alias("open"),
        ).first()
        new = (totals["all"] - totals["full"]) / totals["open"] if totals["open"] else level
        if new is None or new == level:
            break
        level = new
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(float(level or 0.0)))
    return ordered.select("source", "source_size", "n_docs", target.alias("target"), F.col("__k").alias("source_no"))


def _offset(source: Column, seed: str, draw: int) -> Column:
    """A number in [0, 1) that depends on the seed, the draw and the source alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{draw}:"), F.coalesce(source, F.lit("\u0000"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def _taken(offset: Column) -> Column:
    """Integers passed by a row's interval of the running sum."""
    step = F.col("__rank") - F.col("first")
    return F.floor((step + 1) * F.col("rate") + offset) - F.floor(step * F.col("rate") + offset)


def plan_mix(
    docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED, carry: list[str] | None = None,
) -> DataFrame:
    """The ``carry`` columns (all of ``docs`` by default) with ``size``, ``source_size``, ``target`` and ``copies``."""
    outputs = {"size", "source_size", "target", "copies"}
    carried = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    key = F.col(source).cast("string")
    sized = docs.select(*carried, key.alias("__source"), F.col(doc_id).alias("__id"), text_size(text).alias("size"))
    order = [F.col("__source").asc_nulls_last(), F.col("size").desc(), F.col("__id").asc_nulls_last()]
    ranked = cut_lineage(global_rank(sized, order, "__rank"), "ranked")
    by_source = ranked.groupBy("__source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"), F.min("__rank").alias("first")
    )
    by_source = cut_lineage(by_source.withColumnRenamed("__source", "source"), "by-source")
    firsts = by_source.select(F.col("source").alias("__s"), "first")
    targets = source_targets(by_source.select("source", "n_docs", "source_size"), weights, most)
    targets = targets.join(firsts, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Written, so that Spark knows its true size when it plans the joins with the documents.
    targets = cut_lineage(targets.withColumn("rate", rate).withColumnRenamed("source", "__s"), "targets")
    same = F.col("__source").eqNullSafe(F.col("__s"))
    draws = [_offset(F.col("__s"), seed, k) for k in range(DRAWS)]
    words = [F.sum(_taken(F.col("u")[k]) * F.col("size")).alias(f"w{k}") for k in range(DRAWS)]
    tried = ranked.join(targets.withColumn("u", F.array(*draws)), same).groupBy("__s", "target").agg(*words)
    miss = [F.struct(F.abs(F.col(f"w{k}") - F.col("target")), F.lit(k).alias("k")) for k in range(DRAWS)]
    best = tried.select(F.col("__s").alias("__b"), F.array_min(F.array(*miss))["k"].alias("k"))
    drawn = targets.join(best, F.col("__s").eqNullSafe(F.col("__b"))).withColumn("offset", F.array(*draws)[F.col("k")])
    drawn = cut_lineage(drawn.drop("__b", "k"), "drawn")
    joined = ranked.join(drawn, same)
    return joined.select(*carried, "size", "source_size", "target", _taken(F.col("offset")).alias("copies"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    columns = docs.columns
    hidden = docs.toDF(*[f"__in{i}" for i in range(len(columns))])
    place = {c: f"__in{i}" for i, c in enumerate(columns)}
    named = {k: place[options.pop(k, k)] for k in ("source", "text", "doc_id")}
    planned = plan_mix(hidden, **named, **options)
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    repeated = planned.filter(F.col("copies") > 0).withColumn("__copy", times)
    return repeated.select(*[F.col(v).alias(k) for k, v in place.items()])


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    planned = plan_mix(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


OP4_SQL = r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
),
ranked as (
    select *, row_number() over (partition by source order by size desc, doc_id asc nulls last) - 1 as step from sized
),
sources as (
    select source, sum(size)::bigint as source_size,
        (row_number() over (order by source asc nulls last) - 1) % 3 + 1 as weight
    from sized group by source
),
levels as (
    -- with the sources by how early they are full, the level that holds if those before are full
    select *, source_size * 3.0 / weight as filled_at,
        coalesce(sum(source_size * 3) over before, 0)::bigint as full_before,
        (sum(weight) over () - coalesce(sum(weight) over before, 0))::bigint as open_weight,
        (sum(source_size) over ())::bigint as all_words
    from sources
    window before as (order by source_size * 3.0 / weight, source rows between unbounded preceding and 1 preceding)
),
chosen as (
    select (all_words - full_before)::double / open_weight as level from levels
    where (all_words - full_before)::double / open_weight <= filled_at order by filled_at limit 1
),
targets as (
    select *, case when source_size > 0 then target / source_size else 0 end as rate from (
        select source, source_size,
            least(source_size * 3::double, weight * coalesce((select level from chosen), 0)) as target
        from sources
    )
),
draws as (
    select t.*, k, ('0x' || substr(md5('mix-1:' || k || ':' || coalesce(source, chr(0))), 1, 8))::bigint
        / 4294967296.0::double as u
    from targets t, range(16) r(k)
),
tried as (
    select r.source, k, any_value(u) as u, any_value(target) as target,
        sum((floor((step + 1) * rate + u) - floor(step * rate + u)) * size) as words
    from ranked r join draws d on r.source is not distinct from d.source group by r.source, k
),
best as (
    select * from tried qualify row_number() over (partition by source order by abs(words - target), k) = 1
)
select r.doc_id, r.size, t.source_size, t.target,
    ((floor((step + 1) * rate + u) - floor(step * rate + u)) * size)::bigint as taken
from ranked r
join targets t on r.source is not distinct from t.source
join best b on r.source is not distinct from b.source
"""
