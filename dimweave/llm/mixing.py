"""Mixing sources to target weights by hash thresholds, without sorting documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.llm.common import hide, table, word_count, work_folder, written

#: Bits of the hash that one histogram resolves, and how many histograms refine each other.
BITS, LEVELS = 10, 4


def targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """(source, source_size) to the same with `target`: a row per source, sources in order of code points.

    The sources, null last, take the weights in turn and share `share` times all sizes by weight. A
    target stops at `most` times its source's size and what is over goes to the others by weight, until
    no target is above. That fixed point gives each source min(most * size, level * weight) with one
    level for all: sources fill up in ascending order of size per weight, so running sums find it.
    A source of size 0 gets 0.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1)
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("budget"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    ).withColumn("level", (F.col("budget") - F.col("full")) / F.col("open"))
    # The first source that its level does not fill has the level of all that follow.
    unfilled = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(unfilled, ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight")))
    return levels.select("source", "source_size", target.alias("target"))


def _bucket(level: int) -> Column:
    """The hash's bits above those of `level`, and that level's: a number that nests in the one before."""
    return F.shiftrightunsigned("_hash", 64 - BITS * (level + 1))


def row_hash(key: str = "doc_id", text: str = "text") -> Column:
    """The hash that decides which rows are taken once more: the same in every run and partition."""
    return F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))


def plan_mix(rows: DataFrame, folder: str, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target, rounds, at) of (source, size, _hash): how often a source is taken.

    Each source takes whole `rounds` of its rows as often as its target allows. For the rest, rows whose
    hash lies below a threshold are taken once more: a histogram of sizes by source and hash bucket
    finds the bucket in which the budget ends, the next histogram splits only that bucket, and so on;
    in the last one the whole boundary bucket counts if that comes nearer the target. `at` is that
    threshold. One row per source and at most 2 ** BITS buckets of it meet in a task; rows never do.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.col("target") - F.col("rounds") * F.col("source_size")
    plan = targets(sizes, weights, share, most).withColumn("rounds", rounds.cast("long"))
    plan = written(plan.select("*", left.alias("left"), F.lit(0).cast("long").alias("at")), f"{folder}/plan0")
    same = F.col("r.source").eqNullSafe(F.col("p.source"))
    for level in range(LEVELS):
        inside = rows.where("size > 0").alias("r").join(plan.where("left > 0").alias("p"), same)
        if level:  # only rows of the boundary bucket of the level before
            inside = inside.where(_bucket(level - 1) == F.col("at"))
        sums = inside.groupBy("r.source", _bucket(level).alias("bucket")).agg(
            F.sum("r.size").alias("held"), F.first("p.left").alias("left")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        rest = (F.col("left") - F.col("upto") + F.col("held")).alias("rest")
        ends = (
            sums.withColumn("upto", F.sum("held").over(running))
            .where(F.col("upto") > F.col("left"))
            .groupBy("source")
            .agg(F.min_by(F.struct("bucket", rest, "held"), "bucket").alias("end"))
        )
        more = F.lit(level == LEVELS - 1) & (F.col("e.end.held") < 2 * F.col("e.end.rest"))
        # Without a boundary the budget outlasts the bucket, or there is none: the threshold is its end or start.
        open_end = F.when(F.col("p.left") > 0, F.shiftleft(F.col("p.at") + 1, BITS) if level else F.lit(1 << BITS))
        at = F.coalesce(F.col("e.end.bucket") + more.cast("long"), open_end, F.shiftleft(F.col("p.at"), BITS))
        plan = plan.alias("p").join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        plan = plan.select(
            "p.source", "p.source_size", "p.target", "p.rounds",
            F.coalesce(F.col("e.end.rest"), F.lit(0.0)).alias("left"), at.cast("long").alias("at"),
        )
        plan = written(plan, f"{folder}/plan{level + 1}")
    return plan.drop("left")


def times(size: Column) -> Column:
    """How often a row is taken, beside its plan and `_hash`; never for a row of size 0."""
    return F.when(size > 0, F.col("p.rounds") + (_bucket(LEVELS - 1) < F.col("p.at")).cast("long")).otherwise(0)


RESULTS = ("_hash", "size", "source_size", "target", "taken")


def mix(
    df: DataFrame,
    size: Column,
    folder: str,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    text: str = "text",
) -> DataFrame:
    """Rows of `df` (without `text`) with size, source_size, target (their source's) and taken (words the mix takes).

    A null source is a source of its own; null and empty texts have size 0 and take nothing; repeated
    rows share a hash and are taken alike. A column with the name of a result is replaced. No rows, no
    result. The hash is of doc_id and text, so a rerun takes the same rows (see plan_mix).
    """
    others = [F.col(f"`{c}`") for c in hide(df, text, *RESULTS).columns]
    rows = written(df.select(*others, size.alias("size"), row_hash(text=text).alias("_hash")), f"{folder}/rows")
    plan = plan_mix(rows.select("source", "size", "_hash"), folder, weights, share, most)
    mixed = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    others = [F.col(f"r.`{c}`") for c in rows.columns if c not in RESULTS]
    taken = (F.col("r.size") * times(F.col("r.size"))).alias("taken")
    return mixed.select(*others, F.col("r.size"), "p.source_size", "p.target", taken)


def repeat(
    df: DataFrame, folder: str, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """The mix itself: rows of `df` (with doc_id, text and source), each as often as it is taken; sizes are words."""
    names = [f"_{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    at = {c: n for c, n in zip(df.columns, names)}
    sized = plain.select(
        *names, F.col(at["source"]).alias("source"), row_hash(at["doc_id"], at["text"]).alias("_hash"),
        word_count(F.col(at["text"])).alias("size"),
    )
    rows = written(sized.select("source", "size", "_hash"), f"{folder}/rows")
    plan = plan_mix(rows, folder, weights, share, most)
    mixed = sized.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    copies = F.explode(F.sequence(F.lit(1), times(F.col("r.size")).cast("int"))).alias("_copy")
    some = mixed.where(times(F.col("r.size")) > 0).select(*names, copies)
    return some.select(*names).toDF(*df.columns)


def op10_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, word_count(F.col("text")), work_folder(spark, "mix")).drop("source")
