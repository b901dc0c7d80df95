"""Mixing sources to target weights by capped water-filling (operator 6).

Sources share a budget of words in proportion to their weights; none may take
more than `max_epochs` times its size. The level is found in closed form: in
the order of size per weight, the sources below the level are full, the others
share the rest by weight. Each source then repeats its documents whole, and
the remaining fraction takes the documents with the least seeded hash; of rows
that repeat one document as many as fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlab.llm.tables import column_places, free_names, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2.0
SEED = 20


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order_key(seed: int, text: str, doc_id: str = "doc_id") -> Column:
    """A seeded order of documents as 32 hex digits: the same in every run. Rows with one key have one id and text."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), part(doc_id), F.lit(":"), F.md5(part(text))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(`source`, `source_size`) -> the same with `target`, the words to take.

    Weights repeat over the sources by code point, null last. The table has a
    row per source, which is what the windows run over.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), pick.cast("int") + 1)
    rows = (sizes.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(max_epochs))
            .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(budget)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("total") - before) / after
    rows = rows.withColumn("level", level).withColumn("open", F.col("cap") / F.col("weight") > F.col("level"))
    rows = rows.withColumn("at", F.row_number().over(fill))
    first_open = F.min_by("level", F.when(F.col("open"), F.col("at")))
    rows = rows.withColumn("water", first_open.over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
             max_epochs: float = MAX_EPOCHS, seed: int = SEED, text: str = "text") -> DataFrame:
    """One row per source: `source`, `source_size`, `target`, `whole` (full
    repetitions) and `cut`: documents whose seeded hash is below `cut` are taken once more,
    and of the `n` equal rows whose hash is `cut` any `take`.

    The cut comes from sums per source and hash prefix (4,096 of them), then
    from the documents of one prefix: no task orders a whole source.
    """
    narrow = docs.select("source", word_count(text).alias("size"), _order_key(seed, text).alias("key")).checkpoint()
    by_prefix = narrow.groupBy("source", F.substring("key", 1, 3).alias("prefix")).agg(F.sum("size").alias("size"))
    sizes = by_prefix.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (source_targets(sizes, weights, budget, max_epochs).withColumn("whole", whole.cast("long"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    plan = written(plan, "mix-plan")  # a row per source
    so_far = Window.partitionBy("source").orderBy("prefix")
    steps = by_prefix.withColumn("upto", F.sum("size").over(so_far))
    same = F.col("s.source").eqNullSafe(F.col("p.source"))
    edge = (steps.alias("s").join(plan.alias("p"), same)
            .where("s.upto - s.size <= p.rest and s.upto > p.rest")
            .groupBy("p.source").agg(F.min("s.prefix").alias("prefix"),
                                     F.min(F.col("p.rest") - (F.col("s.upto") - F.col("s.size"))).alias("room")))
    edge = written(edge, "mix-edge")  # a row per source; joined with every document's row below
    there = (narrow.alias("n").join(edge.alias("e"), F.col("n.source").eqNullSafe(F.col("e.source"))
                                    & F.col("n.key").startswith(F.col("e.prefix")))
             .groupBy("e.source", "e.prefix", "e.room", "n.key")
             .agg(F.sum("n.size").alias("size"), F.max("n.size").alias("each"), F.count("*").alias("n")))
    before = F.sum("size").over(Window.partitionBy("source").orderBy("key")) - F.col("size")
    take = F.when(F.col("each") > 0, F.floor((F.col("room") - F.col("before")) / F.col("each") + 0.5)).when(
        F.col("before") <= F.col("room"), F.col("n")).otherwise(F.lit(0))
    cuts = (there.withColumn("before", before).withColumn("take", F.least(take, F.col("n")).cast("long"))
            .groupBy("source", "prefix")
            .agg(F.max(F.when(F.col("take") > 0, F.struct("key", "take", "n"))).alias("x"))
            .select("source", F.coalesce("x.key", "prefix").alias("cut"), "x.take", "x.n"))
    # Rest 0 has no edge where every prefix lies above it: nothing more is taken.
    return (plan.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
            .select("p.source", "p.source_size", "p.target", "p.whole", F.coalesce("c.cut", F.lit("")).alias("cut"),
                    F.coalesce("c.take", F.lit(0)).alias("take"), F.coalesce("c.n", F.lit(0)).alias("n")))


def _take_some(tied: DataFrame) -> DataFrame:
    """`tied` (equal rows of a source, with `__source`, `__take`) and `__rank` from 1 in each source.

    Rows are numbered inside the partition they come from, behind the rows of the
    partitions before it: a source's rows are never gathered.
    """
    tied = written(tied.withColumn("__at", F.spark_partition_id()), "mix-tied")
    counts = tied.groupBy("__source", "__at").agg(F.count("*").alias("__n_at"))
    so_far = F.sum("__n_at").over(Window.partitionBy("__source").orderBy("__at")) - F.col("__n_at")
    starts = written(counts.select(F.col("__source").alias("__s"), F.col("__at").alias("__a"),
                                   so_far.alias("__start")), "mix-starts")  # a row per source and partition
    inside = F.row_number().over(Window.partitionBy("__source", "__at").orderBy(F.lit(1)))
    return (tied.withColumn("__inside", inside)
            .join(starts, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__at") == F.col("__a")))
            .withColumn("__rank", F.col("__start") + F.col("__inside")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
        max_epochs: float = MAX_EPOCHS, seed: int = SEED, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with `mix_size` (words), `mix_source_size`,
    `mix_target` (its source's) and `mix_repeats`, how often the mix takes the row.

    Where `docs` has a column of such a name, these four begin with underscores, as many as
    it takes. A null text has no words; null sources are one source, the last. Rows of a source
    that agree in doc_id (or have none) and text are taken by count, any of them.
    Rerunning gives the same rows; empty table: no rows.
    """
    plan = written(mix_plan(docs, weights, budget, max_epochs, seed, text).select(
        F.col("source").alias("__source"), F.col("source_size").alias("__size"), F.col("target").alias("__target"),
        F.col("whole").alias("__whole"), F.col("cut").alias("__cut"), F.col("take").alias("__take"),
        F.col("n").alias("__n")), "mix-cuts")
    places = column_places(docs)
    rows = docs.toDF(*places.values())
    key, size = _order_key(seed, places[text], places["doc_id"]), word_count(places[text])
    # a row per source; Spark broadcasts it below its size threshold
    joined = rows.join(plan, F.col(places["source"]).eqNullSafe(F.col("__source")))
    most = F.lit(math.ceil(max_epochs)).cast("long")
    names = [*docs.columns, *free_names(docs, "mix_size", "mix_source_size", "mix_target", "mix_repeats")]

    def result(some, words, once_more):
        return some.select(*rows.columns, words, F.col("__size"), F.col("__target"),
                           F.least(F.col("__whole") + once_more.cast("long"), most)).toDF(*names)

    if plan.where("__take < __n").isEmpty():
        return result(joined, size, key <= F.col("__cut"))
    split = (key == F.col("__cut")) & (F.col("__take") < F.col("__n"))
    tied = _take_some(joined.where(split).select(*rows.columns, size.alias("__words"), *plan.columns))
    return result(joined.where(~split), size, key <= F.col("__cut")).union(
        result(tied, F.col("__words"), F.col("__rank") <= F.col("__take")))
