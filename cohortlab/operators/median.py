"""Exact per-column medians, computed distributed in a few scans.

The median is the *lower* median: the element at rank ``ceil(n / 2)`` of the
sorted non-null, non-NaN values (``[1, 2, 3, 4] -> 2``), the value an exact
quantile query at 0.5 returns. Nulls and NaN are ignored.

Why not one ``percentile_disc`` aggregate: it keeps a value->count map of every
distinct value, and its final merge runs in one task, so on a near-unique
column it pulls the whole column into one task. Here no task ever holds more
than a bounded band of distinct values:

0. One cheap aggregate gives per column: rows, nulls, NaNs and valid values
   (``prepare`` reuses it as its missing-value report); a distinct estimate is
   made only of the columns that need a median.
1. A column with few distinct values is finished at once: its values are
   grouped with their counts (map-side combined, so a value holding a third of
   all rows is one row per task) and a running count over that bounded set
   picks the element at the wanted rank.
2. A column with many distinct values gets a mergeable KLL sketch of its
   current value band (merged in two levels -- by a salt of the partition id,
   then globally -- so the final merge sees ~sqrt(#partitions) sketches). The
   sketch proposes a narrow sub-band around the wanted rank.
3. The proposal is checked with exact counts (rows below it, rows inside it).
   If the wanted element is inside, the band narrows to it; if the sketch
   missed, the band narrows to the side that holds it. Correctness never
   depends on the sketch. When a proposal is small enough, checking and
   finishing happen in the same grouped pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import is_remote

from cohortlab.functions.keys import valid_number

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


@dataclass
class _Band:
    lo: float | None = None
    lo_inc: bool = True
    hi: float | None = None
    hi_inc: bool = True

    def contains(self, v: Column) -> Column:
        cond = v.isNotNull()
        if self.lo is not None:
            cond = cond & ((v >= F.lit(self.lo)) if self.lo_inc else (v > F.lit(self.lo)))
        if self.hi is not None:
            cond = cond & ((v <= F.lit(self.hi)) if self.hi_inc else (v < F.lit(self.hi)))
        return cond

    def single_value(self) -> bool:
        return self.lo is not None and self.lo == self.hi and self.lo_inc and self.hi_inc


@dataclass
class _State:
    band: _Band
    rank: int                        # 1-based rank of the median inside ``band``
    n: int                           # valid values inside ``band``
    distinct: int | None = None      # estimate of distinct values inside ``band``
    proposal: _Band | None = None    # sub-band to check next
    margin: float = 0.0              # half-width, in rank share, of the next proposal

    def below(self, v: Column) -> Column:
        """Band rows under the proposal (the rank offset of the proposal)."""
        if self.proposal is None or self.proposal.lo is None:
            return F.lit(False)
        return self.band.contains(v) & (v < F.lit(self.proposal.lo))

    def target(self) -> _Band:
        return self.proposal if self.proposal is not None else self.band

    def settle(self, below: int, inside: int) -> bool:
        """Apply exact counts of a checked proposal; True when the median is inside it."""
        t = self.target()
        if below < self.rank <= below + inside:
            if inside >= self.n:
                # The proposal held every row of the band: no progress, so the
                # next proposal is narrower (it ends at a single value).
                self.margin /= 4.0
            self.band, self.rank, self.n = t, self.rank - below, inside
            ok = True
        elif self.rank <= below:
            self.band, self.n = _Band(self.band.lo, self.band.lo_inc, t.lo, False), below
            ok = False
        else:
            self.band = _Band(t.hi, False, self.band.hi, self.band.hi_inc)
            self.rank, self.n = self.rank - below - inside, self.n - below - inside
            ok = False
        self.proposal, self.distinct = None, None
        return ok



def check_numeric(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise one error naming every non-numeric column (before any job runs)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in cols if c not in types]
    if missing:
        raise ValueError(f"columns not in the frame: {missing}")
    bad = [f"{c} ({types[c].simpleString()})" for c in cols if not isinstance(types[c], NUMERIC)]
    if bad:
        raise ValueError("a median needs numeric columns; not numeric: " + ", ".join(bad))


def _kll_error(k: int) -> float:
    # Normalised rank error of a KLL sketch with parameter k (two-sided, ~99%).
    return 2.296 / k ** 0.9723


@dataclass
class ColumnStats:
    rows: int
    nulls: int
    nans: int
    valid: int        # non-null, non-NaN values


def stats_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the row count, and per column the non-null and NaN counts."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(c)).alias(f"n{i}"))
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            aggs.append(F.count_if(F.isnan(c)).alias(f"nan{i}"))
    return df.agg(*aggs)


def column_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, ColumnStats]:
    """Counts per numeric column from one plain aggregate (one bounded row)."""
    cols = list(cols)
    check_numeric(df, cols)
    if not cols:
        return {}
    r = stats_frame(df, cols).first().asDict()
    return {c: ColumnStats(r["rows"], r["rows"] - r[f"n{i}"], r.get(f"nan{i}", 0), r[f"n{i}"] - r.get(f"nan{i}", 0))
            for i, c in enumerate(cols)}


def _distinct_estimates(base: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """About how many distinct values each column has: it decides how a median
    is searched, not what it is."""
    if not names:
        return {}
    return base.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first().asDict()


def exact_medians(df: DataFrame, cols: Sequence[str], stats: dict[str, ColumnStats] | None = None,
                  sketch_k: int = 2048, finish_distinct: int = 200_000,
                  persist: bool = False) -> dict[str, float | None]:
    """``{column: lower median as float}``; ``None`` for a column with no value.

    ``stats`` from :func:`column_stats` saves the first scan when the caller has it.
    ``finish_distinct`` is a choice of plan: up to about so many distinct values
    a band is grouped and ranked at once, above it a sketch narrows the band
    first. Both ways are exact. ``persist`` keeps the median columns (spilling to
    disk) from the first sketch round on: for a text source, whose every scan
    parses the whole file; a columnar one is read again more cheaply. The search ends because every checked proposal
    leaves a band with fewer rows or halves the next proposal's margin.
    """
    cols = list(cols)
    if not cols:
        return {}
    check_numeric(df, cols)
    if stats is None:
        stats = column_stats(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [f"__v{i}" for i in range(len(cols))]
    base = df.select(*[valid_number(c, types[c]).alias(n) for c, n in zip(cols, names)])
    margin = 3.0 * _kll_error(sketch_k)
    err = _kll_error(sketch_k)

    result: dict[str, float | None] = {}
    states: dict[str, _State] = {}
    # Where so few rows are valid that grouping them is always small, nothing is estimated.
    large = [n for c, n in zip(cols, names) if stats[c].valid > finish_distinct]
    distinct = _distinct_estimates(base, large)
    for c, n in zip(cols, names):
        st = stats[c]
        if st.valid == 0:
            result[n] = None
        else:
            states[n] = _State(_Band(), (st.valid + 1) // 2, st.valid, distinct.get(n, st.valid), margin=margin)
    try:
        _search(base, states, result, sketch_k, finish_distinct, err, persist)
    finally:
        if persist:
            base.unpersist()
    return {c: result[n] for c, n in zip(cols, names)}


def _search(base: DataFrame, states: dict[str, _State], result: dict[str, float | None], sketch_k: int,
            finish_distinct: int, err: float, persist: bool) -> None:
    """Rounds until ``result`` has every column of ``states``."""
    fan = None
    while True:
        pending = {n: s for n, s in states.items() if n not in result}
        for n, s in pending.items():
            if s.proposal is None and s.band.single_value():
                result[n] = s.band.lo
        pending = {n: s for n, s in pending.items() if n not in result}
        if not pending:
            break
        finish = {n: s for n, s in pending.items()
                  if (s.proposal is None and (s.n <= finish_distinct or
                                              (s.distinct is not None and s.distinct <= finish_distinct)))
                  # a proposal spans its margin on both sides plus the sketch's
                  # rank error, and the ties at its two ends (two values at most)
                  or (s.proposal is not None and s.n * (2 * s.margin + 2 * err) + 2 <= finish_distinct)}
        sketch = {n: s for n, s in pending.items() if n not in finish}
        if sketch:
            # Columns ready to finish wait, so all of them share one grouped pass.
            if fan is None:
                fan = _fan_out(base)
                if persist:
                    base.persist(StorageLevel.MEMORY_AND_DISK)
            _sketch_round(base, sketch, sketch_k, fan, finish_distinct)
        else:
            result.update(_finish(base, finish))


def _fan_out(base: DataFrame) -> int:
    """~sqrt(#input partitions) first-level merge groups (a fixed 32 on a Spark
    Connect session, which has no RDD API)."""
    if is_remote():
        return 32
    return max(1, math.isqrt(max(1, base.rdd.getNumPartitions())))


def sketch_frame(base: DataFrame, active: dict[str, _State], k: int, fan: int) -> DataFrame:
    """One row: per column, exact counts of the band or proposal and a sketch of it."""
    single, level1, level2 = [], [], []
    for n, s in active.items():
        v = F.col(n)
        in_target = s.target().contains(v)
        kll_in = F.kll_sketch_agg_double(F.when(in_target, v), k)
        hll_in = F.hll_sketch_agg(F.when(in_target, F.xxhash64(v)))
        single += [F.count_if(s.below(v)).alias(f"{n}_below"), F.count_if(in_target).alias(f"{n}_in"),
                   kll_in.alias(f"{n}_kll"),
                   F.coalesce(F.hll_sketch_estimate(hll_in), F.lit(0)).alias(f"{n}_distinct")]
        level1 += [F.count_if(s.below(v)).alias(f"{n}_below"), F.count_if(in_target).alias(f"{n}_in"),
                   kll_in.alias(f"{n}_kll"), hll_in.alias(f"{n}_hll")]
        level2 += [F.coalesce(F.sum(f"{n}_below"), F.lit(0)).alias(f"{n}_below"),
                   F.coalesce(F.sum(f"{n}_in"), F.lit(0)).alias(f"{n}_in"),
                   F.kll_merge_agg_double(f"{n}_kll", k).alias(f"{n}_kll"),
                   F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{n}_hll")), F.lit(0))
                   .alias(f"{n}_distinct")]
    if fan <= 1:
        merged = base.agg(*single)
    else:
        salted = base.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(fan)))
        merged = salted.groupBy("__salt").agg(*level1).agg(*level2)
    out = []
    for n, s in active.items():
        out += [F.col(f"{n}_below"), F.col(f"{n}_in"), F.col(f"{n}_distinct")]
        if s.proposal is None:
            q = s.rank / s.n
            lo, hi = max(0.0, q - s.margin), min(1.0, q + s.margin)
            kll = F.col(f"{n}_kll")
            out += [F.when(F.col(f"{n}_in") > 0, F.kll_sketch_get_quantile_double(kll, F.lit(lo))).alias(f"{n}_qlo"),
                    F.when(F.col(f"{n}_in") > 0, F.kll_sketch_get_quantile_double(kll, F.lit(hi))).alias(f"{n}_qhi")]
        else:
            out.append(F.col(f"{n}_kll"))
    return merged.select(*out)


def _sketch_round(base: DataFrame, active: dict[str, _State], k: int, fan: int,
                  finish_distinct: int) -> None:
    """One scan (``sketch_frame``) and what follows from it.

    A column without a proposal gets its next proposal from the sketch inside
    the same job (its rank and size are known); a column whose proposal is
    being checked learns its new rank only from this job's counts, so its
    proposal comes from the collected (size-bounded) sketch afterwards.
    """
    row = sketch_frame(base, active, k, fan).first()
    later = {}
    for n, s in active.items():
        distinct = row[f"{n}_distinct"]
        if s.proposal is None:
            s.distinct = distinct
            if distinct > finish_distinct:
                s.proposal = _Band(row[f"{n}_qlo"], True, row[f"{n}_qhi"], True)
        elif s.settle(row[f"{n}_below"], row[f"{n}_in"]):
            s.distinct = distinct
            if distinct > finish_distinct and not s.band.single_value():
                q = s.rank / s.n
                later[n] = (max(0.0, q - s.margin), min(1.0, q + s.margin))
    if later:
        for n, (lo, hi) in _quantiles(base.sparkSession, row, later).items():
            active[n].proposal = _Band(lo, True, hi, True)


def _quantiles(spark, row, propose: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    """Values at given normalised ranks of collected sketches (one row, no scan)."""
    names = list(propose)
    schema = T.StructType([T.StructField(n, T.BinaryType()) for n in names])
    one = spark.createDataFrame([tuple(bytes(row[f"{n}_kll"]) for n in names)], schema)
    exprs = []
    for n in names:
        lo, hi = propose[n]
        exprs += [F.kll_sketch_get_quantile_double(F.col(n), F.lit(lo)).alias(f"{n}_lo"),
                  F.kll_sketch_get_quantile_double(F.col(n), F.lit(hi)).alias(f"{n}_hi")]
    q = one.select(*exprs).first()
    return {n: (q[f"{n}_lo"], q[f"{n}_hi"]) for n in names}


def finish_frame(base: DataFrame, finish: dict[str, _State]) -> DataFrame:
    """A row per column: the value at its rank, and exact counts below and inside its band."""
    names = list(finish)
    args = []
    for i, n in enumerate(names):
        s, v = finish[n], F.col(n)
        part = F.when(s.below(v), F.lit(0)).when(s.target().contains(v), F.lit(1))
        args += [F.lit(i), part, F.when(part == 1, v)]
    cands = (base.select(F.stack(F.lit(len(names)), *args).alias("c", "part", "v"))
             .filter(F.col("part").isNotNull())
             .groupBy("c", "part", "v").agg(F.count(F.lit(1)).alias("cnt")))
    rank_of = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(finish[n].rank))])
    w = Window.partitionBy("c").orderBy("part", "v").rowsBetween(Window.unboundedPreceding,
                                                                Window.currentRow)
    r = rank_of[F.col("c")]
    hit = (F.col("cum") >= r) & (F.col("cum") - F.col("cnt") < r)
    return (cands.withColumn("cum", F.sum("cnt").over(w))
               .groupBy("c")
               .agg(F.max(F.when(hit & (F.col("part") == 1), F.col("v"))).alias("median"),
                    F.coalesce(F.sum(F.when(F.col("part") == 0, F.col("cnt"))), F.lit(0)).alias("below"),
                    F.coalesce(F.sum(F.when(F.col("part") == 1, F.col("cnt"))), F.lit(0)).alias("inside")))


def _finish(base: DataFrame, finish: dict[str, _State]) -> dict[str, float]:
    """Exact pick in bounded bands, checking any pending proposal in the same pass.

    Rows under the proposal collapse into one counted group per column; rows in
    the proposal (or in the whole band) are grouped by value. A running count
    in value order over that bounded set finds the wanted rank. If the rank
    falls outside the proposal, the state narrows and the search goes on.
    """
    names = list(finish)
    rows = {names[row["c"]]: row for row in finish_frame(base, finish).collect()}
    out = {}
    for n, s in finish.items():
        row = rows.get(n)
        if s.settle(row["below"] if row else 0, row["inside"] if row else 0):
            out[n] = row["median"]
    return out
