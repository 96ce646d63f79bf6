"""Shared statistical building blocks: unpivot, exact distributed quantiles,
size-checked broadcast, column selection by type.

Quantiles use linear interpolation between order statistics (pandas'
default, DuckDB ``quantile_cont``). The exact method never gathers a whole
group in one task:

1. one aggregate per group gives the non-null count and an approximate
   quantile sketch, from which a narrow value bracket around each requested
   rank is read (``p +- 4/accuracy``);
2. while a bracket may hold more than ``MAX_CANDIDATES`` rows, it is sketched
   and cut down again;
3. one aggregate per (group, probability, candidate value) counts the rows
   below the bracket and the distinct values inside it (map-side combined);
4. a running sum over the small candidate table finds the two order
   statistics and interpolates.

If a bracket misses its rank (the sketch bound did not hold), steps 2 to 4 are
done again for it from [min, max].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from claimlens.session import stored
from claimlens.settings import BOOKKEEPING

QUANTILE_ACCURACY = 5_000
BROADCAST_MAX_ROWS = 1_000_000
#: Candidate rows that one window task may see for a group and probability.
MAX_CANDIDATES = 1_000_000


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in BOOKKEEPING]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in BOOKKEEPING and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in BOOKKEEPING and f.name not in exclude]


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN becomes NULL in floating columns (pandas treats both as missing)."""
    from pyspark.sql.types import DoubleType, FloatType
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in cols}) if cols else df


def unpivot(df: DataFrame, ids: list[str], cols: list[str], cast: str | None = "double",
            name: str = "column", value: str = "value") -> DataFrame:
    """Wide to long: one row per (ids, column) with ``col_ord`` = position."""
    items = [F.struct(F.lit(i).alias("col_ord"), F.lit(c).alias(name),
                      (F.col(c).cast(cast) if cast else F.col(c)).alias(value))
             for i, c in enumerate(cols)]
    return df.select(*ids, F.inline(F.array(*items)))


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only if its row count is proven below ``max_rows``;
    beyond that Spark plans a shuffle join (AQE may still convert it)."""
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def _q_names(probs):
    return [f"q{int(round(p * 100)):02d}" if abs(p * 100 - round(p * 100)) < 1e-9 else f"q_{p}" for p in probs]


def group_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    method: str = "exact", names: list[str] | None = None,
                    accuracy: int = QUANTILE_ACCURACY, halfwidth: float | None = None) -> DataFrame:
    """Per group of ``keys``: interpolated quantiles of non-null ``value``.

    Returns ``keys + names``; groups whose values are all NULL are absent.
    """
    names = names or _q_names(probs)
    nn = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    if method == "approx":
        return (nn.groupBy(*keys).agg(F.percentile_approx("_v", list(probs), accuracy).alias("_q"))
                  .select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]))
    if method == "spark":
        return (nn.groupBy(*keys).agg(F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("_q"))
                  .select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]))

    half = 4.0 / accuracy if halfwidth is None else halfwidth
    edges = []
    for p in probs:
        edges += [max(0.0, p - half), min(1.0, p + half)]
    # one row per group, written once: joined below, and read again for the ranks
    sketch = stored(nn.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                                          F.percentile_approx("_v", edges, accuracy).alias("_e")), "sketch")
    pk = F.array(*[F.lit(float(p)) for p in probs])
    ranked = sketch.select(*keys, "_n", "_min", "_max", F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("_e")[2 * k].alias("_lo"), F.col("_e")[2 * k + 1].alias("_hi"))
        for k in range(len(probs))]))).withColumn("_h", (F.col("_n") - 1) * F.element_at(pk, F.col("k") + 1)) \
        .withColumn("_i", F.floor("_h")).withColumn("_j", F.least(F.col("_i") + 1, F.col("_n") - 1))
    largest = sketch.agg(F.max("_n")).first()[0] or 0
    brackets = _narrowed(nn, keys, ranked, accuracy) if largest * 2 * half > MAX_CANDIDATES else ranked
    per_k = stored(_read_ranks(nn, keys, brackets), "ranks")
    missed = per_k.where(F.col("_q").isNull()).select(*keys, "k")
    if missed.limit(1).count():
        # the sketch was off: start again from the whole range of these groups
        again = ranked.join(missed, [*keys, "k"], "left_semi").withColumn("_lo", F.col("_min")).withColumn("_hi", F.col("_max"))
        again = _narrowed(nn, keys, again, accuracy) if largest > MAX_CANDIDATES else again
        per_k = stored(per_k.where(F.col("_q").isNotNull()).unionByName(_read_ranks(nn, keys, again)), "ranks")
    return per_k.groupBy(*keys).agg(*[F.max(F.when(F.col("k") == k, F.col("_q"))).alias(n) for k, n in enumerate(names)])


def _beside(nn: DataFrame, keys: list[str], brackets: DataFrame, fields: list[str]) -> DataFrame:
    """Each fact row with the brackets of its group as an array, in one size-checked
    broadcast join (one row per group)."""
    small = brackets.groupBy(*keys).agg(F.collect_list(F.struct("k", *fields)).alias("_b"))
    return nn.join(bounded_broadcast(small), keys)


def _narrowed(nn: DataFrame, keys: list[str], brackets: DataFrame, accuracy: int) -> DataFrame:
    """Brackets cut down, pass by pass, until none holds more than ``MAX_CANDIDATES``
    rows or values other than its ends. Each pass sketches the rows inside a bracket
    and keeps the stretch around the target rank; partial aggregates do the work, so
    no task sees a whole bracket."""
    steps, accuracy = 1000, max(accuracy, QUANTILE_ACCURACY)
    marks = [i / steps for i in range(steps + 1)]
    while True:
        rows = _beside(nn, keys, brackets, ["_lo", "_hi"]).select(*keys, "_v", F.explode("_b").alias("_s"))
        inside = F.col("_v").between(F.col("_s._lo"), F.col("_s._hi"))
        seen = rows.groupBy(*keys, F.col("_s.k").alias("k")).agg(
            F.count_if(F.col("_v") < F.col("_s._lo")).alias("_below"), F.count_if(inside).alias("_in"),
            F.percentile_approx(F.when(inside, F.col("_v")), marks, accuracy).alias("_m"))
        at = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("_i") - F.col("_below")) / F.greatest(F.col("_in"), F.lit(1)))) * steps
        narrow = (F.col("_in") > MAX_CANDIDATES) & (F.col("_i") >= F.col("_below")) & (F.col("_j") < F.col("_below") + F.col("_in"))
        # three marks on either side, and a few rows where a mark is less than a row
        margin = F.greatest(F.lit(3), F.ceil(4 * steps / F.greatest(F.col("_in"), F.lit(1)))).cast("int")
        lo = F.element_at("_m", F.greatest(F.lit(1), F.floor(at).cast("int") + 1 - margin))
        hi = F.element_at("_m", F.least(F.lit(steps + 1), F.floor(at).cast("int") + 2 + margin))
        new = stored(brackets.join(seen, [*keys, "k"]).select(
            *brackets.columns, "_in", F.when(narrow, F.greatest("_lo", lo)).otherwise(F.col("_lo")).alias("_lo2"),
            F.when(narrow, F.least("_hi", hi)).otherwise(F.col("_hi")).alias("_hi2")), "brackets")
        left = new.where((F.col("_lo2") != F.col("_lo")) | (F.col("_hi2") != F.col("_hi"))).limit(1).count()
        brackets = new.select(*[c for c in brackets.columns if c not in ("_lo", "_hi")], F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi"))
        if not left:
            return brackets


def _read_ranks(nn: DataFrame, keys: list[str], brackets: DataFrame) -> DataFrame:
    """``keys, k, _q``: the interpolated value at each bracket's rank, null where the
    bracket misses it. Rows below a bracket are only counted; the distinct values
    inside are few, and a running sum over them finds the two order statistics."""
    v = F.col("_v")
    b = F.col("_s")
    # exploded before it is filtered: functions over arrays are not compiled
    cand = (_beside(nn, keys, brackets, ["_lo", "_hi"]).select(*keys, "_v", F.explode("_b").alias("_s")).where(v <= b["_hi"])
            .select(*keys, b["k"].alias("k"), F.when(v >= b["_lo"], v).alias("cv"))
            .groupBy(*keys, "k", "cv").agg(F.count(F.lit(1)).alias("_c")))
    w = (Window.partitionBy(*keys, "k").orderBy(F.col("cv").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranks = cand.withColumn("_last", F.sum("_c").over(w) - 1).withColumn("_first", F.col("_last") - F.col("_c") + 1)
    hit = lambda r: F.col("cv").isNotNull() & (F.col("_first") <= r) & (F.col("_last") >= r)
    return (ranks.join(bounded_broadcast(brackets.select(*keys, "k", "_h", "_i", "_j")), [*keys, "k"])
            .groupBy(*keys, "k")
            .agg(F.max(F.when(hit(F.col("_i")), F.col("cv"))).alias("_vi"),
                 F.max(F.when(hit(F.col("_j")), F.col("cv"))).alias("_vj"),
                 F.first("_h").alias("_h"), F.first("_i").alias("_i"))
            .select(*keys, "k", (F.col("_vi") + (F.col("_h") - F.col("_i")) * (F.col("_vj") - F.col("_vi"))).alias("_q")))
