"""Medians, the bisection median estimate, and box-plot statistics.

Quantile methods:
* ``exact`` (default): ``exact_quantiles`` -- bracketed selection: a mergeable
  sketch per group brackets each wanted rank, rows outside the brackets are only
  counted, and the few inside are sorted. No task ever holds a whole group.
  Interpolation is the one Spark's ``percentile`` uses.
* ``percentile``: Spark's ``percentile`` aggregate (one pass; its buffer per
  group is a value -> count map, so it suits measures with few distinct values).
* ``approx``: ``percentile_approx`` (one pass, fixed-size buffer, approximate).

``median_bisect`` gives the same answer as a 10-round bisection that starts at
the midrange and moves one bound per round, in ONE pass over the data: every
row follows the same halving path the rounds would take and lands in one of
2**rounds leaf cells; a per-group walk over the (at most 2**rounds) leaf counts
then replays the rounds.

Raw rows meet their group's statistics through ``with_group_stats``: the
statistics are kept in the shared folder first; counted few, they are
broadcast and the raw rows stay where they are; beyond that the join is
salted, so the rows of a hot group are dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.functions.columns import complete_rows, with_calendar, with_season
from obsgrid.session import shared_dir

QUARTILES = (0.25, 0.5, 0.75)

# Groups up to which their statistics (a few numbers each) are broadcast, and parts a hot group is dealt into beyond that.
BROADCAST_GROUPS = 500_000
SALTS = 32
_SALT = "_salt"
# Brackets: the sketch's accuracy (its ranks are off by at most a part in so many), and how far around a wanted probability a
# bracket reaches -- the sketch's error at both ends and the rounding of ranks, with room. A miss is found and done without sketch.
SKETCH_ACCURACY = 1000
BRACKET = 0.004
# groups of so many rows or fewer are one bracket
SMALL_GROUP = 2000
# rows of the largest group up to which its values are walked in one task as they are, and up to which its bracketed values are
DIRECT_ROWS = 5_000_000
WALKED_ROWS = 500_000_000
# leaf cells per group that the bisection may count
MAX_LEAVES = 1 << 16

# Group key used when no keys are given, so every join stays an equi-join. Its
# value is always 0; being nondeterministic, it is not folded into a constant,
# which would let the optimizer turn the joins into cartesian products.
_ALL = "_all"


def _one_group() -> Column:
    return F.monotonically_increasing_id() * F.lit(0)


# Nullable group keys travel packed in one struct column: the struct itself is
# never NULL and struct equality treats NULL fields as equal, so joins on it
# keep groups whose key holds a NULL (a plain equi-join would drop them).
_GK = "_gk"


def _pack(vals: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    if not any(vals.schema[k].nullable for k in keys):
        return vals, keys
    others = [c for c in vals.columns if c not in keys]
    return vals.select(F.struct(*keys).alias(_GK), *others), [_GK]


def _unpack(df: DataFrame, keys: list[str], used: list[str]) -> DataFrame:
    if used == keys:
        return df
    return df.select(*[F.col(f"{_GK}.{k}").alias(k) for k in keys], *[c for c in df.columns if c != _GK])


def _values(obs: DataFrame, measure: str, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    df = complete_rows(with_season(with_calendar(obs)), [measure])
    return df.select(*keys, *extra, F.col(measure).cast("double").alias("_v"))


def with_group_stats(rows: DataFrame, stats: DataFrame, keys: list[str], broadcast_rows: int | None = None,
                     salts: int | None = None, groups: int | None = None) -> DataFrame:
    """Join each row with its group's row of ``stats`` (cheap to read again, one row per group; ``groups`` of them, if counted already)."""
    limit = BROADCAST_GROUPS if broadcast_rows is None else broadcast_rows
    if (stats.count() if groups is None else groups) <= limit:
        return rows.join(F.broadcast(stats), keys)
    n = SALTS if salts is None else salts
    salted = rows.withColumn(_SALT, F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys]), F.lit(n)).cast("int"))
    spread = stats.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted.join(spread, [*keys, _SALT]).drop(_SALT)


def _kept(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def exact_quantiles(vals: DataFrame, keys: Sequence[str], probs: Sequence[float], value: str = "_v",
                    names: Sequence[str] | None = None, slices: int | None = None) -> DataFrame:
    """Exact quantiles per group without gathering a group in one task.

    Returns keys, n and one double column per probability (``names``). The
    quantile at p is linear interpolation at position (n-1)*p of the sorted
    values: (hi - pos) * v[lo] + (pos - lo) * v[hi] -- the form of Spark's
    ``percentile``, so both give the same doubles.

    * where the largest group has ``DIRECT_ROWS`` rows or fewer, the rows are counted by
      value and each group's counts walked in order;
    * else one pass adds up each group's count, extremes and a quantile sketch; around
      each wanted probability the sketch gives a bracket of two values;
    * a second pass counts the rows between brackets, a number for each gap,
      and the rows inside by value, adding up before the shuffle: what is
      shuffled and sorted is a small share of the distinct values;
    * running sums over gaps and values give the wanted ranks. Up to
      ``WALKED_ROWS`` rows in the largest group they are a window per group; beyond that
      the counts are range-partitioned, see ``_walked``;
    * a rank outside its bracket leaves a NULL; such groups are done again from
      all their values, so the sketch never decides a result.
    Every kind of value is sorted like any other, infinities and NaN too.
    ``slices`` asks for range partitions of all values, and sets their number.
    """
    if not keys:
        return exact_quantiles(vals.withColumn(_ALL, _one_group()), [_ALL], probs, value, names, slices).drop(_ALL)
    orig_keys = list(keys)
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    vals, keys = _pack(vals.select(*orig_keys, F.col(value).cast("double").alias("_x")), orig_keys)
    x = F.col("_x")
    largest = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    by_value = vals.groupBy(*keys, F.lit(0).alias("_c"), "_x").agg(F.count(F.lit(1)).alias("_m"))
    if slices or largest <= DIRECT_ROWS:
        return _unpack(_put_together(_walked(by_value, keys, probs, slices, largest), keys, probs, names), orig_keys, keys)
    inner = sorted({float(p) for p in probs if 0 < p < 1})
    ends = [max(min(p + side * BRACKET, 1.0), 0.0) for p in inner for side in (-1, 1)]
    sketch = F.percentile_approx("_x", ends, SKETCH_ACCURACY) if ends else F.lit(None).cast("array<double>")
    stats = _kept(vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                          sketch.alias("_q")))
    groups = stats.count()
    small = F.col("n") <= SMALL_GROUP
    bounds = [F.when(small, F.col("_max" if i % 2 else "_min")).otherwise(F.col("_q")[i]).alias(f"_b{i}") for i in range(len(ends))]
    met = with_group_stats(vals, stats.select(*keys, *bounds), keys, groups=groups)
    cell, inside = F.lit(0), F.lit(False)
    for i in range(0, len(ends), 2):
        lo, hi = F.col(f"_b{i}"), F.col(f"_b{i + 1}")
        cell = cell + (x >= lo).cast("int") + (x > hi).cast("int")      # rises with the value: gaps and brackets in order
        inside = inside | ((x >= lo) & (x <= hi))
    counts = met.select(*keys, cell.alias("_c"), F.when(inside, x).alias("_x")).groupBy(*keys, "_c", "_x").agg(
        F.count(F.lit(1)).alias("_m"))
    # the extremes need no ranks
    extremes = stats.select(*keys, "n", "_min", "_max")
    if ends:
        picked = _walked(counts, keys, inner, None, largest).groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("_k", "_x"))).alias("_got"))
        extremes = extremes.join(F.broadcast(picked) if groups <= BROADCAST_GROUPS else picked, keys, "left")
    else:
        extremes = extremes.withColumn("_got", F.lit(None).cast("map<bigint,double>"))
    got = _kept(extremes.select(*keys, "n", *[
        F.col("_min" if p == 0 else "_max").alias(nm) if p in (0, 1) else _interpolated(p).alias(nm) for p, nm in zip(probs, names)]))
    missed = got.where(" OR ".join(f"`{nm}` IS NULL" for nm in names)).select(*keys)
    if ends and missed.take(1):
        full = _put_together(_walked(by_value.join(missed, keys, "left_semi"), keys, probs, None, None), keys, probs, names)
        got = got.join(missed, keys, "left_anti").unionByName(full)
    return _unpack(got, orig_keys, keys)


def _position(p: float) -> Column:
    return (F.col("n") - 1).cast("double") * F.lit(float(p))


def _interpolated(p: float) -> Column:
    lo, hi = F.floor(_position(p)).cast("long"), F.ceil(_position(p)).cast("long")
    vlo, vhi = F.try_element_at("_got", lo), F.try_element_at("_got", hi)
    return F.when(lo == hi, vlo).otherwise((hi - _position(p)) * vlo + (_position(p) - lo) * vhi)


def _put_together(picked: DataFrame, keys: list[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    got = picked.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_x"))).alias("_got"))
    return got.select(*keys, "n", *[_interpolated(p).alias(nm) for p, nm in zip(probs, names)])


def _walked(counts: DataFrame, keys: list[str], probs: Sequence[float], slices: int | None, largest: int | None) -> DataFrame:
    """(keys, n, _k, _x): the values at the wanted ranks, from counts (keys, _c, _x, _m) in order of (_c, _x).

    Where the largest group has few rows, or few of them are left, a window per group. Else the counts are
    range-partitioned, so that a large group spans as many slices as its size asks for; running sums of the
    slices' totals tell which slices hold a wanted rank, and only those are walked value by value.
    """
    ranks = []
    for p in probs:
        ranks += [F.floor(_position(p)).cast("long"), F.ceil(_position(p)).cast("long")]
    wanted = F.array_distinct(F.array(*ranks))

    def pick(walked: DataFrame, ks: Column) -> DataFrame:
        return walked.select(*keys, "n", "_x", F.explode(F.filter(
            ks, lambda k: (k < F.col("_upto")) & (k >= F.col("_upto") - F.col("_m")))).alias("_k"))

    group = Window.partitionBy(*keys)
    if slices is None and largest is not None and largest <= WALKED_ROWS:
        walk = Window.partitionBy(*keys).orderBy("_c", "_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return pick(counts.withColumn("n", F.sum("_m").over(group)).withColumn("_upto", F.sum("_m").over(walk)), wanted)
    order = [*keys, "_c", "_x"]
    ranged = counts.repartitionByRange(slices, *order) if slices else counts.repartitionByRange(*order)
    sliced = _kept(ranged.withColumn("_part", F.spark_partition_id()))
    totals = sliced.groupBy(*keys, "_part").agg(F.sum("_m").alias("_cnt"))
    upto = F.sum("_cnt").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = totals.select(*keys, F.sum("_cnt").over(group).alias("n"), "_part", (upto - F.col("_cnt")).alias("_before"), upto.alias("_after"))
    held = placed.select(*keys, "n", "_part", "_before", F.filter(
        wanted, lambda k: (k >= F.col("_before")) & (k < F.col("_after"))).alias("_ks")).where(F.size("_ks") > 0)
    # slices are bounded, so this join and window have no hot key
    walk = Window.partitionBy(*keys, "_part").orderBy("_c", "_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = sliced.join(held, [*keys, "_part"]).withColumn("_upto", F.col("_before") + F.sum("_m").over(walk))
    return pick(walked, F.col("_ks"))


def _agg_quantiles(vals: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str],
                   method: str, accuracy: int) -> DataFrame:
    """keys, n and the quantiles, by the chosen method."""
    keys = list(keys)
    if method == "exact":
        return exact_quantiles(vals, keys, probs, names=names)
    if method == "percentile":
        q = F.percentile("_v", list(probs))
    elif method == "approx":
        q = F.percentile_approx("_v", list(probs), accuracy)
    else:
        raise ValueError("method must be 'exact', 'percentile' or 'approx'")
    agg = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), q.alias("_q"))
    return agg.select(*keys, "n", *[F.col("_q")[i].cast("double").alias(nm) for i, nm in enumerate(names)])


def median_season(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year", "season"),
                  method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Median per group (A9): linear interpolation between the middle values."""
    if not keys:
        return median_season(obs.withColumn(_ALL, _one_group()), measure, [_ALL], method, accuracy).drop(_ALL)
    return _agg_quantiles(_values(obs, measure, keys), keys, [0.5], [f"median_{measure}"], method, accuracy)


def _half(lo: Column, hi: Column) -> Column:
    return (lo + hi) / F.lit(2.0)


def leaves(rows: DataFrame, rounds: int) -> DataFrame:
    """``rows`` (with _v and its group's extremes _lo0, _hi0) and the leaf cell ``_leaf`` each value walks down to.

    The same arithmetic in the same order as the rounds of ``median_bisect``.
    """
    kept = rows.columns
    walk = rows.select(*kept, F.col("_lo0").alias("_lo"), F.col("_hi0").alias("_hi"), F.lit(0).alias("_leaf"))
    for _ in range(rounds):
        walk = walk.withColumn("_mid", _half(F.col("_lo"), F.col("_hi")))
        right = F.col("_v") >= F.col("_mid")
        walk = walk.select(
            *kept,
            F.when(right, F.col("_mid")).otherwise(F.col("_lo")).alias("_lo"),
            F.when(right, F.col("_hi")).otherwise(F.col("_mid")).alias("_hi"),
            (F.col("_leaf") * 2 + right.cast("int")).alias("_leaf"),
        )
    return walk.drop("_lo", "_hi")


def replayed(groups: DataFrame, rounds: int) -> DataFrame:
    """``groups`` (n, _lo0, _hi0 and _cells: leaf counts, at most 2**rounds different leaves) after the rounds: _mid and _done."""
    kept = groups.columns
    st = groups.select(
        *kept, F.col("_lo0").alias("_lo"), F.col("_hi0").alias("_hi"), _half(F.col("_lo0"), F.col("_hi0")).alias("_mid"),
        F.lit(0).alias("_base"), F.lit(False).alias("_done"), F.lit(None).cast("long").alias("l"),
    )
    for r in range(rounds):
        split = F.col("_base") + F.lit(2 ** (rounds - r - 1))
        below = F.aggregate(
            F.filter("_cells", lambda c: c["leaf"] < split), F.lit(0).cast("long"),
            lambda acc, c: acc + c["cnt"],
        )
        st = st.withColumn("l", below)
        left_n, right_n = F.col("l"), F.col("n") - F.col("l")
        stop = F.col("_done") | (F.abs(left_n - right_n) <= 1)
        go_right = ~stop & (left_n < right_n)
        go_left = ~stop & (left_n >= right_n)
        st = st.select(
            *kept, "l", stop.alias("_done"),
            F.when(go_right, F.col("_mid")).otherwise(F.col("_lo")).alias("_lo"),
            F.when(go_left, F.col("_mid")).otherwise(F.col("_hi")).alias("_hi"),
            F.when(go_right, split).otherwise(F.col("_base")).alias("_base"),
        ).withColumn("_mid", _half(F.col("_lo"), F.col("_hi")))
    return st.drop("l", "_lo", "_hi", "_base")


def median_bisect(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year", "season"),
                  rounds: int = 10) -> DataFrame:
    """Bisection estimate of the median per group.

    Rounds: start with lo = min, hi = max, mid = (lo+hi)/2; count values below
    mid (l) and at or above it (r); if |l - r| <= 1 the group stops for good,
    else lo := mid when l < r, otherwise hi := mid; mid := (lo+hi)/2. The
    answer is mid after ``rounds`` rounds. Columns: keys, n, converged, bisect_<measure>.
    """
    if rounds < 1 or 2 ** rounds > MAX_LEAVES:
        raise ValueError(f"rounds must be within 1..{MAX_LEAVES.bit_length() - 1}: a group's leaf cells are walked as one array")
    if not keys:
        return median_bisect(obs.withColumn(_ALL, _one_group()), measure, [_ALL], rounds).drop(_ALL)
    orig_keys = list(keys)
    vals, keys = _pack(_values(obs, measure, orig_keys), orig_keys)
    bounds = _kept(vals.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo0"), F.max("_v").alias("_hi0"),
    ))

    met = with_group_stats(vals, bounds.select(*keys, "_lo0", "_hi0"), keys)
    cells = leaves(met, rounds).groupBy(*keys, "_leaf").agg(F.count(F.lit(1)).alias("_cnt"))
    per_group = cells.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("_leaf").alias("leaf"), F.col("_cnt").alias("cnt"))).alias("_cells")
    )
    st = replayed(bounds.join(per_group, keys), rounds)
    out = st.select(*keys, "n", F.col("_done").alias("converged"), F.col("_mid").alias(f"bisect_{measure}"))
    return _unpack(out, orig_keys, keys)


def box_stats(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year", "season"),
              whis: float = 1.5, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Box-plot statistics per group (A10) instead of the raw value lists.

    Quartiles by linear interpolation; whiskers are the most extreme values
    within ``whis`` * IQR of the box; values beyond them are outliers.
    Columns: keys, n, min, q1, median, q3, max, whisker_lo, whisker_hi, n_outliers.
    """
    if not keys:
        return box_stats(obs.withColumn(_ALL, _one_group()), measure, [_ALL], whis, method, accuracy).drop(_ALL)
    orig_keys = list(keys)
    vals, keys = _pack(_values(obs, measure, orig_keys), orig_keys)
    q = _agg_quantiles(vals, keys, (0.0, *QUARTILES, 1.0), ["min", "q1", "median", "q3", "max"], method, accuracy)
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("_lo_f", F.col("q1") - F.lit(whis) * iqr).withColumn("_hi_f", F.col("q3") + F.lit(whis) * iqr)
    stat_cols = ["n", "min", "q1", "median", "q3", "max", "_lo_f", "_hi_f"]
    v = F.col("_v")
    out = v < F.col("_lo_f")
    out = out | (v > F.col("_hi_f"))
    res = with_group_stats(vals, _kept(q), keys).groupBy(*keys, *stat_cols).agg(
        F.min(F.when(v >= F.col("_lo_f"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("_hi_f"), v)).alias("whisker_hi"),
        F.count_if(out).alias("n_outliers"),
    )
    return _unpack(res.drop("_lo_f", "_hi_f"), orig_keys, keys)


def box_outliers(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year", "season"),
                 carry: Sequence[str] = ("seq",), whis: float = 1.5, method: str = "exact",
                 accuracy: int = 10000) -> DataFrame:
    """The rows drawn as outliers of each box: keys, carried columns, value."""
    if not keys:
        return box_outliers(obs.withColumn(_ALL, _one_group()), measure, [_ALL], carry, whis, method,
                            accuracy).drop(_ALL)
    orig_keys = list(keys)
    carry = [c for c in carry if c in obs.columns]
    vals, keys = _pack(_values(obs, measure, orig_keys, carry), orig_keys)
    q = _agg_quantiles(vals, keys, (0.25, 0.75), ["_q1", "_q3"], method, accuracy)
    iqr = F.col("_q3") - F.col("_q1")
    q = q.select(*keys, (F.col("_q1") - F.lit(whis) * iqr).alias("_lo_f"),
                 (F.col("_q3") + F.lit(whis) * iqr).alias("_hi_f"))
    v = F.col("_v")
    out = (with_group_stats(vals, _kept(q), keys).where((v < F.col("_lo_f")) | (v > F.col("_hi_f")))
           .select(*keys, *carry, v.alias(measure)))
    return _unpack(out, orig_keys, keys)
