"""Exact order statistics of groups of any size, by histograms of ordered numbers.

Equal values are one row with a count. While a group has more distinct values than a
task should hold, its values become long integers that sort like them, are counted by
their leading digits, and only those in the digit that holds the wanted rank stay: no
larger group is ever sorted, and nothing larger than a histogram meets in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import ColumnLike, col
from ..session import shared_dir
from ..sources.files import stored

#: Distinct values of a group that one task may hold, 24 bytes each, and digits that a histogram has.
FEW, DIGITS = 1 << 16, 1 << 12
_SHIFT = DIGITS.bit_length() - 1
#: Bits of a double's fraction, and its smallest normal exponent.
_FRACTION, _LOWEST = 52, -1022


def _double_order(c: Column) -> Column:
    """The long whose order is that of doubles: sign, exponent and fraction. NaN comes last, both zeros are 0."""
    size = F.abs(c)
    # the logarithm may be off by one next to a power of two
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(_LOWEST)), F.lit(1023)).cast("int")
    power = F.pow(F.lit(2.0), guess.cast("double"))
    e = F.when(size < power, guess - 1).when(size / power >= 2, guess + 1).otherwise(guess)
    scale = F.pow(F.lit(2.0), e.cast("double"))
    normal = F.shiftleft((e - _LOWEST + 1).cast("long"), _FRACTION) + ((size / scale - 1) * F.lit(2.0 ** _FRACTION)).cast("long")
    tiny = (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    most = F.lit(2047 << _FRACTION)
    magnitude = F.when(size == 0, F.lit(0).cast("long")).when(size < F.lit(2.0 ** _LOWEST), tiny).when(
        size == F.lit(float("inf")), most).otherwise(normal)
    return F.when(F.isnan(c), most + 1).otherwise(F.when(c < 0, -magnitude).otherwise(magnitude))


def _as_number(c: Column, kind: T.DataType) -> tuple[Column, Column]:
    """The value as a long if that is exact, else as a double; the other one is NULL."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long"), F.lit(None).cast("double")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10 ** kind.scale)).cast("long"), F.lit(None).cast("double")
    if not isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        raise TypeError(f"no quantile of a {kind.simpleString()}")
    return F.lit(None).cast("long"), c.cast("double")


def _value(whole: str, value: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (F.col(whole).cast(T.DecimalType(38, 0)) / F.lit(10 ** kind.scale)).cast(kind)
    return F.coalesce(F.col(value), F.col(whole).cast("double")).cast(kind) if isinstance(
        kind, (T.DoubleType, T.FloatType, T.DecimalType)) else F.col(whole).cast(kind)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_r{i}"]) for i, k in enumerate(keys)])


def _renamed(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    return groups.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})


def _first_reaching(rows: Column, need: Column, fields: Sequence[str]) -> Column:
    """Of structs (…, n) in order, the first whose running count reaches ``need``, with what came before it as ``before``."""
    start = F.struct(F.lit(0).cast("long").alias("so_far"), F.lit(0).cast("long").alias("before"),
                     *[F.element_at(rows, 1)[f].alias(f) for f in fields])

    def step(state: Column, row: Column) -> Column:
        # once reached, the state stays; else the row takes its place
        reached = state["so_far"] >= need
        return F.struct(
            F.when(reached, state["so_far"]).otherwise(state["so_far"] + row["n"]).alias("so_far"),
            F.when(reached, state["before"]).otherwise(state["so_far"]).alias("before"),
            *[F.when(reached, state[f]).otherwise(row[f]).alias(f) for f in fields])

    return F.aggregate(rows, start, step)


def _narrow(counted: DataFrame, state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One round: (groups, lo, hi, distinct, need) of the digit that holds the wanted rank."""
    right = _renamed(state, groups)
    inside = counted.join(right, _same(counted, right, groups) & (F.col("_key") >= F.col("lo")) & (F.col("_key") <= F.col("hi")))
    # the first digits are sign and exponent; then the range that is left, in DIGITS parts
    wide = (F.shiftright("hi", _FRACTION) - F.shiftright("lo", _FRACTION)) > 0
    bits = F.greatest(F.lit(0), F.length(F.bin(F.col("hi") - F.col("lo"))) - _SHIFT)
    digit = F.when(wide, F.shiftright("_key", _FRACTION)).otherwise(
        F.call_function("shiftright", F.when(wide, F.lit(0)).otherwise(F.col("_key") - F.col("lo")), F.when(wide, F.lit(0)).otherwise(bits)))
    tally = inside.groupBy(*groups, digit.alias("digit")).agg(
        F.sum("_n").alias("n"), F.count("*").alias("distinct"), F.min("_key").alias("lo"), F.max("_key").alias("hi"), F.first("need").alias("need"))
    rows = F.array_sort(F.collect_list(F.struct("digit", "n", "distinct", "lo", "hi")))  # DIGITS at most
    found = tally.groupBy(*groups).agg(rows.alias("rows"), F.first("need").alias("need"))
    found = found.withColumn("at", _first_reaching(F.col("rows"), F.col("need"), ["distinct", "lo", "hi"]))
    return found.select(*groups, "at.lo", "at.hi", "at.distinct", (F.col("need") - F.col("at.before")).alias("need"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], cols: Mapping[str, ColumnLike], p: float = 0.5, few: int = FEW) -> DataFrame:
    """Per group the smallest value that at least the share ``p`` of its values do not exceed (0.5: the
    lower median), for each of ``cols``: ``{name: column}``, numeric. NULL values don't count; NULL keys form a group.

    Exact for groups of any size and any values (decimals of more than 18 digits as doubles). Rows are counted per group
    and value, combined map-side, and stored. A group of up to ``few`` distinct values is settled at once;
    larger ones first go through rounds of histograms, five at most, that leave only the part with the wanted rank.
    """
    spark = df.sparkSession
    kept = df.select(*keys, *[col(c).alias(f"_q{i}") for i, c in enumerate(cols.values())])
    kinds = [kept.schema[f"_q{i}"].dataType for i in range(len(cols))]

    def row(i: int, kind: T.DataType) -> Column:
        whole, value = _as_number(F.col(f"_q{i}"), kind)
        return F.struct(F.lit(i).alias("_which"), whole.alias("_whole"), value.alias("_value"))

    groups = [*keys, "_which"]
    stacked = kept.select(*keys, F.inline(F.array(*[row(i, kind) for i, kind in enumerate(kinds)])))
    seen = Observation()
    counted = stacked.groupBy(*groups, "_whole", "_value").agg(F.count(F.lit(1)).alias("_n"))
    counted = stored(counted.observe(seen, F.count(F.lit(1)).alias("rows")), shared_dir(spark, "counted"))
    known = counted.where("_whole IS NOT NULL OR _value IS NOT NULL")
    need = F.sum("_n") * F.lit(p)
    if seen.get["rows"] > few:
        known, need = _part_with_rank(known, groups, p, few), F.first("need")
    rows = F.array_sort(F.collect_list(F.struct(F.col("_whole").alias("whole"), F.col("_value").alias("value"), F.col("_n").alias("n"))))
    found = known.groupBy(*groups).agg(rows.alias("rows"), need.alias("need")).select(
        *groups, _first_reaching(F.col("rows"), F.col("need"), ["whole", "value"]).alias("at")).select(*groups, "at.whole", "at.value")
    # a group whose values are all NULL has a row of NULLs
    nulls = counted.where("_whole IS NULL AND _value IS NULL").select(*groups, F.col("_whole").alias("whole"), F.col("_value").alias("value"))
    return found.unionByName(nulls).groupBy(*keys).agg(*[
        F.max(F.when(F.col("_which") == i, _value("whole", "value", kind))).cast(kind).alias(name) for i, (name, kind) in enumerate(zip(cols, kinds))])


def _part_with_rank(known: DataFrame, groups: Sequence[str], p: float, few: int) -> DataFrame:
    """``known`` without the values of large groups that can't have the wanted rank; ``need`` is the rank in what is left."""
    spark = known.sparkSession
    known = known.withColumn("_key", F.coalesce("_whole", _double_order(F.col("_value"))))
    totals = known.groupBy(*groups).agg(F.min("_key").alias("lo"), F.max("_key").alias("hi"), F.count("*").alias("distinct"),
                                        (F.sum("_n") * F.lit(p)).alias("need"))
    state = stored(totals, shared_dir(spark, "quantile-round"))
    while (state.agg(F.max("distinct")).first()[0] or 0) > few:
        large = _narrow(known, state.where(F.col("distinct") > few), groups)
        state = stored(state.where(F.col("distinct") <= few).unionByName(large), shared_dir(spark, "quantile-round"))
    right = _renamed(state, groups)
    part = known.join(right, _same(known, right, groups) & (F.col("_key") >= F.col("lo")) & (F.col("_key") <= F.col("hi")))
    return part.select(*[known[c] for c in known.columns], "need")
