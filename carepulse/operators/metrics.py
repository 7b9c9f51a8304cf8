"""Metric views: named dimensions and measures, evaluated at any grouping, from the source or from stored states."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import ColumnLike, col
from ..sources.files import footer_counts
from ..sources.versions import Versions


@dataclass(frozen=True)
class MetricView:
    source: DataFrame
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Column]

    def evaluate(self, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
        """The named measures grouped by the named dimensions (none: one total row)."""
        unknown = [n for n in by if n not in self.dimensions] + [n for n in measures if n not in self.measures]
        if unknown:
            raise KeyError(f"not defined in this metric view: {unknown}")
        keys = [self.dimensions[n].alias(n) for n in by]
        return self.source.groupBy(*keys).agg(*[self.measures[n].alias(n) for n in measures])


def metric_view(df: DataFrame, dimensions: Mapping[str, Column], measures: Mapping[str, Column],
                by: Sequence[str] = ()) -> DataFrame:
    """All measures of a view at one grouping."""
    return MetricView(df, dimensions, measures).evaluate(list(measures), by)


@dataclass(frozen=True)
class Mergeable:
    """A measure made of partial states: each is an aggregate of rows, merged by an aggregate of states."""

    states: Mapping[str, tuple[Column, Callable[[str], Column]]]
    result: Callable[[Mapping[str, Column]], Column]


def _single(state: Column, merge: Callable[[str], Column]) -> Mergeable:
    return Mergeable({"s": (state, merge)}, lambda m: m["s"])


def row_total() -> Mergeable:
    return Mergeable({"n": (F.count(F.lit(1)), F.sum)}, lambda m: F.coalesce(m["n"], F.lit(0).cast("long")))


def total_of(c: ColumnLike) -> Mergeable:
    return _single(F.sum(col(c)), F.sum)


def least_of(c: ColumnLike) -> Mergeable:
    return _single(F.min(col(c)), F.min)


def largest_of(c: ColumnLike) -> Mergeable:
    return _single(F.max(col(c)), F.max)


def mean_of(c: ColumnLike) -> Mergeable:
    """Mean of the values that aren't NULL; of a flag its share."""
    value = col(c).cast("double")
    return Mergeable({"s": (F.sum(value), F.sum), "n": (F.count(value), F.sum)},
                     lambda m: F.when(m["n"] > 0, m["s"] / m["n"]))


def distinct_of(c: ColumnLike) -> Mergeable:
    """Number of distinct values, estimated by a sketch of bounded size (about 1.6 %)."""
    return Mergeable({"h": (F.hll_sketch_agg(col(c)), F.hll_union_agg)},
                     lambda m: F.coalesce(F.hll_sketch_estimate(m["h"]), F.lit(0).cast("long")))


@dataclass(frozen=True)
class MetricStore:
    """Partial states of measures, stored at one or more fine grains below ``root`` and answered at any coarser one.

    A question is answered from the stored state with the fewest rows that has all its dimensions; the source is not read.
    Each grain is versioned, so storing anew never leaves readers without an answer.
    """

    spark: SparkSession
    root: str
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Mergeable]

    def _versions(self, grain: Sequence[str]) -> Versions:
        return Versions(self.spark, f"{self.root}/{'+'.join(sorted(grain)) or 'all'}")

    def _known(self, names: Sequence[str], what: Mapping) -> None:
        if unknown := [n for n in names if n not in what]:
            raise KeyError(f"not defined in this metric store: {unknown}")

    def store(self, source: DataFrame, grain: Sequence[str], keep: int = 2) -> str:
        """Aggregate ``source`` to the grain and store the states; returns their folder."""
        self._known(grain, self.dimensions)
        states = {f"{n}__{part}": state for n, m in self.measures.items() for part, (state, _) in m.states.items()}
        keys = [self.dimensions[n].alias(n) for n in sorted(grain)]
        versions = self._versions(grain)
        at = versions.write(source.groupBy(*keys).agg(*[s.alias(n) for n, s in states.items()]))
        versions.expire(keep)
        return at.path

    def covering(self, by: Sequence[str], grains: Sequence[Sequence[str]]) -> Versions:
        """The stored grain with the fewest rows that has all dimensions of ``by``."""
        found = {v.root: v for g in grains if set(by) <= set(g) and (v := self._versions(g)).current() is not None}
        if not found:
            raise LookupError(f"no stored state covers {sorted(by)}")
        sizes = footer_counts(self.spark, {root: v.current().path for root, v in found.items()}).collect()
        return found[min((r["row_count"], r["table_name"]) for r in sizes)[1]]

    def answer(self, measures: Sequence[str], by: Sequence[str], grains: Sequence[Sequence[str]], where: Column | None = None) -> DataFrame:
        """The named measures grouped by ``by``, from one of the stored ``grains``; ``where`` may use its dimensions."""
        self._known(by, self.dimensions)
        self._known(measures, self.measures)
        states = self.covering(by, grains).read()
        states = states if where is None else states.where(where)
        parts = [(n, part, merge) for n in measures for part, (_, merge) in self.measures[n].states.items()]
        merged = states.groupBy(*by).agg(*[merge(f"{n}__{part}").alias(f"{n}__{part}") for n, part, merge in parts])
        return merged.select(*by, *[
            self.measures[n].result({part: F.col(f"{n}__{part}") for part in self.measures[n].states}).alias(n) for n in measures])
