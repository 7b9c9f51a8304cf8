"""Cleaning expressions: enum normalisation, flags, defaults, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _case(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    if not branches:
        return default
    first, *rest = branches
    chain = reduce(lambda acc, b: acc.when(*b), rest, F.when(*first))
    return chain.otherwise(default)


def enum_exact(c: ColumnLike, allowed: Sequence[str], default: str, trim: bool = True) -> Column:
    """The value if it is in ``allowed``, else ``default`` (also for NULL)."""
    value = F.trim(col(c)) if trim else col(c)
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))


def enum_ci(c: ColumnLike, allowed: Sequence[str], otherwise: str | Column) -> Column:
    """Canonical spelling of a trimmed, case-insensitive match, else ``otherwise``.

    ``otherwise`` is a literal, or a Column such as ``coalesce(raw, default)``
    (keep unknown values raw), ``lower(trim(raw))`` or a looked-up value.
    """
    folded = F.lower(F.trim(col(c)))
    fallback = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    return _case([(folded == a.lower(), F.lit(a)) for a in allowed], fallback)


def enum_ci_keep_unknown(c: ColumnLike, allowed: Sequence[str], default: str) -> Column:
    """Like :func:`enum_ci`; an unknown value passes unchanged, NULL becomes ``default``."""
    return enum_ci(c, allowed, F.coalesce(col(c), F.lit(default)))


def enum_ci_self(c: ColumnLike, allowed: Sequence[str]) -> Column:
    """Like :func:`enum_ci`; an unknown value becomes its own lower-case trimmed form."""
    return enum_ci(c, allowed, F.lower(F.trim(col(c))))


def classify(rules: Sequence[tuple[Column, str | Column]], default: str) -> Column:
    """First matching predicate decides the class; NULL predicates do not match."""
    return _case(
        [(pred, F.lit(out) if isinstance(out, str) else out) for pred, out in rules],
        F.lit(default),
    )


def bucket_in(c: ColumnLike, buckets: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of the member list that holds the value."""
    return _case([(col(c).isin(*members), F.lit(label)) for label, members in buckets.items()], F.lit(default))


def band_probability(c: ColumnLike, bands: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first band whose upper bound lies above the value."""
    return _case([(col(c) < bound, F.lit(label)) for bound, label in bands], F.lit(top))


def flag(predicate: Column) -> Column:
    """Predicate as TRUE or FALSE, never NULL."""
    return F.coalesce(predicate, F.lit(False))


def value_if(predicate: Column, c: ColumnLike, other: float = 0.0) -> Column:
    """The value where the flag holds, else ``other``."""
    return F.when(predicate, col(c)).otherwise(F.lit(other))


def null_default(c: ColumnLike, default) -> Column:
    return F.coalesce(col(c), F.lit(default))
