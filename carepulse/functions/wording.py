"""Text-building expressions for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnLike, col


def join_sentences(parts: Sequence[tuple[Column, str]]) -> Column:
    """Texts whose flag holds, joined by ``'. '`` and closed by ``'.'``; NULL if none holds."""
    flagged = [F.when(pred, F.lit(text)) for pred, text in parts]
    present = F.coalesce(*flagged).isNotNull()
    return F.when(present, F.concat(F.concat_ws(". ", *flagged), F.lit(".")))


def glucose_text(c: ColumnLike) -> Column:
    return F.format_string("%d mg/dL", col(c).cast("int"))


def pressure_text(systolic: ColumnLike, diastolic: ColumnLike) -> Column:
    shown = F.format_string("%d/%d mmHg", col(systolic).cast("int"), col(diastolic).cast("int"))
    return F.when(col(systolic).isNotNull() & col(diastolic).isNotNull(), shown)


POUNDS_PER_KG = 2.20462


def pounds_text(kg: ColumnLike) -> Column:
    return F.format_string("%.1f lbs", col(kg) * POUNDS_PER_KG)
