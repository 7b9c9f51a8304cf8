"""Vocabulary mapping and the person load of the common data model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import ColumnLike, col
from .quality import dq_unique


def map_concepts(concept: DataFrame, relationship: DataFrame, vocabulary: str, target: str | None = None,
                 code: str | None = None, kind: str = "Maps to") -> DataFrame:
    """Standard concepts for the codes of one vocabulary (two-hop join).

    ``code`` narrows to one source code, ``target`` to one target vocabulary.
    All filters sit below the joins.
    """
    source = concept.where(F.col("vocabulary_id") == vocabulary)
    if code is not None:
        source = source.where(F.col("concept_code") == code)
    source = source.select(
        F.col("concept_id").alias("concept_id_1"),
        F.col("concept_code").alias("source_code"),
        F.col("concept_name").alias("source_name"),
    )
    hop = relationship.where(F.col("relationship_id") == kind).select("concept_id_1", "concept_id_2")
    goal = concept.where(F.col("standard_concept") == "S")
    if target is not None:
        goal = goal.where(F.col("vocabulary_id") == target)
    goal = goal.select(
        F.col("concept_id").alias("concept_id_2"),
        F.col("concept_id").alias("standard_concept_id"),
        F.col("concept_name").alias("standard_name"),
    )
    return source.join(hop, "concept_id_1").join(goal, "concept_id_2").select(
        "source_code", "source_name", "standard_concept_id", "standard_name"
    )


def surrogate_id(c: ColumnLike) -> Column:
    """Repeatable id from a natural key: all 128 bits of md5 as text; the same on every engine that has md5.

    Two of n keys share an id with a chance of about n^2 / 2^129.
    """
    return F.md5(col(c).cast("string"))


def checked_persons(persons: DataFrame) -> DataFrame:
    """``persons`` if no id stands for two different people; an error otherwise, before any row is passed on."""
    clash = dq_unique(persons.select("person_id", "person_source_value").distinct(), ["person_id"]).limit(1).count()
    if clash:
        raise ValueError("a person_id stands for more than one source patient")
    return persons


def omop_person_load(patients: DataFrame, locations: DataFrame | None = None,
                     lookup: Mapping[str, str] | None = None) -> DataFrame:
    """PERSON rows from cleaned patients; an error if an id stands for two of them (:func:`checked_persons`).

    With ``locations`` the ``location_id`` is looked up by ``{patient column:
    location column}``; else the patients carry it already.
    """
    rows = patients
    if locations is not None:
        pairs = dict(lookup or {"zip": "zip"})
        found = locations.select(*[F.col(l).alias(p) for p, l in pairs.items()], "location_id")
        rows = rows.join(found, list(pairs), "left")
    born = F.col("birth_datetime")
    return checked_persons(rows.select(
        surrogate_id("source_patient_id").alias("person_id"),
        "gender_concept_id",
        F.year(born).alias("year_of_birth"),
        F.month(born).alias("month_of_birth"),
        F.dayofmonth(born).alias("day_of_birth"),
        "birth_datetime",
        "race_concept_id",
        "ethnicity_concept_id",
        "location_id",
        F.col("source_patient_id").alias("person_source_value"),
    ))
