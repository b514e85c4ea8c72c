"""Curated tables joined from several canonical event types."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.masking import hash_value
from millrace.operators.joins import lookup_join


def encounters(canonical: DataFrame, salt: str) -> DataFrame:
    """Encounters of messages with what FHIR resources know of the same person.

    Resources are aggregated per person first, so both joins meet unique keys. A visit belongs to the patient that its
    ``subject`` (Patient/id) names.
    Patient ids leave only as salted hashes.
    """
    fhir = canonical.filter(F.col("format") == "fhir")
    patients = fhir.filter("patient IS NOT NULL").groupBy(F.col("patient.id").alias("entity_id")).agg(
        F.count("*").alias("patient_records"))
    person = F.when(F.col("subject").startswith("Patient/"), F.substring_index("subject", "/", -1))
    visits = fhir.filter(F.col("encounter").isNotNull() & person.isNotNull()).groupBy(person.alias("entity_id")).agg(
        F.count("*").alias("ambulatory_visits"))
    people = patients.join(visits, "entity_id", "full")
    rows = canonical.filter(F.col("format").isin("hl7", "x12") & (F.col("entity_type") == "patient")).select(
        "msg_id", "event_id", "format", "entity_id", F.col("encounter.id").alias("encounter_id"),
        F.col("observation.code").alias("observation_code"))
    joined = lookup_join(rows, people, ["entity_id"], "left", ["event_id"])
    return joined.select(
        "msg_id", "format", "encounter_id", "observation_code", hash_value(F.col("entity_id"), salt).alias("patient_key"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("patient_records", "ambulatory_visits")])
