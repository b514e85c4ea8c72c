"""Event-lake jobs on Spark: parse, canonicalise, enrich, quarantine and analyse events."""
