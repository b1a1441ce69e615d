"""The cleaning run, in its fixed order, as one lazy plan with four shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagloom.operators import clean as c


def merged_records(raw: DataFrame) -> DataFrame:
    kept = c.exclude_labels(c.drop_incomplete(c.project_used(raw)))
    return c.merge_groups(kept)


def repaired_records(raw: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """Everything before de-duplication; the label vocabulary is taken from here."""
    merged = merged_records(raw)
    if override is not None:
        merged = c.override_text(merged, override)
    return c.strip_signature(c.strip_truncation_suffix(c.drop_placeholders(merged)))


def unique_records(repaired: DataFrame) -> DataFrame:
    """Unique texts, then unique ids, the first in (movie_id, movie_name) order."""
    return c.dedup_by_id(c.dedup_by_text(repaired))


def clean_records(raw: DataFrame, override: DataFrame | None = None) -> DataFrame:
    return unique_records(repaired_records(raw, override))
