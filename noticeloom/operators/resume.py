"""Resuming work and folding its outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify(sections: DataFrame, records: DataFrame, section: str = "id", ref: str = "section_ref", final: Column | None = None) -> DataFrame:
    """section, n_records, n_pending and action of every row of `sections` by what is stored of it: extract (no record),
    skip (all final) or rerun (some pending). Records are pre-aggregated, so a section's size does not matter."""
    final = F.col("final") if final is None else final
    state = records.where(F.col(ref).isNotNull()).groupBy(F.col(ref).alias("__ref")).agg(F.count("*").alias("n_records"), F.count_if(~final).alias("n_pending"))
    met = sections.join(state, F.col(section) == F.col("__ref"), "left").withColumns({"n_records": F.coalesce("n_records", F.lit(0)), "n_pending": F.coalesce("n_pending", F.lit(0))})
    action = F.when(F.col("n_records") == 0, "extract").when(F.col("n_pending") == 0, "skip").otherwise("rerun")
    return met.select(F.col(section).alias("section"), "n_records", "n_pending", action.alias("action"))


def outcome(events: DataFrame, keys: list[str], processed: str, failed: str, error: str, order: list[str]) -> DataFrame:
    """keys, processed, failed, first_error and status (failed if anything failed, else validated)."""
    first = F.min_by(error, F.when(F.col(error).isNotNull(), F.struct(*order)))
    out = events.groupBy(*keys).agg(F.sum(processed).alias("processed"), F.sum(failed).alias("failed"), first.alias("first_error"))
    return out.withColumn("status", F.when(F.col("failed") > 0, "failed").otherwise("validated"))


def illegal(moves: DataFrame, legal: DataFrame) -> DataFrame:
    """Rows of `moves` (state_from, state_to) that the table of legal moves does not hold."""
    return moves.join(F.broadcast(legal.select("state_from", "state_to").distinct()), ["state_from", "state_to"], "left_anti")
