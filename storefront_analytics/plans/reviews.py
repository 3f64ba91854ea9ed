"""Review queue and batches of review decisions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import count_rows
from storefront_analytics.plans.summaries import HISTORY_COLUMNS

# Fixed values.
DECISIONS = ("APPROVED", "REJECTED")
ALL_STATUSES = "All"

# Why a decision was not applied.
INVALID = "INVALID_DECISION"
CHANGED = "RECORD_CHANGED_OR_NOT_UNIQUE"

_BLANKS = " \t\n\r\f\x0b"


def review_queue(history: DataFrame, status: str = ALL_STATUSES) -> DataFrame:
    """Stored summaries, newest first, in one review state or in all."""
    rows = history if status == ALL_STATUSES else history.filter(F.col("review_status") == status)
    return rows.select(
        "summary_id",
        "generated_summary",
        "prompt_text",
        "generated_at",
        "period_start_date",
        "period_end_date",
        "review_status",
        "reviewed_by",
        "reviewed_at",
        "review_notes",
    ).orderBy(F.col("generated_at").desc())


def _trimmed(name: str) -> Column:
    return F.btrim(F.col(name), F.lit(_BLANKS))


def _filled(name: str) -> Column:
    return F.coalesce(_trimmed(name) != "", F.lit(False))


def is_valid() -> Column:
    """A decision needs a known verdict, a name, notes and the confirmation."""
    known = F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False))
    confirmed = F.coalesce("evidence_checked", F.lit(False))
    return known & confirmed & _filled("reviewer") & _filled("notes")


def _same_state(decisions: DataFrame, rows: DataFrame) -> Column:
    return (
        (decisions["summary_id"] == rows["summary_id"])
        & (decisions["seen_status"] == rows["review_status"])
        & decisions["seen_reviewed_at"].eqNullSafe(rows["reviewed_at"])
    )


def judged_decisions(history: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every decision with ``reason`` null if it applies, else why it does not.

    A decision applies when exactly one stored row still is as the reviewer saw
    it, and no earlier decision of the batch changed that row. Rows and
    decisions are counted per state before they meet, so many rows under one id
    never form pairs.
    """
    states = history.groupBy("summary_id", "review_status", "reviewed_at").agg(count_rows().alias("_rows"))
    turn = F.struct("submitted_at", "decision_id")
    first = (
        decisions.filter(is_valid())
        .groupBy("summary_id", "seen_status", "seen_reviewed_at")
        .agg(F.min(turn).alias("_first"))
    )
    turns = (
        states.filter(F.col("_rows") == 1)
        .join(first, _same_state(first, states))
        .select(states["summary_id"], "review_status", "reviewed_at", "_first")
    )
    mine = F.coalesce(turn == F.col("_first"), F.lit(False))
    return decisions.join(turns, _same_state(decisions, turns), "left").select(
        *[decisions[c] for c in decisions.columns],
        F.when(~is_valid(), F.lit(INVALID)).when(~mine, F.lit(CHANGED)).alias("reason"),
    )


def apply_reviews(history: DataFrame, judged: DataFrame, reviewed_at: datetime) -> DataFrame:
    """The history with the applicable decisions written in; texts stay as they are."""
    wins = judged.filter(F.col("reason").isNull()).select(
        "summary_id",
        "seen_status",
        "seen_reviewed_at",
        F.col("decision").alias("_decision"),
        _trimmed("reviewer").alias("_reviewer"),
        _trimmed("notes").alias("_notes"),
    )
    hit = F.col("_decision").isNotNull()
    at = F.lit(reviewed_at.isoformat(sep=" ")).cast("timestamp_ntz")
    changed = {
        "review_status": F.when(hit, F.col("_decision")).otherwise(history["review_status"]),
        "reviewed_by": F.when(hit, F.col("_reviewer")).otherwise(history["reviewed_by"]),
        "reviewed_at": F.when(hit, at).otherwise(history["reviewed_at"]),
        "review_notes": F.when(hit, F.col("_notes")).otherwise(history["review_notes"]),
    }
    return history.join(wins, _same_state(wins, history), "left").select(
        *[changed.get(c, history[c]).alias(c) for c in HISTORY_COLUMNS]
    )


def review_conflicts(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).select("decision_id", "summary_id", "decision", "reason")
