from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from storefront_analytics.plans import evidence, reviews, summaries, validation
from storefront_analytics.sources.scratch import store
from tests.conftest import at, rows
from tests.test_detector_and_evidence import _results, _row

RUN_AT = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def package(spark):
    data = [_row("Email|TOTAL_ORDERS", 1, y=9.0, distance=4.0), _row("Email|CART_ABANDONMENT_RATE", 2, distance=5.0)]
    return evidence.executive_summary_input(_results(spark, data), RUN_AT)


def test_append_twice_adds_once(spark, package, tmp_path):
    path = f"file://{tmp_path}/history"
    first = store(summaries.summary_candidates(package, RUN_AT), "candidates")
    assert summaries.append_summaries(first, path) == 1
    assert summaries.append_summaries(first, path) == 0
    later = store(summaries.summary_candidates(package, datetime(2024, 7, 1)), "candidates")
    assert summaries.append_summaries(later, path) == 0  # the time is not part of the key
    bumped = store(summaries.summary_candidates(package, RUN_AT, prompt_version="v2.1"), "candidates")
    assert summaries.append_summaries(bumped, path) == 1
    history = spark.read.parquet(path)
    assert history.select("summary_id").distinct().count() == 2
    assert {r["review_status"] for r in history.collect()} == {"PENDING_REVIEW"}


def test_known_keys(package):
    candidates = store(summaries.summary_candidates(package, RUN_AT), "candidates")
    other = candidates.frame.withColumn("input_hash", F.lit("other"))
    assert summaries.new_summaries(candidates, candidates.frame).count() == 0
    assert summaries.new_summaries(candidates, other).count() == 1
    unnamed = candidates.frame.withColumn("model_name", F.lit(None).cast("string"))
    assert summaries.new_summaries(candidates, unnamed).count() == 1


def test_text_restates_the_evidence(package):
    text = package.select(summaries.summary_text(F.col("evidence_package"))).first()[0]
    assert "2 unusual values were detected." in text
    assert "Email CART_ABANDONMENT_RATE on 2023-01-03: 1.00 is above" in text
    assert "potentially unfavorable [ANOM-0001]" in text and "potentially favorable [ANOM-0002]" in text


def test_text_of_the_caller(package):
    out = summaries.summary_candidates(package, RUN_AT, text=lambda p: F.upper(F.substring(p, 1, 9)), model_name="mine")
    row = rows(out)[0]
    assert row["generated_summary"] == "REPORT ON" and row["model_name"] == "mine"


def test_older_history_gets_review_columns(package):
    old = summaries.summary_candidates(package, RUN_AT).drop("reviewed_by", "reviewed_at", "review_notes")
    out = summaries.with_review_columns(old)
    assert out.columns == summaries.HISTORY_COLUMNS and rows(out)[0]["reviewed_at"] is None


def history_row(sid, status="PENDING_REVIEW", reviewed_at=None, n=0, text="text"):
    return (
        sid, date(2024, 1, 1), date(2024, 1, 31), "m", "v2.0", "v2.0", f"h{sid}", "prompt", text,
        datetime(2024, 2, 1, 0, n), status, None, reviewed_at, None,
    )


DECISIONS = (
    "decision_id bigint, summary_id string, decision string, reviewer string, notes string, "
    "evidence_checked boolean, seen_status string, seen_reviewed_at timestamp_ntz, submitted_at timestamp_ntz"
)


def decision(i, sid, verdict="APPROVED", reviewer=" Ann ", notes="ok\n", checked=True, seen="PENDING_REVIEW", seen_at=None):
    return (i, sid, verdict, reviewer, notes, checked, seen, seen_at, datetime(2024, 3, 1, 0, i))


def test_batch_of_reviews(spark):
    before = at("2024-02-10 08:00:00")
    history = spark.createDataFrame(
        [
            history_row("fresh"),
            history_row("again", "REJECTED", before),
            history_row("stale", "APPROVED", before),
            history_row("double"),
            history_row("double"),
            history_row("split"),
            history_row("split", "APPROVED", before),
            history_row("untouched", None),
        ],
        summaries.HISTORY_SCHEMA,
    )
    decisions = spark.createDataFrame(
        [
            decision(1, "fresh", notes="  "),  # invalid, so the next one is the first
            decision(2, "fresh", "REJECTED"),
            decision(3, "fresh"),  # the row has changed by then
            decision(4, "again", seen="REJECTED", seen_at=before),
            decision(5, "stale", seen="APPROVED", seen_at=None),
            decision(6, "double"),
            decision(7, "split"),  # one of two rows is as seen
            decision(8, "unknown"),
            decision(9, "untouched", seen=None),
            decision(10, "fresh", "NEEDS_REVISION"),
            decision(11, "fresh", checked=False),
            decision(12, "fresh", reviewer=None),
        ],
        DECISIONS,
    )
    judged = reviews.judged_decisions(history, decisions)
    why = {r["decision_id"]: r["reason"] for r in rows(judged)}
    assert [i for i in why if why[i] is None] == [2, 4, 7] or sorted(i for i in why if why[i] is None) == [2, 4, 7]
    assert {i for i in why if why[i] == reviews.INVALID} == {1, 10, 11, 12}
    assert {i for i in why if why[i] == reviews.CHANGED} == {3, 5, 6, 8, 9}
    updated = rows(reviews.apply_reviews(history, judged, RUN_AT))
    assert len(updated) == 8 and {r["generated_summary"] for r in updated} == {"text"}
    fresh = next(r for r in updated if r["summary_id"] == "fresh")
    assert (fresh["review_status"], fresh["reviewed_by"], fresh["review_notes"]) == ("REJECTED", "Ann", "ok")
    assert fresh["reviewed_at"] == RUN_AT
    split = sorted((r["review_status"], r["reviewed_at"]) for r in updated if r["summary_id"] == "split")
    assert split == [("APPROVED", before), ("APPROVED", RUN_AT)]
    stale = next(r for r in updated if r["summary_id"] == "stale")
    assert stale["reviewed_at"] == before
    assert reviews.review_conflicts(judged).count() == 9
    assert {r["summary_id"] for r in rows(summaries.approved_summaries(history))} == {"stale", "split"}


def test_queue_and_history_questions(spark):
    history = spark.createDataFrame(
        [history_row("a", n=1), history_row("b", "APPROVED", n=3), history_row("b", "ODD", n=2, text=" "), history_row(None, None, n=0, text=None)],
        summaries.HISTORY_SCHEMA,
    )
    assert [r["summary_id"] for r in reviews.review_queue(history).collect()] == ["b", "b", "a", None]
    assert [r["summary_id"] for r in reviews.review_queue(history, "APPROVED").collect()] == ["b"]
    assert rows(validation.latest_summary(history))[0]["review_status"] == "APPROVED"
    missing = rows(validation.missing_fields(history))[0]
    assert (missing["total_summaries"], missing["missing_summary_ids"], missing["empty_summaries"]) == (4, 1, 1)
    assert rows(validation.duplicate_ids(history)) == [{"summary_id": "b", "duplicate_count": 2}]
    assert {r["review_status"] for r in rows(validation.unexpected_statuses(history))} == {"ODD", None}
    assert rows(validation.period_dates(history))[0]["invalid_reporting_periods"] == 0
    assert [r["summary_character_count"] for r in validation.summary_lengths(history).collect()] == [4, 1, 4, None]


def test_stream_appends_only_new_packages(spark, package, tmp_path):
    from storefront_analytics.streaming.summary_append import append_new_packages, read_packages

    folder, history, checkpoint = (f"file://{tmp_path}/{n}" for n in ("packages", "history", "checkpoint"))

    def run():
        stream = read_packages(spark, folder, package.schema)
        append_new_packages(stream, history, checkpoint, generated_at=RUN_AT).awaitTermination()
        return spark.read.parquet(history).count()

    package.write.mode("append").parquet(folder)
    package.write.mode("append").parquet(folder)  # the same evidence in a second file
    assert run() == 1
    assert run() == 1  # nothing arrived
    package.write.mode("append").parquet(folder)
    assert run() == 1  # arrived again, known by its digest
    other = evidence.executive_summary_input(_results(spark, [_row("Email|TOTAL_ORDERS", 9)]), RUN_AT)
    other.write.mode("append").parquet(folder)
    assert run() == 2
