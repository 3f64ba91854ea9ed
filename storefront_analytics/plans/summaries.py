"""Prompt, narrative and the append-only history of summaries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_analytics.plans.evidence import desired_direction, evidence_json
from storefront_analytics.sources.pointers import AppendLog
from storefront_analytics.sources.scratch import Stored, store

# Fixed values.
PROMPT_VERSION = "v2.0"
NEW_STATUS = "PENDING_REVIEW"
APPROVED = "APPROVED"

# Name of the narrative built in this module; callers with another text function
# pass its name along.
TEMPLATE_MODEL = "evidence-template-1"

HISTORY_SCHEMA = (
    "summary_id string, period_start_date date, period_end_date date, model_name string, "
    "prompt_version string, input_version string, input_hash string, prompt_text string, "
    "generated_summary string, generated_at timestamp_ntz, review_status string, "
    "reviewed_by string, reviewed_at timestamp_ntz, review_notes string"
)
HISTORY_COLUMNS = [part.strip().split(" ")[0] for part in HISTORY_SCHEMA.split(",")]

# What the package holds, and the parts that summary_text() writes, too.
INSTRUCTION = " ".join(
    (
        "Report on the KPIs of an online store, from the JSON package after the word Evidence and nothing else.",
        "The package holds: period_start_date and period_end_date; scored_kpis and scored_observations;",
        "total_anomalies; kpi_facts with averages and latest values, actual and expected, of each channel and",
        "metric; top_anomaly_facts with the strongest unusual days, each under its evidence_id.",
        "Expected values and bounds come from a forecast.",
        "Write four parts. Overview: period, series and observations scored, unusual values found.",
        "Insights: up to five unusual days, one line each, with the value, its bounds and the evidence_id in brackets.",
        "Checks to make: three lines, each naming the day and series whose data should be verified.",
        "Note: what a forecast can not tell.",
    )
)


def _with_prompt(package: DataFrame) -> DataFrame:
    evidence = evidence_json(F.col("evidence_package"))
    return package.withColumns(
        {
            "input_hash": F.sha2(evidence, 256),
            "prompt_text": F.concat(F.lit(INSTRUCTION + " Evidence: "), evidence),
        }
    )


def summary_prompt(package: DataFrame) -> DataFrame:
    """Digest of the evidence and the full instruction text with the evidence in it."""
    return _with_prompt(package).select(
        "period_start_date", "period_end_date", "input_version", "input_hash", "prompt_text"
    )


def _reading(direction: Column, desired: Column) -> Column:
    above = direction == "ABOVE_EXPECTED_RANGE"
    good = ((desired == "HIGHER_IS_BETTER") & above) | ((desired == "LOWER_IS_BETTER") & ~above)
    return (
        F.when(desired == "CONTEXT_DEPENDENT", F.lit("to be read in context"))
        .when(good, F.lit("potentially favorable"))
        .otherwise(F.lit("potentially unfavorable"))
    )


def summary_text(package: Column, insights: int = 5, actions: int = 3) -> Column:
    """A narrative that only restates the evidence, as one expression."""
    total = package["total_anomalies"]
    top = package["top_anomaly_facts"]

    def lines(count: int, line: Callable[[Column, Column], Column]) -> Column:
        return F.array_join(F.transform(F.slice(top, 1, count), line), "\n")

    def insight(a: Column, _: Column) -> Column:
        side = F.when(a["direction"] == "ABOVE_EXPECTED_RANGE", F.lit("above")).otherwise(F.lit("below"))
        return F.concat(
            F.lit("- "), a["channel"], F.lit(" "), a["metric_name"], F.lit(" on "),
            a["metric_date"].cast("string"), F.lit(": "), a["actual_value"].cast("string"), F.lit(" is "),
            side, F.lit(" the expected range "), a["lower_bound"].cast("string"), F.lit(" to "),
            a["upper_bound"].cast("string"), F.lit(", "),
            _reading(a["direction"], desired_direction(a["metric_name"])),
            F.lit(" ["), a["evidence_id"], F.lit("]"),
        )

    def action(a: Column, i: Column) -> Column:
        return F.concat(
            (i + 1).cast("string"), F.lit(". Verify the data behind "), a["channel"], F.lit(" "),
            a["metric_name"], F.lit(" on "), a["metric_date"].cast("string"),
            F.lit(" and look into possible drivers ["), a["evidence_id"], F.lit("]"),
        )

    overview = F.concat(
        F.lit("Executive Performance Summary\nOverview: "),
        package["scored_observations"].cast("string"), F.lit(" observations of "),
        package["scored_kpis"].cast("string"), F.lit(" KPI series were scored from "),
        F.coalesce(package["period_start_date"].cast("string"), F.lit("?")), F.lit(" to "),
        F.coalesce(package["period_end_date"].cast("string"), F.lit("?")), F.lit(". "),
    )
    found = F.concat(
        total.cast("string"), F.lit(" unusual values were detected.\nInsights:\n"), lines(insights, insight),
        F.lit("\nChecks to make:\n"), lines(actions, action),
    )
    note = "\nNote: expected values are model forecasts; an unusual value is not a confirmed cause."
    return F.concat(
        overview,
        F.when(total > 0, found).otherwise(F.lit("No anomalies were detected.")),
        F.lit(note),
    )


def summary_candidates(
    package: DataFrame,
    generated_at: datetime | None = None,
    text: Callable[[Column], Column] | None = None,
    model_name: str = TEMPLATE_MODEL,
    prompt_version: str = PROMPT_VERSION,
) -> DataFrame:
    """History rows for the packages, not yet checked against the history.

    ``text`` maps the prompt column to a narrative, for example a pandas UDF
    around a text service; without it the narrative is :func:`summary_text`.
    The id is the shape of a UUID over input, model and prompt version, so a
    task that runs twice gives the same row.
    """
    at = F.lit(generated_at.isoformat(sep=" ")) if generated_at else F.current_timestamp()
    narrative = text(F.col("prompt_text")) if text else summary_text(F.col("evidence_package"))
    rows = _with_prompt(package).withColumn("generated_summary", narrative)
    digest = F.md5(F.concat_ws("|", "input_hash", F.lit(model_name), F.lit(prompt_version)))
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return rows.select(
        F.concat_ws("-", *parts).alias("summary_id"),
        "period_start_date",
        "period_end_date",
        F.lit(model_name).alias("model_name"),
        F.lit(prompt_version).alias("prompt_version"),
        "input_version",
        "input_hash",
        "prompt_text",
        "generated_summary",
        at.cast("timestamp_ntz").alias("generated_at"),
        F.lit(NEW_STATUS).alias("review_status"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        F.lit(None).cast("string").alias("review_notes"),
    )


def new_summaries(candidates: Stored, history: DataFrame) -> DataFrame:
    """Candidates whose input, model and prompt version are not in the history.

    The history is scanned for three columns. Spark sends the candidate keys to
    it when their stored size allows.
    """
    keys = ["input_hash", "model_name", "prompt_version"]
    wanted = candidates.frame.select(*keys).distinct()
    known = history.select(*keys).join(wanted, keys, "left_semi").distinct()
    return candidates.frame.join(known, keys, "left_anti").select(*HISTORY_COLUMNS)


def with_review_columns(history: DataFrame) -> DataFrame:
    """An older history gets the columns it lacks, filled with nulls."""
    empty = history.sparkSession.createDataFrame([], HISTORY_SCHEMA)
    return empty.unionByName(history, allowMissingColumns=True).select(*HISTORY_COLUMNS)


def approved_summaries(history: DataFrame) -> DataFrame:
    return history.filter(F.col("review_status") == APPROVED).select(
        "summary_id",
        "period_start_date",
        "period_end_date",
        "model_name",
        "prompt_version",
        "input_version",
        "generated_summary",
        "generated_at",
        "reviewed_by",
        "reviewed_at",
        "review_notes",
    )


class AppendContended(RuntimeError):
    """Other writers were first every time."""


def append_summaries(candidates: Stored, path: str, attempts: int = 10) -> int:
    """Append the new rows to the history at ``path`` and return their number.

    The candidates are stored, so ids and texts are computed once. Writers may
    run side by side: rows are added only if nobody has appended since they were
    compared with the history, else they are compared again.
    """
    spark = candidates.frame.sparkSession
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    log = AppendLog(spark, path)
    for _ in range(attempts):
        after = log.settled()
        if files.exists(location):
            history = spark.read.schema(HISTORY_SCHEMA).parquet(path)
        else:
            history = spark.createDataFrame([], HISTORY_SCHEMA)
        batch = store(new_summaries(candidates, history), "new-summaries")
        if not batch.rows:
            return 0
        if log.append(batch.frame, after):
            return batch.rows
    raise AppendContended(path)
