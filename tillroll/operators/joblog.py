"""Job and stage reports over Spark's JSON event log.

Spark writes every scheduler event to its event log
(``spark.eventLog.enabled``); read uncompressed and unrolled, it is JSON
lines.  These functions give, per job, its stages and outcome; per stage, its
name, task count and outcome; and per described step (the job description a
run sets, see ``tillroll.plans.run``), its jobs, stages and wall time.  They
are DataFrame jobs over the log, so a folder with the logs of many
applications is read in parallel like any other JSON table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import EVENT_LOG

# The event names and the status words of the job log.
JOB_START = "SparkListenerJobStart"
JOB_END = "SparkListenerJobEnd"
STAGE_SUBMITTED = "SparkListenerStageSubmitted"
STAGE_COMPLETED = "SparkListenerStageCompleted"
JOB_SUCCEEDED = "JobSucceeded"
REASON_CHARS = 120


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Event-log lines under ``path`` with the declared (partial) schema.

    Fields a log may lack (failure reason, exception) are declared, so a log
    without failures still has the columns.  ``app`` names the log, which tells
    applications apart when a folder holds several: the file, or the folder of
    a rolled log (``eventlog_v2_*``), whose files are one log.
    """
    events = spark.read.schema(EVENT_LOG).json(path)
    wanted = [JOB_START, JOB_END, STAGE_SUBMITTED, STAGE_COMPLETED]
    return events.filter(F.col("Event").isin(wanted)).withColumn(
        "app", F.regexp_replace(F.col("_metadata.file_path"), r"(/eventlog_v2_[^/]*)/[^/]*$", "$1")
    )


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def job_log(events: DataFrame) -> DataFrame:
    """One row per job: stages, times, description and status.

    Status is ``success``, ``failed(<message>)``, or NULL for a job whose
    end event is missing (still running, or the application died).
    """
    starts = events.filter(_c("Event") == JOB_START).select(
        "app",
        _c("Job ID").alias("job_id"),
        _c("Stage IDs").alias("stage_ids"),
        _c("Submission Time").alias("submission_time"),
        F.element_at(_c("Properties"), F.lit("spark.job.description")).alias("description"),
    )
    ends = events.filter(_c("Event") == JOB_END).select(
        "app",
        _c("Job ID").alias("job_id"),
        _c("Completion Time").alias("completion_time"),
        F.col("`Job Result`.Result").alias("result"),
        F.col("`Job Result`.Exception.Message").alias("message"),
    )
    jobs = starts.join(ends, ["app", "job_id"], "left")
    status = (
        F.when(F.col("result") == JOB_SUCCEEDED, F.lit("success"))
        .when(
            F.col("result").isNotNull(),
            F.concat(F.lit("failed("), F.coalesce("message", "result"), F.lit(")")),
        )
    )
    return jobs.select(
        "app",
        "job_id",
        "stage_ids",
        "description",
        "submission_time",
        "completion_time",
        (F.col("completion_time") - F.col("submission_time")).alias("duration_ms"),
        status.alias("status"),
    ).orderBy("app", "job_id")


def stage_log(events: DataFrame) -> DataFrame:
    """One row per stage attempt: name, tasks, status.

    Status is ``done``, ``failed: <reason cut to 120 characters>``, or NULL
    for a stage submitted but never completed.
    """
    info = F.col("`Stage Info`")
    key = [
        "app",
        info["Stage ID"].alias("stage_id"),
        info["Stage Attempt ID"].alias("attempt"),
    ]
    submitted = events.filter(_c("Event") == STAGE_SUBMITTED).select(
        *key,
        info["Stage Name"].alias("name"),
        info["Number of Tasks"].alias("num_tasks"),
    )
    completed = events.filter(_c("Event") == STAGE_COMPLETED).select(
        *key,
        info["Stage Name"].alias("c_name"),
        info["Number of Tasks"].alias("c_tasks"),
        info["Submission Time"].alias("submission_time"),
        info["Completion Time"].alias("completion_time"),
        info["Failure Reason"].alias("reason"),
        F.lit(True).alias("completed"),
    )
    stages = submitted.join(completed, ["app", "stage_id", "attempt"], "full")
    status = F.when(F.col("completed").isNull(), F.lit(None)).otherwise(
        F.when(F.col("reason").isNull(), F.lit("done")).otherwise(
            F.concat(F.lit("failed: "), F.substring("reason", 1, REASON_CHARS))
        )
    )
    return stages.select(
        "app",
        "stage_id",
        "attempt",
        F.coalesce("name", "c_name").alias("name"),
        F.coalesce("num_tasks", "c_tasks").alias("num_tasks"),
        "submission_time",
        "completion_time",
        status.cast("string").alias("status"),
    ).orderBy("app", "stage_id", "attempt")


def step_job_times(events: DataFrame) -> DataFrame:
    """Per described step: jobs, stages, failures and wall time.

    Wall time runs from the first job's submission to the last job's end;
    jobs without an end event are counted but do not extend it.
    """
    jobs = job_log(events).filter(F.col("description").isNotNull())
    return (
        jobs.groupBy("app", F.col("description").alias("step"))
        .agg(
            F.count(F.lit(1)).alias("jobs"),
            F.sum(F.size("stage_ids")).alias("stages"),
            F.sum(F.when(F.col("status").startswith("failed"), 1).otherwise(0)).alias("failed_jobs"),
            F.min("submission_time").alias("first_submission"),
            F.max("completion_time").alias("last_completion"),
        )
        .withColumn("wall_ms", F.col("last_completion") - F.col("first_submission"))
        .orderBy("app", "first_submission")
    )
