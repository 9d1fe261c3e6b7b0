"""Verdicts on batches, jobs and dataset uploads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# States of batches and uploads.
FAILED = "Failed"
PENDING_BATCH = ("InProgress", "Queued")
PENDING_UPLOAD = ("New", "Queued", "InProgress")


def job_status(batches: DataFrame) -> DataFrame:
    """One verdict for each job: failed before pending before complete; ``ok`` is the AND of its batches."""
    failed = (F.col("state") == FAILED) | (F.col("number_records_failed") > 0)
    pending = F.col("state").isin(*PENDING_BATCH)
    verdict = F.when(F.bool_or(failed), "failed").when(F.bool_or(pending), "pending").otherwise("complete")
    return batches.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("number_records_failed").alias("n_failed_records"),
        verdict.alias("status"),
        F.bool_and(~failed & ~pending).alias("ok"),
    )


def upload_status(status: Column) -> Column:
    """Verdict on one dataset upload; unknown and missing states count as done."""
    return F.when(status == FAILED, "failed").when(status.isin(*PENDING_UPLOAD), "pending").otherwise("ok")
