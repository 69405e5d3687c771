"""Drift report over the prediction and verdict logs."""

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import drift, review
from ..sources import journal, store


def monitoring_report(
    spark: SparkSession, root: str, limit: int = K.RECENT_LIMIT
) -> DataFrame:
    """Write and return the report rows. Verdicts are looked up for the recent rows only."""
    newest = drift.recent(journal.read_newest(spark, f"{root}/log/predictions", limit), limit)
    current = review.with_verdicts(
        newest, journal.read_verdicts(spark, f"{root}/log/verdicts"))
    report = drift.report_rows(*drift.drift_report(current, limit))
    store.write_document(report, f"{root}/reports/monitoring")
    return report
