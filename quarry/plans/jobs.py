"""Whole jobs: every output of a job from one shared intermediate.

Each job persists the intermediate its outputs share (the survey summary,
the parsed trade events, the person/profile join) so the outputs do not
recompute it, and returns the outputs as lazy DataFrames.  Call
``unpersist`` on the returned ``shared`` frame when done.  A lost cached
block is recomputed from lineage, which for the trade events ends at the
written row index, so ids cannot change.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from quarry.operators import accounts as A
from quarry.operators.reports import REPORTS, register_view, report
from quarry.plans import person_accounts as P
from quarry.plans import time_usage as TU
from quarry.plans.trades import save_events_table, trade_events
from quarry.session import release_scratch, scratch_mark, unique_name


# Fixed value of the trial job: amount < 25 is "small", else "big".
SMALL_AMOUNT_LIMIT = 25


@dataclass
class JobResult:
    shared: DataFrame
    outputs: dict[str, DataFrame] = field(default_factory=dict)
    views: list[str] = field(default_factory=list)
    mark: int | None = None

    def unpersist(self) -> None:
        self.shared.unpersist()

    def release(self) -> None:
        """Drop the cache, the views and the scratch folders of the job; its
        outputs cannot be read afterwards."""
        self.unpersist()
        spark = self.shared.sparkSession
        for view in self.views:
            spark.catalog.dropTempView(view)
        if self.mark is not None:
            release_scratch(spark, self.mark)


def time_usage_job(spark: SparkSession, survey: DataFrame) -> JobResult:
    """Summary plus the DataFrame, SQL, typed and custom-aggregate averages."""
    summary = TU.time_usage_summary(survey).persist(StorageLevel.MEMORY_AND_DISK)
    return JobResult(summary, {
        "grouped": TU.time_usage_grouped(summary),
        "grouped_sql": TU.time_usage_grouped_sql(spark, summary, view=unique_name("summed")),
        "grouped_typed": TU.time_usage_grouped_typed(summary),
        "grouped_custom": TU.time_usage_grouped_custom(summary),
    })


def trade_job(spark: SparkSession, lines: DataFrame, table: str | None = None) -> JobResult:
    """Events, the six reports over one view, and the saved table (written now)."""
    mark = scratch_mark(spark)
    events = trade_events(lines).persist(StorageLevel.MEMORY_AND_DISK)
    view = unique_name("trade_events")
    register_view(events, view)
    outputs = {name: report(spark, name, view) for name in REPORTS}
    outputs["saved_table"] = save_events_table(events, table)
    return JobResult(events, outputs, [view], mark)


def person_accounts_job(persons: DataFrame, accounts: DataFrame) -> JobResult:
    """The person/profile join and the three candidate selections."""
    joined = A.person_accounts(persons, accounts).persist(StorageLevel.MEMORY_AND_DISK)
    return JobResult(joined, {
        "large_savings_high_earners": P.large_savings_high_earners(joined),
        "broker_candidates": P.broker_candidates(joined),
        "credit_assistance_candidates": P.credit_assistance_candidates(joined),
    })
