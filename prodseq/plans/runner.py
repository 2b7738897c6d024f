"""Runs from landed files to written reports.

One call covers a whole range of dates. Dates that lack one of the four daily
reports are skipped, as are dates without a demand row.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from prodseq.operators import summary as sm
from prodseq.plans import layouts
from prodseq.plans.params import PARAMETER_SCHEMA, Params, load_params
from prodseq.plans.pipeline import stage1, stage2, stage3
from prodseq.plans.workspace import Workspace
from prodseq.sources.calendar import runnable_dates
from prodseq.sources.left_out import LeftOut
from prodseq.sources.reports import matching_paths, read_manual, read_reports
from prodseq.sources.sinks import write_report

# Output names and place of the manual list.
STAGE1_OUTPUT = "combined_data_output"
STAGE2_OUTPUT = "deployment_analysis_report"
STAGE3_OUTPUT = "final_hybrid_deployment_report"
UNUSABLE_OUTPUT = "unusable_rows"
MANUAL_LIST = "manual_frontend_demand.csv"


@dataclass(frozen=True)
class Job:
    data: str
    out: str
    start: date
    end: date
    parameters: str | None = None  # CSV of sheet, Parameter, Default_Value, User_Input
    manual: str | None = None
    fmt: str = "parquet"
    count_unusable: bool = False  # also write the number of rows left out for missing keys

    def params(self, spark: SparkSession) -> Params:
        if self.parameters is None:
            return Params()
        table = spark.read.schema(PARAMETER_SCHEMA).csv(self.parameters, header=True)
        return load_params(table)

    def dates(self, spark: SparkSession) -> list[date]:
        dates = runnable_dates(spark, self.data, self.start, self.end)
        if not dates:
            raise ValueError(f"no date from {self.start} to {self.end} has all daily reports")
        return dates

    def keep_counts(self, spark: SparkSession, left_out: LeftOut) -> None:
        """Write what the run counted on its way."""
        if self.count_unusable:
            counts = left_out.counts(spark)  # one row per report
            counts.coalesce(1).write.mode("overwrite").parquet(f"{self.out}/{UNUSABLE_OUTPUT}")

    def manual_list(self, spark: SparkSession, dates: list[date]) -> DataFrame:
        path = self.manual or f"{self.data}/{MANUAL_LIST}"
        if not matching_paths(spark, path):
            raise FileNotFoundError(f"manual demand list not found: {path}")
        return read_manual(spark, path, dates)


def run_stage1(spark: SparkSession, job: Job) -> None:
    """Demand ranking only."""
    with Workspace(spark) as ws:
        left_out = LeftOut()
        reports = left_out.watch(replace(read_reports(spark, job.data, job.dates(spark)), mould=None))
        ranked = ws.write(stage1(ws, reports, job.params(spark)).df, "ranked-demand")
        write_report(ranked, layouts.STAGE1, f"{job.out}/{STAGE1_OUTPUT}", "demand_rank", job.fmt)
        job.keep_counts(spark, left_out)


def run_stage2(spark: SparkSession, job: Job) -> DataFrame:
    """Demand ranking and gap analysis; returns the summary of each date."""
    with Workspace(spark) as ws:
        params = job.params(spark)
        left_out = LeftOut()
        reports = left_out.watch(read_reports(spark, job.data, job.dates(spark)))
        gaps = ws.write(stage2(ws, stage1(ws, reports, params), params).df, "gaps")
        write_report(gaps, layouts.STAGE2, f"{job.out}/{STAGE2_OUTPUT}", "proxy_rank", job.fmt)
        job.keep_counts(spark, left_out)
        return _kept(spark, sm.stage2_summary(gaps), f"{job.out}/{STAGE2_OUTPUT}_summary")


def run_stage3(spark: SparkSession, job: Job) -> DataFrame:
    """All three stages; returns the summary of each date."""
    with Workspace(spark) as ws:
        params = job.params(spark)
        dates = job.dates(spark)
        left_out = LeftOut()
        reports = left_out.watch(read_reports(spark, job.data, dates))
        manual = left_out.watch_manual(job.manual_list(spark, dates))
        gaps = stage2(ws, stage1(ws, reports, params), params)
        final = ws.write(stage3(ws, gaps, manual, params), "final")
        write_report(final, layouts.STAGE3, f"{job.out}/{STAGE3_OUTPUT}", "final_rank", job.fmt)
        job.keep_counts(spark, left_out)
        return _kept(spark, sm.stage3_summary(final), f"{job.out}/{STAGE3_OUTPUT}_summary")


def _kept(spark: SparkSession, summary: DataFrame, path: str) -> DataFrame:
    """Write the summary and return what was written."""
    summary.coalesce(1).write.mode("overwrite").parquet(path)  # one row per date
    return spark.read.parquet(path)
