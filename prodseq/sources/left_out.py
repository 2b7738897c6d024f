"""Report rows left out for a missing key, counted while the reports are parsed."""

from __future__ import annotations

from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from prodseq.functions import strip
from prodseq.operators.demand import PLANT
from prodseq.sources.reports import Reports


class LeftOut:
    """Counts by report, taken by the one pass in which a run reads each of them.

    ``watch`` hands back reports that count as they are read; ``counts`` is asked for after
    the run. A task that runs twice may count its rows twice, so after the loss of an
    executor counts are upper bounds. Where the plan of a run drops a report unread (its
    partner in a join was empty), that report alone is read for its count.
    """

    def __init__(self) -> None:
        self._watched: dict[str, tuple[Observation, DataFrame, Column]] = {}

    def _watch(self, name: str, rows: DataFrame | None, unusable: Column) -> DataFrame | None:
        if rows is None:
            return None
        seen = Observation()
        self._watched[name] = (seen, rows, unusable)
        return rows.observe(seen, F.count_if(unusable).alias("rows"))

    def watch(self, reports: Reports) -> Reports:
        """All reports but the manual list; those that are missing stay missing."""
        no_sku = F.col("sku").isNull()
        return replace(
            reports,
            bor=self._watch("BOR", reports.bor, no_sku | F.col("loc").isNull()),
            bmr=self._watch("BMR", reports.bmr, (F.col("plant") == PLANT) & no_sku),
            bpr=self._watch("BPR", reports.bpr, no_sku),
            dispatch=self._watch("DISPATCH", reports.dispatch, no_sku),
            curing=self._watch("CURING", reports.curing, no_sku),
            mould=self._watch("MOULD", reports.mould, no_sku),
        )

    def watch_manual(self, manual: DataFrame) -> DataFrame:
        """The manual list, of which entries without a code are left out."""
        (code,) = [c for c in manual.columns if c.strip() == "SKU Code"] or [None]
        if code is None:
            return manual  # the check of its columns says so
        key = strip(F.col(f"`{code}`").cast("string"))
        return self._watch("MANUAL", manual, F.coalesce(F.length(key) == 0, F.lit(True)))

    def counts(self, spark: SparkSession) -> DataFrame:
        """(report, rows), one row for each watched report."""
        return spark.createDataFrame([(name, self._count(*parts)) for name, parts in self._watched.items()], "report string, rows long")

    @staticmethod
    def _count(seen: Observation, rows: DataFrame, unusable: Column) -> int:
        try:
            return seen.get["rows"]
        except Py4JJavaError:  # the run's plan dropped the report, so nothing was observed
            return rows.agg(F.count_if(unusable)).first()[0]
