"""prodseq: ranked production sequences from daily plant reports, on Spark."""

from prodseq.plans.params import Params
from prodseq.plans.pipeline import stage1, stage2, stage3
from prodseq.plans.workspace import Workspace

__all__ = ["Params", "Workspace", "stage1", "stage2", "stage3"]
