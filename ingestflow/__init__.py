"""ingestflow: file ingestion and load reconciliation as Spark DataFrame operators."""

from ingestflow.api import AwaitResults, HistoryReport, StageFiles, SubmitLoads
from ingestflow.operators.load import PipeSpec, load_files
from ingestflow.operators.reconcile import await_results, await_rounds
from ingestflow.operators.submit import classify_submission, load_requests
from ingestflow.plans.flow import run_flow, stage_step

__all__ = [
    "AwaitResults", "HistoryReport", "StageFiles", "SubmitLoads", "PipeSpec", "load_files",
    "await_results", "await_rounds", "classify_submission", "load_requests", "run_flow",
    "stage_step",
]
