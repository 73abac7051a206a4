from hitloom.plans.pipeline import run_pipeline, stage_for
from hitloom.plans.reports import REPORTS, run_all

__all__ = ["REPORTS", "run_all", "run_pipeline", "stage_for"]
