from .evaluate import evaluate_logs
from .suite import REPORTS, Report, register_report, run_report

__all__ = ["REPORTS", "Report", "evaluate_logs", "register_report", "run_report"]
