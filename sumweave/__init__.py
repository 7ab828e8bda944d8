"""sumweave: summary-statistics harmonisation and fixed-effect meta-analysis on Spark."""

from sumweave.session import build_session

__all__ = ["build_session"]
