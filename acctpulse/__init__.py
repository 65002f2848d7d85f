"""acctpulse: account engagement scoring as Spark DataFrame jobs."""

from .config import DEFAULT_CONFIG, FIXTURE_CONFIG, FIXTURE_QUARTERS_CONFIG, ScoreConfig

__all__ = ["DEFAULT_CONFIG", "FIXTURE_CONFIG", "FIXTURE_QUARTERS_CONFIG", "ScoreConfig"]
