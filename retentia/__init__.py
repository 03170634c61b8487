"""retentia — subscription-retention analytics on Spark DataFrames.

Raw tables (accounts, subscriptions, feature usage, support tickets, churn
events) -> calendar -> daily account panel ("spine") -> per-account features,
cohort split, churn classifier, survival curve, risk roster -> dashboard
metrics and data-quality reports.  Every operator is a plain function
``(DataFrame, params) -> DataFrame``; nothing is collected to the driver
except scalar model summaries.
"""

from retentia.config import AnalysisPeriod, DEFAULT_PERIOD  # noqa: F401
from retentia.sources.raw import RawTables  # noqa: F401

__all__ = ["AnalysisPeriod", "DEFAULT_PERIOD", "RawTables"]
