"""Container for the five typed raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from retentia import schemas


@dataclass(frozen=True)
class RawTables:
    accounts: DataFrame
    subscriptions: DataFrame
    feature_usage: DataFrame
    support_tickets: DataFrame
    churn_events: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "accounts": self.accounts,
            "subscriptions": self.subscriptions,
            "feature_usage": self.feature_usage,
            "support_tickets": self.support_tickets,
            "churn_events": self.churn_events,
        }

    @staticmethod
    def read_parquet(spark: SparkSession, base: str) -> "RawTables":
        """Typed raw tables previously written as ``<base>/<name>`` Parquet."""
        t = {n: spark.read.schema(s).parquet(f"{base}/{n}") for n, s in schemas.RAW.items()}
        return RawTables(**t)

    def write_parquet(self, base: str, mode: str = "overwrite") -> None:
        for n, df in self.as_dict().items():
            df.write.mode(mode).parquet(f"{base}/{n}")


class StoredRawTables(RawTables):
    """Raw tables that are written as ``<base>/<name>`` Parquet when they are first read, and read from there."""

    def __init__(self, source: RawTables, base: str):
        self.__dict__.update(source=source, base=base, stored={})

    def _table(self, name: str) -> DataFrame:
        if name not in self.stored:
            path = f"{self.base}/{name}"
            table = getattr(self.source, name)
            table.write.mode("errorifexists").parquet(path)
            self.stored[name] = table.sparkSession.read.schema(schemas.RAW[name]).parquet(path)
        return self.stored[name]

    accounts = property(lambda self: self._table("accounts"))
    subscriptions = property(lambda self: self._table("subscriptions"))
    feature_usage = property(lambda self: self._table("feature_usage"))
    support_tickets = property(lambda self: self._table("support_tickets"))
    churn_events = property(lambda self: self._table("churn_events"))
