"""Risk roster, portfolio KPIs, account card and the score-file contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from retentia import config
from retentia.functions.expressions import cents, half_up_ratio

DATE = "observation_date"


class ScoreContractError(ValueError):
    pass


def risk_roster(scored: DataFrame, drivers: DataFrame | None, spine: DataFrame) -> DataFrame:
    """The six score-file columns; tenure = panel's latest date - the
    account's first panel date.  Highest score first (account_id breaks ties)."""
    from retentia.plans.dashboard import latest_date

    latest = latest_date(spine)
    starts = spine.groupBy("account_id").agg(F.min(DATE).alias("first_seen"))
    r = scored.select("account_id", "industry", "active_mrr_run_rate", "flight_risk_score")
    if drivers is not None:
        r = r.join(drivers, "account_id", "left")
    else:  # scores already carry their drivers
        r = scored.select("account_id", "industry", "active_mrr_run_rate", "flight_risk_score", "primary_risk_drivers")
    r = r.join(starts, "account_id", "left")
    return r.select(
        "account_id",
        "industry",
        F.col("active_mrr_run_rate").cast("double").alias("active_mrr_run_rate"),
        F.col("flight_risk_score").cast("double").alias("flight_risk_score"),
        "primary_risk_drivers",
        F.datediff(latest, F.col("first_seen")).cast("int").alias("tenure_days"),
    ).orderBy(F.desc("flight_risk_score"), "account_id")


def check_contract(scores: DataFrame, required=config.SCORE_COLUMNS) -> DataFrame:
    """K6: raise naming every missing required column."""
    missing = [c for c in required if c not in scores.columns]
    if missing:
        raise ScoreContractError(f"score table is missing required column(s): {missing}")
    return scores


def dedup_scores(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K7/HS8: one row per account - the first occurrence in a score file
    sorted by score descending, i.e. the highest score (account order of
    the remaining columns breaks ties) - and a one-row notice with the
    number of surplus rows."""
    from retentia.operators.dedup import keep_first

    kept = keep_first(scores, "account_id", ["flight_risk_score"], descending=True)
    notice = scores.groupBy("account_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
    )
    return kept, notice


def portfolio_kpis(scores: DataFrame, threshold: float = config.RISK_THRESHOLD) -> DataFrame:
    """Total MRR, MRR of accounts at/above the threshold, its share
    (0 when total is 0), mean score; NULL scores count nowhere."""
    mrr = F.col("active_mrr_run_rate").cast("decimal(18,2)")
    hit = F.col("flight_risk_score") >= F.lit(float(threshold))
    g = scores.agg(
        F.sum(mrr).alias("total"),
        F.sum(F.when(hit, mrr)).alias("at_risk"),
        F.avg("flight_risk_score").alias("avg_risk"),
        F.count(F.when(hit, 1)).alias("at_risk_accounts"),
        F.count(F.lit(1)).alias("accounts"),
    )
    return g.select(
        F.lit(float(threshold)).alias("threshold"),
        "accounts",
        "at_risk_accounts",
        F.round(F.coalesce(F.col("total"), F.lit(0)), 2).cast("double").alias("total_mrr"),
        F.round(F.coalesce(F.col("at_risk"), F.lit(0)), 2).cast("double").alias("at_risk_mrr"),
        F.coalesce(
            F.when(F.col("total") > 0, half_up_ratio(cents(F.coalesce("at_risk", F.lit(0))) * 100, cents("total"))),
            F.lit(0.0),
        ).alias("pct_at_risk"),
        F.round("avg_risk", 4).alias("avg_risk"),
    )


def account_card(scores: DataFrame, account_id) -> DataFrame:
    """One account's tenure, score, MRR and drivers (first row if repeated)."""
    return scores.where(F.col("account_id") == account_id).select(*config.SCORE_COLUMNS)


def account_card_display(card: DataFrame) -> DataFrame:
    """The card's display strings (percent with one decimal, money with
    thousands separators and two decimals)."""
    return card.select(
        "account_id",
        F.concat_ws(" / ", "account_id", "industry", F.concat(F.col("tenure_days").cast("string"), F.lit(" d"))).alias("headline"),
        F.concat(F.format_number(F.col("flight_risk_score") * 100, 1), F.lit("%")).alias("flight_risk"),
        F.concat(F.lit("$"), F.format_number("active_mrr_run_rate", 2)).alias("monthly_revenue"),
        F.col("primary_risk_drivers").alias("intervention_triggers"),
    )


def write_scores(scores: DataFrame, path: str) -> None:
    """A10: score file, highest score first, header, no index column."""
    (
        scores.select(*config.SCORE_COLUMNS)
        .orderBy(F.desc("flight_risk_score"), "account_id")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def read_scores(spark: SparkSession, *paths: str) -> DataFrame:
    """First readable path wins; contract checked (K6)."""
    last = None
    for p in paths:
        try:
            df = spark.read.option("header", True).option("inferSchema", False).csv(p)
            df.schema  # noqa: B018 - forces path resolution
        except AnalysisException as e:
            last = e
            continue
        df = check_contract(df)
        return df.select(
            "account_id",
            "industry",
            F.col("active_mrr_run_rate").cast("double").alias("active_mrr_run_rate"),
            F.col("flight_risk_score").cast("double").alias("flight_risk_score"),
            "primary_risk_drivers",
            F.col("tenure_days").cast("int").alias("tenure_days"),
        )
    raise FileNotFoundError(f"no score file found in {list(paths)}") from last


def source_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Latest modification time of the files behind a table."""
    return spark.read.option("header", True).csv(path).select(
        F.max(F.col("_metadata.file_modification_time")).alias("last_modified")
    )
