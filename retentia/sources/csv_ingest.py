"""Load the five raw CSV exports into typed tables.

CSV rules: header row, comma separated, ``"`` enclosed, CRLF line ends,
flags as text 'True'/'False', blank fields mean NULL where nullable.
Every column is read as text (no inference), trimmed, blanks turned into
NULL *before* casting (ANSI casts of '' fail), then cast to the table's
type.  Flags: 'true' in any case -> 1, anything else (including NULL) -> 0.
Feature usage is de-duplicated on usage_id, earliest usage_date first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia import schemas
from retentia.functions.expressions import blank_to_null, text_flag
from retentia.operators.dedup import dedup_usage
from retentia.sources.raw import RawTables

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
}

# Only tables with free text may hold line breaks inside quotes; multi-line
# parsing makes a file unsplittable (one task per file), so the large tables
# are read line by line and stay splittable.
MULTILINE_TABLES = ("churn_events",)


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_typed_csv(spark: SparkSession, path: str, table: str, **options) -> DataFrame:
    """One raw table from CSV, typed per ``schemas.RAW[table]``."""
    schema = schemas.RAW[table]
    flags = set(schemas.FLAG_COLUMNS.get(table, ()))
    opts = dict(CSV_OPTIONS, multiLine="true" if table in MULTILINE_TABLES else "false")
    opts.update(options)
    text = spark.read.schema(_text_schema(schema)).options(**opts).csv(path)
    cols = []
    for f in schema.fields:
        if f.name in flags:
            cols.append(text_flag(f.name).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(blank_to_null(f.name).alias(f.name))
        else:
            cols.append(blank_to_null(f.name).cast(f.dataType).alias(f.name))
    return text.select(*cols)


def load_raw_csv(spark: SparkSession, paths: dict[str, str], dedup: bool = True, **options) -> RawTables:
    """``paths`` maps table name -> CSV file or folder."""
    t = {name: read_typed_csv(spark, paths[name], name, **options) for name in schemas.RAW}
    if dedup:
        t["feature_usage"] = dedup_usage(t["feature_usage"])
    return RawTables(**t)


def write_raw_csv(raw: RawTables, base: str) -> dict[str, str]:
    """Write raw tables in the same CSV dialect (flags as 'True'/'False')."""
    out = {}
    for name, df in raw.as_dict().items():
        flags = set(schemas.FLAG_COLUMNS.get(name, ()))
        cols = [
            F.when(F.col(c) == 1, "True").otherwise("False").alias(c) if c in flags else F.col(c).cast("string").alias(c)
            for c in df.columns
        ]
        path = f"{base}/{name}"
        (
            df.select(*cols)
            .write.mode("overwrite")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("lineSep", "\r\n")
            .option("nullValue", "")
            .csv(path)
        )
        out[name] = path
    return out
