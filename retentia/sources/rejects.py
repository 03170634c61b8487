"""A1-A5 with a store of rejected rows: bad lines stand beside the typed tables instead of stopping the load.

A line is rejected when it has another number of fields than the header's
table (or a quote that never closes), when a required field is blank, or when a
field's text is no value of its column's type.  Good and rejected rows of a
table are written by one parse into one folder, split on ``_rejected``; both
counts together are the file's rows.  Flags take any text, as in
``csv_ingest``; blanks of optional fields are NULL.

A rejected row carries its ``record`` (a malformed line as it stands, else its
fields, quoted anew), ``reason`` ('fields', 'missing' or 'type') and ``column_name``
of its first fault in table order (NULL for 'fields') and the number of its
``faults``.  An empty file gives two empty tables.  A quote that never closes
takes what follows it into its field: to the line's end, or, in tables read
with line breaks inside quotes, to the next quote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia import schemas
from retentia.functions.expressions import blank_to_null, text_flag
from retentia.operators.dedup import dedup_usage
from retentia.sources.csv_ingest import CSV_OPTIONS, MULTILINE_TABLES
from retentia.sources.raw import RawTables

LINE = "_line"
REJECT_COLUMNS = ("table_name", "reason", "column_name", "faults", "record")


def checked_csv(spark: SparkSession, path: str, table: str, **options) -> DataFrame:
    """The typed columns of each line, ``_rejected`` and, where it is true, ``_record``, ``_reason``, ``_column`` and ``_faults``."""
    schema = schemas.RAW[table]
    flags = set(schemas.FLAG_COLUMNS.get(table, ()))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(LINE, T.StringType())])
    # Pruned columns wouldn't be counted, and short lines would pass.
    opts = dict(CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, columnPruning="false", multiLine="true" if table in MULTILINE_TABLES else "false")
    lines = spark.read.schema(text).options(**{**opts, **options}).csv(path)
    cols, faults = [], []
    for f in schema.fields:
        value = blank_to_null(f.name)
        if f.name in flags:
            typed = text_flag(f.name)
        elif isinstance(f.dataType, T.StringType):
            typed = value
        else:
            typed = value.try_cast(f.dataType)
            faults.append(F.when(value.isNotNull() & typed.isNull(), F.struct(F.lit("type").alias("reason"), F.lit(f.name).alias("column"))))
        if not f.nullable:
            faults.append(F.when(value.isNull(), F.struct(F.lit("missing").alias("reason"), F.lit(f.name).alias("column"))))
        cols.append(typed.alias(f.name))
    malformed = F.struct(F.lit("fields").alias("reason"), F.lit(None).cast("string").alias("column"))
    found = F.when(F.col(LINE).isNotNull(), F.array(malformed)).otherwise(F.array_compact(F.array(*faults)))
    fields = F.to_csv(F.struct(*[F.col(f.name) for f in schema.fields]), {"escape": '"'})
    bad = F.size("_found") > 0
    rows = lines.withColumn("_found", found).select(
        *cols,
        bad.alias("_rejected"),
        F.when(bad, F.coalesce(F.col(LINE), fields)).alias("_record"),
        F.get("_found", F.lit(0))["reason"].alias("_reason"),
        F.get("_found", F.lit(0))["column"].alias("_column"),
        F.size("_found").alias("_faults"),
    )
    return rows


def load_checked_csv(spark: SparkSession, paths: dict[str, str], out: str, dedup: bool = True, **options) -> tuple[RawTables, DataFrame]:
    """(typed tables, rejected rows of all tables as ``REJECT_COLUMNS``), both read from what this writes under ``out``."""
    tables, rejects = {}, []
    for name, schema in schemas.RAW.items():
        at = f"{out}/{name}"
        checked_csv(spark, paths[name], name, **options).write.mode("overwrite").partitionBy("_rejected").parquet(at)
        # With the schema given, a folder without either part reads as an empty table.
        written = T.StructType(
            [T.StructField(f.name, f.dataType) for f in schema.fields]
            + [T.StructField(c, T.StringType()) for c in ("_record", "_reason", "_column")]
            + [T.StructField("_faults", T.IntegerType()), T.StructField("_rejected", T.BooleanType())]
        )
        rows = spark.read.schema(written).parquet(at)
        tables[name] = rows.where("NOT _rejected").select(*schema.fieldNames())
        rejects.append(
            rows.where("_rejected").select(
                F.lit(name).alias("table_name"), F.col("_reason").alias("reason"), F.col("_column").alias("column_name"),
                F.col("_faults").alias("faults"), F.col("_record").alias("record"),
            )
        )
    if dedup:
        tables["feature_usage"] = dedup_usage(tables["feature_usage"])
    rejected = rejects[0]
    for r in rejects[1:]:
        rejected = rejected.unionByName(r)
    return RawTables(**tables), rejected


def column_profile(tables: RawTables) -> DataFrame:
    """(table_name, column_name, values, least, greatest): per column its non-null values and their extremes as text, one scan a table."""
    out = None
    for name, df in tables.as_dict().items():
        text = {c: F.col(c).cast("string") for c in df.columns}
        cells = [F.struct(F.count(e).alias("values"), F.min(e).alias("least"), F.max(e).alias("greatest")).alias(c) for c, e in text.items()]
        one = df.agg(*cells).select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c)["values"].alias("values"), F.col(c)["least"].alias("least"), F.col(c)["greatest"].alias("greatest")) for c in df.columns])).alias("x")
        ).select(F.lit(name).alias("table_name"), "x.*")
        out = one if out is None else out.unionByName(one)
    return out


def load_report(tables: RawTables, rejected: DataFrame) -> DataFrame:
    """(table_name, reason, column_name, row_count): rows loaded (reason 'loaded') and rejected by first fault."""
    loaded = None
    for name, df in tables.as_dict().items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit("loaded").alias("reason"), F.lit(None).cast("string").alias("column_name"), "row_count"
        )
        loaded = one if loaded is None else loaded.unionByName(one)
    by_fault = rejected.groupBy("table_name", "reason", "column_name").agg(F.count(F.lit(1)).alias("row_count"))
    return loaded.unionByName(by_fault)
