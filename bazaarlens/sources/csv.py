"""CSV import and export of scraped listings.

Import maps fields by position (the header line is skipped, never trusted
for names), reads with an explicit schema, keeps a row whose numeric field
is malformed (that field becomes NULL), and treats an empty field as NULL -
or as 0 for numeric columns with ``empty_numeric='zero'``, which is what
some database loaders do. Multi-line quoted fields need ``multiline=True``,
which stops Spark from splitting a file, so it is off by default.

``load_rejects`` lists what such a load cannot take as it stands: malformed
fields (NULL after the load) and lines with too few or too many fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.sources.schema import LISTING_SCHEMA

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
}


def load_csv(spark: SparkSession, path: str, schema: T.StructType = LISTING_SCHEMA,
             empty_numeric: str = "null", multiline: bool = False) -> DataFrame:
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    if multiline:
        reader = reader.option("multiLine", "true")
    df = reader.csv(path)
    if empty_numeric == "zero":
        numeric = (T.DecimalType, T.IntegerType, T.LongType, T.DoubleType)
        df = df.select(*[F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name)
                         if isinstance(f.dataType, numeric) else F.col(f.name)
                         for f in schema.fields])
    return df


def load_rejects(spark: SparkSession, path: str, schema: T.StructType = LISTING_SCHEMA,
                 header: bool = True, multiline: bool = False) -> DataFrame:
    """One row per rejected field or line of a CSV load: file, block_start (of the
    file split that held the line), first field, field, value, reason.

    Fields are read as text, as the loader splits lines, and cast one by one; a
    line whose number of fields is wrong is known by Spark's corrupt-record
    column and reported with its whole text as value (field is NULL). One pass
    over the files, no shuffle."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField("_line", T.StringType())])
    lines = (spark.read.schema(text)
             .options(**{**CSV_OPTIONS, "header": str(header).lower(), "multiLine": str(multiline),
                         "columnNameOfCorruptRecord": "_line",
                         "columnPruning": "false"}).csv(path))   # a pruned line has no length
    found = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            continue
        value, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        bad = value.isNotNull() & (value.try_cast(f.dataType).isNull() | (value != F.trim(value)))
        if isinstance(f.dataType, (T.IntegerType, T.LongType)):
            bad = bad | ~value.rlike("^[+-]?[0-9]+$")
        found.append(F.when(bad, F.struct(F.lit(f.name).alias("field"), value.alias("value"),
                                          F.lit(f"not a {kind}").alias("reason"))))
    bare = F.regexp_replace("_line", '"(?:[^"]|"")*"', "")   # commas in quotes part nothing
    short = F.size(F.split(bare, ",")) < len(schema.fields)
    found.append(F.when(F.col("_line").isNotNull(), F.struct(
        F.lit(None).cast("string").alias("field"), F.col("_line").alias("value"),
        F.when(short, "too few fields").otherwise("too many fields").alias("reason"))))
    first = schema.fields[0].name
    rejects = lines.select(F.col("_metadata.file_name").alias("file"),
                           F.col("_metadata.file_block_start").alias("block_start"),
                           F.col(f"`{first}`").alias(first),
                           F.explode(F.array_compact(F.array(*found))).alias("r"))
    return rejects.select("file", "block_start", first, "r.field", "r.value", "r.reason")


def export_csv(df: DataFrame, path: str, columns=None) -> str:
    """Write listings as CSV with a header, quoting as the importer expects.

    Leading and trailing spaces are kept (Spark trims them on write by
    default). One file per partition: no single-writer bottleneck.
    """
    cols = columns or [f.name for f in LISTING_SCHEMA.fields]
    (df.select(*cols).write.mode("overwrite")
       .option("header", "true").option("quote", '"').option("escape", '"')
       .option("nullValue", "").option("ignoreLeadingWhiteSpace", "false")
       .option("ignoreTrailingWhiteSpace", "false")
       .csv(path))
    return path


def export_parquet(df: DataFrame, path: str, columns=None) -> str:
    cols = columns or [f.name for f in LISTING_SCHEMA.fields]
    df.select(*cols).write.mode("overwrite").parquet(path)
    return path
