"""Reading source tables and loading folders of CSV files into a layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schemas import SOURCE_SCHEMAS
from basketlens.sources import csv_splits
from basketlens.sources.layers import Layer

REPORT_SCHEMA = "table_name string, status string, loaded_rows long, error string"


def normalize_header(df: DataFrame) -> DataFrame:
    """Lower-case column names, blanks as underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


_RECORD = "__record"


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = True
) -> DataFrame:
    """One CSV table, without loss. Values must fit the declared schema, or the read fails.

    Quotes inside quoted fields are doubled, and quoted fields may hold commas and line
    breaks. A row with too few fields ends in NULLs; one with too many fails the read.
    Empty fields are NULL. Declared types are matched to the file's columns by normalized
    header name, so the column order of the file is free. Without a schema all is text.

    Large files are read by a task per split either way. With ``line_breaks`` they are read
    twice, first to find where records start; turn it off for files that are known to have no
    line breaks in fields.
    """
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": _RECORD}
    names = spark.read.options(header=True, multiLine=line_breaks, **options).csv(path).columns
    # A record with another number of fields than the header is kept as text beside its values;
    # commas outside of quotes tell the short ones from those with too many.
    wide = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    if line_breaks:
        fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in wide.names)
        parsed = F.from_csv("record", fields, {**options, "multiLine": "true"})
        raw = csv_splits.records(spark, path).select(parsed.alias("row")).select("row.*")
    else:
        raw = spark.read.options(header=True, **options).schema(wide).csv(path)
    commas = F.length(F.regexp_replace(F.regexp_replace(_RECORD, '"([^"]|"")*+"', ""), "[^,]", ""))
    surplus = F.coalesce(commas >= len(names), F.lit(False))
    fits = F.when(~surplus, True).otherwise(F.raise_error(F.lit(f"a row with too many fields in {path}")).cast("boolean"))
    raw = raw.where(fits).select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])
    raw = normalize_header(raw)
    if schema is None:
        return raw
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


@dataclass(frozen=True)
class CsvTable:
    name: str
    path: str


def csv_tables(spark: SparkSession, folder: str) -> list[CsvTable]:
    """``*.csv`` entries of a folder (files, or folders of part files), by file stem."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    paths = [status.getPath() for status in fs.listStatus(jvm_path)]
    names = sorted((p.getName(), p.toString()) for p in paths if p.getName().endswith(".csv"))
    return [CsvTable(name.removesuffix(".csv"), path) for name, path in names]


def load_csv_folder(
    spark: SparkSession,
    folder: str,
    layer: Layer,
    schemas: dict[str, T.StructType] = SOURCE_SCHEMAS,
    line_breaks: bool = True,
) -> DataFrame:
    """Load every CSV table of a folder into a layer, replacing what is there.

    One bad table does not stop the others: the report has a row per table with
    its status, row count and error. Rows are counted in the written table, from its footers.
    ``line_breaks`` as for read_csv_table.
    """
    report = []
    for table in csv_tables(spark, folder):
        try:
            layer.replace(table.name, read_csv_table(spark, table.path, schemas.get(table.name), line_breaks))
            report.append((table.name, "loaded", layer.read(table.name).count(), None))
        except PySparkException as error:
            report.append((table.name, "failed", 0, str(error).splitlines()[0]))
    return spark.createDataFrame(report, REPORT_SCHEMA)
