"""Readers for landed source files.

Downloads, archives and spreadsheets are outside the job: files are expected
to be landed (unpacked) under a folder. Every reader uses an explicit schema
or reads all columns as strings and coerces with ``try_cast`` /
``try_to_date``, so a bad value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import scalars as X

DELIMITED_OPTIONS = {"sep": ";", "encoding": "ISO-8859-1", "header": "true", "mode": "PERMISSIVE"}

# The nine daily-quote columns kept from the monthly files.
QUOTE_COLUMNS = [
    "TP_FUNDO_CLASSE", "CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA",
    "VL_PATRIM_LIQ", "CAPTC_DIA", "RESG_DIA", "NR_COTST",
]
QUOTE_NUMBERS = ("VL_QUOTA", "VL_PATRIM_LIQ", "CAPTC_DIA", "RESG_DIA")


def _string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """File names matching a glob, from the file system's metadata (no data read)."""
    _, fs, p = _fs(spark, pattern)
    found = fs.globStatus(p) or []
    return sorted(str(st.getPath().toString()) for st in found if st.isFile())


def landed_files(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """(path, mark) of the files matching a glob; the mark changes with the file's size or time (metadata only)."""
    _, fs, p = _fs(spark, pattern)
    found = [st for st in fs.globStatus(p) or [] if st.isFile()]
    return sorted((str(st.getPath().toString()), f"{st.getLen()}-{st.getModificationTime()}") for st in found)


def _coerced(name: str) -> Column:
    """A text column as a finite number, else NULL: text that means no number or infinity is no value."""
    number = F.col(name).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def read_header(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> list[str]:
    """The header line of one delimited file: the first line only, read through the
    file system API (no Spark job)."""
    jvm, fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        line = reader.readLine()
    finally:
        stream.close()
    return line.split(sep) if line else []


def read_delimited(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None,
                   **options: str) -> DataFrame:
    """S1: ';'-separated Latin-1 files with a header; every column read as a string
    (keys keep their leading zeros). ``columns`` fixes the layout when known."""
    opts = {**DELIMITED_OPTIONS, **options}
    reader = spark.read.options(**opts)
    if columns is not None:
        reader = reader.schema(_string_schema(columns))
    else:
        reader = reader.option("inferSchema", "false")
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


# The kept quote columns and the header names that files of any year give them.
QUOTE_ALIASES = {
    "TP_FUNDO_CLASSE": ("TP_FUNDO_CLASSE", "TP_FUNDO"),
    "CNPJ_FUNDO_CLASSE": ("CNPJ_FUNDO_CLASSE", "CNPJ_FUNDO"),
    "ID_SUBCLASSE": ("ID_SUBCLASSE",),
}


def _in_quote_layout(df: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """One select from any year's header to the kept columns (and ``more``); a column that the year lacks is NULL."""
    def source(target: str) -> Column:
        found = [name for name in QUOTE_ALIASES.get(target, (target,)) if name in df.columns]
        return (F.col(found[0]) if found else F.lit(None).cast("string")).alias(target)

    return df.select(*[source(c) for c in QUOTE_COLUMNS], *more)


def read_monthly_quotes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Monthly daily-quote files whose headers drift across years.

    Files are grouped by header (one first-line read per file: metadata only,
    bounded by the number of monthly files); each group is read in one scan,
    normalised, and the groups are unioned by name. Dates and numbers are
    coerced; the nine kept columns are returned.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(tuple(read_header(spark, p)), []).append(p)
    out = spark.createDataFrame([], _string_schema(QUOTE_COLUMNS))  # all there is, if no file has landed
    for header, group in groups.items():
        out = out.unionByName(_in_quote_layout(read_delimited(spark, group, list(header))))
    return out.select(
        F.col("TP_FUNDO_CLASSE"), F.col("CNPJ_FUNDO_CLASSE"), F.col("ID_SUBCLASSE"),
        F.try_to_date(F.col("DT_COMPTC")).alias("DT_COMPTC"),
        *[_coerced(c).alias(c) for c in QUOTE_NUMBERS],
        _coerced("NR_COTST").try_cast("int").alias("NR_COTST"),  # written as 12 or 12.0
    )


CORRUPT = "corrupt_line"


def read_quotes_or_reasons(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S2 with every landed line accounted for: the kept columns, ``file``, and for lines that cannot be a quote ``reason`` and
    ``line``, else NULLs. Accepted and rejected rows add up to the landed data lines (blank lines are none).

    A line is rejected for its shape (more or fewer fields than the header), for lacking a date or for lacking a key; a
    number that is none is no reason, it becomes NULL.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(tuple(read_header(spark, p)), []).append(p)
    extra = StructType([StructField("file", StringType(), True), StructField(CORRUPT, StringType(), True)])
    out = spark.createDataFrame([], StructType(_string_schema(QUOTE_COLUMNS).fields + extra.fields))
    for header, group in groups.items():
        # all fields of a line are parsed, whatever is selected of them, so that its shape is known
        rows = read_delimited(spark, group, [*header, CORRUPT], columnNameOfCorruptRecord=CORRUPT, columnPruning="false")
        rows = rows.withColumn("file", F.element_at(F.split("_metadata.file_path", "/"), -1))
        out = out.unionByName(_in_quote_layout(rows, ("file", CORRUPT)))
    dated = F.try_to_date(F.col("DT_COMPTC"))
    reason = F.when(F.col(CORRUPT).isNotNull(), "fields").when(dated.isNull(), "date").when(F.col("CNPJ_FUNDO_CLASSE").isNull(), "key")
    whole = F.coalesce(F.col(CORRUPT), F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in QUOTE_COLUMNS]))
    return out.select(
        F.col("TP_FUNDO_CLASSE"), F.col("CNPJ_FUNDO_CLASSE"), F.col("ID_SUBCLASSE"), dated.alias("DT_COMPTC"),
        *[_coerced(c).alias(c) for c in QUOTE_NUMBERS], _coerced("NR_COTST").try_cast("int").alias("NR_COTST"),
        "file", reason.alias("reason"), F.when(reason.isNotNull(), whole).alias("line"))


def read_members(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """S3: a chosen set of named delimited tables in an unpacked folder, read lazily."""
    return {n: read_delimited(spark, f"{folder.rstrip('/')}/{n}.csv") for n in names}


def read_year_extract(spark: SparkSession, path: str) -> DataFrame:
    """One year of fund extracts projected to the four used columns."""
    df = read_delimited(spark, path)
    return df.select("CNPJ_FUNDO_CLASSE", "DT_COMPTC", "TAXA_ADM", "EXISTE_TAXA_PERFM")


def read_benchmark_json(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A rate series as a JSON array of {data, valor}: day-first date, percent -> decimal."""
    raw = spark.read.schema("data string, valor string").option("multiLine", True).json(path)
    return raw.select(
        F.try_to_date(F.col("data"), "dd/MM/yyyy").alias("date"),
        (_coerced("valor") / F.lit(100.0)).alias("rate"),
    )


def read_characteristics(spark: SparkSession, path: str, rename: Mapping[str, str], fmt: str = "csv") -> DataFrame:
    """The characteristics extract with its header renames (CSV or parquet)."""
    df = read_delimited(spark, path) if fmt == "csv" else spark.read.parquet(path)
    present = {k: v for k, v in rename.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def month_range(spark: SparkSession, start, end) -> DataFrame:
    """Inclusive list of 'YYYYMM' between two dates, one row per month."""
    return spark.range(1).select(F.explode(X.month_range(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("ym"))
