"""Table maintenance on parquet directories.

Three write patterns of the warehouse, on plain parquet (no table format is
assumed, so there is no MERGE):

* time-series tables (K1): one authoritative row per natural key; an upsert
  rewrites only the month partitions the batch touches, null-safe on keys;
* snapshot tables (K2): every load appended under its ``reference_date``;
* derived tables (K3): one ``reference_date`` slice replaced per run through
  dynamic partition overwrite (idempotent; an empty frame leaves the old
  slice in place, since no partition is written).

``align_columns`` and ``schema_contract`` (K4/K5) hold a frame against a declared
StructType before a write: extra columns are refused, absent ones become typed NULLs.
"""

from __future__ import annotations

import json
import os
import uuid
from contextlib import contextmanager
from datetime import date, datetime
from typing import Callable, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import keyed


class SchemaContractError(ValueError):
    pass


# ------------------------------------------------------------------ existence / high-water marks


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    fs.delete(p, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's first partition column, from the folder names alone (no data, no footers)."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    names = [str(f.getPath().getName()) for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The table at ``path`` or None when it does not exist."""
    if not path_exists(spark, path):
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def max_date(spark: SparkSession, path: str, col: str) -> date | None:
    """High-water mark; None when the table is empty or missing. Reads one
    column only (and only partition values when ``col`` is a partition column)."""
    df = read_table(spark, path)
    if df is None:
        return None
    return df.agg(F.max(col).alias("m")).first()["m"]


# ------------------------------------------------------------------ schema (K4, K5, K9)


def align_columns(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """K4/K5: project onto the declared schema, in its order. Absent columns become
    typed NULLs; extra columns raise (``strict``) instead of being dropped silently."""
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra and strict:
        raise SchemaContractError(f"columns not in the declared schema: {extra}")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def schema_contract(df: DataFrame, schema: StructType) -> dict[str, list[str]]:
    """K5: missing / extra column names against a declared schema."""
    have, want = set(df.columns), set(schema.fieldNames())
    return {"missing": sorted(want - have), "extra": sorted(have - want)}


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> None:
    """K5: raise unless ``df`` has all the columns that the next step reads."""
    if lacking := sorted(set(columns) - set(df.columns)):
        raise SchemaContractError(f"{table} lacks the columns {lacking}")


def null_report(df: DataFrame) -> DataFrame:
    """K9: NULL count per column in one pass, as (column, n_null) rows."""
    cols = df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_null)")


# ------------------------------------------------------------------ write patterns (K1, K2, K3, K6)

#: Files that one upsert writes to a month at most.
FILES_PER_MONTH = 8


def append_snapshot(df: DataFrame, path: str, ref: date, partition_col: str = "reference_date") -> None:
    """K2: stamp the load date and append; old snapshots are never touched."""
    (df.withColumn(partition_col, F.lit(ref).cast("date"))
       .write.mode("append").partitionBy(partition_col).parquet(path))


def replace_partition(df: DataFrame, path: str, partition_col: str = "reference_date") -> None:
    """K3: replace the slices present in ``df`` (dynamic partition overwrite);
    other slices stay. Writing the same frame twice gives the same table."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def replace_snapshot(df: DataFrame, path: str, ref: date, partition_col: str = "reference_date") -> None:
    """K3 for derived tables: stamp the run date and replace its slice, so that a repeated run changes nothing."""
    replace_partition(df.withColumn(partition_col, F.lit(ref).cast("date")), path, partition_col)


def overwrite_table(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Replace a whole table: partitions that ``df`` lacks go too, whatever overwrite mode the session has."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` written to a folder of its own beside ``path`` and read back; the folder goes afterwards."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}__staging-{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        remove_path(spark, folder)


def clear_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """K6: replace the whole table by an empty one with the declared schema."""
    overwrite_table(spark.createDataFrame([], schema), path)


def upsert_timeseries(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    key: Sequence[str],
    date_col: str = "date",
) -> DataFrame:
    """K1: delete target rows whose key matches a batch key null-safely, insert
    every batch row (a key duplicated inside the batch stays duplicated).

    Only month partitions touched by the batch are rewritten: the untouched
    months are never read. The batch is stored once, the touched months are
    computed into a second folder (a job may not overwrite the partitions it is
    reading) and swapped in with a dynamic partition overwrite. Both folders are
    new for every call and removed after it. An empty batch is a no-op.
    Returns the rows of the touched months as now stored.
    """
    with staged(batch.withColumn("quote_month", F.date_format(F.col(date_col), "yyyy-MM")), path) as b:
        # the touched months: bounded by the batch's calendar span, read back as literals
        months = [r["quote_month"] for r in b.select("quote_month").distinct().collect()]
        if not months:
            return batch.limit(0)
        target = read_table(spark, path)
        if target is None:
            merged = b
        else:
            if "quote_month" not in target.columns:
                raise SchemaContractError("time-series table must be partitioned by quote_month (see write_timeseries)")
            old = target.where(F.col("quote_month").isin(months))  # partition pruning at the scan
            kept = keyed.null_safe_join(old, b.select(*key).distinct(), key, "left_anti")
            merged = kept.unionByName(b.select(*kept.columns))
        with staged(merged, path) as rows:
            by_month = rows.repartition("quote_month", F.pmod(F.xxhash64(*key), F.lit(FILES_PER_MONTH)))
            replace_partition(by_month, path, "quote_month")
    return spark.read.parquet(path).where(F.col("quote_month").isin(months)).drop("quote_month")


def write_timeseries(df: DataFrame, path: str, date_col: str = "date", key: Sequence[str] = ("fund_cnpj", "subclass_id"),
                     n_partitions: int | None = None) -> None:
    """Full (re)build of a time-series table, month-partitioned for K1.

    Rows are range-partitioned on (month, series key) first, so each task
    writes a contiguous slice of one or two months: files per month stay near
    (rows per month / rows per task) instead of one file per task per month.
    """
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn("quote_month", F.date_format(F.col(date_col), "yyyy-MM"))
    overwrite_table(out.repartitionByRange(n, "quote_month", *[k for k in key if k in df.columns]), path, "quote_month")


# ------------------------------------------------------------------ skip rules


def slice_exists(spark: SparkSession, path: str, ref: date, partition_col: str = "reference_date") -> bool:
    """Does the derived table already hold the slice for ``ref``? (partition listing only)"""
    return path_exists(spark, os.path.join(path, f"{partition_col}={ref.isoformat()}"))


def should_run(spark: SparkSession, path: str, ref: date, force: bool = False) -> bool:
    return force or not slice_exists(spark, path, ref)


def raw_newer_than_staged(spark: SparkSession, raw_path: str, staged_path: str, col: str = "reference_date") -> bool:
    """The newest raw snapshot is newer than the newest staged one (or staging is empty)."""
    raw_hw = max_date(spark, raw_path, col)
    stg_hw = max_date(spark, staged_path, col)
    return raw_hw is not None and (stg_hw is None or raw_hw > stg_hw)


# ------------------------------------------------------------------ publishing


def write_metrics_parquet(metrics: DataFrame, out_dir: str, ref: date) -> str:
    """K7: one reference-date slice to parquet; the date is stamped into the name."""
    path = os.path.join(out_dir, f"metrics_{ref.isoformat()}.parquet")
    metrics.where(F.col("reference_date") == F.lit(ref).cast("date")).write.mode("overwrite").parquet(path)
    return path


Sink = Callable[[DataFrame], None]


def json_dir_sink(path: str) -> Sink:
    """A sink writing the payload DataFrame as JSON (one document per line)."""
    # one document (a single row by construction); NULL fields are written as null
    return lambda payload: payload.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish(payload: DataFrame, sinks: Iterable[Sink]) -> None:
    """K8: deliver the payload to every sink, in order."""
    for sink in sinks:
        sink(payload)


def payload_to_dict(payload: DataFrame) -> dict:
    """The one-row payload as a Python document (bounded: segments x top_n funds)."""
    doc = F.to_json(F.struct(*[F.col(c) for c in payload.columns]), {"ignoreNullFields": "false"})
    return json.loads(payload.select(doc.alias("j")).first()["j"])


def write_check_log(results: DataFrame, path: str, logged_at: datetime | None = None) -> None:
    """Append check results with the log time (now, unless given), partitioned by run date."""
    at = F.current_timestamp() if logged_at is None else F.lit(logged_at).cast("timestamp")
    (results.withColumn("logged_at", at)
       .write.mode("append").partitionBy("reference_date").parquet(path))
