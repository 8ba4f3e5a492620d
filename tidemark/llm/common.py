"""Helpers shared by the corpus operators: tables, stored intermediate results, whole-batch numpy views of Arrow text."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData, SparkSession

from ..session import shared_path

#: Bytes of text that the numpy steps look at together; bounds a Python worker's arrays whatever the batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession, thorough: bool = True) -> None:
    """Let Spark remove the shuffle files of finished steps.

    They go when the driver's JVM collects the steps' handles; a job of many steps must not wait until it happens to.
    ``thorough`` waits for Python's own handles of the last step to reach the JVM, too.
    """
    for _ in range(2 if thorough else 1):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1.0 if thorough else 0)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once under the cluster's shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor repeats the steps since the last stored table only, and gives the
    optimizer the true size of what follows. Texts take far less disk with ``compression`` zstd.
    """
    spark = df.sparkSession
    path = shared_path(spark, "tidemark-llm", f"{label}-{uuid.uuid4().hex}")
    release(spark, thorough=False)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if _passing:
        _passing[-1].append(out)
    return out


#: Tables stored by the steps under way, those of the innermost last.
_passing: list[list[DataFrame]] = []


def settled(label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``stored(make(), label)``, after which all that ``make`` stored on the way is removed."""
    _passing.append([])
    try:
        kept = stored(make(), label)
    finally:
        made = _passing.pop()
    for df in made:
        if df is not kept:
            discard(df)
    if _passing:
        _passing[-1].append(kept)
    return kept


def discard(df: DataFrame) -> None:
    """Remove a table that ``stored`` wrote and nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, which need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        base = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), os.path.basename(package))
        sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, step: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors."""
    _ship_package(df.sparkSession)
    return df.mapInArrow(step, schema)


def group_arrow(groups: GroupedData, step: Callable, schema) -> DataFrame:
    """``groups.applyInArrow`` with this package on the executors."""
    _ship_package(groups.session)
    return groups.applyInArrow(step, schema)


_remembered: dict[str, dict] = {}


def remembered(step: str) -> dict:
    """What this Python worker remembers for a step. The memory of other steps goes: workers outlive their tasks, and what
    one step left behind would be missing to the next."""
    for other in _remembered.keys() - {step}:
        del _remembered[other]
    return _remembered.setdefault(step, {})


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one large_string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text each; a longer text stands alone."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    start = have = 0
    for i, n in enumerate(lengths):
        if i > start and have + n > size:
            yield start, i
            start, have = i, 0
        have += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def joined(column: pa.Array) -> str:
    """The strings of a column without nulls, with a blank between each two."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(column)], pa.int64()), column.cast(pa.large_string()))
    return pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_py()


def strings(column: pa.Array) -> list[str]:
    """The strings of a column without nulls and blanks; one string in between is far quicker than one scalar each."""
    return joined(column).split(" ") if len(column) else []


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large_string array, and its n + 1 offsets from 0, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (the finishing steps of SplitMix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
