from __future__ import annotations

import os
import sys
import tempfile
from datetime import date, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    from tidemark.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=8, app="tidemark-tests", driver_memory="6g")
    s.sparkContext.setLogLevel("ERROR")

    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemark-test-")


def business_days(start: date, n: int) -> list[date]:
    out, d = [], start
    while len(out) < n:
        if d.weekday() < 5:
            out.append(d)
        d += timedelta(days=1)
    return out


@pytest.fixture(scope="session")
def quotes_2fund(spark):
    """Two series of 252 business days from 2023-01-02: A (NULL subclass) grows
    0.05% a day from 100, B ('sub1') 0.02% a day from 200."""
    days = business_days(date(2023, 1, 2), 252)
    rows = [("A", None, d, 100 * 1.0005 ** i) for i, d in enumerate(days)]
    rows += [("B", "sub1", d, 200 * 1.0002 ** i) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "fund_cnpj string, subclass_id string, date date, nav double")


@pytest.fixture(scope="session")
def cdi_flat(spark):
    days = business_days(date(2023, 1, 2), 252)
    return spark.createDataFrame([(d, 0.0001) for d in days], "date date, rate double")


@pytest.fixture(scope="session")
def cdi_empty(spark):
    return spark.createDataFrame([], "date date, rate double")
