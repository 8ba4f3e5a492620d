"""As-of join on arbitrary dates against a plain search."""

from __future__ import annotations

import random
from datetime import date, timedelta

from tidemark.operators import timeseries as ts


def test_asof_join(spark):
    rng = random.Random(17)
    day = lambda k: date(2024, 1, 1) + timedelta(k)
    series = [("A", None), ("A", "x"), ("B", None), (None, None)]
    quotes = [(*s, day(k), None if rng.random() < 0.3 else float(k), k) for s in series[:3] for k in sorted(rng.sample(range(80), 25))]
    probes = [(i, *rng.choice(series), None if i % 19 == 0 else day(rng.randrange(-5, 100)), 1) for i in range(300)]
    p = spark.createDataFrame(probes, "id int, f string, s string, at date, n int").repartition(5)
    q = spark.createDataFrame(quotes, "f string, s string, d date, nav double, k int")
    for limit in (None, 0, 6):
        found = ts.asof_join(p, q, ["f", "s"], "at", "d", ["nav", "k"], max_days=limit)
        want = []
        for i, f, s, at, n in probes:
            old = [x for x in quotes if at is not None and (x[0], x[1]) == (f, s) and x[2] <= at and x[3] is not None and (limit is None or (at - x[2]).days <= limit)]
            want.append((i, f, s, at, n, *(max(old, key=lambda x: x[2])[2:] if old else (None,) * 3)))
        assert found.columns == ["id", "f", "s", "at", "n", "d", "nav", "k"]
        assert sorted(map(tuple, found.collect())) == sorted(want)
    assert ts.asof_join(p, q.limit(0), ["f", "s"], "at", "d", ["nav"]).where("nav is not null").count() == 0
