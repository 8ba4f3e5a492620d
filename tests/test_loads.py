"""Load lifecycle: first load, repeat, revision, force; restaging from the last-value state equals a full rebuild."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import loads as L
from tidemark.plans import staging as S
from tidemark.sinks import tables as T
from tidemark.sources import readers as RD

RAW = "CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date, TP_FUNDO_CLASSE string, VL_QUOTA double, VL_PATRIM_LIQ double, CAPTC_DIA double, RESG_DIA double, NR_COTST int"
KEY = ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC"]


def quotes(spark, rows):
    return spark.createDataFrame([(c, s, d, "FI", nav, 10.0, 0.0, 0.0, holders) for c, s, d, nav, holders in rows], RAW)


def land(df, folder):
    by_month = df.withColumn("month", F.date_format("DT_COMPTC", "yyyy-MM")).repartition("month")
    by_month.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(folder)


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)


MARCH = [("A", None, date(2024, 3, 1), 10.0, 5), ("A", None, date(2024, 3, 4), 11.0, 5), ("B", "x", date(2024, 3, 4), 20.0, 2)]
APRIL = [("A", None, date(2024, 4, 2), 0.0, 5), ("B", "x", date(2024, 4, 2), 21.0, 2), ("B", "x", date(2024, 4, 3), 22.0, 2)]


def test_series_first_load_repeat_revision_and_force(spark, tmp_dir):
    ledger, target, landing = L.Ledger(spark, f"{tmp_dir}/ledger"), f"{tmp_dir}/raw", f"{tmp_dir}/landed"

    def run(day, force=False):
        return L.load_series(ledger, "quotes", target, f"{landing}/*/*.parquet", lambda paths: spark.read.parquet(*paths), KEY, "DT_COMPTC", date(2024, 4, day), force)

    assert run(1) == L.SKIP  # nothing has landed
    land(quotes(spark, MARCH + APRIL[:2]), landing)
    assert run(3) == L.LOAD and run(4) == L.SKIP
    before = T.path_exists(spark, target) and spark.read.parquet(target).inputFiles()
    assert run(4) == L.SKIP and spark.read.parquet(target).inputFiles() == before
    revised = [(c, s, d, nav + 1, n) for c, s, d, nav, n in APRIL]
    land(quotes(spark, revised), landing)
    land(quotes(spark, [("A", None, date(2024, 3, 1), 99.0, 5)]), landing)  # a month before the mark: by force only
    assert run(5) == L.LOAD
    assert same(quotes(spark, MARCH + revised), spark.read.parquet(target).drop("quote_month"))
    assert run(6, force=True) == L.REPLACE
    assert same(quotes(spark, [("A", None, date(2024, 3, 1), 99.0, 5)] + revised), spark.read.parquet(target).drop("quote_month"))
    log = [(r.action, r.from_date, r.high_water, r.n_rows) for r in ledger.rows().orderBy("logged_at").collect()]
    assert log[1] == (L.LOAD, None, date(2024, 4, 2), 5) and log[4] == (L.LOAD, date(2024, 4, 1), date(2024, 4, 3), 3)
    assert log[5] == (L.REPLACE, None, date(2024, 4, 3), 4)


def test_load_that_died_before_its_ledger_row_is_repeated(spark, tmp_dir, monkeypatch):
    ledger, target, landing = L.Ledger(spark, f"{tmp_dir}/ledger"), f"{tmp_dir}/raw", f"{tmp_dir}/landed"
    land(quotes(spark, MARCH), landing)
    run = lambda: L.load_series(ledger, "quotes", target, f"{landing}/*/*.parquet", lambda p: spark.read.parquet(*p), KEY, "DT_COMPTC", date(2024, 4, 1))
    with monkeypatch.context() as m:
        m.setattr(L.Ledger, "add", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run()
    assert run() == L.LOAD
    assert same(quotes(spark, MARCH), spark.read.parquet(target).drop("quote_month"))


def test_snapshots_are_loaded_once_a_day_and_replaced_by_force(spark, tmp_dir):
    ledger, root = L.Ledger(spark, f"{tmp_dir}/ledger"), f"{tmp_dir}/raw"
    frames = lambda *v: {"registry": spark.createDataFrame([(x,) for x in v], "v int"), "fees": spark.createDataFrame([(-x,) for x in v], "v int")}
    rows = lambda name: sorted((r.v, r.reference_date) for r in spark.read.parquet(f"{root}/{name}").collect())
    one, two = date(2024, 5, 1), date(2024, 5, 2)
    assert L.load_snapshots(ledger, frames(1, 2), root, one) == {"registry": L.LOAD, "fees": L.LOAD}
    assert set(L.load_snapshots(ledger, frames(3), root, one).values()) == {L.SKIP}
    assert rows("registry") == [(1, one), (2, one)]
    assert set(L.load_snapshots(ledger, frames(4), root, two).values()) == {L.LOAD}
    assert set(L.load_snapshots(ledger, frames(5), root, two, force=True).values()) == {L.REPLACE}
    assert rows("registry") == [(1, one), (2, one), (5, two)] and rows("fees") == [(-5, two), (-2, one), (-1, one)]


def test_restaging_equals_a_full_rebuild_after_a_revision(spark, tmp_dir):
    staged, state = f"{tmp_dir}/staged", f"{tmp_dir}/state"
    assert L.restage_quotes(spark, quotes(spark, []), staged, state) == []
    may = [("A", None, date(2024, 5, 2), 0.0, 5), ("C", None, date(2024, 5, 2), 7.0, 1), ("B", "x", date(2024, 5, 3), 0.0, 0)]
    steps = [MARCH, MARCH + APRIL, MARCH + [(c, s, d, nav * 3, n) for c, s, d, nav, n in APRIL[:2]],  # the last month loses a row
             MARCH + APRIL + may, MARCH + APRIL + may[1:2]]
    months = []
    for rows in steps:
        raw = quotes(spark, rows)
        months.append(L.restage_quotes(spark, raw, staged, state))
        assert same(S.clean_quotes(raw), spark.read.parquet(staged).drop("quote_month"))
    assert months == [["2024-03"], ["2024-03", "2024-04"], ["2024-04"], ["2024-04", "2024-05"], ["2024-05"]]
    assert L.restage_quotes(spark, quotes(spark, MARCH), staged, state, force=True) == ["2024-03"]
    assert same(S.clean_quotes(quotes(spark, MARCH)), spark.read.parquet(staged).drop("quote_month"))
    assert T.partition_values(spark, state, "as_of") == ["2024-03"] or spark.read.schema(L.STATE).parquet(state).count() == 0


def test_restaging_reads_no_staged_month_for_its_seeds(spark, tmp_dir):
    staged, state = f"{tmp_dir}/staged", f"{tmp_dir}/state"
    L.restage_quotes(spark, quotes(spark, MARCH + APRIL), staged, state)
    seeds = spark.read.schema(L.STATE).parquet(state).where(F.col("as_of") == "2024-04").drop("as_of")
    plan = L.clean_from(quotes(spark, APRIL), seeds)._jdf.queryExecution().executedPlan().toString()
    assert staged not in plan and f"{tmp_dir}/state" in plan
    assert sorted(map(tuple, seeds.collect())) == [("A", None, date(2024, 3, 4), 11.0), ("B", "x", date(2024, 3, 4), 20.0)]


def test_restaging_after_a_run_that_died_before_its_state(spark, tmp_dir, monkeypatch):
    staged, state = f"{tmp_dir}/staged", f"{tmp_dir}/state"
    L.restage_quotes(spark, quotes(spark, MARCH), staged, state)
    with monkeypatch.context() as m:
        m.setattr(L, "last_values", lambda rows: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            L.restage_quotes(spark, quotes(spark, MARCH + APRIL), staged, state)
    revised = quotes(spark, MARCH + APRIL[1:])
    L.restage_quotes(spark, revised, staged, state)
    assert same(S.clean_quotes(revised), spark.read.parquet(staged).drop("quote_month"))


def test_benchmark_takes_newer_dates_only(spark, tmp_dir):
    staged = f"{tmp_dir}/cdi"
    rates = lambda *r: spark.createDataFrame([(date(2024, m, d), x) for m, d, x in r], "date date, rate double")
    rows = lambda: sorted((r.date.month, r.date.day, r.rate) for r in spark.read.parquet(staged).collect())
    assert L.restage_benchmark(spark, rates(), staged) == 0
    assert L.restage_benchmark(spark, rates((1, 2, 0.1), (1, 3, 0.2)), staged) == 2
    assert L.restage_benchmark(spark, rates((1, 2, 0.9), (1, 3, 0.2)), staged) == 0
    assert L.restage_benchmark(spark, rates((1, 2, 0.9), (1, 4, 0.3), (2, 1, 0.4)), staged) == 2
    assert rows() == [(1, 2, 0.1), (1, 3, 0.2), (1, 4, 0.3), (2, 1, 0.4)]
    assert L.restage_benchmark(spark, rates((1, 2, 0.9)), staged, force=True) == 1 and rows() == [(1, 2, 0.9)]


def test_text_that_is_no_finite_number_is_null(spark, tmp_dir):
    lines = ["TP_FUNDO;CNPJ_FUNDO;DT_COMPTC;VL_QUOTA;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST", "FI;1;2024-01-02;NaN;Infinity;-inf;1.5;12.0", "FI;1;2024-01-03;x;;2;3;NaN"]
    with open(f"{tmp_dir}/q.csv", "w", encoding="latin-1") as f:
        f.write("\n".join(lines) + "\n")
    found = RD.read_monthly_quotes(spark, [f"file:{tmp_dir}/q.csv"]).orderBy("DT_COMPTC").collect()
    assert [tuple(r)[4:] for r in found] == [(None, None, None, 1.5, 12), (None, None, 2.0, 3.0, None)]
    empty = RD.read_monthly_quotes(spark, [])
    assert empty.count() == 0 and empty.columns == RD.QUOTE_COLUMNS
    with open(f"{tmp_dir}/r.json", "w") as f:
        f.write('[{"data": "02/01/2024", "valor": "NaN"}, {"data": "03/01/2024", "valor": "0.05"}]')
    assert sorted((r.date.day, r.rate) for r in RD.read_benchmark_json(spark, f"file:{tmp_dir}/r.json").collect()) == [(2, None), (3, 0.05 / 100)]


def test_rejected_lines_are_kept_by_file_and_counted(spark, tmp_dir):
    head = "TP_FUNDO;CNPJ_FUNDO;DT_COMPTC;VL_QUOTA;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST"
    good = ["FI;1;2024-01-02;10;1;0;0;5", "FI;2;2024-01-02;NaN;1;0;0;5"]
    bad = ["FI;1;2024-01-03;10", "FI;1;2024-01-03;10;1;0;0;5;9", "FI;1;soon;10;1;0;0;5", "FI;;2024-01-04;10;1;0;0;5"]

    def land(name, lines):
        with open(f"{tmp_dir}/{name}", "w", encoding="latin-1") as f:
            f.write("\n".join([head, *lines]) + "\n")
        return f"file:{tmp_dir}/{name}"

    read, rejects = L.read_quotes(spark, f"{tmp_dir}/rejects"), lambda: spark.read.schema("reason string, line string, file string").parquet(f"{tmp_dir}/rejects")
    paths = [land("a.csv", good + bad), land("b.csv", good + bad[:1])]
    accepted = read(paths)
    assert accepted.columns == RD.QUOTE_COLUMNS and accepted.count() == 4
    assert sorted((r.file, r.reason) for r in rejects().collect()) == [("a.csv", "date"), ("a.csv", "fields"), ("a.csv", "fields"), ("a.csv", "key"), ("b.csv", "fields")]
    assert {r.line for r in rejects().where("reason = 'fields'").collect()} == set(bad[:2])
    assert read([land("a.csv", good)]).count() == 2
    assert [r.file for r in rejects().collect()] == ["b.csv"]
