"""DuckDB oracle text per registered query key (same column names as the Spark side).

Every DOUBLE output column is wrapped as ``round(x, 6) + 0e0`` to mirror the
Spark side's output rounding; the set of double columns is declared here by
name.
"""

from __future__ import annotations

from tidemark.plans.serving import COHORT_COLS, COHORT_METRICS, HEADER_M, HEADER_U, TOP_COLS

from dateutil.relativedelta import relativedelta

from .sql import FEATS, LABELS, METRICS_COLS, QUOTES_START, RANKING_COLS, REF, ST, WINDOWS, _dotted, compose, d, dbl

DOUBLE_COLS = set(
    """nav aum inflows outflows VL_QUOTA VL_PATRIM_LIQ CAPTC_DIA RESG_DIA adm_fee perf_fee median_aum median_holders
    redemption_days_d min_initial_investment min_investment return_daily level peak drawdown r_fund rate cdi_rate
    annualized_return pct_months_above_cdi volatility sharpe_excess sharpe_raw max_drawdown ir_rate score
    fund_ret cdi_ret fund_cum cdi_cum value percentile bin_lo median_annualized_return cdi_annualized""".split()
)
DOUBLE_COLS |= {f"return_{l}" for l in WINDOWS} | {f"alpha_{l}" for l in WINDOWS} | {f"cdi_{l}" for l in WINDOWS}
DOUBLE_COLS |= {f"return_{l}_net" for l in LABELS} | {f"alpha_{l}_net" for l in LABELS}
DOUBLE_COLS |= {f"s_{c}" for c in FEATS} | {"s_span", "s_liquidity", "s_accessibility"}
DOUBLE_COLS |= set(HEADER_M) - {"span_days"}


def final(cols: list[str], source: str, where: str = "", doubles: set[str] | None = None) -> str:
    dbls = DOUBLE_COLS if doubles is None else doubles
    items = [f"round({c}, 6) + 0e0 AS {c}" if c in dbls else c for c in cols]
    return f"SELECT {', '.join(items)} FROM {source}{(' WHERE ' + where) if where else ''}"


def q(cols: list[str], source: str, *deps: str, where: str = "", doubles: set[str] | None = None) -> str:
    return compose(final(cols, source, where, doubles), *deps)


ORACLE: dict[str, str] = {}

RAW_Q = ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "TP_FUNDO_CLASSE", "VL_QUOTA", "VL_PATRIM_LIQ",
         "CAPTC_DIA", "RESG_DIA", "NR_COTST"]
QUOTE_COLS = ["fund_cnpj", "subclass_id", "date", "nav", "aum", "inflows", "outflows", "shareholders"]
SK = ["fund_cnpj", "subclass_id"]
SEG = ["purpose", "profile", "investor_type"]

ORACLE["dedupe_first"] = q(RAW_Q, "dq_dedup", "dq_dedup")

ORACLE["forward_fill"] = compose(final(
    ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA", "NR_COTST"], """(
  SELECT CNPJ_FUNDO_CLASSE, ID_SUBCLASSE, DT_COMPTC,
    LAST_VALUE(CASE WHEN VL_QUOTA <> 0 THEN VL_QUOTA END IGNORE NULLS) OVER w AS VL_QUOTA,
    LAST_VALUE(CASE WHEN NR_COTST <> 0 THEN NR_COTST END IGNORE NULLS) OVER w AS NR_COTST
  FROM dq_dedup
  WINDOW w AS (PARTITION BY CNPJ_FUNDO_CLASSE, ID_SUBCLASSE ORDER BY DT_COMPTC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""),
    "dq_dedup")

ORACLE["clean_quotes"] = q(QUOTE_COLS, "stg_quotes", "stg_quotes")
ORACLE["forward_fill_seeded"] = q(QUOTE_COLS, "stg_quotes", "stg_quotes", where="date >= DATE '2000-01-01'")

ORACLE["clean_registry_class"] = q(
    ["fund_cnpj", "fund_name", "inception_date", "status", "anbima_category", "target_investor", "share_class",
     "fund_structure", "is_exclusive"], "reg_class", "reg_class")

REG_COLS = ["fund_cnpj", "subclass_id", "fund_name", "inception_date", "status", "anbima_category", "target_investor",
            "share_class", "fund_structure", "is_exclusive", "is_pension"]
ORACLE["class_subclass"] = q(REG_COLS, "stg_registry", "stg_registry")
ORACLE["last_non_null_per_column"] = q(["fund_cnpj", "adm_fee_date", "adm_fee"], "fee_adm", "fee_adm")
ORACLE["fees_full"] = q(["fund_cnpj", "adm_fee", "adm_fee_date", "perf_fee", "perf_fee_desc", "perf_fee_date", "has_perf_fee"],
                        "fee_hist", "fee_hist")
ORACLE["clean_fees"] = q(["fund_cnpj", "adm_fee", "adm_fee_date", "perf_fee", "perf_fee_desc", "perf_fee_date", "has_perf_fee"],
                         "stg_fees", "stg_fees")
ORACLE["clean_characteristics"] = q(
    ["fund_cnpj", "subclass_id", "structure", "commercial_name", "target_taxation", "redemption_days",
     "min_initial_investment"], "stg_anbima", "stg_anbima", doubles=DOUBLE_COLS | {"redemption_days"})

ORACLE["quote_stats"] = q(["fund_cnpj", "subclass_id", "median_aum", "median_holders", "first_quote_date",
                           "last_quote_date", "quote_count"], "quote_stats", "quote_stats")


def _bd(x: str) -> str:
    k = f"date_diff('day', DATE '1900-01-01', {x})"
    return f"(({k}) // 7 * 5 + least(({k}) % 7, 5))"


ORACLE["business_days"] = compose(
    f"SELECT fund_cnpj, subclass_id, first_quote_date, last_quote_date, "
    f"CAST({_bd('last_quote_date + 1')} - {_bd('first_quote_date')} AS BIGINT) AS business_days FROM quote_stats",
    "quote_stats")

_P = ST.universe
ORACLE["quote_quality_filter"] = compose(final(["fund_cnpj", "subclass_id", "median_aum", "median_holders"], f"""quote_stats
WHERE COALESCE(date_diff('day', last_quote_date, {d(REF)}) <= {_P.max_quote_staleness_days}, FALSE)
  AND COALESCE(date_diff('day', first_quote_date, last_quote_date) >= {_P.min_span_days}, FALSE)
  AND COALESCE(quote_count / NULLIF({_bd('last_quote_date + 1')} - {_bd('first_quote_date')}, 0) >= {dbl(_P.min_obs_ratio)}, FALSE)"""),
    "quote_stats")

ORACLE["eligible_registry"] = q(REG_COLS, "elig", "elig")

UNIV_COLS = ["fund_cnpj", "subclass_id", "fund_name", "inception_date", "anbima_category", "target_investor",
             "share_class", "fund_structure", "adm_fee", "has_perf_fee", "median_aum", "median_holders",
             "target_taxation", "redemption_days", "min_investment", "reference_date"]
ORACLE["build_universe"] = q(UNIV_COLS, "universe", "universe")

ORACLE["daily_return"] = compose(final(["fund_cnpj", "subclass_id", "date", "nav", "return_daily"], """(
  SELECT * FROM (
    SELECT fund_cnpj, subclass_id, date, nav,
           nav / NULLIF(LAG(nav) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date), 0) - 1e0 AS return_daily
    FROM stg_quotes WHERE nav IS NOT NULL) WHERE return_daily IS NOT NULL)"""), "stg_quotes")

ORACLE["drawdown_series"] = compose(final(["fund_cnpj", "subclass_id", "date", "return_daily", "level", "peak", "drawdown"], """(
  SELECT *, level / NULLIF(peak, 0) - 1e0 AS drawdown FROM (
    SELECT *, max(level) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
    FROM (
      SELECT *, product(1e0 + return_daily) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level
      FROM (SELECT * FROM (
              SELECT fund_cnpj, subclass_id, date, nav,
                     nav / NULLIF(LAG(nav) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date), 0) - 1e0 AS return_daily
              FROM stg_quotes WHERE nav IS NOT NULL) WHERE return_daily IS NOT NULL))))"""), "stg_quotes")

FM_COLS = (SK + [f"return_{l}" for l in WINDOWS] + [f"alpha_{l}" for l in WINDOWS]
           + ["annualized_return", "volatility", "max_drawdown", "span_days", "pct_months_above_cdi", "sharpe_excess", "sharpe_raw"])
_fm_src = "(SELECT f.*, " + ", ".join(f"f.return_{l} - b.cdi_{l} AS alpha_{l}" for l in WINDOWS) + " FROM fm f CROSS JOIN bench b)"
ORACLE["fund_metrics"] = compose(final(FM_COLS, _fm_src), "fm", "bench")
ORACLE["trailing_returns"] = q(SK + [f"return_{l}" for l in WINDOWS], "fm", "fm")
ORACLE["annualized_return"] = q(SK + ["annualized_return"], "fm", "fm")
ORACLE["volatility_sharpe"] = q(SK + ["volatility", "sharpe_excess", "sharpe_raw"], "fm", "fm")
ORACLE["max_drawdown"] = q(SK + ["max_drawdown", "span_days"], "fm", "fm")
ORACLE["pct_months_above"] = q(SK + ["pct_months_above_cdi"], "fm", "fm")
ORACLE["monthly_compound"] = q(SK + ["month", "r_fund"], "fund_month", "fund_month")
ORACLE["benchmark_window_returns"] = q([f"cdi_{l}" for l in WINDOWS] + ["cdi_annualized"], "bench", "bench")
ORACLE["build_metrics"] = q(METRICS_COLS, "metrics", "metrics")

ORACLE["average_rank_pct"] = q(SK + ["investor_type"] + [f"s_{c}" for c in FEATS], "pct", "pct")
ORACLE["build_rankings"] = q(RANKING_COLS + ["reference_date"], "rankings", "rankings")

_top = f"""(
  SELECT t.*, c.eligible_funds FROM (
    SELECT {', '.join(SEG + TOP_COLS)},
           CAST(ROW_NUMBER() OVER (PARTITION BY purpose, profile, investor_type
                              ORDER BY rank ASC, fund_cnpj ASC, subclass_id ASC NULLS FIRST) AS INTEGER) AS position
    FROM rankings) t
  JOIN (SELECT purpose, profile, investor_type, COUNT(*) AS eligible_funds FROM rankings GROUP BY ALL) c
    USING (purpose, profile, investor_type)
  WHERE position <= {ST.top_n})"""
ORACLE["top_n_per_segment"] = compose(final(SEG + TOP_COLS + ["position", "eligible_funds"], _top), "rankings")



def _shown(fmt: str, col: str, factor: str = "1e0") -> str:
    return f"CASE WHEN {col} IS NOT NULL THEN printf('{fmt}', {col} * {factor}) END"


ORACLE["display_table"] = compose(f"""
SELECT {', '.join(SEG)}, position, fund_cnpj, fund_name,
       {_shown('%+.2f%%', 'return_annualized_net', '100e0')} AS return_annualized, {_shown('%+.2f%%', 'alpha_12m_net', '100e0')} AS alpha_12m,
       {_shown('%+.2f%%', 'return_12m_net', '100e0')} AS return_12m, {_shown('%.2f', 'sharpe_excess')} AS sharpe,
       {_shown('%.0f%%', 'pct_months_above_cdi', '100e0')} AS months_above, {_shown('%.2f%%', 'max_drawdown', '100e0')} AS max_drawdown,
       {_shown('D+%.0f', 'redemption_days')} AS redemption, {_shown('%.2f%%', 'volatility', '100e0')} AS volatility
FROM {_top}""", "rankings")

_PAY = ["return_annualized_net", "alpha_12m_net", "return_12m_net", "sharpe_excess", "pct_months_above_cdi", "max_drawdown", "volatility"]
_segments = ", ".join(f"('{x.purpose}', '{x.profile}', '{x.investor_type}')" for x in ST.segments)
ORACLE["segment_payload"] = compose(final(
    ["schema_version", "generated_at", "reference_date", "universe_size", *SEG, "eligible_funds", "rank", "cnpj", "subclass_id", "fund_name",
     *_PAY, "redemption_days"], f"""(
  SELECT '1.1' AS schema_version, '2001-06-30T00:00:00.000000+00:00' AS generated_at, '{REF.isoformat()}' AS reference_date,
         (SELECT COUNT(*) FROM universe WHERE reference_date = {d(REF)}) AS universe_size,
         s.purpose, s.profile, s.investor_type, COALESCE(t.eligible_funds, 0) AS eligible_funds, t.position AS rank, t.fund_cnpj AS cnpj,
         t.subclass_id, CASE WHEN t.position IS NOT NULL THEN COALESCE(t.fund_name, '') END AS fund_name,
         {', '.join('t.' + c for c in _PAY)}, CAST(t.redemption_days AS INTEGER) AS redemption_days
  FROM (VALUES {_segments}) AS s(purpose, profile, investor_type) LEFT JOIN {_top} t USING (purpose, profile, investor_type))""",
    doubles=set(_PAY)), "rankings", "universe")

SEGW = "purpose = 'income' AND profile = 'balanced' AND investor_type = 'qualified'"
_FTN = ["rank", "fund_name", "fund_cnpj", "subclass_id", "score", "return_12m_net", "alpha_12m_net", "sharpe_excess",
        "volatility", "max_drawdown", "pct_months_above_cdi", "redemption_days", "min_investment"]
ORACLE["filtered_top_n"] = compose(final(_FTN, f"""(
  SELECT {', '.join(_FTN)} FROM rankings WHERE reference_date = {d(REF)} AND {SEGW}
  ORDER BY rank ASC, fund_cnpj ASC, subclass_id ASC NULLS FIRST LIMIT {ST.top_n})"""), "rankings")
ORACLE["filtered_top_n_name"] = compose(final(_FTN, f"""(
  SELECT {', '.join(_FTN)} FROM rankings WHERE reference_date = {d(REF)} AND {SEGW} AND fund_name ILIKE '%PLIER#00000001%'
  ORDER BY rank ASC, fund_cnpj ASC, subclass_id ASC NULLS FIRST LIMIT {ST.top_n})"""), "rankings")

ORACLE["universe_summary"] = compose(final(["n_funds", "median_aum", "median_holders", "median_annualized_return"], f"""(
  SELECT COUNT(u.fund_cnpj) AS n_funds, MEDIAN(u.median_aum) AS median_aum, MEDIAN(u.median_holders) AS median_holders,
         MEDIAN(m.return_annualized_net) AS median_annualized_return
  FROM universe u LEFT JOIN metrics m
    ON m.fund_cnpj = u.fund_cnpj AND m.subclass_id IS NOT DISTINCT FROM u.subclass_id AND m.reference_date = u.reference_date
  WHERE u.reference_date = {d(REF)})"""), "universe", "metrics")

_HDR = SK + list(HEADER_U) + list(HEADER_M)
ORACLE["fund_header"] = compose(final(_HDR, f"""(
  SELECT u.fund_cnpj, u.subclass_id, {', '.join('u.' + c for c in HEADER_U)}, {', '.join('m.' + c for c in HEADER_M)}
  FROM universe u LEFT JOIN metrics m
    ON m.fund_cnpj = u.fund_cnpj AND m.subclass_id IS NOT DISTINCT FROM u.subclass_id AND m.reference_date = u.reference_date
  WHERE u.reference_date = {d(REF)})"""), "universe", "metrics")

ORACLE["fund_rank_row"] = q(SK + SEG + ["rank", "score"], "rankings", "rankings", where=f"reference_date = {d(REF)}")
ORACLE["cohort_returns"] = q(SEG + list(COHORT_COLS), "rankings", "rankings", where=f"reference_date = {d(REF)}")

_cm_union = " UNION ALL ".join(
    f"SELECT purpose, profile, investor_type, fund_cnpj, subclass_id, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, "
    f"{'1' if hib else '-1'} AS dir FROM rankings WHERE reference_date = {d(REF)}" for m, hib in COHORT_METRICS)
ORACLE["cohort_percentile"] = compose(final(SEG + SK + ["metric", "value", "percentile"], f"""(
  SELECT *, CASE WHEN value IS NULL THEN NULL ELSE
           (RANK() OVER (PARTITION BY purpose, profile, investor_type, metric, value IS NULL ORDER BY dir * value) - 1)
           / COUNT(value) OVER (PARTITION BY purpose, profile, investor_type, metric) * 100e0 END AS percentile
  FROM ({_cm_union}))"""), "rankings")

ORACLE["histogram"] = compose(final(SEG + ["bin", "bin_lo", "n"], f"""(
  SELECT purpose, profile, investor_type, bin, lo + (bin - 1) * (hi - lo) / 40e0 AS bin_lo, COUNT(*) AS n FROM (
    SELECT c.*, b.lo, b.hi,
           CAST(CASE WHEN (b.hi - b.lo) / 40e0 > 0 THEN least(floor((c.v - b.lo) / ((b.hi - b.lo) / 40e0)) + 1, 40) ELSE 1 END AS INTEGER) AS bin
    FROM (SELECT purpose, profile, investor_type, return_12m_net AS v FROM rankings
          WHERE reference_date = {d(REF)} AND return_12m_net IS NOT NULL) c
    JOIN (SELECT purpose, profile, investor_type, MIN(return_12m_net) AS lo, MAX(return_12m_net) AS hi FROM rankings
          WHERE reference_date = {d(REF)} AND return_12m_net IS NOT NULL GROUP BY ALL) b
    USING (purpose, profile, investor_type))
  GROUP BY purpose, profile, investor_type, bin, lo, hi)"""), "rankings")

ORACLE["ranking_dims"] = compose(" UNION ALL ".join(
    f"SELECT '{c}' AS dim, {c} AS value, CAST(ROW_NUMBER() OVER (ORDER BY {c}) - 1 AS INTEGER) AS ord "
    f"FROM (SELECT DISTINCT {c} FROM rankings WHERE reference_date = {d(REF)} AND {c} IS NOT NULL)" for c in SEG), "rankings")

_H12 = REF - relativedelta(months=12)
ORACLE["fund_history_12m"] = compose(final(
    SK + ["date", "cdi_rate", "nav", "fund_ret", "cdi_ret", "fund_cum", "cdi_cum", "drawdown"], f"""(
  SELECT fund_cnpj, subclass_id, date, cdi_rate, nav, fund_ret, cdi_ret, level - 1e0 AS fund_cum, cdi_level - 1e0 AS cdi_cum,
         level / NULLIF(max(level) OVER w, 0) - 1e0 AS drawdown
  FROM (
    SELECT *, product(1e0 + fund_ret) OVER w AS level, product(1e0 + cdi_ret) OVER w AS cdi_level FROM (
      SELECT *, COALESCE(nav / NULLIF(LAG(nav) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date), 0) - 1e0, 0e0) AS fund_ret,
             COALESCE(cdi_rate, 0e0) AS cdi_ret
      FROM (
        SELECT g.fund_cnpj, g.subclass_id, g.date, g.cdi_rate,
               LAST_VALUE(q.nav IGNORE NULLS) OVER (PARTITION BY g.fund_cnpj, g.subclass_id ORDER BY g.date
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nav
        FROM (SELECT k.fund_cnpj, k.subclass_id, c.date, c.rate AS cdi_rate
              FROM (SELECT DISTINCT fund_cnpj, subclass_id FROM universe) k
              CROSS JOIN (SELECT date, rate FROM fx_cdi WHERE date >= {d(_H12)} AND date <= {d(REF)}) c) g
        LEFT JOIN stg_quotes q ON q.fund_cnpj = g.fund_cnpj AND q.subclass_id IS NOT DISTINCT FROM g.subclass_id
              AND q.date = g.date AND q.date >= {d(_H12)} AND q.date <= {d(REF)}))
    WINDOW w AS (PARTITION BY fund_cnpj, subclass_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WINDOW w AS (PARTITION BY fund_cnpj, subclass_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""),
    "universe", "stg_quotes", "fx_cdi")

from .gates_sql import GATES  # noqa: E402

ORACLE.update(GATES)

# ----------------------------------------------------------------- snapshots, sets, sources, tables, streaming
from datetime import date as _date  # noqa: E402

from .sql import cte as _cte  # noqa: E402

_cte("snap_view", """
SELECT *, CAST(DATE '2001-03-01' + to_months(CAST(ID_Registro_Classe % 4 AS INTEGER)) AS DATE) AS reference_date
FROM fx_registro_classe""", "fx_registro_classe")
_SNAP_COLS = ["ID_Registro_Fundo", "ID_Registro_Classe", "CNPJ_Classe", "Denominacao_Social", "Data_Inicio", "Situacao",
              "Classificacao_Anbima", "Publico_Alvo", "Classe_Cotas", "Forma_Condominio", "Exclusivo", "reference_date"]


def _as_of(ref: _date) -> str:
    return compose(final(_SNAP_COLS, f"""snap_view WHERE reference_date = (
  SELECT COALESCE(MAX(reference_date) FILTER (WHERE reference_date <= {d(ref)}),
                  MIN(reference_date) FILTER (WHERE reference_date >= {d(ref)})) FROM snap_view)"""), "snap_view")


ORACLE["as_of_snapshot"] = _as_of(_date(2001, 5, 10))
ORACLE["as_of_snapshot_backfill"] = _as_of(_date(2001, 1, 1))
ORACLE["latest_snapshot"] = compose(final(_SNAP_COLS, "snap_view WHERE reference_date = (SELECT MAX(reference_date) FROM snap_view)"),
                                    "snap_view")
ORACLE["snapshot_date"] = compose(
    "SELECT MAX(reference_date) FILTER (WHERE reference_date <= DATE '2001-05-10') AS snapshot_date FROM snap_view", "snap_view")
ORACLE["recent_dates"] = compose("SELECT DISTINCT reference_date FROM snap_view", "snap_view")
ORACLE["distinct_keys"] = compose("SELECT DISTINCT fund_cnpj, subclass_id FROM stg_quotes", "stg_quotes")
ORACLE["set_difference"] = compose("""
SELECT e.fund_cnpj, e.subclass_id FROM elig e
WHERE NOT EXISTS (SELECT 1 FROM universe u WHERE u.fund_cnpj = e.fund_cnpj AND u.subclass_id IS NOT DISTINCT FROM e.subclass_id)""",
                                   "elig", "universe")
ORACLE["month_range"] = compose("""
SELECT strftime(m, '%Y%m') AS ym FROM (
  SELECT unnest(generate_series(date_trunc('month', MIN(date)), date_trunc('month', MAX(date)), INTERVAL 1 MONTH)) AS m
  FROM fx_cdi)""", "fx_cdi")
ORACLE["read_delimited"] = compose("""
SELECT CAST(ID_Registro_Fundo AS VARCHAR) AS ID_Registro_Fundo, CAST(ID_Registro_Classe AS VARCHAR) AS ID_Registro_Classe,
       CNPJ_Classe, Denominacao_Social, CAST(Data_Inicio AS VARCHAR) AS Data_Inicio, Situacao, Classificacao_Anbima,
       Publico_Alvo, Classe_Cotas, Forma_Condominio, Exclusivo
FROM fx_registro_classe""", "fx_registro_classe")
ORACLE["read_monthly_quotes"] = compose(final(RAW_Q, """(
  SELECT TP_FUNDO_CLASSE, CNPJ_FUNDO_CLASSE,
         CASE WHEN DT_COMPTC < DATE '1998-01-01' THEN NULL ELSE ID_SUBCLASSE END AS ID_SUBCLASSE,
         DT_COMPTC, VL_QUOTA, VL_PATRIM_LIQ, CAPTC_DIA, RESG_DIA, NR_COTST
  FROM fx_inf_diario)"""), "fx_inf_diario")
ORACLE["read_benchmark_json"] = compose(final(["date", "rate"], "fx_cdi"), "fx_cdi")
ORACLE["upsert_timeseries"] = compose(final(["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA"], """(
  SELECT CNPJ_FUNDO_CLASSE, ID_SUBCLASSE, DT_COMPTC, VL_QUOTA FROM fx_inf_diario WHERE DT_COMPTC < DATE '1999-07-01'
  UNION ALL
  SELECT CNPJ_FUNDO_CLASSE, ID_SUBCLASSE, DT_COMPTC, VL_QUOTA * 2 FROM fx_inf_diario WHERE DT_COMPTC >= DATE '1999-07-01')"""),
    "fx_inf_diario")
ORACLE["quote_feed"] = compose(final(["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA", "NR_COTST"], "fx_inf_diario"),
                               "fx_inf_diario")
ORACLE["null_report"] = compose(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM fx_inf_diario" for c in RAW_Q),
    "fx_inf_diario")

_TAX_COLS = SK + ["ir_rate"] + [f"return_{l}_net" for l in LABELS] + [f"alpha_{l}_net" for l in LABELS]
ORACLE["tax_layer"] = compose(final(_TAX_COLS, "(SELECT *, " + ", ".join(
    f"return_{l}_net - bn_{l} AS alpha_{l}_net" for l in LABELS) + " FROM fm_net)"), "fm_net")

# ------------------------------------------------------------------ load lifecycle

_REVISED = "DT_COMPTC >= DATE '1999-07-01'"
_LANDED = "DT_COMPTC < DATE '1999-07-15'"
ORACLE["load_series"] = compose(final(RAW_Q, f"""(
  SELECT * REPLACE (CASE WHEN {_REVISED} THEN VL_QUOTA * 2 ELSE VL_QUOTA END AS VL_QUOTA) FROM fx_inf_diario)"""), "fx_inf_diario")
ORACLE["load_ledger"] = compose(f"""
SELECT 1 AS run, 'load' AS action, CAST(NULL AS DATE) AS from_date, MAX(DT_COMPTC) FILTER (WHERE {_LANDED}) AS high_water,
       COUNT(*) FILTER (WHERE {_LANDED}) AS n_rows FROM fx_inf_diario
UNION ALL SELECT 2, 'skip', NULL, MAX(DT_COMPTC) FILTER (WHERE {_LANDED}), 0 FROM fx_inf_diario
UNION ALL SELECT 3, 'load', DATE '1999-07-01', MAX(DT_COMPTC), COUNT(*) FILTER (WHERE {_REVISED}) FROM fx_inf_diario
UNION ALL SELECT 4, 'skip', NULL, MAX(DT_COMPTC), 0 FROM fx_inf_diario
UNION ALL SELECT 5, 'replace', NULL, MAX(DT_COMPTC), COUNT(*) FROM fx_inf_diario""", "fx_inf_diario")
ORACLE["load_snapshots"] = compose("""
SELECT ID_Registro_Fundo, CNPJ_Classe, Situacao, DATE '2001-02-01' AS reference_date FROM fx_registro_classe
UNION ALL SELECT ID_Registro_Fundo, CNPJ_Classe, upper(Situacao), DATE '2001-03-01' FROM fx_registro_classe""", "fx_registro_classe")
_RESTAGED = """(
  SELECT fund_cnpj, subclass_id, date,
         LAST_VALUE(CASE WHEN date >= DATE '1999-07-01' THEN nav_raw * 2 ELSE nav_raw END IGNORE NULLS) OVER (
           PARTITION BY fund_cnpj, subclass_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nav,
         aum, inflows, outflows, shareholders
  FROM dq_clean)"""
ORACLE["restage_quotes"] = compose(final(QUOTE_COLS, _RESTAGED), "dq_clean")
ORACLE["last_value_state"] = compose(f"""
SELECT fund_cnpj, subclass_id, MAX(date) AS date, round(arg_max_null(nav, date), 6) + 0e0 AS nav, any_value(as_of) AS as_of
FROM (SELECT *, strftime((SELECT MAX(date) FROM dq_clean), '%Y-%m') AS as_of FROM {_RESTAGED})
WHERE strftime(date, '%Y-%m') < as_of GROUP BY fund_cnpj, subclass_id""", "dq_clean")
ORACLE["restage_benchmark"] = compose(final(["date", "rate"], "fx_cdi"), "fx_cdi")
_FEE_COLS = ["fund_cnpj", "adm_fee", "adm_fee_date", "perf_fee", "perf_fee_desc", "perf_fee_date", "has_perf_fee"]
ORACLE["restage_fees"] = q([*_FEE_COLS, "reference_date"], "(SELECT *, DATE '2001-05-01' AS reference_date FROM stg_fees)", "stg_fees")
ORACLE["asof_join"] = compose(f"""
SELECT p.probe_id, p.fund_cnpj, p.subclass_id, p.probe_date,
       CASE WHEN date_diff('day', q.date, p.probe_date) <= 30 THEN q.date END AS date,
       CASE WHEN date_diff('day', q.date, p.probe_date) <= 30 THEN round(q.nav, 6) + 0e0 END AS nav
FROM (SELECT o_orderkey AS probe_id, {_dotted('1 + o_custkey % 40')} AS fund_cnpj,
             CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'A' ELSE 'R' END AS subclass_id, CAST(o_orderdate AS DATE) AS probe_date,
             COALESCE(CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'A' ELSE 'R' END, '-') AS k FROM orders) p
ASOF LEFT JOIN (SELECT fund_cnpj, COALESCE(subclass_id, '-') AS k, date, nav FROM stg_quotes WHERE nav IS NOT NULL) q
  ON p.fund_cnpj = q.fund_cnpj AND p.k = q.k AND p.probe_date >= q.date""", "stg_quotes")
ORACLE["quote_rejects"] = compose("""
SELECT outcome, COUNT(*) AS n_lines, COUNT(nav) AS n_quotas, COUNT(*) FILTER (WHERE outcome <> 'accepted') AS n_kept_lines
FROM (SELECT CASE tb1 % 40 WHEN 1 THEN 'date' WHEN 2 THEN 'key' WHEN 3 THEN 'fields' WHEN 4 THEN 'fields' ELSE 'accepted' END AS outcome,
             CASE WHEN tb1 % 40 <> 5 THEN VL_QUOTA END AS nav FROM fx_inf_diario)
GROUP BY outcome""", "fx_inf_diario")
