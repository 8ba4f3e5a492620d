"""Independent DuckDB SQL for every registered query (the correctness oracle).

Fixture views are the DuckDB text of FIXTURES.md Part B. Derived layers are
written as CTEs with explicit dependencies; ``compose`` emits the needed CTEs
in dependency order in front of a final SELECT. All numeric literals that
take part in arithmetic are DOUBLE (DuckDB reads 0.15 as DECIMAL).
"""

from __future__ import annotations

from datetime import date, timedelta

from dateutil.relativedelta import relativedelta

from tidemark.settings import INVESTOR_ACCESS, fixture_settings

ST = fixture_settings()
REF = ST.reference_date
P = ST.universe


def d(x: date) -> str:
    return f"DATE '{x.isoformat()}'"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def fmt_key(x: str) -> str:
    """DuckDB twin of format_key."""
    dg = f"regexp_replace(COALESCE(CAST({x} AS VARCHAR), ''), '[^0-9]', '', 'g')"
    p = f"(CASE WHEN length({dg}) < 14 THEN lpad({dg}, 14, '0') ELSE {dg} END)"
    return (f"(substr({p}, 1, 2) || '.' || substr({p}, 3, 3) || '.' || substr({p}, 6, 3) || '/' "
            f"|| substr({p}, 9, 4) || '-' || substr({p}, 13))")


def _dotted(x: str) -> str:
    p = f"lpad(CAST({x} AS VARCHAR), 14, '0')"
    return (f"substr({p}, 1, 2) || '.' || substr({p}, 3, 3) || '.' || substr({p}, 6, 3) || '/' "
            f"|| substr({p}, 9, 4) || '-' || substr({p}, 13, 2)")


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def compose(final: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


# ----------------------------------------------------------------- fixture views (FIXTURES.md, Part B)

cte("fx_inf_diario", f"""
SELECT {_dotted('l_suppkey')} AS CNPJ_FUNDO_CLASSE,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS ID_SUBCLASSE,
       CAST(l_shipdate AS DATE) AS DT_COMPTC,
       l_linestatus AS TP_FUNDO_CLASSE,
       CASE WHEN l_linenumber = 7 AND l_quantity <= 10 THEN 0e0 ELSE 100e0 + l_extendedprice / 1e3 END AS VL_QUOTA,
       l_extendedprice * 1e3 AS VL_PATRIM_LIQ,
       l_discount * 1e3 AS CAPTC_DIA,
       l_tax * 1e3 AS RESG_DIA,
       CASE WHEN l_quantity <= 5 THEN 0 ELSE CAST(l_quantity * 20 AS INT) END AS NR_COTST,
       l_orderkey AS tb1, l_linenumber AS tb2, l_partkey AS tb3
FROM lineitem""")

cte("fx_cdi", """
SELECT CAST(o_orderdate AS DATE) AS date, (1 + MIN(o_orderkey) % 60) / 1e5 AS rate
FROM orders GROUP BY CAST(o_orderdate AS DATE)""")

cte("fx_registro_classe", """
SELECT CAST(s_suppkey AS BIGINT) + v.off AS ID_Registro_Fundo,
       CAST(s_suppkey AS BIGINT) + 1000000 AS ID_Registro_Classe,
       CAST(s_suppkey AS VARCHAR) AS CNPJ_Classe,
       s_name || CASE WHEN s_nationkey % 7 = 0 THEN ' INCENTIVADO' ELSE '' END AS Denominacao_Social,
       CASE WHEN s_nationkey = 24 THEN NULL ELSE DATE '1994-01-01' + CAST(s_nationkey AS INT) * 30 END AS Data_Inicio,
       CASE WHEN v.off < 0 OR s_suppkey % 11 = 5 THEN 'Cancelado' ELSE 'Em Funcionamento Normal' END AS Situacao,
       CASE WHEN s_suppkey % 13 = 7 THEN 'Acoes' WHEN s_suppkey % 17 = 9 THEN NULL ELSE 'Renda Fixa Simples' END AS Classificacao_Anbima,
       CASE s_nationkey % 3 WHEN 0 THEN 'Publico Geral' WHEN 1 THEN 'Qualificado' ELSE 'Profissional' END AS Publico_Alvo,
       'Classe' AS Classe_Cotas,
       CASE WHEN s_suppkey % 23 = 3 THEN 'Fechado' WHEN s_suppkey % 23 = 4 THEN NULL ELSE 'Aberto' END AS Forma_Condominio,
       CASE WHEN s_suppkey % 19 = 6 THEN 'S' ELSE 'N' END AS Exclusivo
FROM supplier CROSS JOIN (VALUES (0), (-500000)) AS v(off)
WHERE v.off = 0 OR s_suppkey % 5 = 0""")

cte("fx_registro_subclasse", """
SELECT CAST(s_suppkey AS BIGINT) + 1000000 AS ID_Registro_Classe, v.sub AS ID_Subclasse,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name || ' ' || v.sub END AS Denominacao_Social,
       CASE WHEN s_suppkey % 29 = 8 THEN 'S' WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'N' END AS Previdenciario
FROM supplier CROSS JOIN (VALUES ('A'), ('R')) AS v(sub)
WHERE s_suppkey % 3 <> 0""")

cte("fx_taxa_adm", """
SELECT CAST(user_id AS VARCHAR) AS CNPJ_FUNDO,
       CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'n/d' ELSE 'NaN' END
            WHEN event_id % 9 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS TAXA_ADM,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS DT_INI_TAXA_ADM,
       event_id AS tb1
FROM events WHERE event_type IN ('view', 'click', 'error')""")

cte("fx_taxa_perfm", """
SELECT CAST(user_id AS VARCHAR) AS CNPJ_FUNDO,
       CASE WHEN user_id % 4 = 0 OR event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 0e0 ELSE value END AS VL_TAXA_PERFM,
       props AS DS_TAXA_PERFM, CAST(ts AS DATE) AS DT_INI_TAXA_PERFM, event_id AS tb1
FROM events WHERE event_type = 'purchase'""")

cte("fx_extrato", f"""
SELECT {_dotted('user_id')} AS CNPJ_FUNDO_CLASSE, CAST(ts AS DATE) AS DT_COMPTC,
       value / 1e2 AS TAXA_ADM,
       CASE event_id % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE NULL END AS EXISTE_TAXA_PERFM,
       event_id AS tb1
FROM events WHERE event_type = 'signup'""")

cte("fx_anbima", """
SELECT CAST(p_partkey AS VARCHAR) AS Cnpj_Da_Classe, v.est AS Estrutura,
       CASE WHEN v.code = 'A' AND p_partkey % 31 = 2 THEN NULL ELSE ' ' || v.code END AS Codigo_Cvm_Subclasse,
       p_name AS Nome_Comercial,
       CASE p_partkey % 3 WHEN 0 THEN 'Renda Fixa' WHEN 1 THEN 'Multimercados' ELSE NULL END AS Categoria_Anbima,
       CASE p_partkey % 4 WHEN 0 THEN 'Varejo' WHEN 1 THEN 'Private' ELSE NULL END AS Tipo_De_Investidor,
       CASE p_type WHEN 'MEDIUM' THEN 'Longo Prazo' WHEN 'SMALL' THEN 'Curto Prazo' WHEN 'PROMO' THEN 'Isento'
            WHEN 'LARGE' THEN 'Outros' WHEN 'STANDARD' THEN 'Alíquota de 15%' ELSE NULL END AS Tributacao_Alvo,
       CASE WHEN p_partkey % 25 = 1 THEN 'n/d' ELSE CAST(p_size AS VARCHAR) END AS Prazo_Pagamento_Resgate_Em_Dias,
       CASE WHEN p_partkey % 25 = 2 THEN 'n/d' ELSE CAST(CAST(p_retailprice * 10 AS INT) AS VARCHAR) END AS Aplicacao_Inicial_Minima
FROM part CROSS JOIN (VALUES ('Classe', 'X'), ('Subclasse', 'A'), ('Subclasse', 'R')) AS v(est, code)""")

# ----------------------------------------------------------------- staging

cte("dq_dedup", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY CNPJ_FUNDO_CLASSE, ID_SUBCLASSE, DT_COMPTC
    ORDER BY TP_FUNDO_CLASSE ASC NULLS FIRST, tb1 ASC NULLS FIRST, tb2 ASC NULLS FIRST,
             tb3 ASC NULLS FIRST, VL_QUOTA ASC NULLS FIRST) AS rn
  FROM fx_inf_diario) WHERE rn = 1""", "fx_inf_diario")

cte("dq_clean", """
SELECT CNPJ_FUNDO_CLASSE AS fund_cnpj, ID_SUBCLASSE AS subclass_id, DT_COMPTC AS date,
       CASE WHEN COALESCE(VL_QUOTA = 0, FALSE) AND (COALESCE(NR_COTST, 0) > 0 OR COALESCE(VL_PATRIM_LIQ, 0) > 0)
            THEN NULL ELSE VL_QUOTA END AS nav_raw,
       VL_PATRIM_LIQ AS aum, CAPTC_DIA AS inflows, RESG_DIA AS outflows, CAST(NR_COTST AS INTEGER) AS shareholders
FROM dq_dedup
WHERE NOT COALESCE(VL_QUOTA = 0 AND NR_COTST = 0, FALSE)""", "dq_dedup")

cte("stg_quotes", """
SELECT fund_cnpj, subclass_id, date,
       LAST_VALUE(nav_raw IGNORE NULLS) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nav,
       aum, inflows, outflows, shareholders
FROM dq_clean""", "dq_clean")

cte("reg_class", f"""
SELECT * EXCLUDE (rn, ID_Registro_Fundo) FROM (
  SELECT {fmt_key('CNPJ_Classe')} AS fund_cnpj, ID_Registro_Fundo, ID_Registro_Classe,
         Denominacao_Social AS fund_name, CAST(Data_Inicio AS DATE) AS inception_date, Situacao AS status,
         Classificacao_Anbima AS anbima_category, Publico_Alvo AS target_investor, Classe_Cotas AS share_class,
         Forma_Condominio AS fund_structure, Exclusivo AS is_exclusive,
         ROW_NUMBER() OVER (PARTITION BY {fmt_key('CNPJ_Classe')}
                            ORDER BY ID_Registro_Fundo DESC NULLS LAST, ID_Registro_Classe DESC NULLS LAST) AS rn
  FROM fx_registro_classe) WHERE rn = 1""", "fx_registro_classe")

cte("stg_registry", """
SELECT c.fund_cnpj, s.ID_Subclasse AS subclass_id, COALESCE(s.Denominacao_Social, c.fund_name) AS fund_name,
       c.inception_date, c.status, c.anbima_category, c.target_investor, c.share_class, c.fund_structure,
       c.is_exclusive, COALESCE(s.Previdenciario, 'N') AS is_pension
FROM reg_class c LEFT JOIN fx_registro_subclasse s ON c.ID_Registro_Classe = s.ID_Registro_Classe""",
    "reg_class", "fx_registro_subclasse")

cte("fee_adm", f"""
SELECT fund_cnpj, MAX(adm_fee_date) AS adm_fee_date,
       arg_max(adm_fee, row(COALESCE(adm_fee_date, DATE '9999-12-31'), tb1)) FILTER (WHERE adm_fee IS NOT NULL) AS adm_fee
FROM (SELECT {fmt_key('CNPJ_FUNDO')} AS fund_cnpj, NULLIF(TRY_CAST(TAXA_ADM AS DOUBLE), 'NaN'::DOUBLE) AS adm_fee, DT_INI_TAXA_ADM AS adm_fee_date, tb1 FROM fx_taxa_adm)
GROUP BY fund_cnpj""", "fx_taxa_adm")

cte("fee_perf", f"""
SELECT fund_cnpj, perf_fee_date, perf_fee, perf_fee_desc,
       CASE WHEN perf_fee IS NULL THEN NULL ELSE perf_fee > 0 END AS has_perf_fee
FROM (
  SELECT fund_cnpj, MAX(perf_fee_date) AS perf_fee_date,
         arg_max(perf_fee, row(COALESCE(perf_fee_date, DATE '9999-12-31'), tb1)) FILTER (WHERE perf_fee IS NOT NULL) AS perf_fee,
         arg_max(perf_fee_desc, row(COALESCE(perf_fee_date, DATE '9999-12-31'), tb1)) FILTER (WHERE perf_fee_desc IS NOT NULL) AS perf_fee_desc
  FROM (SELECT {fmt_key('CNPJ_FUNDO')} AS fund_cnpj, VL_TAXA_PERFM AS perf_fee, DS_TAXA_PERFM AS perf_fee_desc,
               DT_INI_TAXA_PERFM AS perf_fee_date, tb1 FROM fx_taxa_perfm)
  GROUP BY fund_cnpj)""", "fx_taxa_perfm")

cte("fee_ext", """
SELECT fund_cnpj, adm_fee,
       CASE e WHEN 'S' THEN TRUE WHEN 'N' THEN FALSE ELSE NULL END AS has_perf_fee
FROM (
  SELECT CNPJ_FUNDO_CLASSE AS fund_cnpj,
         arg_max(TAXA_ADM, row(COALESCE(DT_COMPTC, DATE '9999-12-31'), tb1)) FILTER (WHERE TAXA_ADM IS NOT NULL) AS adm_fee,
         arg_max(EXISTE_TAXA_PERFM, row(COALESCE(DT_COMPTC, DATE '9999-12-31'), tb1)) FILTER (WHERE EXISTE_TAXA_PERFM IS NOT NULL) AS e
  FROM fx_extrato GROUP BY CNPJ_FUNDO_CLASSE)""", "fx_extrato")

cte("fee_hist", """
SELECT COALESCE(a.fund_cnpj, p.fund_cnpj) AS fund_cnpj, a.adm_fee, a.adm_fee_date, p.perf_fee, p.perf_fee_desc,
       p.perf_fee_date, p.has_perf_fee
FROM fee_adm a FULL OUTER JOIN fee_perf p ON a.fund_cnpj = p.fund_cnpj""", "fee_adm", "fee_perf")

cte("fee_filled", """
SELECT h.fund_cnpj, COALESCE(h.adm_fee, e.adm_fee) AS adm_fee, h.adm_fee_date, h.perf_fee, h.perf_fee_desc,
       h.perf_fee_date, COALESCE(h.has_perf_fee, e.has_perf_fee) AS has_perf_fee
FROM fee_hist h LEFT JOIN fee_ext e ON h.fund_cnpj = e.fund_cnpj""", "fee_hist", "fee_ext")

cte("stg_fees", """
SELECT fund_cnpj,
       CASE WHEN adm_fee <= 5 THEN adm_fee ELSE adm_fee / 100e0 END AS adm_fee, adm_fee_date,
       CASE WHEN perf_fee <= 5 THEN perf_fee ELSE perf_fee / 100e0 END AS perf_fee,
       perf_fee_desc, perf_fee_date, has_perf_fee
FROM fee_filled""", "fee_filled")

cte("stg_anbima", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY structure NULLS FIRST, commercial_name NULLS FIRST,
    target_taxation NULLS FIRST, redemption_days NULLS FIRST, min_initial_investment NULLS FIRST) AS rn FROM (
    SELECT {fmt_key('Cnpj_Da_Classe')} AS fund_cnpj,
           NULLIF(trim(CASE WHEN Estrutura = 'Subclasse' THEN Codigo_Cvm_Subclasse END), '') AS subclass_id,
           Estrutura AS structure, Nome_Comercial AS commercial_name, Tributacao_Alvo AS target_taxation,
           TRY_CAST(Prazo_Pagamento_Resgate_Em_Dias AS DOUBLE) AS redemption_days,
           TRY_CAST(Aplicacao_Inicial_Minima AS DOUBLE) AS min_initial_investment
    FROM fx_anbima
    WHERE NOT COALESCE(Estrutura = 'Subclasse' AND Codigo_Cvm_Subclasse IS NULL, FALSE)))
WHERE rn = 1""", "fx_anbima")

# ----------------------------------------------------------------- universe


def _bdays_before(x: str) -> str:
    k = f"date_diff('day', DATE '1900-01-01', {x})"
    return f"(({k}) // 7 * 5 + least(({k}) % 7, 5))"


LOOKBACK_START = REF - timedelta(days=P.aum_lookback_days)

cte("quote_stats", f"""
SELECT fund_cnpj, subclass_id,
       MEDIAN(aum) FILTER (WHERE date >= {d(LOOKBACK_START)} AND date <= {d(REF)}) AS median_aum,
       MEDIAN(CAST(shareholders AS DOUBLE)) FILTER (WHERE date >= {d(LOOKBACK_START)} AND date <= {d(REF)}) AS median_holders,
       MIN(date) AS first_quote_date, MAX(date) AS last_quote_date, COUNT(*) AS quote_count
FROM stg_quotes WHERE date <= {d(REF)}
GROUP BY fund_cnpj, subclass_id""", "stg_quotes")

cte("elig", f"""
SELECT * FROM stg_registry
WHERE status = 'Em Funcionamento Normal'
  AND COALESCE(starts_with(anbima_category, 'Renda Fixa'), FALSE)
  AND COALESCE(is_exclusive, 'N') <> 'S'
  AND COALESCE(fund_structure, '') <> 'Fechado'
  AND COALESCE(is_pension, 'N') <> 'S'
  AND COALESCE(inception_date <= {d(REF)}, FALSE)""", "stg_registry")

cte("u_quotes", f"""
SELECT e.*, f.adm_fee, f.has_perf_fee, q.median_aum, q.median_holders,
       q.first_quote_date, q.last_quote_date, q.quote_count
FROM elig e
LEFT JOIN stg_fees f ON e.fund_cnpj = f.fund_cnpj
LEFT JOIN quote_stats q ON e.fund_cnpj = q.fund_cnpj AND e.subclass_id IS NOT DISTINCT FROM q.subclass_id
WHERE q.median_aum IS NOT NULL
  AND COALESCE(date_diff('day', q.last_quote_date, {d(REF)}) <= {P.max_quote_staleness_days}, FALSE)
  AND COALESCE(date_diff('day', q.first_quote_date, q.last_quote_date) >= {P.min_span_days}, FALSE)
  AND COALESCE(q.quote_count / NULLIF({_bdays_before("q.last_quote_date + 1")} - {_bdays_before("q.first_quote_date")}, 0)
               >= {dbl(P.min_obs_ratio)}, FALSE)""", "elig", "stg_fees", "quote_stats")

UNIVERSE_SELECT = """fund_cnpj, subclass_id, fund_name, inception_date, anbima_category, target_investor, share_class,
       fund_structure, adm_fee, has_perf_fee, median_aum, median_holders, target_taxation, redemption_days,
       min_investment, reference_date"""

cte("universe", f"""
SELECT u.fund_cnpj, u.subclass_id, u.fund_name, u.inception_date, u.anbima_category, u.target_investor,
       u.share_class, u.fund_structure, u.adm_fee, u.has_perf_fee, u.median_aum, u.median_holders,
       a.target_taxation, CAST(round(a.redemption_days) AS INTEGER) AS redemption_days,
       a.min_initial_investment AS min_investment, {d(REF)} AS reference_date
FROM u_quotes u
LEFT JOIN stg_anbima a ON u.fund_cnpj = a.fund_cnpj AND u.subclass_id IS NOT DISTINCT FROM a.subclass_id
WHERE COALESCE(u.median_holders, 0) > {dbl(P.min_cotistas)} AND COALESCE(u.median_aum, 0) > {dbl(P.min_aum)}""",
    "u_quotes", "stg_anbima")

# ----------------------------------------------------------------- metrics

QUOTES_START = REF - relativedelta(months=ST.quotes_start_months)
CDI_START = REF - relativedelta(months=ST.cdi_start_months)
WINDOWS = dict(ST.windows)
CUT = {l: REF - relativedelta(months=m) for l, m in WINDOWS.items()}
LABELS = list(WINDOWS) + ["annualized"]

cte("cdi", f"SELECT date, rate FROM fx_cdi WHERE date >= {d(CDI_START)} AND date <= {d(REF)}", "fx_cdi")

_bench_cols = ",\n".join(
    f"  COALESCE(product(1e0 + rate) FILTER (WHERE date > {d(CUT[l])} AND date <= {d(REF)}) - 1e0, 0e0) AS cdi_{l}"
    for l in WINDOWS
)
cte("bench", f"""
SELECT {_bench_cols},
  (SELECT CASE WHEN date_diff('day', MIN(date), {d(REF)}) > 0
               THEN pow(product(1e0 + rate), 252e0 / date_diff('day', MIN(date), {d(REF)})) - 1e0 ELSE 0e0 END
   FROM cdi WHERE date <= {d(REF)}) AS cdi_annualized
FROM cdi""", "cdi")


def _net(g: str, rate: str) -> str:
    return f"(CASE WHEN ({g}) IS NULL THEN NULL ELSE ((1e0 + ({g})) - greatest(((1e0 + ({g})) - 1e0) * ({rate}), 0e0)) - 1e0 END)"


cte("bench_net", "SELECT " + ", ".join(
    f"{_net(f'cdi_{l}', dbl(ST.cdi_ir_rate))} AS bn_{l}" for l in LABELS) + ", " + ", ".join(
    f"cdi_{l}" for l in WINDOWS) + " FROM bench", "bench")

cte("uq", f"""
SELECT q.fund_cnpj, q.subclass_id, q.date, q.nav FROM stg_quotes q
WHERE q.date >= {d(QUOTES_START)} AND q.date <= {d(REF)}
  AND EXISTS (SELECT 1 FROM universe u WHERE u.fund_cnpj = q.fund_cnpj AND u.subclass_id IS NOT DISTINCT FROM q.subclass_id)""",
    "stg_quotes", "universe")

cte("ri", """
SELECT * FROM (
  SELECT fund_cnpj, subclass_id, date, nav,
         nav / NULLIF(LAG(nav) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date), 0) - 1e0 AS return_daily
  FROM uq WHERE nav IS NOT NULL)
WHERE return_daily IS NOT NULL""", "uq")

cte("ri_lv", """
SELECT *, max(level) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
FROM (SELECT *, product(1e0 + return_daily) OVER (PARTITION BY fund_cnpj, subclass_id ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level,
             CAST(date_trunc('month', date) AS DATE) AS month
      FROM ri)""", "ri")

cte("fund_month", """
SELECT fund_cnpj, subclass_id, month, product(1e0 + return_daily) - 1e0 AS r_fund
FROM ri_lv GROUP BY fund_cnpj, subclass_id, month""", "ri_lv")

cte("cdi_month", """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, product(1e0 + rate) - 1e0 AS r_cdi FROM cdi GROUP BY 1""", "cdi")

cte("pct_months", """
SELECT f.fund_cnpj, f.subclass_id,
       AVG(CASE WHEN COALESCE(f.r_fund > c.r_cdi, FALSE) THEN 1e0 ELSE 0e0 END) AS pct_months_above_cdi
FROM fund_month f LEFT JOIN cdi_month c ON f.month = c.month
GROUP BY f.fund_cnpj, f.subclass_id""", "fund_month", "cdi_month")

_vs = ",\n".join(f"  arg_max(nav, date) FILTER (WHERE date <= {d(CUT[l])}) AS vs_{l}" for l in WINDOWS)
cte("agg", f"""
SELECT fund_cnpj, subclass_id,
  arg_max(nav, date) AS v_end, arg_min(nav, date) AS v_first, COUNT(*) AS n,
  AVG(return_daily) AS mean_r, STDDEV_SAMP(return_daily) AS std_r,
  MIN(level / NULLIF(peak, 0) - 1e0) AS mdd, MIN(date) AS first_date, MAX(date) AS last_date,
{_vs}
FROM ri_lv GROUP BY fund_cnpj, subclass_id""", "ri_lv")

cte("rf", """
SELECT a.fund_cnpj, a.subclass_id, AVG(c.rate) AS rf
FROM agg a JOIN cdi c ON c.date BETWEEN a.first_date AND a.last_date
GROUP BY a.fund_cnpj, a.subclass_id""", "agg", "cdi")


def _sharpe_sql(num: str) -> str:
    return (f"(CASE WHEN std_r IS NULL OR ({num}) IS NULL THEN NULL "
            f"WHEN std_r = 0 THEN CASE WHEN ({num}) > 0 THEN CAST('inf' AS DOUBLE) WHEN ({num}) < 0 THEN CAST('-inf' AS DOUBLE) END "
            f"ELSE ({num}) / std_r END) * sqrt(252e0)")


_ret = ",\n".join(f"  CASE WHEN vs_{l} > 0 THEN v_end / vs_{l} - 1e0 END AS return_{l}" for l in WINDOWS)
cte("fm", f"""
SELECT a.fund_cnpj, a.subclass_id,
{_ret},
  CASE WHEN n >= 2 AND v_first <> 0 THEN pow(v_end / v_first, 252e0 / n) - 1e0 END AS annualized_return,
  p.pct_months_above_cdi,
  std_r * sqrt(252e0) AS volatility,
  {_sharpe_sql('mean_r - r.rf')} AS sharpe_excess,
  {_sharpe_sql('mean_r')} AS sharpe_raw,
  CASE WHEN n >= 2 THEN mdd END AS max_drawdown,
  CAST(date_diff('day', first_date, last_date) AS INTEGER) AS span_days
FROM agg a
LEFT JOIN pct_months p ON a.fund_cnpj = p.fund_cnpj AND a.subclass_id IS NOT DISTINCT FROM p.subclass_id
LEFT JOIN rf r ON a.fund_cnpj = r.fund_cnpj AND a.subclass_id IS NOT DISTINCT FROM r.subclass_id""",
    "agg", "pct_months", "rf")

_tax_exact = " ".join(f"WHEN '{k}' THEN {dbl(v)}" for k, v in ST.rates_by_taxation.items())
_exempt = " OR ".join(f"upper(COALESCE(fund_name, '')) LIKE '%{kw}%'" for kw in ST.exempt_keywords)
cte("fm_meta", f"""
SELECT m.*, u.fund_name, u.target_investor, u.target_taxation, u.redemption_days, u.min_investment,
       COALESCE(CASE u.target_taxation {_tax_exact} END,
                CASE WHEN {_exempt.replace('fund_name', 'u.fund_name')} THEN 0e0 ELSE {dbl(ST.default_tax_rate)} END) AS ir_rate
FROM fm m LEFT JOIN universe u ON m.fund_cnpj = u.fund_cnpj AND m.subclass_id IS NOT DISTINCT FROM u.subclass_id""",
    "fm", "universe")

_gross_alpha = ",\n".join(f"  return_{l} - b.cdi_{l} AS alpha_{l}" for l in WINDOWS)
_net_ret = ",\n".join(
    f"  {_net(f'return_{l}' if l != 'annualized' else 'annualized_return', 'ir_rate')} AS return_{l}_net" for l in LABELS)
cte("fm_net", f"""
SELECT m.*, {_gross_alpha.strip()},
{_net_ret},
  b.* EXCLUDE ({', '.join(f'cdi_{l}' for l in WINDOWS)})
FROM fm_meta m CROSS JOIN bench_net b""", "fm_meta", "bench_net")

_alpha_net = ",\n".join(
    f"  {'COALESCE(' if l in ('24m', '36m') else ''}return_{l}_net - bn_{l}{', 0e0)' if l in ('24m', '36m') else ''} AS alpha_{l}_net"
    for l in LABELS)
_req = " AND ".join(f"{c} IS NOT NULL" for c in (
    "alpha_3m_net", "alpha_6m_net", "alpha_12m_net", "return_annualized_net", "sharpe_excess", "volatility",
    "max_drawdown", "pct_months_above_cdi"))
METRICS_COLS = (
    ["fund_cnpj", "subclass_id", "fund_name", "target_investor", "target_taxation", "redemption_days", "min_investment"]
    + [f"return_{l}" for l in WINDOWS] + [f"alpha_{l}" for l in WINDOWS] + ["annualized_return"]
    + [f"return_{l}_net" for l in WINDOWS] + ["return_annualized_net"]
    + [f"alpha_{l}_net" for l in WINDOWS] + ["alpha_annualized_net"]
    + ["pct_months_above_cdi", "volatility", "sharpe_excess", "sharpe_raw", "max_drawdown", "span_days",
       "ir_rate", "investor_level", "reference_date"]
)
cte("metrics", f"""
SELECT {', '.join(METRICS_COLS)} FROM (
  SELECT * EXCLUDE (redemption_days, min_investment),
    COALESCE(redemption_days, 100) AS redemption_days,
    COALESCE(min_investment, 10000e0) AS min_investment,
{_alpha_net},
    CAST(CASE WHEN lower(COALESCE(target_investor, '')) LIKE '%profissional%' THEN 2
              WHEN lower(COALESCE(target_investor, '')) LIKE '%qualificado%' THEN 1 ELSE 0 END AS INTEGER) AS investor_level,
    {d(REF)} AS reference_date
  FROM fm_net)
WHERE {_req}""", "fm_net")

# ----------------------------------------------------------------- rankings

FEATS = [c for c, _ in ST.cont_features]
_types = ", ".join(f"('{t}', {a})" for t, a in INVESTOR_ACCESS.items())
cte("eligible_seg", f"""
SELECT m.*, it.investor_type FROM metrics m
JOIN (VALUES {_types}) AS it(investor_type, access) ON m.investor_level <= it.access""", "metrics")


def _pct(c: str, asc: bool) -> str:
    w = f"PARTITION BY investor_type ORDER BY {c}"
    p = (f"((RANK() OVER ({w}) + COUNT(*) OVER ({w} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2e0)"
         f" / COUNT({c}) OVER (PARTITION BY investor_type)")
    return f"({p})" if asc else f"(1e0 - {p})"


cte("pct", "SELECT *, " + ", ".join(f"{_pct(c, a)} AS s_{c}" for c, a in ST.cont_features)
    + " FROM eligible_seg", "eligible_seg")


def _segments_values() -> str:
    rows = []
    for seg in ST.segments:
        w = ST.weights[seg.purpose][seg.profile]
        if seg.investor_type == "retail":
            scale = 1.0 - ST.accessibility_weight
            coef = [scale * wi for wi in w]
            acc = ST.accessibility_weight
        else:
            coef = [float(wi) for wi in w]
            acc = 0.0
        vals = [f"'{seg.purpose}'", f"'{seg.profile}'", f"'{seg.investor_type}'",
                dbl(ST.liquidity_lambda[seg.purpose]), dbl(acc)] + [dbl(c) for c in coef]
        rows.append("(" + ", ".join(vals) + ")")
    names = ["purpose", "profile", "investor_type", "liquidity_lambda", "c_accessibility"] + [f"c{i}" for i in range(12)]
    return f"(VALUES {', '.join(rows)}) AS sg({', '.join(names)})"


_parts = [f"s_{c}" for c in FEATS] + ["s_span", "s_liquidity"]
_score = "0e0" + "".join(f" + c{i} * {p}" for i, p in enumerate(_parts)) + " + c_accessibility * s_accessibility"
cte("scored", f"""
SELECT *, {_score} AS score FROM (
  SELECT p.*, sg.purpose, sg.profile, sg.liquidity_lambda, sg.c_accessibility, {', '.join(f'sg.c{i}' for i in range(12))},
         1e0 - exp({dbl(-ST.span_lambda)} * p.span_days / 365e0) AS s_span,
         exp(-sg.liquidity_lambda * p.redemption_days) AS s_liquidity,
         exp(-p.min_investment / {dbl(ST.accessibility_scale)}) AS s_accessibility
  FROM pct p JOIN {_segments_values()} ON p.investor_type = sg.investor_type)""", "pct")

RANKING_COLS = [
    "fund_cnpj", "subclass_id", "fund_name", "purpose", "profile", "investor_type", "rank", "score",
    "investor_level", "ir_rate", "alpha_12m_net", "alpha_3m_net", "alpha_6m_net", "return_annualized_net",
    "return_12m_net", "sharpe_excess", "pct_months_above_cdi", "max_drawdown", "volatility", "span_days",
    "redemption_days", "min_investment",
] + [f"s_{c}" for c in FEATS] + ["s_span", "s_liquidity", "s_accessibility"]

cte("rankings", f"""
SELECT {', '.join(c for c in RANKING_COLS if c != 'rank')},
       CAST(RANK() OVER (PARTITION BY purpose, profile, investor_type ORDER BY score DESC NULLS LAST) AS INTEGER) AS rank,
       {d(REF)} AS reference_date
FROM scored""", "scored")
