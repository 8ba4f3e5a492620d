"""DuckDB text for the three gates: one SELECT per rule instance, UNION ALL.

Values are rendered like the Spark side: counts and dates as text, shares as
'12.3%' (ties to even), unknown category lists sorted and comma-joined.
"""

from __future__ import annotations

from datetime import timedelta

from tidemark.plans import gates as G

from .sql import QUOTES_START, REF, ST, compose, cte, d

REFD = d(REF)


def _pct(x: str) -> str:
    return f"printf('%.1f%%', round_even(({x}) * 100e0, 1))"


def row(name: str, sev: str, passed: str, value: str, threshold: str | None, src: str) -> str:
    thr = "NULL" if threshold is None else "'" + threshold.replace("'", "''") + "'"
    return (f"SELECT '{name}' AS check_name, '{sev}' AS severity, COALESCE({passed}, FALSE) AS passed, "
            f"CAST({value} AS VARCHAR) AS value, CAST({thr} AS VARCHAR) AS threshold FROM {src}")


def slice_of(t: str) -> str:
    return f"(SELECT * FROM {t} WHERE reference_date = (SELECT MAX(reference_date) FROM {t} WHERE reference_date <= {REFD}))"


def snap_exists(name: str, t: str) -> str:
    s = f"(SELECT MAX(reference_date) AS s FROM {t} WHERE reference_date <= {REFD})"
    return row(name, "error", "s IS NOT NULL", "CAST(s AS VARCHAR)", f"<= {REF.isoformat()}", s)


def rc(name: str, src: str) -> str:
    return row(name, "error", "n > 0", "n", "> 0", f"(SELECT COUNT(*) AS n FROM {src})")


def nn(name: str, col: str, src: str, sev: str = "error") -> str:
    return row(name, sev, "n = 0", "n", "0", f"(SELECT COUNT(*) FILTER (WHERE {col} IS NULL) AS n FROM {src})")


def fresh(name: str, col: str, src: str, lag: int = 7) -> str:
    cut = REF - timedelta(days=lag)
    return row(name, "warning", f"mx >= {d(cut)}", "CAST(mx AS VARCHAR)", f">= {cut.isoformat()}",
               f"(SELECT MAX(CAST({col} AS DATE)) AS mx FROM {src})")


def nr(name: str, col: str, bound: float, sev: str, thr: str, src: str, inclusive: bool = False) -> str:
    op = "<=" if inclusive else "<"
    return row(name, sev, f"r {op} {bound!r}", _pct("r"), thr,
               f"(SELECT COALESCE(AVG(CASE WHEN {col} IS NULL THEN 1e0 ELSE 0e0 END), 0e0) AS r FROM {src})")


def cw(name: str, cond: str, sev: str, src: str, thr: str = "0") -> str:
    return row(name, sev, "n = 0", "n", thr, f"(SELECT COUNT(*) FILTER (WHERE COALESCE({cond}, FALSE)) AS n FROM {src})")


def pk(name: str, cols: list[str], src: str) -> str:
    c = ", ".join(cols)
    return row(name, "error", "n = 0", "n", "0",
               f"(SELECT COUNT(*) FILTER (WHERE k > 1) AS n FROM (SELECT {c}, COUNT(*) AS k FROM {src} GROUP BY {c}))")


def kv(name: str, col: str, known: set[str], src: str) -> str:
    lst = ", ".join("'" + k.replace("'", "''") + "'" for k in sorted(known))
    u = (f"(SELECT list_sort(list_distinct(list(CAST({col} AS VARCHAR)) FILTER (WHERE {col} IS NOT NULL "
         f"AND CAST({col} AS VARCHAR) NOT IN ({lst})))) AS u FROM {src})")
    return row(name, "warning", "COALESCE(len(u), 0) = 0",
               "CASE WHEN COALESCE(len(u), 0) > 0 THEN array_to_string(u, ', ') END",
               "subset of {" + ", ".join(sorted(known)) + "}", u)


def cov(name: str, col: str, src: str, start) -> str:
    return row(name, "warning", f"mn <= {d(start)}", "CAST(mn AS VARCHAR)", f"<= {start.isoformat()}",
               f"(SELECT MIN(CAST({col} AS DATE)) AS mn FROM {src})")


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _ctx(task: str, dataset: str, body: str) -> str:
    return (f"SELECT {REFD} AS reference_date, '{task}' AS task, '{dataset}' AS dataset, "
            f"check_name, severity, passed, value, threshold FROM (\n{body}\n)")


# ------------------------------------------------------------------ inputs stamped with the run's snapshot date

for _n, _src in [("raw_registro_classe", "fx_registro_classe"), ("raw_registro_subclasse", "fx_registro_subclasse"),
                 ("raw_taxa_adm", "fx_taxa_adm"), ("raw_taxa_perfm", "fx_taxa_perfm"), ("raw_extrato", "fx_extrato"),
                 ("raw_anbima", "fx_anbima"), ("snap_registry", "stg_registry"), ("snap_fees", "stg_fees"),
                 ("snap_anbima", "stg_anbima")]:
    cte(_n, f"SELECT *, {REFD} AS reference_date FROM {_src}", _src)

_digits = "length(regexp_replace(CAST(CNPJ_Classe AS VARCHAR), '[^0-9]', '', 'g'))"

cte("ingestion_results", _ctx("validate_ingestion", "raw", union([
    rc("inf_diario_row_count", "fx_inf_diario"),
    fresh("inf_diario_date_freshness", "DT_COMPTC", "fx_inf_diario"),
    nr("inf_diario_nav_not_fully_null", "VL_QUOTA", 0.5, "error", "< 50%", "fx_inf_diario"),
    nr("inf_diario_aum_null_rate", "VL_PATRIM_LIQ", 0.5, "warning", "< 50%", "fx_inf_diario"),
    nr("inf_diario_shareholders_null_rate", "NR_COTST", 0.5, "warning", "< 50%", "fx_inf_diario"),
    rc("cdi_daily_row_count", "fx_cdi"),
    fresh("cdi_daily_date_freshness", "date", "fx_cdi"),
    cw("cdi_daily_rate_not_negative", "rate < 0", "error", "fx_cdi"),
    cw("cdi_daily_rate_in_daily_range", "rate >= 0.01", "warning", "fx_cdi", "0 rows with rate >= 0.01"),
    snap_exists("registro_classe_snapshot_exists", "raw_registro_classe"),
    rc("registro_classe_row_count", slice_of("raw_registro_classe")),
    nn("registro_classe_id_not_null", "ID_Registro_Classe", slice_of("raw_registro_classe")),
    cw("registro_classe_cnpj_numeric_le14", f"{_digits} > 14", "error", slice_of("raw_registro_classe")),
    row("registro_classe_renda_fixa_coverage", "warning", f"n >= {G.FIXED_INCOME_MIN_CLASSES}", "n",
        f">= {G.FIXED_INCOME_MIN_CLASSES}",
        f"(SELECT COUNT(*) FILTER (WHERE COALESCE(starts_with(Classificacao_Anbima, 'Renda Fixa'), FALSE)) AS n "
        f"FROM {slice_of('raw_registro_classe')})"),
    nr("registro_classe_inception_date_null_rate", "Data_Inicio", 0.05, "warning", "< 5%", slice_of("raw_registro_classe")),
    kv("registro_classe_situacao_known", "Situacao", G.KNOWN_SITUACAO, slice_of("raw_registro_classe")),
    kv("registro_classe_exclusivo_yn", "Exclusivo", G.KNOWN_YN, slice_of("raw_registro_classe")),
    kv("registro_classe_forma_condominio_known", "Forma_Condominio", G.KNOWN_FORMA_CONDOMINIO, slice_of("raw_registro_classe")),
    snap_exists("registro_subclasse_snapshot_exists", "raw_registro_subclasse"),
    rc("registro_subclasse_row_count", slice_of("raw_registro_subclasse")),
    nn("registro_subclasse_merge_key_not_null", "ID_Registro_Classe", slice_of("raw_registro_subclasse")),
    nn("registro_subclasse_id_not_null", "ID_Subclasse", slice_of("raw_registro_subclasse"), "warning"),
    row("registro_subclasse_referential_integrity", "warning", "share >= 0.95", _pct("share"), ">= 95%",
        f"(SELECT COALESCE(AVG(CASE WHEN c.k IS NOT NULL THEN 1e0 ELSE 0e0 END), 1e0) AS share "
        f"FROM {slice_of('raw_registro_subclasse')} s "
        f"LEFT JOIN (SELECT DISTINCT ID_Registro_Classe AS k FROM {slice_of('raw_registro_classe')}) c "
        f"ON s.ID_Registro_Classe = c.k WHERE s.ID_Registro_Classe IS NOT NULL)"),
    kv("registro_subclasse_previdenciario_yn", "Previdenciario", G.KNOWN_YN, slice_of("raw_registro_subclasse")),
    snap_exists("taxa_adm_snapshot_exists", "raw_taxa_adm"),
    rc("taxa_adm_row_count", slice_of("raw_taxa_adm")),
    cw("taxa_adm_no_ambiguous_values", "TRY_CAST(TAXA_ADM AS DOUBLE) > 5 AND TRY_CAST(TAXA_ADM AS DOUBLE) < 20", "warning", slice_of("raw_taxa_adm")),
    snap_exists("taxa_perfm_snapshot_exists", "raw_taxa_perfm"),
    rc("taxa_perfm_row_count", slice_of("raw_taxa_perfm")),
    snap_exists("extrato_fi_snapshot_exists", "raw_extrato"),
    rc("extrato_fi_row_count", slice_of("raw_extrato")),
    kv("extrato_fi_existe_taxa_perfm_yn", "EXISTE_TAXA_PERFM", G.KNOWN_YN, slice_of("raw_extrato")),
    snap_exists("anbima_snapshot_exists", "raw_anbima"),
    rc("anbima_row_count", slice_of("raw_anbima")),
    kv("anbima_estrutura_known", "Estrutura", G.KNOWN_ESTRUTURA, slice_of("raw_anbima")),
    kv("anbima_tributacao_alvo_known", "Tributacao_Alvo", G.KNOWN_TRIBUTACAO_ALVO, slice_of("raw_anbima")),
    # schema rule: the characteristics view lacks Categoria_Anbima and Tipo_De_Investidor
    row("anbima_required_columns_present", "error", "n = 0", "NULL", "all required columns present",
        "(SELECT COUNT(Cnpj_Da_Classe || Estrutura || Categoria_Anbima || Tipo_De_Investidor || Tributacao_Alvo || "
        "Codigo_Cvm_Subclasse) FILTER (WHERE FALSE) AS n FROM raw_anbima)"),
])), "fx_inf_diario", "fx_cdi", "raw_registro_classe", "raw_registro_subclasse", "raw_taxa_adm", "raw_taxa_perfm",
    "raw_extrato", "raw_anbima")

cte("staging_results", _ctx("validate_staging", "staging", union([
    snap_exists("registry_snapshot_exists", "snap_registry"),
    fresh("registry_snapshot_freshness", "reference_date", "snap_registry", 14),
    rc("registry_row_count", slice_of("snap_registry")),
    nn("registry_fund_cnpj_not_null", "fund_cnpj", slice_of("snap_registry")),
    nn("registry_fund_name_not_null", "fund_name", slice_of("snap_registry"), "warning"),
    nn("registry_inception_date_not_null", "inception_date", slice_of("snap_registry"), "warning"),
    pk("registry_pk_unique", ["fund_cnpj", "subclass_id"], slice_of("snap_registry")),
    rc("daily_quotes_row_count", "stg_quotes"),
    fresh("daily_quotes_date_freshness", "date", "stg_quotes"),
    nn("daily_quotes_fund_cnpj_not_null", "fund_cnpj", "stg_quotes"),
    cov("daily_quotes_window_coverage", "date", "stg_quotes", QUOTES_START),
    nr("daily_quotes_nav_null_rate", "nav", 0.5, "error", "< 50%", "stg_quotes"),
    nr("daily_quotes_aum_null_rate", "aum", 0.5, "warning", "< 50%", "stg_quotes"),
    nr("daily_quotes_shareholders_null_rate", "shareholders", 0.5, "warning", "< 50%", "stg_quotes"),
    cw("daily_quotes_nav_outliers", "nav > 1e9", "warning", "stg_quotes"),
    cw("daily_quotes_aum_outliers", "aum > 1e12", "warning", "stg_quotes"),
    cw("daily_quotes_shareholders_outliers", "shareholders < 0", "warning", "stg_quotes"),
    pk("daily_quotes_pk_unique", ["fund_cnpj", "subclass_id", "date"], "stg_quotes"),
    snap_exists("fees_snapshot_exists", "snap_fees"),
    fresh("fees_snapshot_freshness", "reference_date", "snap_fees", 14),
    rc("fees_row_count", slice_of("snap_fees")),
    nn("fees_fund_cnpj_not_null", "fund_cnpj", slice_of("snap_fees")),
    cw("fees_adm_fee_not_negative", "adm_fee < 0", "warning", slice_of("snap_fees")),
    pk("fees_fund_cnpj_unique", ["fund_cnpj"], slice_of("snap_fees")),
    rc("cdi_rates_row_count", "fx_cdi"),
    fresh("cdi_rates_date_freshness", "date", "fx_cdi"),
    cov("cdi_rates_window_coverage", "date", "fx_cdi", QUOTES_START),
    cw("cdi_rates_rate_not_negative", "rate < 0", "error", "fx_cdi"),
    row("cdi_rates_no_large_gaps", "warning", "mg <= 10", "mg", "<= 10 days",
        "(SELECT MAX(date_diff('day', p, dt)) AS mg FROM (SELECT dt, LAG(dt) OVER (ORDER BY dt) AS p "
        "FROM (SELECT DISTINCT CAST(date AS DATE) AS dt FROM fx_cdi WHERE date IS NOT NULL)))"),
    snap_exists("anbima_staging_snapshot_exists", "snap_anbima"),
    fresh("anbima_staging_snapshot_freshness", "reference_date", "snap_anbima", 14),
    rc("anbima_staging_row_count", slice_of("snap_anbima")),
    nn("anbima_fund_cnpj_not_null", "fund_cnpj", slice_of("snap_anbima")),
    nr("anbima_redemption_days_null_rate", "redemption_days", 0.5, "warning", "< 50%", slice_of("snap_anbima")),
    pk("anbima_pk_unique", ["fund_cnpj", "subclass_id"], slice_of("snap_anbima")),
])), "snap_registry", "stg_quotes", "snap_fees", "fx_cdi", "snap_anbima")

_combos = ", ".join(f"('{s.purpose}', '{s.profile}', '{s.investor_type}')" for s in ST.segments)
cte("marts_results", _ctx("validate_marts", "marts", union([
    snap_exists("universe_snapshot_exists", "universe"),
    rc("universe_row_count", slice_of("universe")),
    nn("universe_fund_cnpj_not_null", "fund_cnpj", slice_of("universe")),
    *[nr(f"universe_{c}_null_rate", c, 0.05, "warning", "<= 5%", slice_of("universe"), inclusive=True)
      for c in ("target_taxation", "redemption_days", "min_investment")],
    pk("universe_pk_unique", ["fund_cnpj", "subclass_id"], slice_of("universe")),
    snap_exists("metrics_snapshot_exists", "metrics"),
    rc("metrics_row_count", slice_of("metrics")),
    nn("metrics_fund_cnpj_not_null", "fund_cnpj", slice_of("metrics")),
    nn("metrics_ir_rate_not_null", "ir_rate", slice_of("metrics")),
    row("metrics_fund_count_reasonable", "warning", f"n >= {G.METRICS_MIN_FUNDS}", "n", f">= {G.METRICS_MIN_FUNDS} distinct funds",
        f"(SELECT COUNT(DISTINCT fund_cnpj) AS n FROM {slice_of('metrics')})"),
    cw("metrics_ir_rate_in_range", "ir_rate < 0 OR ir_rate > 1", "warning", slice_of("metrics")),
    cw("metrics_investor_level_valid", "investor_level IS NULL OR investor_level NOT IN (0, 1, 2)", "warning", slice_of("metrics")),
    cw("metrics_no_negative_volatility", "volatility < 0", "error", slice_of("metrics")),
    cw("metrics_max_drawdown_sign", "max_drawdown > 0", "error", slice_of("metrics")),
    cw("metrics_pct_months_in_range", "pct_months_above_cdi < 0 OR pct_months_above_cdi > 1", "error", slice_of("metrics")),
    cw("metrics_return_12m_bounds", "return_12m IS NOT NULL AND (return_12m < -0.9 OR return_12m > 1.0)",
       "warning", slice_of("metrics"), "0 outside (-90%, +100%)"),
    cw("metrics_alpha_12m_net_extreme", "alpha_12m_net IS NOT NULL AND abs(alpha_12m_net) > 0.3",
       "warning", slice_of("metrics"), "0 with |alpha| > 30pp"),
    cw("metrics_volatility_bounds", "volatility IS NOT NULL AND volatility > 5", "warning", slice_of("metrics"),
       "0 with vol > 500%"),
    cw("metrics_sharpe_not_extreme", "sharpe_excess IS NOT NULL AND abs(sharpe_excess) > 100", "warning",
       slice_of("metrics"), "0 with |Sharpe| > 100"),
    pk("metrics_pk_unique", ["fund_cnpj", "subclass_id"], slice_of("metrics")),
    snap_exists("rankings_snapshot_exists", "rankings"),
    rc("rankings_row_count", slice_of("rankings")),
    cw("rankings_score_in_range", "score < 0 OR score > 1", "warning", slice_of("rankings")),
    pk("rankings_pk_unique", ["fund_cnpj", "subclass_id", "purpose", "profile", "investor_type"], slice_of("rankings")),
    row("rankings_combo_coverage", "warning", f"n = {len(ST.segments)}", f"CAST(n AS VARCHAR) || '/{len(ST.segments)}'",
        f"all {len(ST.segments)} combos present",
        f"(SELECT COUNT(*) AS n FROM (VALUES {_combos}) AS e(purpose, profile, investor_type) WHERE EXISTS "
        f"(SELECT 1 FROM {slice_of('rankings')} r WHERE r.purpose = e.purpose AND r.profile = e.profile "
        f"AND r.investor_type = e.investor_type))"),
])), "universe", "metrics", "rankings")

cte("all_results", "SELECT * FROM ingestion_results UNION ALL SELECT * FROM staging_results UNION ALL SELECT * FROM marts_results",
    "ingestion_results", "staging_results", "marts_results")

GATE_COLS = "reference_date, task, dataset, check_name, severity, passed, value, threshold"
GATES = {
    "ingestion_gate": compose(f"SELECT {GATE_COLS} FROM ingestion_results", "ingestion_results"),
    "staging_gate": compose(f"SELECT {GATE_COLS} FROM staging_results", "staging_results"),
    "marts_gate": compose(f"SELECT {GATE_COLS} FROM marts_results", "marts_results"),
    "check_summary": compose("""
SELECT reference_date, task, dataset, COUNT(*) AS total, COUNT(*) FILTER (WHERE passed) AS passed,
       COUNT(*) FILTER (WHERE NOT passed) AS failed,
       COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS errors,
       COUNT(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings
FROM all_results GROUP BY reference_date, task, dataset""", "all_results"),
    "ordered_detail": compose("""
SELECT check_name, severity, passed, value, threshold FROM all_results WHERE task = 'validate_staging'""", "all_results"),
    "log_detail": compose("""
SELECT check_name, severity, passed, value, threshold, '2001-07-01 18:30:00' AS logged_at FROM staging_results""", "staging_results"),
    "log_summary": compose("""
SELECT reference_date, task, dataset, COUNT(*) AS total, COUNT(*) FILTER (WHERE passed) AS passed, COUNT(*) FILTER (WHERE NOT passed) AS failed,
       COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS errors,
       COUNT(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings, max(logged) AS last_logged_at
FROM staging_results, (VALUES ('2001-07-01 06:00:00'), ('2001-07-01 18:30:00'), ('2001-07-02 06:00:00')) AS l(logged)
WHERE logged < '2001-07-02' OR NOT contains(check_name, 'row_count')
GROUP BY reference_date, task, dataset""", "staging_results"),
    "logged_dates": "SELECT unnest([DATE '2001-07-01', DATE '2001-07-02']) AS logged_date",
}
