"""The three validation gates (ingestion, staging, marts): 99 rule instances.

Each table's aggregate rules run as one pass; key, set, gap and schema rules
run on their own. ``*_checks`` return the result DataFrame (with task and
dataset); ``checks.gate`` writes it to the log and raises on failed errors.
"""

from __future__ import annotations

from datetime import date
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import checks as V
from ..settings import Settings

# Known categories accepted by the ingestion checks.
KNOWN_SITUACAO = {
    "Em Funcionamento Normal",
    "Em Liquidação",
    "Cancelado",
    "Fase Pré-Operacional",
    "Em Processo de Transformação",
}
KNOWN_YN = {"S", "N"}
KNOWN_FORMA_CONDOMINIO = {"Aberto", "Fechado"}
KNOWN_ESTRUTURA = {"Classe", "Subclasse"}
CHARACTERISTICS_REQUIRED_COLUMNS = {
    "Cnpj_Da_Classe",
    "Estrutura",
    "Categoria_Anbima",
    "Tipo_De_Investidor",
    "Tributacao_Alvo",
    "Codigo_Cvm_Subclasse",
}
KNOWN_TRIBUTACAO_ALVO = {
    "Longo Prazo",
    "Isento",
    "Curto Prazo",
    "Alíquota de 15%",
    "Previdenciário",
    "Outros",
    "Não Aplicável",
    "Especifica",
    "Indefinido",
}
FIXED_INCOME_MIN_CLASSES = 1000
METRICS_MIN_FUNDS = 50


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _snapshot_block(spark: SparkSession, table: DataFrame, ref: date, prefix: str, label: str,
                    freshness_days: int | None):
    """snapshot_exists (+ freshness on reference_date) for a snapshot table; returns the
    as-of slice and its snapshot date as a scalar-subquery column (all lazy)."""
    sl, snap = V.as_of_slice_lazy(table, ref)
    parts = [V.snapshot_exists(spark, f"{prefix}_snapshot_exists", snap, ref, label)]
    if freshness_days is not None:
        parts.append(V.evaluate(table, [V.freshness(f"{prefix}_snapshot_freshness", "reference_date", ref, label, freshness_days)]))
    return sl, snap, parts


# ------------------------------------------------------------------ ingestion (37)


def ingestion_checks(raw: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Checks on the raw layer. Snapshot tables carry ``reference_date``."""
    ref = settings.reference_date
    spark = raw["inf_diario"].sparkSession
    parts: list[DataFrame] = []

    q = raw["inf_diario"]
    parts.append(V.evaluate(q, [
        V.row_count("inf_diario_row_count", "raw.inf_diario"),
        V.freshness("inf_diario_date_freshness", "DT_COMPTC", ref, "raw.inf_diario"),
        V.null_rate("inf_diario_nav_not_fully_null", "VL_QUOTA", 0.5, "error", "< 50%"),
        V.null_rate("inf_diario_aum_null_rate", "VL_PATRIM_LIQ", 0.5, "warning", "< 50%"),
        V.null_rate("inf_diario_shareholders_null_rate", "NR_COTST", 0.5, "warning", "< 50%"),
    ]))
    c = raw["cdi_daily"]
    parts.append(V.evaluate(c, [
        V.row_count("cdi_daily_row_count", "raw.cdi_daily"),
        V.freshness("cdi_daily_date_freshness", "date", ref, "raw.cdi_daily"),
        V.count_where("cdi_daily_rate_not_negative", F.col("rate") < 0, "error"),
        V.count_where("cdi_daily_rate_in_daily_range", F.col("rate") >= 0.01, "warning", "0 rows with rate >= 0.01"),
    ]))

    cls, snap_c, p = _snapshot_block(spark, raw["registro_classe"], ref, "registro_classe", "raw.registro_classe", None)
    parts += p
    rules = [
        V.row_count("registro_classe_row_count", "raw.registro_classe"),
        V.no_nulls("registro_classe_id_not_null", "ID_Registro_Classe", "raw.registro_classe"),
        V.count_where("registro_classe_cnpj_numeric_le14", X.digit_count(F.col("CNPJ_Classe")) > 14, "error"),
        V.min_count("registro_classe_renda_fixa_coverage",
                    F.count_if(F.coalesce(F.col("Classificacao_Anbima").startswith("Renda Fixa"), F.lit(False))),
                    FIXED_INCOME_MIN_CLASSES, "warning", f">= {FIXED_INCOME_MIN_CLASSES}"),
        V.null_rate("registro_classe_inception_date_null_rate", "Data_Inicio", 0.05, "warning", "< 5%", requires=snap_c),
    ]
    parts.append(V.evaluate(cls, rules))
    parts.append(V.known_values(cls, "registro_classe_situacao_known", "Situacao", KNOWN_SITUACAO, "raw.registro_classe"))
    parts.append(V.known_values(cls, "registro_classe_exclusivo_yn", "Exclusivo", KNOWN_YN, "raw.registro_classe"))
    parts.append(V.known_values(cls, "registro_classe_forma_condominio_known", "Forma_Condominio", KNOWN_FORMA_CONDOMINIO,
                                "raw.registro_classe"))

    sub, snap_s, p = _snapshot_block(spark, raw["registro_subclasse"], ref, "registro_subclasse", "raw.registro_subclasse", None)
    parts += p
    parts.append(V.evaluate(sub, [
        V.row_count("registro_subclasse_row_count", "raw.registro_subclasse"),
        V.no_nulls("registro_subclasse_merge_key_not_null", "ID_Registro_Classe", "raw.registro_subclasse"),
        V.no_nulls("registro_subclasse_id_not_null", "ID_Subclasse", "raw.registro_subclasse", "warning"),
    ]))
    both = F.when(snap_s.isNotNull() & snap_c.isNotNull(), F.lit(1))
    parts.append(V.referential(sub.where(F.col("ID_Registro_Classe").isNotNull()), cls,
                               "registro_subclasse_referential_integrity", "ID_Registro_Classe", 0.95,
                               "raw.registro_subclasse", requires=both))
    parts.append(V.known_values(sub, "registro_subclasse_previdenciario_yn", "Previdenciario", KNOWN_YN, "raw.registro_subclasse"))

    adm, _, p = _snapshot_block(spark, raw["taxa_adm"], ref, "taxa_adm", "raw.cad_fi_hist_taxa_adm", None)
    parts += p
    parts.append(V.evaluate(adm, [
        V.row_count("taxa_adm_row_count", "raw.cad_fi_hist_taxa_adm"),
        V.count_where("taxa_adm_no_ambiguous_values", X.to_number_or_null(F.col("TAXA_ADM")).between(5, 20) & ~X.to_number_or_null(F.col("TAXA_ADM")).isin(5.0, 20.0), "warning"),
    ]))
    perf, _, p = _snapshot_block(spark, raw["taxa_perfm"], ref, "taxa_perfm", "raw.cad_fi_hist_taxa_perfm", None)
    parts += p
    parts.append(V.evaluate(perf, [V.row_count("taxa_perfm_row_count", "raw.cad_fi_hist_taxa_perfm")]))
    ext, _, p = _snapshot_block(spark, raw["extrato_fi"], ref, "extrato_fi", "raw.extrato_fi", None)
    parts += p
    parts.append(V.evaluate(ext, [V.row_count("extrato_fi_row_count", "raw.extrato_fi")]))
    parts.append(V.known_values(ext, "extrato_fi_existe_taxa_perfm_yn", "EXISTE_TAXA_PERFM", KNOWN_YN, "raw.extrato_fi"))

    anb, _, p = _snapshot_block(spark, raw["anbima"], ref, "anbima", "raw.anbima_caracteristicas", None)
    parts += p
    parts.append(V.evaluate(anb, [V.row_count("anbima_row_count", "raw.anbima_caracteristicas")]))
    parts.append(V.known_values(anb, "anbima_estrutura_known", "Estrutura", KNOWN_ESTRUTURA, "raw.anbima_caracteristicas"))
    parts.append(V.known_values(anb, "anbima_tributacao_alvo_known", "Tributacao_Alvo", KNOWN_TRIBUTACAO_ALVO,
                                "raw.anbima_caracteristicas"))
    parts.append(V.required_columns(spark, raw["anbima"].columns, "anbima_required_columns_present",
                                    CHARACTERISTICS_REQUIRED_COLUMNS))
    return V.with_context(_union(parts), "validate_ingestion", "raw", ref)


# ------------------------------------------------------------------ staging (35)


def staging_checks(stg: Mapping[str, DataFrame], settings: Settings, quotes_start: date | None) -> DataFrame:
    """Checks on the staging layer. registry / fees / anbima carry ``reference_date``."""
    ref = settings.reference_date
    spark = stg["daily_quotes"].sparkSession
    parts: list[DataFrame] = []

    reg, _, p = _snapshot_block(spark, stg["registry"], ref, "registry", "staging.registry", 14)
    parts += p
    parts.append(V.evaluate(reg, [
        V.row_count("registry_row_count", "staging.registry"),
        V.no_nulls("registry_fund_cnpj_not_null", "fund_cnpj", "staging.registry"),
        V.no_nulls("registry_fund_name_not_null", "fund_name", "staging.registry", "warning"),
        V.no_nulls("registry_inception_date_not_null", "inception_date", "staging.registry", "warning"),
    ]))
    parts.append(V.pk_unique(reg, "registry_pk_unique", ["fund_cnpj", "subclass_id"], "staging.registry"))

    q = stg["daily_quotes"]
    parts.append(V.evaluate(q, [
        V.row_count("daily_quotes_row_count", "staging.daily_quotes"),
        V.freshness("daily_quotes_date_freshness", "date", ref, "staging.daily_quotes"),
        V.no_nulls("daily_quotes_fund_cnpj_not_null", "fund_cnpj", "staging.daily_quotes"),
        V.window_coverage("daily_quotes_window_coverage", "date", quotes_start, "staging.daily_quotes"),
        V.null_rate("daily_quotes_nav_null_rate", "nav", 0.5, "error", "< 50%"),
        V.null_rate("daily_quotes_aum_null_rate", "aum", 0.5, "warning", "< 50%"),
        V.null_rate("daily_quotes_shareholders_null_rate", "shareholders", 0.5, "warning", "< 50%"),
        V.count_where("daily_quotes_nav_outliers", F.col("nav") > 1e9, "warning", what="rows with nav > 1e9"),
        V.count_where("daily_quotes_aum_outliers", F.col("aum") > 1e12, "warning", what="rows with aum > 1e12"),
        V.count_where("daily_quotes_shareholders_outliers", F.col("shareholders") < 0, "warning",
                      what="rows with negative shareholders"),
    ]))
    parts.append(V.pk_unique(q, "daily_quotes_pk_unique", ["fund_cnpj", "subclass_id", "date"], "staging.daily_quotes"))

    fees, _, p = _snapshot_block(spark, stg["fees"], ref, "fees", "staging.fees", 14)
    parts += p
    parts.append(V.evaluate(fees, [
        V.row_count("fees_row_count", "staging.fees"),
        V.no_nulls("fees_fund_cnpj_not_null", "fund_cnpj", "staging.fees"),
        V.count_where("fees_adm_fee_not_negative", F.col("adm_fee") < 0, "warning", what="negative adm_fee"),
    ]))
    parts.append(V.pk_unique(fees, "fees_fund_cnpj_unique", ["fund_cnpj"], "staging.fees"))

    c = stg["cdi_rates"]
    parts.append(V.evaluate(c, [
        V.row_count("cdi_rates_row_count", "staging.cdi_rates"),
        V.freshness("cdi_rates_date_freshness", "date", ref, "staging.cdi_rates"),
        V.window_coverage("cdi_rates_window_coverage", "date", quotes_start, "staging.cdi_rates"),
        V.count_where("cdi_rates_rate_not_negative", F.col("rate") < 0, "error", what="negative rates"),
    ]))
    parts.append(V.max_gap(c, "cdi_rates_no_large_gaps", "date", 10, "staging.cdi_rates"))

    anb, snap_a, p = _snapshot_block(spark, stg["anbima"], ref, "anbima_staging", "staging.anbima", 14)
    parts += p
    parts.append(V.evaluate(anb, [
        V.row_count("anbima_staging_row_count", "staging.anbima"),
        V.no_nulls("anbima_fund_cnpj_not_null", "fund_cnpj", "staging.anbima"),
        V.null_rate("anbima_redemption_days_null_rate", "redemption_days", 0.5, "warning", "< 50%", requires=snap_a),
    ]))
    parts.append(V.pk_unique(anb, "anbima_pk_unique", ["fund_cnpj", "subclass_id"], "staging.anbima"))
    return V.with_context(_union(parts), "validate_staging", "staging", ref)


# ------------------------------------------------------------------ marts (27)


def marts_checks(marts: Mapping[str, DataFrame], settings: Settings, check_combos: bool = True) -> DataFrame:
    ref = settings.reference_date
    spark = marts["universe"].sparkSession
    parts: list[DataFrame] = []

    u, _, p = _snapshot_block(spark, marts["universe"], ref, "universe", "marts.universe", None)
    parts += p
    parts.append(V.evaluate(u, [
        V.row_count("universe_row_count", "marts.universe"),
        V.no_nulls("universe_fund_cnpj_not_null", "fund_cnpj", "marts.universe"),
        *[V.null_rate(f"universe_{c}_null_rate", c, 0.05, "warning", "<= 5%", inclusive=True)
          for c in ("target_taxation", "redemption_days", "min_investment")],
    ]))
    parts.append(V.pk_unique(u, "universe_pk_unique", ["fund_cnpj", "subclass_id"], "marts.universe"))

    m_all = marts["metrics"]
    m, _, p = _snapshot_block(spark, m_all, ref, "metrics", "marts.metrics", None)
    parts += p
    parts.append(V.evaluate(m, [
        V.row_count("metrics_row_count", "marts.metrics"),
        V.no_nulls("metrics_fund_cnpj_not_null", "fund_cnpj", "marts.metrics"),
        V.no_nulls("metrics_ir_rate_not_null", "ir_rate", "marts.metrics"),
    ]))
    parts.append(V.evaluate(m, [
        V.min_count("metrics_fund_count_reasonable", F.count_distinct("fund_cnpj"),
                    METRICS_MIN_FUNDS, "warning", f">= {METRICS_MIN_FUNDS} distinct funds"),
        V.count_where("metrics_ir_rate_in_range", ((F.col("ir_rate") < 0) | (F.col("ir_rate") > 1)), "warning"),
        V.count_where("metrics_investor_level_valid",
                      (F.col("investor_level").isNull() | ~F.col("investor_level").isin(0, 1, 2)), "warning"),
        V.count_where("metrics_no_negative_volatility", (F.col("volatility") < 0), "error"),
        V.count_where("metrics_max_drawdown_sign", (F.col("max_drawdown") > 0), "error"),
        V.count_where("metrics_pct_months_in_range",
                      ((F.col("pct_months_above_cdi") < 0) | (F.col("pct_months_above_cdi") > 1)), "error"),
        V.count_where("metrics_return_12m_bounds",
                      (F.col("return_12m").isNotNull() & ((F.col("return_12m") < -0.9) | (F.col("return_12m") > 1.0))),
                      "warning", "0 outside (-90%, +100%)"),
        V.count_where("metrics_alpha_12m_net_extreme",
                      (F.col("alpha_12m_net").isNotNull() & (F.abs(F.col("alpha_12m_net")) > 0.3)),
                      "warning", "0 with |alpha| > 30pp"),
        V.count_where("metrics_volatility_bounds", (F.col("volatility").isNotNull() & (F.col("volatility") > 5)),
                      "warning", "0 with vol > 500%"),
        V.count_where("metrics_sharpe_not_extreme",
                      (F.col("sharpe_excess").isNotNull() & (F.abs(F.col("sharpe_excess")) > 100)),
                      "warning", "0 with |Sharpe| > 100"),
    ]))
    parts.append(V.pk_unique(m, "metrics_pk_unique", ["fund_cnpj", "subclass_id"], "marts.metrics"))

    r_all = marts["rankings"]
    r, _, p = _snapshot_block(spark, r_all, ref, "rankings", "marts.rankings", None)
    parts += p
    parts.append(V.evaluate(r, [V.row_count("rankings_row_count", "marts.rankings")]))
    parts.append(V.evaluate(r, [
        V.count_where("rankings_score_in_range", (F.col("score") < 0) | (F.col("score") > 1), "warning")]))
    parts.append(V.pk_unique(r, "rankings_pk_unique", ["fund_cnpj", "subclass_id", "purpose", "profile", "investor_type"],
                             "marts.rankings"))
    if check_combos:
        expected = [(s.purpose, s.profile, s.investor_type) for s in settings.segments]
        parts.append(V.combo_coverage(r, "rankings_combo_coverage", expected))
    return V.with_context(_union(parts), "validate_marts", "marts", ref)
