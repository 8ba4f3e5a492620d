"""Declared schemas of the stored tables, and the check that every write passes.

``checked`` holds a frame against its table's declaration before it is written: a column that is not declared, a missing key
and a type that is not the declared one (or a narrower number) are refused; any other missing column is written as typed
NULLs. The order of the columns is the declared one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

from .sinks.tables import SchemaContractError, align_columns

_WINDOWS = ("1m", "3m", "6m", "12m", "24m", "36m")
_HEAD = "fund_cnpj string, subclass_id string, fund_name string"


def _doubles(*names: str) -> str:
    return ", ".join(f"{n} double" for n in names)


# Column names and types of the tables, as the later layers read them.
DECLARED = {
    "raw.inf_diario": "TP_FUNDO_CLASSE string, CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date, VL_QUOTA double, "
                      "VL_PATRIM_LIQ double, CAPTC_DIA double, RESG_DIA double, NR_COTST int",
    "raw.cdi_daily": "date date, rate double",
    "staging.daily_quotes": "fund_cnpj string, subclass_id string, date date, nav double, aum double, inflows double, outflows double, shareholders int",
    "staging.quote_month_summary": "fund_cnpj string, subclass_id string, quote_month string, first_date date, last_date date, n_rows bigint, quote_year int",
    "staging.registry": f"{_HEAD}, inception_date date, status string, anbima_category string, target_investor string, share_class string, "
                        "fund_structure string, is_exclusive string, is_pension string",
    "staging.fees": "fund_cnpj string, adm_fee double, adm_fee_date date, perf_fee double, perf_fee_desc string, perf_fee_date date, has_perf_fee boolean",
    "staging.anbima": "fund_cnpj string, subclass_id string, anbima_code string, structure string, commercial_name string, category string, type string, "
                      "level_1 string, level_2 string, level_3 string, focus string, composition string, open_to_public string, is_esg string, "
                      "target_taxation string, administrator string, lead_manager string, investor_type string, investor_profile string, "
                      "min_initial_investment double, open_nav_quota string, redemption_days double",
    "staging.cdi_rates": "date date, rate double",
    "marts.universe": f"{_HEAD}, inception_date date, anbima_category string, target_investor string, share_class string, fund_structure string, "
                      "adm_fee double, has_perf_fee boolean, median_aum double, median_holders double, target_taxation string, redemption_days int, "
                      "min_investment double, reference_date date",
    "marts.metrics": f"{_HEAD}, target_investor string, target_taxation string, redemption_days int, min_investment double, "
                     + _doubles(*[f"return_{w}" for w in _WINDOWS], *[f"alpha_{w}" for w in _WINDOWS], "annualized_return",
                                *[f"return_{w}_net" for w in (*_WINDOWS, "annualized")], *[f"alpha_{w}_net" for w in (*_WINDOWS, "annualized")],
                                "pct_months_above_cdi", "volatility", "sharpe_excess", "sharpe_raw", "max_drawdown")
                     + ", span_days int, ir_rate double, investor_level int, reference_date date",
    "marts.rankings": f"{_HEAD}, purpose string, profile string, investor_type string, rank int, score double, investor_level int, ir_rate double, "
                      + _doubles("alpha_12m_net", "alpha_3m_net", "alpha_6m_net", "return_annualized_net", "return_12m_net", "sharpe_excess",
                                 "pct_months_above_cdi", "max_drawdown", "volatility")
                      + ", span_days int, redemption_days int, min_investment double, "
                      + _doubles(*[f"s_alpha_{w}_net" for w in ("12m", "3m", "6m", "24m", "36m")], "s_return_annualized_net", "s_sharpe_excess",
                                 "s_pct_months_above_cdi", "s_max_drawdown", "s_volatility", "s_span", "s_liquidity", "s_accessibility")
                      + ", reference_date date",
}

# Columns without which a table cannot be read on; raw snapshots are stored as they land otherwise.
KEYS = {
    "raw.inf_diario": ("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC"),
    "raw.cdi_daily": ("date",),
    "raw.registro_classe": ("ID_Registro_Fundo", "ID_Registro_Classe", "CNPJ_Classe"),
    "raw.registro_subclasse": ("ID_Registro_Classe", "ID_Subclasse"),
    "raw.cad_fi_hist_taxa_adm": ("CNPJ_FUNDO", "TAXA_ADM", "DT_INI_TAXA_ADM"),
    "raw.cad_fi_hist_taxa_perfm": ("CNPJ_FUNDO", "VL_TAXA_PERFM", "DT_INI_TAXA_PERFM"),
    "raw.extrato_fi": ("CNPJ_FUNDO_CLASSE", "DT_COMPTC", "TAXA_ADM", "EXISTE_TAXA_PERFM"),
    "raw.anbima_caracteristicas": ("Cnpj_Da_Classe", "Estrutura"),
    "staging.daily_quotes": ("fund_cnpj", "subclass_id", "date"),
    "staging.quote_month_summary": ("fund_cnpj", "subclass_id", "quote_month", "quote_year"),
    "staging.registry": ("fund_cnpj", "subclass_id"),
    "staging.fees": ("fund_cnpj",),
    "staging.anbima": ("fund_cnpj", "subclass_id"),
    "staging.cdi_rates": ("date",),
    "marts.universe": ("fund_cnpj", "subclass_id", "reference_date"),
    "marts.metrics": ("fund_cnpj", "subclass_id", "reference_date"),
    "marts.rankings": ("fund_cnpj", "subclass_id", "purpose", "profile", "investor_type", "reference_date"),
}

_WIDTH = {ShortType: 1, IntegerType: 2, LongType: 3, FloatType: 4, DoubleType: 5}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(DECLARED[table])


def _fits(have: DataType, want: DataType) -> bool:
    """The same type, or a number that the declared type can hold."""
    return have == want or have.typeName() == "void" or (type(have) in _WIDTH and type(want) in _WIDTH and _WIDTH[type(have)] <= _WIDTH[type(want)])


def checked(df: DataFrame, table: str) -> DataFrame:
    """``df`` as the declared table; raises ``SchemaContractError`` naming every drifted column."""
    drift = [f"{c}: missing" for c in KEYS.get(table, ()) if c not in df.columns]
    if table in DECLARED:
        want = {f.name: f.dataType for f in schema_of(table).fields}
        drift += [f"{f.name}: not declared" for f in df.schema.fields if f.name not in want]
        drift += [f"{f.name}: {f.dataType.simpleString()} instead of {want[f.name].simpleString()}"
                  for f in df.schema.fields if f.name in want and not _fits(f.dataType, want[f.name])]
    if drift:
        raise SchemaContractError(f"{table} has drifted: {'; '.join(drift)}")
    return align_columns(df, schema_of(table)) if table in DECLARED else df
