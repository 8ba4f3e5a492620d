"""Domain views over the driver's synthetic tables (FIXTURES.md, Part B).

Each function reads the parquet tables under ``sf_dir`` and projects them into
the raw layout of one source table of the fund pipeline. Only the columns a
view needs are read (the parquet scan prunes the rest). The matching DuckDB
text for the oracle lives in ``oracle/sql.py``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, lazily read; reading again costs a footer, so nothing is kept between calls."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _dotted(col: str) -> str:
    """SQL text: digits left-padded to 14 and rendered XX.XXX.XXX/XXXX-XX."""
    p = f"lpad(CAST({col} AS STRING), 14, '0')"
    return (f"concat(substring({p}, 1, 2), '.', substring({p}, 3, 3), '.', substring({p}, 6, 3), '/', "
            f"substring({p}, 9, 4), '-', substring({p}, 13, 2))")


def fx_inf_diario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quotes (raw.inf_diario) with tie-breakers tb1..tb3 for the ordered dedupe."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{_dotted('l_suppkey')} AS CNPJ_FUNDO_CLASSE",
        "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS ID_SUBCLASSE",
        "CAST(l_shipdate AS DATE) AS DT_COMPTC",
        "l_linestatus AS TP_FUNDO_CLASSE",
        "CASE WHEN l_linenumber = 7 AND l_quantity <= 10 THEN 0D ELSE 100D + l_extendedprice / 1000D END AS VL_QUOTA",
        "l_extendedprice * 1000D AS VL_PATRIM_LIQ",
        "l_discount * 1000D AS CAPTC_DIA",
        "l_tax * 1000D AS RESG_DIA",
        "CASE WHEN l_quantity <= 5 THEN 0 ELSE CAST(l_quantity * 20 AS INT) END AS NR_COTST",
        "l_orderkey AS tb1", "l_linenumber AS tb2", "l_partkey AS tb3",
    )


def fx_cdi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark daily rate (raw.cdi_daily): one rate per order date."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.expr("(1 + min(o_orderkey) % 60) / 100000D").alias("rate")
    )


def fx_registro_classe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class registry (raw.registro_classe); every fifth supplier is also registered
    a second time under a lower, cancelled registration id."""
    s = table(spark, sf_dir, "supplier")

    def view(off: int, base: DataFrame) -> DataFrame:
        return base.selectExpr(
            f"CAST(s_suppkey AS BIGINT) + {off} AS ID_Registro_Fundo",
            "CAST(s_suppkey AS BIGINT) + 1000000 AS ID_Registro_Classe",
            "CAST(s_suppkey AS STRING) AS CNPJ_Classe",
            "s_name || CASE WHEN s_nationkey % 7 = 0 THEN ' INCENTIVADO' ELSE '' END AS Denominacao_Social",
            "CASE WHEN s_nationkey = 24 THEN NULL ELSE date_add(DATE '1994-01-01', CAST(s_nationkey AS INT) * 30) END AS Data_Inicio",
            f"CASE WHEN {off} < 0 OR s_suppkey % 11 = 5 THEN 'Cancelado' ELSE 'Em Funcionamento Normal' END AS Situacao",
            "CASE WHEN s_suppkey % 13 = 7 THEN 'Acoes' WHEN s_suppkey % 17 = 9 THEN NULL ELSE 'Renda Fixa Simples' END AS Classificacao_Anbima",
            "CASE s_nationkey % 3 WHEN 0 THEN 'Publico Geral' WHEN 1 THEN 'Qualificado' ELSE 'Profissional' END AS Publico_Alvo",
            "'Classe' AS Classe_Cotas",
            "CASE WHEN s_suppkey % 23 = 3 THEN 'Fechado' WHEN s_suppkey % 23 = 4 THEN NULL ELSE 'Aberto' END AS Forma_Condominio",
            "CASE WHEN s_suppkey % 19 = 6 THEN 'S' ELSE 'N' END AS Exclusivo",
        )

    return view(0, s).unionByName(view(-500000, s.where("s_suppkey % 5 = 0")))


def fx_registro_subclasse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subclass registry (raw.registro_subclasse): subclasses A and R for two thirds of the classes."""
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0")

    def view(sub: str) -> DataFrame:
        return s.selectExpr(
            "CAST(s_suppkey AS BIGINT) + 1000000 AS ID_Registro_Classe",
            f"'{sub}' AS ID_Subclasse",
            f"CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name || ' {sub}' END AS Denominacao_Social",
            "CASE WHEN s_suppkey % 29 = 8 THEN 'S' WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'N' END AS Previdenciario",
        )

    return view("A").unionByName(view("R"))


def fx_taxa_adm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Administration-fee history (raw.cad_fi_hist_taxa_adm), the fee as text: error events carry text that is no number."""
    return table(spark, sf_dir, "events").where("event_type IN ('view', 'click', 'error')").selectExpr(
        "CAST(user_id AS STRING) AS CNPJ_FUNDO",
        "CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'n/d' ELSE 'NaN' END "
        "WHEN event_id % 9 = 0 THEN NULL ELSE CAST(value AS STRING) END AS TAXA_ADM",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS DT_INI_TAXA_ADM",
        "event_id AS tb1",
    )


def fx_taxa_perfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance-fee history (raw.cad_fi_hist_taxa_perfm); a fourth of the funds state no fee."""
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr(
        "CAST(user_id AS STRING) AS CNPJ_FUNDO",
        "CASE WHEN user_id % 4 = 0 OR event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 0D ELSE value END AS VL_TAXA_PERFM",
        "props AS DS_TAXA_PERFM", "CAST(ts AS DATE) AS DT_INI_TAXA_PERFM", "event_id AS tb1",
    )


def fx_extrato(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund extract (raw.extrato_fi), already carrying a formatted key."""
    return table(spark, sf_dir, "events").where("event_type = 'signup'").selectExpr(
        f"{_dotted('user_id')} AS CNPJ_FUNDO_CLASSE",
        "CAST(ts AS DATE) AS DT_COMPTC",
        "value / 100D AS TAXA_ADM",
        "CASE event_id % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE NULL END AS EXISTE_TAXA_PERFM",
        "event_id AS tb1",
    )


def fx_anbima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characteristics extract (raw.anbima_caracteristicas): one Classe row and two
    Subclasse rows per part."""
    p = table(spark, sf_dir, "part")

    def view(est: str, code: str) -> DataFrame:
        code_sql = f"' {code}'" if code != "A" else "CASE WHEN p_partkey % 31 = 2 THEN NULL ELSE ' A' END"
        return p.selectExpr(
            "CAST(p_partkey AS STRING) AS Cnpj_Da_Classe",
            f"'{est}' AS Estrutura",
            f"{code_sql} AS Codigo_Cvm_Subclasse",
            "p_name AS Nome_Comercial",
            "CASE p_partkey % 3 WHEN 0 THEN 'Renda Fixa' WHEN 1 THEN 'Multimercados' ELSE NULL END AS Categoria_Anbima",
            "CASE p_partkey % 4 WHEN 0 THEN 'Varejo' WHEN 1 THEN 'Private' ELSE NULL END AS Tipo_De_Investidor",
            "CASE p_type WHEN 'MEDIUM' THEN 'Longo Prazo' WHEN 'SMALL' THEN 'Curto Prazo' WHEN 'PROMO' THEN 'Isento' "
            "WHEN 'LARGE' THEN 'Outros' WHEN 'STANDARD' THEN 'Alíquota de 15%' ELSE NULL END AS Tributacao_Alvo",
            "CASE WHEN p_partkey % 25 = 1 THEN 'n/d' ELSE CAST(p_size AS STRING) END AS Prazo_Pagamento_Resgate_Em_Dias",
            "CASE WHEN p_partkey % 25 = 2 THEN 'n/d' ELSE CAST(CAST(p_retailprice * 10 AS INT) AS STRING) END AS Aplicacao_Inicial_Minima",
        )

    return view("Classe", "X").unionByName(view("Subclasse", "A")).unionByName(view("Subclasse", "R"))


BINDINGS = {
    "fx_inf_diario": fx_inf_diario,
    "fx_cdi": fx_cdi,
    "fx_registro_classe": fx_registro_classe,
    "fx_registro_subclasse": fx_registro_subclasse,
    "fx_taxa_adm": fx_taxa_adm,
    "fx_taxa_perfm": fx_taxa_perfm,
    "fx_extrato": fx_extrato,
    "fx_anbima": fx_anbima,
}
