"""Staging layer: raw source tables -> clean, keyed tables.

Each cleaner is ``DataFrame(s) -> DataFrame``; none collects data (the incremental
steps read one scalar low- or high-water mark). Keys, NULL
handling and de-duplication order follow the semantics ledger (SURVEY §8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import keyed, timeseries as ts

SERIES_KEY = ["fund_cnpj", "subclass_id"]
QUOTE_COLS = ["fund_cnpj", "subclass_id", "date", "nav", "aum", "inflows", "outflows", "shareholders"]
RAW_QUOTE_KEY = ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC"]


# ------------------------------------------------------------------ quotes


def dedupe_quotes(raw: DataFrame, tie_breakers: tuple[str, ...] = ("tb1", "tb2", "tb3", "VL_QUOTA")) -> DataFrame:
    """Per (fund, subclass, date) keep the first row by TP_FUNDO_CLASSE, NULLs first.

    The source has no total order for ties; ``tie_breakers`` supply one.

    The raw rows move once, by series, before they are sorted: hardly any two of them share a key, so a map-side pass
    would sort whole input splits (and spill them) without making them fewer. The fill by series finds its rows in place.
    """
    tbs = [t for t in tie_breakers if t in raw.columns]
    return keyed.dedupe_first(raw.repartition(*RAW_QUOTE_KEY[:2]), RAW_QUOTE_KEY, "TP_FUNDO_CLASSE", tbs)


def drop_ghost_rows(df: DataFrame) -> DataFrame:
    """P5: drop rows with nav = 0 and holders = 0 (NULL holders are kept)."""
    ghost = F.coalesce((F.col("VL_QUOTA") == 0) & (F.col("NR_COTST") == 0), F.lit(False))
    return df.where(~ghost)


def mask_active_zero(df: DataFrame) -> DataFrame:
    """nav = 0 on an active fund (holders > 0 or aum > 0) becomes NULL."""
    active = (F.coalesce(F.col("NR_COTST"), F.lit(0)) > 0) | (F.coalesce(F.col("VL_PATRIM_LIQ"), F.lit(0.0)) > 0)
    bad = F.coalesce(F.col("VL_QUOTA") == 0, F.lit(False)) & active
    return df.withColumn("VL_QUOTA", F.when(bad, F.lit(None).cast("double")).otherwise(F.col("VL_QUOTA")))


def rename_quotes(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("CNPJ_FUNDO_CLASSE").alias("fund_cnpj"),
        F.col("ID_SUBCLASSE").alias("subclass_id"),
        F.col("DT_COMPTC").alias("date"),
        F.col("VL_QUOTA").cast("double").alias("nav"),
        F.col("VL_PATRIM_LIQ").cast("double").alias("aum"),
        F.col("CAPTC_DIA").cast("double").alias("inflows"),
        F.col("RESG_DIA").cast("double").alias("outflows"),
        F.col("NR_COTST").cast("int").alias("shareholders"),
    )


def clean_quotes(raw: DataFrame) -> DataFrame:
    """Dedupe, drop ghost rows, mask bad zeros, rename, forward-fill nav.

    The dedupe is an aggregate on the natural key, in the partitions by series;
    after it every series has at most one row per day, so the fill window per
    series is calendar-bounded.
    """
    out = dedupe_quotes(raw)
    out = drop_ghost_rows(out)
    out = mask_active_zero(out)
    out = rename_quotes(out)
    return ts.forward_fill(out, SERIES_KEY, "date", ["nav"])


def clean_quotes_incremental(raw_batch: DataFrame, staged: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Clean a new batch of months, seeding the fill with the last staged
    row of each series before the batch's first date (a scalar: the batch's
    low-water mark, so the staged scan gets a pushed-down date filter).
    ``seeds`` may be given precomputed (see ``seed_rows``)."""
    out = rename_quotes(mask_active_zero(drop_ghost_rows(dedupe_quotes(raw_batch))))
    if seeds is None:
        first = out.agg(F.min("date").alias("m")).first()["m"]
        if first is None:
            return out.select(*QUOTE_COLS)
        before = staged.where(F.col("date") < F.lit(first).cast("date"))
        seeds = keyed.latest_row_per_key(before.select(*SERIES_KEY, "date", "nav"), SERIES_KEY, "date")
    return ts.forward_fill_seeded(out, seeds.select(*SERIES_KEY, "date", "nav"), SERIES_KEY, "date", ["nav"]).select(*QUOTE_COLS)


def seed_rows(staged_by_month: DataFrame, summary: DataFrame, first) -> DataFrame:
    """Last stored row of every series before ``first``, reading only the month
    partitions that hold those rows.

    ``staged_by_month`` is the stored quotes table with its ``quote_month``
    partition column; ``summary`` the per (series, month) first/last/count table.
    Whole months before ``first``'s month give each series' last date from the
    summary; ``first``'s own month is read for rows before ``first``. The months
    of the seed dates (bounded by the calendar) become a partition filter.
    """
    first_month = first.strftime("%Y-%m")
    f = F.lit(first).cast("date")
    from_summary = (summary.where(F.col("quote_year") <= F.lit(first.year))
                    .where(F.col("quote_month") < F.lit(first_month)).select(*SERIES_KEY, F.col("last_date").alias("d")))
    same_month = (staged_by_month.where((F.col("quote_month") == F.lit(first_month)) & (F.col("date") < f))
                  .select(*SERIES_KEY, F.col("date").alias("d")))
    last = from_summary.unionByName(same_month).groupBy(*SERIES_KEY).agg(F.max("d").alias("date"))
    months = sorted({r[0] for r in last.select(F.date_format("date", "yyyy-MM")).distinct().collect()})
    rows = staged_by_month.where(F.col("quote_month").isin(months)).drop("quote_month")
    return keyed.null_safe_join(rows, last, [*SERIES_KEY, "date"], "left_semi")


# ------------------------------------------------------------------ registry


def clean_registry_class(raw: DataFrame) -> DataFrame:
    """Parse the inception date, format the key, rename, keep the newest
    registration (highest ID_Registro_Fundo, NULL lowest) per fund."""
    dt = dict(raw.dtypes)
    out = raw.select(
        X.format_key(F.col("CNPJ_Classe")).alias("fund_cnpj"),
        F.col("ID_Registro_Fundo"),
        F.col("ID_Registro_Classe"),
        F.col("Denominacao_Social").alias("fund_name"),
        (F.try_to_date(F.col("Data_Inicio")) if dt["Data_Inicio"] == "string" else F.col("Data_Inicio").cast("date"))
        .alias("inception_date"),
        F.col("Situacao").alias("status"),
        F.col("Classificacao_Anbima").alias("anbima_category"),
        F.col("Publico_Alvo").alias("target_investor"),
        F.col("Classe_Cotas").alias("share_class"),
        F.col("Forma_Condominio").alias("fund_structure"),
        F.col("Exclusivo").alias("is_exclusive"),
    )
    # The registration id is unique per row in the source; it is its own tie-breaker.
    return keyed.dedupe_latest(out, ["fund_cnpj"], "ID_Registro_Fundo", ["ID_Registro_Classe"]).drop("ID_Registro_Fundo")


def clean_registry_subclass(raw: DataFrame) -> DataFrame:
    """Rename and project."""
    return raw.select(
        "ID_Registro_Classe",
        F.col("ID_Subclasse").alias("subclass_id"),
        F.col("Denominacao_Social").alias("fund_name_sub"),
        F.col("Previdenciario").alias("is_pension"),
    )


REGISTRY_COLS = [
    "fund_cnpj", "subclass_id", "fund_name", "inception_date", "status", "anbima_category",
    "target_investor", "share_class", "fund_structure", "is_exclusive", "is_pension",
]


def class_subclass(classes: DataFrame, subclasses: DataFrame) -> DataFrame:
    """Class LEFT JOIN subclass on the registry id; the subclass name wins
    when present; pension flag defaults to 'N'."""
    j = classes.join(subclasses, "ID_Registro_Classe", "left")
    return j.select(
        "fund_cnpj", "subclass_id",
        F.coalesce(F.col("fund_name_sub"), F.col("fund_name")).alias("fund_name"),
        "inception_date", "status", "anbima_category", "target_investor", "share_class",
        "fund_structure", "is_exclusive",
        F.coalesce(F.col("is_pension"), F.lit("N")).alias("is_pension"),
    )


def stage_registry(raw_class: DataFrame, raw_subclass: DataFrame) -> DataFrame:
    return class_subclass(clean_registry_class(raw_class), clean_registry_subclass(raw_subclass))


# ------------------------------------------------------------------ fees


def clean_admin_fees(raw: DataFrame) -> DataFrame:
    """W3 on the admin-fee history: per fund, last non-NULL fee and date."""
    d = raw.select(
        X.format_key(F.col("CNPJ_FUNDO")).alias("fund_cnpj"),
        X.to_number_or_null(F.col("TAXA_ADM"), raw.schema["TAXA_ADM"].dataType).alias("adm_fee"),
        X.to_date_or_null(F.col("DT_INI_TAXA_ADM"), raw.schema["DT_INI_TAXA_ADM"].dataType).alias("adm_fee_date"),
        *[F.col(c) for c in ("tb1",) if c in raw.columns],
    )
    tbs = ["tb1"] if "tb1" in raw.columns else []
    return keyed.last_non_null_per_column(d, ["fund_cnpj"], "adm_fee_date", ["adm_fee"], tbs)


def clean_perf_fees(raw: DataFrame) -> DataFrame:
    """W3 on the performance-fee history, then has_perf_fee = fee > 0."""
    d = raw.select(
        X.format_key(F.col("CNPJ_FUNDO")).alias("fund_cnpj"),
        X.to_number_or_null(F.col("VL_TAXA_PERFM"), raw.schema["VL_TAXA_PERFM"].dataType).alias("perf_fee"),
        F.col("DS_TAXA_PERFM").alias("perf_fee_desc"),
        X.to_date_or_null(F.col("DT_INI_TAXA_PERFM"), raw.schema["DT_INI_TAXA_PERFM"].dataType).alias("perf_fee_date"),
        *[F.col(c) for c in ("tb1",) if c in raw.columns],
    )
    tbs = ["tb1"] if "tb1" in raw.columns else []
    out = keyed.last_non_null_per_column(d, ["fund_cnpj"], "perf_fee_date", ["perf_fee", "perf_fee_desc"], tbs)
    return out.withColumn("has_perf_fee", X.flag_positive(F.col("perf_fee")))


def clean_extract(raw: DataFrame) -> DataFrame:
    """W3 on the extract (key as delivered), flag S/N -> boolean."""
    d = raw.select(
        F.col("CNPJ_FUNDO_CLASSE").alias("fund_cnpj"),
        X.to_date_or_null(F.col("DT_COMPTC"), raw.schema["DT_COMPTC"].dataType).alias("DT_COMPTC"),
        X.to_number_or_null(F.col("TAXA_ADM"), raw.schema["TAXA_ADM"].dataType).alias("adm_fee"),
        F.col("EXISTE_TAXA_PERFM"),
        *[F.col(c) for c in ("tb1",) if c in raw.columns],
    )
    tbs = ["tb1"] if "tb1" in raw.columns else []
    out = keyed.last_non_null_per_column(d, ["fund_cnpj"], "DT_COMPTC", ["adm_fee", "EXISTE_TAXA_PERFM"], tbs)
    return out.select("fund_cnpj", "adm_fee", X.flag_from_yn(F.col("EXISTE_TAXA_PERFM")).alias("has_perf_fee"))


def fees_full(adm: DataFrame, perf: DataFrame) -> DataFrame:
    """Admin fees FULL OUTER JOIN performance fees on the fund key."""
    return adm.join(perf, "fund_cnpj", "full")


def fees_fallback(hist: DataFrame, ext: DataFrame) -> DataFrame:
    """Fill only the missing adm_fee / has_perf_fee from the extract."""
    e = ext.select("fund_cnpj", F.col("adm_fee").alias("adm_fee_ext"), F.col("has_perf_fee").alias("has_perf_fee_ext"))
    j = hist.join(e, "fund_cnpj", "left")
    return j.withColumn("adm_fee", F.coalesce("adm_fee", "adm_fee_ext")).withColumn(
        "has_perf_fee", F.coalesce("has_perf_fee", "has_perf_fee_ext")
    ).drop("adm_fee_ext", "has_perf_fee_ext")


FEE_COLS = ["fund_cnpj", "adm_fee", "adm_fee_date", "perf_fee", "perf_fee_desc", "perf_fee_date", "has_perf_fee"]


def clean_fees(raw_adm: DataFrame, raw_perf: DataFrame, raw_ext: DataFrame | None) -> DataFrame:
    """W3 per source, full join, extract fallback, fee normalisation."""
    hist = fees_full(clean_admin_fees(raw_adm), clean_perf_fees(raw_perf))
    df = fees_fallback(hist, clean_extract(raw_ext)) if raw_ext is not None else hist
    return df.select(
        "fund_cnpj",
        X.normalise_fee(F.col("adm_fee")).alias("adm_fee"),
        "adm_fee_date",
        X.normalise_fee(F.col("perf_fee")).alias("perf_fee"),
        "perf_fee_desc", "perf_fee_date", "has_perf_fee",
    )


# ------------------------------------------------------------------ characteristics

# The characteristics source's header -> staging column names.
CHARACTERISTICS_RENAME = {
    "Cnpj_Da_Classe": "fund_cnpj",
    "Codigo_Cvm_Subclasse": "subclass_id",
    "Codigo_Anbima": "anbima_code",
    "Estrutura": "structure",
    "Nome_Comercial": "commercial_name",
    "Categoria_Anbima": "category",
    "Tipo_Anbima": "type",
    "Nivel_1_Categoria": "level_1",
    "Nivel_2_Categoria": "level_2",
    "Nivel_3_Subcategoria": "level_3",
    "Foco_Atuacao": "focus",
    "Composicao_Do_Fundo": "composition",
    "Aberto_Estatutariamente": "open_to_public",
    "Fundo_Esg": "is_esg",
    "Tributacao_Alvo": "target_taxation",
    "Administrador": "administrator",
    "Gestor_Principal": "lead_manager",
    "Tipo_De_Investidor": "investor_type",
    "Caracteristica_Do_Investidor": "investor_profile",
    "Aplicacao_Inicial_Minima": "min_initial_investment",
    "Cota_De_Abertura": "open_nav_quota",
    "Prazo_Pagamento_Resgate_Em_Dias": "redemption_days",
}


_TIE_FIRST = {"fund_cnpj", "subclass_id", "commercial_name", "target_taxation", "redemption_days", "min_initial_investment"}


def clean_characteristics(raw: DataFrame, order: tuple[str, ...] = ("Estrutura",)) -> DataFrame:
    """Drop Subclasse rows without a code, blank the code on other rows,
    rename, format the key, normalise the code, parse numbers, keep the first
    row per (fund, subclass) by ``order``.

    Absent source columns become typed NULL columns (declared schema).
    """
    is_sub = F.col("Estrutura") == "Subclasse"
    df = raw
    if "Codigo_Cvm_Subclasse" in df.columns:
        df = df.where(~F.coalesce(is_sub & F.col("Codigo_Cvm_Subclasse").isNull(), F.lit(False)))
        code = F.when(is_sub, F.col("Codigo_Cvm_Subclasse"))
        code_type = df.schema["Codigo_Cvm_Subclasse"].dataType
    else:
        code = F.lit(None).cast("string")
        code_type = None
    cols = []
    for src, dst in CHARACTERISTICS_RENAME.items():
        if src == "Cnpj_Da_Classe":
            cols.append(X.format_key(F.col(src)).alias(dst))
        elif src == "Codigo_Cvm_Subclasse":
            cols.append(X.normalise_code(code, code_type).alias(dst))
        elif src in ("Prazo_Pagamento_Resgate_Em_Dias", "Aplicacao_Inicial_Minima"):
            c = X.to_number_or_null(F.col(src), df.schema[src].dataType) if src in df.columns else F.lit(None).cast("double")
            cols.append(c.alias(dst))
        elif src in df.columns:
            cols.append(F.col(src).cast("string").alias(dst))
        else:
            cols.append(F.lit(None).cast("string").alias(dst))
    tbs = [o for o in order if o in df.columns]
    out = df.select(*cols, *[F.col(o).alias(f"__o{i}") for i, o in enumerate(tbs)])
    # the kept columns break ties, so the choice does not depend on the input's order
    ties = ["commercial_name", "target_taxation", "redemption_days", "min_initial_investment",
            *[c for c in CHARACTERISTICS_RENAME.values() if c not in _TIE_FIRST]]
    out = keyed.keep_first(out, ["fund_cnpj", "subclass_id"], [*[f"__o{i}" for i in range(len(tbs))], *ties])
    return out.select(*CHARACTERISTICS_RENAME.values())


# ------------------------------------------------------------------ benchmark


def clean_benchmark(raw: DataFrame) -> DataFrame:
    """Benchmark staging: one rate per date; of a repeated date the highest rate (which load wins is the upsert's job)."""
    rates = raw.select(F.col("date").cast("date").alias("date"), F.col("rate").cast("double").alias("rate"))
    return rates.groupBy("date").agg(F.max("rate").alias("rate"))


def incremental_new_rows(raw: DataFrame, staged: DataFrame | None, force: bool = False) -> DataFrame:
    """Benchmark rows newer than the staged high-water mark (all rows when forced)."""
    if force or staged is None:
        return raw
    hw = staged.agg(F.max("date").alias("m")).first()["m"]
    return raw if hw is None else raw.where(F.col("date") > F.lit(hw).cast("date"))
