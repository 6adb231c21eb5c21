"""Weighted indicators by territory and their gaps to yearly targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.functions.scalars import number, ratio, true_flag, weight
from stratakit.operators.dedup import require_columns
from stratakit.operators.enrich import TERRITORY, Lookup, enrich

TARGET_YEARS = tuple(range(2024, 2031))


@dataclass(frozen=True)
class IndicatorSpec:
    """Column names of an indicator."""

    flag: str = "alfabetizado"
    weight: str = "peso_aluno"
    score: str = "proficiencia"
    rate: str = "taxa_crianca_alfabetizada"
    official: str = "taxa_alfabetizacao"
    target: str = "meta_alfabetizacao_{year}"
    gap_official: str = "gap_taxa_vs_inep"
    gap: str = "gap_meta_{year}"
    years: tuple[int, ...] = TARGET_YEARS


SPEC = IndicatorSpec()


def prepare(df: DataFrame, spec: IndicatorSpec = SPEC, nulls_count: bool = True) -> DataFrame:
    """Flag 0 or 1, weight (1 where absent), score.  Whole numbers in a float
    flag column read as whole numbers.  ``nulls_count`` off: rows without a flag
    leave."""
    require_columns(df, [spec.flag], "students")
    flag = F.col(spec.flag)
    flag = flag.cast("long") if dict(df.dtypes)[spec.flag] in ("double", "float") else flag
    out = df.withColumns({
        "_flag": true_flag(flag, nulls_count=nulls_count),
        "_weight": weight(spec.weight) if spec.weight in df.columns else F.lit(1.0),
        "_score": number(spec.score) if spec.score in df.columns else F.lit(None).cast("double"),
    })
    return out if nulls_count else out.where(F.col("_flag").isNotNull())


def aggregate(prepared: DataFrame, keys: list[str], spec: IndicatorSpec = SPEC, mean_over: str = "all") -> DataFrame:
    """Counts, weights and rate by ``keys`` (null keys are groups).

    The weighted mean divides by all weight, or with ``mean_over="scored"`` by
    the weight of rows with a score; a zero weight gives null.
    """
    scored = F.sum(F.col("_score") * F.col("_weight"))
    over = F.sum(F.when(F.col("_score").isNotNull(), F.col("_weight"))) if mean_over == "scored" else F.sum("_weight")
    out = prepared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_alunos"),
        F.sum("_weight").alias("total_peso"),
        F.sum(F.col("_flag") * F.col("_weight")).alias("total_alfabetizados_ponderado"),
        ratio(F.coalesce(scored, F.lit(0.0)), over).alias("proficiencia_media_ponderada"),
    )
    return out.withColumn(spec.rate, ratio(F.col("total_alfabetizados_ponderado"), F.col("total_peso")) * 100)


def gap_columns(columns: list[str], spec: IndicatorSpec = SPEC) -> dict[str, Column]:
    """Rate less official rate and less each year's target, where present."""
    pairs = [(spec.gap_official, spec.official), *((spec.gap.format(year=y), spec.target.format(year=y)) for y in spec.years)]
    return {gap: F.col(spec.rate) - F.col(of) for gap, of in pairs if of in columns}


def add_gaps(indicator: DataFrame, targets: DataFrame, keys: list[str], spec: IndicatorSpec = SPEC, extra: tuple[str, ...] = ()) -> DataFrame:
    """Targets by null-safe left join (one row a key) and the gaps to them."""
    names = [spec.official, *(spec.target.format(year=y) for y in spec.years), *extra]
    out = enrich(indicator, targets, Lookup({k: k for k in keys}, {n: n for n in names}, match=None))
    return out.withColumns(gap_columns(out.columns, spec))


def local_indicator(students: DataFrame, targets: DataFrame, municipalities: DataFrame | None = None, spec: IndicatorSpec = SPEC) -> DataFrame:
    """The indicator by year, municipality and network, its state attached last."""
    keys = ["ano", "id_municipio", "rede"]
    out = add_gaps(aggregate(prepare(students, spec), keys, spec), targets, keys, spec, ("nome_municipio", "nome_uf", "sigla_uf"))
    if municipalities is not None and "sigla_uf" not in out.columns and "sigla_uf" in municipalities.columns:
        out = enrich(out, municipalities, TERRITORY)
    return out


def state_indicator(students: DataFrame, municipalities: DataFrame | None, targets: DataFrame, spec: IndicatorSpec = SPEC) -> DataFrame:
    """The indicator by year, state and network; students get their state before
    grouping, those without one leave."""
    if "sigla_uf" not in students.columns:
        if municipalities is None or "sigla_uf" not in municipalities.columns:
            raise ValueError("no table has the state's column")
        students = enrich(students, municipalities, TERRITORY)
    keys = ["ano", "sigla_uf", "rede"]
    prepared = prepare(students, spec).where(F.col("sigla_uf").isNotNull())
    return add_gaps(aggregate(prepared, keys, spec), targets, keys, spec, ("nome_uf",))


def distinct_years(df: DataFrame, year: str = "ano") -> DataFrame:
    return df.agg(F.count_distinct(year).alias("n_years"))


#: Text columns of the indicator tables; all others but the year are numbers.
TEXT_COLUMNS = ("id_municipio", "sigla_uf", "rede", "nome_municipio", "nome_uf", "_gold_processed_at", "_gold_batch_id")


def coerce(df: DataFrame, year: str = "ano", texts: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    """Year as int, named columns as text, everything else as number or null."""
    def kind(c: str) -> Column:
        if c == year:
            return F.col(c).try_cast("double").try_cast("int")
        if c in texts:
            return F.col(c).cast("string")
        return F.col(c) if dict(df.dtypes)[c] in ("bigint", "int", "double") else F.col(c).try_cast("double")

    return df.select(*[kind(c).alias(c) for c in df.columns])
