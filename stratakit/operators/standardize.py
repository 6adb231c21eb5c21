"""Column standardisation: each rule applies where its column exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from stratakit.functions import scalars as S


def standardize(df: DataFrame, rules: dict[str, Callable[[str, str], Column]]) -> DataFrame:
    """Applies ``rules`` (column -> function of name and type) in one projection."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: rule(c, kinds[c]) for c, rule in rules.items() if c in kinds})


def common_rules(year: str = "ano", code: str = "id_municipio", states: tuple[str, ...] = ("sigla_uf", "sigla"), network: str = "rede") -> dict[str, Callable[[str, str], Column]]:
    return {
        year: lambda c, _: S.year(c),
        code: lambda c, kind: S.padded_code(c, kind),
        **{state: lambda c, _: S.upper_clean(c) for state in states},
        network: lambda c, _: S.lower_clean(c),
    }


def standardize_common(df: DataFrame) -> DataFrame:
    """Year, municipality code, state codes and network in their standard forms."""
    return standardize(df, common_rules())
