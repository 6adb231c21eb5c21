"""Left joins to reference tables, and column pruning."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.operators.dedup import lookup, require_columns


@dataclass(frozen=True)
class Lookup:
    """How a reference enriches a table.

    ``keys``: table column -> reference column; ``add``: reference column ->
    new name, those absent from the reference are left out.
    """

    keys: dict[str, str]
    add: dict[str, str] = field(default_factory=dict)
    match: str | None = "_join_match"


def enrich(df: DataFrame, reference: DataFrame, how: Lookup, null_safe: bool = True) -> DataFrame:
    """``df`` with the reference's columns; rows without a match stay.

    The reference is cut to its columns and to one row a key first, so that
    no row multiplies.  Null keys match null keys if ``null_safe``.  No join is
    hinted: Spark broadcasts the reference if its size allows.
    """
    require_columns(reference, list(how.keys.values()), "reference")
    require_columns(df, list(how.keys), "table")
    add = {a: b for a, b in how.add.items() if a in reference.columns}
    renamed = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(how.keys.values())]
    marker = [F.lit(True).alias("_found")]
    right = lookup(reference.select(*how.keys.values(), *[a for a in add if a not in how.keys.values()]), list(how.keys.values()))
    right = right.select(*renamed, *[F.col(a).alias(b) for a, b in add.items()], *marker)
    condition = F.lit(True)
    for i, k in enumerate(how.keys):
        pair = (F.col(k), F.col(f"_key_{i}"))
        condition = condition & (pair[0].eqNullSafe(pair[1]) if null_safe else pair[0] == pair[1])
    left = df.drop(*add.values(), *([how.match] if how.match else []))
    out = left.join(right, condition, "left").drop(*[f"_key_{i}" for i in range(len(how.keys))])
    if how.match:
        out = out.withColumn(how.match, F.coalesce("_found", F.lit(False)))
    return out.drop("_found")


# Columns and their new names, kept and dropped columns: part of the data contracts (fixed values).
STATE = Lookup({"sigla_uf": "sigla"}, {"nome": "nome_uf", "regiao": "regiao_uf", "id_uf": "id_uf"})
MUNICIPALITY = Lookup({"id_municipio": "id_municipio"}, {"nome": "nome_municipio", "sigla_uf": "sigla_uf", "nome_uf": "nome_uf", "nome_regiao": "regiao_municipio", "capital_uf": "capital_uf"})
TERRITORY = Lookup({"id_municipio": "id_municipio"}, {"sigla_uf": "sigla_uf"}, match=None)


def enrich_state_targets(targets: DataFrame, states: DataFrame) -> DataFrame:
    require_columns(states, ["sigla", "nome", "regiao", "id_uf"], "states")
    return enrich(targets, states, STATE)


def enrich_municipality_targets(targets: DataFrame, municipalities: DataFrame) -> DataFrame:
    require_columns(municipalities, ["id_municipio"], "municipalities")
    return enrich(targets, municipalities, MUNICIPALITY)


def unmatched(df: DataFrame, match: str = "_join_match") -> DataFrame:
    """One row: rows that found no reference."""
    return df.agg(F.count_if(~F.col(match)).alias("unmatched_rows"))


@dataclass(frozen=True)
class Keep:
    """Which columns stay: named ones and prefixes, less dropped ones."""

    columns: tuple[str, ...]
    prefixes: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    drop_prefixes: tuple[str, ...] = ()


# Fixed values.
STUDENT_COLUMNS = Keep(
    columns=("ano", "id_aluno", "id_municipio", "rede", "alfabetizado", "proficiencia", "peso_aluno", "_ingestion_timestamp"),
    prefixes=("_silver_",),
    drop=("_stream_sink", "_ingestion_mode", "_source_table", "_batch_id", "_event_type", "_event_timestamp", "_kafka_topic"),
    drop_prefixes=("_kafka_", "_event_"),
)


def prune(df: DataFrame, keep: Keep, extra: tuple[str, ...] = ()) -> DataFrame:
    """The kept columns that exist, in the keep list's order, then the others."""
    wanted = [c for c in (*keep.columns, *extra) if c in df.columns]
    wanted += [c for c in df.columns if c.startswith(keep.prefixes or ("\0",)) and c not in wanted]
    gone = [c for c in wanted if c in keep.drop or c.startswith(keep.drop_prefixes or ("\0",))]
    return df.select(*[c for c in wanted if c not in gone])
