"""The literacy domain as data: entities, keys, quality rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from stratakit.operators.quality import FOREIGN_KEY, NOT_NULL, PATTERN, RANGE, SUM, UNIQUE, Rule


@dataclass(frozen=True)
class Entity:
    name: str
    source: str
    keys: tuple[str, ...]
    partition: str | None = None
    year_filter: bool = False
    required: tuple[str, ...] = ()
    enrich_with: str | None = None
    rules: tuple[Rule, ...] = ()
    schema: T.StructType | str | None = field(default=None, compare=False)


def _targets(*extra: str) -> str:
    years = ", ".join(f"meta_alfabetizacao_{y} double" for y in range(2024, 2031))
    return ", ".join(["ano int", *extra, "rede string", "taxa_alfabetizacao double", years, "percentual_participacao double"])


_STUDENTS = "ano int, id_municipio string, id_escola string, id_aluno string, caderno string, serie string, rede string, presenca string, preenchimento_caderno string, alfabetizado string, proficiencia double, peso_aluno double"

# Rule ids and texts are part of the data contracts (fixed values).
UF = Entity("uf", "uf", ("sigla",), required=("sigla", "nome"), schema="id_uf string, sigla string, nome string, regiao string", rules=(
    Rule("uf_sigla_obrigatoria", NOT_NULL, "sigla", description="Coluna sigla não deve ser nula"),
    Rule("uf_nome_obrigatorio", NOT_NULL, "nome", description="Coluna nome não deve ser nula"),
))
MUNICIPIO = Entity("municipio", "municipio", ("id_municipio",), required=("id_municipio", "nome"), rules=(
    Rule("municipio_id_obrigatorio", NOT_NULL, "id_municipio", description="Coluna id_municipio não deve ser nula"),
    Rule("municipio_nome_obrigatorio", NOT_NULL, "nome", description="Coluna nome não deve ser nula"),
    Rule("municipio_id_formato", PATTERN, "id_municipio", description="ID município com 7 dígitos numéricos"),
))
META_BRASIL = Entity("meta_brasil", "meta_brasil", ("ano", "rede"), "ano", True, ("ano",), schema=_targets(), rules=(
    Rule("meta_brasil_ano_obrigatorio", NOT_NULL, "ano", description="Coluna ano não deve ser nula"),
))
META_UF = Entity("meta_uf", "meta_uf", ("ano", "sigla_uf", "rede"), "ano", True, ("ano",), "uf", schema=_targets("sigla_uf string"), rules=(
    Rule("meta_uf_ano_obrigatorio", NOT_NULL, "ano", description="Coluna ano não deve ser nula"),
    Rule("meta_uf_sigla_fk", FOREIGN_KEY, "sigla_uf", reference="uf.sigla", description="sigla_uf deve existir na tabela uf"),
))
META_MUNICIPIO = Entity("meta_municipio", "meta_municipio", ("ano", "id_municipio", "rede"), "ano", True, ("ano",), "municipio", schema=_targets("id_municipio string", "nivel_alfabetizacao int"), rules=(
    Rule("meta_municipio_ano_obrigatorio", NOT_NULL, "ano", description="Coluna ano não deve ser nula"),
    Rule("meta_municipio_id_municipio_formato", PATTERN, "id_municipio", description="ID município com 7 dígitos numéricos"),
    Rule("meta_municipio_fk", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio", description="id_municipio deve existir na tabela municipio"),
))
ALUNOS = Entity("alunos", "alunos", ("ano", "id_aluno"), "ano", True, ("ano", "id_aluno"), schema=_STUDENTS, rules=(
    Rule("alunos_ano_obrigatorio", NOT_NULL, "ano", description="Coluna ano não deve ser nula"),
    Rule("alunos_id_aluno_obrigatorio", NOT_NULL, "id_aluno", description="Coluna id_aluno não deve ser nula"),
    Rule("alunos_id_municipio_formato", PATTERN, "id_municipio", description="ID município com 7 dígitos numéricos"),
    Rule("alunos_municipio_fk", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio", description="id_municipio deve existir na tabela municipio"),
))
ENTITIES = {e.name: e for e in (UF, MUNICIPIO, META_BRASIL, META_UF, META_MUNICIPIO, ALUNOS)}
#: Entities that batch ingestion reads from the warehouse; students come by stream.
BATCH_SOURCES = ("uf", "municipio", "meta_brasil", "meta_uf", "meta_municipio")

_RATE = Rule("gold_taxa_faixa", RANGE, "taxa_crianca_alfabetizada", low=0, high=100, description="Taxa calculada deve estar entre 0 e 100")
GOLD_RULES = {
    "municipio": (_RATE, Rule("gold_referencia_territorial", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio", description="id_municipio deve existir na referência Silver municipio")),
    "uf": (_RATE, Rule("gold_referencia_territorial", FOREIGN_KEY, "sigla_uf", reference="municipio.sigla_uf", description="sigla_uf deve existir na referência Silver municipio")),
}

_SHARES = tuple(f"proporcao_aluno_nivel_{k}" for k in range(9))
#: Rules that the contracts state for catalogued tables and targets.
DOCUMENTED_RULES = {
    "municipio_indicadores": (
        Rule("municipio_ind_ano_obrigatorio", NOT_NULL, "ano", description="Coluna ano não deve ser nula"),
        Rule("municipio_ind_chave_unica", UNIQUE, columns=("ano", "id_municipio", "serie", "rede"), description="Combinação ano + município + série + rede única por carga"),
        Rule("municipio_ind_proporcoes_soma", SUM, columns=_SHARES, description="Soma das proporções por nível (0–8) deve aproximar 100% quando aplicável"),
    ),
    "targets": tuple(Rule(f"{c}_faixa", RANGE, c, description=f"{c} deve estar entre 0 e 100") for c in ("taxa_alfabetizacao", "percentual_participacao", *(f"meta_alfabetizacao_{y}" for y in range(2024, 2031)))),
}
