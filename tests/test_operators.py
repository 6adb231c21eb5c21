"""Golden values and edge cases of the operators."""

import math

import pytest
from pyspark.sql import functions as F

from stratakit.functions import scalars as S
from stratakit.operators import dedup, enrich, indicator, quality, reports, standardize, upsert
from stratakit.operators.quality import FOREIGN_KEY, NOT_NULL, PATTERN, RANGE, SUM, UNIQUE, Rule


def one(df, c="x"):
    return [r[c] for r in df.collect()]


def values(spark, rows, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return one(df.select("i", f("v").alias("x")).orderBy("i"))


def test_codes(spark):
    assert values(spark, ["123", "45", "3550308.0", "x", "", None, " 7 ", "12345678"], "string", S.padded_code) == ["0000123", "0000045", "3550308", None, None, None, "0000007", "12345678"]
    assert values(spark, [3550308.0, 12345678.0, None], "double", lambda c: S.padded_code(c, "double")) == ["3550308", "12345678", None]


def test_case_trim_null_words_and_years(spark):
    assert values(spark, [" sp ", "Rj", "\tNaN\n", "<NA>", None], "string", S.upper_clean) == ["SP", "RJ", None, None, None]
    assert values(spark, [" Municipal ", "ESTADUAL", "None"], "string", S.lower_clean) == ["municipal", "estadual", None]
    assert values(spark, ["2024", "2024.0", "2024.5", "abc", None], "string", S.year) == [2024, 2024, None, None, None]


def test_flags_weights_ratio(spark):
    assert values(spark, ["Sim", "Não", "1", "0", None], "string", S.true_flag) == [1.0, 0.0, 1.0, 0.0, 0.0]
    assert values(spark, ["Sim", None], "string", lambda c: S.true_flag(c, nulls_count=False)) == [1.0, None]
    assert values(spark, ["2", "x", None], "string", S.weight) == [2.0, 1.0, 1.0]
    assert values(spark, [math.nan, 1.0], "double", S.number) == [None, 1.0]
    assert values(spark, [0.0, 2.0], "double", lambda c: S.ratio(F.lit(1.0), F.col(c))) == [None, 0.5]


def test_standardize_only_columns_that_exist(spark):
    df = spark.createDataFrame([("2024.0", " sp ")], "ano string, sigla_uf string")
    out = standardize.standardize_common(df)
    assert out.columns == ["ano", "sigla_uf"] and out.collect() == [(2024, "SP")]


def test_latest_keeps_the_later_row(spark):
    df = spark.createDataFrame([(1, "a", 0.5, "2024-01-01"), (1, "a", 0.9, "2024-01-02"), (1, "b", 0.1, None), (None, None, 1.0, None), (None, None, 2.0, "2020")], "k int, s string, v double, _ingestion_timestamp string")
    assert sorted(one(dedup.latest(df, ["k", "s"]), "v")) == [0.1, 0.9, 2.0]
    assert dedup.latest(df.drop("_ingestion_timestamp"), ["k", "s"]).count() == 3
    assert one(dedup.removed_rows(df, ["k", "s"]), "removed_rows") == [2]
    with pytest.raises(ValueError, match="missing"):
        dedup.latest(df, ["absent"])


def test_last_arrival_wins(spark):
    df = spark.createDataFrame([(2024, "1", 100, 0, 1), (2024, "1", 200, 0, 2), (2024, "2", 300, 0, 3)], "ano int, id string, v int, part int, off long")
    assert sorted(one(dedup.last_arrival(df, ["ano", "id"], ["part", "off"]), "v")) == [200, 300]


STATES = [("35", "SP", "São Paulo", "Sudeste"), ("33", "RJ", "Rio de Janeiro", "Sudeste")]


def test_state_enrichment(spark):
    states = spark.createDataFrame(STATES, "id_uf string, sigla string, nome string, regiao string")
    out = enrich.enrich_state_targets(spark.createDataFrame([("SP", 1.0), ("XX", 2.0), (None, 3.0)], "sigla_uf string, t double"), states)
    rows = {r.sigla_uf: r for r in out.collect()}
    assert (rows["SP"].nome_uf, rows["SP"].regiao_uf, rows["SP"]._join_match) == ("São Paulo", "Sudeste", True)
    assert rows["XX"].nome_uf is None and rows["XX"]._join_match is False and rows[None]._join_match is False
    with pytest.raises(ValueError, match="missing"):
        enrich.enrich_state_targets(out, states.drop("nome"))


def test_municipality_enrichment_keeps_unmatched_and_never_multiplies(spark):
    towns = spark.createDataFrame([("3550308", "São Paulo", "SP"), ("3550308", "Again", "SP")], "id_municipio string, nome string, sigla_uf string")
    out = enrich.enrich_municipality_targets(spark.createDataFrame([("3550308",), ("9999999",)], "id_municipio string"), towns)
    assert out.count() == 2 and {r.id_municipio: r._join_match for r in out.collect()} == {"3550308": True, "9999999": False}
    assert one(enrich.unmatched(out), "unmatched_rows") == [1]
    no_names = enrich.enrich_municipality_targets(out.select("id_municipio"), towns.select("id_municipio"))
    assert sorted(one(no_names, "_join_match")) == [False, True]


def test_prune_drops_lineage(spark):
    df = spark.createDataFrame([(1,) * 6], "ano int, id_aluno int, _kafka_offset int, _event_id int, _silver_x int, caderno int")
    assert enrich.prune(df, enrich.STUDENT_COLUMNS).columns == ["ano", "id_aluno", "_silver_x"]
    assert "caderno" in enrich.prune(df, enrich.STUDENT_COLUMNS, ("caderno",)).columns


def failing(spark, rows, schema, rule, references=None):
    checked = quality.check(spark.createDataFrame(rows, schema), [rule], references, "t")
    return checked.valid.count(), checked.quarantine.count()


def test_rules(spark):
    assert failing(spark, [(2024,), (None,)], "ano int", Rule("r", NOT_NULL, "ano")) == (1, 1)
    assert failing(spark, [(2024,)], "ano int", Rule("r", NOT_NULL, "absent")) == (0, 1)
    assert failing(spark, [("3550308",), ("invalid",), (" ",), (None,)], "id_municipio string", Rule("r", PATTERN, "id_municipio")) == (3, 1)
    assert failing(spark, [("x",)], "other string", Rule("r", PATTERN, "other")) == (1, 0)
    towns = {"municipio": spark.createDataFrame([("3550308",), (None,)], "id_municipio string")}
    fk = Rule("r", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio")
    assert failing(spark, [("3550308",), ("9999999",), (None,)], "id_municipio string", fk, towns) == (2, 1)
    assert failing(spark, [("9999999",)], "id_municipio string", fk) == (1, 0)
    assert failing(spark, [("9999999",)], "x string", fk, towns) == (0, 1)
    assert failing(spark, [(120.0,), (0.0,), (100.0,), (None,), (math.nan,)], "x double", Rule("r", RANGE, "x")) == (4, 1)
    assert failing(spark, [(120.0,)], "x double", Rule("r", RANGE, "absent")) == (1, 0)
    assert failing(spark, [(1,), (1,), (2,)], "x int", Rule("r", UNIQUE, columns=("x",))) == (1, 2)
    assert failing(spark, [(60.0, 39.5), (60.0, 30.0), (None, 1.0)], "a double, b double", Rule("r", SUM, columns=("a", "b"))) == (2, 1)
    assert failing(spark, [(1,)], "x int", Rule("r", "else", "x")) == (1, 0)
    assert failing(spark, [(1,)], "x int", Rule("r", NOT_NULL)) == (1, 0)


def test_quality_outputs(spark):
    rules = [Rule("a", NOT_NULL, "x", description="no x"), Rule("b", NOT_NULL, "y", description="no y"), Rule("c", NOT_NULL, "y")]
    checked = quality.check(spark.createDataFrame([(1, 1), (None, None), (1, None)], "x int, y int"), rules, quarantined_at="now")
    rows = {(r.x, r.y): r for r in checked.quarantine.collect()}
    assert rows[(None, None)]._quality_rule_ids == "a,b,c" and rows[(None, None)]._quality_messages == "no x | no y"
    assert rows[(1, None)]._quarantined_at == "now"
    assert {r.rule_id: r.failures for r in checked.counts.collect()} == {"a": 1, "b": 2, "c": 2}
    assert checked.totals.collect()[0] == (3, 2, pytest.approx(1 / 3))
    empty = quality.check(spark.createDataFrame([], "x int"), [rules[0]])
    assert empty.totals.collect()[0].pass_rate == 1.0
    none = quality.check(spark.createDataFrame([(1,)], "x int"), [])
    assert none.valid.count() == 1 and none.quarantine.count() == 0 and none.counts.count() == 0


STUDENTS = [(2024, "3550308", "1", "municipal", "Sim", 1.0, 800.0), (2024, "3550308", "2", "municipal", "Não", 1.0, 600.0), (2024, "3304557", "3", "municipal", "Sim", 2.0, 750.0), (2024, "3304557", "4", "estadual", None, 1.0, None)]
_S = "ano int, id_municipio string, id_aluno string, rede string, alfabetizado string, peso_aluno double, proficiencia double"


def test_local_and_state_indicator(spark):
    students = spark.createDataFrame(STUDENTS, _S)
    targets = spark.createDataFrame([(2024, "3550308", "municipal", "São Paulo", 55.0, 70.0, 100.0)], "ano int, id_municipio string, rede string, nome_municipio string, taxa_alfabetizacao double, meta_alfabetizacao_2024 double, meta_alfabetizacao_2030 double")
    towns = spark.createDataFrame([("3550308", "SP"), ("3304557", "RJ")], "id_municipio string, sigla_uf string")
    rows = {(r.id_municipio, r.rede): r for r in indicator.local_indicator(students, targets, towns).collect()}
    sp = rows[("3550308", "municipal")]
    assert (sp.total_alunos, sp.taxa_crianca_alfabetizada, sp.gap_taxa_vs_inep, sp.gap_meta_2024, sp.gap_meta_2030, sp.sigla_uf, sp.nome_municipio) == (2, 50.0, -5.0, -20.0, -50.0, "SP", "São Paulo")
    rj = rows[("3304557", "estadual")]
    assert rj.taxa_crianca_alfabetizada == 0.0 and rj.proficiencia_media_ponderada == 0.0 and rj.gap_meta_2024 is None
    state = spark.createDataFrame([(2024, "SP", "municipal", 50.0, 100.0)], "ano int, sigla_uf string, rede string, taxa_alfabetizacao double, meta_alfabetizacao_2030 double")
    found = {r.sigla_uf: r for r in indicator.state_indicator(students, towns, state).where("rede = 'municipal'").collect()}
    assert found["SP"].taxa_crianca_alfabetizada == 50.0 and found["SP"].gap_meta_2030 == -50.0
    with pytest.raises(ValueError):
        indicator.state_indicator(students, None, state)


def test_zero_weight_and_float_flags(spark):
    zero = spark.createDataFrame([("a", 1.0, 0.0)], "k string, alfabetizado double, peso_aluno double")
    row = indicator.aggregate(indicator.prepare(zero), ["k"]).collect()[0]
    assert row.total_alunos == 1 and row.taxa_crianca_alfabetizada is None
    flags = indicator.prepare(spark.createDataFrame([(1.0,), (0.0,)], "alfabetizado double"))
    assert sorted(one(flags, "_flag")) == [0.0, 1.0] and one(flags, "_weight") == [1.0, 1.0]
    only = indicator.prepare(spark.createDataFrame([("Sim",), (None,)], "alfabetizado string"), nulls_count=False)
    assert only.count() == 1


def test_upsert_semantics(spark, tmp_path):
    target = spark.createDataFrame([(2023, 1, "old", "keep"), (2024, 2, "old", "keep"), (None, 3, "old", "keep")], "ano int, id int, v string, p string")
    batch = spark.createDataFrame([(2024, 2, None, "lost", "n"), (2024, 9, "new", "own", "n"), (None, 3, "new", "own", "n")], "ano int, id int, v string, p string, extra string")
    rows = sorted(upsert.merged(target, batch, ["ano", "id"], ("p",)).collect(), key=str)
    assert sorted([tuple(r) for r in rows], key=str) == sorted([(2023, 1, "old", "keep", None), (2024, 2, None, "keep", "n"), (2024, 9, "new", "own", "n"), (None, 3, "old", "keep", None), (None, 3, "new", "own", "n")], key=str)
    guard = upsert.merged(target, batch.withColumn("v", F.lit("a")), ["ano", "id"], newer_than="v").where("id = 2").collect()[0]
    assert guard.v == "old"
    path = f"{tmp_path}/t"
    for _ in range(2):
        upsert.upsert_parquet(batch.where("ano is not null"), path, ["ano", "id"], [], partition_by="ano")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        upsert.upsert_parquet(batch, path, ["id"], [], partition_by="ano")


def test_reports(spark):
    df = spark.createDataFrame([("m", 2023, 10.0), ("m", 2024, 30.0)], "k string, ano int, r double")
    assert sorted(one(reports.trend(df, "r", ["k"], "ano"), "change"), key=str) == [20.0, None]
    assert one(reports.literate_by_score(spark.createDataFrame([(743.0,), (742.9,), (None,)], "p double"), "p"), "literate_by_score") == [True, False, None]
