"""Tables, jobs and streams on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.operators import upsert
from stratakit.operators.quality import FOREIGN_KEY, NOT_NULL, Rule
from stratakit.plans import config, jobs
from stratakit.sources import readers, sinks
from stratakit.streaming import events, jobs as stream_jobs

AT = "2024-01-01T00:00:00+00:00"
SCHEMA = T.StructType().add("ano", "integer").add("id_aluno", "string").add("id_municipio", "string")
KEYS = ("ano", "id_aluno")


def envelope(payload, **more):
    return json.dumps({"event_id": "e1", "event_type": "t", "event_timestamp": "x", "payload": payload, **more}).encode()


GOOD = {"ano": 2024, "id_aluno": "a", "id_municipio": "3550308", "caderno": "1"}
CASES = [
    (envelope(json.dumps(GOOD)), None),
    (envelope(GOOD), None),
    (envelope(json.dumps({"id_aluno": "a"}), ano=2024), None),
    (None, events.EMPTY),
    (b"\xc3\x28", events.UNDECODABLE),
    (b"{bad", events.BAD_ENVELOPE),
    (b"[1]", events.ENVELOPE_SHAPE),
    (envelope(json.dumps(GOOD), event_id=0), events.MISSING_FIELDS),
    (envelope(json.dumps(GOOD), event_id=""), events.MISSING_FIELDS),
    (envelope(json.dumps(GOOD), event_id="0"), None),
    (envelope(None), events.MISSING_FIELDS),
    (envelope("{bad"), events.BAD_PAYLOAD),
    (envelope("[1]"), events.PAYLOAD_SHAPE),
    (envelope(7), events.PAYLOAD_SHAPE),
    (envelope(json.dumps({"ano": 2024})), events.MISSING_KEYS),
    (envelope(json.dumps({"id_aluno": "a", "ano": "x"})), events.MISSING_KEYS),
]


def messages(spark, values):
    rows = [(bytearray(v) if v is not None else None, "topic", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")


def test_dead_letter_classes(spark):
    done = events.classified(messages(spark, [v for v, _ in CASES]), KEYS)
    assert [r._rule for r in done.orderBy("offset").collect()] == [rule for _, rule in CASES]
    valid, rejected = events.parse(messages(spark, [v for v, _ in CASES]), SCHEMA, KEYS, AT)
    first = valid.orderBy("_kafka_offset").collect()
    assert (first[0].ano, first[0].id_aluno, first[0]._extra, first[0]._event_id) == (2024, "a", '{"caderno":"1"}', "e1")
    assert first[2].ano == 2024 and "_kafka_topic" not in valid.columns
    assert rejected.count() == sum(rule is not None for _, rule in CASES)
    assert {r._dlq_reason for r in rejected.collect()} <= set(events.REASONS.values())


def test_encode_fills_year_only_inside_payload(spark):
    rows = spark.createDataFrame([("a", None), ("b", 2023)], "id_aluno string, ano int")
    out = [json.loads(bytes(r.value)) for r in events.encode(rows, F.lit("e"), "t", F.lit("x"), year=F.lit(2024)).collect()]
    assert [json.loads(e["payload"])["ano"] for e in out] == [2024, 2023] and "ano" not in out[0]


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    first = [envelope(json.dumps({**GOOD, "id_aluno": str(k % 5), "id_municipio": f"355030{k}"})) for k in range(8)]
    messages(spark, first).coalesce(1).write.parquet(f"{tmp_path}/topic")
    towns = spark.createDataFrame([(f"355030{k}",) for k in range(7)], "id_municipio string")
    rules = (Rule("fk", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio"),)
    tables = stream_jobs.StreamTables(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/quarantine", SCHEMA, KEYS, rules, rejects=f"{tmp_path}/rejects")
    seen = []
    for run in range(2):
        source = readers.read_file_stream(spark, f"{tmp_path}/topic", messages(spark, []).schema)
        stream_jobs.run_stream(source, tables, lambda: {"municipio": towns}, f"{tmp_path}/checkpoint{run}", "s", lambda: AT).awaitTermination()
        seen.append(sorted((r.id_aluno, r.id_municipio) for r in spark.read.parquet(tables.silver).collect()))
        assert spark.read.parquet(tables.bronze).count() == 5
        assert spark.read.parquet(tables.quarantine).count() == 1
    assert seen[0] == seen[1] == [("0", "3550305"), ("1", "3550306"), ("3", "3550303"), ("4", "3550304")]


def test_missing_sources_are_empty_and_strict_reads_raise(spark, tmp_path):
    assert readers.read_bronze(spark, f"{tmp_path}/none", schema="ano int").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_silver(spark, f"{tmp_path}/none")
    assert sinks.write_table(spark.createDataFrame([], "a int"), f"{tmp_path}/nothing") is False
    with pytest.raises(ValueError, match="missing"):
        sinks.bronze_rows(spark.createDataFrame([(1,)], "a int"), "s", "b", AT, ("b",))


def test_ingest_skips_absent_sources_and_reports_failures(spark, tmp_path):
    run, seen = jobs.Run("b1", AT, years=(2024,), limit=5), []
    sources = {n: f"{tmp_path}/none/{n}" for n in config.BATCH_SOURCES}
    counts = jobs.measured_ingest(spark, sources, f"{tmp_path}/bronze", run, lambda m: seen.append(m.first()), iter((1.0, 3.5)).__next__)
    assert {(r.records, r.written) for r in counts.collect()} == {(0, False)}
    assert (seen[0].sources_empty, seen[0].total_records, seen[0].duration_seconds, seen[0].job_failure) == (5, 0, 2.5, 0)
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_path}/none/uf")
    with pytest.raises(ValueError, match="columns missing"):
        jobs.measured_ingest(spark, sources, f"{tmp_path}/bronze", run, lambda m: seen.append(m.first()))
    assert seen[1].job_failure == 1 and seen[1].duration_seconds > 0


def test_references_that_cannot_be_read_are_left_out(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/a")
    assert readers.load_references(spark, {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"}).keys() == {"a"}


def test_upsert_leaves_no_staged_copy(spark, tmp_path):
    upsert.upsert_parquet(spark.createDataFrame([(1, 2)], "a int, b int"), f"{tmp_path}/t", ["a"], [])
    assert list((tmp_path / "t_staging").iterdir()) == [] and spark.read.parquet(f"{tmp_path}/t").count() == 1


def test_scan_prunes_partitions(spark, tmp_path):
    spark.createDataFrame([(2023, 1), (2024, 2)], "ano int, v int").write.partitionBy("ano").parquet(f"{tmp_path}/t")
    df = readers.read_silver(spark, f"{tmp_path}/t", [2024])
    assert [r.v for r in df.collect()] == [2]
    assert "PartitionFilters: [isnotnull(ano" in df._jdf.queryExecution().toString() or "PartitionFilters: [ano" in df._jdf.queryExecution().toString()
    assert readers.scan(df, ["v"], limit=0).count() == 1 and readers.scan(df, limit=-1, extra="v > 5").count() == 0


def test_overwrite_replaces_only_its_years(spark, tmp_path):
    write = lambda year, v: sinks.write_table(spark.createDataFrame([(year, v)], "ano int, v int"), f"{tmp_path}/t", "ano")
    write(2023, 1), write(2024, 2), write(2024, 3)
    assert sorted((r.ano, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(2023, 1), (2024, 3)]


def test_quarantine_rerun_replaces_its_batch(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    for batch in ("b1", "b1", "b2"):
        sinks.write_quarantine(df, f"{tmp_path}/q", batch, "silver")
    assert readers.read_silver(spark, f"{tmp_path}/q", None).count() == 2


def test_years_of_a_run():
    assert jobs.parsed_years("2024, 2023,2024") == (2023, 2024) and jobs.parsed_years("all") is None and jobs.parsed_years(None) is None
    with pytest.raises(ValueError, match="not years"):
        jobs.parsed_years("2024,x")


def test_batch_jobs_from_sources_to_gold(spark, tmp_path):
    """Sources to Bronze to Silver to Gold, then the same batch again."""
    frames = {
        "uf": spark.createDataFrame([("35", "SP", "São Paulo", "Sudeste"), ("99", None, "x", "y")], "id_uf string, sigla string, nome string, regiao string"),
        "municipio": spark.createDataFrame([("3550308", "São Paulo", "SP"), ("bad", "x", "SP")], "id_municipio string, nome string, sigla_uf string"),
        "meta_brasil": spark.createDataFrame([(2024, "municipal", 60.0)], "ano int, rede string, taxa_alfabetizacao double"),
        "meta_uf": spark.createDataFrame([(2024, "sp", "Municipal", 55.0, 60.0), (2024, "XX", "municipal", 1.0, 1.0)], "ano int, sigla_uf string, rede string, taxa_alfabetizacao double, meta_alfabetizacao_2024 double"),
        "meta_municipio": spark.createDataFrame([(2024, "3550308.0", "Municipal", 55.0, 70.0), (2023, "3550308", "municipal", 1.0, 1.0)], "ano int, id_municipio string, rede string, taxa_alfabetizacao double, meta_alfabetizacao_2024 double"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/source/{name}")
    run = jobs.Run("b1", AT, years=(2024,))
    students = spark.createDataFrame([(2024, "1", "3550308", "Municipal", "Sim", 1.0, 800.0, "t1"), (2024, "1", "3550308", "Municipal", "Não", 1.0, 700.0, "t2"), (2024, "2", "9999999", "municipal", "Sim", 1.0, 1.0, "t1")], "ano int, id_aluno string, id_municipio string, rede string, alfabetizado string, peso_aluno double, proficiencia double, _ingestion_timestamp string")
    for _ in range(2):
        counts = {r.source: r.records for r in jobs.ingest(spark, {n: f"{tmp_path}/source/{n}" for n in frames}, f"{tmp_path}/bronze", run).collect()}
        assert counts == {"uf": 2, "municipio": 2, "meta_brasil": 1, "meta_uf": 2, "meta_municipio": 1}
        sinks.write_table(students, f"{tmp_path}/bronze/alunos", "ano")
        rates = {r.entity: (r.valid_rows, r.quarantined_rows) for r in jobs.silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/quarantine", run).collect()}
        assert rates == {"uf": (1, 1), "municipio": (1, 1), "meta_brasil": (1, 0), "meta_uf": (1, 1), "meta_municipio": (1, 0), "alunos": (1, 1)}
        assert {r.entity: r.valid_rows for r in jobs.gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", f"{tmp_path}/quarantine", run).collect()} == {"indicador_crianca_alfabetizada_municipio": 1, "indicador_crianca_alfabetizada_uf": 1}
    town = spark.read.parquet(f"{tmp_path}/gold/indicador_crianca_alfabetizada_municipio").collect()
    assert [(r.taxa_crianca_alfabetizada, r.gap_taxa_vs_inep, r.gap_meta_2024, r.sigla_uf, r.nome_municipio) for r in town] == [(0.0, -55.0, -70.0, "SP", "São Paulo")]
    assert spark.read.parquet(f"{tmp_path}/quarantine/alunos").count() == 1


def test_names_and_references(spark):
    assert jobs.selected("all", ["a", "b"]) == ["a", "b"] and jobs.selected("b", ["a", "b"]) == ["b"]
    with pytest.raises(ValueError, match="unknown"):
        jobs.selected("c", ["a"])
    rows = spark.createDataFrame([(2024, "1", "3550308", "x")], "ano int, id_aluno string, id_municipio string, rede string")
    with pytest.raises(ValueError, match="references missing"):
        jobs.to_silver(rows, config.ALUNOS, {}, jobs.Run("b", AT))
    assert jobs.to_silver(rows, config.ALUNOS, {}, jobs.Run("b", AT, lean=True)).valid.count() == 1
    assert sum(len(e.rules) for e in config.ENTITIES.values()) == 15 and all(r.kind != NOT_NULL or r.column for e in config.ENTITIES.values() for r in e.rules)
