"""Tables that grow, upserts into buckets, sized files, counts of the passes that write, and replays."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.operators import upsert
from stratakit.operators.quality import FOREIGN_KEY, NOT_NULL, RANGE, Rule, check, failures_of, metrics, metrics_of, written
from stratakit.sources import readers, schemas, sinks
from stratakit.streaming import events, jobs as stream_jobs
from tests.test_jobs import AT, GOOD, KEYS, SCHEMA, envelope, messages


def files(path):
    return {f"{os.path.relpath(d, path)}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-") and "_schema" not in d}


# ---- schemas ---------------------------------------------------------------


def test_wider_types(spark):
    of = T.StructType.fromDDL("a int, b long, c double, d float, e date, f timestamp, g timestamp_ntz, h string, i void, j array<int>")
    kind = {f.name: f.dataType for f in of}
    want = {"ab": "bigint", "ac": "double", "bd": "double", "ad": "double", "ef": "timestamp", "eg": "timestamp_ntz", "fe": "timestamp", "ah": "string", "ia": "int", "ai": "int", "aj": "string", "jj": "array<int>"}
    assert {k: schemas.wider(kind[k[0]], kind[k[1]]).simpleString() for k in want} == want
    assert schemas.united([T.StructType.fromDDL("x int not null, y string"), T.StructType.fromDDL("z date, x long")]) == T.StructType.fromDDL("x long, y string, z date")


def test_a_partition_with_more_columns_and_wider_numbers_is_read_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_table(spark.createDataFrame([(2023, 1, "x")], "ano int, n int, gone string"), path, "ano")
    sinks.write_table(spark.createDataFrame([(2024, 1 << 40, 1.5)], "ano int, n long, new double"), path, "ano")
    got = readers.read_bronze(spark, path)
    assert {tuple(sorted(r.asDict().items(), key=lambda x: x[0])) for r in got.collect()} == {
        (("ano", 2023), ("gone", "x"), ("n", 1), ("new", None)), (("ano", 2024), ("gone", None), ("n", 1 << 40), ("new", 1.5))}
    assert "PartitionFilters: [isnotnull(ano" in readers.read_bronze(spark, path, [2024])._jdf.queryExecution().toString()
    narrow = spark.createDataFrame([(2025, 3)], "ano int, n int")
    sinks.write_table(narrow, path, "ano")
    assert readers.read_silver(spark, path, [2025]).select("n", "new").collect() == [(3, None)]
    with pytest.raises(ValueError, match="column n is bigint"):
        sinks.write_table(spark.createDataFrame([(2026, "x")], "ano int, n string"), path, "ano")
    assert readers.read_bronze(spark, path).count() == 3


def test_fragments_without_a_kept_schema(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(1, "a")], "n int, s string").write.parquet(f"{path}/ano=2023")
    spark.createDataFrame([("x", 2.0)], "n string, d double").write.parquet(f"{path}/ano=2024")
    got = readers.read_bronze(spark, path).select("ano", "n", "s", "d")
    assert sorted(map(tuple, got.collect())) == [(2023, "1", "a", None), (2024, "x", None, 2.0)]
    assert readers.read_bronze(spark, f"{tmp_path}/absent").columns == [] and schemas.table_or_none(spark, f"{tmp_path}/absent") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_silver(spark, f"{tmp_path}/absent")


# ---- scans and files -------------------------------------------------------


def test_years_reach_the_scan_as_ranges_of_the_date(spark, tmp_path):
    rows = [(k, f"{1995 + k}-{m:02d}-{d:02d}") for k in range(6) for m, d in ((1, 1), (12, 31))]
    spark.createDataFrame(rows, "k int, s string").select("k", F.to_date("s").alias("d"), F.to_timestamp(F.concat("s", F.lit(" 23:59:59"))).alias("t")).write.parquet(f"{tmp_path}/t")
    table, width = spark.read.parquet(f"{tmp_path}/t"), spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for c in ("d", "t"):
        found = readers.scan(table, ["k"], [1996, 1999, 1997, 1997], date_column=c)
        pushed = found._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("\n")[0]
        assert pushed.count("GreaterThanOrEqual") == pushed.count("LessThan(") == 2 and "1998-01-01" in pushed
        assert sorted(r.k for r in found.collect()) == [1, 1, 2, 2, 4, 4]
    spark.conf.set("spark.sql.maxMetadataStringLength", width)
    assert readers.scan(table, ["k"], None, date_column="d").count() == 12
    by_date = readers.read_source(spark, f"{tmp_path}/t", None, [2000], date_column="d")
    assert [r.k for r in by_date.collect()] == [5, 5]


def test_files_of_a_partitioned_write_are_of_even_size(spark, tmp_path):
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    rows = spark.range(400_000, numPartitions=40).select(F.when(F.col("id") % 10 == 0, F.col("id") % 4 + 2000).otherwise(2024).cast("int").alias("ano"), F.rand(1).alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    try:
        for k, v in zip(held, ("4m", "64")):
            spark.conf.set(k, v)
        assert sinks.write_counted(rows, f"{tmp_path}/t", "ano", counts={"low": F.count_if(F.col("x") < 0)}) == {"rows": 400_000, "low": 0}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    by_year = {}
    for f in files(f"{tmp_path}/t"):
        by_year.setdefault(f.split("/")[0], []).append(os.path.getsize(f"{tmp_path}/t/{f}"))
    hot = by_year.pop("ano=2024")
    assert 3 <= len(hot) <= 20 and max(hot) < 8e6 and all(len(x) <= 2 for x in by_year.values())
    twice = sinks.rebalanced(sinks.rebalanced(rows, "ano"), "ano")
    assert twice._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


# ---- upserts ---------------------------------------------------------------


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["ano", "id"]
    base = spark.range(400).select((F.col("id") % 2 + 2023).cast("int").alias("ano"), F.col("id"), F.lit("old").alias("v"))
    upsert.upsert_parquet(base, path, keys, [], (), "ano", buckets=8)
    before = files(path)
    assert len({os.path.dirname(f) for f in before}) == 16
    upsert.upsert_parquet(spark.createDataFrame([(2024, 7, "new", 1)], "ano int, id int, v string, more int"), path, keys, [], (), "ano", buckets=8)  # a narrower key
    after = files(path)
    assert len({os.path.dirname(f) for f in after - before}) == len({os.path.dirname(f) for f in before - after}) == 1
    got = readers.read_silver(spark, path, None)
    assert got.columns == ["id", "v", "more", "ano"] and got.count() == 400 and got.where("v = 'new'").collect() == [(7, "new", 1, 2024)]
    for n in (4, None):
        with pytest.raises(ValueError, match="buckets"):
            upsert.upsert_parquet(base, path, keys, [], (), "ano", buckets=n)
    upsert.rebucket(spark, path, keys, f"{tmp_path}/u", "ano", 4)
    upsert.upsert_parquet(spark.createDataFrame([(2023, 8, "newer")], "ano int, id long, v string"), f"{tmp_path}/u", keys, [], (), "ano", buckets=4)
    assert {r.v: r["count"] for r in readers.read_silver(spark, f"{tmp_path}/u", None).groupBy("v").count().collect()} == {"old": 398, "new": 1, "newer": 1}


def test_buckets_without_years_and_null_years(spark, tmp_path):
    for part, name in ((None, "a"), ("ano", "b")):
        path = f"{tmp_path}/{name}"
        for v in ("x", "y"):
            upsert.upsert_parquet(spark.createDataFrame([(2024, 1, v), (None, 2, v)], "ano int, id long, v string"), path, ["id"] if part is None else ["ano", "id"], [], (), part, buckets=3)
        got = sorted((r.id, r.v) for r in readers.read_silver(spark, path, None).collect())
        # a null key matches nothing, so it comes once a batch
        assert got == ([(1, "y"), (2, "y")] if part is None else [(1, "y"), (2, "x"), (2, "y")])


# ---- counts of the passes that write ---------------------------------------


def test_counts_equal_those_of_an_aggregation(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, 500.0), (3, None, 7.0), (4, "zz", -1.0)], "id int, k string, x double")
    rules = (Rule("k_there", NOT_NULL, "k"), Rule("x_range", RANGE, "x"), Rule("k_known", FOREIGN_KEY, "k", reference="ref.k"))
    checked = check(df, rules, {"ref": spark.createDataFrame([("a",)], "k string")}, AT)
    good = sinks.write_silver(checked.valid, f"{tmp_path}/s", "b", AT)
    bad = sinks.write_quarantine(checked.quarantine, f"{tmp_path}/q", "b", "silver", checked.failures_in_quarantine)
    done = {"e": written(checked, good, bad)}
    assert metrics_of(spark, done).collect() == metrics({"e": checked}).collect() == [("e", 1, 3, 0.25)]
    assert failures_of(spark, done).drop("entity").collect() == checked.counts.collect() == [("k_there", 2), ("x_range", 2), ("k_known", 1)]
    empty = check(df.limit(0), rules, {}, AT)
    none = sinks.write_quarantine(empty.quarantine, f"{tmp_path}/q", "c", "silver", empty.failures_in_quarantine)
    assert none == {"rows": 0, "k_there": 0, "x_range": 0, "k_known": 0} and readers.read_silver(spark, f"{tmp_path}/q", None).count() == 3
    assert metrics_of(spark, {}).collect() == [] == failures_of(spark, {}).collect()


def test_rules_that_cannot_act_are_warned_of(spark, caplog):
    df = spark.createDataFrame([(1,)], "id int")
    with caplog.at_level("WARNING"):
        assert check(df, (Rule("odd", "outro", "id"), Rule("bare", NOT_NULL))).valid.count() == 1
    assert [r.args[0] for r in caplog.records if r.name.endswith("quality")] == ["odd", "bare"]


# ---- streams ---------------------------------------------------------------


def test_whole_numbers_of_a_payload_keep_all_digits(spark):
    schema = T.StructType().add("ano", "integer").add("id_aluno", "string").add("n", "long").add("m", "short")
    bodies = [{"n": 9007199254740993, "m": 7.0}, {"n": "9223372036854775807", "m": "12.0"}, {"n": 1e3, "m": 70000}, {"n": "x", "m": None}, {"n": 1e30}]
    sent = [envelope(json.dumps({"ano": 2024, "id_aluno": "a", **b})) for b in bodies]
    valid, _ = events.parse(messages(spark, sent), schema, KEYS, AT)
    assert [(r.n, r.m) for r in valid.orderBy("_kafka_offset").collect()] == [(9007199254740993, 7), (9223372036854775807, 12), (1000, None), (None, None), (None, None)]


def test_extra_keys_from_the_parsed_payload(spark):
    body = {**GOOD, "t": "ü\"", "n": 5, "f": 1.5, "b": True, "z": None, "o": {"k": [1, "x"]}, "l": [1, None]}
    valid, _ = events.parse(messages(spark, [envelope(json.dumps(body)), envelope(json.dumps({"ano": 2024, "id_aluno": "a"}))]), SCHEMA, KEYS, AT)
    first, second = (r._extra for r in valid.orderBy("_kafka_offset").collect())
    assert json.loads(first) == {"caderno": "1", "t": "ü\"", "n": "5", "f": "1.5", "b": "true", "z": None, "o": '{"k":[1,"x"]}', "l": "[1,null]"} or "z" not in json.loads(first)
    assert second is None
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan.lower() and "jsontostructs" not in plan.lower()


def test_a_replayed_batch_keeps_its_time_and_metrics_have_a_row_a_batch(spark, tmp_path):
    sent = [envelope(json.dumps({**GOOD, "id_aluno": str(k % 3), "id_municipio": f"355030{k % 2}"})) for k in range(6)] + [b"{bad", None]
    towns = spark.createDataFrame([("3550300",)], "id_municipio string")
    rules = (Rule("fk", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio"),)
    at = lambda n: f"{tmp_path}/{n}"
    tables = stream_jobs.StreamTables(at("bronze"), at("silver"), at("quarantine"), SCHEMA, KEYS, rules, rejects=at("rejects"), buckets=4, metrics=at("metrics"))
    clock = iter("abcdefgh")
    write = stream_jobs.batch_writer(tables, lambda: {"municipio": towns}, "s", lambda: next(clock), at("times"))
    states = []
    for number in (0, 0, 1, 0):
        write(messages(spark, sent if number == 0 else []), number)
        read = [readers.read_silver(spark, getattr(tables, n), None) for n in ("bronze", "silver", "quarantine", "rejects")]
        states.append([sorted(map(str, df.collect())) for df in read])
    assert states[0] == states[1] == states[3] and "_ingestion_timestamp='a'" in states[0][0][0]
    (row,) = stream_jobs.batch_metrics(spark, tables.metrics).collect()
    # of each of three students the last arrival counts: towns 3550301, 3550300, 3550301
    assert row.asDict() == {"batch": "s-0", "at": "a", "messages": 8, "parsed_rows": 6, "rejected_rows": 2, "valid_rows": 1, "quarantined_rows": 2, "pass_rate": 1 / 3}


# ---- foreign keys ----------------------------------------------------------


def test_a_hot_foreign_key_is_split_where_the_reference_is_too_large_to_copy(spark):
    """Both sides only move by the key, so Spark may cut the hot key's rows into several tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ref = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
        rows = spark.range(300_000, numPartitions=12).select(F.when(F.col("id") % 3 > 0, "k1").otherwise(F.concat(F.lit("k"), (F.col("id") % 30_000).cast("string"))).alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
        checked = check(rows, (Rule("fk", FOREIGN_KEY, "k", reference="ref.k"),), {"ref": ref})
        seen = checked.quarantine.select("id", "s")
        assert len(seen.collect()) == 33_330
        assert "skew=true" in seen._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
