"""Steps whose time has to stay in proportion to their input."""

import re

import pytest
from stratakit.functions import scalars as S
from stratakit.operators.dedup import latest
from stratakit.plans import queries
from tests.conftest import SF_DIR


def test_a_topic_is_written_and_read_by_several_tasks(spark, tmp_path):
    rows = queries.messages(spark, SF_DIR)
    queries.topic(rows, f"{tmp_path}/topic")
    assert len(list((tmp_path / "topic").glob("*.parquet"))) == queries.TOPIC_FILES
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/topic").collect())) == sorted(map(repr, rows.collect()))


@pytest.mark.parametrize("query", ["stream_quarantine", "stream_bronze_silver"])
def test_streams_take_their_topic_in_one_batch_of_several_files(spark, query, monkeypatch):
    files, real = [], queries.topic
    monkeypatch.setattr(queries, "topic", lambda rows, path: (real(rows, path), files.append(len(spark.read.parquet(path).inputFiles()))))
    assert queries.QUERIES[query](spark, SF_DIR).count() > 0
    assert files == [queries.TOPIC_FILES]


def test_dedup_sorts_by_a_hash_of_the_key_first(spark):
    df = spark.createDataFrame([(2020, "a", 1), (2020, "a", 2), (2020, None, 3), (None, None, 4), (None, None, 5)], "ano int, id string, _ingestion_timestamp int")
    found = latest(df, ["ano", "id"])
    assert found.columns == df.columns and {tuple(r) for r in found.collect()} == {(2020, "a", 2), (2020, None, 3), (None, None, 5)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Sort \[_hash#", plan)


ODD = ["", " ", "\t\n", " a ", "a b", "\x0b a\f\r", " a ", "1234567", "12345678", " 1234567", "1234567\n", "123", "12.0", "1234567.0", "x", "12a", "-5", "Ünï ", "é", "NaN", " None\t", "null", "<NA>", "٣٣٣٣٣٣٣", None]


def test_cleaned_texts_and_codes_are_those_of_regular_expressions(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "x string")
    got = df.select("x", S.text_of("x").alias("text"), S.padded_code("x").alias("code"), S.lower_clean("x").alias("low"), S.upper_clean("x").alias("up")).collect()
    for r in got:
        text = None if r.x is None else re.sub(r"^\s+|\s+\Z", "", r.x, flags=re.ASCII)
        digits = "" if text is None else re.sub(r"[^0-9]", "", re.sub(r"\.0\Z", "", text))
        word = None if text is None or text.lower() in S.NULL_WORDS else text
        assert (r.text, r.code, r.low, r.up) == (text, digits.zfill(7) if digits else None, word and word.lower(), word and word.upper())


def test_a_code_in_its_form_is_left_by_the_first_branch(spark):
    df = spark.createDataFrame([("0000001",)], "x string").select(S.padded_code("x").alias("x"))
    assert r"\A[0-9]{7,}\z" in df._jdf.queryExecution().analyzed().toString() and df.first().x == "0000001"
