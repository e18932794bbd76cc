"""Searches through the trigram index return what the plain searches do and read less."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import keyword_index as K
from feedloom.operators import query as Q


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(2)
    pieces = ["Été", "ete", "été", "S01E02", "x264", "straße", "Жук", "жук", "foo_bar", "foo-bar", "the", "theatre", "of", "ø", "日本語", "Kelvin",
              "a.b", "l'été", "  ", "\n", "émentère"]
    rows = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))), "x") for i in range(400)]
    rows += [(400, None, "x"), (401, "", "x"), (None, "theatre", "x"), (402, "common " * 2000, "x"), (5, "theatre again", "x")]
    df = spark.createDataFrame(rows, "k long, t string, gram string")
    path = str(tmp_path_factory.mktemp("index"))
    K.write_index(df, "k", "t", path, buckets=8)
    return df, path


@pytest.mark.parametrize("kw", ["ETE", "été theatre", "s01e02 x264", "foo_bar", "foo-bar", "ße", "strasse", "ЖУК", "ж", "kelvin", "日本語", "", None, "no such thing",
                                "ementere the", "a.b", "l'ete", "of", "common"])
def test_same_rows_as_without_index(spark, indexed, kw):
    df, path = indexed
    given = df.where("k IS NOT NULL")
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(K.indexed_andmatch(given, "k", "t", path, kw)) == rows(Q.andmatch(given, "t", kw))
    assert rows(K.indexed_andmatch(given, "k", "t", path, kw, 4)) == rows(Q.andmatch_prefix(given, "t", kw, 4))
    assert rows(K.indexed_search_q(given, "k", "t", path, kw)) == rows(Q.search_q(given, kw, "t"))


def test_search_opens_the_buckets_of_its_grams(spark, indexed):
    df, path = indexed
    plan = K.indexed_andmatch(df, "k", "t", path, "theatre")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(gram" in plan
    assert len(K.rarest(spark, path, ["theatre"])) == K.MOST_GRAMS and K.rarest(spark, path, ["qqqq"]) is None
    assert K.rarest(spark, path, ["th"]) == []


def test_a_common_gram_is_split_over_files(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit("same words").alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.write_index(df, "k", "t", str(tmp_path / "i"), buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spread = spark.read.parquet(str(tmp_path / "i/postings")).where("gram = 'ame'").select(F.input_file_name()).distinct().count()
    assert spread > 1
    assert K.indexed_andmatch(df, "k", "t", str(tmp_path / "i"), "SAME").count() == 5000
    empty = df.limit(0)
    K.write_index(empty, "k", "t", str(tmp_path / "e"))
    assert K.indexed_andmatch(df, "k", "t", str(tmp_path / "e"), "SAME").count() == 0
    assert K.indexed_andmatch(df, "k", "t", str(tmp_path / "e"), "x").count() == 0


def test_texts_are_read_once_to_place_their_grams(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(300).selectExpr("id AS k", "concat('word', id) AS t").mapInArrow(count, "k long, t string")
    K.write_index(df, "k", "t", str(tmp_path / "i"), buckets=4)
    assert seen.value == 300
    assert K.indexed_andmatch(df, "k", "t", str(tmp_path / "i"), "word299").count() == 1
