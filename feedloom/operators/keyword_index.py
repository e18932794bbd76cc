"""An inverted index of trigrams for keyword searches (Q1, Q14, Q15) over large tables.

Texts are folded (case and accents) and cut into runs without ASCII punctuation and blanks; a
keyword that occurs in a text occurs in one of these runs, so every trigram of the keyword's own
runs is a trigram of the text. ``postings/bucket=<b>`` holds (gram, id) sorted by gram, so a
search opens the folders of its grams' buckets only and Parquet's statistics skip the rest;
``grams`` holds how many rows have each gram. A search intersects the postings of its rarest
grams, and only those candidates are confirmed on the whole text.

Texts are read once to build the index; postings are distinct per row before they are shuffled,
and the posting list of a gram that most rows have is split over files. Null texts and null
ids have no postings. Ids should be unique: rows that share one are confirmed one by one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .query import andmatch, fold, search_q

#: ASCII that is neither letter, digit nor underscore ends a run.
_BREAK = r"[\x00-\x2f\x3a-\x40\x5b-\x5e\x60\x7b-\x7f]+"
GRAM = 3
#: Grams whose postings are intersected: more read more and prune little.
MOST_GRAMS = 4
#: Parts of a bucket at least, by id; more if there are more shuffle partitions than these give.
CUTS = 4


def grams(text) -> Column:
    """The distinct trigrams of the runs of a folded text."""
    runs = F.array_distinct(F.split(fold(text), _BREAK))
    of_run = F.transform(runs, lambda r: F.transform(
        F.when(F.length(r) >= GRAM, F.sequence(F.lit(1), F.length(r) - (GRAM - 1))).otherwise(F.array().cast("array<int>")),
        lambda i: F.substr(r, i, F.lit(GRAM))))
    return F.array_distinct(F.flatten(of_run))


def _bucket(gram, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def write_index(df: DataFrame, id: str, text: str, path: str, buckets: int = 64) -> None:
    """Write the index of ``text`` by ``id`` to ``path``."""
    rows = df.where(F.col(id).isNotNull() & F.col(text).isNotNull()).select(F.col(id).alias("id"), F.explode(grams(text)).alias("gram"))
    # a bucket is cut by the ids, so a gram that most rows have is split as well; ranges of (gram, id)
    # would need samples, and for them all texts a second time
    placed = rows.withColumn("bucket", _bucket("gram", buckets))
    parts = max(CUTS, -(-2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets))
    placed = placed.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(parts)))
    placed.sortWithinPartitions("bucket", "gram", "id").write.partitionBy("bucket").parquet(f"{path}/postings")
    spark = df.sparkSession
    postings = spark.read.schema(placed.schema).parquet(f"{path}/postings")
    postings.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), F.first("bucket").alias("bucket")).orderBy("gram").write.parquet(f"{path}/grams")


def rarest(spark: SparkSession, path: str, keywords: Sequence[str]) -> list[tuple[str, int]] | None:
    """(gram, bucket) of the least frequent trigrams of the keywords, empty if none has any;
    None if some trigram is in no row, so nothing can match. Reads a row per trigram asked for."""
    folded = spark.range(1).select(F.array(*[F.lit(k) for k in keywords]).cast("array<string>").alias("k"))
    asked = sorted(folded.select(F.array_distinct(F.flatten(F.transform("k", grams)))).first()[0]) if keywords else []
    if not asked:
        return []
    known = spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(asked)).collect()
    if len(known) < len(asked):
        return None
    return [(r["gram"], r["bucket"]) for r in sorted(known, key=lambda r: (r["rows"], r["gram"]))[:MOST_GRAMS]]


def candidates(df: DataFrame, id: str, path: str, keywords: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that hold the rarest trigrams of the keywords; all rows if no keyword is
    three characters long."""
    spark = df.sparkSession
    found = rarest(spark, path, keywords)
    if found is None:
        return df.where(F.lit(False))
    if not found:
        return df
    postings = spark.read.schema(T.StructType([T.StructField("id", df.schema[id].dataType), T.StructField("gram", T.StringType()),
                                               T.StructField("bucket", T.IntegerType())])).parquet(f"{path}/postings").where(
        F.col("bucket").isin(sorted({b for _, b in found})) & F.col("gram").isin([g for g, _ in found]))
    ids = postings.groupBy(F.col("id").alias(id)).agg(F.countDistinct("gram").alias("n")).where(F.col("n") == len(found)).select(id)
    return df.join(ids, id, "left_semi")


def indexed_search_q(df: DataFrame, id: str, text: str, path: str, q: str | None) -> DataFrame:
    """Q1 through the index."""
    return search_q(candidates(df, id, path, (q or "").split()), q, text)


def indexed_andmatch(df: DataFrame, id: str, text: str, path: str, kw: str | None, n: int | None = None) -> DataFrame:
    """Q14 through the index, or Q15 with only the first ``n`` characters of the keywords."""
    kw = (kw or "") if n is None else (kw or "")[:n]
    return andmatch(candidates(df, id, path, [t for t in re.split(r"\W+", kw) if t]), text, kw)
