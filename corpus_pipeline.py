"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``documents``. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import line_dedup, mixing, near_dedup, packing, quality
from feedloom.llm.common import drop_saved, saved, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.classify(docs).where(~F.col("rejected")).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites, whatever share of the document they
    are; documents of nothing else are left to the near-duplicates. n_chars follows the text."""
    out = line_dedup.remove_boilerplate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                                         .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixture(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", keep_good), ("line dedup", drop_boilerplate), ("near-duplicates", drop_copies),
          ("source mix", mix_sources), ("packing", pack_sequences)]

#: The classifier and the signatures have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"stage-{i}")
            if before is not None:
                drop_saved(before)
            before = docs
    return docs
