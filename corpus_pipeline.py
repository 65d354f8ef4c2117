"""From documents to token ids: quality rules, line dedup, near duplicates, source mix, SentencePiece.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the columns of
documents. Rows are told apart by 128 bits of hash of all their columns and of which of them are null, so null or repeated ids and
repeated rows are no trouble: equal rows share every decision, others none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import jaccard, lines, mixing, outliers, pieces
from ledgerlens.llm.common import documents, saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "piece_bpe_32k.model"


def _key() -> Column:
    # The hash skips nulls, so it also gets which columns are null.
    null = [F.col(c).isNull() for c in COLUMNS]
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(n), *null, *COLUMNS)), 16, "0") for n in (1, 2)]).alias("key")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rules or the outlier test reject."""
    keyed = docs.select(_key(), *COLUMNS)
    rejected = outliers.quality(keyed, id_col="key").where(~F.col("kept")).select("key").distinct()
    return keyed.join(rejected, "key", "left_anti").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that too many documents of their source hold; n_chars follows the text."""
    left = lines.drop_boilerplate(docs.select(COLUMNS), "source", "text")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates; texts without words are in no group."""
    keyed = docs.select(F.struct("doc_id", _key()).alias("id"), _key(), *COLUMNS)
    found = jaccard.near_duplicates(keyed, id_col="id")
    first = found.where(F.col("component_id").eqNullSafe(F.col("id"))).select("id.key", (F.col("n_shingles") > 0).alias("grouped")).distinct()
    kept = keyed.drop("id").join(first, "key")
    # Repeated rows have one key, and one of them stays.
    return kept.where("grouped").dropDuplicates(["key"]).union(kept.where("not grouped")).select(COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, to the nearest whole number; documents that it does not take go."""
    keyed = docs.select(_key(), *COLUMNS)
    taken = mixing.mix(keyed, id_col="key").groupBy("key").agg(F.max("taken").alias("taken"), F.max("size").alias("size"))
    copies = taken.where("size > 0").select("key", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("copies")).where("copies > 0")
    return keyed.join(copies, "key").select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: doc_id, lang, source, n_tokens, ids and whether they decode to the text."""
    rows = docs.select(F.struct("doc_id", "lang", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")).alias("id"), "text")
    coded = pieces.encode(rows, public_tokenizers.path(TOKENIZER), id_col="id")
    return coded.select("id.doc_id", "id.lang", "id.source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.xxhash64("decoded") == F.col("id.hash")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]
# Near duplicates and SentencePiece have no SQL form; tests run the stages on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
