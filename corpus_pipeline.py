"""Training-data pipeline: documents in, token ids out.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read again as the docs of the next. All but the last return the columns of documents, and
any other columns of docs with them, whatever their names. Texts are read whole at any length, and an empty
table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.llm.bpe_codec import bpe_codec
from idweave.llm.common import read_table, scratch_path
from idweave.llm.decontaminate import decontaminate
from idweave.llm.quality import keep_good
from idweave.llm.queries import tokenizer_file
from idweave.llm.simhash import simhash_components
from idweave.llm.substring_dedup import remove_repeats

TOKEN_MEMORY = 20_000  # words a worker remembers: its executor's memory also serves the other stages
KEY = "key of the row"  # no column of documents has this name


def _keyed(docs: DataFrame) -> DataFrame:
    """A key that depends on a row's id and text only, so it is the same in every scan,
    also for null and repeated ids."""
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts to be of good quality stay. Null and empty texts
    get the score of a text without words; repeated rows are judged each, so all stay or all go; a null
    doc_id is scored like any other."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"), label_col="quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash component the document with the smallest id stays; ids are null last, and
    of equal ids the smaller key of the row stays. Texts without words, null ones too, have fingerprint zero and
    are copies of one another. Of rows that repeat id and text one stays, that whose other columns
    come first as JSON. Two texts whose keys collide are both kept if either is."""
    keyed = _keyed(docs)
    found = simhash_components(keyed, shingle=4, max_bits=4, id_col=KEY)
    ids = keyed.select(F.col(KEY).alias("k"), F.col("doc_id").alias("id")).distinct()
    stays = (found.select(F.col("doc_id").alias("k"), "component_id").distinct().join(ids, "k")
             .groupBy("component_id")
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("least"))
             .select(F.col("least.k").alias(KEY)))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rank = F.to_json(F.struct(F.col("doc_id"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text"))))
    return keyed.join(stays, KEY, "left_semi").groupBy(
        KEY, "doc_id", F.xxhash64(F.lit(KEY), "text")).agg(F.min_by(row, rank).alias("row")).select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 bytes that occur more than once are cut out of the texts, all their
    occurrences, so repeated rows of 200 bytes or more lose all their text and stay as rows. A character that a cut
    goes through is dropped. A null text becomes empty; null and repeated ids are kept; n_chars is counted anew."""
    out = remove_repeats(docs, length=200, outputs=("kept",), carry=tuple(docs.columns))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*(new.get(c, F.col("carry").getField(c)).alias(c) for c in docs.columns))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window of 10 words go, repeated rows together. Null and empty
    texts hold none and stay, as do documents of null id without a window; an empty benchmark removes nothing."""
    keyed = _keyed(docs)
    found = decontaminate(keyed, read_table(spark, sf_dir, "benchmark"), width=10, id_col=KEY)
    hit = found.where("contaminated").select(F.col("doc_id").alias(KEY)).distinct()
    return keyed.join(hit, KEY, "left_anti").drop(KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of their decoding: one row
    for each row, repeated ones and null ids included; null and empty texts have no ids."""
    return bpe_codec(docs, tokenizer_file("word_bpe_49k.json"),
                     outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
                     memory_words=TOKEN_MEMORY)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("benchmark", benchmark), ("tokens", tokens)]
ORACLE_SQL = None  # SQL cannot express the stages; the tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result is a table in the checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
