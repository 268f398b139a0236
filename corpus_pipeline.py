"""From raw documents to packed training sequences.

Each stage takes the documents that the one before kept, as a table, and returns
a DataFrame; all but the last return the columns of documents. Extra columns,
whatever they are called, are left out; an empty table stays empty. Null and empty
texts are clean, are no copies of one another, hold no personal data, have no
words to mix, and pack as the end id alone where the mix has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.llm import jaccard, mixing, packing, pii, toxicity
from timeloom.llm.queries import CAPACITY, tokenizer_file
from timeloom.llm.runtime import Scratch, closing_scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic (operator 8); equal texts go or stay together, and all stay without both labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.classify_toxicity(docs, labels, Scratch(spark, "stage1"), keep=COLUMNS)
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id, and of equal rows one (operator 10); rows without doc_id stay."""
    groups = jaccard.jaccard_components(docs, Scratch(spark, "stage2"))
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.select(*COLUMNS).join(first, "doc_id", "left_semi").withColumn("_print", F.xxhash64("text"))
    named = named.dropDuplicates(["doc_id", "_print"]).select(*COLUMNS)
    return named.unionByName(docs.select(*COLUMNS).filter("doc_id is null"))


def redact_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each span of personal data in its place (operator 4); a text without any is as it was, null included."""
    found = pii.find_private_data(docs.select(*COLUMNS))
    text = pii.redacted(F.col("text"), F.col("pii_spans"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(F.size("pii_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, the last one of a source's budget cut at the exact word (operator 3); null source is a source."""
    return mixing.mixed_documents(docs, COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in the training sequences (operator 1); repeated rows are packed each."""
    scratch = Scratch(spark, "stage5")
    pieces = packing.tokenized_pieces(docs, tokenizer_file("byte_bpe_50k.json"), CAPACITY, added_tokens=True)
    pieces = scratch.save(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.pack_best_fit(pieces, "length", CAPACITY, ["doc_id", "piece", "start", "ids_crc32"])


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("private_data", redact_private_data), ("mixing", mix), ("packing", pack)]

#: Word-piece ids, a trained classifier and a set join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents: every stage in turn over what the one before wrote.

    A stage's own tables go when its result stands, and its input then, too.
    """
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with closing_scratch():
            docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
