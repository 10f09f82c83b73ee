"""A training corpus from the documents table, one operator per stage.

Each stage reads what the one before it kept. Rows are named by a hash of doc_id and text, so rows
that agree in both are one document, and null ids are ids like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envhealth.llm import decontaminate, mixing, quality, simhash, suffix_dedup
from envhealth.llm.queries import ratings
from envhealth.llm.scratch import free_name, saved


def _key():
    return F.xxhash64("doc_id", "text").alias("key")


def _packed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column, whatever their names are, next to their key."""
    return docs.select(F.struct("*").alias("doc"), _key())


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the highest grade, learned from `labels`, is at least `quality.KEEP`.

    Null and empty texts are graded like a text without features, repeated rows alike; a probability
    of exactly the limit is kept. Labels with a null id or grade teach nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(ratings(labels), docs, grades=3)
    return quality.selected(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose fingerprints are linked: the one with the smallest doc_id.

    Fingerprints of 4-word shingles are linked at 4 or fewer differing bits, and links chain. Null,
    empty and blank texts have one fingerprint, so one of them stays. Null ids come last; of rows with
    the same smallest id the smallest key stays, and of equal rows one.
    """
    classes = simhash.near_duplicates(docs.select(_key().alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("key"), "component_id").dropDuplicates(["key"])
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    ids = docs.select(_key(), "doc_id").join(classes, "key")
    kept = ids.groupBy("component_id").agg(F.min(order).alias("least")).select("least.key")
    return _packed(docs).join(kept, "key", "left_semi").dropDuplicates(["key"]).select("doc.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occurred before; documents of which nothing is left go.

    Null and empty texts have no passages and stay. The first of several occurrences, in order of
    doc_id, stays.
    """
    cut = suffix_dedup.without_repeats(docs, keep_emptied=False)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is from the benchmark.

    Null and empty texts have no words and stay; equal rows stay or go together; exactly one word in
    twenty is contaminated.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    named = docs.select(_key().alias("doc_id"), "text")
    found = decontaminate.contamination(named, benchmark)
    bad = found.where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return _packed(docs).join(bad, "key", "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; `copy` numbers those of one document from 1.

    A null source is a source of its own. Texts without words have size 0 and are never taken. Rows
    equal in doc_id and text are one document whose copies are added up.
    """
    mixed = mixing.mix(docs.select(_key().alias("doc_id"), "text", "source"))
    taken = mixed.groupBy(F.col("doc_id").alias("key")).agg(F.sum("copies").cast("int").alias("copies"))
    whole = _packed(docs).join(taken.where("copies > 0"), "key").dropDuplicates(["key"])
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(free_name(docs, "copy"))
    return whole.select("doc.*", copy)


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
]
#: SQL cannot say what a classifier, fingerprints or a random draw decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
