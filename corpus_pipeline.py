"""The documents on their way to training: five stages, each over all that the one before has kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biomesheaf.llm import decontamination, langid, minhash, mixing, pii
from biomesheaf.llm.queries_native import MIX
from biomesheaf.llm.shared import row_key, stored

KEY, COPY = "__pipeline_key", "__pipeline_copy"
#: Per cent, of the stage; op5 has its own.
SIMILARITY = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell; those it rejects (no text, no letter, too unsure) go.

    The model learns from the labelled documents themselves. If none is labelled, none is told and all go.
    """
    return langid.identified(docs, langid.fit(docs)).where(~F.col("_rejected")).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; of equal rows one.

    Documents whose sets of five-word shingles have a Jaccard similarity of SIMILARITY % and more are linked.
    Documents without words are no duplicates of each other and all stay.
    """
    found = minhash.near_duplicates(docs, similarity=SIMILARITY).where("kept").select(F.col("_key").alias(KEY), "n_shingles").dropDuplicates([KEY])
    copy = F.when(F.col("n_shingles") > 0, F.lit(-1)).otherwise(F.monotonically_increasing_id())
    one = docs.withColumn(KEY, row_key()).join(found, KEY).withColumn(COPY, copy).dropDuplicates([KEY, COPY])
    return one.select(*[one[c] for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, nor an edited copy of one."""
    leaked = decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("_key").alias(KEY)).distinct()
    return docs.withColumn(KEY, row_key()).join(leaked, KEY, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by its kind; n_chars follows the new text."""
    found = pii.located(docs).withColumn("_text", pii.masked(F.col("_row.text"), F.col("_spans")))
    changed = {"text": F.col("_text"), "n_chars": F.when(F.size("_spans") > 0, F.length("_text").cast("long")).otherwise(F.col("_row.n_chars"))}
    return found.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled by their raked weights, with mix_weight and mix_probability."""
    return mixing.mix(docs, **MIX)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing_to_targets),
]

#: Learned models, signatures and alignments have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
