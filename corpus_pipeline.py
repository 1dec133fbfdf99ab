"""A corpus from raw documents to a training mix, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanflow.llm import decontaminate, language, mixing, simhash, suffixes
from fanflow.llm.common import settled, written

#: A text whose best language prototype is less like it than this is in no language that was learned.
LEAST_LIKENESS = 0.1
#: A text whose distinct words have fewer letters than this has too few trigrams to be like a prototype, and stays.
JUDGED_LETTERS = 64
#: Bytes of a passage that is cut out where it repeats: about 40 to 50 words.
PASSAGE_BYTES = 256
#: Keys of rows that one broadcast may hold (about 100 MB).
SENT_ROWS = 1_500_000
#: Rows that a Python worker is given at once: whole documents go through it, so the default of 10,000 takes much memory.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach: texts without a letter go, and so do texts of some length unlike all prototypes."""
    small_batches(spark)
    prototypes = language.fit(docs)
    said = language.identify(docs.withColumn("doc", F.struct(*docs.columns)), prototypes, "doc", "text")
    distinct = F.array_distinct(F.split(F.lower("doc.text"), r"[^\p{L}]+"))
    short = F.aggregate(distinct, F.lit(0), lambda n, w: n + F.length(w)) < JUDGED_LETTERS
    return said.filter((F.col("lang_pred") != language.UNKNOWN) & F.when(F.col("score") >= LEAST_LIKENESS, True).otherwise(short)).select("doc.*")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id: SimHashes of five-word shingles within two bits, or likeness 0.8 or more.

    Null ids count as the largest; of rows with equal id and text one stays. The rows that go are sent to all tasks up
    to SENT_ROWS of them and joined by a shuffle beyond, so that texts are shuffled only where they must be.
    """
    small_batches(spark)
    key = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("id"), F.xxhash64("text").alias("same")]
    found = simhash.near_documents(docs.select(F.struct(*key).alias("key"), "text"), "key")
    rows = found.groupBy("key").agg(F.max(F.col("key") != F.col("component")).alias("goes"), F.count(F.lit(1)).alias("times"))
    odd = written(rows.filter("goes or times > 1").select("key.*", "goes"), "pipeline-odd")
    sent = F.broadcast(odd) if odd.count() <= SENT_ROWS else odd
    doc = docs.select(F.struct(*docs.columns).alias("doc"), *key)
    names = ["none", "id", "same"]
    left = doc.join(sent, names, "left_anti").select("doc.*")
    again = doc.join(sent.filter("not goes"), names, "left_semi").dropDuplicates(names).select("doc.*")
    return left.unionByName(again)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without passages that stand elsewhere too, n_chars counted anew; documents of which nothing is left go."""
    small_batches(spark)
    found = suffixes.without_repeats(docs, length=PASSAGE_BYTES, carried=tuple(c for c in docs.columns if c not in ("doc_id", "text")), whole_characters=True)
    left = found.filter((F.col("n_removed") == 0) | (F.length("kept") > 0)).select("doc_id", F.col("kept").cast("string").alias("text"), "rest.*")
    return left.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without four fifths of any benchmark item's shingles; rows of one id are judged one by one."""
    small_batches(spark)
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken of each (repeats counted) and the number of repeats.

    Rows that are equal in all columns are taken so often as the mix takes rows like them, each with its own words.
    """
    key = F.xxhash64(*docs.columns)
    plan = written(mixing.mix(docs, key=key).filter("taken > 0"), "mix-plan")
    facts = ["size", "source_size", "target", "taken"]
    times = plan.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"), *(F.first(c).alias(c) for c in facts)).filter("rows = 1").drop("rows")
    again = plan.join(times, "hash", "left_anti").groupBy("hash", *facts).agg(F.count(F.lit(1)).alias("rows"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("hash"))
    once = rows.join(times, "hash").select("doc.*", *facts)
    repeated = written(again, "mix-again")
    if not repeated.isEmpty():
        one = rows.join(repeated.select("hash"), "hash", "left_semi").dropDuplicates(["hash"]).join(repeated, "hash")
        once = once.unionByName(one.select("doc.*", *facts, F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("col"))
    return once.withColumn("repeats", (F.col("taken") / F.col("size")).cast("long"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents in sf_dir. Each stage's table is deleted once the next one's is whole, and so is what a stage wrote on its way.

    So the shared folder holds two stages at most; what the rows returned are read from stays.
    """
    docs, drop = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, done = settled(lambda: stage(spark, docs, sf_dir), name)  # noqa: B023
        if drop:
            drop()
        drop = done
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
