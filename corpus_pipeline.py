"""From raw documents to packed training sequences, a written table after each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.llm.mixing import mixed
from tellerbook.llm.near_dedup import near_duplicates
from tellerbook.llm.packing import pack
from tellerbook.llm.pii import pseudonymise
from tellerbook.llm.store import stored
from tellerbook.llm.toxicity import fit, score
from tellerbook.session import ship_package

#: Near duplicates share at least so many hundredths of their five-word shingles.
SIMILARITY = 80
#: The key of the pseudonyms; jobs on real data set their own.
KEY = "corpus-pipeline"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; null and empty texts stay, and so do repeated rows."""
    ship_package(spark)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return score(rows, model).where("predicted = 0").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, each judged by its own text.

    That is the one of the smallest id. Rows whose id is null or another row's too
    are documents of their own, behind all others, by id (null last) and digest of the
    text; of equal ones one stays. Documents without words are no copies of anything and
    stay, but for repeated rows of such an id. An empty table stays empty.
    """
    ship_package(spark)
    columns = docs.columns
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stored(repeated, "repeated-ids")
    single = docs.where("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti").select("doc_id", "text")
    # One number; the rows numbered behind it come in a fixed order.
    last = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0
    row = F.struct(*columns).alias("row")
    others = docs.where("doc_id IS NULL").select("doc_id", "text", row).union(
        docs.join(repeated, "doc_id", "left_semi").select("doc_id", "text", row)
    )
    others = others.withColumn("digest", F.md5("text")).orderBy(
        F.col("doc_id").asc_nulls_last(), "digest", F.xxhash64("row")
    )
    others = stored(others.select((F.monotonically_increasing_id() + last + 1).alias("number"), "text", "row"), "others")

    numbered = single.union(others.select(F.col("number").alias("doc_id"), "text"))
    kept = stored(near_duplicates(numbered, SIMILARITY).where("kept").select("doc_id", "n_shingles"), "kept")
    rows = docs.where("doc_id IS NOT NULL").join(kept.select("doc_id").hint("merge"), "doc_id", "left_semi").select(*columns)
    again = others.join(kept.withColumnRenamed("doc_id", "number"), "number")
    # Rows without words are classes of their own; of those of one id one stays.
    wordless = again.where("n_shingles = 0")
    once = wordless.where("row.doc_id IS NOT NULL").dropDuplicates(["row"])
    rest = again.where("n_shingles > 0").select("row").union(once.select("row"))
    rest = rest.union(wordless.where("row.doc_id IS NULL").select("row"))
    return rows.union(rest.select("row.*").select(*columns))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms."""
    return pseudonymise(docs, KEY).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: documents whole, twice or in part.

    Null, empty and blank texts have no words and go; null ids and repeated rows are
    documents of their own.
    """
    return mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a document taken twice is packed twice.

    Texts of any length are packed whole; an empty table gives no pieces.
    """
    ship_package(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A trained model and MinHash are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again.

    See the stages for nulls, empty texts, ties and repeated rows; without documents
    there are no pieces.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
