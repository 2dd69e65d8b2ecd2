"""From raw documents to token files: the training-data operators in a row.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of ``documents``; the
last one returns what the token files hold. Between stages documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agentlake.llm.decontaminate import find_benchmark
from agentlake.llm.jaccard_join import near_duplicates
from agentlake.llm.labelled import fold_of
from agentlake.llm.mixing import WORD, mix_sources
from agentlake.llm.quality_model import score_quality, train_quality
from agentlake.llm.queries import token_digests
from agentlake.llm.storage import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on this stage's labelled documents, does not reject."""
    model = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda d: fold_of(d, 5) == 0)
    return score_quality(docs, model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every component of near duplicates; of equal texts of one id one row, as an id
    may name several texts. Rows without id stay."""
    named = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(named, "doc_id")
    first = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("source", "lang"))
    kept = kept.withColumn("place", first).where("place = 1")
    return kept.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=COLUMNS)
    return found.where("n_hit = 0").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Where a source's budget cuts into a document, its first words up to
    the budget are a row too, joined by one space. Documents of which the mix takes nothing go."""
    mixed = mix_sources(docs.select(*COLUMNS))
    rest = F.expr("CASE WHEN size > 0 THEN taken % size ELSE 0 END").cast("int")
    whole = F.expr("CASE WHEN size > 0 THEN taken DIV size ELSE 0 END").cast("int")
    begin = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), rest), " ")
    texts = F.concat(F.array_repeat("text", whole), F.when(rest > 0, F.array(begin)).otherwise(F.array().cast("array<string>")))
    rows = mixed.where("taken > 0").select("doc_id", F.explode(texts).alias("text"), "lang", "source")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places, token counts and checksums, read back from their token files."""
    return token_digests(spark, docs, most_words=250_000)  # earlier stages leave executors less memory than op2 has


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix),
    ("token files", token_files),
]

#: SQL can express neither the trained classifier nor the tokenizer; tests/llm compares with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
