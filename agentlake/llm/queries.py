"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.llm.decontaminate import find_benchmark
from agentlake.llm.html_extract import extract_pages
from agentlake.llm.jaccard_join import near_duplicates
from agentlake.llm.labelled import fold_of
from agentlake.llm.line_rules import judge_lines
from agentlake.llm.mixing import mix_sizes
from agentlake.llm.packing import cut_documents, pack_pieces
from agentlake.llm.quality_model import score_quality, train_quality
from agentlake.llm.spelling import count_words, group_spellings
from agentlake.llm.storage import new_folder
from agentlake.llm.substring_dedup import remove_repeats
from agentlake.llm.token_counts import count_tokens
from agentlake.llm.token_files import read_token_files, write_token_files
from agentlake.llm.toxicity import score_toxicity, train_toxicity
from agentlake.llm.whitening import fit_whitening, identity_error, whiten

#: Parameters of the token files.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Pieces and scores of the token counts.
VOCABULARY = "piece_bpe_32k.model"
#: Ids of a packed sequence, and the id that ends a document there.
CAPACITY = 2048
PACKED_END_ID = 0
#: Whitened components of a vector.
COMPONENTS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digests(spark: SparkSession, docs: DataFrame, most_words: int | None = None) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_token_files(docs, folder, tokenizer_path(TOKENIZER), END_ID, most_words=most_words)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels"), lambda d: fold_of(d, 3) == 1)
    return score_toxicity(docs, model, keep=["doc_id"]).select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark, _table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("found_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "found_items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), digest=True)


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, _table(spark, sf_dir, "labels"), lambda d: fold_of(d, 5) == 0)
    return score_quality(docs, model, keep=["doc_id"]).select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_lines(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(VOCABULARY), keep=["doc_id"]).select("doc_id", "n_tokens", "best_score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(count_words(_table(spark, sf_dir, "documents")))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut_documents(_table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER), PACKED_END_ID, CAPACITY, keep=["doc_id"])
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_pieces(pieces, CAPACITY)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    rows = whiten(vectors, model, COMPONENTS, keep=["vec_id"])
    explained = F.array(*(F.lit(e).cast("double") for e in (model.explained(COMPONENTS) if model else []))).cast("array<double>")
    return rows.select("vec_id", F.posexplode("whitened").alias("place", "whitened"), "deviation").select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", F.get(explained, F.col("place")).alias("explained"),
        F.lit(identity_error(rows)).cast("double").alias("identity_error"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_files": op2_token_files,
    "op3_decontaminate": op3_decontaminate,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_model": op5_quality_model,
    "op6_line_rules": op6_line_rules,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_html_extract": op8_html_extract,
    "op9_mix_sources": op9_mix_sources,
    "op10_token_counts": op10_token_counts,
    "op11_spelling": op11_spelling,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}
