"""The registered queries: each applies one operator to its whole table.

The digest columns asked for are derived here from the operators' outputs;
``ORACLE_SQL`` holds DuckDB SQL for those that SQL can express (module ``sql``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    bpe,
    context_tree,
    conversations,
    decontaminate,
    divergence,
    html_text,
    quality,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filter,
    vector_dedup,
)
from tillroll.llm.common import ship
from tillroll.llm.sql import ORACLE_SQL  # noqa: F401

#: (verdict, host/path)
URL_RULES = [
    (url_filter.BLOCK, "net/"),
    (url_filter.ALLOW, "example.net/en/"),
    (url_filter.BLOCK, "example.com/de/"),
    (url_filter.ALLOW, "org/fr/"),
]

TOKEN_LIMIT = 4096

#: Bytes of context of the language model: a whole word of usual length.
LM_DEPTH = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"), depth=200)
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_texts(
        _table(spark, sf_dir, "documents"), folds=5, fold=1, depth=LM_DEPTH)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_signals(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(
        _table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), width=3, max_bits=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"), depth=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def bpe_round_trip(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids and of the bytes they decode to, ids,
    the text they decode to, and the columns ``keep``."""
    import public_tokenizers

    ranks = bpe.read_ranks(_tokenizer("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.bpe_encode(docs, ranks, public_tokenizers.PATTERN, keep=keep)
    back = F.transform(F.array(bpe.decode_ids(F.col("ids"), ranks)), lambda raw: F.struct(
        F.sha2(raw, 256).alias("sha256"), F.decode(raw, "UTF-8").alias("text")))
    return coded.withColumn("_back", F.get(back, F.lit(0))).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.col("_back.sha256").alias("decoded_sha256"), "ids", F.col("_back.text").alias("text"), *keep)


#: Columns that the encoding adds; the documents' own of these names give way.
CODED = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def token_ids(docs: DataFrame) -> DataFrame:
    """The documents with their token ids: all their columns, and CODED.

    ``text`` is what the ids decode to: an empty string for a null.
    """
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text", *CODED))
    own = [c for c in docs.columns if c not in CODED]
    return bpe_round_trip(docs, keep).select(*(F.col(f"`{c}`") for c in own), *CODED)


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf_dir, "documents")).drop("ids", "text")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"), min_docs=10, top=10)


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_dedup.vector_links(_table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """The conversations with the damage that the repair is asked to mend.

    A dropped row stays as one that is not ``present``, so that its conversation
    is known.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    damage = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (damage != 0).alias("present"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_conversations(
        damaged_conversations(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_byte_level_bpe": op10_byte_level_bpe,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
