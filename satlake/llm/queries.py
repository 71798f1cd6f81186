"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.llm import (
    chat_parts,
    hilbert,
    importance,
    line_blocks,
    mixing,
    part_codes,
    piece_bpe,
    piecewise,
    quality,
    simhash,
    suffix_blocks,
    token_files,
    url_filters,
)
from satlake.llm.common import table

SHARDS = 8

# Fixed values of the contract: rules of the URL filter.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, its half-edited text's, and how alike they and the next one's are."""
    return piecewise.compared(table(spark, sf_dir, "documents"))


def op2_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight runs along the curve over source, language and length."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
    )
    sharded = hilbert.hilbert_shards(
        docs, ["lang", "source"], ["n_chars"], ["doc_id", "text_crc32", "size"], SHARDS
    )
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    said = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(said)
    turns = turns.withColumn("parts", chat_parts.text_parts(F.col("text")))
    back = chat_parts.read_back(chat_parts.format_conversations(turns))
    told = F.array_join(
        F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.withColumn("trained", F.array_join("read_loss", "")).select(
        "conv_id",
        F.size("read_turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return line_blocks.extract(table(spark, sf_dir, "pages"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules; URLs that no rule fits are allowed."""
    rules = spark.createDataFrame(URL_RULES, url_filters.RULE_SCHEMA)
    judged = url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint of 4-word shingles and its component at 4 bits."""
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the 50-byte strings that a document of a smaller id has."""
    return suffix_blocks.repeats(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures, and whether the weighed votes keep it."""
    found = quality.assess(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by sources with weights 3, 1, 2 to 150% of all words."""
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded with the 32k piece vocabulary."""
    docs = table(spark, sf_dir, "documents")
    return piece_bpe.encode_documents(docs, vocabulary(), with_ids=False)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids, written to coded files in ascending doc_id order and read back from them."""
    return token_files.through_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's likeness to the benchmark texts, and the tenth of the longer ones that is drawn."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as eight codes of 16 entries, with its error and that of its label."""
    coded = part_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_piecewise_fingerprints": op1_piecewise_fingerprints,
    "op2_hilbert_sharding": op2_hilbert_sharding,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_html_extraction": op4_html_extraction,
    "op5_url_filters": op5_url_filters,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_weak_supervision": op8_weak_supervision,
    "op9_source_mixing": op9_source_mixing,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_token_files": op11_token_files,
    "op12_importance": op12_importance,
    "op13_part_codes": op13_part_codes,
}
