"""From raw documents to tokens: five stages, each written and read again by the next.

quality rules -> SimHash near-dedup -> suffix-array dedup -> mixing to target
weights -> SentencePiece encoding.  Every stage works on all rows that the one
before kept; all but the last return the columns of documents.

Defined results, by stage
  quality rules      null, empty and short texts go, as the base rules say; equal
                     rows share their fate
  near-dedup         one row per component: the smallest id, null as the last, of
                     equal ids the one of the lowest hash of text and row
  suffix dedup       a null id is smaller than all others; rows of equal ids do
                     not take from each other; a text may become empty
  mixing             a null source is a source, last in order; rows of which
                     nothing is taken go; equal rows have pieces of their own
  encoding           one row per row, ids and sources as they came
An empty table gives an empty one at every stage.  Extra columns stay until the
last stage, whatever their names; of a null or repeated id no row is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from satlake.llm import mixing, piece_bpe, quality, simhash, suffix_blocks
from satlake.llm.common import table
from satlake.llm.queries import vocabulary
from satlake.session import fresh_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the weighed votes reject go."""
    return quality.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints the document with the smallest id stays."""
    return simhash.near_unique(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document of a smaller id has are cut out of the texts."""
    return suffix_blocks.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become the words that the mix takes of them; untaken documents go."""
    return mixing.mix_documents(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number, and digests of the ids and of the decoded text."""
    return piece_bpe.encode_documents(docs, vocabulary(), keep=("doc_id", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("source mixing", source_mixing),
    ("sentencepiece encoding", sentencepiece_encoding),
]

#: Fingerprint components, byte removal and piece merges are no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
