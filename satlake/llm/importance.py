"""Target-distribution importance resampling: draw the documents that are most like a target.

Words come from the UTF-8 bytes: one 256-byte table lower-cases A-Z and turns
every other separator into a blank, and ``bytes.split`` yields the words.  A
feature is a run of 1 to ``longest`` words; its hash is the CRC-32 of the run,
extended word by word with the hash of the shorter run as seed.  Each task
reduces its hashes to bucket counts with a Counter, Spark adds up the counts of
the tasks, and a bucket's gain is the log ratio of its share in the target to
its share in the documents.  A document weighs the mean gain of its features,
and Gumbel noise from a hash of its id turns "the highest scores" into a draw
without replacement.

Defined results
  null or empty text, or one without a word    no feature, weight 0, never drawn
                                               if ``least_words`` is above 0
  null id        hashed as the empty string; after all others among equal scores
  repeated rows  each counts, and each can be drawn
  equal scores   smaller id first; equal ids in the order of the written table
  empty table    no rows; an empty target gives every bucket t = 0
  very long text read in slices of about 1 MB, cut at blanks
  other columns  not looked at, whatever their names
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import ranked, ship, staged

#: What a word is made of: digits, letters and every byte of a longer character.
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_BLANKED = bytes(b if b in WORD_BYTES else 0x20 for b in range(256))
TABLE = _BLANKED[:0x41] + b"abcdefghijklmnopqrstuvwxyz" + _BLANKED[0x5B:]

SLICE_BYTES = 1 << 20


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about SLICE_BYTES."""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        if end < len(text):
            while end < len(text) and TABLE[text[end]] != 0x20:
                end += 1
        yield text[start:end].translate(TABLE).split()
        start = end


def run_hashes(text: bytes, longest: int) -> Iterator[tuple[int, list[int]]]:
    """Per slice the number of words and the hashes of all runs that end in it."""
    # Per length the hash of the run that ends with the last word seen.
    open_runs: list[int | None] = [None] * longest
    for words in word_slices(text):
        if not words:
            continue
        level = list(map(crc32, words))
        found = list(level) if longest > 1 else level
        following = [b" " + w for w in words] if longest > 1 else []
        for n in range(longest - 1):
            before = [] if open_runs[n] is None else [open_runs[n]]
            seeds = before + level[:-1]
            if level:
                open_runs[n] = level[-1]
            level = list(map(crc32, following[len(following) - len(seeds) :], seeds))
            found += level
        yield len(words), found


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all rows of the one text column; a task hands on at most ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for _, hashes in run_hashes(text.as_py() or b"", longest):
                    totals.update([h % buckets for h in hashes])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals.keys()), pa.int64()), pa.array(list(totals.values()), pa.int64())],
            names=["bucket", "n"],
        )

    counted = texts.mapInArrow(count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> list[int]:
    """Gain of each bucket.  The driver sees one row per bucket and side, however long the tables."""
    raw = {r.bucket: r.n for r in bucket_counts(docs, longest, buckets).collect()}
    aim = {r.bucket: r.n for r in bucket_counts(target, longest, buckets).collect()}
    raw_all, aim_all = float(sum(raw.values()) + buckets), float(sum(aim.values()) + buckets)
    return [
        math.floor(1000 * math.log((aim.get(b, 0) + 1.0) * raw_all / ((raw.get(b, 0) + 1.0) * aim_all)))
        for b in range(buckets)
    ]


def weighed(docs: DataFrame, gain: list[int], longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for text in batch.column(1):
                words = features = total = 0
                for n, hashes in run_hashes(text.as_py() or b"", longest):
                    words += n
                    features += len(hashes)
                    total += sum([gain[h % buckets] for h in hashes])
                n_words.append(words)
                n_features.append(features)
                weights.append(total // features if features else 0)
            columns = [pa.array(c, pa.int64()) for c in (n_words, n_features, weights)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return docs.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: str = "2024:",
) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and, if drawn, its rank from 1.

    ``percent`` of the documents with ``least_words`` words are drawn.  Two
    passes over the texts: one for the counts, one for the weights, which are
    written; only ids and numbers are shuffled, by ranges of the score.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    gain = gains(rows.select("text"), target.select(F.col("text").cast("binary").alias("text")), longest, buckets)
    name = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    scored = staged(
        weighed(rows, gain, longest)
        .withColumn("score", F.col("weight") + noise)
        .withColumn("row", F.monotonically_increasing_id()),
        "weighed",
    )
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    placed = ranked(
        able.withColumn("down", -F.col("score")).withColumn("unnamed", F.col("doc_id").isNull()),
        ["down", "unnamed", "doc_id", "row"],
        "place",
    )
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("bigint").alias("rank")
    rest = scored.where(F.col("n_words") < least_words)
    return placed.select(*columns, rank).unionByName(rest.select(*columns, F.lit(None).cast("bigint").alias("rank")))
