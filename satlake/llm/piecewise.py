"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes ends a piece wherever it is a multiple of the
block size, so pieces depend on their surroundings only and an edit changes the
few that it touches.  A piece is written as one character of its hash.  A
fingerprint is ``block:signature:signature at twice the block``; two are
compared by edit distance where their block sizes are equal or one is twice the
other, and only if their signatures have a stretch in common.

Defined results: null is the empty text, whose fingerprint has empty
signatures; documents follow one another by ascending id (null first), equal
ids by a hash of their text, and after the last comes the first, a single
document being followed by itself; repeated rows are kept; an empty table gives
no rows.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlake.llm.common import ship, staged, tasks

#: Bytes of the rolling hash, characters of a signature, and triggers that a block size should meet.
ROLL = 7
SIGNATURE = 64
ENOUGH = 32
#: Characters in a row that two signatures must share, at most; shorter ones share half their length.
COMMON = 7
#: Bytes that are hashed at a time.
SLICE_BYTES = 2_000_000

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_LETTERS = np.frombuffer(ALPHABET.encode(), np.uint8)

_random = np.random.Generator(np.random.PCG64(7))
_VALUES = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_ROLL_DOWN = _powers(_INVERSE, ROLL + 1)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, in a few sizes."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _tables:
        _tables[size] = (_powers(_BASE, size), _powers(_INVERSE, size))
    return _tables[size]


def _signed(text: np.ndarray) -> str:
    """The fingerprint of one text's bytes."""
    n = len(text)
    if not n:
        return "1::"
    up, down = _tables_of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[text] * up[:n], out=sums[1:])
    # Trailing zero bits of the rolling hash at the last byte of each window.
    rolled = _mixed((sums[ROLL:] - sums[: n + 1 - ROLL]) * down[: n + 1 - ROLL]) if n >= ROLL else sums[:0]
    low = rolled & (~rolled + np.uint64(1))
    k = max(0, (-(-n // SIGNATURE) - 1).bit_length())
    while k and np.count_nonzero(low >= np.uint64(1 << k)) < ENOUGH:
        k -= 1
    ends = np.flatnonzero(low >= np.uint64(1 << k)) + ROLL
    first = _pieces(sums, down, ends, n)
    second = _pieces(sums, down, ends[low[ends - ROLL] >= np.uint64(2 << k)], n)
    return f"{1 << k}:{first}:{second}"


def _pieces(sums: np.ndarray, down: np.ndarray, ends: np.ndarray, n: int) -> str:
    ends = ends[: SIGNATURE - 1]
    if not len(ends) or ends[-1] < n:
        ends = np.r_[ends, n]
    starts = np.r_[0, ends[:-1]]
    hashes = _mixed((sums[ends] - sums[starts]) * down[starts])
    return _LETTERS[(hashes >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    return _signed(np.frombuffer((text or "").encode(), np.uint8))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many, or all, of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# -- comparison: columns -----------------------------------------------------


def _alike(a: Column, b: Column) -> Column:
    """One minus the edit distance by length, if the signatures share a stretch."""
    shorter = F.least(F.length(a), F.length(b))
    need = F.least(F.lit(COMMON), F.greatest(F.lit(1), F.floor(shorter / 2))).cast("int")
    stretches = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(a) - need + 1))
    shared = F.exists(stretches, lambda i: F.contains(b, F.substr(a, i, need)))
    return F.when(
        (shorter > 0) & shared, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    ).otherwise(0.0)


def likeness(one: Column, other: Column) -> Column:
    """0 to 1 of two fingerprints."""
    a, b = F.split(one, ":"), F.split(other, ":")
    # A long row of one character says no more than three of it.
    sign = lambda parts, i: F.regexp_replace(parts[i], r"(.)\1{3,}", "$1$1$1")
    size = lambda parts: parts[0].cast("bigint")
    return (
        F.when(one == other, 1.0)
        .when(size(a) == size(b), F.greatest(_alike(sign(a, 1), sign(b, 1)), _alike(sign(a, 2), sign(b, 2))))
        .when(size(a) == 2 * size(b), _alike(sign(a, 1), sign(b, 2)))
        .when(2 * size(a) == size(b), _alike(sign(a, 2), sign(b, 1)))
        .otherwise(0.0)
        .cast("double")
    )


# -- the job -----------------------------------------------------------------

_WALKED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " next_fingerprint string, part int, role string, text string"
)
_WALKED_TYPE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("next_fingerprint", pa.string()),
        ("part", pa.int32()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)


def _done(doc_id, text: str, mark: str, following: str, next_mark: str, part: int) -> tuple:
    changed = edited(text, following).encode()
    digest = hashlib.sha256(changed).hexdigest()
    changed_mark = _signed(np.frombuffer(changed, np.uint8))
    return (doc_id, len(text), digest, mark, changed_mark, next_mark, part, None, None)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _WALKED_TYPE]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _WALKED_TYPE)], schema=_WALKED_TYPE
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents of one task: each with its next, but the last; both ends are handed on whole."""
    held = None
    for batch in batches:
        rows = []
        for doc_id, text, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
            mark = fingerprint(text)
            if held is None:
                rows.append((doc_id, None, None, mark, None, None, part, "first", text))
            else:
                rows.append(_done(*held, text, mark, part))
            held = (doc_id, text, mark)
        yield _rows(rows)
    if held is not None:
        yield _rows([(held[0], None, None, held[2], None, None, part, "last", held[1])])


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        yield _rows([_done(*row) for row in zip(*columns)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and that of the next document.

    Texts are sorted by ranges of their ids, in one shuffle; only the two
    documents at the ends of a task's range are moved again, to meet their
    neighbours.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(tasks(spark), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    walked = staged(rows.mapInArrow(_walk, _WALKED), "piecewise")
    firsts = walked.where("role = 'first'")
    # One row per task: the range that follows, the first one after the last.
    order = Window.orderBy("part")
    following = firsts.select("part").select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part")
    )
    ends = (
        walked.where("role = 'last'")
        .select("doc_id", "text", "fingerprint", "part")
        .join(following, "part")
        .join(
            firsts.select(
                F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark")
            ),
            "next_part",
        )
        .select("doc_id", "text", "fingerprint", "next_text", "next_mark", "part")
    )
    found = walked.where("role is null").unionByName(ends.mapInArrow(_join_ends, _WALKED))
    return found.drop("part", "role", "text")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next."""
    mark = F.col("fingerprint")
    return fingerprints(docs).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(mark, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(mark, F.col("next_fingerprint")).alias("near_next"),
    )
