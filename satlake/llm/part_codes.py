"""Vector compression to part codes: each part of a vector becomes the index of a codebook entry.

Components are integers (floor of ``scale`` times the value), vectors are cut
into equal parts, and each part position has a codebook of a few entries,
refined by rounds of assignment and floored means.

The distinct parts of each position are counted once and written, dealt by
lexicographic ranges.  In every round a task walks the trie of its parts in
depth-first order: a node stands for a common prefix of components and holds
the distances of that prefix to all entries, which every part below it shares;
a leaf adds its own remaining components, takes the nearest entry and adds its
components, times its copies, to that entry's sums.  A task hands on one row
per entry and component, Spark adds them up, and the driver sees only the
codebooks, whose size is set by the parameters.

Defined results
  null vector, or a null, NaN or infinite component    row dropped
  empty, another length than the first kept vector's, or
  a length that the parts do not divide                row dropped
  fewer kept vectors than entries    that many entries
  null vec_id     kept; last in the order that starts the codebooks
  repeated rows   each gets its row and weighs in the means
  equal distances the lower index; an entry without parts stays as it is
  empty table     no rows
  null labels     one group
  components from about 16,000 on    an error, since squares would not fit 64 bits
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import few, ship, staged, tasks

#: Greatest integer component: squares of differences, summed over a vector, stay far below 2^63.
GREATEST = 1 << 26
#: Parts of one trie; bounds the memory of a walk.
TRIE_PARTS = 1 << 16


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry for distinct parts in lexicographic order.

    The stack holds the open nodes: depth, the run of parts below, and the
    distances of their common prefix.  Children are met in order; those with
    one part only are finished at once.
    """
    n, width = parts.shape
    codes, distances = np.zeros(n, np.int64), np.zeros(n, np.int64)
    stack = [(0, 0, n, np.zeros(len(book), np.int64))] if n and width else []
    while stack:
        depth, low, high, prefix = stack.pop()
        column = parts[low:high, depth]
        starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
        ends = np.r_[starts[1:], high - low]
        shared = prefix + np.square(column[starts, None] - book[:, depth])
        alone = ends - starts == 1
        leaves = low + starts[alone]
        whole = shared[alone]
        for place in range(depth + 1, width):
            whole += np.square(parts[leaves, place, None] - book[:, place])
        codes[leaves] = best = whole.argmin(axis=1)
        distances[leaves] = whole[np.arange(len(leaves)), best]
        for child in np.flatnonzero(~alone)[::-1]:
            stack.append((depth + 1, low + int(starts[child]), low + int(ends[child]), shared[child]))
    return codes, distances


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order and, per row given, which of them it is."""
    if not parts.size:
        return parts, np.zeros(len(parts), np.int64)
    order = np.lexsort(parts.T[::-1])
    sorted_parts = parts[order]
    new = np.r_[True, (sorted_parts[1:] != sorted_parts[:-1]).any(axis=1)]
    which = np.empty(len(parts), np.int64)
    which[order] = np.cumsum(new) - 1
    return sorted_parts[new], which


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if flat.size and int(np.abs(flat).max()) > GREATEST:
        raise ValueError(f"a scaled component is beyond {GREATEST}")
    return flat.reshape(rows, -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TRIE_PARTS):
            yield batch.slice(at, TRIE_PARTS)


def _is_number(x: Column) -> Column:
    value = x.cast("double")
    return x.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def scaled_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and the integer vector of the rows whose vector is all numbers."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", _is_number)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "label", whole.alias("vector")
    )


def _sums(counted: DataFrame, books: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
    """Per position, entry and component: how many parts the entry has, and their sum."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        for batch in _slices(batches):
            positions = batch.column(0).to_numpy()
            parts, copies = _matrix(batch.column(1), batch.num_rows), batch.column(2).to_numpy()
            for position in np.unique(positions):
                mine = positions == position
                found, which = distinct_parts(parts[mine])
                weight = np.zeros(len(found), np.int64)
                np.add.at(weight, which, copies[mine])
                codes, _ = nearest(found, books[position])
                np.add.at(weights[position], codes, weight)
                np.add.at(totals[position], codes, found * weight[:, None])
        rows = [
            (p, e, place, int(weights[p][e]), int(totals[p][e, place]))
            for p in range(len(books))
            for e in np.flatnonzero(weights[p]).tolist()
            for place in range(totals[p].shape[1])
        ]
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["position", "entry", "place", "copies", "total"]
        )

    schema = "position bigint, entry bigint, place bigint, copies bigint, total bigint"
    added = counted.mapInArrow(walk, schema).groupBy("position", "entry", "place")
    return [tuple(r) for r in added.agg(F.sum("copies"), F.sum(F.col("total").cast("decimal(38,0)"))).collect()]


def train(kept: DataFrame, n_parts: int, entries: int, rounds: int, width: int) -> list[np.ndarray]:
    """Codebooks of each position, from all parts of ``kept``."""
    order = [F.col("vec_id").isNull(), F.col("vec_id"), F.col("vector")]
    first = [r.vector for r in kept.orderBy(*order).limit(entries).collect()]
    if not first:
        return [np.zeros((0, width), np.int64) for _ in range(n_parts)]
    books = [np.array(first, np.int64)[:, p * width : (p + 1) * width] for p in range(n_parts)]
    cut = F.array(*[F.slice("vector", p * width + 1, width) for p in range(n_parts)])
    counted = kept.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").count()
    spark = kept.sparkSession
    counted = staged(
        counted.select(F.col("position").cast("bigint").alias("position"), "part", "count")
        .repartitionByRange(tasks(spark), "position", "part")
        .sortWithinPartitions("position", "part"),
        "parts",
    )
    for _ in range(rounds):
        books = [b.copy() for b in books]
        for position, entry, place, copies, total in _sums(counted, books):
            books[position][entry, place] = int(total) // copies
    return books


def books_digest(books: list[np.ndarray]) -> str:
    said = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(said.encode()).hexdigest()


def assign(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of every kept vector."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = batch.num_rows
            vectors = _matrix(batch.column(2), rows) if rows else np.zeros((0, width * len(books)), np.int64)
            errors, codes = np.zeros(rows, np.int64), np.zeros((rows, len(books)), np.int64)
            for p, book in enumerate(books):
                found, which = distinct_parts(vectors[:, p * width : (p + 1) * width])
                best, distance = nearest(found, book)
                if rows:
                    codes[:, p] = best[which]
                    errors += distance[which]
            told = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(told, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    label = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")


def compress(
    vectors: DataFrame, n_parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept vector.

    ``vectors`` has vec_id, embedding (numbers) and label; at most 256 entries,
    as a code has two digits per part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two digits has 1 to 256 entries")
    spark = vectors.sparkSession
    ship(spark)
    kept = staged(scaled_vectors(vectors, scale), "vectors")
    order = [F.col("vec_id").isNull(), F.col("vec_id"), F.col("vector")]
    first = kept.where((F.size("vector") > 0) & (F.size("vector") % n_parts == 0)).orderBy(*order).select(F.size("vector").alias("n")).first()
    length = first.n if first else -1
    kept = kept.where(F.size("vector") == length)
    books = train(kept, n_parts, entries, rounds, max(length, 0) // n_parts)
    coded = staged(assign(kept, books), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(few(sums), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
