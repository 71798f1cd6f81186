"""SimHash near-duplicates found by deletion-variant signatures.

Fingerprints of at most ``distance`` differing bits are cut into so few segments
that in one of them they differ by at most one bit (three segments for four
bits).  A segment is indexed once per bit with that bit left out, so two
fingerprints that may be linked share such a variant: rows meet by equality on
it and the whole fingerprints are verified.  A variant that too many distinct
fingerprints share is cut further in the same way over the bits that it leaves
free, which is exact as well.

Defined results: null and empty texts have the zero fingerprint and are linked
like any other; texts of fewer words than a shingle have the whole sequence as
their shingle; repeated rows keep their rows; a component whose ids are all null
has a null id; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import ship, staged
from satlake.llm.components import connected

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
DISTANCE = 4

#: Distinct fingerprints of one variant that are compared in one piece (8 bytes each); larger sets
#: are cut further.  Cutting pays where many unrelated fingerprints meet; dense sets are quick in one piece.
GROUP_ROWS = 8_192
#: Groups up to this size are compared pair by pair, larger ones by growing their components.
PAIR_ROWS = 8
#: Levels of variants.  Each takes a third of the free bits; after the last one
#: at most ten are free besides the five left out, so 2^15 fingerprints bound a group.
LEVELS = 5


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is in over half of the shingles' hashes."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n].tolist()
    stops = (ends[min(words, len(tokens)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and fp of every row; fp holds the 64 bits as a signed long."""
    ship(docs.sparkSession)
    kinds = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), words) for text in batch.column(len(keep))]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], fps], names=[*keep, "fp"])

    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, fp bigint")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def variants(
    keys: np.ndarray, fps: np.ndarray, free: np.ndarray, segments: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One-wildcard variants of the free bits: (key, fp, bits still free) per bit left out."""
    for mask in np.unique(free):
        rows = np.flatnonzero(free == mask)
        bits = [b for b in range(BITS) if int(mask) >> b & 1]
        cuts = [len(bits) * k // segments for k in range(segments + 1)]
        for a, b in zip(cuts, cuts[1:]):
            segment = sum(1 << bit for bit in bits[a:b])
            left = np.full(len(rows), int(mask) & ~segment, np.uint64)
            for bit in bits[a:b]:
                kept = fps[rows] & np.uint64(segment & ~(1 << bit))
                yield _mixed(_mixed(keys[rows], np.full(len(rows), bit, np.uint64)), kept), fps[rows], left


def grown_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is within ``distance``, one per fingerprint at most.

    A component grows by everything near one of its members; what has joined is
    not compared again, so a dense group costs little more than its size.
    """
    links = []
    rest = np.unique(fps)
    while len(rest) > 1:
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            one = waiting.pop()
            near = np.bitwise_count(rest ^ one) <= distance
            if near.any():
                joined = rest[near]
                links.extend((int(one), int(x)) for x in joined)
                waiting.extend(joined)
                rest = rest[~near]
    return links


def _scan(batches: Iterator[pa.RecordBatch], distance: int, limit: int | None) -> Iterator[pa.RecordBatch]:
    """Links of each run of equal keys in sorted rows; runs over the limit are handed on."""
    names = ["key", "a", "b", "free"]

    def linked(a, b):
        n = len(a)
        none = pa.nulls(n, pa.int64())
        a, b = (np.asarray(x, np.uint64).view(np.int64) for x in (a, b))
        return pa.RecordBatch.from_arrays([none, pa.array(a), pa.array(b), none], names=names)

    def handed(keys, fps, free):
        parts = [pa.array(x.view(np.int64)) for x in (keys, fps, free)]
        return pa.RecordBatch.from_arrays([parts[0], parts[1], pa.nulls(len(keys), pa.int64()), parts[2]], names=names)

    def runs(keys, fps):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        run = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat((sizes > 1) & (sizes <= PAIR_ROWS), sizes)
        for lag in range(1, PAIR_ROWS):
            at = np.flatnonzero(small[:-lag] & (run[lag:] == run[:-lag])) if len(run) > lag else []
            if not len(at):
                break
            at = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= distance]
            at = at[fps[at] != fps[at + lag]]
            if len(at):
                yield linked(fps[at], fps[at + lag])
        for start, size in zip(starts[sizes > PAIR_ROWS].tolist(), sizes[sizes > PAIR_ROWS].tolist()):
            found = grown_links(fps[start : start + size], distance)
            if found:
                yield linked([a for a, _ in found], [b for _, b in found])

    held = [np.empty(0, np.uint64)] * 3
    over = None  # the key whose run is being handed on
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3)]
        rows = [np.concatenate(x) for x in zip(held, new)]
        if not len(rows[0]):
            continue
        if over is not None:
            same = rows[0] == over
            if same.any():
                yield handed(*(x[same] for x in rows))
            rows = [x[~same] for x in rows]
            if not len(rows[0]):
                held = rows
                continue
            over = None
        last = np.flatnonzero(rows[0] != rows[0][-1])
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield from _limited(runs, handed, [x[:cut] for x in rows], limit)
        held = [x[cut:] for x in rows]
        if limit is not None and len(held[0]) > limit:
            yield handed(*held)
            over, held = held[0][0], [x[:0] for x in held]
    if len(held[0]):
        yield from _limited(runs, handed, held, limit)


def _limited(runs, handed, rows, limit):
    keys, fps, free = rows
    if limit is not None:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        large = np.repeat(sizes > limit, sizes)
        if large.any():
            yield handed(keys[large], fps[large], free[large])
            keys, fps = keys[~large], fps[~large]
    if len(keys):
        yield from runs(keys, fps)


def links(nodes: DataFrame, distance: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp``: they connect exactly what is within ``distance``."""
    # Fewest segments of which one differs by at most one bit.
    segments = distance // 2 + 1
    spark = nodes.sparkSession
    ship(spark)
    everything = F.lit(-1).cast("bigint")
    rows = nodes.select(F.lit(0).cast("bigint").alias("key"), "fp", everything.alias("free"))
    found = []

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3)]
            for out in variants(*columns, segments):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in out], names=["key", "fp", "free"]
                )

    for level in range(1, LEVELS + 1):
        limit = None if level == LEVELS else group_rows
        met = (
            rows.mapInArrow(expand, "key bigint, fp bigint, free bigint")
            .repartition("key")
            .sortWithinPartitions("key", "fp")
            .mapInArrow(lambda batches, limit=limit: _scan(batches, distance, limit), "key bigint, a bigint, b bigint, free bigint")
        )
        met = staged(met, f"simhash-{level}")
        found.append(met.where("b is not null").select("a", "b"))
        rows = met.where("b is null").select("key", F.col("a").alias("fp"), "free")
        if rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _rooted(found: DataFrame, first: Column, distance: int, group_rows: int) -> DataFrame:
    """(fp, first, root) of every fingerprint: ``first`` of its rows, and its component's root."""
    nodes = staged(found.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    labels = connected(links(nodes, distance, group_rows))
    if labels is None:
        rooted = nodes.withColumn("root", F.col("fp"))
    else:
        rooted = nodes.join(labels.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp")
        )
    return staged(rooted, "simhash-roots")


def components(
    docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest id that links lead to."""
    found = staged(fingerprints(docs, words), "simhash")
    rooted = _rooted(found, F.min("doc_id"), distance, group_rows)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return found.join(classes, "fp").select("doc_id", "fp", "component_id")


def near_unique(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row per component: the one with the smallest id, null as the last one, all its columns kept.

    Rows of one id are told apart by a digest of the text and then of the other
    columns, so components are as many rows whatever their ids, and the same
    ones in every run.
    """
    others = [f"`{c}`" for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and kind != "variant"]
    text, rest = F.xxhash64("text"), F.xxhash64(F.lit(0), *others)
    ids = docs.select("doc_id", text.alias("digest"), rest.alias("rest"), "text")
    found = staged(fingerprints(ids, words, ("doc_id", "digest", "rest")), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "rest")
    rooted = _rooted(found, F.min(order), distance, GROUP_ROWS)
    kept = (
        rooted.groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("__id"), F.col("first.digest").alias("__digest"), F.col("first.rest").alias("__rest"))
    )
    marked = docs.withColumn("__text_digest", text).withColumn("__rest_digest", rest)
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & (F.col("__text_digest") == F.col("__digest"))
        & (F.col("__rest_digest") == F.col("__rest"))
    )
    one = marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__text_digest", "__rest_digest"])
    return one.drop("__text_digest", "__rest_digest")
