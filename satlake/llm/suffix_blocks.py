"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes if a string of ``LENGTH`` bytes around it also starts in a document
of a smaller id.  Suffixes matter to that depth only and meet in buckets, one
sorted at a time.  Most never get there, by two rankings of a cover sample: the
positions whose residue modulo 31 lies in a difference cover, so that any two
suffixes have a common offset below 31 at which both are sampled.

1. Sample strings of 20 bytes are ranked.  Equal suffixes share one within 50
   bytes, so a suffix without a shared sample string is unique and dropped.
2. Shared sample strings of 80 bytes are ranked with the smallest document that
   has them.  They settle long ties: inside a match of 80 bytes or more all
   suffixes of the later documents are decided by the sample alone.
3. The remaining suffixes (first occurrences and the rims of matches) are
   ranked by their 50 bytes, bucket by bucket.

A rank is a fingerprint, so buckets are sorted by fingerprints instead of by
alphabet, which groups equal strings alike.  Documents are written once as
blocks (a bucketed table in the shared folder); a block sends its distinct
fingerprints to the buckets and gets back one bit for each, so texts are never
shuffled, and neither a block nor a bucket grows with the input: their numbers do.

Defined results: null is the empty text, a null id is smaller than all others;
rows of the same id do not remove from one another; texts shorter than LENGTH
stay whole; an empty table gives no rows.  Names of other columns may clash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import ship, staged, tasks
from satlake.session import fresh_path

LENGTH = 50
#: A perfect difference set: the differences of its members are all residues modulo 31.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Bytes of a sample string that any two equal suffixes share, and that settle a tie.
SHORT = LENGTH - PERIOD + 1
LONG = LENGTH + PERIOD - 1

#: Bytes of text in a block, and fingerprints in a bucket, on average.
BLOCK_BYTES = 8_000_000
#: What a row adds to its block besides its text.
ROW_BYTES = 16
BUCKET_ROWS = 2_000_000
#: Positions that are hashed at a time.
SLICE = 1 << 18

NULL_ID = -(1 << 63)

_random = np.random.Generator(np.random.PCG64(20))
_VALUES = _random.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Fingerprints of the strings of one length at given places, by prefix sums of a polynomial."""

    def __init__(self) -> None:
        n = SLICE + LONG + 1
        self.up = [_powers(base, n) for base in _BASES]
        self.down = [_powers(pow(base, -1, 1 << 64), n) for base in _BASES]

    def at(self, text: np.ndarray, places: np.ndarray, length: int, which: int) -> np.ndarray:
        """``places`` ascending; every string lies inside ``text``."""
        out = np.empty(len(places), np.uint64)
        for start in range(0, len(text), SLICE):
            a, b = np.searchsorted(places, (start, start + SLICE))
            if a == b:
                continue
            piece = _VALUES[which][text[start : start + SLICE + length]]
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(piece * self.up[which][: len(piece)], out=sums[1:])
            i = places[a:b] - start
            out[a:b] = (sums[i + length] - sums[i]) * self.down[which][i]
        return _mixed(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_hashers: list[Hasher] = []


def hasher() -> Hasher:
    if not _hashers:
        _hashers.append(Hasher())
    return _hashers[0]


class Groups:
    """Equal keys: the distinct ones in order, and for each row the number of its key."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        ordered = keys[self.order]
        self.starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.empty(0, np.int64)
        self.keys = ordered[self.starts]
        sizes = np.diff(np.r_[self.starts, len(keys)])
        self.number = np.empty(len(keys), np.int64)
        self.number[self.order] = np.repeat(np.arange(len(self.starts)), sizes)

    def least(self, values: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(values[self.order], self.starts) if len(self.starts) else values[:0]

    def most(self, values: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(values[self.order], self.starts) if len(self.starts) else values[:0]


def _pack(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=n).astype(bool)


def _bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    return ((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


class Block:
    """The texts of one block end to end, documents in order of their ids."""

    def __init__(self, ids: np.ndarray, texts: list[bytes]):
        order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
        self.order = np.array(order, np.int64)
        self.lengths = np.array([len(texts[i]) for i in order], np.int64)
        self.text = np.frombuffer(b"".join([texts[i] for i in order]), np.uint8)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        # Rows of the same id are one document here.
        self.ids, rank = np.unique(ids[self.order], return_inverse=True)
        self.rank = np.repeat(rank.astype(np.int32), self.lengths)

    def _room(self, length: int) -> np.ndarray:
        """Places where a string of this length starts inside its document."""
        free = np.maximum(self.lengths - length + 1, 0)
        sizes = np.column_stack((free, self.lengths - free)).ravel()
        return np.repeat(np.tile([True, False], len(free)), sizes)

    @cached_property
    def samples(self) -> np.ndarray:
        member = np.zeros(PERIOD, bool)
        member[list(COVER)] = True
        longest = np.resize(member, int(self.lengths.max(initial=0)))
        mask = np.concatenate([longest[:n] for n in self.lengths.tolist()])
        return np.flatnonzero(mask & self._room(SHORT))

    # 1: short sample strings

    def short_names(self, buckets: int) -> Groups:
        names = hasher().at(self.text, self.samples, SHORT, 0)
        return Groups(_bucket_of(names, buckets) << np.uint64(32) | names & np.uint64(0xFFFFFFFF))

    def send_short(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        keys = self.short_names(buckets).keys
        yield from _by_bucket(keys >> np.uint64(32), lambda a, b: _write_short(keys[a:b]))

    def shared(self, buckets: int, replies: list[bytes]) -> np.ndarray:
        """Which samples have a string that occurs in another document."""
        groups = self.short_names(buckets)
        rank = self.rank[self.samples]
        several = groups.most(rank) > groups.least(rank)
        return (several | _read_bits(replies, len(several)))[groups.number]

    # 2: long sample strings

    def long(self, shared: np.ndarray) -> np.ndarray:
        places = self.samples[shared]
        return places[self._room(LONG)[places]]

    def early_names(
        self, places: np.ndarray, length: int, buckets: int
    ) -> tuple[Groups, np.ndarray, np.ndarray, np.ndarray]:
        """Groups of equal strings, the first document of each, their order by bucket and document, and bucket."""
        groups = Groups(hasher().at(self.text, places, length, 0))
        first = groups.least(self.rank[places])
        # The bucket comes from a second fingerprint and so adds to the first one's length.
        bucket = np.empty(len(first), np.uint64)
        bucket[groups.number] = _bucket_of(hasher().at(self.text, places, length, 1), buckets)
        order = np.argsort(bucket * np.uint64(len(self.ids)) + first.astype(np.uint64))
        return groups, first, order, bucket

    def send_early(self, places: np.ndarray, length: int, buckets: int) -> Iterator[tuple[int, bytes]]:
        groups, first, order, bucket = self.early_names(places, length, buckets)
        names, ids = groups.keys[order], self.ids[first[order]]
        yield from _by_bucket(bucket[order], lambda a, b: _write_early(names[a:b], ids[a:b]))

    def early(self, places: np.ndarray, length: int, buckets: int, replies: list[bytes]) -> np.ndarray:
        """Which of the places have a string that occurs in a smaller document."""
        groups, first, order, _ = self.early_names(places, length, buckets)
        flags = np.empty(len(first), bool)
        flags[order] = _read_bits(replies, len(first))
        return flags[groups.number] | (self.rank[places] > first[groups.number])

    def covered(self, places: np.ndarray, length: int) -> np.ndarray:
        # At most LONG places cover a byte, so a byte counts them.
        change = np.zeros(len(self.text) + 1, np.int8)
        change[places] += 1
        change[places + length] -= 1
        return np.cumsum(change[:-1], dtype=np.int8) > 0

    # 3: suffixes that the samples leave open

    def open_places(self, shared: np.ndarray, settled: np.ndarray) -> np.ndarray:
        """Suffixes with a shared sample in reach that no settled string contains."""
        samples = self.samples[shared]
        change = np.zeros(len(self.text) + 1, np.int8)
        low = samples - (PERIOD - 1)
        change[0] += np.count_nonzero(low < 0)
        change[low[low >= 0]] += 1
        change[samples + 1] -= 1
        reach = np.cumsum(change[:-1], dtype=np.int8) > 0
        return np.flatnonzero(reach & self._room(LENGTH) & ~self.covered(settled, LONG - LENGTH + 1))

    def removed(self, settled: np.ndarray, places: np.ndarray, early: np.ndarray) -> np.ndarray:
        """Mask of the bytes that go."""
        return self.covered(settled, LONG) | self.covered(places[early], LENGTH)


def _by_bucket(bucket: np.ndarray, body) -> Iterator[tuple[int, bytes]]:
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)] if len(bucket) else []):
        yield int(bucket[a]), body(int(a), int(b))


def _write_short(keys: np.ndarray) -> bytes:
    """Ascending 32-bit names as differences, byte by byte of their significance."""
    names = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    steps = np.diff(names, prepend=np.uint32(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _read_short(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def _write_early(names: np.ndarray, ids: np.ndarray) -> bytes:
    cuts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    sizes = np.diff(np.r_[cuts, len(ids)])
    return np.array([len(cuts)], np.int64).tobytes() + ids[cuts].tobytes() + sizes.tobytes() + names.tobytes()


def _read_early(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts = np.frombuffer(body, np.int64)
    n = int(parts[0])
    return parts[1 + 2 * n :].view(np.uint64), np.repeat(parts[1 : 1 + n], parts[1 + n : 1 + 2 * n])


def _read_bits(replies: list[bytes], n: int) -> np.ndarray:
    """Replies in order of their buckets; each starts with its number of bits."""
    out = [
        np.unpackbits(np.frombuffer(r, np.uint8, offset=8), count=int(np.frombuffer(r, np.int64, 1)[0])) for r in replies
    ]
    bits = np.concatenate(out) if out else np.empty(0, np.uint8)
    if len(bits) != n:
        raise ValueError(f"{len(bits)} replies to {n} fingerprints")
    return bits.astype(bool)


def _write_bits(bits: np.ndarray) -> bytes:
    return np.array([len(bits)], np.int64).tobytes() + np.packbits(bits).tobytes()


# -- the jobs --------------------------------------------------------------

#: Rows between the steps.  ``bucket`` is the receiver; a note that a block keeps for its
#: next step has a negative one of its own.
MESSAGE = "block bigint, bucket bigint, body binary"
_MESSAGE_TYPE = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("body", pa.binary())])


def _messages(block: int, rows: Iterator[tuple[int, bytes]], note: bytes | None = None) -> pa.Table:
    rows = list(rows)
    if note is not None:
        rows.append((-1 - block, note))
    buckets, bodies = zip(*rows) if rows else ((), ())
    return pa.table([[block] * len(rows), list(buckets), list(bodies)], schema=_MESSAGE_TYPE)


def _answer_short(table: pa.Table) -> pa.Table:
    """Sort a bucket of short sample strings: a bit for each that another block sent as well."""
    bodies = [_read_short(b) for b in table.column("body").to_pylist()]
    groups = Groups(np.concatenate(bodies))
    sizes = np.diff(np.r_[groups.starts, len(groups.number)])
    return _answers(table, (sizes > 1)[groups.number], [len(b) for b in bodies])


def _answer_early(table: pa.Table) -> pa.Table:
    """Sort a bucket of strings: a bit for each that a smaller document of another block has."""
    bodies = [_read_early(b) for b in table.column("body").to_pylist()]
    groups = Groups(np.concatenate([names for names, _ in bodies]))
    ids = np.concatenate([ids for _, ids in bodies])
    return _answers(table, groups.least(ids)[groups.number] < ids, [len(names) for names, _ in bodies])


def _answers(table: pa.Table, bits: np.ndarray, sizes: list[int]) -> pa.Table:
    parts = np.split(bits, np.cumsum(sizes)[:-1])
    return pa.table(
        [table.column("block").combine_chunks(), table.column("bucket").combine_chunks(), [_write_bits(p) for p in parts]],
        schema=_MESSAGE_TYPE,
    )


def _asked(messages: DataFrame, answer, label: str) -> DataFrame:
    """The answers of every bucket; notes pass by."""

    def one(key, table):
        return answer(table) if key[0].as_py() >= 0 else table

    return staged(messages.groupBy("bucket").applyInArrow(one, MESSAGE), label)


def _block_of(table: pa.Table) -> Block:
    ids = table.column("__id").fill_null(NULL_ID).to_numpy()
    return Block(ids, table.column("__text").to_pylist())


def _told(table: pa.Table) -> tuple[list[bytes], bytes | None]:
    """Answers in order of their buckets, and the block's own note."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("body").to_pylist()), key=lambda r: r[0])
    notes = [body for bucket, body in rows if bucket < 0]
    return [body for bucket, body in rows if bucket >= 0], notes[0] if notes else None


def blocks_table(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, int]:
    """Documents written once, in blocks that are bucketed by their number; and the buckets to use.

    A block ends before its bytes pass the limit, so only a longer document makes a longer block.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    limit = BLOCK_BYTES
    parts = tasks(spark)
    kept = [F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)]
    name = f"satlake_blocks_{uuid.uuid4().hex}"
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("__id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("__text"),
        *kept,
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            blocks = []
            for size in pc.add(pc.binary_length(batch.column(1)), ROW_BYTES).to_pylist():
                if held and held + size > limit:
                    block, held = block + 1, 0
                held += size
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.int64())], names=[*batch.schema.names, "block"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    (
        rows.mapInArrow(cut, f"{fields}, block bigint")
        .write.bucketBy(parts, "block")
        .option("compression", "zstd")
        .option("path", fresh_path(spark, "blocks"))
        .saveAsTable(name)
    )
    samples = total * len(COVER) // PERIOD
    return spark.table(name), max(2 * parts, samples // BUCKET_ROWS + 1)


def repeats(docs: DataFrame, keep: list[str], with_text: bool = False) -> DataFrame:
    """One row per document: ``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256.

    ``with_text`` adds ``kept``, what stays as text without characters that were cut.
    """
    ship(docs.sparkSession)
    blocks, buckets = blocks_table(docs, keep)
    by_block = blocks.groupBy("block")

    def first(key, table):
        return _messages(key[0].as_py(), _block_of(table).send_short(buckets))

    def second(key, table, told):
        block = _block_of(table)
        shared = block.shared(buckets, _told(told)[0])
        return _messages(key[0].as_py(), block.send_early(block.long(shared), LONG, buckets), _pack(shared))

    def third(key, table, told):
        block = _block_of(table)
        answers, note = _told(told)
        shared, long, settled = _settled(block, note, lambda long: block.early(long, LONG, buckets, answers))
        places = block.open_places(shared, long[settled])
        flags = _pack(settled)
        note = len(flags).to_bytes(8, "little") + flags + note
        return _messages(key[0].as_py(), block.send_early(places, LENGTH, buckets), note)

    def last(key, table, told):
        block = _block_of(table)
        answers, note = _told(told)
        n = int.from_bytes(note[:8], "little")
        shared, long, settled = _settled(block, note[8 + n :], lambda long: _unpack(note[8 : 8 + n], len(long)))
        places = block.open_places(shared, long[settled])
        gone = block.removed(long[settled], places, block.early(places, LENGTH, buckets, answers))
        return _result(block, table, gone, len(keep), with_text)

    answers = _asked(by_block.applyInArrow(first, MESSAGE), _answer_short, "suffix-short")
    for step, label in ((second, "suffix-long"), (third, "suffix-open")):
        sent = by_block.cogroup(answers.groupBy("block")).applyInArrow(step, MESSAGE)
        answers = _asked(sent, _answer_early, label)
    fields = [f"__keep{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    fields += ["n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string"]
    fields += ["kept string"] * with_text
    found = by_block.cogroup(answers.groupBy("block")).applyInArrow(last, ", ".join(fields))
    for i, c in enumerate(keep):
        found = found.withColumnRenamed(f"__keep{i}", c)
    return found


def _settled(block: Block, note: bytes, flags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shared = _unpack(note, len(block.samples))
    long = block.long(shared)
    return shared, long, flags(long)


def _result(block: Block, table: pa.Table, gone: np.ndarray, n_keep: int, with_text: bool) -> pa.Table:
    before = np.r_[0, np.cumsum(gone)]
    removed = before[block.ends] - before[block.starts]
    begins = gone & ~np.r_[False, gone[:-1]] if len(gone) else gone
    starts = block.starts[block.lengths > 0]
    begins[starts] = gone[starts]
    runs = np.r_[0, np.cumsum(begins)]
    spans = runs[block.ends] - runs[block.starts]
    left = block.text[~gone].tobytes()
    cuts = np.cumsum(block.lengths - removed)
    kept = [left[b - n : b] for b, n in zip(cuts.tolist(), (block.lengths - removed).tolist())]
    rows = table.take(pa.array(block.order))
    columns = [rows.column(f"__keep{i}") for i in range(n_keep)]
    columns += [pa.array(block.lengths), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64))]
    columns.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
    names = [f"__keep{i}" for i in range(n_keep)] + ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        columns.append(pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()))
        names.append("kept")
    return pa.table(columns, names=names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with what stays as their text, n_chars counted anew; no row is dropped.

    A character of which only some bytes stay goes as a whole.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    found = repeats(docs, others, with_text=True).withColumn("text", F.col("kept"))
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)
