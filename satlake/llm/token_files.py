"""Texts to token-id files, coded with one shared frequency table, and back.

``encode_texts`` gives each document its ids.  ``write_ids`` counts the ids of
all documents into one frequency table and writes files of whole documents in
ascending order of their ids:

    magic
    block 0 | block 1 | ...        each coded on its own (see ``rans``)
    checkpoints                    per block: offset, bytes, ids, CRC-32 of the coded bytes and of the ids
    documents                      per document: doc_id or null, number of ids
    counts, CRC-32 of both tables, CRC-32 of the frequency table, magic

``read_documents`` decodes runs of blocks in parallel: a checkpoint says where
a block lies and how many ids come before it, so a task reads the tail of a
file, the blocks of its run and, for the last document that starts there, what
follows.  Every checksum is compared.

The files' names carry the attempt that wrote them and only the manifest, a
table written with the job, says which of them count: a task that is run again
or twice leaves a file that nobody reads.

Defined results
  null or empty text   no ids but the end id, if one is asked for
  null id              after all others, in files as in the order
  equal ids, repeated rows   each is a document of its own, in an order fixed
                       by the written ids
  very long text       cut at blanks for the library, which leaves its ids as
                       they are; ids may run over many blocks
  empty table          no file, no rows
  other columns        not looked at, whatever their names
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satlake.llm.common import LOWER, UPPER, ship, staged, tasks
from satlake.llm.rans import FrequencyTable, decode_block, encode_block
from satlake.session import fresh_path

#: Units of up to this many characters are remembered with their ids, so many at a time.
UNIT_CHARS = 48
REMEMBERED = 400_000
#: New units given to the library as one text.
TOGETHER = 1024
#: Text whose words are numbered at once, in bytes.
SLICE_BYTES = 1 << 24

#: Ids counted at once.
COUNTED_IDS = 1 << 20
BLOCK_IDS = 1 << 18
#: A file is closed with the document that brings it to this many ids.
FILE_IDS = 1 << 23
#: Blocks that one reading task decodes at a time.
RUN_BLOCKS = 8

#: Units of words whose parts any version of Unicode classes alike: letters of the first Latin
#: blocks, single digits, other ASCII signs.  The apostrophe, which may begin a unit with letters, is in none,
#: nor is the dotted capital I, whose small form is a letter and a mark.
_UNIT = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+|[0-9]|[!-&(-/:-@[-`{-~]+"
#: The same for Arrow, and words that consist of units only.
_ARROW_UNIT = "(" + _UNIT.replace("@[-`", "@\\[-`") + ")"
_PLAIN = r"\A(?:" + _ARROW_UNIT + r")+\z"
_TRIED = [chr(c) for c in range(0x21, 0x7F) if c != 0x27] + list("ÀØéßÿœƵɏ")


def _joined(parts: pa.Array, stops: np.ndarray) -> pa.Array:
    """The binary values up to each stop run together; ``parts`` has no nulls and starts its own buffers."""
    _, offsets, data = parts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(parts) + 1)[np.r_[0, stops]]
    return pa.Array.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(ends), data])


class WordEncoder:
    """Ids of texts by the library, asked once for each unit of the words between ASCII blanks.

    Right for vocabularies that drop white space and never join across it, as
    those with word ends do: a text's ids are then those of its words in turn.
    A word's ids are in the same way those of its units, each of which ends in
    an id with the mark of word ends.  Whether the vocabulary has these units
    is tried out first, on all pairs of signs; other words, and those with a
    string that the library takes out beforehand, are one unit each.  New units
    go to the library many at a time and get their ids by the marks; groups
    whose marks do not fit go unit by unit.  Capital ASCII letters are one with
    the small ones where the vocabulary's own normalizer says so.
    """

    def __init__(self, model: str, id_type: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.id_type = np.dtype(id_type)
        # The empty word stands before a leading and after a trailing blank.
        self.known: dict[str, bytes] = {"": b""}
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for said, i in vocabulary.items() if said.endswith(suffix)]] = True
        # Strings that the library takes out of a text before it looks for words.
        taken = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.taken = "|".join(taken)
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and all(
            normalizer.normalize_str(said) == LOWER for said in (UPPER, LOWER)
        )
        pairs = [a + b for a in _TRIED for b in _TRIED]
        units = [re.findall(_UNIT, pair) for pair in pairs]
        different = sorted({u for cut in units for u in cut})
        alone = dict(zip(different, self._ids(different)))
        self.counted = all(
            ids == [i for u in cut for i in alone[u]] and self.ends[ids].sum() == len(cut) and self.ends[ids[-1]]
            for cut, ids in zip(units, self._ids(pairs))
        )

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, units: list[str]) -> None:
        for unit, ids in zip(units, self._ids(units)):
            self.known[unit] = np.array(ids, self.id_type).tobytes()

    def _together(self, units: list[str]) -> None:
        [found] = self._ids([" ".join(units)])
        ids = np.array(found, self.id_type)
        marks = np.flatnonzero(self.ends[ids])
        if len(marks) != len(units) or marks[-1] + 1 != len(ids):
            self._alone(units)
            return
        packed, stops = ids.tobytes(), ((marks + 1) * self.id_type.itemsize).tolist()
        self.known.update(zip(units, [packed[a:b] for a, b in zip([0, *stops], stops)]))

    def _with_taken(self, words: pa.Array) -> pa.Array:
        if not self.taken:
            return pa.repeat(False, len(words))
        return pc.match_substring_regex(words, self.taken, ignore_case=True)

    def learn(self, units: list[str]) -> None:
        new = pa.array(units, pa.large_string())
        fits = pc.and_not(pc.match_substring_regex(new, r"\A(?:" + _ARROW_UNIT + r")\z"), self._with_taken(new))
        single = fits if self.counted else pa.repeat(False, len(new))
        for chosen, ask in ((single, self._together), (pc.invert(single), self._alone)):
            asked = new.filter(chosen).to_numpy(zero_copy_only=False).tolist()
            for at in range(0, len(asked), TOGETHER):
                ask(asked[at : at + TOGETHER])

    def _units(self, words: pa.Array) -> pa.Array:
        """The units of each word, and the empty one; words that are not plain are one unit."""
        if not self.counted:
            return pc.ascii_split_whitespace(words)
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), self._with_taken(words))
        cut = pc.replace_substring_regex(pc.ascii_lower(words) if self.lowers else words, _ARROW_UNIT, r"\1 ")
        return pc.ascii_split_whitespace(pc.if_else(plain, cut, words))

    def _packed(self, words: pa.Array, end: bytes) -> pa.Array:
        """The packed ids of different words, and ``end`` after the last."""
        units = self._units(words)
        numbered = units.flatten().dictionary_encode()
        names = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known = {u: self.known[u] for u in ["", *names] if u in self.known}
        known = self.known
        found = list(map(known.get, names))
        fresh = [u for u, ids in zip(names, found) if ids is None]
        if fresh:
            self.learn(fresh)
            found = list(map(known.get, names))
            for unit in fresh:
                if len(unit) > UNIT_CHARS:
                    del known[unit]
        # The end is one more unit of one more word.
        numbers = np.append(numbered.indices.to_numpy(), len(found))
        laid = pa.array([*found, end], pa.large_binary()).take(pa.array(numbers))
        stops = units.offsets.to_numpy()[1:] - units.offsets[0].as_py()
        return _joined(laid, np.append(stops, len(numbers)))

    def __call__(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The packed ids of each text, with ``end`` after each.

        Arrow cuts and numbers the words, and the units of the different ones;
        the ids are laid out once and gathered by number.
        """
        cut = pc.ascii_split_whitespace(texts)
        numbered = cut.flatten().dictionary_encode()
        packed = self._packed(numbered.dictionary, end)
        # The end id is one more word, after the last of each text.
        last = cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()
        numbers = np.insert(numbered.indices.to_numpy(), last, len(packed) - 1)
        laid = packed.take(pa.array(numbers))
        return _joined(laid, last + np.arange(1, len(last) + 1)).cast(pa.binary())


_encoders: dict[tuple[int, str], WordEncoder] = {}


def encoder(model: str, kind: str) -> WordEncoder:
    """The worker's encoder of this vocabulary; it keeps what it has learnt from task to task."""
    name = (crc32(model.encode()), kind)
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = WordEncoder(model, kind)
    return _encoders[name]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows in groups of about SLICE_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = held = 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(at, row - at)
            at, held = row, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)


def id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def encode_texts(docs: DataFrame, vocabulary_path: str, end_id: int | None) -> tuple[DataFrame, str]:
    """(doc_id, ids as packed integers) of every document, and the type of the integers.

    The vocabulary file is read by the driver and sent to the tasks; it does
    not grow with the documents.  It has to be one with word ends that drops
    white space, in the file format of the tokenizers library.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        said = file.read()
    tokenizer = Tokenizer.from_str(said)
    if not getattr(tokenizer.model, "end_of_word_suffix", None):
        raise ValueError("words can be encoded apart only with a vocabulary that marks their ends")
    kind = id_type(tokenizer.get_vocab_size(with_added_tokens=True))
    end = b"" if end_id is None else np.array([end_id], kind).tobytes()
    model = spark.sparkContext.broadcast(said)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model.value, kind)
        for batch in batches:
            for some in _slices(batch, 1):
                yield pa.RecordBatch.from_arrays([some.column(0), encode(some.column(1), end)], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary"), kind


def count_ids(encoded: DataFrame, kind: str) -> dict[int, int]:
    """How often each id occurs; tasks and driver hold at most one number per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(0).cast(pa.large_binary())
            _, offsets, data = values.buffers()
            bounds = np.frombuffer(offsets, np.int64, len(values) + 1, 8 * values.offset)
            n_ids = int(bounds[-1] - bounds[0]) // np.dtype(kind).itemsize
            ids = np.frombuffer(data, kind, n_ids, int(bounds[0])) if n_ids else np.zeros(0, kind)
            for at in range(0, n_ids, COUNTED_IDS):
                found = np.bincount(ids[at : at + COUNTED_IDS])
                if len(found) > len(totals):
                    totals = np.r_[totals, np.zeros(len(found) - len(totals), np.int64)]
                totals[: len(found)] += found
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some], pa.int64())], names=["id", "n"])

    counted = encoded.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in counted.collect()}


# -- files --------------------------------------------------------------------

MAGIC = b"RIDS0001"
_POINT = np.dtype([("offset", "<u8"), ("size", "<u4"), ("n_ids", "<u4"), ("data_crc", "<u4"), ("ids_crc", "<u4")])
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("named", "u1"), ("n_ids", "<u8")])
_TAIL = struct.Struct("<IIII8s")


class FileWriter:
    """One file; holds no more than a block of ids and the two tables."""

    def __init__(self, out, table: FrequencyTable):
        self.out, self.table, self.waiting, self.n_waiting = out, table, [], 0
        self.points: list[tuple] = []
        self.documents: list[tuple] = []
        self.n_ids, self.offset = 0, len(MAGIC)
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id or 0, doc_id is not None, len(ids)))
        self.n_ids += len(ids)
        while len(ids):
            taken = ids[: BLOCK_IDS - self.n_waiting]
            self.waiting.append(taken)
            self.n_waiting += len(taken)
            ids = ids[len(taken) :]
            if self.n_waiting == BLOCK_IDS:
                self._block()

    def _block(self) -> None:
        ids = np.concatenate(self.waiting).astype("<u4")
        data = encode_block(ids, self.table)
        self.points.append((self.offset, len(data), len(ids), crc32(data), crc32(ids)))
        self.out.write(data)
        self.offset += len(data)
        self.waiting, self.n_waiting = [], 0

    def close(self, table_crc: int) -> None:
        if self.n_waiting:
            self._block()
        tables = np.array(self.points, _POINT).tobytes() + np.array(self.documents, _DOCUMENT).tobytes()
        tail = _TAIL.pack(len(self.points), len(self.documents), crc32(tables), table_crc, MAGIC)
        self.out.write(tables + tail)
        self.out.close()


class FileReader:
    """Checkpoints and documents of one file, and any of its blocks."""

    def __init__(self, path: str, table: FrequencyTable, table_crc: int):
        system, place = fs.FileSystem.from_uri(path)
        self.path, self.table, self.file = path, table, system.open_input_file(place)
        size = self.file.size()
        n_points, n_documents, crc, coded_with, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or coded_with != table_crc:
            raise ValueError(f"{path} is no id file of this frequency table")
        length = n_points * _POINT.itemsize + n_documents * _DOCUMENT.itemsize
        tables = self.file.read_at(length, size - _TAIL.size - length)
        if crc32(tables) != crc:
            raise ValueError(f"the tables of {path} are damaged")
        self.points = np.frombuffer(tables, _POINT, n_points)
        self.documents = np.frombuffer(tables, _DOCUMENT, n_documents, n_points * _POINT.itemsize)
        #: Ids before each block, and before each document.
        self.block_starts = np.r_[0, np.cumsum(self.points["n_ids"], dtype=np.int64)]
        self.document_starts = np.r_[0, np.cumsum(self.documents["n_ids"].astype(np.int64))]

    def block(self, k: int) -> np.ndarray:
        point = self.points[k]
        data = self.file.read_at(int(point["size"]), int(point["offset"]))
        if crc32(data) != point["data_crc"]:
            raise ValueError(f"block {k} of {self.path} is damaged")
        ids = decode_block(data, int(point["n_ids"]), self.table).astype("<u4", copy=False)
        if crc32(ids) != point["ids_crc"]:
            raise ValueError(f"the ids of block {k} of {self.path} are wrong")
        return ids

    def blocks(self, first: int) -> Iterator[tuple[int, np.ndarray]]:
        """(ids before, ids) of the blocks from ``first`` on."""
        for k in range(first, len(self.points)):
            yield int(self.block_starts[k]), self.block(k)

    def documents_of(self, first: int, last: int) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
        """(doc_id, ids before, number of ids, pieces of ids) of the documents that start in blocks first..last-1.

        Documents without an id start with the next one, or in the last block.
        The pieces have to be read before the next document is asked for.
        """
        low, high = self.block_starts[first], self.block_starts[last]
        at = int(np.searchsorted(self.document_starts[:-1], low, "left")) if first else 0
        end = len(self.documents) if last == len(self.points) else int(np.searchsorted(self.document_starts[:-1], high, "left"))
        source = self.blocks(first)
        before, held = next(source) if first < len(self.points) else (0, np.zeros(0, np.uint32))

        def pieces(start: int, n: int) -> Iterator[np.ndarray]:
            nonlocal before, held
            while n:
                while start >= before + len(held):
                    before, held = next(source)
                piece = held[start - before : start - before + n]
                yield piece
                start, n = start + len(piece), n - len(piece)

        for k in range(at, end):
            name, start, n = self.documents[k], int(self.document_starts[k]), int(self.documents[k]["n_ids"])
            yield int(name["doc_id"]) if name["named"] else None, start, n, pieces(start, n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Any stretch of ids, decoding only the blocks that hold it."""
        first = int(np.searchsorted(self.block_starts, start, "right")) - 1
        found, left = [], n
        for before, held in self.blocks(first):
            if not left:
                break
            piece = held[max(0, start - before) : max(0, start - before) + left]
            found.append(piece)
            left -= len(piece)
        return np.concatenate(found) if found else np.zeros(0, "<u4")


def write_ids(encoded: DataFrame, kind: str, path: str) -> None:
    """Write the files of (doc_id, ids) below ``path``, with their frequency table and manifest.

    The ids are written once as a table; one shuffle deals them by ranges of
    doc_id.  The driver holds the frequency table, one entry per id that occurs.
    """
    spark = encoded.sparkSession
    ship(spark)
    encoded = staged(encoded.withColumn("row", F.monotonically_increasing_id()), "ids")
    table = FrequencyTable.from_counts(count_ids(encoded, kind)).to_bytes()
    spark.createDataFrame([(bytearray(table),)], "data binary").coalesce(1).write.parquet(f"{path}/table")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = FrequencyTable.from_bytes(table)
        system, folder = fs.FileSystem.from_uri(f"{path}/files")
        system.create_dir(folder, recursive=True)
        writer, name, done, part, first = None, "", [], 0, 0

        def finish() -> None:
            nonlocal writer, first
            writer.close(crc32(table))
            done.append((part, len(done), name, first, writer.n_ids, len(writer.points), len(writer.documents)))
            first += writer.n_ids
            writer = None

        for batch in batches:
            for doc_id, ids, dealt in zip(*(batch.column(i) for i in range(3))):
                if writer is None:
                    part = dealt.as_py()
                    name = f"ids-{part:05d}-{len(done):05d}-{uuid.uuid4().hex[:12]}.rids"
                    writer = FileWriter(system.open_output_stream(f"{folder}/{name}"), shared)
                writer.add(doc_id.as_py(), np.frombuffer(ids.as_py(), kind))
                if writer.n_ids >= FILE_IDS:
                    finish()
        if writer is not None:
            finish()
        columns = list(zip(*done)) if done else [[]] * 7
        types = [pa.string() if k == 2 else pa.int64() for k in range(7)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_MANIFEST_NAMES)

    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("ids"), F.col("row")]
    dealt = encoded.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    files = dealt.select("doc_id", "ids", F.spark_partition_id().cast("bigint").alias("part")).mapInArrow(write, _MANIFEST)
    files.write.parquet(f"{path}/manifest")


_MANIFEST = "part bigint, number bigint, name string, first bigint, n_ids bigint, n_blocks bigint, n_documents bigint"
_MANIFEST_NAMES = [c.split()[0] for c in _MANIFEST.split(", ")]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files below ``path``.

    Runs of blocks are dealt over the tasks, whichever file they are in.
    """
    ship(spark)
    table = bytes(spark.read.schema("data binary").parquet(f"{path}/table").first().data)
    files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    # One row per task that wrote files.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    runs = files.join(F.broadcast(parts), "part").select(
        F.concat(F.lit(f"{path}/files/"), "name").alias("file"),
        (F.col("base") + F.col("first")).alias("before"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_blocks") - 1, F.lit(0)), F.lit(RUN_BLOCKS))).alias("block"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = FrequencyTable.from_bytes(table)
        for batch in batches:
            for file, before, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                reader = FileReader(file, shared, crc32(table))
                doc_ids, starts, counts, sums = [], [], [], []
                for doc_id, start, n, pieces in reader.documents_of(block, min(block + RUN_BLOCKS, len(reader.points))):
                    total = 0
                    for piece in pieces:
                        total = crc32(np.ascontiguousarray(piece), total)
                    doc_ids.append(doc_id)
                    starts.append(before + start)
                    counts.append(n)
                    sums.append(total)
                columns = [pa.array(c, pa.int64()) for c in (doc_ids, starts, counts, sums)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = runs.repartition(tasks(spark), "file", "block")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def through_files(docs: DataFrame, vocabulary_path: str, end_id: int | None, path: str | None = None) -> DataFrame:
    """Encode all texts, write the id files (to the shared folder unless ``path`` says where) and read them back."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "id-files")
    encoded, kind = encode_texts(docs, vocabulary_path, end_id)
    write_ids(encoded, kind, path)
    return read_documents(spark, path)
