"""Encoding and decoding with a merge-type (BPE) piece vocabulary.

A text becomes one symbol per code point; of all adjacent pairs that form a
piece, the one with the best score is merged first, the leftmost of equals,
until none is left.  Pieces never join a blank to the characters before it, so
a text is cut there and each distinct stretch is encoded once per batch: short
stretches together, one agenda per matrix row, long ones by a heap.  Every
newly encoded stretch is checked against the sentencepiece library.

Defined results: null is the empty text, which has no ids; characters without a
piece become byte pieces; control strings in a text are ordinary text; repeated
rows are kept.  Only the named columns are read.  Vocabularies need byte pieces
and the identity normaliser (refused otherwise).
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import ship

BLANK = "▁"

#: Longer stretches go through the heap, shorter ones through matrices.
MATRIX_CHARS = 40
#: Characters encoded at a time (one text at least), and stretches that a worker remembers.
SLICE_CHARS = 1_000_000
REMEMBERED = 200_000

_EMPTY = -1


class PairTable:
    """Open-addressed map from (left symbol, right symbol) to (merged symbol, score)."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, float]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.mask = (1 << bits) - 1
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _EMPTY, np.int64)
        self.merged = np.full(1 << bits, -1, np.int32)
        self.scores = np.full(1 << bits, -np.inf, np.float32)
        keys = np.fromiter((left << 32 | right for left, right in pairs), np.int64, len(pairs))
        for key, slot, (merged, score) in zip(keys.tolist(), self._slots(keys).tolist(), pairs.values()):
            while self.keys[slot] != _EMPTY:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.merged[slot], self.scores[slot] = key, merged, score

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; the slot of a pair that forms no piece has score -inf."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        slots = self._slots(keys)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != _EMPTY))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            held = self.keys[slots[open_]]
            open_ = open_[(held != keys[open_]) & (held != _EMPTY)]
        return slots


class PieceEncoder:
    """Encoder of one vocabulary, given as the bytes of its model file."""

    def __init__(self, model: bytes, check: bool = True):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        spec = pb.ModelProto()
        spec.ParseFromString(model)
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback:
            raise ValueError("the vocabulary must be of the merge type and have byte pieces")
        normal = spec.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.add_dummy_prefix:
            raise ValueError("the vocabulary must use the identity normaliser with a dummy prefix")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None
        ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == 1}
        scores = {i: p.score for i, p in enumerate(spec.pieces)}
        if any(BLANK in p.lstrip(BLANK) for p in ids):
            raise ValueError("a piece joins a blank to the characters before it")
        self.bytes = [0] * 256
        for i, p in enumerate(spec.pieces):
            if p.type == 6:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.text = [p.piece for p in spec.pieces]
        self.number = [str(i) for i in range(len(self.text))]
        self.ids_of_byte = {i: b for b, i in enumerate(self.bytes)}
        # Characters that only occur inside pieces are symbols as well, numbered behind the pieces.
        symbols = dict(ids)
        for char in sorted({c for p in ids for c in p}):
            symbols.setdefault(char, len(spec.pieces) + len(symbols))
        self.n_pieces = len(spec.pieces)
        self.extra = {s: c for c, s in symbols.items() if s >= self.n_pieces}
        # A code point that is in no piece is the symbol -1 - code point.
        self.of_point = -1 - np.arange(0x110000, dtype=np.int32)
        for text, s in symbols.items():
            if len(text) == 1:
                self.of_point[ord(text)] = s
        pairs = {}
        for text, i in ids.items():
            for k in range(1, len(text)):
                left, right = symbols.get(text[:k]), symbols.get(text[k:])
                if left is not None and right is not None:
                    pairs[left, right] = (i, scores[i])
        self.pairs = pairs
        self.table = PairTable(pairs)
        self.line_cut = all("\n" not in p for p in ids)
        self.known: dict[str, str] = {}
        self.inexact: set[str] = set()

    # -- merging ---------------------------------------------------------

    def agenda(self, symbols: list[int]) -> list[int]:
        """Merge one stretch by a heap of (score, place) with links between neighbours."""
        n = len(symbols)
        symbols = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, heap = self.pairs, []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := pairs.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (-found[1], i, symbols[i], symbols[j], found[0]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def matrix(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all rows (one stretch each, equally long); returns the symbols and their counts.

        The scores of a row's pairs are its agenda; each round takes the best,
        leftmost, of every row that still has one.
        """
        n, width = symbols.shape
        out, counts = symbols, np.full(n, width, np.int32)
        if width < 2:
            return out, counts
        rows = np.arange(n)
        symbols = symbols.copy()
        slots = self.table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, width - 1)
        scores = self.table.scores[slots]
        out = symbols.copy()
        while True:
            best = scores.argmax(axis=1)
            at = np.arange(len(rows))
            alive = scores[at, best] > -np.inf
            if not alive.all():
                done = ~alive
                out[rows[done], : symbols.shape[1]] = symbols[done]
                rows, symbols, slots, scores, best = rows[alive], symbols[alive], slots[alive], scores[alive], best[alive]
                at = np.arange(len(rows))
            if not len(rows):
                return out, counts
            symbols[at, best] = self.table.merged[slots[at, best]]
            counts[rows] -= 1
            width = symbols.shape[1] - 1
            # Close the gap behind the merged pair; rows stay equally long in the matrix.
            columns = np.arange(width)
            take = columns + (columns > best[:, None])
            symbols = np.take_along_axis(symbols, take, axis=1)
            if width < 2:
                out[rows, :width] = symbols
                return out, counts
            pairs = np.arange(width - 1)
            take = pairs + (pairs >= best[:, None])
            slots = np.take_along_axis(slots, take, axis=1)
            scores = np.take_along_axis(scores, take, axis=1)
            for place in (best - 1, best):
                here = np.flatnonzero((place >= 0) & (place < width - 1))
                p = place[here]
                slots[here, p] = self.table.find(symbols[here, p], symbols[here, p + 1])
                scores[here, p] = self.table.scores[slots[here, p]]

    def _ids(self, symbols: list[int]) -> list[int]:
        out = []
        for s in symbols:
            if 0 <= s < self.n_pieces:
                out.append(s)
            else:
                char = self.extra[s] if s >= 0 else chr(-1 - s)
                out.extend(self.bytes[b] for b in char.encode())
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, with the blank that encoding puts in front taken off."""
        text = self._plain(ids)
        return text[1:] if text.startswith(" ") else text

    def _plain(self, ids: list[int]) -> str:
        out, held = [], bytearray()
        for i in ids:
            if i in self.ids_of_byte:
                held.append(self.ids_of_byte[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.text[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(BLANK, " ")

    # -- stretches -------------------------------------------------------

    def learn(self, stretches: list[str]) -> None:
        """Encode the stretches and remember their ids as text."""
        by_length: dict[int, list[str]] = {}
        found: list[tuple[str, list[int]]] = []
        for s in stretches:
            by_length.setdefault(len(s), []).append(s)
        exact: list[tuple[str, list[int]]] = []
        for length, group in by_length.items():
            points = np.frombuffer("".join(group).encode("utf-32-le"), np.int32).reshape(len(group), length)
            symbols = self.of_point[points]
            if length > MATRIX_CHARS:
                found.extend((s, self._ids(self.agenda(row))) for s, row in zip(group, symbols.tolist()))
                continue
            merged, counts = self.matrix(symbols)
            odd = ((merged < 0) | (merged >= self.n_pieces)).any(axis=1)
            for s, row, n, unknown in zip(group, merged.tolist(), counts.tolist(), odd.tolist()):
                if unknown:
                    found.append((s, self._ids(row[:n])))
                else:
                    exact.append((s, row[:n]))
        if self.library:
            self._compare(found)
            self._compare(exact)
        known, number, text = self.known, self.number, self.text
        for s, ids in found:
            known[s] = ",".join([number[i] for i in ids])
            if self._plain(ids) != s.replace(BLANK, " "):
                self.inexact.add(s)
        for s, ids in exact:
            known[s] = ",".join([number[i] for i in ids])
            if "".join([text[i] for i in ids]) != s:
                self.inexact.add(s)

    def _compare(self, found: list[tuple[str, list[int]]]) -> None:
        # The library puts a blank in front; a stretch without one is set behind a line feed.
        texts = [s[1:].replace(BLANK, " ") if s[0] == BLANK else "\n" + s for s, _ in found]
        skip = len(self.library.encode("\n"))
        for (s, ids), theirs in zip(found, self.library.encode(texts, num_threads=1)):
            if (theirs if s[0] == BLANK else theirs[skip:]) != ids and s != BLANK:
                raise ValueError(f"{s!r}: {ids} differs from the library's {theirs}")

    def stretches(self, text: str) -> list[str]:
        """Cut where no piece can reach across; joined again they are the text with its blanks marked."""
        if not text:
            return []
        if not self.line_cut:
            return _CUT.findall(BLANK + text.replace(" ", BLANK))
        out: list[str] = []
        marked = BLANK in text
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append("\n")
            if marked or "  " in line or line[:1] == " " or line[-1:] == " " or not line:
                out.extend(_CUT.findall((BLANK if not k else "") + line.replace(" ", BLANK)))
            else:
                out.extend(((BLANK if not k else "") + line.replace(" ", " " + BLANK)).split(" "))
        return out

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """(ids joined by commas, decoded text) of each text."""
        cut = [self.stretches(t) for t in texts]
        met = set().union(*cut)
        if len(self.known) > REMEMBERED:
            self.known = {p: self.known[p] for p in met if p in self.known}
        fresh = met.difference(self.known)
        if fresh:
            self.learn(list(fresh))
        known, inexact = self.known, self.inexact
        for text, parts in zip(texts, cut):
            ids = ",".join([known[p] for p in parts])
            if BLANK in text or (inexact and not inexact.isdisjoint(parts)):
                yield ids, self.decode([int(i) for i in ids.split(",")] if ids else [])
            else:
                # Every stretch decodes to itself, so the text does.
                yield ids, text


_CUT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")

_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(model: bytes, check: bool) -> PieceEncoder:
    """The worker's encoder of this vocabulary; it keeps what it has learnt."""
    name = (hashlib.sha256(model).hexdigest(), check)
    if name not in _encoders:
        _encoders[name] = PieceEncoder(model, check)
    return _encoders[name]


def slices(batch: pa.RecordBatch, text_column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about SLICE_CHARS bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False)
    at = held = 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_CHARS:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)


def encode_documents(
    docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",), check: bool = True, with_ids: bool = True
) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids.

    The model file is read by the driver and sent to the tasks: it holds one
    vocabulary and does not grow with the documents.
    """
    ship(docs.sparkSession)
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = list(keep)
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    fields += ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model.value, check)
        for batch in batches:
            for part in slices(batch, len(kept)):
                texts = [t or "" for t in part.column(len(kept)).to_pylist()]
                counts, ids_digest, text_digest, ids_lists = [], [], [], []
                for ids, text in own.encode_all(texts):
                    counts.append(ids.count(",") + 1 if ids else 0)
                    ids_digest.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_digest.append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        ids_lists.append(np.fromstring(ids, np.int32, sep=","))
                columns = [part.column(i) for i in range(len(kept))]
                columns += [pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())]
                if with_ids:
                    columns.append(pa.array(ids_lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *_NAMES][: len(columns)])

    return docs.select(*kept, F.col("text")).mapInArrow(run, ", ".join(fields))


_NAMES = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
