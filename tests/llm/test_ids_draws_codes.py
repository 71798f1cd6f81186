"""Token files, importance draws and part codes against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from satlake.llm import importance, part_codes, queries, rans, token_files

# -- token files --------------------------------------------------------------

WORDS = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary(WORDS))


def brute_files(tokenizer, rows, end=2):
    """(doc_id, start, n_tokens, crc) in file order, by the library on whole texts."""
    said = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows]
    out, start = [], 0
    for i, ids in sorted(said, key=lambda r: (r[0] is None, r[0])):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=3000), st.sampled_from([1, 7, 1000]))
def test_blocks_come_back(ids, commonness):
    values = np.array(ids, np.uint32)
    found, n = np.unique(values, return_counts=True)
    table = rans.FrequencyTable.from_counts({int(i): int(c) * commonness for i, c in zip(found, n)} or {5: 1})
    table = rans.FrequencyTable.from_bytes(table.to_bytes())
    assert rans.decode_block(rans.encode_block(values, table), len(values), table).tolist() == ids


def test_blocks_are_near_the_entropy_and_notice_damage():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 300_000) % 40_000).astype(np.uint32)
    found, n = np.unique(ids, return_counts=True)
    table = rans.FrequencyTable.from_counts(dict(zip(found.tolist(), n.tolist())))
    data = rans.encode_block(ids, table)
    entropy = -(n * np.log2(n / n.sum())).sum() / 8
    assert len(data) < 1.06 * entropy
    hurt = bytearray(data)
    hurt[len(hurt) // 2] ^= 4
    with pytest.raises((ValueError, IndexError)):
        back = rans.decode_block(bytes(hurt), len(ids), table)
        if not (back == ids).all():
            raise ValueError
    with pytest.raises(ValueError):
        rans.FrequencyTable.from_bytes(table.to_bytes()[:-5] + b"\0" * 5)


ODD_WORDS = [
    "It's we'll I'd 12345 á ́start ÅÅ Å",
    "x y z　w\u0085v\x0bq\x0cr\x1cs\x1ft",
    "<|endoftext|> a<|startoftext|>b <|endoftext|",
    "ΣΣ ΟΣ İI ﬁ ẞ\n\n\t  \r\n end",
    "漢字かなカナ" * 50,
    "word" * 5000,
]


def _ids(packed):
    return [np.frombuffer(ids, "<u2").tolist() for ids in packed.to_pylist()]


def test_words_apart_have_the_ids_of_the_whole_text(tokenizer):
    with open(queries.vocabulary(WORDS), encoding="utf-8") as file:
        encode = token_files.WordEncoder(file.read(), "<u2")
    assert encode.counted
    texts = [*ODD_WORDS, "", "x" * 100, " ", ODD_WORDS[0]]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert _ids(encode(pa.array(texts))) == want
    assert _ids(encode(pa.array(texts)[2:], b"\x07\x00")) == [ids + [7] for ids in want[2:]]
    assert _ids(encode(pa.array([], pa.string()))) == []


def test_every_letter_of_a_unit_is_one_beside_any_neighbour(tokenizer):
    with open(queries.vocabulary(WORDS), encoding="utf-8") as file:
        encode = token_files.WordEncoder(file.read(), "<u2")
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250))]
    texts = [said for c in letters for said in (c, f"{c}<", f"<{c}", f"a{c}a", f"X{c}7{c}", f"{c}'s{c}")]
    assert _ids(encode(pa.array(texts))) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_library_is_asked_once_for_each_unit(tokenizer, monkeypatch):
    """Words that differ in capitals or in the signs around them share their units; marks of the vocabulary do not."""
    with open(queries.vocabulary(WORDS), encoding="utf-8") as file:
        encode = token_files.WordEncoder(file.read(), "<u2")
    asked = []
    ids = encode._ids
    monkeypatch.setattr(encode, "_ids", lambda texts: asked.extend(texts) or ids(texts))
    texts = ["Stone stone, (stone) STONE.", "stone,Wall,stone wall <|endoftext|> <|ENDOFTEXT|> x<|endoftext|>stone", "can't Can't 2024 (2024)"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert _ids(encode(pa.array(texts))) == want
    words = [w for said in asked for w in said.split()]
    assert len(words) == len(set(words))
    assert words.count("stone") == words.count("wall") == words.count("2") == 1
    assert not {"Stone", "stone,", "(stone)", "STONE."} & set(words)
    asked.clear()
    assert _ids(encode(pa.array(["(WALL) 4202, stone"]))) == [tokenizer.encode("(WALL) 4202, stone").ids]
    assert asked == []


def test_words_forgotten_are_asked_again(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    monkeypatch.setattr(token_files, "TOGETHER", 2)
    with open(queries.vocabulary(WORDS), encoding="utf-8") as file:
        encode = token_files.WordEncoder(file.read(), "<u2")
    for text in ("one two three four five", "five six", "", "one " + "long" * 40 + ", two", "five"):
        assert _ids(encode(pa.array([text, ""]), b"\x02\x00")) == [tokenizer.encode(text).ids + [2], [2]]
        assert not any(len(unit) > token_files.UNIT_CHARS for unit in encode.known)


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_ids_are_counted_over_batches(spark, kind, monkeypatch):
    monkeypatch.setattr(token_files, "COUNTED_IDS", 7)
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 40, n) for n in (0, 1, 50, 0, 13, 7)]
    encoded = spark.createDataFrame([(bytearray(ids.astype(kind).tobytes()),) for ids in rows], "ids binary").repartition(3)
    found, n = np.unique(np.concatenate(rows), return_counts=True)
    assert token_files.count_ids(encoded, kind) == dict(zip(found.tolist(), n.tolist()))


def test_coder_near_its_bounds():
    """Frequencies from one to nearly the whole table, at both ends of the states."""
    table = rans.FrequencyTable.from_counts({0: 10**9, 1: 1, 7: 10**6, 65535: 1})
    rng = np.random.default_rng(4)
    for ids in (np.zeros(5000, int), np.full(5000, 65535), rng.choice([0, 1, 7, 65535], 300_001)):
        assert (rans.decode_block(rans.encode_block(ids, table), len(ids), table) == ids).all()


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("aB1' \n\t.<|>̧́éΣÅ ‍\U0001f600İ\x0b\x1c")), max_size=40))
def test_words_apart_have_the_ids_of_any_text(text):
    from tokenizers import Tokenizer

    global _whole, _apart
    if "_whole" not in globals():
        _whole = Tokenizer.from_file(queries.vocabulary(WORDS))
        with open(queries.vocabulary(WORDS), encoding="utf-8") as file:
            _apart = token_files.WordEncoder(file.read(), "<u2")
    assert _ids(_apart(pa.array([text]))) == [_whole.encode(text, add_special_tokens=False).ids]


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_files_hold_all_ids_in_order(request, spark, tokenizer, odd_rows, source, tmp_path, monkeypatch):
    """Small blocks and files, so that documents run over blocks and runs of blocks."""
    monkeypatch.setattr(token_files, "FILE_IDS", 20_000)
    docs = request.getfixturevalue(source)
    path = str(tmp_path / "files")
    found = token_files.through_files(docs, queries.vocabulary(WORDS), 2, path).collect()
    rows = [(r[0], (r[1] or "") + "") for r in odd_rows]
    assert sorted(tuple(r) for r in found) == brute_files(tokenizer, rows)
    assert spark.read.parquet(f"{path}/manifest").count() > 1


def test_files_of_null_and_repeated_ids(spark, tokenizer, odd_rows):
    rows = [(None if i % 3 else 7, t) for i, t, *_ in odd_rows] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted((tuple(r) for r in token_files.through_files(docs, queries.vocabulary(WORDS), 2).collect()), key=lambda r: r[1])
    wanted = brute_files(tokenizer, rows)
    assert [r[0] for r in found] == [r[0] for r in wanted]
    assert sorted(str((r[0], *r[2:])) for r in found) == sorted(str((r[0], *r[2:])) for r in wanted)
    ends = [r[1] + r[2] for r in found]
    assert [r[1] for r in found] == [0, *ends[:-1]]


def test_files_of_no_documents(empty):
    assert token_files.through_files(empty, queries.vocabulary(WORDS), 2).collect() == []


def test_files_without_end_id(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "one two")], "doc_id long, text string").coalesce(1)
    rows = sorted(token_files.through_files(docs, queries.vocabulary(WORDS), None).collect())
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(1, 0, 0), (2, 0, 0), (3, 0, 2)]
    assert rows[0].ids_crc32 == 0


def _file(tmp_path, documents, monkeypatch, block=64):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    table = rans.FrequencyTable.from_counts({i: 1 + i for i in range(50)})
    crc = zlib.crc32(table.to_bytes())
    path = str(tmp_path / "one.rids")
    writer = token_files.FileWriter(open(path, "wb"), table)
    for name, ids in documents:
        writer.add(name, ids)
    writer.close(crc)
    return path, table, crc


def test_any_run_of_blocks_and_any_stretch(tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    documents = [(None if k % 7 == 0 else k, rng.integers(0, 50, n)) for k, n in enumerate([0, 3, 200, 64, 0, 1, 500, 0, 64, 128, 5, 0])]
    path, table, crc = _file(tmp_path, documents, monkeypatch)
    reader = token_files.FileReader(path, table, crc)
    whole = np.concatenate([d for _, d in documents])
    for step in (1, 2, 5, 100):
        got = []
        for first in range(0, len(reader.points), step):
            for name, start, n, pieces in reader.documents_of(first, min(first + step, len(reader.points))):
                got.append((name, np.concatenate([*pieces, np.zeros(0, int)]).tolist()))
        assert got == [(name, ids.tolist()) for name, ids in documents]
    for start, n in [(0, 0), (0, 1), (63, 2), (64, 64), (100, 500), (0, len(whole)), (len(whole) - 1, 1)]:
        assert reader.ids(start, n).tolist() == whole[start : start + n].tolist()


def test_damaged_files_are_noticed(tmp_path, monkeypatch):
    path, table, crc = _file(tmp_path, [(1, np.arange(50)), (2, np.arange(50).repeat(4))], monkeypatch)
    data = open(path, "rb").read()
    for at in (20, len(data) - 60):
        hurt = bytearray(data)
        hurt[at] ^= 1
        open(path, "wb").write(hurt)
        with pytest.raises(ValueError):
            reader = token_files.FileReader(path, table, crc)
            for k in range(len(reader.points)):
                reader.block(k)
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        token_files.FileReader(path, table, crc + 1)


# -- importance ---------------------------------------------------------------

FEATURE_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text, longest):
    words = FEATURE_WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    runs = [b" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return words, [zlib.crc32(r) for r in runs]


def brute_draw(rows, target, longest=1, buckets=10_000, least=20, percent=10):
    aim, raw = [0] * buckets, [0] * buckets
    for side, texts in ((aim, target), (raw, [t for _, t in rows])):
        for text in texts:
            for h in brute_features(text, longest)[1]:
                side[h % buckets] += 1
    s, t = sum(raw) + buckets, sum(aim) + buckets
    gain = [math.floor(1000 * math.log((aim[b] + 1) * s / ((raw[b] + 1) * t))) for b in range(buckets)]
    out = []
    for i, text in rows:
        words, hashes = brute_features(text, longest)
        weight = sum(gain[h % buckets] for h in hashes) // len(hashes) if hashes else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(words), len(hashes), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, row in enumerate(able[: len(able) * percent // 100], 1):
        row[5] = place
    return [tuple(r) for r in out]


def _ordered(rows):
    return sorted(map(str, map(tuple, rows)))


@pytest.mark.parametrize("longest", [1, 3])
def test_draw_of_given_documents(spark, sf_docs, longest):
    docs, rows = sf_docs
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    wanted = brute_draw(rows, [r.text for r in target.collect()], longest)
    assert _ordered(importance.resample(docs, target, longest).collect()) == _ordered(wanted)
    assert sum(r[5] is not None for r in wanted) > 10


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_draw_of_odd_documents(request, spark, odd_rows, source):
    target = spark.createDataFrame([(PHRASE,), (None,), ("",)], "text string")
    wanted = brute_draw([r[:2] for r in odd_rows], [PHRASE], 2, 64, 1, 50)
    got = importance.resample(request.getfixturevalue(source), target, 2, 64, 1, 50)
    assert _ordered(got.collect()) == _ordered(wanted)


PHRASE = "The moon over the quiet river"


@pytest.mark.parametrize("size", [1, 5, 13, 1 << 20])
def test_runs_do_not_depend_on_slices(size, monkeypatch):
    monkeypatch.setattr(importance, "SLICE_BYTES", size)
    text = "One  two-three\x00four é漢字 five.SIX seven eight " * 5 + "x" * 50
    for longest in (1, 2, 3, 5):
        found = [h for _, hashes in importance.run_hashes(text.encode(), longest) for h in hashes]
        assert sorted(found) == sorted(brute_features(text, longest)[1])


def test_draw_of_null_and_repeated_ids(spark, odd_rows):
    rows = [(None if i % 3 else 7, t) for i, t, *_ in odd_rows] * 3
    target = spark.createDataFrame([(PHRASE,)], "text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = importance.resample(docs, target, percent=40).collect()
    wanted = brute_draw(rows, [PHRASE], percent=40)
    assert _ordered(r[:5] for r in got) == _ordered(r[:5] for r in wanted)
    assert sorted(r.rank for r in got if r.rank) == sorted(r[5] for r in wanted if r[5])
    drawn = sorted((r for r in got if r.rank), key=lambda r: r.rank)
    assert [r.score for r in drawn] == sorted((r.score for r in drawn), reverse=True)


def test_draw_of_no_documents(empty, odd, spark):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(empty, target).collect() == []
    got = importance.resample(odd, target).collect()
    assert len(got) == odd.count() and {r.doc_id for r in got if r.n_words == 0 and r.weight != 0} == set()


# -- part codes ---------------------------------------------------------------

VECTOR = "vec_id long, embedding array<float>, label int"


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = [nearest(c[p], books[p])[1] for c in cut]
            for e in set(found):
                mine = [c[p] for c, f in zip(cut, found) if f == e]
                books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append([i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)])
    errors = {}
    for _, label, _, error in out:
        errors[label] = errors.get(label, 0) + error
    return [(*r, errors[r[1]], digest) for r in out]


def _vectors(n, width=16, seed=0):
    rng = np.random.default_rng(seed)
    grid = rng.integers(-6, 7, (n, width)) / 8 + rng.integers(0, 2, (n, 1)) / 4096
    return [(k * 3 % n, [float(x) for x in row], [0, 1, None, 2][k % 4]) for k, row in enumerate(grid)]


def test_codes_of_vectors_that_share_prefixes(spark):
    rows = _vectors(300) + _vectors(40)[:20]
    got = part_codes.compress(spark.createDataFrame(rows, VECTOR).repartition(5)).collect()
    assert _ordered(got) == _ordered(brute_codes(rows))


def test_codes_of_odd_vectors(spark):
    rows = _vectors(9, 8)
    nan, inf = float("nan"), float("inf")
    odd = [
        (-5, None, 1),
        (-4, [], 1),
        (-3, [nan] + [0.0] * 7, 1),
        (-2, [0.0] * 7 + [-inf], None),
        (-1, [None] + [0.0] * 7, 0),
        (None, [0.5] * 8, None),
        (None, [0.5] * 8, None),
        (50, [0.25] * 16, 2),
        (51, [0.25] * 7, 2),
    ]
    table = spark.createDataFrame(rows + odd, VECTOR)
    for name in ("code", "label_error", "position", "part", "of", "n", "count"):
        table = table.selectExpr("*", f"'x' as `{name}`")
    got = part_codes.compress(table, entries=4, rounds=3).collect()
    assert _ordered(got) == _ordered(brute_codes(rows + odd, entries=4, rounds=3))
    assert len(got) == len(rows) + 2


def test_codes_of_no_vectors_and_of_one(spark):
    assert part_codes.compress(spark.createDataFrame([], VECTOR)).collect() == []
    assert part_codes.compress(spark.createDataFrame([(1, None, 1)], VECTOR)).collect() == []
    [row] = part_codes.compress(spark.createDataFrame([(1, [0.5] * 8, None)], VECTOR)).collect()
    assert (row.code, row.error, row.label_error) == ("00" * 8, 0, 0)


def test_huge_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        part_codes.compress(spark.createDataFrame([(1, [3.0e4] * 8, 0), (2, [0.0] * 8, 0)], VECTOR)).collect()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), min_size=1, max_size=60), st.integers(1, 5))
def test_trie_finds_what_a_scan_finds(parts, entries):
    rng = np.random.default_rng(len(parts))
    book = rng.integers(-3, 4, (entries, 3))
    found, which = part_codes.distinct_parts(np.array(parts, np.int64))
    assert (found[which] == np.array(parts)).all()
    assert found.tolist() == sorted(map(list, set(map(tuple, parts))))
    codes, distances = part_codes.nearest(found, book)
    scan = np.square(found[:, None, :] - book[None]).sum(axis=2)
    assert codes.tolist() == scan.argmin(axis=1).tolist()
    assert distances.tolist() == scan.min(axis=1).tolist()
