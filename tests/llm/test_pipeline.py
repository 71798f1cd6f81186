"""The pipeline as a chain: each stage against a plain version, on rows that are as odd as they get."""

import hashlib
from collections import Counter, defaultdict

import brute
import duckdb
import pytest

import corpus_pipeline
from satlake.llm.oracles import ORACLES
from satlake.llm.queries import vocabulary

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """All given documents, and rows of good texts with null, repeated and shared ids and extra columns."""
    path = tmp_path_factory.mktemp("corpus")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in given.select(*DOCUMENTS).collect()]
    good = [r for r in rows if r[1] and len(r[1].split()) > 60][:8]
    odd = [(None, *r[1:]) for r in good[:4]] + good[4:6] * 2 + [(good[6][0], good[7][1], None, None, None)]
    odd += [(None, "a new text " + good[7][1][::-1].lower() + ".", None, "s", 5)] * 2
    odd += [(10**9, (good[7][1] + "\n") * 400, "xx", None, 1), (-5, None, None, None, None), (-4, "", "", "", 0)]
    schema = given.select(*DOCUMENTS).schema
    docs = spark.createDataFrame(rows + odd, schema).selectExpr("*", "'x' as fp", "doc_id as block", "array(1) as words")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Rows before the first and after each stage."""
    path = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        out.append(docs.collect())
    return out


def counted(rows):
    return Counter(tuple(str(v) for v in r) for r in rows)


def test_columns_stay_until_the_last_stage(stages):
    for rows in stages[1:-1]:
        assert rows and set(stages[0][0].asDict()) == set(rows[0].asDict())


def test_quality_rules_keep_what_their_sql_keeps(stages, folder):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    kept = con.execute(f"select doc_id, n_words, word_chars from ({ORACLES['op8_weak_supervision']}) where kept").fetchall()
    got = [(r.doc_id, *brute.measures(r.text)[:2]) for r in stages[1]]
    assert Counter(got) == Counter(kept)
    assert not counted(stages[1]) - counted(stages[0]) and len(stages[1]) < len(stages[0])


def test_near_dedup_keeps_one_row_per_component(stages):
    before, after = stages[1], stages[2]
    roots = brute.components({t: brute.simhash(t) for t in {r.text for r in before}})
    groups = defaultdict(list)
    for r in before:
        groups[roots[r.text]].append(r)
    assert len(after) == len(groups) and not counted(after) - counted(before)
    smallest = {root: min((r.doc_id is None, r.doc_id or 0) for r in rows) for root, rows in groups.items()}
    assert {roots[r.text]: (r.doc_id is None, r.doc_id or 0) for r in after} == smallest


def test_suffix_dedup_cuts_what_smaller_ids_have(stages):
    before, after = stages[2], stages[3]
    want = Counter()
    for (i, text, mask), r in zip(brute.removed([(r.doc_id, r.text) for r in before]), before):
        left = bytes(b for b, gone in zip(text, mask) if not gone).decode("utf-8", "ignore")
        want[(i, left, r.source)] += 1
    assert Counter((r.doc_id, r.text, r.source) for r in after) == want


def test_the_mix_takes_whole_stretches_and_no_document_twice_over(stages):
    before, after = stages[3], stages[4]
    sizes = Counter()
    words = defaultdict(Counter)
    for r in before:
        sizes[r.doc_id, r.source] += len(brute.words(r.text))
        words[r.doc_id, r.source].update(brute.words(r.text))
    taken, said = Counter(), defaultdict(Counter)
    for r in after:
        assert r.text and r.n_chars == len(r.text)
        taken[r.doc_id, r.source] += len(r.text.split(" "))
        said[r.doc_id, r.source].update(r.text.split(" "))
    assert all(taken[k] <= 2 * sizes[k] for k in taken)
    assert all(n <= 2 * words[k][w] for k, found in said.items() for w, n in found.items())
    assert 1.3 * sum(sizes.values()) < sum(taken.values()) < 1.6 * sum(sizes.values())


def test_the_ids_are_those_of_the_library(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary())
    want = Counter()
    for r in stages[4]:
        ids = library.encode(r.text)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[r.doc_id, r.source, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages[5])
    assert got == want


def test_run_is_the_chain_of_the_stages(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder).collect()
    assert counted(got) == counted(stages[-1])


def test_run_over_no_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
