"""Piecewise fingerprints against a version that goes byte by byte."""

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from satlake.llm import piecewise

VALUES = [int(v) for v in piecewise._VALUES]


def plain(text):
    return brute.piecewise(text, VALUES, piecewise._BASE, piecewise.ALPHABET)


def test_fingerprints_of_odd_texts(odd_rows):
    for _, text, *_ in odd_rows:
        assert piecewise.fingerprint(text) == plain(text)


def test_fingerprints_of_documents(sf_docs):
    for _, text in sf_docs[1][:60]:
        assert piecewise.fingerprint(text) == plain(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é"), max_size=400))
def test_fingerprints_of_any_text(text):
    assert piecewise.fingerprint(text) == plain(text)


@pytest.mark.parametrize("n", [1, 6, 7, 8, 63, 64, 65, 2048, 2049, 4500])
def test_fingerprints_around_the_block_sizes(n):
    text = "".join(np.random.default_rng(n).choice(list("abcdefgh \n"), n))
    assert piecewise.fingerprint(text) == plain(text)


def test_likeness_by_an_edit_distance_loop(spark):
    rng = np.random.default_rng(4)
    prints = ["1::", "1:A:", "2:A:A", "1:AAAAAA:AAAA", "2:AAAAAAAAAA:B", "4:BAAAB:AAAA"]
    for n in (30, 200, 900, 4000):
        text = "".join(rng.choice(list("abcdefgh "), n))
        prints += [piecewise.fingerprint(t) for t in (text, text[: n // 2], "x" + text, text * 2, text[::-1])]
    pairs = [(a, b) for a in prints for b in prints]
    df = spark.createDataFrame(pairs, "a string, b string").select("*", piecewise.likeness(F.col("a"), F.col("b")).alias("near"))
    rows = df.collect()
    for row in rows:
        assert row.near == pytest.approx(brute.likeness(row.a, row.b), abs=1e-12), (row.a, row.b)
    assert any(0 < r.near < 1 for r in rows)


def test_the_whole_job(odd, odd_rows):
    """Fingerprints of the texts, of the edited ones and of the next ones, and how alike they are."""
    order = [(i, t or "") for i, t, *_ in odd_rows]
    want = {}
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        marks = plain(text), plain(text[: len(text) - half] + following[:half]), plain(following)
        want[i] = (marks[0], marks[1], brute.likeness(marks[0], marks[1]), brute.likeness(marks[0], marks[2]))
    got = piecewise.compared(odd).collect()
    assert len(got) == len(want)
    for r in got:
        fingerprint, edited, near_edited, near_next = want[r.doc_id]
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint, edited)
        assert (r.near_edited, r.near_next) == (pytest.approx(near_edited), pytest.approx(near_next))
