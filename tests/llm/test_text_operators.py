import hashlib
import time
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from satlake.llm import line_blocks, piece_bpe, piecewise, quality, simhash, suffix_blocks
from satlake.llm.components import connected
from satlake.llm.queries import vocabulary


def ids(rows):
    return [(r[0], r[1]) for r in rows]


# -- fingerprints -----------------------------------------------------------


def edited_rows(rows):
    out = {}
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        out[i] = (len(t), t[: len(t) - half] + u[:half], u)
    return out


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_piecewise(request, odd_rows, source):
    got = piecewise.compared(request.getfixturevalue(source)).collect()
    want = edited_rows(ids(odd_rows))
    assert len(got) == len(want)
    prints = {t: piecewise.fingerprint(t) for _, t in ids(odd_rows)}
    for r in got:
        n, changed, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == prints[dict(ids(odd_rows))[r.doc_id]]
        assert r.edited_fingerprint == piecewise.fingerprint(changed)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if piecewise.fingerprint(following) == r.fingerprint:
            assert r.near_next == 1


def test_piecewise_over_documents(sf_docs):
    df, rows = sf_docs
    got = {r.doc_id: r for r in piecewise.compared(df).collect()}
    want = edited_rows(sorted(rows))
    assert all(got[i].edited_sha256 == hashlib.sha256(want[i][1].encode()).hexdigest() for i in want)
    long = [got[i] for i in want if want[i][0] > 300]
    assert np.median([r.near_edited for r in long]) > 0.4
    assert np.mean([r.near_next for r in long]) < 0.05


def test_piecewise_keeps_repeated_rows_and_single_ones(spark, odd, empty):
    twice = odd.unionByName(odd)
    assert piecewise.compared(twice).count() == 2 * odd.count()
    assert piecewise.compared(empty).collect() == []
    one = spark.createDataFrame([(None, "abcdef")], "doc_id long, text string")
    row = piecewise.compared(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1


def test_likeness_needs_compatible_blocks(spark):
    text = "".join(np.random.default_rng(2).choice(list("abcdefgh "), 9000))
    cases = [text, text[:4000] + "#" + text[4000:], text * 8, "z" * 50]
    prints = [(piecewise.fingerprint(text), piecewise.fingerprint(c)) for c in cases]
    df = spark.createDataFrame(prints, "a string, b string")
    near = [r[0] for r in df.select(piecewise.likeness(F.col("a"), F.col("b"))).collect()]
    assert near[0] == 1 and near[1] > 0.9 and near[2] < 0.3 and near[3] == 0


# -- simhash ----------------------------------------------------------------


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_simhash_components(request, odd_rows, source):
    got = {r.doc_id: r for r in simhash.components(request.getfixturevalue(source)).collect()}
    prints = {i: brute.simhash(t) for i, t in ids(odd_rows)}
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == prints
    roots = brute.components(prints)
    smallest = {}
    for i, root in roots.items():
        smallest[root] = min(i, smallest.get(root, i))
    assert {i: r.component_id for i, r in got.items()} == {i: smallest[roots[i]] for i in roots}


def test_simhash_over_documents(sf_docs):
    df, rows = sf_docs
    assert {r.doc_id for r in simhash.near_unique(df).select("doc_id").collect()} == brute.near_unique(rows)


def test_simhash_edges(spark, odd, empty):
    assert simhash.components(empty).collect() == []
    assert simhash.near_unique(empty).collect() == []
    assert simhash.components(odd.unionByName(odd)).count() == 2 * odd.count()
    kept = simhash.near_unique(odd.unionByName(odd))
    assert kept.count() == kept.select("doc_id").distinct().count()
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (4, "e f g h")], "doc_id long, text string")
    assert Counter(r.component_id for r in simhash.components(nulls).collect()) == {None: 2, 4: 1}


def test_near_unique_keeps_one_row_per_component(spark):
    one, two, three = ("".join(f"{w}{k} " for k in range(40)) for w in ("red", "blue", "green"))
    rows = [(None, one, "s"), (None, two, "s"), (None, two, "r"), (1, three, "s"), (2, three, "s"), (2, "x y z " * 20, "s")]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string, digest string")
    kept = [{tuple(r) for r in simhash.near_unique(df.repartition(n)).collect()} for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 4 == simhash.near_unique(df).count()
    assert {r[:2] for r in kept[0]} == {(None, one), (None, two), (1, three), (2, "x y z " * 20)}


def dense_prints():
    rnd = np.random.default_rng(3)
    out = set()
    for base in rnd.integers(0, 1 << 63, 4, dtype=np.uint64):
        for _ in range(150):
            x = int(base)
            for bit in rnd.choice(np.r_[0:6, 21:25, 40:45], rnd.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            out.add(x)
        x = int(base)
        for _ in range(30):
            x ^= 1 << int(rnd.integers(0, 64))
            x ^= 1 << int(rnd.integers(0, 64))
            out.add(x)
    return sorted(out)


def sparse_prints():
    """Fingerprints that share their first segment, some of them near others."""
    rnd = np.random.default_rng(5)
    out = {int(x) << 22 | 5 for x in rnd.integers(0, 1 << 41, 120)}
    for x in list(out)[:30]:
        for bit in rnd.choice(64, 4, replace=False):
            x ^= 1 << int(bit)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("prints, group_rows", [(dense_prints(), 200_000), (sparse_prints(), 20)])
def test_variants_lose_no_link(spark, prints, group_rows):
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in prints], "fp long")
    labels = connected(simhash.links(df, 4, group_rows))
    got = {r.vertex & (1 << 64) - 1: r.root for r in labels.collect()}
    roots = brute.components({x: x for x in prints})
    want = Counter(roots.values())
    assert {x for x, root in roots.items() if want[root] > 1} == set(got)
    assert len({(got[x], roots[x]) for x in got}) == len(set(got.values())) == len({roots[x] for x in got})


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(1000, 1001), (7, 7)], "a long, b long")
    labels = connected(df).collect()
    assert Counter(Counter(r.root for r in labels).values()) == {61: 1, 2: 1}
    assert connected(df.where("a = b")) is None


# -- suffixes ---------------------------------------------------------------


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_suffixes(request, odd_rows, source):
    got = suffix_blocks.repeats(request.getfixturevalue(source), ["doc_id"]).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.removal_rows(ids(odd_rows)))


def test_suffixes_over_documents_in_many_blocks(sf_docs, monkeypatch):
    df, rows = sf_docs
    monkeypatch.setattr(suffix_blocks, "BLOCK_BYTES", 20_000)
    got = suffix_blocks.repeats(df.repartition(3), ["doc_id"]).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.removal_rows(rows))


def test_no_block_is_longer_than_its_limit(spark, monkeypatch):
    monkeypatch.setattr(suffix_blocks, "BLOCK_BYTES", 20_000)
    rows = [(k, "ab" * 10) for k in range(2000)] + [(2000 + k, "c" * 5_000) for k in range(30)] + [(3000, "d" * 50_000), (3001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    blocks, _ = suffix_blocks.blocks_table(docs, ["doc_id"])
    sizes = blocks.groupBy("block").agg(F.sum(F.octet_length("__text")).alias("bytes"), F.count("*").alias("rows")).collect()
    assert sum(r.rows for r in sizes) == len(rows)
    assert all(r.bytes <= 20_000 or r.rows == 1 for r in sizes)
    assert len(sizes) < 20


def test_suffix_edges(spark, odd, odd_rows, empty):
    assert suffix_blocks.repeats(empty, ["doc_id"]).collect() == []
    twice = suffix_blocks.repeats(odd.unionByName(odd), ["doc_id"]).collect()
    assert sorted(tuple(r) for r in twice) == sorted(brute.removal_rows(ids(odd_rows) * 2))
    rows = [(None, "q" * 30 + "r" * 30), (5, "q" * 30 + "r" * 30), (5, "q" * 30 + "r" * 30)]
    got = suffix_blocks.repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 60), (False, 60), (True, 0)]


def test_texts_without_repeats(odd, odd_rows):
    got = suffix_blocks.without_repeats(odd)
    assert got.columns == odd.columns
    want = brute.without_repeats(ids(odd_rows))
    rows = got.collect()
    assert {r.doc_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_cover_meets_all_residues():
    found = {(a - b) % suffix_blocks.PERIOD for a in suffix_blocks.COVER for b in suffix_blocks.COVER}
    assert found == set(range(suffix_blocks.PERIOD))


# -- quality ----------------------------------------------------------------


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_measures(request, odd_rows, source):
    got = quality.assess(request.getfixturevalue(source)).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        text = dict(ids(odd_rows))[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.measures(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_against_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.assess(docs).join(labels, "doc_id").collect()
    clean = [r for r in found if r.quality == 1 and not r.base_failed]
    poor = [r for r in found if r.quality == 0]
    assert all(r.kept for r in clean)
    assert sum(r.kept for r in poor) <= 0.05 * len(poor)


def test_quality_edges(odd, clashing, empty):
    assert quality.assess(empty).collect() == []
    assert quality.kept_documents(empty).collect() == []
    assert quality.assess(odd.unionByName(odd)).count() == 2 * odd.count()
    kept = quality.kept_documents(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.assess(odd).where("kept").collect()}


def test_em_finds_an_unreliable_rule(spark):
    # A rule that speaks against what all others find fine is the less accurate one.
    names = [f"vote_{r.name}" for r in quality.RULES]
    fine = [1] * len(names)
    noisy = fine[:1] + [-1] + fine[2:]
    broken = [1, 1, -1, -1, 1, -1, -1, -1]
    rows = [fine] * 700 + [noisy] * 50 + [broken] * 250
    model = quality.fit(spark.createDataFrame(rows, names))
    accuracies = model.accuracies()
    assert accuracies[1] < min(accuracies[2], accuracies[3], accuracies[5])
    assert model.shares[0] > 0.6


# -- pieces -----------------------------------------------------------------


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary())


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("source", ["odd", "clashing"])
def test_pieces(request, odd_rows, source):
    got = piece_bpe.encode_documents(request.getfixturevalue(source), vocabulary()).collect()
    theirs = library()
    assert len(got) == len(odd_rows)
    for r in got:
        want = theirs.encode(dict(ids(odd_rows))[r.doc_id] or "")
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == digest(",".join(map(str, want)))
        assert r.decoded_sha256 == digest(theirs.decode(want))


def test_pieces_over_documents(sf_docs, empty):
    df, rows = sf_docs
    theirs = library()
    got = {r.doc_id: r for r in piece_bpe.encode_documents(df, vocabulary(), with_ids=False).collect()}
    for i, text in rows:
        assert got[i].ids_sha256 == digest(",".join(map(str, theirs.encode(text))))
        assert got[i].decoded_sha256 == digest(theirs.decode(theirs.encode(text)))
    assert piece_bpe.encode_documents(empty, vocabulary()).collect() == []


def test_heap_and_matrix_agree():
    with open(vocabulary(), "rb") as file:
        own = piece_bpe.PieceEncoder(file.read(), check=False)
    rnd = np.random.default_rng(1)
    letters = "abcdehinorst▁ézß漢"
    for width in (1, 2, 3, 7, 20, 40):
        texts = ["".join(rnd.choice(list(letters), width)) for _ in range(200)]
        symbols = np.array([[own.of_point[ord(c)] for c in t] for t in texts], np.int32)
        merged, counts = own.matrix(symbols)
        for row, n, start in zip(merged.tolist(), counts.tolist(), symbols.tolist()):
            assert row[:n] == own.agenda(start)


def test_a_wrong_merge_is_noticed():
    with open(vocabulary(), "rb") as file:
        own = piece_bpe.PieceEncoder(file.read(), check=True)
    own.table.scores[:] = -np.inf
    with pytest.raises(ValueError, match="differs"):
        list(own.encode_all(["the cat"]))


# -- pages ------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie notice">We use cookies</div>
<article><h1>A &amp; B</h1><p>First   line<br>goes on.<div class="ad">Buy</div><p><b>Second &eacute;&#33;
<ul><li>one<li>two</ul><form><input><button>Send</button></form><script>var x = "</p>";</script></article>
<aside>More</aside><section id="comments"><article class="comment"><p>Nice!</article></section>
<footer>&copy; me</footer></body></html>"""


def test_article_of_a_page():
    assert line_blocks.main_text(PAGE) == "A & B\nFirst line goes on.\nSecond é!\none\ntwo"


def test_surge_and_dive_without_marked_article():
    page = (
        "<div><a href=a>Home</a></div><div><a href=b>News</a></div><div></div><div class=menu>x</div><div class=ad>y</div>"
        "<div class=promo>z</div><div id=text><p>" + "long sentence " * 10 + "<p>short<p>" + "another one " * 9 + "</div>"
        "<div class=share>s</div><div class=related>r</div><div class=widget>w</div><p>tail</p>"
    )
    assert line_blocks.main_text(page).split("\n") == [("long sentence " * 10).strip(), "short", ("another one " * 9).strip()]


def test_window_sums_decide_beside_an_article():
    body = ["long sentence " * 10, "another one " * 9]
    page = "<article><p>teaser</article><nav>n</nav><div class=ad>a</div><form>f</form><div>" + "".join(f"<p>{t}" for t in body)
    assert line_blocks.main_text(page + "</div>").split("\n") == ["teaser", *(t.strip() for t in body)]


@pytest.mark.parametrize("classes", ["content-sidebar-wrap", "layout has-sidebar", "entry has-comments", "page-header"])
def test_wrappers_named_after_what_is_left_out(classes):
    text, card = "long sentence " * 10, "<div class=widget>w</div><div class=sidebar><p>menu</div>"
    wrap = f"<body><nav>n</nav><div class='{classes}'>{{}}</div><footer>f</footer>"
    for body in (f"<article><p>{text}</article>{card}", f"{card}<h1>T</h1><p>{text}", f"<main>{text}</main>{card}", f"<p>{text}{card}"):
        assert line_blocks.main_text(wrap.format(body)).split("\n")[-1] == text.strip()
        assert "w" not in line_blocks.main_text(wrap.format(body)).split("\n")


def test_parts_left_out_by_class():
    text = "long sentence " * 10
    two = f"<article><p>teaser</article><div class='layout has-sidebar'><article><p>{text * 2}</article></div>"
    assert line_blocks.main_text(two).split("\n") == ["teaser", (text * 2).strip()]
    page = f"<div><h1>T</h1><p>{text}</div><div class=related><article>card</article></div><div id=comments><article>{text * 3}</article></div>"
    assert line_blocks.main_text(page).split("\n") == ["T", text.strip()]
    assert line_blocks.main_text(f"<p>{text}</p><div id=comments><p>{text * 3}</div>") == text.strip()


def test_lines_beside_a_surge_are_kept():
    text, parts = "long sentence " * 10, "<div class=ad>a</div><div class=share>s</div><nav>n</nav>"
    link = "<a href=x>A link as title</a>"
    want = ["A link as title", text.strip(), "A link as title"]
    assert line_blocks.main_text(f"{parts}<h2>{link}</h2><p>{text}<p>{link}").split("\n") == want
    assert line_blocks.main_text(f"<h1>{link}</h1>{parts}<p>{text}<p>{link}").split("\n") == want
    assert line_blocks.main_text(f"<p>{text}</p>{parts}<p>This is the end.").split("\n") == [text.strip(), "This is the end."]
    assert line_blocks.main_text(f"<p>{text}</p>{parts}<p>Then</p>{parts}<p>{text}").split("\n") == [text.strip(), "Then", text.strip()]
    assert line_blocks.main_text(f"<p>{text}</p>{parts}<p>{link}") == text.strip()


def test_text_runs():
    assert line_blocks.text_runs([0, 5, 0, 0, 0, 90, 3, 0, 0, 40, 0, 0, 0, 2], 80) == [(5, 10)]
    assert line_blocks.text_runs([], 80) == []
    assert line_blocks.text_runs([0, 0], 80) == []


@pytest.mark.parametrize("page", ["", None, "<", "<p", "<!-- ", "<a title=\"x>y", "<script>", "</p></div>", "&amp", "<p>" * 5000 + "a"])
def test_odd_pages(page):
    line_blocks.main_text(page)


WIDE = "word " * 60


@pytest.mark.parametrize(
    "page",
    [
        '<svg class="i"/><p>{0}</p>',
        "<script src='a.js'/><p>{0}</p><script>var x;</script>",
        "<svg><path d='x'><p>{0}</p>",
        "<iframe src=a /><p>{0}</p><iframe src=b></iframe>",
        "<form id=f action=/x><div><p>{0}</p></div><input name=a></form>",
        "<form><fieldset><article><h1>{0}</h1></article></fieldset></form>",
        "<p title='a > b' data-x=\"c > d\">{0}</p>",
        "<p>{0}<br/></p>",
    ],
)
def test_markup_that_hides_no_article(page):
    assert line_blocks.main_text(page.format(WIDE)).split() == WIDE.split()


def test_forms_beside_an_article_go():
    page = "<article><h1>T</h1><p>{0}</p><form><p>your mail please</p></form></article><form><p>{0} {0}</p></form>"
    assert line_blocks.main_text(page.format(WIDE)).split("\n") == ["T", WIDE.strip()]


DEEP = [
    ('<div class="widget">', 1200),
    ('<div class="widget">', 100_000),
    ("<script ", 250_000),
    ("<svg>", 300_000),
    ("<b x='", 300_000),
    ("<b x='<c y=\"", 150_000),
    ('<p "', 400_000),
    ("<!-- ", 400_000),
    ("<!x ", 400_000),
    ("<", 1_000_000),
    ("<div></p>", 200_000),
    ("<ul><li>", 200_000),
    ("</li>", 300_000),
]


@pytest.mark.parametrize("mark,times", DEEP)
def test_time_grows_with_the_page(mark, times):
    """Pages of up to two megabytes, with the article after what is odd where that leaves it readable."""
    start = time.process_time()
    text = line_blocks.main_text(mark * times + "<h1>T</h1><p>" + WIDE)
    assert time.process_time() - start < 20
    if "class" in mark:
        assert text.split("\n") == ["T", WIDE.strip()]


def test_many_stray_closing_tags():
    start = time.process_time()
    line_blocks.main_text("<div>" * 100_000 + "</p>" * 100_000 + ("<p>short</p>" + "<p><a>l</a></p>" * 4) * 10_000)
    assert time.process_time() - start < 20


def test_pages_in_spark(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (3, "v", "<p>" + "w " * 50_000, "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = line_blocks.extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 43), (1, 43), (3, 99_999)]
    assert line_blocks.extract(df.limit(0)).collect() == []
