"""Classifiers on held-out labels, pieces against the library, pages and vectors against brute force."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from moodtide.llm import neighbours, pieces, quality_model, templates, toxicity
from moodtide.llm.common import table
from moodtide.llm.queries import piece_model


def scored(docs, labels, operator, name):
    got = operator(docs, labels).collect()
    truth = {row.doc_id: row[name] for row in labels.collect()}
    return got, [(row.score, truth[row.doc_id]) for row in got if row.held_out and truth.get(row.doc_id) is not None]


def auc(pairs):
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])


@pytest.mark.parametrize(
    ("operator", "name", "threshold", "least"),
    [(quality_model.quality_scores, "quality", 0.3, 0.95), (toxicity.toxicity_scores, "toxic", 0.5, 0.95)],
)
def test_scores_of_held_out_documents(spark, operator, name, threshold, least):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got, pairs = scored(docs, labels, operator, name)
    assert auc(pairs) > least
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= threshold)


@pytest.mark.parametrize("operator", [quality_model.quality_scores, toxicity.toxicity_scores])
def test_scores_of_odd_documents(odd, none, labels, operator):
    assert len(operator(odd, labels).collect()) == odd.count()
    assert operator(none, labels).collect() == []
    alone = operator(odd, labels.limit(0)).collect()
    assert {row.score for row in alone} == {0.5}


def test_held_out_labels_are_never_learnt(documents, labels):
    from pyspark.sql import functions as F

    from moodtide.llm.common import held_out

    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = sorted(map(tuple, toxicity.toxicity_scores(documents, labels).collect()))
    assert a == sorted(map(tuple, toxicity.toxicity_scores(documents, turned).collect()))


def test_random_indexing_counts_neighbours(spark):
    docs = spark.createDataFrame([("a b c",), ("c",), (None,)], "text string")
    vectors, weight = quality_model.word_vectors(docs)
    place, sign = quality_model.index_vectors()
    of = {w: zlib.crc32(w.encode()) % quality_model.BUCKETS for w in "abc"}
    index = {w: np.bincount(place[of[w]], sign[of[w]], quality_model.DIM) for w in "abc"}
    around = index["a"] + index["c"]
    assert np.allclose(vectors[of["b"]], around / np.linalg.norm(around), atol=1e-6)
    assert weight[of["c"]] < weight[of["a"]]


def made_texts():
    rng, letters = random.Random(3), " ab▁\n\té日😀t he.\x00'19"
    return ["", " ", "  x", "a" * 500, " " * 90 + "x", "a\x00b", "日本語 ok", *["".join(rng.choices(letters, k=k)) for k in range(60)]]


def test_pieces_equal_the_library(documents):
    texts = made_texts() + [row.text for row in documents.collect()]
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    vocabulary = pieces.Vocabulary.load(piece_model())
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    got = [ids.tolist() for at in range(0, len(texts), 37) for ids in encoder.encode(texts[at : at + 37])]
    assert got == model.encode(texts)
    assert [decoder.decode(ids) for ids in got] == [text.replace("▁", " ") for text in texts]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "UNITS", 3)
    vocabulary = pieces.Vocabulary.load(piece_model())
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    encoder = pieces.Encoder(vocabulary)
    for text in made_texts():
        assert encoder.encode([text])[0].tolist() == model.encode(text)


def test_piece_tables(odd, none):
    got = pieces.piece_counts(odd, piece_model()).collect()
    assert len(got) == odd.count() and all(row.round_trip for row in got)
    assert pieces.piece_counts(none, piece_model()).collect() == []
    assert pieces.encoded(odd, piece_model()).columns == [*odd.columns, "ids"]


def page(i, body):
    return (
        i, f"https://h.example/{i}",
        f"<html><head><title>t{i}</title><style>p{{}}</style></head><body><header>Site</header><nav><a href='/'>Home</a></nav>"
        f"<div class='ad'>Buy {i}</div>{body}<div class='comments'><p>Nice post {i}</p></div><footer>&copy; h</footer></body></html>",
    )


def test_article_is_taken_whole():
    body = "<article><h1>A &amp;\n B</h1><p><b>One<br>two<script>x('</p>')</script><p>3 < 4 &eacute;<ul><li>five<li>six</ul></article>"
    assert templates.main_text(page(1, body)[2], [], set()) == "A & B\n\nOne two\n\n3 < 4 é\n\nfive\n\nsix"


def test_template_finds_main_slot_and_notices(spark):
    text = lambda i, k: f"page {i} says its own words in line {k} which no other page has, at some length"
    body = lambda i: (
        f"<div class='col'><p>{text(i, 1)}</p><p>Print this page</p><p>{text(i, 2)}</p></div>"
        f"<div class='list'>{''.join(f'<a href=/{j}>Other page number {j} of this host</a>' for j in range(i % 5 + 3))}</div>"
    )
    pages = spark.createDataFrame([page(i, body(i)) for i in range(20)], "page_id bigint, url string, html string")
    for row in templates.page_texts(pages).collect():
        assert row.text == f"{text(row.page_id, 1)}\n\n{text(row.page_id, 2)}" and row.n_chars == len(row.text)


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (None, "x", "<p>a"), (3, "https://h/1", "just text &amp &quo"), (3, "https://h/1", "<div"), (4, "//H", "<" * 500)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, token string")
    got = Counter((r.page_id, r.text) for r in templates.page_texts(pages).collect())
    assert got == Counter([(1, ""), (2, ""), (None, "a"), (3, "just text & &quo"), (3, ""), (4, "<" * 500)])
    assert templates.page_texts(pages.limit(0)).collect() == []


def test_pages_of_the_table(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    texts = {row.page_id: row.text for row in templates.page_texts(pages).collect()}
    for row in pages.collect():
        inside = row.html.split("<article>")[1].split("</article>")[0]
        assert texts[row.page_id] and "track(" not in texts[row.page_id]
        assert texts[row.page_id].split("\n\n")[-1].split("&")[0].split("<")[0][:20] in " ".join(inside.replace("&amp;", "&").split())


def test_class_members_agree_in_order_and_nesting():
    # A holds B, then C, on one page; on the other B stands after A: only A and C, or B and C, agree.
    one, two = templates.relations([[(1, 4)], [(2, 3)], [(5, 6)]]), templates.relations([[(1, 2)], [(3, 4)], [(5, 6)]])
    both = lambda *pages: [(a[0] & b[0], a[1] | b[1]) for a, b in zip(*pages, strict=True)]
    assert templates.agreeing(both(one, one), [False] * 3) == [0, 1, 2]
    assert len(templates.agreeing(both(one, two), [False] * 3)) == 2
    # Repeated members have to take turns.
    assert templates.agreeing(templates.relations([[(1, 2), (5, 6)], [(3, 4), (7, 8)]]), [False] * 2) == [0, 1]
    assert len(templates.agreeing(templates.relations([[(1, 2), (3, 4)], [(5, 6), (7, 8)]]), [False] * 2)) == 1


def test_small_and_disordered_classes_are_no_template(spark):
    parts = ["<div class='a'><p>x y</p></div>", "<div class='b'><p>z {0}</p></div>", "<div class='c'><p>own words {0} of this page</p></div>"]
    turned = [[0, 1, 2], [2, 1, 0], [1, 0, 2]]
    body = lambda i: "".join(parts[k] for k in turned[i % 3]).format(i) + ("<div class='few'><p>once</p></div>" if i % 2 else "")
    pages = spark.createDataFrame([page(i, body(i)) for i in range(18)], "page_id bigint, url string, html string")
    [found] = templates.templates(pages).collect()
    ids = {name: templates.token_id(f">html>body>div.{name}") for name in ("a", "b", "c", "few", "ad")}
    assert ids["ad"] in found.template and ids["few"] not in found.template
    assert sum(ids[name] in found.template for name in "abc") == 1


def test_main_text_beside_an_article_stays(spark):
    lead, own, more = (lambda i, w=w: f"{w} of page {i} with some words" for w in ("lead", "own text" + " again" * 20, "more"))
    body = lambda i: (
        f"<main><h1>title {i}</h1><div class='lead'><p>{lead(i)}</div><article><p>{own(i)}</article><section><p>{more(i)}</section></main>"
        f"<div class='box'><p>tip {i}</div>"
    )
    pages = spark.createDataFrame([page(i, body(i)) for i in range(12)], "page_id bigint, url string, html string")
    want = lambda i: [f"title {i}", lead(i), own(i), more(i)]
    assert [row.slots for row in templates.templates(pages).collect()] != [[]]
    for row in templates.page_texts(pages).collect():
        assert row.text.split("\n\n") == want(row.page_id)
    assert templates.main_text(page(1, body(1))[2], [], set()).split("\n\n") == want(1)


def test_slots_choose_against_names(spark):
    own = lambda i: f"own text of page {i} " * 30
    body = lambda i: f"<div class='col'><p>{own(i)}</div><article><p>card {i}</article>"
    pages = spark.createDataFrame([page(i, body(i)) for i in range(12)], "page_id bigint, url string, html string")
    for row in templates.page_texts(pages).collect():
        assert row.text.split("\n\n")[0] == own(row.page_id).strip()
    # A page of another kind than its host's.
    odd = spark.createDataFrame([page(99, f"<div class='other'><p>{own(99)}</div><div class='col'><p>short</div>")], pages.schema)
    texts = {row.page_id: row.text for row in templates.page_texts(pages.union(odd)).collect()}
    assert own(99).strip() in texts[99]


def test_repeated_texts_of_the_main_text_stay(spark):
    own = lambda i: f"own text of page {i} " * 30
    said = lambda row: row.text.split("\n\n")
    schema = "page_id bigint, url string, html string"
    # Fixed headings, items and short parts of a named main text, or headings of one without a name.
    fixed = lambda i: f"<h2>Background</h2><p>{own(i)}<ul><li>one item</ul><h2>Summary</h2>"
    for around in ("<article>{}<p>The end</article>", "<div class='col'>{}</div>"):
        pages = spark.createDataFrame([page(i, around.format(fixed(i))) for i in range(12)], schema)
        for row in templates.page_texts(pages).collect():
            end = ["The end"] if "article" in around else []
            assert said(row) == ["Background", own(row.page_id).strip(), "one item", "Summary", *end]
    # Copies of one text are most pages, or all.
    copy = lambda i: f"<div class='col'><p>First</p><p>{own(i)}</p><p>Second</p><p>Third</p></div>"
    for copies in (9, 12):
        pages = spark.createDataFrame(
            [page(i, copy(0) if i < copies else f"<div class='col'><p>{own(i)}</p></div>") for i in range(12)], schema
        )
        for row in templates.page_texts(pages).collect():
            assert said(row) == (["First", own(0).strip(), "Second", "Third"] if row.page_id < copies else [own(row.page_id).strip()])


def check_vectors(vectors, chunk):
    rows = vectors.collect()
    usable = [r.label is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding) for r in rows]
    n, group = len(rows), list(range(len(rows)))
    links = [0] * n

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable[i] and usable[j] and a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding, dtype=float), np.array(b.embedding, dtype=float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    group[root(i)] = root(j)
    lowest = {}
    for i in range(n):
        ids = [v for v in (lowest.get(root(i)), rows[i].vec_id) if v is not None]
        lowest[root(i)] = min(ids, default=None)
    expected = Counter((rows[i].vec_id, links[i], lowest[root(i)], rows[i].vec_id == lowest[root(i)]) for i in range(n))
    assert Counter(map(tuple, neighbours.near_vectors(vectors, chunk=chunk).collect())) == expected


@pytest.mark.parametrize("chunk", [4, 4096])
def test_near_vectors(spark, chunk):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        centre = rng.standard_normal(16)
        for j in range(int(rng.integers(1, 6))):
            near = centre + rng.standard_normal(16) * 0.05 * (j > 1)
            rows.append((len(rows), [float(x) for x in near], i % 2, "k"))
    bad = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0] * 15]
    rows += [(1000 + i, v, 0, "k") for i, v in enumerate(bad)] + [(2000, rows[0][1], None, "k"), (None, rows[0][1], 0, "k")]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, key string")
    check_vectors(vectors, chunk)
    assert neighbours.near_vectors(vectors.limit(0)).collect() == []


def test_collisions_are_counted_per_pair():
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((7, 5)), rng.standard_normal((11, 5))
    expected = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.4).sum(axis=2)
    assert (neighbours.collisions(a, b, 0.4) == expected).all()


def test_count_is_calibrated_for_recall():
    p, least, rng = neighbours.needed(), neighbours.needed(miss=0.1), np.random.default_rng(3)
    assert p < least
    hits = (np.abs(rng.standard_normal((20_000, neighbours.PROJECTIONS))) <= neighbours.WINDOW).sum(axis=1)
    assert 0.88 < (hits >= least).mean() and (hits >= p).all()


NAMES = """ad advert banner sponsor promo sidebar menu nav navigation breadcrumb footer site-header masthead cookie consent notice
notification announcement disclaimer alert popup overlay discussion related-work reviews recommended teaser share social newsletter
subscribe signup login search toolbar pagination widget hidden-figures comments replies""".split()


@pytest.mark.parametrize("kind", ["id", "class"])
def test_names_inside_an_article_keep_its_text(kind):
    told = "These are sentences of the article itself, which nothing but a name speaks against."
    for name in NAMES:
        if kind == "class" and name in ("comments", "replies"):
            continue
        body = f'<article><h1>Title</h1><p>First {told}</p><section {kind}="{name}"><p>{told}</p></section><p>Last {told}</p></article>'
        page = f"<html><body><nav><a href='/'>Home</a></nav>{body}<div class='{name}'><p>Outside, short.</p></div></body></html>"
        got = templates.main_text(page, [], set())
        assert got.split("\n\n")[:4] == ["Title", f"First {told}", told, f"Last {told}"], name
    links = '<article><p>Text of the article.</p><div class="share"><a href="a">One</a> <a href="b">Two</a></div>' \
            '<div class="comments"><p>A reader says so.</p></div></article>'
    assert templates.main_text(links, [], set()) == "Text of the article."


def test_unclosed_elements_by_the_ten_thousands():
    began = time.monotonic()
    got = templates.main_text("<div>" * 100_000 + "<p>Deep inside</p>", [], set())
    assert got == "Deep inside" and time.monotonic() - began < 20
