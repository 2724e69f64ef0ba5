import html
import math
import random
import time
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from corpus import CLASHING, DATA, HAVE, awkward, frame

from snapgrid.llm import html_region as hr
from snapgrid.llm import ordinal_quality as oq
from snapgrid.llm import ppm_language as ppm
from snapgrid.llm import secret_crf as sc
from snapgrid.llm import textkit as tk

needs_data = pytest.mark.skipif(not HAVE, reason="driver tables are absent")


# ---------------------------------------------------------------- quality


def test_slopes_are_the_derivatives():
    rng = np.random.default_rng(0)
    score, thresholds, grades = rng.normal(size=9), np.array([-1.0, 0.3]), np.arange(9) % 3

    def loss(s, t):
        below = np.concatenate([np.zeros((9, 1)), oq._sigmoid(t - s[:, None]), np.ones((9, 1))], axis=1)
        return -np.log(below[np.arange(9), grades + 1] - below[np.arange(9), grades])

    by_score, by_threshold = oq._slopes(score, thresholds, grades, 3)
    e = 1e-6
    assert np.allclose(by_score, (loss(score + e, thresholds) - loss(score - e, thresholds)) / (2 * e), atol=1e-5)
    for k in range(2):
        d = np.eye(2)[k] * e
        assert np.allclose(by_threshold[:, k], (loss(score, thresholds + d) - loss(score, thresholds - d)) / (2 * e), atol=1e-5)


def rated_texts(n=240):
    texts, grades = [], []
    for i in range(n):
        words = [f"w{(i * 7 + j * j) % 90}" for j in range(30)]
        if i % 6 == 0:
            words[i % 30] = "vile"
        elif i % 6 == 1:
            words = [w + "***" for w in words]
        texts.append(" ".join(words))
        grades.append({0: 0, 1: 1}.get(i % 6, 2))
    return texts, np.array(grades)


def test_grades_are_learned_in_order():
    texts, grades = rated_texts()
    model = oq.fit(pa.array(texts), grades, 3)
    assert (np.diff(model.thresholds) >= 0).all()
    tails = model.tails(model.scores(pa.array(texts)))
    expected = tails.sum(1)
    assert [np.median(expected[grades == g]) for g in range(3)] == sorted(np.median(expected[grades == g]) for g in range(3))
    assert ((tails[:, 1] >= 0.5) == (grades == 2)).mean() > 0.99


def test_fit_in_blocks_equals_the_whole(monkeypatch):
    texts, grades = rated_texts()
    whole = oq.fit(pa.array(texts), grades, 3)
    monkeypatch.setattr(oq, "_BLOCK", 97)
    parts = oq.fit(pa.array(texts), grades, 3)
    assert (whole.hashes == parts.hashes).all() and np.allclose(whole.weights, parts.weights)


def test_samples_are_those_that_figures_are_given_for():
    assert (oq.SAMPLE, sc.SAMPLE, sc.CHUNKS) == (8_000, 1_500, 6_000)


def test_quality_of_awkward_rows(spark):
    texts, grades = rated_texts()
    model = oq.fit(pa.array(texts), grades, 3)
    docs = frame(spark, clashing=True)
    rows, names = oq.graded(docs, model)
    got = rows.collect()
    assert len(got) == len(awkward()) and set(CLASHING) <= set(rows.columns) and names["tail"] == "tail_"
    assert all(r["tail_"] == 0 for r in got if not (r["text"] or "").strip())
    assert oq.kept(docs, model).columns == docs.columns
    assert oq.graded(frame(spark, []), model)[0].count() == 0


def test_training_without_ratings_or_with_odd_ones(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0), (3, 1, None), (4, 1, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, oq.rated(labels).collect())) == [(1, 1), (4, 0)]
    model = oq.train(frame(spark), oq.rated(labels.limit(0)))
    assert len(model.hashes) == 0 and model.scores(pa.array(["a", None])).tolist() == [0, 0]
    assert oq.train(frame(spark), oq.rated(labels)).thresholds.shape == (2,)


@needs_data
def test_quality_on_held_out_ratings():
    rows = duckdb.sql(
        f"""SELECT text, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END AS grade
            FROM '{DATA}/../sf0.01/documents.parquet' JOIN '{DATA}/../sf0.01/labels.parquet' USING (doc_id) ORDER BY doc_id"""
    ).fetchall()
    fold = np.arange(len(rows)) % 4 == 0
    texts, grades = np.array([r[0] for r in rows], object), np.array([r[1] for r in rows])
    model = oq.fit(pa.array(texts[~fold], pa.string()), grades[~fold], 3)
    kept = model.tails(model.scores(pa.array(texts[fold], pa.string())))[:, 1] >= 0.5
    assert (kept == (grades[fold] == 2)).mean() > 0.9


# ---------------------------------------------------------------- language


def slow_bits(counts, languages, text):
    """Code length by walking the contexts from the longest down, symbol by symbol."""
    classes = [0] * ppm.ORDER + [int(ppm.CLASSES[b]) for b in text.encode()]
    out = []
    for lang in languages:
        bits = 0.0
        for i in range(ppm.ORDER, len(classes)):
            p = 1.0
            for k in range(ppm.ORDER, -1, -1):
                seen = counts[lang].get((k, tuple(classes[i - k : i])))
                if not seen:
                    continue
                total, distinct = sum(seen.values()), len(seen)
                if classes[i] in seen:
                    p *= seen[classes[i]] / (total + distinct)
                    break
                p *= distinct / (total + distinct)
            else:
                p /= ppm.SYMBOLS
            bits -= math.log2(p)
        out.append(bits)
    return out


def test_code_lengths_equal_the_walk(spark):
    rows = [(1, "the cat sat on the mat. the hat", "en", None, None), (2, "die Katze saß auf der Matte", "de", None, None), (3, "the end", "en", None, None)]
    model = ppm.train(frame(spark, rows))
    counts = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for _, text, lang, _, _ in rows:
        classes = [0] * ppm.ORDER + [int(ppm.CLASSES[b]) for b in text.encode()]
        for i in range(ppm.ORDER, len(classes)):
            for k in range(ppm.ORDER + 1):
                counts[lang][(k, tuple(classes[i - k : i]))][classes[i]] += 1
    texts = ["the rat", "der Hut ß é", "", "z", "The cat sat on the mat"]
    got = model.bits(pa.array(texts))
    assert model.languages == ["de", "en"]
    for text, bits in zip(texts, got):
        assert np.allclose(bits, slow_bits(counts, model.languages, text), rtol=1e-5)


def test_rare_languages_keep_their_contexts(spark):
    """Thirty languages of the same letters, one with most of the text; each follows its own rule over three letters."""
    rng = np.random.default_rng(2)
    letters = np.array(list("abcdefghijklmnop"))
    rules = rng.integers(0, 16, (30, 16, 16, 16))

    def text(lang, n):
        out = rng.integers(0, 16, 3).tolist()
        while len(out) < n:
            odd = lang == 0 or rng.random() < 0.2
            out.append(int(rng.integers(0, 16)) if odd else int(rules[lang][tuple(out[-3:])]))
        return "".join(letters[out])

    rows = [(i, text(i, 60_000 if i == 0 else 4_000), f"l{i:02d}", None, None) for i in range(30)]
    model = ppm.train(frame(spark, rows))
    counts = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for _, own, lang, _, _ in rows:
        classes = [0] * ppm.ORDER + [int(ppm.CLASSES[b]) for b in own.encode()]
        for i in range(ppm.ORDER, len(classes)):
            for k in range(ppm.ORDER + 1):
                counts[lang][(k, tuple(classes[i - k : i]))][classes[i]] += 1
    held = [text(i, 400) for i in range(30)]
    bits = model.bits(pa.array(held))
    assert np.allclose(bits[3], slow_bits(counts, model.languages, held[3]), rtol=1e-5)
    assert (bits.argmin(1) == np.arange(30)).mean() > 0.95


def test_rows_of_a_language_are_bounded(spark):
    """A language with many rows is fitted on a share of them, by hash; small ones on all of theirs."""
    rng = random.Random(5)
    word = lambda signs: "".join(rng.choice(signs) for _ in range(rng.randint(2, 8)))
    text = {"aa": lambda: " ".join(word("abcde") for _ in range(9)), "bb": lambda: " ".join(word("cdefg") for _ in range(9))}
    rows = [(i, text["aa"](), "aa", None, None) for i in range(2_000)] + [(5_000 + i, text["bb"](), "bb", None, None) for i in range(60)]
    docs = frame(spark, rows).repartition(7)
    whole, part = ppm.train(docs), ppm.train(docs, most=100)
    sizes = [[sum(len(level.grams) for level in levels) for levels in m.levels] for m in (whole, part)]
    assert sizes[1][0] < sizes[0][0] and sizes[1][1] == sizes[0][1]
    assert [len(level.grams) for level in ppm.train(docs.repartition(3), most=100).levels[0]] == [len(level.grams) for level in part.levels[0]]
    held = [(lang, text[lang]()) for lang in ("aa", "bb") for _ in range(100)]
    found = part.bits(pa.array([t for _, t in held])).argmin(1)
    assert sum(part.languages[f] == lang for f, (lang, _) in zip(found, held)) >= 196


def test_long_texts_are_summed_in_pieces(spark, monkeypatch):
    model = ppm.train(frame(spark, [(1, "abc abd abe", "en", None, None), (2, "xyz xyw", "de", None, None)]))
    texts = pa.array(["abc xyz " * 40, "", None, "xyw " * 33, "é"])
    whole = model.bits(texts)
    monkeypatch.setattr(tk, "BLOCK", 7)
    assert np.allclose(model.bits(texts), whole)


def test_language_of_awkward_rows(spark):
    docs = frame(spark, clashing=True)
    found = {r.doc_id: r for r in ppm.predictions(docs, ppm.train(docs)).collect()}
    assert ppm.predictions(docs, ppm.train(docs)).count() == len(awkward())
    assert [found[i].lang_pred for i in (5, 6, 7)] == ["und"] * 3 and found[1].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found.values())
    nothing = ppm.train(docs.limit(0))
    assert {r.lang_pred for r in ppm.predictions(docs, nothing).collect()} == {"und"}


@needs_data
def test_language_of_held_out_documents(spark):
    import __spark_entry__ as registry

    folder = f"{DATA}/../sf0.01"
    found = registry.queries()["op9_language_id"](spark, folder).where("held_out").collect()
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    right = [r.lang_pred == truth[r.doc_id] for r in found]
    assert len(right) > 200 and sum(right) / len(right) > 0.98


# ---------------------------------------------------------------- secrets


def secret_texts():
    texts = []
    for i in range(120):
        value = f"{i * 7919 % 10**9:09d}abcdef{i:03d}fedc"
        if i % 3 == 0:
            texts.append(f'some words here password={value} and more words {i}')
        elif i % 3 == 1:
            texts.append(f"the key AKIA{value[:9]}ABCDEFG is given, mail me at a{i}@example.com or +1 (555) {i:03d}-0199")
        else:
            texts.append(f"nothing to see here in text {i}, only prose and {i} numbers.")
    return texts


def test_viterbi_equals_the_full_search():
    texts = secret_texts()
    model = sc.fit(texts, steps=15)
    rng = np.random.default_rng(1)
    wild = sc.Model(rng.normal(0, 1, model.weights.shape).astype(np.float32), rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3))
    data, offsets = tk.texts(pa.array([*texts, "", "x"]))
    found = sc.tokens(data, offsets)
    for m in (model, wild):
        tags, scores = m.tags(found), m.unary(found.features)
        for a, b in zip(found.first[:-1], found.first[1:]):
            if a == b:
                continue
            best, back = m.first + scores[a], []
            for k in range(a + 1, b):
                ways = best[:, None] + m.moves
                back.append(ways.argmax(0))
                best = ways.max(0) + scores[k]
            own = tags[a:b]
            value = m.first[own[0]] + scores[np.arange(a, b), own].sum() + m.moves[own[:-1], own[1:]].sum()
            assert value == pytest.approx(best.max(), abs=1e-3)


#: Secrets that no pattern finds; none of these words, prefixes or forms is in a training copy by name.
HIDDEN = {
    "pwd": 'and set pwd = "{}" for it',
    "bearer": "send Authorization: Bearer {} with it",
    "prefix": "then use ghp_{} there",
    "credential": "the credential: {} was given",
    "bare": "you will need {} for this",
}


def key(rng, n=32):
    return "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(n))


def varied_texts(n=400):
    """Prose of random words; a third of the texts has a secret that a pattern finds, somewhere."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9)))
    texts = []
    for i in range(n):
        words = [rng.choice([word(), word().title(), word() + rng.choice(",.;:"), str(rng.randrange(3_000))]) for _ in range(rng.randint(15, 60))]
        secret = rng.choice(["password={}", 'api_key: "{}"', "token = {}", "{}"])
        if i % 3 == 0:
            words[rng.randrange(len(words))] = secret.format("".join(rng.choice("0123456789abcdef") for _ in range(28)))
        texts.append(" ".join(words))
    return texts


def test_field_finds_secrets_that_no_pattern_names():
    model = sc.fit(varied_texts())
    got = sc.all_spans(pa.array(["plain prose without any", "x password=123456789abcdef000fedc y", None, ""]), model)
    assert got[0] == [] and got[2] == [] and got[3] == []
    assert got[1] == [(2, 0, 33)]  # a pattern's own span stays as it is
    rng = random.Random(9)
    caught = dict.fromkeys(HIDDEN, 0)
    for name, form in HIDDEN.items():
        for _ in range(40):
            value = key(rng)
            text = "some words here " + form.format(value) + " and more words after that"
            assert sc.pattern_spans(text) == []
            spans = sc.all_spans(pa.array([text]), model)[0]
            at = text.index(value)
            caught[name] += any(kind == 3 and a <= at and at + len(value) <= b for a, kind, b in spans)
    assert min(caught.values()) >= 36, caught


def test_field_leaves_ordinary_text_alone():
    model = sc.fit(varied_texts())
    plain = [
        "See https://www.example.com/some/long-path_to/page.html and mail first.last@example.org today.",
        "Call +49 30 1234567 on 2024-05-17, order 20394857, room B-204, version 3.11.2 of the file.",
        "Donaudampfschifffahrtsgesellschaft and internationalization, snake_case_name2 and camelCaseName.",
        "/usr/local/share/doc/readme_1.txt holds 1,234,567 rows; x=1&y=2 is a query.",
        "The quick brown fox jumps over the lazy dog near the old mill by the river.",
    ]
    assert [len(s) for s in sc.all_spans(pa.array(plain), model)] == [0] * len(plain)


@needs_data
def test_field_on_held_out_documents():
    """Fitted on two thirds of the documents, with secrets that patterns find planted in some: forms that no pattern
    names are found in the others, and nothing in their own text."""
    import pyarrow.parquet as pq

    docs = [d for d in pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pylist() if d["text"]]
    rng = random.Random(2)

    def planted(text, piece):
        at = text.find(" ", len(text) // 2) + 1
        return f"{text[:at]}{piece} {text[at:]}"

    known = ["password={}", 'api_key: "{}"', "token = {}", "secret: '{}'"]
    value = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(28))
    train = [d["text"] for d in docs if d["doc_id"] % 3]
    train = [planted(t, rng.choice(known).format(value())) if i % 2 else t for i, t in enumerate(train)]
    model = sc.fit(train)
    rest = [d["text"][:2_000] for d in docs if not d["doc_id"] % 3] * 3
    hits = extra = 0
    for text in rest:
        extra += len(sc.all_spans(pa.array([text]), model)[0]) - len(sc.pattern_spans(text))
        secret = key(rng, rng.choice([20, 32, 40]))
        text = planted(text, rng.choice(list(HIDDEN.values())).format(secret))
        spans = sc.all_spans(pa.array([text]), model)[0]
        hits += any(a <= text.index(secret) and text.index(secret) + len(secret) <= b for a, _, b in spans)
    assert len(rest) > 150 and hits >= 0.8 * len(rest) and extra <= 0.01 * len(rest), (hits, extra, len(rest))


def test_pattern_spans():
    text = "é PASSWORD: 'short' token=abc secret=abcdefg AKIA" + "A" * 16 + " AKIA123 " + "0" * 24 + "g" + "f" * 23
    spans = [(sc.KINDS[k], text[a:b]) for a, k, b, _ in sc.pattern_spans(text)]
    assert spans == [("assign", "secret=abcdefg"), ("access", "AKIA" + "A" * 16), ("hex", "0" * 24)]
    assert sc.pattern_spans("\u017fecret=abcdefgh to\u212aen=abcdefgh") == []


def test_secrets_of_awkward_rows(spark):
    docs = frame(spark, clashing=True)
    model = sc.train(docs)
    rows, name = sc.with_spans(docs, model)
    got = {r["doc_id"]: r[name] for r in rows.collect()}
    assert name == "spans_" and rows.count() == len(awkward())
    assert [s["kind"] for s in got[13]] == ["assign", "hex", "access"] and got[5] == [] and got[6] == []
    clean = {r["doc_id"]: r["text"] for r in sc.redacted(docs, model).collect()}
    assert clean[13] == '[SECRET]" and [SECRET] end' and clean[5] is None and clean[1] == awkward()[0][1]
    assert sc.train(docs.limit(0)) is None and sc.redacted(docs.limit(0), None).count() == 0


# ---------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if(a<b){"</p>"}</script></head><body><header><h1>Site</h1></header>
<div id="menu"><a href=x>Home</a></div><div class="cookie-notice">We use cookies</div><article><h1>Ti&eacute;tle &lt;x&gt;</h1>
<p>Hello <b>wor</b>ld&nbsp;a  b.<p>Second &amp more<br>line<div class="advert">Buy now</div><ul><li>one<li>two</ul>
<form><label>Mail</label></form><p style="display:none">hid</p><!-- no <p>no</p> --><p>Last</p></article>
<section class="comments"><p>Nice post with very many words indeed to score many points yes</p></section>
<aside>Related</aside><footer>&copy; foot</footer></body></html>"""


def test_main_text():
    model = hr.Model()
    for _ in range(5):
        assert model.learn(PAGE)
    assert hr.main_text(PAGE, model) == "Tiétle <x> Hello world a b. Second & more line one two Last"
    plain = "<body><div id=nav><a>Home</a></div><div class=post><p>First text here.</p><p>More.</p></div><div class=footer>foot</div>"
    assert hr.main_text(plain, model) == "First text here. More."
    assert [hr.main_text(p, model) for p in (None, "", "<p>", "<script>x", "&lt;b")] == ["", "", "", "", "<b"]
    assert hr.main_text("no tags", hr.Model()) == "no tags"


def test_a_hot_site_does_not_take_the_text_of_others(spark):
    hot = "<body><article><p>short text</p></article><div>" + "much other text beside it " * 40 + "</div></body>"
    own = "<body><article><p>First words here.</p><div>Second words in a plain div.</div></article></body>"
    plain = "<body><div>Only a plain div with its words.</div></body>"
    rows = [(i, f"https://hot.example/{i}", hot) for i in range(20)]
    rows += [(100 + i, f"https://s{i}.example/", own) for i in range(20)] + [(200, "https://p.example/", plain)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in hr.extracted(pages, hr.train(pages)).collect()}
    assert out[100] == "First words here. Second words in a plain div."
    assert out[200] == "Only a plain div with its words."


BODY = "<h1>Head</h1><p>The words of the body.</p><p>More of them.</p>"
BODY_TEXT = "Head The words of the body. More of them."
AROUND = "<nav><a>Home</a> <a>About us</a></nav>{}<footer>Imprint and so on</footer>"
#: Names that speak of something beside the content without being it.
WRAPPED = {
    "layout": f'<div class="layout with-sidebar"><article>{BODY}</article></div>',
    "modifier": f'<article class="post comments-open">{BODY}</article>',
    "negation": f'<div class="no-sidebar"><article>{BODY}</article></div>',
    "topic": f'<article><section class="legal-analysis">{BODY}</section></article>',
    "unclosed": f'<p class="notice">Cookies here<article>{BODY}</article>',
    "form": f'<form id="aspnetForm"><div id="page-header">Brand</div><article>{BODY}</article></form>',
    "sidebar": f'<div class="sidebar"><main>{BODY}</main></div>',
    "whole": f'<article><div class="sidebar">{BODY}</div></article>',
    "comments": f'<article>{BODY}<section id="comments"><article class="comment">I say</article></section></article>',
    "replies": f'<main>{BODY}</main><section class="comment-list"><article class="comment even">I say</article></section>',
    "compound": f'<article>{BODY}<div class="ad-container-2">Buy</div><div class="related-posts">See</div></article>',
    "bare": f'<div class="sidebar-left">Side</div><div class="search">{BODY}</div>',
}


@pytest.mark.parametrize("name", WRAPPED)
def test_names_do_not_take_the_article(name):
    pages = [AROUND.format(x) for x in (*WRAPPED.values(), f"<article>{BODY}</article>")]
    learned = hr.Model()
    for page in pages:
        learned.learn(page)
    for model in (hr.Model(), learned):
        assert hr.main_text(AROUND.format(WRAPPED[name]), model) == BODY_TEXT


@pytest.mark.parametrize(
    "page",
    [
        "<article>" + "<p>some words here" * 12_000 + "</article>",
        "<article>" + "<div>" * 4_000 + "x</span></b></section>" * 4_000 + "</article>",
        "<article>" + "<b><i>" * 8_000 + "text" + "</i></u>" * 8_000 + "</article>",
        "<article><ul>" + "<li><a>one" * 12_000 + "</ul></article>",
        "<table>" + "<tr><td>one<td>two" * 6_000 + "</table>",
    ],
    ids=["paragraphs", "strays", "inline", "items", "cells"],
)
def test_long_pages_take_linear_time(page):
    before = time.perf_counter()
    assert hr.main_text(page, hr.Model())
    assert time.perf_counter() - before < 1.5


def test_open_elements_end_where_html_ends_them():
    def text(page):
        return hr.main_text(page, hr.Model())

    assert text("<article><p class=notice>gone<p>kept<div>more</div></article>") == "kept more"
    assert text("<article><ul><li class=ad>gone<li>kept<ul><li>deep</ul><li>last</ul></article>") == "kept deep last"
    assert text("<article><table><tr><td class=ad>gone<td>kept<tr><td>next</table></article>") == "kept next"
    assert text("<article><dl><dt class=ad>gone<dd>kept</dl><select><option>no</select></article>") == "kept"
    assert text("<article><b class=ad>gone<p>gone too</p></b> kept</article>") == "kept"
    assert text("<article><div class=ad>gone</span> gone</div>kept</article>") == "kept"


def test_pages_made_of_known_parts():
    """Random pages against what they were made of: article blocks in order, everything else left out."""
    rng = random.Random(6)
    word = lambda: rng.choice(["word", "Wörter", "a&amp;b", "x&lt;y", "and"])
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 12)))
    noise = [
        "<nav>{}</nav>", '<div class="cookie-banner">{}</div>', "<aside><p>{}</aside>", '<section id="comments"><p>{}</section>',
        "<script>if (a < b) {}</script>", "<!-- {} -->", '<ul class="menu"><li>{}<li>x</ul>', "<form><label>{}</label></form>", "<style>{}</style>",
    ]
    blocks = ["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div><b>{}</b></div>", "<ul><li>{}</li></ul>", '<div class="with-sidebar"><p>{}</p></div>', "<blockquote>{}</blockquote>"]
    pages = []
    for _ in range(300):
        inside, want = [], []
        for i in range(rng.randint(1, 9)):
            if i and rng.random() < 0.3:  # an article has some text of its own
                inside.append(rng.choice(noise).format(sentence()))
            else:
                own = sentence()
                inside.append(rng.choice(blocks).format(own))
                want.append(html.unescape(own))
        around = [rng.choice(noise).format(sentence()) for _ in range(4)]
        tag = rng.choice(["article", "main", 'article class="post has-comments"'])
        page = "<html><body>" + "\n".join([*around[:2], f"<{tag}>" + "".join(inside) + f"</{tag.split()[0]}>", *around[2:]]) + "</body></html>"
        pages.append((page, " ".join(want)))
    model = hr.Model()
    for page, _ in pages[:150]:
        model.learn(page)
    for page, want in pages:
        assert hr.main_text(page, model) == want


def test_region_is_the_best_run():
    rng = np.random.default_rng(4)
    for _ in range(300):
        scores = rng.integers(-4, 5, rng.integers(0, 12)).tolist()
        low, high = hr.region(scores)
        best = max([0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        assert sum(scores[low:high]) == best


def test_pages_with_nulls(spark):
    rows = [(1, "u", PAGE), (None, None, PAGE), (2, None, None), (3, "", ""), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    out = hr.extracted(pages, hr.train(pages)).collect()
    assert sorted(len(r.text) for r in out) == [0, 0, 59, 59, 59] and all(r.n_chars == len(r.text) for r in out)
    assert hr.extracted(pages.limit(0), hr.train(pages.limit(0))).count() == 0
