"""Quality classifier, line rules, language and extraction: brute force, held-out accuracy, odd rows."""
import itertools
import math
import re
import time
import unicodedata
import zlib
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import html_extract, langid, line_rules, quality
from riskframe.llm.queries import op7_quality_classifier, op9_language_id, remainder

SF = "/root/testdata/sf0.01"


def test_quality_on_the_held_out_fold(spark):
    got = op7_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 50
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93


def test_negative_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fold = remainder("doc_id", 5) != 0
    a = quality.fit(docs, labels, fold, fit_rows=300)
    b = quality.fit(docs, labels.where("quality = 1"), fold, fit_rows=300)
    assert np.array_equal(a.w1, b.w1) and a.prior == b.prior


def test_prior_estimate():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(1, 1, (3000, 18)), rng.normal(-1, 1, (3000, 18))
    unl = np.vstack([pos[:1800], neg[:1200]])
    assert quality.estimate_prior(rng.permutation(pos), rng.permutation(unl)) == pytest.approx(0.6, abs=0.06)


def test_quality_of_odd_rows(spark, odd, labels):
    model = quality.fit(odd, labels, F.lit(True))
    got = quality.scored(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    kept = quality.accepted(odd, model, threshold=-1.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    none = odd.where("false")
    assert quality.scored(none, quality.fit(none, labels, F.lit(True))).collect() == []
    assert {r.score for r in quality.scored(odd, quality.fit(odd, labels.where("false"), F.lit(True))).collect()} == {0.5}


def plain_features_and_score(text, model):
    """The score of a text by its definition: features one by one, then the network in plain Python."""
    x = [max(-6.0, min(6.0, (a - m) / s)) for a, m, s in zip(quality.features(None if text is None else text.encode()), model.mean, model.scale)]
    hidden = [math.tanh(sum(a * w for a, w in zip(x, col)) + b) for col, b in zip(model.w1.T, model.b1)]
    return 1 / (1 + math.exp(-(sum(h * w for h, w in zip(hidden, model.w2)) + model.b2)))


def test_scores_equal_the_network_by_hand(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels, remainder("doc_id", 5) != 0, fit_rows=200)
    texts = {r.doc_id: r.text for r in odd.where("doc_id is not null").collect()}
    for r in quality.scored(odd.where("doc_id is not null"), model).collect():
        assert r.score == pytest.approx(plain_features_and_score(texts[r.doc_id], model), abs=1e-9)


@pytest.mark.parametrize("prior, shift", [(0.4, 0.0), (0.9, 4.0)])
def test_gradients_of_the_non_negative_risk(prior, shift):
    """Numeric gradients; with a negative part below zero the step climbs on it: minus its own gradient."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(shift, 1, (30, 4)), rng.normal(-shift, 1, (40, 4))
    params = [np.abs(rng.normal(0, 0.5, (4, 3))), 0.1 * rng.normal(size=3), np.ones(3) + 0.1 * rng.normal(size=3), np.zeros(1)]

    def loss(q):
        f = lambda z: np.tanh(z @ q[0] + q[1]) @ q[2] + q[3][0]
        soft = lambda v: np.log1p(np.exp(v)).mean()
        neg = soft(f(u)) - prior * soft(f(p))
        return prior * soft(-f(p)), neg, quality.DECAY / 2 * ((q[0] ** 2).sum() + (q[2] ** 2).sum())

    own, neg, decay = loss(params)
    value, grads = quality.risk(params, p, u, prior)
    assert shift == 0 or neg < 0
    assert value == pytest.approx(own + max(0, neg) + decay)
    target = (lambda q: loss(q)[0] + loss(q)[1] + loss(q)[2]) if neg >= 0 else (lambda q: -loss(q)[1] + loss(q)[2])
    for i, g in enumerate(grads):
        for at in np.ndindex(*params[i].shape):
            up, down = ([x.copy() for x in params] for _ in range(2))
            up[i][at] += 1e-5
            down[i][at] -= 1e-5
            assert g[at] == pytest.approx((target(up) - target(down)) / 2e-5, abs=1e-6)


def test_repeated_ids_fit_alike_in_any_layout(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    twice = docs.select("doc_id", "text").unionAll(docs.selectExpr("doc_id", "reverse(text)"))
    a = quality.fit(twice.repartition(3), labels, F.lit(True), fit_rows=100)
    b = quality.fit(twice.repartition(7, "text"), labels, F.lit(True), fit_rows=100)
    assert np.array_equal(a.w1, b.w1) and a.prior == b.prior


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def test_line_rule_counts(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionAll(
        odd.select("doc_id", "text")).unionAll(spark.createDataFrame([(5000, "a a a a a b\x1cc\x85d e\na a a\n\na a a")], "doc_id long, text string"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = line_rules.ruled(docs, line_rules.fit(docs, labels)).collect()
    want = sorted(((r.doc_id, *plain_counts(r.text or "")) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_clean_documents_are_kept_and_junk_is_not(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = line_rules.ruled(docs, line_rules.fit(docs, labels.where("doc_id % 2 = 0"))).join(labels, "doc_id").where("doc_id % 2 = 1").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([not r.kept for r in got if r.quality == 0]) > 0.9


def test_line_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    crf = line_rules.Crf(rng.normal(size=(2, line_rules.N_FEATURES)), rng.normal(size=(2, 2)))
    texts = [rng.normal(size=(n, line_rules.N_FEATURES)) for n in (0, 1, 5, 3, 5, 0, 8)]
    for x, y in zip(texts, crf.viterbi(texts)):
        e = x @ crf.weight.T
        best = max(itertools.product((0, 1), repeat=len(x)), key=lambda v: sum(e[i, k] for i, k in enumerate(v))
                   + sum(crf.change[a, b] for a, b in zip(v, v[1:])))
        assert tuple(y) == best


def test_crf_training_fits_a_chain():
    rng = np.random.default_rng(4)
    xs, ys = [], []
    for _ in range(60):
        y = np.repeat(rng.integers(0, 2, 3), 4)
        x = rng.normal(size=(12, line_rules.N_FEATURES))
        x[:, 3] += 3 * y
        xs.append(x)
        ys.append(y)
    got = line_rules.train(xs, ys).viterbi(xs)
    assert np.mean(np.concatenate(got) == np.concatenate(ys)) > 0.95


def test_line_rules_on_empty_tables(spark, odd, labels):
    none = odd.where("false")
    assert line_rules.ruled(none, line_rules.fit(none, labels)).collect() == []
    assert line_rules.ruled(odd, line_rules.fit(odd, labels.where("false"))).count() == odd.count()


def test_language_on_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op9_language_id(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 150 and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97


def test_language_viterbi_is_the_best_path():
    counts = {k: Counter(g for w in ws for g in langid.grams(w)) for k, ws in
              {"x": ["aba", "bab", "aab"], "y": ["cdc", "ddc", "acd"], "z": ["xyz"]}.items()}
    m = langid.build(counts)
    texts = [["aba", "cdc", "acd", "bab"], [], ["zzz"], ["aab", "xyz", "xyz", "ddc", "aba"], ["ж"]]
    for words, tags in zip(texts, m.spans(texts)):
        e = m.word_scores(words) if words else []
        best = max((sum(e[i][k] for i, k in enumerate(v)) - m.switch * sum(a != b for a, b in zip(v, v[1:])), v)
                   for v in itertools.product(range(3), repeat=len(words)))
        assert len(tags) == len(words)
        if words:
            score = sum(e[i][k] for i, k in enumerate(tags)) - m.switch * sum(a != b for a, b in zip(tags, tags[1:]))
            assert score == pytest.approx(best[0])


def test_scripts_narrow_the_candidates_and_spans_switch(spark):
    rows = [(i, "the cat sat on the mat with a hat", "en") for i in range(5)] + [
        (10 + i, "кот сидел на коврике в шляпе", "ru") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.fit(df, F.lit(True))
    mixed = spark.createDataFrame([(1, "the cat сидел на коврике", None), (2, "1234 !", None), (3, None, None), (4, "漢字", None)], df.schema)
    got = {r.doc_id: r for r in langid.identified(mixed, m).collect()}
    assert [(s.lang, s.word, s.words) for s in got[1].spans] == [("en", 0, 2), ("ru", 2, 3)] and got[1].lang_pred == "ru"
    assert (got[2].lang_pred, got[2].score, got[3].lang_pred) == ("und", 0.0, "und")
    assert got[4].lang_pred in ("en", "ru")


def test_every_letter_of_a_long_run_counts(spark):
    rows = [(i, "the cat sat on the mat with a hat", "en") for i in range(5)] + [
        (10 + i, "我们在这里学习中文的语法", "zh") for i in range(5)] + [(20 + i, "私達は日本語の文法を学校で学ぶ", "ja") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.fit(df, F.lit(True))
    texts = ["cat" + "我们在这里学习中文的语法" * 9, "我们在这里学习中文的语法" * 4 + "私達は日本語の文法を学校で学ぶ" * 20, "x" * 100 + "é" * 7]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identified(docs, m).collect()}
    assert [s.lang for s in got[0].spans] == ["en", "zh"] and got[0].lang_pred == "zh"
    assert got[1].lang_pred == "ja" and {s.lang for s in got[1].spans} == {"ja", "zh"}
    for t in [*texts, "aµb ªº ǅ ﬁnal ᏣᎳᎩ IBM公司 ไทยລາວ кот_1"]:
        assert "".join(langid.words_of(t)) == "".join(c for c in t.lower() if unicodedata.category(c)[0] == "L")
        assert all(len({langid.script(c) for c in w}) == 1 for w in langid.words_of(t))


@pytest.mark.parametrize("text, words", [
    ("हिन्दी में", ["हिन्दी", "में"]), ("ภาษาไทยที่", ["ภาษาไทยที", "่"][:1]), ("²³ ½ ⅷ ① 五", ["五"]), ("e\u0301te\u0301 na\u00efve", ["e\u0301te\u0301", "na\u00efve"]),
    ("x²y", ["x", "y"]), ("தமிழ் மொழி", ["தமிழ்", "மொழி"]), ("\u0301\u0301", []), ("a\u0301" * 45, ["a\u0301" * 20, "a\u0301" * 20, "a\u0301" * 5]), ("a" * 39 + "b\u0301\u0302" + "c", ["a" * 39 + "b\u0301\u0302", "c"])])
def test_words_keep_their_marks(text, words):
    found = langid.words_of(text)
    if "ไ" in text:  # pieces of eight letters, each with its marks
        assert "".join(found) == text and all(unicodedata.category(w[0])[0] == "L" for w in found)
    else:
        assert found == words


def test_signs_that_look_like_letters_are_none(spark, odd):
    rows = [(i, "the cat sat on the mat", "en") for i in range(4)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    docs = spark.createDataFrame([(1, "²³ ¼ ⅷ"), (2, "①②"), (3, "_ 12 \u0301")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in langid.identified(docs, model).collect()} == {("und", 0.0)}


def test_language_of_odd_rows(spark, odd):
    got = langid.identified(odd, langid.fit(odd, F.lit(True))).collect()
    assert len(got) == odd.count()
    assert all((r.lang_pred == "und") == (r.score == 0.0) for r in got)
    none = odd.where("false")
    assert langid.identified(none, langid.fit(none, F.lit(True))).collect() == []
    assert {r.lang_pred for r in langid.identified(odd, langid.fit(none, F.lit(True))).collect()} == {"und"}


def plain_article(html):
    m = re.search(r"<article>(.*?)(</article>|$)", html or "", re.S)
    blocks = re.split(r"</?(?:p|h1|br)>", m[1]) if m else []
    return " ".join(x for x in (re.sub(r"\s+", " ", unescape(re.sub(r"</?b>", "", b))).strip() for b in blocks) if x)


def test_extraction_against_the_marked_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = html_extract.extracted(pages).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    assert len(got) == len(html)
    assert all(r.text == plain_article(html[r.page_id]) and r.n_chars == len(r.text) for r in got)


PAGE = ("<html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><header><h1>Site</h1></header>"
        "<div class='main-menu'><ul><li><a>One</a><li><a>Two</a></ul></div><div id=cookieNotice>We use cookies on this site</div>"
        "%s<div id='comments'><p>First! A reader's own long remark about all of it.</p></div>"
        "<aside>Related things to read</aside><form><p>Your mail<input name=x></form><footer>&copy; us</footer></body></html>")


@pytest.mark.parametrize("body, text", [
    ("<article><header><h1>Title</h1></header><p>A first paragraph that is long enough to be read as text.<p>Ok.<ul><li>x<li>y</ul></article>",
     "Title A first paragraph that is long enough to be read as text. Ok. x y"),
    ("<div><h2>Head</h2><p>Text with <b>bo</b>ld, &lt;tags&gt; and\n &amp; marks; this line is long.</p><p>Ok<br>then</p></div>",
     "Head Text with bold, <tags> and & marks; this line is long. Ok then"),
    ("<main><table><tr><td>cell one<td>cell two</table><script>var x = '<p>no</p>'</script><p hidden>gone</p>Plain words that stand alone here</main>",
     "cell one cell two Plain words that stand alone here")])
def test_extraction_of_made_pages(body, text):
    assert html_extract.main_text(PAGE % body) == text


BODY = "A long line of the body that is read as text by anyone. " * 40


@pytest.mark.parametrize("body, text", [
    (f"<article><h1>Title</h1><div class=body><p>{BODY}</div><p>Last paragraph.</article>", f"Title {BODY.strip()} Last paragraph."),
    (f"<article><header><h1>Title</h1></header><section><p>{BODY}</section><section><p>Short one.</section></article>",
     f"Title {BODY.strip()} Short one."),
    (f"<main><p>Before.<table><tr><td>{BODY}<td>x</table><p>After.</main>", f"Before. {BODY.strip()} x After."),
    (f"<h1>Title</h1><div><div><p>{BODY}</div><p>Last paragraph.</div><ul><li><a href=a>One</a><li><a href=b>Two</a></ul>",
     f"Title {BODY.strip()} Last paragraph. One Two"),
    (f"<div><div><p>{BODY}</div></div><div><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>", BODY.strip())])
def test_extraction_keeps_what_lies_around_the_largest_part(body, text):
    assert html_extract.main_text(PAGE % body) == text


def test_extraction_of_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>a"), (3, "u", "plain text"), (3, "u", "plain text"), (4, "u", "<div class=ad>x</div>"),
            (5, "u", "<<<>>&&& </p></div>"), (6, "u", "<p>" + "word " * 100_000), (7, "u", "<div>" * 3000 + "deep" + "</div>" * 3000),
            (8, "u", "<script>x"), (9, "u", "<!-- c --><![CDATA[x]]><?pi?>ok")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = html_extract.extracted(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert (by[1], by[2], by[None], by[3], by[4], by[8]) == ("", "", "a", "plain text", "", "")
    assert by[6] == ("word " * 100_000).strip() and by[7] == "deep" and by[9].endswith("ok")
    assert html_extract.extracted(df.where("false")).collect() == []


ARTICLE = f"<article><h1>Title</h1><p>{BODY}</p><p>Last one.</p></article>"
TEXT = f"Title {BODY.strip()} Last one."
MORE = "Another paragraph of the page, also long enough to be read as prose by anyone at all."


@pytest.mark.parametrize("html, text", [
    (f"<html><head><title>T</title><meta charset=x><body>{ARTICLE}", TEXT),                                   # no </head>
    (f"<html><head><title>T</title><p>{BODY}<p>{MORE}", f"{BODY.strip()} {MORE}"),                             # neither </head> nor body
    (f"<body><form action=x><input name=q><nav><a href=a>One</a></nav>{ARTICLE}</form></body>", TEXT),         # a page inside a form
    (f"<body><form><div><p>{BODY}<p>{MORE}</div><div><label>Name</label><input></div></form>", f"{BODY.strip()} {MORE} Name"),
    (f"<div class='content no-sidebar'><p>{BODY}</p><p>{MORE}</p></div><div class=sidebar><p>{MORE}</p></div>", f"{BODY.strip()} {MORE}"),
    (f"<div class='search-wrapper'><p>{BODY}</p><p>{MORE}</p></div>", f"{BODY.strip()} {MORE}"),              # wraps the page
    (f"<article><p>{BODY}</p><section id=related-work><p>{MORE}</p></section><h2 id=search-algorithms>Search</h2><p>x</p></article>",
     f"{BODY.strip()} {MORE} Search x"),
    (f"<nav><ul><li><a href=a>One</a></ul><main><p>{BODY}</p><p>{MORE}</p></main>", f"{BODY.strip()} {MORE}"),  # an open nav
    (f"<header><h1>Site</h1>{ARTICLE}", TEXT),
    (f"{ARTICLE}<article class=comment><p>{MORE * 30}</p></article>", TEXT),
    (f"<main><p>{BODY}</p><article class='comment-body'><p>{MORE}</p></article></main>", BODY.strip()),
    (f"<div><article><p>{MORE}</p></article><div id=comments><article><p>{BODY * 9}</p></article></div></div>", MORE),
    (f"{ARTICLE}<aside><article><p>{MORE}</p></article></aside><div class='related-posts'><p>{MORE}</p></div>", TEXT),
    (f"<article><p>{BODY}</p><form><p>{MORE}</p><input></form><p>End.</p></article>", f"{BODY.strip()} End."),
    ("<div class=cookie-notice><p>We use cookies to make this site work for you.</p></div>", "")])
def test_extraction_judges_furniture(html, text):
    assert html_extract.main_text(html) == text


@pytest.mark.parametrize("value, words", [
    ("content no-sidebar", ""), ("related-work", ""), ("search-algorithms", ""), ("with-footer", ""), ("hasNav", ""), ("adapted", ""),
    ("site-nav", "nav"), ("left sidebar-2", "sidebar"), ("relatedPosts", "related"), ("comment-list", "comment"), ("cookieNotice", "cookie notice"),
    ("post-comments", "comments"), ("article", ""), ("menu_item active", "menu")])
def test_names_of_furniture(value, words):
    assert html_extract.furniture_words(value) == frozenset(words.split())


@pytest.mark.parametrize("html", ["<b>a " * 250_000, "<div>" * 200_000 + "x", "<div><p>a <li>b " * 60_000, "<nav><i>a" * 100_000,
                                  "<article><a>b</i> " * 50_000, "<td>x" * 150_000, "</p>" * 200_000, "<div class=ad>x" * 60_000])
def test_a_megabyte_of_open_tags_takes_seconds(html):
    began = time.process_time()
    html_extract.main_text(html)
    assert time.process_time() - began < 5
