"""Classifier, language model, language identification and page text against brute force, invariants and held-out data."""

from __future__ import annotations

import binascii
import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import html_text, language_id, ordinal, queries
from granary.llm import pitman_yor as py
from tests.llm.helpers import SF, docs, odd_rows
from tests.llm.test_rules import WORD


# -- classifier -------------------------------------------------------------------------------------------------------


def test_ordinal_gradient():
    rng = np.random.default_rng(0)
    scores, grades, free = rng.normal(size=50), rng.integers(0, 4, 50), np.array([-1.0, 0.2, -0.3])
    loss, by_score, by_free = ordinal.loss_and_gradient(scores, grades, free)
    for k in range(3):
        step = np.zeros(3)
        step[k] = 1e-6
        assert (ordinal.loss_and_gradient(scores, grades, free + step)[0] - loss) / 1e-6 == pytest.approx(by_free[k], abs=1e-3)
    moved = scores.copy()
    moved[7] += 1e-6
    assert (ordinal.loss_and_gradient(moved, grades, free)[0] - loss) / 1e-6 == pytest.approx(by_score[7], abs=1e-3)
    assert (np.diff(ordinal.thresholds(free)) > 0).all()


def test_classifier_learns_grades(spark):
    rows = [(i, " ".join([["bad", "fair", "fine"][i % 3]] + [f"w{(i * 7 + k) % 90}" for k in range(20)])) for i in range(600)]
    table = docs(spark, rows + [r[:2] for r in odd_rows() if r[0] is None or r[0] < 6])
    ratings = spark.createDataFrame([(i, i % 3) for i in range(300)] + [(None, 1), (7, None)], "doc_id long, grade int")
    model = ordinal.fit(table, ratings, n_grades=3)
    out = {r.doc_id: r for r in ordinal.classify(table, model).collect()}
    assert len(out) == 600 + 1  # the ids below 6 occur twice, one id is null
    held_out = [out[i] for i in range(300, 600)]
    assert sum(r.keep == (r.doc_id % 3 == 2) for r in held_out) > 290
    assert sum(round(r.expected_grade) == r.doc_id % 3 for r in held_out) > 280


def test_classifier_without_ratings(spark):
    ratings = spark.createDataFrame([], "doc_id long, grade int")
    model = ordinal.fit(docs(spark, odd_rows()), ratings, n_grades=3)
    assert not model.weights.any() and ordinal.classify(docs(spark, []), model).count() == 0


def test_classifier_held_out(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = spark.read.parquet(f"{SF}/labels.parquet").collect()
    grade = {r.doc_id: 0 if r.toxic else 1 + r.quality for r in rows}
    ratings = spark.createDataFrame([(d, g) for d, g in grade.items() if d % 4], "doc_id long, grade int")
    out = ordinal.classify(table, ordinal.fit(table, ratings, n_grades=3)).collect()
    held_out = [(r.keep, grade[r.doc_id] == 2) for r in out if r.doc_id in grade and r.doc_id % 4 == 0]
    assert sum(a == b for a, b in held_out) > 0.8 * len(held_out)


# -- language model ---------------------------------------------------------------------------------------------------


def tokens(text):
    return [w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))] + [None]


def crc(doc_id, folds):
    return binascii.crc32(str(doc_id).encode()) % folds if doc_id is not None else 0


def check_model(rows, got):
    train = Counter(t for d, x in rows if crc(d, 7) != 2 for t in tokens(x))
    n, v = train.total(), len(train)
    want = []
    for d, x in rows:
        own = tokens(x)
        base = sum(math.log10((train[t] + 1) / (n + v + 1)) for t in own)
        want.append((d if d is not None else -1, crc(d, 7) == 2, len(own), sum(train[t] > 0 for t in own), n, pytest.approx(base, rel=1e-9)))
    key = lambda r: (r[0], r[2], r[3])
    have = sorted(((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert have == sorted(want, key=key)
    return sum(r.score for r in got if r.held_out), sum(r.base_score for r in got if r.held_out)


def test_language_model_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op4_pitman_yor"](spark, SF).collect()
    score, base = check_model(rows, got)
    assert score > 0.95 * base  # both negative: the held-out texts are likelier
    again = {r.doc_id: r.score for r in queries.QUERIES["op4_pitman_yor"](spark, SF).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, rel=1e-12) for r in got)


def parts_of(spark, rows, shard_tokens, monkeypatch):
    monkeypatch.setattr(py, "SHARD_TOKENS", shard_tokens)
    table = docs(spark, rows).repartition(3)
    models, corpus = py.train(table.select("text"), 4)
    return {(r.doc_id, r.n_tokens): r.score for r in py.score(table, models, corpus, 4).collect()}


def test_parts_of_a_shard_change_nothing(spark, monkeypatch):
    rows = [r[:2] for r in odd_rows()]
    whole, parts = parts_of(spark, rows, 10**9, monkeypatch), parts_of(spark, rows, 300, monkeypatch)
    assert whole == {k: pytest.approx(v, rel=1e-9) for k, v in parts.items()}


def test_probabilities_sum_to_one(spark):
    rows = [(i, "a b c a b a " * (i % 5) + "d e") for i in range(60)]
    models, corpus = py.train(docs(spark, rows).select("text"), 1)
    block = models.select("model").first()["model"]
    predictive = py.ShardModel(0, block, corpus).predictive()
    words = np.sort(np.append(predictive.words, np.uint64(12345)))  # one word that no text has
    for context in (0, *set((predictive.keys % py.CONTEXTS).tolist())):
        one = np.ones(len(words), np.int64)
        _, log_p, _, known = predictive.answer(words, one, one * context, np.arange(len(words)))
        assert (10.0**log_p).sum() == pytest.approx(1.0, abs=1e-9) and known.sum() == len(words) - 1


def test_every_word_is_a_context_of_its_own(spark):
    n = 70_000  # more than any fixed number of restaurants that could be shared by chance
    rows = [(k, " ".join(f"w{i} x{i}" for i in range(k, min(k + 1000, n)))) for k in range(0, n, 1000)]
    models, corpus = py.train(docs(spark, rows).repartition(3).select("text"), 4)
    shards = [py.ShardModel(r.shard, r.model, corpus).predictive() for r in models.collect()]
    owned = np.concatenate([p.owned for p in shards])
    assert len(owned) == len(np.unique(owned)) == 2 * n + 1  # the end token is one too
    customers, *tables = (np.concatenate(x) for x in zip(*(p.by_context for p in shards), strict=True))
    assert customers.sum() == corpus.tokens and sorted(customers)[-2] == 1
    for t, sums in zip(tables, corpus.rounds[py.BURN_IN + 1 :], strict=True):
        assert t.sum() == sums.customers1 and (t <= customers).all()


def test_score_of_shards_is_the_formula(spark):
    rows = [r[:2] for r in odd_rows()]
    table = docs(spark, rows)
    models, corpus = py.train(table.filter("doc_id % 2 = 0").select("text"), 4)
    shards = [py.ShardModel(r.shard, r.model, corpus).predictive() for r in models.collect()]
    pair, word, context = {}, {}, {}
    for p in shards:
        for key, c, t in zip(p.keys.tolist(), p.counts.tolist(), p.seated.tolist(), strict=True):
            pair[int(p.words[key // py.CONTEXTS]), int(p.known[key % py.CONTEXTS])] = c - corpus.discount * t / py.SAMPLES
        word |= dict(zip(p.words.tolist(), zip(*(x.tolist() for x in p.by_word), strict=True), strict=True))
        context |= dict(zip(p.owned.tolist(), zip(*(x.tolist() for x in p.by_context), strict=True), strict=True))
    want = []
    for _, text in rows:
        own, total, before = py.tokens_of(pa.array([text], pa.string())).words.tolist(), 0.0, int(py.END)
        for w in own:
            counts, (customers, *tables) = word.get(w, (0,) * 5), context.get(before, (0,) * 3)
            back = 0.0
            for s, t in enumerate(tables):
                sums = corpus.rounds[py.BURN_IN + 1 + s]
                new = (py.STRENGTH + corpus.discount1 * sums.tables1) / (corpus.words + 1)
                parent = (counts[1 + 2 * s] - corpus.discount1 * counts[2 + 2 * s] + new) / (py.STRENGTH + sums.customers1)
                back += (py.STRENGTH + corpus.discount * t) * parent / py.SAMPLES
            total += math.log10((pair.get((w, before), 0.0) + back) / (py.STRENGTH + customers))
            before = w
        want.append(total)
    got = sorted(r.score for r in py.score(table, models, corpus, 4).collect())
    assert got == pytest.approx(sorted(want), rel=1e-9)


def test_tables_follow_the_exact_conditional():
    d, c, p, rest = 0.6, 3, 0.2, 4
    rng = np.random.default_rng(1)
    n = 40_000
    drawn = py.draw_tables(np.full(n, c), np.ones(n, np.int64), np.full(n, rest), np.full(n, p), d, rng)

    def seatings(sizes, left):
        if not left:
            yield sizes, 1.0
            return
        for k, s in enumerate(sizes):
            for out, w in seatings([*sizes[:k], s + 1, *sizes[k + 1 :]], left - 1):
                yield out, w * (s - d)
        for out, w in seatings([*sizes, 1], left - 1):
            yield out, w * (py.STRENGTH + d * (rest + len(sizes))) * p

    weight = Counter()
    for sizes, w in seatings([], c):
        weight[len(sizes)] += w
    for t in (1, 2, 3):
        assert (drawn == t).mean() == pytest.approx(weight[t] / weight.total(), abs=0.01)


def test_large_dishes_are_close_to_small_ones():
    d, n, rng = 0.7, 4000, np.random.default_rng(2)
    for p in (0.3, 0.001):
        share = []
        for c in (py.EXACT, py.EXACT + 1, 10 * py.EXACT):
            t = py.draw_tables(np.full(n, c), np.ones(n, np.int64), np.zeros(n, np.int64), np.full(n, p), d, rng)
            assert (t >= 1).all() and (t <= c).all()
            share.append(d * t.mean() / c)  # what the tables take from the customers
        assert abs(share[0] - share[1]) < 0.02 and share[2] < share[1] + 0.005


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing_blocks(values):
    a = np.sort(np.array(values, np.uint64))
    out = py.unpack(py.pack(a_sorted=a, b=a[::-1].copy(), c=py.small(a % np.uint64(300))))
    assert (out["a_sorted"] == a).all() and (out["b"] == a[::-1]).all() and (out["c"] == a % np.uint64(300)).all()


def test_language_model_odd_cases(spark):
    rows = [r[:2] for r in odd_rows()]
    table = docs(spark, rows)
    models, corpus = py.train(table.filter("false").select("text"), 32)
    assert corpus.tokens == 0 and corpus.words == 0
    assert py.score(table, models, corpus, 32).filter("n_known = 0").count() == len(rows)
    models, corpus = py.train(table.select("text"), 32)
    assert py.score(table.filter("false"), models, corpus, 32).count() == 0


# -- language identification ------------------------------------------------------------------------------------------


def grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in (text or "").lower())):
        padded = f" {word} "
        for i, c in enumerate(word, 1):
            out[(c,)] += 1
            out[(padded[i - 1], c)] += 1
            out[(padded[i - 1], c, padded[i + 1])] += 1
        out[(word[-1], " ")] += 1
    return out


def profile(counts):
    key = lambda g: tuple(1 if c == " " else ord(c) for c in g) + (0,) * (3 - len(g))
    return {g: r for r, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], key(x[0])))[: language_id.PROFILE])}


def brute_languages(rows, learn):
    by_lang = {}
    for lang, text in learn:
        by_lang.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: profile(c) for lang, c in by_lang.items()}
    out = []
    for _, text in rows:
        own, size = profile(grams(text)), language_id.PROFILE
        far = {lang: sum(abs(p[g] - r) if g in p else size for g, r in own.items()) for lang, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k)) if own and far else None
        out.append((best or "und", 1 - far[best] / (size * len(own)) if best else 0.0))
    return out


def test_languages(spark):
    rows = [(d, t, "x" if i % 3 else None if i % 2 else "y") for i, (d, t, *_) in enumerate(odd_rows())]
    rows += [(800, "漢字 漢字 かな 漢", "z"), (801, "12 34 !?", "z"), (802, "𐐀𐐁 𐐀", "z")]
    table = docs(spark, rows)
    learn = [(lang, t) for d, t, lang in rows if crc(d, 4) != 2 and lang and t is not None]
    got = language_id.identify(table, language_id.learn(language_id.training_rows(table))).collect()
    have = sorted((r.doc_id or -1, r.lang_pred, round(r.score, 9)) for r in got)
    want = brute_languages([r[:2] for r in rows], learn)
    assert have == sorted((d or -1, lang, round(s, 9)) for (d, *_), (lang, s) in zip(rows, want, strict=True))
    nothing = language_id.identify(table, language_id.learn(language_id.training_rows(docs(spark, []))))
    assert nothing.filter("lang_pred = 'und' and score = 0").count() == len(rows)


def test_profiles_are_cut_in_every_task(spark):
    plan = language_id.learn(language_id.training_rows(docs(spark, odd_rows())))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_languages_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r for r in queries.QUERIES["op7_language_id"](spark, SF).collect() if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in got) > 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


# -- page text --------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><!-- <p>no</p> -->
<header><h1>Site</h1></header><div id="cookie-notice">We use cookies, and this notice is long enough to be taken for a paragraph.</div>
<div class="menu"><a href=x>Home</a> <a>About</a></div><div id="content"><h2>Title &amp; more</h2><p>A paragraph of
the   article, which is long enough to count as text for sure.<p>Short.</p><div class="ad-box">Buy now!</div><p>Second
<b>bold</b>ed &lt;long&gt; paragraph, with many words, <a href="y">a link</a> and more words still.</p><script>var x = "</p>";</script>
<ul><li>one<li>two</ul></div><aside>Side</aside><div id="comments"><p>A reader's comment that is very long, so that it would count
as text by its length alone.</p></div><footer>Copyright</footer><form>Name <input></form></body></html>"""


def test_page():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more",
        "A paragraph of the article, which is long enough to count as text for sure.",
        "Short.",
        "Second bolded <long> paragraph, with many words, a link and more words still.",
        "one",
        "two",
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a<p>b", "a\nb"),
        ("<nav>menu", ""),
        ("<nav>menu<article>It.</article>", "It."),
        ("<article><header><h1>T</h1></header>x<div class=ad>y</div><section class=comments><article>z</article></section></article>", "T\nx"),
        ("<article>a<br>b&nbsp;&#99;</article><p>" + "other " * 100, "a b c"),
        ("<script>never closed <p>x", ""),
        ("<p title='a > b'>x</p", "x"),
        ("1 < 2 <b>and</b> 3 > 2", "1 < 2 and 3 > 2"),
        ("<article>" + "<p>w</p>" * 20_000, "\n".join(["w"] * 20_000)),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<p>a <svg class="i"/> kept</p><p>b</p>', "a kept\nb"),
        ("<p>a <math/> kept</p><p>b</p>", "a kept\nb"),
        ("<p>a <svg><path d=x /> no</svg> kept</p>", "a kept"),
        ("<button-group>x</button-group><p>b</p>", "x\nb"),
        ("<title-bar>x</title-bar><title>no</title><p>b</p>", "x\nb"),
    ],
)
def test_raw_elements_end(page, text):
    assert html_text.main_text(page) == text


TEXT = "The main text of the page is long enough to be found by its length alone, and it has no article element around it."
CARDS = "<article>Teaser</article><article><p>Another</p></article>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div id=content><p>{TEXT}</p></div><aside class=related>{CARDS}</aside>", TEXT),
        (f"<nav>{CARDS}</nav><div id=content><p>{TEXT}</p></div><footer>{CARDS}</footer>", TEXT),
        (f"<article>{TEXT}<div class=related>{CARDS}</div>more</article>", f"{TEXT}\nmore"),
        (f"<div class=share-page><main>{TEXT}</main></div><p>Short.</p>", TEXT),  # what holds most of the text is no card
        (f"<nav>menu<article>{TEXT}</article><aside>{CARDS}</aside>", TEXT),
    ],
)
def test_cards_are_not_the_article(page, text):
    assert html_text.main_text(page) == text


def test_short_regions_stay_with_their_neighbours():
    page = f"<section><h2>Title</h2></section><section><p>{TEXT}</p></section><section><p>End.</p></section><nav>menu</nav><section>Alone.</section>"
    assert html_text.main_text(page) == f"Title\n{TEXT}\nEnd."


def test_pages_table_without_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in pages:  # the line blocks decide, and find what the article held
        assert html_text.main_text(re.sub("<(/?)article>", r"<\1div>", r.html)) == html_text.main_text(r.html)


def test_pages_table(spark):
    got = {r.page_id: r for r in queries.QUERIES["op9_html_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside).replace("<br>", " "))
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert html_text.extract(empty).count() == 0
