"""Packing, mixing and spam pages: exact conditions, brute force and edges."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelattice.llm import mixing, packing, queries, spam
from tidelattice.llm.tokens import encode, vocabulary_path

LIMITS = "container_kind string, capacity_tokens int"
SENTENCE = "The basis on the book held above the level while nobody on the desk was at the screen. "


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, key string, tokens string, container string, size int")


def test_hilbert_is_a_curve():
    """Every cell once, and each next to the one before."""
    for bits, d in ((2, 2), (2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        key = packing.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200), st.integers(2, 30))
def test_fill(sizes, ahead):
    boxes = packing.fill(sizes, 100, ahead)
    assert sorted(i for b in boxes for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in boxes)


def test_best_pair_is_the_best():
    rng = np.random.default_rng(3)
    for _ in range(200):
        w = packing.Window()
        sizes = rng.integers(1, 60, rng.integers(1, 12)).tolist()
        for i, s in enumerate(sizes):
            w.add(s, i)
        room = int(rng.integers(1, 100))
        want = max((sum(c) for k in (1, 2) for c in itertools.combinations(sizes, k) if sum(c) <= room), default=0)
        assert sum(w.sizes[p][0] for p in w.best(room)) == want


def test_pack_corpus(spark, sf_dir):
    d, limits = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/pack_limits.parquet")
    got = queries.p8_packed(spark, sf_dir).toPandas()
    texts = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    size = dict(zip(texts, map(len, encode(list(texts.values()), vocabulary_path()))))
    for kind, cap in packing.capacities(limits).items():
        g = got[got.container_kind == kind]
        assert g.groupby("doc_id").tokens.sum().to_dict() == {k: n for k, n in size.items() if n}
        assert g.groupby("container").tokens.sum().max() <= cap
        pieces = g.groupby("doc_id").size()
        assert all(pieces[k] == -(-n // cap) for k, n in size.items() if n)
    used = {r.container_kind: r.used for r in packing.fill_report(queries.p8_packed(spark, sf_dir), limits).collect()}
    assert used["short_ctx"] > 0.97


def test_pack_edges(spark):
    rows = [(1, None, "a", None, None, None, 1), (2, "", "a", None, None, None, 1), (3, "word " * 2000, "a", None, None, None, 1), (3, "word " * 2000, "a", None, None, None, 1), (None, "x", "a", None, None, None, 1), (5, "short", "a", None, None, None, 1)]
    limits = spark.createDataFrame([("small", 100), ("small", 200), ("none", None), (None, 5), ("zero", 0)], LIMITS)
    got = packing.pack(docs(spark, rows), limits).toPandas()
    assert set(got.container_kind) == {"small"} and set(got.doc_id) == {3, 5}
    assert got.groupby("container").tokens.sum().max() <= 100
    total = len(encode(["word " * 2000], vocabulary_path())[0])
    assert got[got.doc_id == 3].tokens.sum() == 2 * total
    assert packing.pack(docs(spark, []), limits).count() == 0 and packing.pack(docs(spark, rows), limits.limit(0)).count() == 0


def test_poisson_counts():
    u = (np.arange(200_000) + 0.5) / 200_000
    for mean, most in ((0.3, 1), (2.0, 3), (1.5, 50)):
        k = mixing.copies(u, np.float64(mean), np.array([most]))
        assert abs(k.mean() - mixing.expected(mean, most)) < 1e-3 and k.max() <= most
    assert abs(mixing.copies(u, np.float64(1.5), np.array([50])).var() - 1.5) < 0.01
    for rate, most in ((0.9, 1), (2.5, 4)):
        assert abs(mixing.expected(mixing.mean_for(rate, most), most) - rate) < 1e-9


def test_mix_reaches_shares(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    t = spark.createDataFrame([("submissions", 0.5, 2), ("comments", 0.3, 3), ("nowhere", 0.2, 1)], "source string, target_share double, max_repeats int")
    mixture, report = mixing.mix(d, t)
    m, r = mixture.toPandas(), {x.source: x for x in report.collect()}
    largest = m.groupby("source").tokens.max() / m.tokens.sum()
    for s, want in (("submissions", 0.625), ("comments", 0.375)):
        share = m[m.source == s].tokens.sum() / m.tokens.sum()
        assert abs(share - want) <= largest.max() and abs(share - r[s].reached_share) < 1e-9
        assert m[m.source == s].groupby("doc_id").size().max() <= {"submissions": 2, "comments": 3}[s]
    assert r["nowhere"].reached_share == 0 and set(m.source) == {"submissions", "comments"}
    assert m.place.is_monotonic_increasing and not m.duplicated(["doc_id", "source", "copy"]).any()
    again = mixing.mix(d, t)[0].toPandas()
    assert again.equals(m)


def test_mix_edges(spark):
    t = spark.createDataFrame([("a", 1.0, 1), ("a", 0.5, 2), ("b", None, 1), (None, 0.2, 1), ("c", 0.3, 0)], "source string, target_share double, max_repeats int")
    rows = [(i, "one two three", "a", None, None, None, 1) for i in range(40)] + [(99, None, "a", None, None, None, 1), (100, "x", None, None, None, None, 1), (101, "x", "c", None, None, None, 1), (None, "x", "a", None, None, None, 1)]
    mixture, report = mixing.mix(docs(spark, rows), t)
    m = mixture.toPandas()
    assert set(m.source) == {"a"} and m.groupby("doc_id").size().max() <= 2 and not set(m.doc_id) & {99, 100, 101}
    assert {r.source for r in report.collect()} == {"a", "c"}
    for empty in (mixing.mix(docs(spark, []), t), mixing.mix(docs(spark, rows), t.limit(0))):
        assert empty[0].count() == 0 and all(r.reached_share == 0 for r in empty[1].collect())


SPAM = [
    "vip group free airdrop buy now free airdrop leverage trading presale token vip group buy now crypto signals free airdrop",
    "1. Buy Now -> https://a.test/x\n2. Vip Group -> https://b.invalid/y\n3. Low Fee Swap - c.example/ref/1",
    "#free_airdrop #buynow $ABCDE #vip_group #free_airdrop $FGHIJ #trading_bot",
    "SKU: vip group 2201\nBrand: buy now 13\nColour: free airdrop 7711\nTag: passive income 4511",
    "bUy n0w fr33 a!rdrop v!p gr0up bUy n0w fr33 airdr0p pre5ale +oken buy now",
    SENTENCE + "\n\n" + "free airdrop vip group buy now " * 12,
]
PROSE = [
    SENTENCE + "In the end a friend with a small account sold a third of his position before the close, and nobody on the desk asked why. What would change if the bars came in late?",
    "As of this morning the long side has been quiet while the short side paid for it. Nobody knows when the next update is due, but we keep two alerts open at once.\n" + SENTENCE + "\nhttps://a.test/x\n#one #two",
    "hold hold hold hold hold hold\nIs it worth the trouble? I moved the check to a second machine after the window, and it was fine for a week.\n" + SENTENCE,
    "The list of the day follows, as it did before the weekend.\nABCDE -6.6%, FGHIJ +3.5%, KLMNO -6.0%, PQRST -5.3%, UVWXY +1.0%, ABCDE +2.2%, FGHIJ -0.1%, KLMNO +4.4%",
    "This is how I read it on my own machine, in case anyone wants to compare the two.\nbar = load(symbol, step)\nif bar.close > level:\n    send(bar)\nvalues = [x for x in rows]",
    "[removed]", "", None, "ok then",
]


def larger(sf_dir):
    """Curves need more pages than the smallest tables have."""
    return sf_dir.replace("sf0.001", "sf0.1")


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return spark.read.parquet(f"{larger(sf_dir)}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def weights(corpus):
    fits = spam.rank_fits(corpus)
    model = spam.language_words(fits)
    far = spam.apart(spam.figures(fits, model))
    out = {}
    for r in spam.word_weights(fits, far, model).collect():
        out.setdefault(r.language, {})[r.form] = r.weight
    return out["en"], out[None]


def share(text, weights):
    return spam.listed_share(spam.words(text), *weights)


def test_shares(weights):
    for t in SPAM:
        assert share(t, weights) > 0.5, t
    for t in PROSE:
        assert share(t or "", weights) < 0.5 or t in ("[removed]", "ok then"), t
    assert share("a-" * 20_000 + "(" * 20_000, weights) >= 0 and share("w(" * 50_000, weights) >= 0


HTML_SPAM = [
    '<a href="chartmill-bonus.test">premium index</a><br><a href="https://gridpilot.invalid/ref/3">funding rate</a><br><a href="http://feelessly.example">mark price</a>',
    "<ul>\n    <li><A HREF='https://a.test/x'>free airdrop</A></li>\n    <li><a\n href=b.invalid/y class=c>vip group</a></li>\n</ul>",
    SENTENCE + '\n<a href="https://a.test/x">buy now</a> ' + '<a href="c.example/ref/1">vip group</a> ' * 5,
    "<p>vip group</p><p>free airdrop</p><b>buy now</b> <i>leverage trading</i><br/>presale token",
]
HTML_PROSE = [
    "<p>" + SENTENCE.replace("book", '<a href="https://a.test/x">book</a>') + "After the last period the archive came back to where it was, which surprised nobody.</p>",
    "<div class='c'>Wait for the bar to close before you read the feed. " + SENTENCE + "<br></div>",
    "Close it by hand if the job does not come back in time.\nif a <b and c> d:\n    send(bar)\nx = y[0]",
]


def test_shares_of_markup(weights):
    for t in HTML_SPAM:
        assert share(t, weights) > 0.5, t
    for t in HTML_PROSE:
        assert share(t, weights) < 0.2, t
    assert "link" not in {k for k, *_ in spam.words(HTML_PROSE[2])} and "b" in {f for _, f, *_ in spam.words(HTML_PROSE[2])}
    assert share("<a " + "=" * 50_000 + "<a" + " " * 50_000 + "<br" * 20_000, weights) >= 0


#: Plain prose in languages of which the corpus has no page.
FOREIGN = [
    "Вчера вечером мы долго обсуждали новый отчёт, но никто так и не понял, почему рынок вдруг остановился. Утром я снова проверил таблицы и нашёл две ошибки, о которых раньше никто не говорил. Если всё будет спокойно, мы закончим работу до пятницы и отправим письмо в банк.",
    "Ieri sera abbiamo parlato a lungo del nuovo rapporto, ma nessuno ha capito perché il mercato si fosse fermato all'improvviso. Stamattina ho controllato di nuovo le tabelle e ho trovato due errori di cui prima non aveva parlato nessuno. Se tutto resta tranquillo, finiremo il lavoro entro venerdì.",
    "Wczoraj wieczorem długo rozmawialiśmy o nowym raporcie, ale nikt nie zrozumiał, dlaczego rynek nagle się zatrzymał. Rano jeszcze raz sprawdziłem tabele i znalazłem dwa błędy, o których wcześniej nikt nie mówił. Jeśli wszystko będzie spokojne, skończymy pracę przed piątkiem i wyślemy list do banku.",
]


def found(docs):
    got = [r.doc_id for r in spam.spam_pages(docs).select("doc_id").collect()]
    assert len(got) == len(set(got))
    return set(got)


def extra(spark, *groups):
    return spark.createDataFrame([(10**6 * (k + 1) + i, t, None) for k, g in enumerate(groups) for i, t in enumerate(g)] + [(None, SPAM[0], None)], "doc_id long, text string, lang string")


def test_pages(spark, corpus):
    """Lists are found; prose, also of languages without pages, and what the corpus had are not moved."""
    alone = found(corpus)
    every = corpus.unionByName(extra(spark, SPAM + HTML_SPAM, PROSE + HTML_PROSE, FOREIGN)).withColumns({"language": F.lit(1), "same": F.lit(2), "share": F.lit("x"), "label": F.lit("y")})
    got = found(every)
    assert {g for g in got if g >= 10**6} == {10**6 + i for i in range(len(SPAM + HTML_SPAM))}
    assert {g for g in got if g < 10**6} == alone and 300 < len(alone) < 600


def test_repeated_words_of_no_known_language(spark, corpus):
    text = "купить монеты быстро " * 30
    assert found(corpus.unionByName(spark.createDataFrame([(10**6, text, "ru")], "doc_id long, text string, lang string"))) - found(corpus) == {10**6}


def test_figures_by_plain_python(corpus):
    """Languages, curves, divergences and distances of the corpus, by counting and sorting."""
    rows = {}
    for r in corpus.collect():
        if r.text is not None and r.text.strip() not in spam.GONE:
            label = (r.lang or "").strip().lower()
            t = rows.setdefault(r.text, [[], None])
            t[0].append(r.doc_id)
            if label not in ("", "und"):
                t[1] = min(t[1] or label, label)
    words = {t: [spam.LINK if "." in w or "://" in w else spam.TAG if w[0] in "#$" else w for w in spam._FORM.findall(spam._MARK.sub(" ", spam._MARKED.sub(" http://- ", spam._HIDDEN.sub("", t).lower())))] for t in rows}
    pages = {t: (ids, label, Counter(words[t])) for t, (ids, label) in rows.items() if words[t]}
    labels = {k for k, n in Counter(label for _, label, _ in pages.values()).items() if k and n >= spam.ENOUGH}
    seen = {k: Counter(w for _, label, c in pages.values() if label == k for w in c) for k in labels}
    count = {k: sum(label == k for _, label, _ in pages.values()) for k in labels}
    assert len(labels) == 4 and max(map(len, seen.values())) < spam.COMMON
    plain = []
    for t, (ids, label, c) in pages.items():
        score = {k: sum(n * np.log(seen[k][w] / seen[k].total() / spam.UNSEEN) for w, n in c.items() if w not in (spam.LINK, spam.TAG) and w in seen[k]) + np.log(count[k]) + spam.LABEL * (label == k) for k in labels}
        k = max(labels, key=lambda x: (score[x], x))
        n = c.total()
        divergence = sum(m / n * np.log(m / n * seen[k].total() / max(seen[k][w], 1)) for w, m in c.items())
        y = np.log(sorted(c.values(), reverse=True))
        x = np.log([sum(v >= u for v in c.values()) for u in sorted(c.values(), reverse=True)])
        slope = np.polyfit(x, y, 1)[0] if len(set(c.values())) > 1 else 0.0
        residual = np.sqrt(np.mean((y - y.mean() - slope * (x - x.mean())) ** 2))
        plain += [(i, k, int(2 * np.log2(len(t))), slope, residual, divergence) for i in ids]
    got = {r.doc_id: r for r in spam.page_figures(corpus).collect()}
    assert set(got) == {p[0] for p in plain}
    for i, k, _, *figures in plain:
        assert got[i].language == k and [got[i][c] for c in spam.NAMES] == pytest.approx(figures, abs=1e-9), i
    once = {min(ids) for ids, _, _ in pages.values()}
    groups = defaultdict(list)
    for p in plain:
        if p[0] in once:
            groups[p[1], p[2]].append(p)
    for i, k, length, *figures in plain:
        group = groups[k, length]
        if len(group) >= spam.ENOUGH:
            for c, v, j in zip(spam.NAMES, figures, (3, 4, 5)):
                low, mid, high = (sorted(p[j] for p in group)[int(np.ceil(q * len(group))) - 1] for q in (0.25, 0.5, 0.75))
                assert got[i][f"away_{c}"] == pytest.approx((v - mid) / max((high - low) / 2 * 1.4826, 0.01), abs=1e-6)


def test_copies_of_a_list(spark, corpus):
    """A short tag list in half as many copies as there are other pages is found, and moves no figure of theirs."""
    n = corpus.count()
    lists = ["#vip #airdrop #presale #token #mining #bonus #casino #jackpot", "airdrop presale token mining bonus casino jackpot lottery voucher", "vip group token presale signals miner wallet payout lottery cash bonus swap"]
    copies = lambda text: spark.range(10**6, 10**6 + n // 2).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"))
    for text in lists:
        assert found(corpus.unionByName(copies(text))) >= set(range(10**6, 10**6 + n // 2)), text
    prose = copies(SENTENCE * 2)
    one, many = ({r.doc_id: r for r in spam.page_figures(corpus.unionByName(x)).collect()} for x in (prose.limit(1), prose))
    assert all(many[k].away_divergence == pytest.approx(r.away_divergence) and many[k].divergence == pytest.approx(r.divergence) for k, r in one.items())


def test_rank_fit(spark):
    """The windows' fit is numpy's, whatever the order of the words; without labels all pages are one language."""
    text = " ".join(w for n, w in enumerate("the of and to in is was".split(), 1) for _ in range(40 // n))
    r = spam.page_figures(spark.createDataFrame([(1, text), (2, " ".join(reversed(text.split()))), (2, text)], "doc_id long, text string")).collect()
    x, y = np.log(np.arange(1, 8)), np.log([40 // n for n in range(1, 8)])
    slope, cut = np.polyfit(x, y, 1)
    assert sorted(a.doc_id for a in r) == [1, 2, 2]
    for a in r:
        assert a.language == "" and a.slope == pytest.approx(slope) and a.residual == pytest.approx(np.sqrt(((y - slope * x - cut) ** 2).mean()))


def test_commonest_words_and_the_rest(spark, monkeypatch):
    """Words beyond the commonest share evenly what they have together."""
    monkeypatch.setattr(spam, "COMMON", 2)
    d = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, "a")], "doc_id long, text string")
    got = {r.form: (r.q, r.other) for r in spam.language_words(spam.rank_fits(d)).collect()}
    assert got == {"a": (3 / 7, 1 / 7), "b": (2 / 7, 1 / 7)}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries_give_rows(name, spark, sf_dir):
    df = queries.QUERIES[name](spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns) and df.count() > 0


def test_pages_empty(spark):
    none = "doc_id long, text string, lang string"
    assert spam.spam_pages(spark.createDataFrame([], none)).count() == 0
    assert spam.spam_pages(spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "[removed]", "en"), (4, "...", None), (None, "a b", "en")], none)).count() == 0
