"""Pages made of keywords, link lists or tag lists instead of sentences.

Rank-frequency curves: each page's words are ranked by their counts in a SQL window and log count is fitted on log rank. Prose of one language and
length has much the same slope, residual and divergence from that language's words, whatever its subject; pages of strung-together keywords
don't. Languages and their words come from the corpus, no list of words is given. Each figure is set against the median of all pages of the same
language and a comparable length, in units of their usual distance from it; a page that is extreme in one of them stands out.

Pages that are partly prose are judged by the same divergence at the scale of a few words: what the pages that stand out widely use more than
those that don't, word by word (`word_weights`), says for each stretch of a page whether it diverges from prose. More than half of a page's text must.
So the curves decide twice: which pages are looked at, and what their words are measured by.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidelattice.session import cut, lookup, spread, stored

#: Letters that are written with another sign to hide a word.
DISGUISES = {"@": "a", "0": "o", "3": "e", "1": "i", "!": "i", "5": "s", "+": "t", "7": "t", "$": "s", "4": "a"}
_DISGUISE = str.maketrans(DISGUISES)
#: What stands for a text that was taken away.
GONE = frozenset({"[removed]", "[deleted]"})

#: Names of markup tags that end a line, and the others.
BREAKS = "article aside blockquote br center dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul"
TAGS = BREAKS + " a abbr area b base big body button cite code del em embed font head html i iframe img input ins kbd label link mark meta noscript object option q s select small source span strike strong sub summary sup title tt u var video"

_MARK = re.compile(r"</?(?:%s)(?:\s+[\w:\-]+\s*=[^<>]*|\s*/?)>" % "|".join(TAGS.split()), re.I)
_ADDRESS = re.compile(r"""[\s"'](?:href|src)\s*=\s*["']?([^\s"'>]+)""", re.I)
_BREAK = re.compile(r"</?(?:%s)\b" % "|".join(BREAKS.split()), re.I)
#: Signs without width that hide a word.
HIDDEN = (0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF, 0xAD)
_HIDDEN = re.compile("[" + "".join(map(chr, HIDDEN)) + "]")
#: Endings by which a name without a path is an address.
ENDINGS = "com org net io info biz co test example invalid"
_TOKEN = re.compile(r"(?i:(?P<mark>" + _MARK.pattern + r"))|(?P<link>(?:https?|hxxps?)://\S+|\b(?:h\s?t\s?t\s?p\s?s?\s?:\s?/\s?/\s?)\S+|\b\w[\w\-]{0,62}(?:\.[\w\-]{1,63}){0,6}\.[a-z]{2,24}/\S*|\b\w[\w\-]{0,62}\.(?:" + "|".join(ENDINGS.split()) + r")\b)|(?P<tag>[#$][^\W\d]\w*)|(?P<number>[+\-−]?\d[\d.,:]*%?(?!\w))|(?P<word>[^\W_][\w@!+$'’]*)", re.U)
_STOP = re.compile(r"[\"'’”»)\]]*[.!?…][\"'’”»)\]]*\s")
_CODE = re.compile(r"^(?:\s{4,}|```|>>>|\$ |#!|//)|[{};]\s*$|\w\s*=\s*\w+[\[(.]|^\s*(?:def|class|import|from|return|for|if|while|select|insert|curl|pip)\b.*[(:;=]|=>|==", re.I)
_CALL = re.compile(r"\w\(")

#: Words on either side that belong to a stretch.
SPAN = 7
#: One word so many times in a row within a line, from four on, is a cry rather than a keyword list.
CRY = 16
#: Usual distances from comparable pages from which a page stands out, and from which its divergence leaves no doubt that most of it is no prose.
APART, SURE = 4.0, 6.0
#: Pages that make a median, and pages of a label that make a language.
ENOUGH = 20
#: Most labels that make a language: the commonest. Pages under others are compared with the language that is likeliest for their words.
LANGUAGES = 100
#: Words of a language that are told apart; the others share what they have together evenly.
COMMON = 4096
#: Share of a word that a language doesn't have, when the language of a page is chosen; and what the page's own label weighs there.
UNSEEN, LABEL = 1.0 / (COMMON * 64), 3.0
#: Words that the average of all languages weighs in a word's rates, and most that one word weighs.
PRIOR, MOST = 2.0, 4.0
#: How often the pages that stand out by their subject only are left out of what listed words are.
ROUNDS = 1
#: Average weight below which a stretch is none of prose, and what a word that comes again nearby weighs besides its own.
LISTED, REPEAT = -0.5, -1.0
#: A label that names no language.
UNKNOWN = "und"
#: What all links and all tags count as.
LINK, TAG = "<link>", "<tag>"


def words(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, form, size, sentence) of the pieces of a text: link, tag, number, word, or code for those of code lines. A piece's size reaches to the next one. A name with its change in percent is a number.

    A markup tag with an address is one link; any other is no piece but counts to the one before, and ends the line where it breaks it.
    """
    out: list[tuple[str, str, int, int]] = []
    sentence = 0
    text = _MARK.sub(lambda m: " ".join(m.group().split()), _HIDDEN.sub("", text))
    for line in text.splitlines():
        bare = _MARK.sub(" ", line)
        plain = line if bare == line else bare.strip()
        code = "://" not in line and bool(_CODE.search(plain) or plain.rstrip().endswith(")") and _CALL.search(plain))
        found = list(_TOKEN.finditer(line))
        begin = len(out)
        for i, m in enumerate(found):
            kind, form = m.lastgroup, m.group()
            after = found[i + 1] if i + 1 < len(found) else None
            size = (after.start() if after else len(line) + 1) - m.start()
            if kind == "mark":
                address = _ADDRESS.search(form)
                if not address:
                    if len(out) > begin:
                        out[-1] = (*out[-1][:2], out[-1][2] + size, out[-1][3])
                    sentence += bool(_BREAK.match(form))
                    continue
                kind, form = "link", address[1]
            if code and kind != "link":
                kind = "code"
            elif kind == "word":
                if after and after.lastgroup == "number" and form.isupper() and after.group()[-1] == "%":
                    kind = "number"
                form = form.lower()
                if any(c in DISGUISES for c in form):
                    plain = form.rstrip("!+$'’").translate(_DISGUISE)
                    form = plain if any(c.isalpha() for c in form) else form
            out.append((kind, form, size, sentence))
            sentence += bool(after and _STOP.match(line, m.end()))
        sentence += 1
    return out


def listed_share(pieces: list[tuple[str, str, int, int]], *weights: dict[str, float]) -> float:
    """Share of a text's size in words, tags and links whose stretch diverges from prose. Figures, code and cries are text, but none of these.

    A stretch are up to SPAN pieces on either side within the sentence or line; it is of prose if it is so by any of `weights`. Words that come again within two spans weigh less. A number goes with what
    is around it, except in sentences or lines of which numbers make half: those are figures.
    """
    p = pieces
    if not p:
        return 0.0
    n = len(p)
    kind = np.array([x[0] for x in p])
    size = np.array([x[2] for x in p], float)
    sentence = np.array([x[3] for x in p])
    form = [LINK if k == "link" else TAG if k == "tag" else f for k, f, _, _ in p]
    word = np.isin(kind, ["word", "link", "tag"])
    again = np.zeros(n, bool)
    last_at: dict[str, int] = {}
    for i, f in enumerate(form):
        j = last_at.get(f)
        if j is not None and i - j <= 2 * SPAN:
            again[i] = again[j] = True
        last_at[f] = i
    cry = np.zeros(n, bool)
    i = 0
    while i < n:
        j = i
        while j < n and p[j][:2] == p[i][:2] and p[j][3] == p[i][3]:
            j += 1
        cry[i:j] = p[i][0] == "word" and 4 <= j - i <= CRY
        i = j
    first, last = np.searchsorted(sentence, sentence), np.searchsorted(sentence, sentence, side="right")
    at = np.arange(n)
    a, b = np.maximum(at - SPAN, first), np.minimum(at + SPAN + 1, last)
    sums = lambda x: np.concatenate([[0.0], np.cumsum(x)])
    count, numbers = sums(word), sums(kind == "number")
    figures = (last - first) <= 2 * (numbers[last] - numbers[first])
    prose = np.zeros(n, bool)
    for w in weights:
        each = np.array([w.get(f, w.get(re.split("['’]", f)[0], 0.0)) for f in form])
        s = sums(np.where(word, each + np.where(again, REPEAT, 0.0), np.where(kind == "code", MOST, 0.0)))
        prose |= s[b] - s[a] >= LISTED * (count[b] - count[a])
    listed = ~prose & (kind != "code") & ~cry & ~figures
    return float(size[listed].sum() / size.sum())


_MARKED = re.compile(r"<(?:%s)\s[^<>]*\b(?:href|src)\s*=[^<>]*>" % "|".join(TAGS.split()))
_FORM = re.compile(r"(?:https?|hxxps?)://\S+|[^\W_][\w-]*(?:\.[\w-]+)*\.(?:[a-z]{2,24}/\S*|(?:%s)\b)|[#$][^\W\d]\w*|[^\W\d_]+(?:['’][^\W\d_]+)*" % "|".join(ENDINGS.split()))


def forms(token: str) -> tuple[str, ...]:
    """The words in a piece of text without blanks; every link and every tag is one form."""
    return tuple(LINK if "." in w or "://" in w else TAG if w[0] in "#$" else w for w in _FORM.findall(token))


def count_forms(text: str, known: dict[str, tuple[str, ...]]) -> dict[str, int]:
    """How often each word occurs in a text, in lower case, what hides words taken out. No word spans a blank, so each different piece between blanks is cut up once; `known` remembers them."""
    t = (text if text.isascii() else _HIDDEN.sub("", text)).lower()
    if "<" in t:
        t = _MARK.sub(" ", _MARKED.sub(" http://- ", t))
    out: dict[str, int] = {}
    for token, n in Counter(t.split()).items():
        found = known.get(token)
        if found is None:
            found = known[token] = forms(token)
        for w in found:
            out[w] = out.get(w, 0) + n
    return out


#: Pieces of text that a worker remembers.
REMEMBERED = 200_000


def _counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """form and n of the words of each text; and its different counts with how many words have each."""
    known: dict[str, tuple[str, ...]] = {}
    for texts in batches:
        if len(known) > REMEMBERED:
            known.clear()
        pages = [count_forms(t, known) for t in texts]
        ties = [Counter(p.values()) for p in pages]
        yield pd.DataFrame({"form": [list(p) for p in pages], "n": [list(p.values()) for p in pages], "count": [list(t) for t in ties], "ties": [list(t.values()) for t in ties]})


def _pages(docs: DataFrame) -> DataFrame:
    """doc_id, text, same (what equal texts share) and label of the rows that have a text."""
    label = F.lower(F.trim("lang")) if "lang" in docs.columns else F.lit(None).cast("string")
    label = F.when((label != UNKNOWN) & (label != ""), label)
    rows = docs.select("doc_id", "text", label.alias("label")).filter("doc_id is not null and text is not null").filter(~F.trim("text").isin(*GONE))
    return rows.withColumn("same", F.unhex(F.md5("text")))


def rank_fits(docs: DataFrame) -> DataFrame:
    """One row for each different text: same, label, chars, size (words), slope, residual and entropy of its rank-frequency curve, and words (form and n, two arrays).

    A word's rank is how many words are at least as common, so words of one count share a rank, and the window runs over counts, not words. The fit of log count
    on log rank weighs every word alike. A text is counted once however many rows have it, so copies weigh nothing; of each, a task passes on one.
    The one exchange is that of the counted words; ranks and fits of a text need no further one.
    """
    count = F.pandas_udf(_counts, "form array<string>, n array<int>, count array<int>, ties array<int>").asNondeterministic()
    counted = spread(_pages(docs)).select("same", "label", F.length("text").alias("chars"), count("text").alias("words"))
    pages = counted.groupBy("same").agg(F.min("label").alias("label"), F.first("chars").alias("chars"), F.first("words").alias("words"))
    # one row a count; the words themselves stay with the first
    each = pages.select("same", "label", "chars", "words", F.posexplode_outer("words.count").alias("pos", "n")).filter("n is not null")
    page = F.struct("label", "chars", F.col("words.form").alias("form"), F.col("words.n").alias("n"))
    each = each.select("same", "n", F.get("words.ties", F.col("pos")).alias("m"), F.when(F.col("pos") == 0, page).alias("page"))
    ranked = each.withColumn("rank", F.sum("m").over(Window.partitionBy("same").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)))
    m, x, y = F.col("m"), F.ln("rank"), F.ln("n")
    sums = {"k": m, "size": m * F.col("n"), "x": m * x, "y": m * y, "xx": m * x * x, "xy": m * x * y, "yy": m * y * y, "n_ln_n": m * F.col("n") * y}
    fit = ranked.groupBy("same").agg(*[F.sum(v).alias(c) for c, v in sums.items()], F.first("page", ignorenulls=True).alias("page"))
    spread_of = lambda a, b: F.col(a + b) - F.col(a) * F.col(b) / F.col("k")
    # what sums of like numbers differ by is rounding: below that there is no spread
    slope = F.when(spread_of("x", "x") > 1e-9, spread_of("x", "y") / spread_of("x", "x")).otherwise(0.0)
    rest = (spread_of("y", "y") - slope * spread_of("x", "y")) / F.col("k")
    residual = F.sqrt(F.when(rest > 1e-12, rest).otherwise(0.0))
    return fit.select("same", "page.label", "page.chars", "size", slope.alias("slope"), residual.alias("residual"), (F.col("n_ln_n") / F.col("size") - F.ln("size")).alias("entropy"), F.struct("page.form", "page.n").alias("words"))


def _each_word(fits: DataFrame, *columns: str) -> DataFrame:
    """`columns`, form and n of every word of every page."""
    each = fits.select(*columns, F.col("words.n").alias("counts"), F.posexplode_outer("words.form").alias("pos", "form")).filter("form is not null")
    return each.select(*columns, "form", F.get("counts", F.col("pos")).alias("n"))


def language_words(fits: DataFrame) -> DataFrame:
    """(language, form, q, share, pages, other): the share q of the COMMON commonest words of each language among all words of its pages, each page counting a word once; its shares
    of the pages it is on, added up; how many pages the language has; and the share of a word outside them, which is what these have together, evenly.

    A language is a label with ENOUGH pages; where there is none, all pages are one language.
    """
    spark = fits.sparkSession
    by_label = fits.groupBy("label").agg(F.count("*").alias("pages"))
    labels = [(r.label, r.pages) for r in by_label.filter("label is not null").filter(F.col("pages") >= ENOUGH).orderBy(F.desc("pages"), "label").limit(LANGUAGES).collect()]
    if not labels:
        labels, fits = [("", by_label.agg(F.sum("pages")).first()[0] or 0)], fits.withColumn("label", F.lit(""))
    labels = spark.createDataFrame(labels, "label string, pages long")
    words = _each_word(fits.join(F.broadcast(labels), "label"), "label", "pages", "size")
    seen = cut(words.groupBy(F.col("label").alias("language"), "form").agg(F.count("*").alias("n"), F.sum(F.col("n") / F.col("size")).alias("share"), F.first("pages").alias("pages")))
    # the commonest words of each of 64 parts of a language first, so no task ranks all its words
    part = seen.withColumn("part", F.pmod(F.xxhash64("form"), F.lit(64)))
    order = [F.desc("n"), "form"]
    for by in (("language", "part"), ("language",)):
        part = part.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("nth") <= COMMON)
    total = seen.groupBy("language").agg(F.sum("n").alias("all_n"), F.count("*").alias("all_k"))
    top = cut(part.select("language", "form", "n", "share", "pages"))
    within = top.groupBy("language").agg(F.sum("n").alias("top_n"), F.count("*").alias("top_k")).join(total, "language")
    other = F.when(F.col("all_k") > F.col("top_k"), (F.col("all_n") - F.col("top_n")) / (F.col("all_k") - F.col("top_k"))).otherwise(1.0) / F.col("all_n")
    return cut(top.join(F.broadcast(within), "language").select("language", "form", (F.col("n") / F.col("all_n")).alias("q"), "share", "pages", other.alias("other")))


def figures(fits: DataFrame, model: DataFrame) -> DataFrame:
    """(same, language, chars, size, slope, residual, divergence): the language whose words make a page likeliest, and the divergence from them. A page without a word of any language is set against the largest."""
    by_form = model.groupBy("form").agg(F.collect_list(F.struct("language", (F.ln("q") - F.lit(float(np.log(UNSEEN)))).alias("gain"), (F.ln("q") - F.ln("other")).alias("own"))).alias("in"))
    hits = _each_word(fits, "same").join(F.broadcast(by_form), "form").select("same", "n", F.when(F.col("form").isin(LINK, TAG), 0).otherwise(F.col("n")).alias("m"), F.explode("in").alias("l"))
    each = hits.groupBy("same", F.col("l.language").alias("language")).agg(F.sum(F.col("m") * F.col("l.gain")).alias("gain"), F.sum(F.col("n") * F.col("l.own")).alias("own"))
    languages = model.groupBy("language").agg(F.first("pages").alias("pages"), F.first("other").alias("other"))
    largest = languages.orderBy(F.desc("pages"), "language").first()
    each = each.join(F.broadcast(languages), "language")
    found = each.groupBy("same").agg(F.collect_list(F.struct(F.col("gain") + F.ln("pages"), "language", "own", "other")).alias("of"))
    page = fits.select("same", "label", "chars", "size", "slope", "residual", "entropy").join(found, "same", "left")
    scored = F.transform("of", lambda x: F.struct((x["col1"] + F.when(x["language"] == F.col("label"), LABEL).otherwise(0.0)).alias("score"), x["language"].alias("language"), x["own"].alias("own"), x["other"].alias("other")))
    page = page.withColumn("best", F.array_max(scored))
    other, name = (largest["other"], largest["language"]) if largest else (1.0, "")
    divergence = F.col("entropy") - F.ln(F.coalesce("best.other", F.lit(other))) - F.coalesce(F.col("best.own") / F.col("size"), F.lit(0.0))
    return page.select("same", F.coalesce("best.language", F.lit(name)).alias("language"), "chars", "size", "slope", "residual", divergence.alias("divergence"))


NAMES = ["slope", "residual", "divergence"]


def apart(f: DataFrame) -> DataFrame:
    """`f` with away_<figure>: the distance from the median of the pages of the same language and a comparable length, in usual distances.

    Lengths are comparable within half an octave of characters. Where fewer than ENOUGH pages of the language are, those of all languages stand in, then those of two octaves.
    """
    f = f.withColumn("length", F.floor(2 * F.log2("chars")).cast("int")).withColumn("octaves", F.floor(F.col("length") / 4).cast("int"))
    quartiles = [F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(c) for c in NAMES]
    groups = (["language", "length"], ["length"], ["language", "octaves"], ["octaves"])
    rows = f
    for k, group in enumerate(groups):
        mid = rows.groupBy(*group).agg(*quartiles, F.count("*").alias(f"n{k}")).withColumnsRenamed({c: f"q{k}_{c}" for c in NAMES})
        f = f.join(F.broadcast(mid), group, "left")  # at most a row for each of LANGUAGES languages and 62 lengths
    out = []
    for c in NAMES:
        q = F.coalesce(*[F.when(F.col(f"n{k}") >= ENOUGH, F.col(f"q{k}_{c}")) for k in range(len(groups))], F.col(f"q{len(groups) - 1}_{c}"))
        # half the middle half's width is the usual distance; a hundredth keeps it above zero
        out.append(((F.col(c) - F.get(q, F.lit(1))) / F.greatest((F.get(q, F.lit(2)) - F.get(q, F.lit(0))) / 2 * 1.4826, F.lit(0.01))).alias(f"away_{c}"))
    return f.select(*rows.drop("length", "octaves").columns, *out)


def stands_out() -> Column:
    return (F.abs("away_slope") >= APART) | (F.abs("away_residual") >= APART) | (F.col("away_divergence") >= APART)


def word_weights(fits: DataFrame, far: DataFrame, model: DataFrame) -> DataFrame:
    """(language, form, weight): logarithm of how much commoner a word is on the other pages than on those that widely stand out, in a language and, under the language null, in all.

    Prose on a subject of its own stands out widely too, but its words are those of prose: ROUNDS times the pages that the weights take for prose are left out, and the rest is weighed anew.
    """
    sure = lookup(cut(far.filter(F.col("away_divergence") >= SURE).select("same", "language")))
    known = F.broadcast(model.select("form").distinct())  # like all that follows from the model, at most COMMON * LANGUAGES rows
    words = _each_word(fits.join(sure, "same"), "same", "label", "language", "size").join(known, "form")
    listed = stored(words.select("same", "label", "language", "form", (F.col("n") / F.col("size")).alias("share")), "listed")
    whole = model.select("language", "form", F.col("share").alias("prose"))

    def weigh(listed: DataFrame) -> DataFrame:
        # what the listed pages have is taken out of the language of their label, in which it was counted
        had = listed.groupBy(F.coalesce("label", F.lit("")).alias("language"), "form").agg(F.sum("share").alias("had"))
        prose = whole.join(had, ["language", "form"], "left").select("language", "form", F.greatest(F.col("prose") - F.coalesce("had", F.lit(0.0)), F.lit(0.0)).alias("prose"))
        rates = listed.groupBy("language", "form").agg(F.sum("share").alias("list"))
        both = prose.join(rates, ["language", "form"], "full").fillna(0.0, ["list", "prose"])
        everywhere = both.groupBy("form").agg(F.sum("list").alias("list"), F.sum("prose").alias("prose"))
        both = cut(both.unionByName(everywhere.withColumn("language", F.lit(None).cast("string"))))
        sums = {r.language: (r.list or 0.0, r.prose or 0.0) for r in both.groupBy("language").agg(F.sum("list").alias("list"), F.sum("prose").alias("prose")).collect()}  # a row a language
        total = sum(sums.get(None, (0.0, 0.0))) or 1.0
        of = both.sparkSession.createDataFrame([(k, *v) for k, v in sums.items()], "language string, n_list double, n_prose double")
        prior = both.filter("language is null").select("form", ((F.col("list") + F.col("prose")) * (PRIOR / total)).alias("prior"))
        joined = both.alias("a").join(F.broadcast(of).alias("t"), F.equal_null("a.language", "t.language")).join(F.broadcast(prior), "form")
        rate = lambda c: (F.col(c) + F.col("prior")) / (F.col(f"n_{c}") + PRIOR)
        return cut(joined.select("a.language", "form", F.greatest(F.least(F.ln(rate("prose") / rate("list")), F.lit(MOST)), F.lit(-MOST)).alias("weight")))

    for _ in range(ROUNDS):
        of_page = listed.join(F.broadcast(weigh(listed).filter("language is not null")), ["language", "form"]).groupBy("same").agg(F.sum(F.col("share") * F.col("weight")).alias("weight"))
        listed = listed.join(lookup(cut(of_page.filter(F.col("weight") < 0).select("same"))), "same", "left_semi")
    return weigh(listed)


def spam_pages(docs: DataFrame) -> DataFrame:
    """(doc_id, share, language, slope, residual, divergence) of the pages more than half of whose text is keywords, links or tags instead of sentences.

    docs: doc_id, text and, if there is one, lang: a label of the language that may be null or wrong. Null, empty and removed texts and rows without doc_id are none. Rows that
    repeat a doc_id or a text are judged alike and each returned. A page in a language of which the corpus has too few pages stands out, but its words weigh nothing, so only
    what is repeated nearby, its links and its tags count as listed. An empty table gives an empty result; further columns are ignored.
    """
    fits = stored(rank_fits(docs), "pages")
    model = language_words(fits)
    far = cut(apart(cut(figures(fits, model))))
    weights: dict[str | None, dict[str, float]] = {}
    for r in word_weights(fits, far, model).toLocalIterator():  # at most COMMON words a language, LANGUAGES of them
        weights.setdefault(r.language, {})[r.form] = r.weight
    known = docs.sparkSession.sparkContext.broadcast(weights)

    def share(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = known.value
        for text, language in parts:
            done: dict[tuple[str, str], float] = {}  # copies of a text in a batch are read once
            for pair in zip(text, language):
                if pair not in done:
                    done[pair] = listed_share(words(pair[0]), w.get(pair[1], {}), w.get(None, {}))
            yield pd.Series([done[x] for x in zip(text, language)], dtype=float)

    looked_at = far.filter(stands_out()).select("same", "language", "slope", "residual", "divergence")
    rows = _pages(docs).select("doc_id", "text", "same").join(lookup(looked_at), "same")
    judged = rows.withColumn("share", F.pandas_udf(share, DoubleType()).asNondeterministic()("text", "language"))
    return judged.filter(F.col("share") > 0.5).select("doc_id", "share", "language", "slope", "residual", "divergence")


def page_figures(docs: DataFrame) -> DataFrame:
    """(doc_id, language, chars, size, slope, residual, divergence, away_slope, away_residual, away_divergence) of every page with a word."""
    fits = stored(rank_fits(docs), "pages")
    far = cut(apart(cut(figures(fits, language_words(fits)))))
    return _pages(docs).select("doc_id", "same").join(lookup(far), "same").drop("same")
