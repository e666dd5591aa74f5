"""Texts of submissions and comments: cleaning, words, moods per period, bots, ensembles and the watchlist."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.functions.normalize import epoch_ms
from tidelattice.operators.bars import bucket

#: Words that carry no subject.
STOPWORDS = "a an and are as at be but by for from if in into is it no not of on or such that the their then there these they this to was will with".split()
#: Further words left out of the counts.
MORE_STOPWORDS = "able actual already also another anyone anything around could don even every get got https http many much now one really see since someone something thing things use utm way will would x200b xpost rbitcoin im i'm ive i've dont don't isnt isn't thats that's theres there's youre you're".split()
#: Words of two letters that count.
SHORT_WORDS = ["ai", "us", "uk", "eu"]
#: Weights of the classes (negative, neutral, positive) of the two models of the ensemble.
ENSEMBLE = ((0.58, 0.60, 0.38), (0.42, 0.40, 0.62))
#: Fixed values of the activity rule: decay an hour, score from which a thread is active, longest span in hours, days until an inactive one is dropped.
DECAY, ACTIVE, SPAN_HOURS, KEEP_DAYS = 0.075, 0.55, 168, 30


def tokens(text: Column | str) -> Column:
    """Words of a text: lower case, without links, punctuation, symbols, stopwords, numbers and most short words."""
    x = F.lower(F.col(text) if isinstance(text, str) else text)
    x = F.regexp_replace(x, r"https?://\S+|www\.\S+", " ")
    x = F.translate(x, "’‘​", "'' ")
    x = F.regexp_replace(x, r"[\p{P}\p{S}&&[^']]", " ")
    words = F.transform(F.split(x, r"\s+"), lambda t: F.regexp_replace(t, r"^'+|'+$", ""))
    out = F.array(*[F.lit(w) for w in sorted({*STOPWORDS, *MORE_STOPWORDS})])
    two = F.array(*[F.lit(w) for w in SHORT_WORDS])
    return F.filter(words, lambda t: (F.length(t) > 1) & ~F.array_contains(out, t) & ~t.rlike(r"^\p{Nd}+$") & ((F.length(t) > 2) | F.array_contains(two, t)))


def moods() -> list[Column]:
    """Aggregates over sentiment 0 negative, 1 neutral, 2 positive."""
    s = F.col("sentiment")
    n, neg, neu, pos = F.count("*"), F.count_if(s == 0), F.count_if(s == 1), F.count_if(s == 2)
    return [n.alias("count"), ((pos - neg) / n).alias("score"), ((pos + neg) / n).alias("confidence"), (neg / n).alias("pct_negative"), (pos / n).alias("pct_positive"), (neu / n).alias("pct_neutral")]


def social_rows(df: DataFrame, source: str, text: Column) -> DataFrame:
    """(source, t, sentiment, text) of rows with a sentiment and a time."""
    s = F.nullif(F.trim(F.col("sentiment").cast("string")), F.lit("")).try_cast("int")
    return df.select(F.lit(source).alias("source"), epoch_ms("created_utc").alias("t"), s.alias("sentiment"), F.coalesce(text, F.lit("")).alias("text")).dropna(subset=["t", "sentiment"])


def mood_features(rows: DataFrame, step: int, key: list[str] = ()) -> DataFrame:
    """Moods per period [b - step, b), labelled by its end."""
    return rows.groupBy(*key, bucket("t", step, "end").alias("create_time")).agg(*moods())


def top_words(rows: DataFrame, step: int, most: int = 100, least: int = 2) -> DataFrame:
    """(create_time, word, n) of the most frequent words of each period that occur at least twice; ties by the word."""
    each = rows.select(bucket("t", step, "end").alias("create_time"), F.explode(tokens("text")).alias("word"))
    n = each.groupBy("create_time", "word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    w = Window.partitionBy("create_time").orderBy(F.desc("n"), "word")
    return n.withColumn("rank_", F.row_number().over(w)).filter(F.col("rank_") <= most).drop("rank_")


def word_maps(words: DataFrame) -> DataFrame:
    """(create_time, words) with a map of counts; a period has at most the top words."""
    return words.groupBy("create_time").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("words"))


def _plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Entities and width forms resolved; only texts that have any are touched."""
    for s in batches:
        yield s.map(lambda t: t if t is None or (t.isascii() and "&" not in t) else unicodedata.normalize("NFKC", html.unescape(t)))


def _named(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Emoji by their names in brackets."""
    symbol = lambda c: f" [{unicodedata.name(c, 'symbol').lower().replace(' ', '_')}] " if unicodedata.category(c) == "So" else c
    for s in batches:
        yield s.map(lambda t: t if t is None or t.isascii() else "".join(map(symbol, t)))


#: What stands for a title, a body or a comment that was taken away.
BLOCKED_TITLES = ["[deleted by user]", "[Removed by moderator]", "[Removed by Reddit]"]
BLOCKED_SELFTEXTS = ["[removed]", "[deleted]", "[Removed by Reddit on account of violating the [content policy](/help/contentpolicy).]"]
BLOCKED_BODIES = ["[removed]", "[deleted]"]
#: Patterns that have marks, in their order, and the marks.
MARKS = [
    (r"(?:https?://|www\.)[^\s)\]\}]+", "[URL]"),
    (r"!\[[^\]]*\]\([^)]+\)", "[MEDIA]"),
    (r"(?<!\w)(?:r|u)/[A-Za-z0-9_-]+(?:/[A-Za-z0-9_-]+)+", "[REDDIT_PATH]"),
    (r"(?<!\w)u/[A-Za-z0-9_-]+", "[USER]"),
    (r"(?<!\w)r/[A-Za-z0-9_-]+", "[SUBREDDIT]"),
]
#: What is tidied after that, in its order.
TIDY = [
    (r"(.)\1{2,}", "$1$1"),
    (r"(?<=[A-Za-z0-9])[—–-](?=[A-Za-z0-9])", "-"),
    (r"[\^\*\~\\/_—–#>|]", " "),
    (r"(?<![A-Za-z0-9])-(?![A-Za-z0-9]|\s*\d)|(?<=[A-Za-z0-9])-(?![A-Za-z0-9])", " "),
    (r"\(\s*\)|\[\s*\]|\{\s*\}", " "),
    (r"([\[\(\{])\s+", "$1"),
    (r"\s+([\]\)\}])", "$1"),
    (r"\s+", " "),
]


def clean_text(text: Column | str, blocked: list[str] = (), marks: bool = True, emoji: str = "keep", lower: bool = False) -> Column:
    """A text for the models: entities and width forms resolved, links, pictures, paths, users and communities as marks, long repeats cut to two, markup and blanks tidied.

    marks: False leaves them out instead. emoji: `keep`, `drop`, or `name` (the name in brackets). blocked: results that count as empty. Null and blank texts are empty.
    """
    x = F.pandas_udf(_plain, "string")(F.col(text) if isinstance(text, str) else text)
    if emoji == "drop":
        x = F.regexp_replace(x, r"[\p{So}\p{Cs}\x{200D}\x{FE0F}]", " ")
    elif emoji == "name":
        x = F.pandas_udf(_named, "string")(x)
    for pattern, by in [(p, f" {mark} " if marks else " ") for p, mark in MARKS] + TIDY:
        x = F.regexp_replace(x, f"(?U){pattern}", by)
    x = F.trim(F.translate(x, "\u200b", ""))
    x = F.when(x.isin(*blocked), "").otherwise(x) if blocked else x
    return F.coalesce(F.lower(x) if lower else x, F.lit(""))


def language_rule(text: Column | str, detector=None) -> Column:
    """`empty` without a letter; else what `detector` (a column function) says, by default `en` if most letters are ASCII."""
    x = F.col(text) if isinstance(text, str) else text
    ascii_, all_ = (F.length(F.regexp_replace(x, p, "")) for p in (r"[^A-Za-z]", r"[^\p{L}]"))
    guess = detector(x) if detector else F.when(ascii_ >= 0.9 * all_, "en").otherwise("non-en")
    return F.when(x.isNull() | ~x.rlike(r"\p{L}"), "empty").otherwise(guess)


def bot_flag(relevance: Column, author: Column, text: Column, authors: list[str], pattern: str) -> Column:
    """For relevant rows 1 if the author is known as a bot or the text says so, else 0; null for others."""
    said = F.coalesce(F.lower(author).isin([a.lower() for a in authors]), F.lit(False)) | F.coalesce(F.lower(text).rlike(pattern), F.lit(False))
    return F.when(relevance == 1, F.when(said, 1).otherwise(0))


def ensemble(first: Column, second: Column) -> Column:
    """Class from two arrays of three probabilities: weighted by class, scaled to sum 1, the largest; the lowest class of equals."""
    weighted = F.zip_with(F.zip_with(first, F.array(*[F.lit(w) for w in ENSEMBLE[0]]), lambda p, w: p * w), F.zip_with(second, F.array(*[F.lit(w) for w in ENSEMBLE[1]]), lambda p, w: p * w), lambda a, b: a + b)
    total = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)
    share = F.transform(weighted, lambda x: F.try_divide(x, total))
    return (F.array_position(share, F.array_max(share)) - 1).cast("int")


def decayed(times: Column, now: Column) -> Column:
    """Number of a thread's events (seconds), each weighing less by its age."""
    return F.aggregate(F.transform(times, lambda t: F.exp(-DECAY * (now - t) / 3600)), F.lit(0.0), lambda a, x: a + x)


def activity(times: Column, now: Column) -> Column:
    """Whether a thread is active: its events span at most SPAN_HOURS and their decayed count reaches ACTIVE."""
    span = (F.array_max(times) - F.array_min(times)) / 3600
    return (F.size(times) > 0) & (span <= SPAN_HOURS) & (decayed(times, now) >= ACTIVE)


def thread_sizes(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """(id, created_utc, comments, newest) of every submission; the last two null where there is no comment."""
    g = comments.groupBy(F.col("submission_id").alias("id")).agg(F.count("*").alias("comments"), F.max("created_utc").alias("newest"))
    return submissions.select("id", "created_utc").join(g, "id", "left")


def with_parent(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Only the comments whose submission is there."""
    return comments.join(submissions.select(F.col("id").alias("submission_id")), "submission_id", "left_semi").select(*comments.columns)


def newest_of(rows: DataFrame, group: str, time: str, key: str) -> DataFrame:
    """The key of each group's newest row, the greatest among equals."""
    return rows.dropna(subset=[group, time]).groupBy(group).agg(F.max_by(key, F.struct(time, key)).alias(key))


def watchlist(submissions: DataFrame, comments: DataFrame, now: int) -> DataFrame:
    """(id, created_utc, comment_ids, times, active) of the threads worth watching: active, or last touched within KEEP_DAYS. Comments are ordered by time, then id."""
    grouped = comments.groupBy("submission_id").agg(F.array_sort(F.collect_list(F.struct(F.col("created_utc").alias("t"), "id"))).alias("c"))
    both = submissions.select("id", "created_utc").join(grouped, F.col("id") == F.col("submission_id"), "left")
    times = F.concat(F.array("created_utc"), F.coalesce(F.col("c.t"), F.array().cast("array<bigint>")))
    out = both.select("id", "created_utc", F.coalesce(F.col("c.id"), F.array().cast("array<string>")).alias("comment_ids"), times.alias("times"))
    out = out.withColumn("active", activity(F.col("times"), F.lit(now)))
    return out.filter(F.col("active") | (now - F.array_min("times") <= KEEP_DAYS * 86_400))


def inherit_relevance(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Comments with their submission's relevance, where their own language is English or there is no word at all."""
    parent = submissions.select(F.col("id").alias("submission_id"), F.col("relevance").alias("parent_"))
    ok = F.col("language").isin("en", "empty")
    return comments.join(parent, "submission_id", "left").withColumn("relevance", F.when(ok, F.col("parent_"))).drop("parent_")


def relevance_prompt(subreddit: Column, flair: Column, title: Column, body: Column) -> Column:
    """What a relevance model reads: a line for each part that is there."""
    parts = [F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.lit(f"{name}: "), F.trim(c))) for name, c in (("Subreddit", subreddit), ("Flair", flair), ("Title", title), ("Selftext", body))]
    return F.concat_ws("\n", *parts)


def relevance(language: Column, probability: Column, threshold: float = 0.5) -> Column:
    """1 or 0 by a model's probability, for English texts and those without any word; null for others."""
    return F.when(language.isin("en", "empty"), F.when(probability >= threshold, 1).otherwise(0))
