"""Operator 6: URL filter with rules, host word segmentation and naive Bayes.

Rules decide first: the longest rule (its text's length) whose host is the
url's host or a parent domain of it and whose path starts the url's path. All
other urls are judged by a multinomial naive Bayes model over words:

1. a unigram model of all words of the pages' text (counted over all pages)
   splits the labels of a host and the names in a path into words by Viterbi
   search: ``thering`` -> ``the ring``;
2. the urls that rules decide are the labelled examples: Spark counts each word
   in the allowed and in the blocked ones, over all pages;
3. a url is blocked when the log-probability of its words, with Laplace
   smoothing and class priors, is higher for block. Without any labelled
   example, or with equal scores, it is allowed.

Words that no page has count as one unknown word and digits as their number of
digits. Neither model is ever held whole: both stay tables in Spark. Urls are dealt
into chunks of at most about CHUNK_URLS; the distinct substrings of a chunk's names
are joined with the word table, the distinct words of a chunk with the class counts,
and each chunk is worked on with the entries that occur in it, which are all it can use.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is judged by the class priors; repeated pages are judged alike, row by row;
null ids and html are allowed; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .line_dedup import LOWER, UPPER

UNKNOWN = "<unknown>"
#: Letters of an alphabet for unknown words, cached segmentations.
LETTERS, CACHED = 26, 200_000
#: Urls of a chunk, chunks of a small table (which else would be too few for all tasks), substrings sent on at once.
CHUNK_URLS, LEAST_CHUNKS, SENT = 20_000, 200, 100_000
NAME = re.compile(r"\d+|[^\W\d_]+")

Rule = tuple[str, str]  # (allow or block, host/path)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and rule_verdict to rows with host and path; both null where no rule fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith(
            "path", F.lit(slash + path)
        )
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


class Segmenter:
    """Unigram Viterbi segmentation of concatenated words; ``total`` is given where ``counts`` has not all words."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = max(1, sum(counts.values()) if total is None else total)
        self.known = {w: math.log(n / total) for w, n in counts.items() if w}
        self.lengths = sorted({len(w) for w in self.known})
        self.floor = -math.log(total)
        self.cache: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        """The most probable words of ``name``; an unknown word of n letters has the probability 1 / (total * LETTERS^n)."""
        if name in self.cache:
            return self.cache[name]
        letter = math.log(LETTERS)
        best, last = [0.0], [0]
        start = 0  # of the best unknown word so far: it stays the best one as the word grows, or a later start is
        for end in range(1, len(name) + 1):
            score, start = max((best[s] + (self.floor - (end - s) * letter), s) for s in (start, end - 1))
            found = (score, start)
            for size in self.lengths:
                if size > end:
                    break
                word = name[end - size : end]
                if word in self.known:
                    found = max(found, (best[end - size] + self.known[word], end - size))
            best.append(found[0])
            last.append(found[1])
        out, end = [], len(name)
        while end:
            out.append(name[last[end] : end])
            end = last[end]
        if len(self.cache) >= CACHED:
            self.cache.clear()
        self.cache[name] = out = out[::-1]
        return out

    def words(self, host: str, path: str) -> list[str]:
        """Words of a host and path; digits as #<how many>, words outside the model as one unknown word."""
        out = []
        for part, mark in ((host, "h:"), (path.lower(), "p:")):
            for name in NAME.findall(part):
                if name[0].isdigit():
                    out.append(f"{mark}#{len(name)}")
                else:
                    out += [mark + (w if w in self.known else UNKNOWN) for w in self.split(name)]
        return out


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: all words of the pages' text, markup removed, with their counts."""
    plain = F.lower(F.regexp_replace(F.col("html").cast("string"), "<[^>]*>", " "))
    return staged(
        pages.select(F.explode(F.regexp_extract_all(plain, F.lit(r"(\p{L}{2,})"), F.lit(1))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n")),
        "page-words",
    )


def _names(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = {
            (chunk, name)
            for chunk, host, path in frame.itertuples(index=False, name=None)
            for part in (host, path.lower())
            for name in NAME.findall(part)
            if not name[0].isdigit()
        }
        yield pd.DataFrame(list(found), columns=["chunk", "name"])


def _substrings(lengths: list[int]):
    """The substrings of names that have the length of some word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found: set[tuple[int, str]] = set()
            for chunk, name in frame.itertuples(index=False, name=None):
                for size in lengths:
                    if size > len(name):
                        break
                    for at in range(len(name) - size + 1):
                        found.add((chunk, name[at : at + size]))
                        if len(found) >= SENT:
                            yield pd.DataFrame(list(found), columns=["of_chunk", "word"])
                            found = set()
            yield pd.DataFrame(list(found), columns=["of_chunk", "word"])

    return run


def words_in_names(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """of_chunk, word, n: the words that are substrings of a name of the chunk's urls."""
    lengths = [r.size for r in counted.select(F.char_length("word").alias("size")).distinct().collect()]
    names = rows.select("chunk", "host", "path").mapInPandas(_names, "chunk long, name string").distinct()
    parts = names.mapInPandas(_substrings(sorted(lengths)), "of_chunk long, word string")
    return parts.join(counted, "word").select("of_chunk", "word", "n").distinct()


URL = "page_id string, host string, path string, rule string, rule_verdict string"


def _segmented(total: int):
    def run(urls: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        segmenter = Segmenter(dict(zip(known["word"], known["n"], strict=True)), total)
        words = [segmenter.words(h, p) for h, p in zip(urls["host"], urls["path"], strict=True)]
        return urls.assign(words=words)

    return run


class NaiveBayes:
    """Log-odds of block against allow for each word, with Laplace smoothing.

    ``counts`` are (word, verdict, n), with the word "" for the urls themselves; ``totals`` (smoothed words per
    verdict) are given where ``counts`` has not all words."""

    def __init__(self, counts: list[tuple[str, str, int]], totals: dict[str, int] | None = None):
        held = {"allow": Counter(), "block": Counter()}
        urls = Counter()
        for word, verdict, n in counts:
            if word:
                held[verdict][word] += n
            else:
                urls[verdict] += n
        known = set(held["allow"]) | set(held["block"])
        total = totals or {v: sum(c.values()) + len(known) for v, c in held.items()}
        self.odds = {
            w: math.log((held["block"][w] + 1) / total["block"]) - math.log((held["allow"][w] + 1) / total["allow"])
            for w in known
        }
        self.prior = math.log(urls["block"] + 1) - math.log(urls["allow"] + 1)

    def score(self, words: list[str]) -> float:
        return self.prior + sum(self.odds.get(w, 0.0) for w in words)


def _scored(urls_of: dict[str, int], totals: dict[str, int], columns: list[str]):
    def run(urls: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        held = [("", verdict, n) for verdict, n in urls_of.items()]
        for verdict in urls_of:
            held += [(w, verdict, n) for w, n in zip(counts["word"], counts[verdict], strict=True)]
        model = NaiveBayes(held, totals)
        return urls.assign(score=[model.score(list(words)) for words in urls["words"]])[columns]

    return run


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log-odds of block by the model) for every row of ``pages``."""
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")
    )
    rows = with_rules(
        urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules
    )
    n = urls.count()
    chunks = max(1, n // CHUNK_URLS, min(LEAST_CHUNKS, n // 100))
    chunk = F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(chunks)).alias("chunk")
    rows = rows.select(chunk, F.col("page_id").cast("string"), "host", "path", "rule", "rule_verdict")
    counted = word_counts(pages)
    total = counted.agg(F.sum("n")).first()[0] or 0
    known = words_in_names(rows, counted)
    split = staged(
        rows.groupBy("chunk")
        .cogroup(known.groupBy("of_chunk"))
        .applyInPandas(_segmented(total), f"chunk long, {URL}, words array<string>"),
        "url-words",
    )
    learned = split.filter("rule_verdict is not null")
    of = {v: F.count_if(F.col("rule_verdict") == v).alias(v) for v in ("allow", "block")}
    counts = staged(
        learned.select("rule_verdict", F.explode("words").alias("word")).groupBy("word").agg(*of.values()), "url-word-counts"
    )
    urls_of = learned.agg(*of.values()).first().asDict()
    sums = counts.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count(F.lit(1)).alias("words")).first()
    totals = {v: (sums[v] or 0) + sums.words for v in of}
    used = split.select(F.col("chunk").alias("of_chunk"), F.explode("words").alias("word")).distinct().join(counts, "word")
    columns = ["page_id", "host", "path", "rule", "rule_verdict", "score"]
    scored = (
        split.groupBy("chunk")
        .cogroup(used.select("of_chunk", "word", *of).groupBy("of_chunk"))
        .applyInPandas(_scored(urls_of, totals, columns), f"{URL}, score double")
    )
    by_model = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        F.col("page_id").cast("long").alias("page_id"),
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", by_model).alias("verdict"),
        "score",
    )
