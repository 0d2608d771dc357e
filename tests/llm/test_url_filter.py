"""Operator 6 against plain Python."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

from ordermill.llm.queries import URL_RULES
from ordermill.llm.url_filter import NaiveBayes, Segmenter, judge_urls

SCHEMA = "page_id long, url string, html string, host string, rule string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [
        (len(r), r, a)
        for a, r in URL_RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])
    ]
    return max(fits)[1:] if fits else (None, None)


def corpus():
    rnd = random.Random(6)
    hosts = ["thering", "blog.theand", "WWW.theblue", "redhouse", "x"]
    ends = [".example.org", ".example.com", ".example.net", ".example.ORG", "org.net", ".org", ".com"]
    paths = ["/es/1", "/en/12", "/en/2?x=/fr/", "/fr/3#a", "/de/4", "", "?q", "#f", "/", "/theredhouse/99/É"]
    rows = [
        (i, f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}{rnd.choice(ends)}{rnd.choice(paths)}", None, "h", "r")
        for i in range(200)
    ]
    html = "<p class='q'>the ring and the red house, the blue ring</p>"
    rows += [(900, None, html, "h", "r"), (901, "no scheme", html, "h", "r"), (902, "", None, "h", "r"), (903, "://", html, "h", "r")]
    return rows + [(None, "http://org/", "", "h", "r"), rows[0], rows[0], (904, "http://a.org/b://c/d", html, "h", "r")]


def test_host_path_rule_and_verdict(spark):
    rows = corpus()
    out = judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    want, verdicts = [], {}
    for page, url, *_ in rows:
        host, path = parts(url)
        rule, action = rule_of(host, path)
        verdicts[host, path] = action
        want.append((str(page), host, path, str(rule)))
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in out) == sorted(want)
    for r in out:
        assert r.verdict == (verdicts[r.host, r.path] or ("block" if r.score > 0 else "allow"))
    assert {r.verdict for r in out if r.rule is None} <= {"allow", "block"}


def test_scores_equal_a_plain_model(spark):
    rows = corpus()
    out = judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    words = Counter()
    for row in rows:
        words.update("the ring and the red house the blue ring".split() if row[2] else [])
    model = Segmenter(dict(words))
    assert model.words("thering", "/theredhouse/12") == ["h:the", "h:ring", "p:the", "p:red", "p:house", "p:#2"]
    counts, urls = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, *_ in rows:
        action = rule_of(*parts(url))[1]
        if action:
            counts[action].update(model.words(*parts(url)))
            urls[action] += 1
    known = set(counts["allow"]) | set(counts["block"])
    total = {a: sum(c.values()) + len(known) for a, c in counts.items()}
    for r in out:
        score = math.log(urls["block"] + 1) - math.log(urls["allow"] + 1)
        for w in model.words(r.host, r.path):
            if w in known:
                score += math.log((counts["block"][w] + 1) / total["block"])
                score -= math.log((counts["allow"][w] + 1) / total["allow"])
        assert abs(score - r.score) < 1e-9


def test_segmentation_is_the_most_probable(spark):
    counts = {"a": 5, "ab": 3, "b": 2, "ba": 4, "aba": 1, "c": 1}
    model, total = Segmenter(counts), sum(counts.values())

    def cost(words):
        return sum(
            math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(26) for w in words
        )

    for letters in itertools.product("abd", repeat=5):
        name = "".join(letters)
        splits = []
        for cuts in itertools.product([0, 1], repeat=4):
            words, word = [], name[0]
            for c, cut in zip(name[1:], cuts, strict=True):
                words, word = (words + [word], c) if cut else (words, word + c)
            splits.append(words + [word])
        assert abs(cost(model.split(name)) - max(map(cost, splits))) < 1e-9
    assert len("".join(model.split("z" * 3000))) == 3000


def test_all_words_count_however_many_and_long(spark):
    rare = ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4), 60_000)]
    long = "donaudampfschifffahrtsgesellschaft"
    html = " ".join([*rare, "zebra", "house", long])
    urls = ["http://zebrahouse.example.org/es/1", f"http://{long}house.org/", "http://q.net/zebra", f"http://q.net/{long}", "http://q.net/house"]
    rows = [(i, url, html if not i else None, "", "") for i, url in enumerate(urls)]
    out = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()}
    model = Segmenter(dict.fromkeys(html.split(), 1))
    assert model.words(long + "house", "") == ["h:" + long, "h:house"]
    assert model.split("é" * 30) == ["é" * 30]
    counts = []
    for i, verdict in ((0, "block"), (1, "allow")):
        counts += [("", verdict, 1), *((w, verdict, 1) for w in model.words(*parts(urls[i])))]
    bayes = NaiveBayes(counts)
    assert "h:zebra" in bayes.odds and "h:" + long in bayes.odds
    for r in out.values():
        assert abs(r.score - bayes.score(model.words(r.host, r.path))) < 1e-9
    assert out[0].score > 0 > out[1].score


def test_empty_table_and_no_examples(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []
    out = judge_urls(spark.createDataFrame([(1, "http://x.net/a", "b", "", "")], SCHEMA), URL_RULES).collect()
    assert [(r.verdict, r.score) for r in out] == [("allow", 0.0)]
    assert NaiveBayes([]).score(["x"]) == 0.0
