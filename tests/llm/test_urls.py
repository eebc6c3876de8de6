"""URL filter: parsing, rules, segmentation and scores against plain Python."""

import itertools
import math
import re

import pytest

from tallyfold.llm import urls
from tallyfold.llm.queries import URL_RULES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [
        r
        for r in URL_RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
        and path.startswith("/" + r.split("/", 1)[1])
    ]
    return max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/en/15?x=1", "http://example.org/es/a#b",
    "http://notexample.org/es/a", "http://x.com/fr/1", "http://x.com/de/1", "http://x.net/de/1",
    "http://x.com", "http://org/", "ftp://É.COM/fr/É", "http://x.com/fr/1", "a://b://c/d",
    "http://x.net/" + "q" * 3000, "http://thecatsat.net/1", "http://host.com:80/fr/\n1",
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "<p>the cat sat on the mat</p>", "x", 1) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, score int")
    return {r.page_id: r for r in urls.judge(pages, URL_RULES).collect()}


def test_parts_and_rules(judged):
    assert len(judged) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = plain_parts(url)
        row = judged[i]
        assert (row.host, row.path) == (host, path)
        assert row.rule == plain_rule(host, path)
        if row.rule:
            assert row.verdict == URL_RULES[row.rule]
        assert row.verdict in ("allow", "block") and 0 <= row.score <= 1


def test_repeated_rows_agree(judged):
    assert judged[7].score == judged[13].score


def test_segmentation_is_the_best_split():
    counts = {"the": 50, "cat": 20, "sat": 10, "thecat": 1, "a": 5}
    segmenter = urls.Segmenter(counts)
    for name in ("thecatsat", "thecat", "a", "zzz", "catthe", "thez"):
        best = max(
            sum(map(segmenter._score, parts))
            for parts in (
                [name[i:j] for i, j in itertools.pairwise([0, *cut, len(name)])]
                for n in range(len(name))
                for cut in itertools.combinations(range(1, len(name)), n)
            )
        )
        split = segmenter.split(name)
        assert "".join(split) == name
        assert math.isclose(sum(map(segmenter._score, split)), best)


def test_learns_from_rules(spark):
    rows = [(i, f"http://{'ads' if i % 2 else 'news'}.{'com/de/' if i % 2 else 'com/fr/'}1", "ads news") for i in range(40)]
    rows += [(100, "http://ads.net/de/1", ""), (101, "http://news.net/fr/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.verdict for r in urls.judge(pages, URL_RULES).collect()}
    assert found[100] == "block" and found[101] == "allow"


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string"), URL_RULES).count() == 0
