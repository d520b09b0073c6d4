"""Echoed addresses return to their items."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import rejoin


def mapping(frame, urls, links):
    got = rejoin.url_mapping(frame([(u,) for u in urls], "url STRING"), frame([(x,) for x in links], "link STRING")).collect()
    assert len({r.url for r in got}) == len({r.link for r in got}) == len(got)
    return {r.url: r.link for r in got}


@pytest.mark.parametrize("url, form", [
    ("https://www.Example.org/A/b/?utm_source=x&z=1&a=2#top", "example.org/A/b?a=2&z=1"), ("http://e.org", "e.org"), ("HTTP://E.org//", "e.org"),
    ("e.org/?gclid=1&fbclid=2", "e.org"), ("https://e.org?a", "e.org?a"), ("", ""), (" https://e.org/x ", "e.org/x"),
])
def test_canonical(frame, url, form):
    assert frame([(url,)], "u STRING").select(rejoin.canonical(F.col("u"))).first()[0] == form


def test_altered_addresses(frame):
    link = "https://news.example.org/2024/story-about-models"
    for url in ("HTTPS://News.Example.org/2024/story-about-models", link + "/", link + "?utm_campaign=a", link.replace("https", "http"), link.replace("models", "Models"),
                link.replace("models", "model"), link.replace("models", "modells"), link.replace("models", "mobels"), link + "#c"):
        assert mapping(frame, [url], [link, "https://other.example.org/"]) == {url: link}, url


def test_numbers_name_other_items(frame):
    assert mapping(frame, ["https://e.org/13"], ["https://e.org/12"]) == {}
    assert mapping(frame, ["https://e.org/abXX"], ["https://e.org/abcd"]) == {}


def test_no_item_gets_two(frame):
    """Exact before canonical before case before a wrong letter; the rest stay without an item."""
    links = ["https://e.org/abc", "https://e.org/abd"]
    assert mapping(frame, ["https://e.org/abc", "https://e.org/abc/", "https://e.org/ABC"], links) == {"https://e.org/abc": "https://e.org/abc"}
    assert mapping(frame, ["https://e.org/abx", "https://e.org/abc/"], links) == {"https://e.org/abc/": links[0], "https://e.org/abx": links[1]}


def test_missing_repeated_and_many(frame):
    rng = random.Random(0)
    links = [f"https://e.org/{''.join(rng.choices('abcdef', k=8))}/{i}" for i in range(200)]
    echoed = {x: rng.choice([x, x + "/", x.replace("e.org", "E.ORG"), x[:18] + x[19:], x[:16] + "q" + x[17:]]) for x in links}
    urls = [*echoed.values(), *echoed.values(), None, "", "https://nowhere.org/1"]
    assert mapping(frame, urls, [*links, *links, None, "", "No Link"]) == {u: x for x, u in echoed.items()}
    assert mapping(frame, [], links) == mapping(frame, urls, []) == {}


def test_rejoin_within_runs(frame):
    results = frame([("a", "https://e.org/x/", 1), ("b", "https://e.org/x/", 2), ("b", None, 3)], "run STRING, url STRING, n INT")
    items = frame([("a", "https://e.org/x")], "run STRING, link STRING")
    got = rejoin.url_rejoin(results, items, ["run"])
    assert got.columns == results.columns
    assert sorted((r.run, r.url, r.n) for r in got.collect() if r.url) == [("a", "https://e.org/x", 1), ("b", "https://e.org/x/", 2)] and got.count() == 3
