import datetime as dt
import html
import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import dates, markup, text
from feedloom.functions.entities import NAMED, html_unescape
from feedloom.sources import replies


@pytest.fixture
def apply(frame):
    def run(values, *functions):
        df = frame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
        rows = df.select("i", *[f(F.col("v")).alias(f"o{n}") for n, f in enumerate(functions)]).orderBy("i").collect()
        return [r[1] if len(functions) == 1 else tuple(r)[1:] for r in rows]

    return run


def test_unescape_equals_the_standard(apply):
    rng = random.Random(5)
    pool = ["&", "#", "x", "X", ";", "a", "lt", "amp", "not", "it", "1", "8", "2", "F", " ", "<", "\n", "128", "55296", "1114112", "99999999999"]
    values = [f"&{n}|&{n}x;&{n[:-1]}" for n in NAMED]
    values += [f"&#{n};&#x{n:x} &#X{n:X};" for n in [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x1FFFF, 0x10FFFF, 0x110000]]
    values += ["".join(rng.choice(pool) for _ in range(14)) for _ in range(2000)]
    values += ["", "plain", "&amp;#8217;", "&lt;b&gt;", "&#0000000000065;", None]
    assert apply(values, html_unescape) == [v if v is None else html.unescape(v) for v in values]


def test_escape_and_strip_equal_the_standard(apply):
    values = ["a & b", "<i>'x' \"y\"</i>", "&amp;", " \xa0 x \x1f\n", "", " \t ", "ß&é"]
    assert apply(values, text.html_escape) == [html.escape(v) for v in values]
    assert apply(values, text.strip) == [v.strip() for v in values]


def test_truncate(apply):
    assert apply(["a" * 500, "a" * 501, None, "é" * 600], lambda c: text.truncate(c, 500)) == ["a" * 500, "a" * 497 + "...", None, "é" * 497 + "..."]


def test_clean_up(apply):
    assert apply([" x ```py\ncode\n``` <b>y</b> &amp; z "], text.clean_summary) == ["x  y & z"]
    assert apply(["&amp;nbsp;a nbsp;", "a&amp;nbsp;b"], text.nbsp_clean) == ["a", "a b"]
    assert apply(["```html\n<p>\n```\n", "<p>```html"], text.strip_reply_fence) == ["<p>\n", "<p>```html"]
    assert apply(["None", "N/A", "none so far", "[Analysis generation failed]", None], text.noncommittal_null) == [None, None, "none so far", None, None]
    assert apply(["a, b,,c", "", " , ", None], text.list_from_text) == [["a", "b", "c"], [], [], None]


def test_analysis_fields(frame):
    i, a, m = text.INSIGHT_LABEL, text.ANGLE_LABEL, text.MOVE_LABEL
    given = [
        f"{i} one\ntwo\n{a} x &amp; <b>y</b>\n{m} N/A", f"{i} only\n{m} go", f"{i}\n{a}\n{m} z", "no labels", f"Look: {i} inline\n{a} ok",
        f"{a} first\n{i} ```py\nx\n```  rest", None, f"{i} none\n📊 other words\n{m} [analysis generation failed]",
    ]
    df = frame([(n, g) for n, g in enumerate(given)], "n INT, reply STRING")
    got = [tuple(r)[2:] for r in text.analysis_fields(df).orderBy("n").collect()]
    assert got == [
        ("one\ntwo", "x & y", None), ("only", None, "go"), ("", "", "z"), (None, None, None), (None, "ok", None),
        ("rest", "first", None), (None, None, None), (None, None, None),
    ]


def test_markup(apply):
    marked = '<h2 id="a">🛠️ Skill Up Tutorial:  Graphs </h2><p>x</p>'
    values = [marked, "<H2>Other\ntopic</H2>", "<p>none</p>", "", None]
    assert apply(values, markup.heading_topic) == ["Graphs", "Other\ntopic", "Unknown Topic", "N/A", "N/A"]
    assert apply([marked, "<h2>keep</h2>", marked + marked], markup.heading_remove) == ["<p>x</p>", "<h2>keep</h2>", "<p>x</p>" + marked]
    page = "<p><strong>Goal:</strong> a &lt;b&gt; <i>c</i>\n</p><p><strong>goal:</strong> d</p>"
    assert apply([page, "<p>Goal: x</p>"], lambda c: markup.labelled_paragraph(c, "GOAL")) == ["a  c", None]
    code = '<pre><code class="language-python">\nx = 1\n</code></pre><pre>no</pre><div class="codehilite"><pre><code class="language-python">y</code></pre></div>'
    assert apply([code, "none"], markup.code_blocks) == [["x = 1", "y"], []]


def test_pubdates(apply):
    utc = lambda *a: dt.datetime(*a)
    cases = {
        "Thu, 03 Apr 2025 19:38:18 +0200": utc(2025, 4, 3, 17, 38, 18), "Thu, 3 Apr 2025 19:38:18 GMT": utc(2025, 4, 3, 19, 38, 18),
        "3 Apr 2025 19:38 EST": utc(2025, 4, 4, 0, 38), "Thursday, 03 Apr 25 19:38:18 UT": utc(2025, 4, 3, 19, 38, 18),
        "2025-04-03T19:38:18.552558": utc(2025, 4, 3, 19, 38, 18, 552558), "2025-04-03T19:38:18+02:00": utc(2025, 4, 3, 17, 38, 18),
        "2025-04-03": utc(2025, 4, 3), "yesterday": None, "": None, None: None,
    }
    assert apply(list(cases), dates.parse_pubdate) == list(cases.values())


def test_iso_and_title_dates(frame):
    df = frame([(dt.datetime(2025, 4, 3, 1, 2, 3, 4500),), (dt.datetime(2025, 12, 31, 1, 2, 3),)], "t TIMESTAMP")
    t = F.col("t")
    got = df.select(text.iso_format(t), text.digest_date(t), text.subject_line(t, "News", resend=True)).collect()
    assert [tuple(r) for r in got] == [
        ("2025-04-03T01:02:03.004500", "April 03, 2025", "[Resend] News - April 03, 2025"),
        ("2025-12-31T01:02:03", "December 31, 2025", "[Resend] News - December 31, 2025"),
    ]


def test_model_json(frame):
    good = json.dumps([{"url": "u", "title": "t", "relevance_score": 9, "keywords": ["a"]}, {"url": "v", "relevance_score": "7.5"}])
    given = [good, f"```json\n{good}\n```", f" ```JSON {good}``` ", good[:-3], "[]", '{"url": "u"}', "sorry", None, good + " done"]
    df = frame([(i, g) for i, g in enumerate(given)], "i INT, reply STRING")
    rows = replies.model_json_scan(df, ["i"])
    assert sorted((r.i, r.pos, r.url, r.relevance_score) for r in rows.collect()) == [
        (i, p, u, s) for i in (0, 1, 2) for p, u, s in ((0, "u", "9"), (1, "v", "7.5"))
    ]
    assert sorted(r.i for r in replies.model_json_rejects(df, ["i"]).collect()) == [3, 5, 6, 7, 8]
