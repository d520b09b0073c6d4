import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedloom.operators import model, prompts
from feedloom.operators.sections import digest_collect, digest_rows, item_fragment
from feedloom.params import RunParams, settings_frame
from feedloom.plans.digest import daily_run, digests_of, enrich_plain
from feedloom.sources.digests import digest_archive, latest_digest
from feedloom.sources.history import HistoryLog, HistoryStore

NOW = dt.datetime(2025, 4, 8, 6, tzinfo=dt.timezone.utc)


def scripted():
    """Answers by prompt; remembers failures of this partition only."""
    tries = {}

    def ask(prompt):
        tries[prompt] = tries.get(prompt, 0) + 1
        if prompt == "third time" and tries[prompt] < 3:
            raise OSError("busy")
        if prompt == "never":
            raise OSError("down")
        if prompt == "empty":
            return "", (4, 0, 4)
        if prompt == "no usage":
            return "ok", None
        return "ok " + prompt, (1, 2, 3)

    return ask


def test_model_call(frame):
    asked = frame([(i, p) for i, p in enumerate(["third time", "never", "empty", "no usage", "plain"])], "i INT, prompt STRING")
    got = model.model_call(asked, scripted, "m", "t", ["i"], delay=0.0)
    rows = {r.i: (r.reply, r.attempts, r.error, r.prompt_tokens, r.total_tokens) for r in got.collect()}
    assert rows == {
        0: ("ok third time", 3, None, 1, 3), 1: (None, 3, "OSError: down", 0, 0), 2: (None, 3, "empty reply", 12, 12),
        3: ("ok", 1, None, 0, 0), 4: ("ok plain", 1, None, 1, 3),
    }
    assert got.rdd.getNumPartitions() >= 1 and got.filter("latency_ms < 0").isEmpty()
    assert "MapInPandas" not in got._jdf.queryExecution().toString()  # read back, not asked again


def test_render(frame):
    df = frame([("a{b}", None)], "a STRING, b STRING")
    assert df.select(prompts.render("<{a}|{b}|{c}>", a=F.col("a"), b=F.col("b"))).first()[0] == "<a{b}||{c}>"


ENRICHED = "run_date STRING, kind STRING, rank INT, url STRING, title STRING, summary STRING, insight STRING, angle STRING, move STRING"


def test_fragments_and_sections(frame):
    rows = [
        ("d", "news", 2, "u2", "B", None, None, "angle b", "Do b"),
        ("d", "news", 1, "u1", "A &amp; <i>", " s&nbsp;1 ", "on Vertex", "", None),
        ("e", "guide", 1, None, None, None, None, None, "not for guides"),
    ]
    df = frame(rows, ENRICHED)
    fragment = item_fragment(df.filter("rank = 1 AND kind = 'news'")).first().fragment
    assert fragment == (
        "<div class='item'>\n<h3>A &amp; &lt;i&gt;</h3>\n"
        "<p class='source-link'><a href=\"u1\" target=\"_blank\">u1</a></p>\n"
        "<p><strong>Summary:</strong> s 1</p>\n<p><strong>💡 Key Technical Insight:</strong> on Vertex</p>\n</div>"
    )
    sections = {(r.run_date, r.section): r.body for r in digest_collect(digest_rows(df)).collect()}
    assert len(sections) == 12
    assert sections["d", "headlines"].index("<h3>A") < sections["d", "headlines"].index("<h3>B")
    assert sections["d", "spotlight"].count("<li>") == 1 and "u1" in sections["d", "spotlight"]
    assert sections["d", "market"].startswith("<ul>\n<li>angle b &ndash; <a href=\"u2\"")
    assert sections["d", "actions"] == '<ul>\n<li>Do b<br><em>(Context: <a href="u2">B</a>)</em></li>\n</ul>'
    assert sections["e", "headlines"] == "<p><em>No relevant news items found today.</em></p>"
    assert "<h3>N/A</h3>" in sections["e", "guides"] and 'href="#"' in sections["e", "guides"]
    assert "No specific project applications" in sections["e", "actions"]
    runs = frame([("d",), ("f",)], "run_date STRING")
    empty = digest_collect(digest_rows(df), runs=runs).filter("run_date = 'f'").collect()
    assert len(empty) == 6 and all(r.body.startswith("<p><em>") for r in empty)
    document = digests_of(df).filter("run_date = 'd'").first().digest_html
    places = [document.index(f'id="{s}"') for s in ("headlines", "tutorial", "guides", "spotlight", "market", "actions")]
    assert places == sorted(places)


def test_enrich_plain(frame):
    df = frame([("d", "news", 1, "u", "t", "j" * 2100, "News"), ("d", "news", 2, None, "t", None, None)],
               "run_date STRING, kind STRING, rank INT, url STRING, title STRING, justification STRING, content_type STRING")
    only, = enrich_plain(df).collect()
    assert len(only.summary) == 2000 and only.source_name == "t" and only.insight is None


def reader_model():
    import re

    def ask(prompt):
        spent = (len(prompt), 10, len(prompt) + 10)
        if "JSON list" in prompt:
            rows = [
                {"url": url, "title": title, "source": "f", "relevance_score": len(title), "justification": "because " + title,
                 "content_type": "Tutorial/Guide" if "guide" in title else "News", "keywords": ["k"]}
                for title, url in re.findall(r"- Title: (.*)\n  URL: (.*)\n", prompt)
            ]
            return "```json\n" + json.dumps(rows) + "\n```", spent
        if "three or four" in prompt:
            return "Summary of " + re.search(r"Content: (.*)", prompt).group(1), spent
        if "three lines" in prompt:
            known = re.search(r"Projects of the reader:\n(.*)", prompt).group(1)
            return f"💡 Key Technical Insight: new\n📊 The Competitive Angle: n/a\n🚀 Your Potential Move: try it in {known}", spent
        topic = re.search(r"Tutorial: (.*)</h2>", prompt).group(1)
        return f"<h2>🛠️ Skill Up Tutorial: {topic}</h2><p>All about {topic}</p>", spent

    return ask


@pytest.mark.parametrize("kind", [HistoryStore, HistoryLog])
def test_daily_runs(spark, frame, tmp_path, kind):
    """Three runs: used items do not come back, topics rotate, usage adds up."""
    titles = [f"AI {'guide' if n % 4 == 0 else 'news'} number {n}" + "!" * n for n in range(30)]
    items = frame(
        [(t, f"https://i/{n}", NOW, "text " + t, f"feed{n % 3}", f"id{n}", n % 3, n) for n, t in enumerate(titles)],
        "title STRING, link STRING, published TIMESTAMP, summary STRING, source_feed STRING, id STRING, feed_rank INT, entry_pos BIGINT")
    store, archive = kind(spark, str(tmp_path / "history")), str(tmp_path / "archive")
    context = frame([("Project X",)], "context STRING")
    models = {"filter": "s", "summary": "s", "analysis": "l", "tutorial": "l"}
    seen = []
    for day in range(3):
        params = RunParams(now=NOW + dt.timedelta(days=day), max_hours=None, keywords=("ai",), num_news=5, num_guides=2)
        usage = daily_run(
            items, params.limits_frame(spark), params.skip_frame(spark), context, store, params, reader_model, models,
            "an engineer", ["graphs", "agents"], "me", archive, delay=0.0)
        tasks = {r.task: r["count"] for r in usage.groupBy("task").count().collect()}
        assert tasks["summary"] == tasks["analysis"] == 7 and tasks["tutorial"] == 1 and tasks["filter"] >= 3
        html = latest_digest(digest_archive(spark, archive)).first().digest_html
        assert f"All about {['graphs', 'agents', 'graphs'][day]}" in html
        assert html.count("<div class='item'>") == 7 and "try it in Project X" in html and "Summary of because AI" in html
        seen += [r.url for r in store.read(params.now).filter(F.col("ts") == F.lit(params.now)).collect()]
    assert len(seen) == len(set(seen)) == 21
    assert settings_frame(spark, "a STRING", [{"a": "x"}]).count() == 1


def careless_model():
    """Alters every address of the filter step, and answers nonsense for one feed."""
    import re

    ask = reader_model()

    def careless(prompt):
        reply, usage = ask(prompt)
        if "Source Feed: feed1" in prompt:
            return "sorry, no list today", usage
        if "Source Feed:" in prompt:
            reply = re.sub(r'"https://i/(\d+)"', r'"HTTPS://I/\1/?utm_source=x"', reply)
        return reply, usage

    return careless


def test_daily_run_with_altered_addresses_and_a_bad_reply(spark, frame, tmp_path):
    items = frame(
        [(f"AI news {n}", f"https://i/{n}", NOW, "text", f"feed{n % 3}", f"id{n}", n % 3, n) for n in range(12)],
        "title STRING, link STRING, published TIMESTAMP, summary STRING, source_feed STRING, id STRING, feed_rank INT, entry_pos BIGINT")
    store, rejects = HistoryStore(spark, str(tmp_path / "history")), []
    params = RunParams(now=NOW, max_hours=None, keywords=("ai",), num_news=8, num_guides=2)
    arguments = (items, params.limits_frame(spark), params.skip_frame(spark), frame([("X",)], "context STRING"), store, params)
    models = {"filter": "s", "summary": "s", "analysis": "l", "tutorial": "l"}
    daily_run(*arguments, careless_model, models, "an engineer", ["graphs"], "me", str(tmp_path / "archive"),
              rejected=lambda df: rejects.extend(df.collect()), delay=0.0)
    assert [r.source_feed for r in rejects] == ["feed1"]
    used = {r.url for r in store.read().collect()}
    assert used == {f"https://i/{n}" for n in range(12) if n % 3 != 1}

    def silent():
        return lambda prompt: ("nothing", None)

    with pytest.raises(RuntimeError, match="no reply"):
        daily_run(*arguments, silent, models, "an engineer", ["graphs"], "you", str(tmp_path / "archive"), delay=0.0)
