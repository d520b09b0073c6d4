"""Near copies by shingles and prompts by budget, beside plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedloom.operators import near, prompts
from feedloom.schemas import ITEM


def item(pos, title, summary, feed="f", rank=0):
    return (title, f"l{pos}", None, summary, feed, f"i{pos}", rank, pos)


def shingled(*texts):
    words = [w for w in re.split(r"[\W_]+", " ".join(t for t in texts if t).lower()) if w]
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def expected(rows):
    """Positions that stay, by all pairs."""
    sets = [shingled(None if r[0] == "No Title" else r[0], None if r[3] == "No Summary" else r[3]) for r in rows]
    similar = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9
    return [r[7] for i, r in enumerate(rows) if not any(similar(sets[i], sets[j]) for j in range(i))]


def stays(rows, frame):
    return sorted(r.entry_pos for r in near.near_dup_shingles(frame(rows, ITEM)).collect())


def varied(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    return words


def test_near_copies_equal_all_pairs(frame):
    """A large group of copies that differ among themselves, a common passage, short texts, copies in chains."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(80)]
    common = [rng.choice(vocabulary) for _ in range(40)]
    texts = [varied(rng, base, rng.randrange(4)) for _ in range(150)]
    texts += [common + [f"u{n}-{i}" for i in range(rng.randrange(5, 25))] for n in range(100)]
    texts += [[rng.choice("ab") for _ in range(rng.randrange(1, 8))] for _ in range(40)]
    chain = [f"c{i}" for i in range(60)]
    for _ in range(30):
        chain = varied(rng, chain, 1)
        texts.append(chain)
    rng.shuffle(texts)
    rows = [item(n, None, " ".join(t)) for n, t in enumerate(texts)]
    kept = stays(rows, frame)
    assert kept == expected(rows)
    assert len(kept) < len(rows)


def test_near_copies_odd_rows(frame):
    rows = [
        item(1, "No Title", "No Summary"), item(2, None, None), item(3, "?!", ""), item(4, "One two", "three"), item(5, "ONE  two", "Three."),
        item(6, "three two", "one"), item(7, "Ünïcode wörds sind auch", "wörter hier"), item(7, "Ünïcode wörds sind auch", "wörter hier"),
    ]
    assert stays(rows, frame) == [1, 2, 3, 4, 6, 7]
    assert stays([], frame) == []
    extra = frame(rows, ITEM).withColumns({"story": F.lit(1), "shingles": F.lit("x"), "_k0": F.lit(0)})
    kept = near.near_dup_shingles(extra)
    assert kept.columns == extra.columns and kept.count() == 6


def test_near_copies_earlier_feed_wins(frame):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [item(1, None, text + " late", "b", 2), item(9, None, text + " first", "a", 1)]
    assert stays(rows, frame) == [9]


def test_near_copies_pair_nothing_twice(spark, frame):
    """Work of a large group stays in proportion to it: members are held against the first one only."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(100)]
    rows = [(n, sorted({hash(tuple(w[i:i + 5])) for w in [varied(rng, base, 1)] for i in range(96)})) for n in range(300)]
    stories = frame(rows, "story BIGINT, shingles ARRAY<BIGINT>")
    rare = near.rare_shingles(stories, 0.8)
    assert near.losers(stories).count() == 299
    assert rare.groupBy("story").count().agg(F.max("count")).first()[0] <= 96 - 77 + 1


@pytest.mark.parametrize("budget", [30, 60, 400])
def test_prompts_never_exceed_the_budget(frame, budget):
    rng = random.Random(budget)
    rows = [item(pos, "t" * rng.randrange(1, 30), "s" * rng.randrange(0, 700), feed) for feed in "ab" for pos in range(57)]
    rows.append(item(57, "T" * 5000, None, "a"))
    got = prompts.budgeted_prompt_items(frame(rows, ITEM), ["source_feed"], "entry_pos", budget, span=25, chars_per_token=3).collect()
    blocks = {(r.source_feed, r.entry_pos): r.block for r in frame(rows, ITEM).select("source_feed", "entry_pos", prompts.item_block().alias("block")).collect()}
    for feed in "ab":
        want, used, last = [], 0, None
        for pos in sorted(p for f, p in blocks if f == feed):
            block = blocks[feed, pos][:budget * 3 - 1]
            size = -(-(len(block) + 1) // 3)
            if want and last == pos // 25 and used + size <= budget:
                want[-1].append(block)
                used += size
            else:
                want.append([block])
                used = size
            last = pos // 25
        mine = sorted((r for r in got if r.source_feed == feed), key=lambda r: r.batch_no)
        assert [r.items_text for r in mine] == ["\n".join(b) for b in want]
        assert all(-(-len(r.items_text) // 3) <= r.n_tokens <= budget for r in mine)
        assert len({r.batch_no for r in mine}) == len(mine)


def test_prompts_by_budget_odd_input(frame):
    assert prompts.budgeted_prompt_items(frame([], ITEM), ["source_feed"], "entry_pos", 10).count() == 0
    with pytest.raises(ValueError):
        prompts.budgeted_prompt_items(frame([], ITEM), ["source_feed"], "entry_pos", 0)
