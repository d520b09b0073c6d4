"""Model calls: several at a time, paced, in order, and not paid for twice."""

import glob
import json
import os
import subprocess
import sys
import time
from pathlib import Path

import pytest

from feedloom.operators import calls, model


def noting(folder, seconds=0.0):
    """A model that leaves a file for each call, with the times it began and ended."""

    def factory():
        import time
        import uuid

        def ask(prompt):
            began = time.time()
            time.sleep(seconds)
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as note:
                note.write(f"{prompt}\t{began}\t{time.time()}")
            return f"re {prompt}", (1, 1, 2)

        return ask

    return factory


def notes(folder):
    out = []
    for name in glob.glob(f"{folder}/*"):
        prompt, began, ended = Path(name).read_text().split("\t")
        out.append((prompt, float(began), float(ended)))
    return out


def asked(frame, n):
    return frame([(i, f"p{i}") for i in range(n)], "i INT, prompt STRING")


def test_calls_overlap_and_stand_in_order(tmp_path):
    pairs = [(f"k{i}", f"p{i}") for i in range(12)]
    began = time.monotonic()
    got = list(calls.ask_all(pairs, noting(tmp_path, 0.2), 1, 0.0, 4, None, None))
    assert time.monotonic() - began < 1.5  # one at a time takes 2.4 seconds
    assert [a[0] for a in got] == [f"re p{i}" for i in range(12)]
    seen = notes(tmp_path)
    most = max(sum(b <= moment < e for _, b, e in seen) for _, moment, _ in seen)
    assert most == 4


def test_calls_per_second(tmp_path):
    list(calls.ask_all([(str(i), str(i)) for i in range(9)], noting(tmp_path), 1, 0.0, 4, 20.0, None))
    starts = sorted(b for _, b, _ in notes(tmp_path))
    assert starts[-1] - starts[0] >= 8 / 20 * 0.95


def test_retries_wait_for_their_turn():
    tries = []

    def factory():
        def ask(prompt):
            tries.append(time.monotonic())
            raise OSError("busy")

        return ask

    (answer,) = calls.ask_all([("k", "p")], factory, 3, 0.0, 2, 20.0, None)
    assert answer[:3] == (None, 3, "OSError: busy") and tries[2] - tries[0] >= 0.095


def test_journal(tmp_path):
    book = calls.Journal(str(tmp_path / "j"))
    assert book.get("a") is None
    book.put("a", ("é", 1, None, 5, 1, 2, 3))
    book.put("a", ("é", 1, None, 5, 1, 2, 3))
    assert calls.Journal(str(tmp_path / "j")).get("a") == ("é", 1, None, 5, 1, 2, 3)
    assert calls.reachable(str(tmp_path)) and not calls.reachable("nosuchscheme://x/y")


def test_tasks_grow_with_the_prompts(frame, tmp_path):
    got = model.model_call(asked(frame, 100), noting(tmp_path), "m", "t", ["i"], per_task=10, concurrency=2)
    assert got.count() == 100 and len(notes(tmp_path)) == 100
    assert {r.i: r.reply for r in got.collect()} == {i: f"re p{i}" for i in range(100)}


def test_a_second_run_asks_only_the_rest(frame, tmp_path):
    seen, book = tmp_path / "seen", str(tmp_path / "book")
    seen.mkdir()
    model.model_call(asked(frame, 20), noting(seen), "m", "t", ["i"], journal=book)
    model.model_call(asked(frame, 30), noting(seen), "m", "t", ["i"], journal=book)
    assert sorted(p for p, _, _ in notes(seen)) == sorted(f"p{i}" for i in range(30))
    # Another model or task asks anew.
    model.model_call(asked(frame, 5), noting(seen), "other", "t", ["i"], journal=book)
    assert len(notes(seen)) == 35


def test_failures_are_not_kept(frame, tmp_path):
    def failing():
        def ask(prompt):
            raise OSError("down")

        return ask

    book = str(tmp_path / "book")
    assert model.model_call(asked(frame, 3), failing, "m", "t", ["i"], retries=1, journal=book).filter("error IS NULL").isEmpty()
    assert model.model_call(asked(frame, 3), noting(tmp_path), "m", "t", ["i"], journal=book).filter("error IS NOT NULL").isEmpty()


def test_rows_that_agree_are_answered_alike(frame, tmp_path):
    same = frame([(1, "p"), (1, "p"), (None, "p"), (2, None)], "i INT, prompt STRING")
    got = model.model_call(same, noting(tmp_path), "m", "t", ["i"]).collect()
    assert len(got) == 4 and all(r.reply for r in got if r.i)


def test_unreachable_journal(frame):
    with pytest.raises(ValueError, match="cannot write"):
        model.model_call(asked(frame, 1), lambda: None, "m", "t", ["i"], journal="nosuchscheme://x/y")


KILLED = """
import sys, os, json
from pyspark.sql import SparkSession
from feedloom.operators import model
folder = sys.argv[1]
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()

def factory():
    import os, uuid
    def ask(prompt):
        # The twentieth question ends its worker the first time it is put.
        if prompt == "p20" and not os.path.exists(folder + "/died"):
            open(folder + "/died", "w").close()
            os._exit(1)
        open(f"{folder}/calls/{prompt}-{uuid.uuid4().hex}", "w").close()
        return "re " + prompt, None
    return ask

asked = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "i INT, prompt STRING")
got = model.model_call(asked, factory, "m", "t", ["i"], per_task=20, concurrency=1)
print(json.dumps(sorted(r.reply for r in got.collect())))
"""


def test_a_lost_task_does_not_pay_twice(tmp_path):
    (tmp_path / "calls").mkdir()
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", KILLED, str(tmp_path)], cwd=root, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=170)
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == sorted(f"re p{i}" for i in range(40))
    assert (tmp_path / "died").exists()
    assert len(os.listdir(tmp_path / "calls")) == 40
