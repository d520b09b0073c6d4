"""Calls of one task: several at a time, at a bounded rate, in order, and none paid for twice."""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import BinaryIO

from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs

# (reply, attempts, error, milliseconds, prompt tokens, candidates tokens, total tokens)
Answer = tuple
#: Hexadecimal digits of a hash that name its shard of the journal.
SHARD_DIGITS = 3
#: Logs that a journal keeps open.
LOGS = 16


class Pace:
    """Lets calls begin at most ``rate`` times a second; without a rate, at once."""

    def __init__(self, rate: float | None) -> None:
        self._gap, self._next, self._lock = (1 / rate if rate else 0.0), 0.0, threading.Lock()

    def wait(self) -> None:
        if not self._gap:
            return
        with self._lock:
            now = time.monotonic()
            begin = max(now, self._next)
            self._next = begin + self._gap
        time.sleep(begin - now)


def reachable(folder: str) -> bool:
    """Whether tasks can write to the folder by themselves (a local or mounted path, HDFS, S3, GCS)."""
    try:
        fs.FileSystem.from_uri(folder)
    except (ArrowInvalid, ArrowNotImplementedError, OSError):
        return False
    return True


class Journal:
    """Answers by the hash of what was asked, in logs of a shared folder; a shard of the hashes has a folder of its own.

    Whoever writes has one log in each shard, to which a line is added before the answer is used, so a task that takes over
    from a lost one finds what that one was answered. File systems other than local or mounted ones add no lines; there each answer is a file.
    """

    def __init__(self, folder: str) -> None:
        self._files, self._root = fs.FileSystem.from_uri(folder)
        self._local = isinstance(self._files, fs.LocalFileSystem)
        self._known: dict[str, dict[str, list]] = {}
        self._made: set[str] = set()
        self._logs: dict[str, BinaryIO] = {}
        self._name, self._lock = uuid.uuid4().hex, threading.Lock()

    @staticmethod
    def _place(asked: str) -> tuple[str, str]:
        name = hashlib.sha256(asked.encode()).hexdigest()
        return name[:SHARD_DIGITS], name

    def _read(self, shard: str) -> dict[str, list]:
        known = {}
        for log in self._files.get_file_info(fs.FileSelector(f"{self._root}/{shard}", allow_not_found=True)):
            with self._files.open_input_stream(log.path) as lines:
                for line in lines.read().split(b"\n"):
                    try:
                        name, answer = json.loads(line)
                    except ValueError:  # a lost task's last line may have been cut off
                        continue
                    known[name] = answer
        return known

    def get(self, asked: str) -> Answer | None:
        shard, name = self._place(asked)
        if shard not in self._known:
            with self._lock:
                if shard not in self._known:
                    self._known[shard] = self._read(shard)
        found = self._known[shard].get(name)
        return None if found is None else tuple(found)

    def _log(self, path: str) -> BinaryIO:
        """An open log without a buffer: what is written is in the file even if the worker ends at once."""
        if path not in self._logs:
            if len(self._logs) == LOGS:
                self._logs.pop(next(iter(self._logs))).close()
            self._logs[path] = open(path, "ab", buffering=0)  # noqa: SIM115
        return self._logs[path]

    def put(self, asked: str, answer: Answer) -> None:
        shard, name = self._place(asked)
        folder = f"{self._root}/{shard}"
        # Begins a line of its own, whatever stands before it.
        line = f"\n{json.dumps([name, answer])}\n".encode()
        with self._lock:
            if shard not in self._made:
                self._files.create_dir(folder, recursive=True)
                self._made.add(shard)
            if self._local:
                self._log(f"{folder}/{self._name}.jsonl").write(line)
                return
        with self._files.open_output_stream(f"{folder}/{uuid.uuid4().hex}.jsonl") as entry:
            entry.write(line)


def ask_all(
    prompts: Iterable[tuple[str, str]], factory: Callable[[], Callable], retries: int, delay: float, workers: int, rate: float | None, journal: Journal | None,
) -> Iterator[Answer]:
    """Answers to (identity, prompt) pairs in their order; ``workers`` calls run at a time, each thread with a client of its own."""
    pace, own = Pace(rate), threading.local()

    def call(asked: tuple[str, str]) -> Answer:
        name, prompt = asked
        known = journal.get(name) if journal else None
        if known is not None:
            return known
        if not hasattr(own, "client"):
            own.client = factory()
        answer = _attempts(own.client, prompt, retries, delay, pace)
        if journal and answer[2] is None:
            journal.put(name, answer)
        return answer

    with ThreadPoolExecutor(workers) as pool:
        yield from pool.map(call, prompts)


def _attempts(ask: Callable, prompt: str, retries: int, delay: float, pace: Pace) -> Answer:
    spent, error, began = [0, 0, 0], None, time.monotonic()
    for attempt in range(1, retries + 1):
        reply = None
        pace.wait()
        try:
            reply, usage = ask(prompt)
            spent = [a + int(b or 0) for a, b in zip(spent, usage or (0, 0, 0))]
            error = None if reply else "empty reply"
        except Exception as failure:
            error = f"{type(failure).__name__}: {failure}"
        if error is None or attempt == retries:
            break
        time.sleep(delay * attempt)
    return (reply if error is None else None, attempt, error, int((time.monotonic() - began) * 1000), *spent)
