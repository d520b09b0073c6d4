"""Byte-level BPE as a tree reduction over the halves of a text.

A text longer than a leaf is halved; the halves are encoded by themselves and
joined by encoding a window around the seam anew, which grows until the tokens
outside of it provably stay as they are.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import whole

LEAF = 1 << 14
WINDOW = 64

# Between a visible character and a blank every scan of the pattern ends a match: no alternative holds a blank after
# another character. These four are blanks for every library.
_BLANK = " \t\n\r"
_SEAM = re.compile(r"(?<=\S)(?=[ \t\n\r])")
# The longest alternative that looks at fixed characters is an apostrophe and two letters.
_APOSTROPHE = 3


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _is_seam(text: str, at: int) -> bool:
    return text[at] in _BLANK and not text[at - 1].isspace()


class Tree:
    """Encodes and decodes with one rank file."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW) -> None:
        self.ranks, self.leaf, self.window = encoding(path), max(leaf, 1), window

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text, as one call over the whole text gives them."""
        if len(text) <= self.leaf:
            return np.array(self.ranks.encode_ordinary(text), dtype="<u4")
        middle = len(text) // 2
        return self.join(text[:middle], self.encode(text[:middle]), text[middle:], self.encode(text[middle:]))

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """Ids of left + right from the ids of both."""
        reach = self.window
        while True:
            start, end = self._stable_start(left, reach), self._stable_end(right, reach)
            if start is not None and end is not None:
                head = self._split(left_ids, len(left[start:].encode()), from_end=True)
                tail = self._split(right_ids, len(right[:end].encode()), from_end=False)
                if head is not None and tail is not None:
                    inner = np.array(self.ranks.encode_ordinary(left[start:] + right[:end]), dtype="<u4")
                    before, after = left_ids[:head], right_ids[tail:]
                    if self._holds(left, start, before, inner) and self._holds(right, end, inner, after):
                        return np.concatenate([before, inner, after])
            if reach >= max(len(left), len(right)):
                return np.array(self.ranks.encode_ordinary(left + right), dtype="<u4")
            reach *= 2

    def _stable_start(self, left: str, reach: int) -> int | None:
        """Where the window may begin: the last seam at least ``reach`` characters back, else a place inside a run."""
        if reach >= len(left):
            return 0
        seam = _last_seam(left, len(left) - reach)
        return seam if seam is not None else self._inside(left, len(left) - reach)

    def _stable_end(self, right: str, reach: int) -> int | None:
        if reach >= len(right):
            return len(right)
        seam = _SEAM.search(right, reach, min(len(right), 2 * reach + 1))
        return seam.start() if seam else self._inside(right, reach)

    @staticmethod
    def _inside(text: str, at: int) -> int | None:
        """A place between two letters that no contraction reaches: one match holds both, however the text goes on."""
        near = text[max(0, at - _APOSTROPHE):at + _APOSTROPHE]
        return at if 0 < at < len(text) and text[at - 1].isalpha() and text[at].isalpha() and "'" not in near else None

    def _holds(self, text: str, at: int, before: np.ndarray, after: np.ndarray) -> bool:
        """At a seam or an end always; inside a match when the two tokens there are what their bytes encode to.

        A sequence of tokens is the encoding of a match exactly if each pair of
        neighbours is the encoding of its own bytes.
        """
        if at in (0, len(text)) or _is_seam(text, at) or not len(before) or not len(after):
            return True
        pair = [int(before[-1]), int(after[0])]
        piece = self.ranks.decode_bytes(pair)
        return self.ranks._encode_single_piece(piece) == pair

    def _split(self, ids: np.ndarray, n_bytes: int, from_end: bool) -> int | None:
        """How many ids lie before the byte that is ``n_bytes`` from an end; None if a token spans it."""
        step, taken, count = (-1 if from_end else 1), 0, 0
        for token in ids[::step]:
            if taken >= n_bytes:
                break
            taken += len(self.ranks.decode_single_token_bytes(int(token)))
            count += 1
        return (len(ids) - count if from_end else count) if taken == n_bytes else None

    def decode(self, ids: np.ndarray) -> bytes:
        """The halves' bytes, concatenated up the tree."""
        if len(ids) <= self.leaf:
            return self.ranks.decode_bytes(ids.tolist())
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _last_seam(text: str, before: int) -> int | None:
    """The last seam at or before a place, among the nearest 4,096 characters."""
    return next((at for at in range(before, max(0, before - 4096), -1) if _is_seam(text, at)), None)


def tokenize(docs: DataFrame, path: str, digest: Callable[[Tree, str], tuple], schema: str, **tree: int) -> DataFrame:
    """doc_id and what ``digest`` makes of each whole text; a map over rows, without a shuffle."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reducer = Tree(path, **tree)
        for frame in frames:
            rows = [(doc, *digest(reducer, text)) for doc, text in zip(frame["doc_id"], frame["text"])]
            out = pd.DataFrame(rows, columns=["doc_id", *names])
            yield out.astype({"doc_id": "Int64"})

    names = [field.split()[0] for field in schema.split(", ")]
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    return text.mapInPandas(batches, f"doc_id long, {schema}")


def encode_documents(docs: DataFrame, path: str, **tree: int) -> DataFrame:
    """doc_id, ids: the encoding of each whole text, special tokens excluded.

    NULL and empty texts have no ids. Each row is encoded for itself, also
    repeated rows and rows without doc_id; other columns play no part.
    """
    return tokenize(docs, path, lambda reducer, text: (reducer.encode(text).astype("int32"),), "ids array<int>", **tree)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded: the bytes behind each ``ids``; NULL ids have none."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reducer = Tree(path)
        for frame in frames:
            decoded = [reducer.decode(np.array([] if ids is None else ids, dtype="<u4")) for ids in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "decoded": decoded})

    return encoded.select("doc_id", "ids").mapInPandas(batches, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, path: str, **tree: int) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, without writing either in between."""

    def digest(reducer: Tree, text: str) -> tuple[int, str, str]:
        ids = reducer.encode(text)
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(reducer.decode(ids)).hexdigest()

    return tokenize(docs, path, digest, "n_tokens long, ids_sha256 string, decoded_sha256 string", **tree)
