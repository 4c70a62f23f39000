"""Problem 8: the corpus in ids of a public byte-level BPE tokenizer, and back.

Pre-tokens are encoded by a priority queue of merge ranks over a doubly linked list of symbols;
entries whose symbols have changed meanwhile are stale and skipped. Pre-tokens repeat, so each
worker keeps a bounded cache of them.
"""

from __future__ import annotations

import base64
import heapq
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary files lie; a parameter everywhere.
TOKENIZER_DIR = os.environ.get("MISSIVA_TOKENIZERS", "/opt/tokenizers")


def vocabulary(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> tuple[dict[bytes, int], str]:
    """Ranks by byte string, and the pattern that cuts texts into pre-tokens."""
    import importlib.util

    spec = importlib.util.spec_from_file_location("public_tokenizers_of_folder", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}, module.PATTERN


def bpe(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of least rank merges first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    sym: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            queue.append((r, i, 2))
    heapq.heapify(queue)
    while queue:
        r, i, size = heapq.heappop(queue)
        left = sym[i]
        if left is None:
            continue
        j = after[i]
        if j >= n or len(left) + len(sym[j]) != size or ranks.get(left + sym[j]) != r:
            continue  # stale: one of the two has merged with another since
        merged = left + sym[j]
        sym[i], sym[j] = merged, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            x = ranks.get(merged + sym[k])
            if x is not None:
                heapq.heappush(queue, (x, i, len(merged) + len(sym[k])))
        h = before[i]
        if h >= 0:
            x = ranks.get(sym[h] + merged)
            if x is not None:
                heapq.heappush(queue, (x, h, len(sym[h]) + len(merged)))
    return [ranks[s] for s in sym if s is not None]


class Encoder:
    """Texts to ids and back, without special tokens; their strings in a text are ordinary text."""

    def __init__(self, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, cache: int = 200_000, longest: int = 64):
        import regex

        self.ranks, pattern = vocabulary(name, folder)
        self.cut = regex.compile(pattern).findall
        self.cache: dict[str, list[int]] = {}
        self.size, self.longest = cache, longest
        self.words: list[bytes] | None = None

    def encode(self, text: str | None) -> list[int]:
        """Null and empty texts have no ids. Lone surrogates are read as U+FFFD."""
        if not text:
            return []
        out: list[int] = []
        cache = self.cache
        for piece in self.cut(text):
            ids = cache.get(piece)
            if ids is None:
                ids = bpe(piece.encode("utf-8", "replace"), self.ranks)
                if len(piece) <= self.longest:
                    if len(cache) >= self.size:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out

    def count(self, text: str | None) -> int:
        return len(self.encode(text))

    def decode(self, ids) -> str:
        if self.words is None:
            self.words = [b""] * (max(self.ranks.values()) + 1)
            for w, i in self.ranks.items():
                self.words[i] = w
        return b"".join(self.words[i] for i in ids).decode("utf-8", "replace")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(name: str, folder: str) -> Encoder:
    """One encoder for each vocabulary in each worker."""
    if (name, folder) not in _ENCODERS:
        _ENCODERS[name, folder] = Encoder(name, folder)
    return _ENCODERS[name, folder]


def with_ids(df: DataFrame, text_col: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, count_only: bool = False) -> DataFrame:
    """Add ``ids`` (array<int>), or their number where ``count_only``.

    Null and empty texts get an empty array (0). Every row of the input is kept, repeated rows
    too; whole texts are encoded however long they are.
    """
    kind = "int" if count_only else "array<int>"

    @F.pandas_udf(kind)
    def run(texts):
        import pandas as pd

        e = encoder(name, folder)
        return pd.Series([e.count(t) if count_only else e.encode(t) for t in texts])

    return df.withColumn(out, run(F.col(f"`{text_col}`")))


def with_text(df: DataFrame, ids_col: str = "ids", out: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """Add the text of ``ids``; null ids give null."""

    @F.pandas_udf("string")
    def run(ids):
        import pandas as pd

        e = encoder(name, folder)
        return pd.Series([None if x is None else e.decode(x) for x in ids])

    return df.withColumn(out, run(F.col(f"`{ids_col}`")))


def blank(c: Column) -> Column:
    """Whether a text has no visible character."""
    return F.coalesce(~c.rlike(r"(?U)\S"), F.lit(True))
