"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut at the tokenizer's special strings (each counts one token) and
at ASCII white space, which no pre-token spans. Every distinct chunk goes
once through the tokenizer's own normaliser and pre-tokeniser; the distinct
pre-tokens of a block are laid end to end in one numpy array of symbols. In
each round every sequence applies its lowest-ranked pair at all its places,
all sequences at the same time; a sequence without a pair leaves the array
and the symbols it still holds are its count. No token is ever built.

That is the tokenizer's own order because a merge can only be followed by
merges of a higher rank (checked when the merges are read); pairs that
overlap in a run of one symbol are taken from the left. Pre-tokens of more
than ``LONG`` symbols take the same merges from an agenda instead: rounds
over an array that long cost its length every time.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from maillens.llm.common import text_blocks, tidy

MODEL = "/opt/tokenizers/word_bpe_49k.json"
LIMIT = 2048
LONG = 4096               # symbols from which on the agenda is used
CACHE_CHUNKS = 400_000    # counted chunks that a task remembers

_NONE = np.iinfo(np.int32).max


class Merges:
    """Symbols and ranked pairs of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError(f"{path}: not a plain byte-level BPE model")
        self.ids: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        a = np.array([self.ids[x] for x, _ in pairs], np.int64)
        b = np.array([self.ids[y] for _, y in pairs], np.int64)
        self.made = np.array([self.ids[x + y] for x, y in pairs], np.int32)
        born = np.full(len(self.ids), -1, np.int64)
        born[self.made] = np.arange(len(pairs))
        if len(set(self.made.tolist())) < len(pairs) or (np.maximum(born[a], born[b]) >= np.arange(len(pairs))).any():
            raise ValueError(f"{path}: a merge ranks before one that it builds on")
        self.width = len(self.ids)
        order = np.argsort(a * self.width + b)
        self.keys, self.rank = (a * self.width + b)[order], order.astype(np.int32)
        chars = max(ord(t[0]) for t in self.ids if len(t) == 1) + 2
        self.inner = np.array([self.ids.get(chr(c), -1) for c in range(chars)], np.int32)
        self.final = np.array([self.ids.get(chr(c) + self.end, -1) for c in range(chars)], np.int32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where the pair never merges."""
        key = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], np.int32(_NONE))

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of (non-empty) pre-tokens, end to end, and how many
        each has; characters that the model lacks are dropped."""
        code = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        last = np.cumsum(size) - 1
        sym = self.inner[np.minimum(code, len(self.inner) - 1)]
        sym[last] = self.final[np.minimum(code[last], len(self.final) - 1)]
        there = sym >= 0
        if there.all():
            return sym, size
        return sym[there], np.bincount(np.repeat(np.arange(len(size)), size)[there], minlength=len(size))

    def count(self, tokens: list[str]) -> np.ndarray:
        """Number of tokens of every (non-empty) pre-token."""
        sym, size = self.symbols(tokens)
        at = np.cumsum(size) - size
        counts = np.zeros(len(size), np.int64)
        for i in np.flatnonzero(size > LONG):
            counts[i] = self.agenda(sym[at[i]:at[i] + size[i]].tolist())
        short = (size > 0) & (size <= LONG)
        if short.any():
            counts[short] = self.rounds(sym[np.repeat(short, size)], size[short])
        return counts

    def rounds(self, sym: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Symbols that survive in each sequence; ``sym`` holds the sequences
        of ``size`` symbols each (at least one) end to end."""
        out = np.zeros(len(size), np.int64)
        who = np.arange(len(size))
        last = np.cumsum(size) - 1
        rank = np.full(len(sym), _NONE, np.int32)
        rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank[last] = _NONE                                   # no pair crosses a border
        while len(who):
            low = np.minimum.reduceat(rank, last - size + 1)
            done = low == _NONE
            if done.any():
                out[who[done]] = size[done]
                stay = np.repeat(~done, size)
                sym, rank = sym[stay], rank[stay]
                who, size, low = who[~done], size[~done], low[~done]
                if not len(who):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            first = np.ones(len(hit), bool)                  # first of a run of touching hits
            first[1:] = np.diff(hit) != 1
            nth = np.arange(len(hit)) - np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
            hit = hit[nth % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            owner = np.repeat(np.arange(len(size)), size)
            size = size - np.bincount(owner[hit], minlength=len(size))
            place = np.cumsum(keep) - 1
            sym, rank = sym[keep], rank[keep]
            last = np.cumsum(size) - 1
            spot = place[hit]                                # the merged symbols
            ends = np.zeros(len(sym), bool)
            ends[last] = True
            begins = np.zeros(len(sym), bool)
            begins[last - size + 1] = True
            rank[spot[ends[spot]]] = _NONE
            behind = np.concatenate((spot[~ends[spot]], spot[~begins[spot]] - 1))
            rank[behind] = self.ranks(sym[behind], sym[behind + 1])
        return out

    def agenda(self, sym: list[int]) -> int:
        """The same count for one long sequence."""
        n = len(sym)
        right, left, live = [*range(1, n + 1)], [*range(-1, n - 1)], n
        rank = self.ranks(np.array(sym[:-1]), np.array(sym[1:])).tolist()
        todo = [(r, i, sym[i], sym[i + 1]) for i, r in enumerate(rank) if r != _NONE]
        heapq.heapify(todo)
        while todo:
            r, i, a, b = heapq.heappop(todo)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                                     # one side has changed meanwhile
            sym[i], sym[j] = int(self.made[r]), -1
            live -= 1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n:
                    key = sym[x] * self.width + sym[y]
                    at = int(np.searchsorted(self.keys, key))
                    if at < len(self.keys) and self.keys[at] == key:
                        heapq.heappush(todo, (int(self.rank[at]), x, sym[x], sym[y]))
        return live


class Counter:
    """Counts the tokens of texts; remembers chunks and pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.normal, self.split = tok.normalizer, tok.pre_tokenizer
        added = list(tok.get_added_tokens_decoder().values())
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError(f"{path}: added tokens that match by context")
        marks = sorted((re.escape(t.content.encode()) for t in added), key=len, reverse=True)
        self.marks = re.compile(b"|".join(marks)) if marks else None
        self.known: dict[bytes, int] = {}
        self.plain = re.compile("[a-z]+").fullmatch          # such a chunk is its own pre-token

    def pre_tokens(self, chunk: str) -> list[str]:
        if self.plain(chunk):
            return [chunk]
        if self.normal is not None:
            chunk = self.normal.normalize_str(chunk)
        return [t for t, _ in self.split.pre_tokenize_str(chunk) if t]

    def learn(self, chunks: set[bytes]) -> None:
        """Count the chunks not yet known, all their pre-tokens at once."""
        if len(self.known) > CACHE_CHUNKS:
            self.known = {}
        fresh = [c for c in chunks if c not in self.known]
        per = [self.pre_tokens(c.decode("utf-8")) for c in fresh]
        distinct = sorted({t for ts in per for t in ts})
        of = dict(zip(distinct, self.merges.count(distinct).tolist(), strict=True)) if distinct else {}
        for c, ts in zip(fresh, per, strict=True):
            self.known[c] = sum(of[t] for t in ts)

    def count(self, texts: list[bytes]) -> np.ndarray:
        chunks: list[bytes] = []
        n = np.zeros(len(texts), np.int64)
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if self.marks is not None and b"<" in text:
                parts = self.marks.split(text)
                n[i] = len(parts) - 1
                for part in parts:
                    chunks += part.split()
            else:
                chunks += text.split()
            ends[i + 1] = len(chunks)
        if chunks:
            self.learn(set(chunks))
            got = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
            total = np.concatenate(([0], np.cumsum(got)))
            n += total[ends[1:]] - total[ends[:-1]]
        return n


def _count(path: str, limit: int, text_at: int, passed: list[int],
           batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter(path)
    for batch in batches:
        for a, b, data, off in text_blocks(batch.column(text_at)):
            raw = data.tobytes()
            n = counter.count([raw[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(a, b - a) for c in passed]
                + [pa.array(np.diff(off), pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                names=[batch.schema.names[c] for c in passed] + ["n_bytes", "n_tokens", "over_limit"])
    tidy()


def token_counts(df: DataFrame, path: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """``df(text, ...)`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens), one row per row, no shuffle.

    Counts are those of the tokenizer file without begin or end tokens and
    without truncation; its special strings inside a text count one each. A
    null or empty text has zero of both, one of white space no tokens; texts
    are counted whole whatever their length; repeated rows get equal counts; an
    empty table gives an empty one. Columns named like the three are
    replaced, all others pass through.
    """
    df = df.drop("n_bytes", "n_tokens", "over_limit")
    names = df.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(partial(_count, path, limit, names.index("text"), list(range(len(names)))),
                         ", ".join([*fields, "n_bytes long", "n_tokens long", "over_limit boolean"]))
