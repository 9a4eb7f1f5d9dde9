"""SentencePiece (BPE model) encoding with seeded merge-dropout, and decoding.

Encoding starts from single characters and takes adjacent pairs whose
concatenation is a piece from an agenda, best score first. With dropout a
candidate merge is skipped when its keyed hash says so; the key is made of
the seed, the document, the word's place in it and the candidate's three
borders inside the word: a draw of its own for every occurrence. A skipped
candidate never comes back, so a seed gives one segmentation of a document and
other seeds give others. With dropout 0 the result is the model's ordinary
segmentation.

No piece holds a line end or a blank behind another character, so merges
never cross the start of a word: words are segmented one by one, many at a
time in numpy (the best allowed merge of every word per round, which is the
agenda's order); very long words go through the agenda itself. Each distinct
word is segmented once without dropout and keeps the list of its merges: an
occurrence that skips none of them has that segmentation, only the others are
segmented with their own key.

Characters outside the model, and the character that the model uses for a
blank, become byte pieces, so decoding restores every text exactly.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import GOLD, mix, mix_int, text_blocks, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20
LONG_WORD = 40          # characters from which on the agenda is used directly
CACHE_WORDS = 400_000   # segmented words that a task remembers

_BLANK = "▁"
_WORDS = re.compile("\n| *[^ \n]+| +")


@dataclass
class Vocabulary:
    """Pieces of a SentencePiece BPE model, by id."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]                       # "normal", "byte" or "control"
    ids: dict[str, int] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == "normal"}
        byte_of = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == "byte"}
        self.byte_ids = [byte_of[f"<0x{b:02X}>"] for b in range(256)]


def load(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    kind = lambda i: ("byte" if sp.is_byte(i) else "control" if sp.is_control(i) or sp.is_unknown(i)
                      else "normal")
    return Vocabulary([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)],
                      [kind(i) for i in range(n)])


# --- the keyed hash -----------------------------------------------------------

def _word_keys(words: list[str], seed: int, stream: int) -> np.ndarray:
    import xxhash

    digest, own = xxhash.xxh3_64_intdigest, mix_int(seed * GOLD + stream + 1)
    return np.array([digest(w, own) for w in words], np.uint64)


def _spot(start, middle, end):
    """The borders of a candidate in one number."""
    return (start << 42) | (middle << 21) | end


def _drop_value(key: int, start: int, middle: int, end: int) -> int:
    return mix_int(key + _spot(start, middle, end) * GOLD)


def _limit(dropout: float) -> int:
    return min(int(dropout * 2.0 ** 64), (1 << 64) - 1)


def segment(word: str, vocab: Vocabulary, dropout: float, key: int, merges: list[int] | None = None) -> list[int]:
    """One word through the agenda; ``word`` holds blanks as plain blanks. The
    borders of the merges taken are added to ``merges``."""
    symbols = [_BLANK if c == " " else "" if c == _BLANK else c for c in word]   # "": bytes only
    n = len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    length = [1] * n
    limit = _limit(dropout)
    agenda: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        j = right[i] if i >= 0 else n
        if i < 0 or j >= n or not symbols[i] or not symbols[j]:
            return
        piece = vocab.ids.get(symbols[i] + symbols[j])
        if piece is not None:
            heapq.heappush(agenda, (-vocab.scores[piece], i, j, length[i] + length[j]))

    for i in range(n - 1):
        offer(i)
    while agenda:
        _, i, j, size = heapq.heappop(agenda)
        if length[i] == 0 or right[i] != j or length[i] + length[j] != size:
            continue                                       # one side has changed meanwhile
        if limit and _drop_value(key, i, j, i + size) < limit:
            continue
        if merges is not None:
            merges.append(_spot(i, j, i + size))
        symbols[i] += symbols[j]
        length[i], length[j] = size, 0
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(left[i])
        offer(i)
    ids: list[int] = []
    for i in range(n):
        if length[i]:
            piece = vocab.ids.get(symbols[i]) if symbols[i] else None
            ids += [piece] if piece is not None else [
                vocab.byte_ids[b] for b in (symbols[i] or _BLANK).encode()]
    return ids


def characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, end to end; length of each)."""
    return (np.frombuffer("".join(words).encode("utf-32-le"), np.uint32),
            np.fromiter(map(len, words), np.int64, len(words)))


# --- many words at once ---------------------------------------------------------

class Segmenter:
    """Segments lists of distinct words; pair look-ups in an open hash table."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        pairs: dict[tuple[int, int], int] = {}
        chars = {c for p in vocab.ids for c in p}
        self.symbol = dict(vocab.ids)                      # extra symbols: characters without a piece
        for c in sorted(chars - set(vocab.ids)):
            self.symbol[c] = len(vocab.pieces) + len(self.symbol)
        for piece, i in vocab.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = i
        char_id = {c: self.symbol[c] for c in chars if c != _BLANK} | {" ": self.symbol[_BLANK]}
        self.by_code = np.full(0x110000, -1, dtype=np.int32)   # -1: a character that never merges
        for c, i in char_id.items():
            self.by_code[ord(c)] = i
        # Ranks by score; pieces of blanks alone may tie, so words with several
        # blanks in front are left to the agenda, which goes by place then.
        order = sorted(vocab.ids.values(), key=lambda i: (vocab.scores[i], -i))
        self.ranked = np.array([0, *order], dtype=np.int32)   # piece by rank; rank 0: none
        rank = {i: r + 1 for r, i in enumerate(order)}
        self.bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.made = np.zeros(size, dtype=np.int32)
        self.probes = 1
        for (a, b), c in pairs.items():
            k = (a << 20) | b
            at = self._slot_int(k)
            n = 1
            while self.keys[at] >= 0:
                at = (at + 1) & (size - 1)
                n += 1
            self.keys[at], self.made[at] = k, rank[c]
            self.probes = max(self.probes, n)

    def _slot_int(self, key: int) -> int:
        return ((key * GOLD) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece made of two symbols, 0 where there is none."""
        out = np.zeros(len(a), dtype=np.int32)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        key = (a[at].astype(np.int64) << 20) | b[at]
        slot = ((key.astype(np.uint64) * np.uint64(GOLD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        for _ in range(self.probes):
            held = self.keys[slot]
            hit = held == key
            out[at[hit]] = self.made[slot[hit]]
            more = ~hit & (held >= 0)
            if not more.any():
                break
            at, key, slot = at[more], key[more], (slot[more] + 1) & (len(self.keys) - 1)
        return out

    def segment_all(self, words: list[str], dropout: float, seed: int, stream: int
                    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, their offsets), keys by (seed, stream, word)."""
        keys = (_word_keys(words, seed, stream) if dropout > 0 else np.zeros(len(words), np.uint64))
        return self.segment_keyed(words, dropout, keys)[:2]

    def segment_keyed(self, words: list[str], dropout: float, keys: np.ndarray
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words in order, their offsets, the merges taken, their
        offsets); one key for each word."""
        chars, size = characters(words)
        return self.segment_chars(chars, size, dropout, keys)

    def segment_chars(self, chars: np.ndarray, size: np.ndarray, dropout: float, keys: np.ndarray
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for words as characters, end to end."""
        words, first = len(size), np.cumsum(size) - size
        found: list[tuple[np.ndarray, ...]] = []
        second = np.minimum(first + 1, max(0, len(chars) - 1))
        alone = (size > LONG_WORD) | ((size > 1) & (chars[np.minimum(first, second)] == 32) & (chars[second] == 32))
        for i in np.flatnonzero(alone):
            merges: list[int] = []
            word = chars[first[i]:first[i] + size[i]].tobytes().decode("utf-32-le")
            ids = np.array(segment(word, self.vocab, dropout, int(keys[i]), merges), np.int32)
            found.append((np.array([i]), ids, np.array([len(ids)]),
                          np.array([m & 0xFFFFFFFFFFFFFFFF for m in merges], np.uint64), np.array([len(merges)])))
        size = np.where(alone, 0, size)
        low = 0
        for high in (4, 8, 12, 18, 26, LONG_WORD):
            pick = np.flatnonzero((size > low) & (size <= high))
            for a in range(0, len(pick), 20_000):
                part = pick[a:a + 20_000]
                n = size[part]
                mine = chars[np.arange(int(n.sum())) + np.repeat(first[part] - (np.cumsum(n) - n), n)]
                found.append((part, *self._rounds(mine, n, high, keys[part], dropout)))
            low = high

        def ordered(flat: int, many: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
            count = np.zeros(words, np.int64)
            for f in found:
                count[f[0]] = f[many]
            at = np.concatenate(([0], np.cumsum(count)))
            out = np.empty(at[-1], kind)
            for f in found:
                before = np.cumsum(f[many]) - f[many]
                out[np.arange(len(f[flat])) + np.repeat(at[f[0]] - before, f[many])] = f[flat]
            return out, at

        return *ordered(1, 2, np.int32), *ordered(3, 4, np.uint64)

    def _rounds(self, chars: np.ndarray, length: np.ndarray, width: int, key: np.ndarray, dropout: float
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids per word, merges taken, merges per word)."""
        n = len(length)
        flat = self.by_code[chars]
        inside = np.arange(width + 1)[None, :] < length[:, None]
        sym = np.full((n, width + 1), -2, dtype=np.int32)  # -2: past the end
        sym[inside] = flat
        start = np.minimum(np.arange(width + 2)[None, :], length[:, None]).astype(np.int8)
        best = np.zeros((n, width), dtype=np.int32)        # rank of the pair that starts here
        limit = np.uint64(_limit(dropout))

        def look(sym, start, best, key, rows: np.ndarray, cols: np.ndarray) -> None:
            rank = self._pair(sym[rows, cols], sym[rows, cols + 1])
            if dropout > 0:
                some = np.flatnonzero(rank)
                r, c = rows[some], cols[some]
                spot = ((start[r, c].astype(np.uint64) << np.uint64(42))
                        | (start[r, c + 1].astype(np.uint64) << np.uint64(21)) | start[r, c + 2].astype(np.uint64))
                rank[some[mix(key[r] + spot * np.uint64(GOLD)) < limit]] = 0
            best[rows, cols] = rank

        look(sym, start, best, key, *np.nonzero(inside[:, 1:]))
        # Every live word loses one symbol a round, so the working arrays lose a
        # column; finished words are written back and leave them.
        live, s, t, b, k = np.arange(n), sym, start, best, key
        taken: list[tuple[np.ndarray, np.ndarray]] = []

        def finish(rows: np.ndarray) -> None:
            w = s.shape[1]
            sym[live[rows], :w], start[live[rows], :w + 1] = s[rows], t[rows]
            if w <= width:
                sym[live[rows], w:] = -2

        while len(live):
            if not b.shape[1]:
                finish(np.ones(len(live), bool))
                break
            at = b.argmax(axis=1)
            rows = np.arange(len(live))
            top = b[rows, at]
            go = top > 0
            if not go.all():
                finish(~go)
                live, s, t, b, k, at, top = live[go], s[go], t[go], b[go], k[go], at[go], top[go]
                rows = np.arange(len(live))
            borders = (t[rows, at + i].astype(np.uint64) for i in range(3))
            taken.append((live, (next(borders) << np.uint64(42)) | (next(borders) << np.uint64(21)) | next(borders)))
            s[rows, at] = self.ranked[top]
            # the right one of the merged symbols goes, with its border and its pair
            stay = np.arange(t.shape[1])[None, :] != (at + 1)[:, None]
            s = s[stay[:, :-1]].reshape(len(live), s.shape[1] - 1)
            b = b[stay[:, :-2]].reshape(len(live), b.shape[1] - 1)
            t = t[stay].reshape(len(live), t.shape[1] - 1)
            back = np.flatnonzero(at)
            look(s, t, b, k, np.concatenate((rows, back)), np.concatenate((at, at[back] - 1)))
        # symbols to ids: a character without a piece becomes its bytes
        there = sym != -2
        ids = sym[there].astype(np.int64)
        odd = (ids < 0) | (ids >= len(self.vocab.pieces))
        per_word = there.sum(axis=1)
        if odd.any():
            first = np.concatenate(([0], np.cumsum(length)[:-1]))
            at_char = (start[:, :width + 1].astype(np.int64) + first[:, None])[there]
            code = np.array(self.vocab.byte_ids)
            pieces, sizes = [], np.ones(len(ids), np.int64)
            for i in np.flatnonzero(odd):
                raw = np.frombuffer(chr(chars[at_char[i]]).encode(), np.uint8)
                pieces.append(code[raw])
                sizes[i] = len(raw)
            owner = np.repeat(np.arange(n), per_word)
            per_word = np.bincount(owner, weights=sizes, minlength=n).astype(np.int64)
            out = np.empty(int(sizes.sum()), np.int64)
            at = np.cumsum(sizes) - sizes
            out[at[~odd]] = ids[~odd]
            for i, p in zip(np.flatnonzero(odd), pieces, strict=True):
                out[at[i]:at[i] + len(p)] = p
            ids = out
        whose = np.concatenate([np.zeros(0, np.int64), *[w for w, _ in taken]])
        spots = np.concatenate([np.zeros(0, np.uint64), *[m for _, m in taken]])
        return (ids.astype(np.int32), per_word, spots[np.argsort(whose, kind="stable")],
                np.bincount(whose, minlength=n))


# --- Arrow functions --------------------------------------------------------------

class _Pool:
    """Arrays of growing number, end to end."""

    def __init__(self, kind: type):
        self.flat, self.at, self.n = np.empty(0, kind), np.zeros(1, np.int64), 0

    def add(self, flat: np.ndarray, at: np.ndarray) -> None:
        used, more = int(self.at[self.n]), len(at) - 1
        while used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(1 << 16, len(self.flat)), self.flat.dtype)])
        while self.n + more + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros(max(1 << 14, len(self.at)), np.int64)])
        self.flat[used:used + len(flat)] = flat
        self.at[self.n + 1:self.n + more + 1] = used + at[1:]
        self.n += more

    def size(self, codes: np.ndarray) -> np.ndarray:
        return self.at[codes + 1] - self.at[codes]

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries of all codes in order, number of each)."""
        n = self.size(codes)
        before = np.cumsum(n) - n
        return self.flat[np.arange(int(n.sum())) + np.repeat(self.at[codes] - before, n)], n


class _Memory:
    """Segmented words of one task, for one model: the ids without dropout and
    the merges that lead to them."""

    def __init__(self, path: str, dropout: float):
        self.segmenter = Segmenter(load(path))
        self.dropout, self.limit = dropout, np.uint64(_limit(dropout))
        self.start()

    def start(self) -> None:
        self.known: dict[str, int] = {}
        self.chars, self.ids, self.merges = _Pool(np.uint32), _Pool(np.int32), _Pool(np.uint64)

    def trim(self) -> None:
        """Over ``CACHE_WORDS`` words: start anew."""
        if self.ids.n > CACHE_WORDS:
            self.start()

    def codes(self, words: list[str]) -> np.ndarray:
        fresh = list(set(words).difference(self.known))
        if fresh:
            chars, n = characters(fresh)
            ids, at, spots, spot_at = self.segmenter.segment_chars(chars, n, 0.0, np.zeros(len(fresh), np.uint64))
            self.chars.add(chars, np.concatenate(([0], np.cumsum(n))))
            self.known.update(zip(fresh, range(self.ids.n, self.ids.n + len(fresh)), strict=True))
            self.ids.add(ids, at)
            self.merges.add(spots, spot_at)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all occurrences in order, number of each); one key each."""
        code = self.codes(words)
        if self.dropout <= 0:
            return self.ids.take(code)
        spots, n = self.merges.take(code)
        skipped = mix(np.repeat(keys, n) + spots * np.uint64(GOLD)) < self.limit
        own = np.zeros(len(words), bool)
        own[np.repeat(np.arange(len(words)), n)[skipped]] = True
        again = np.flatnonzero(own)
        ids, at, _, _ = self.segmenter.segment_chars(*self.chars.take(code[again]), self.dropout, keys[again])
        size = self.ids.size(code)
        size[again] = np.diff(at)
        begin = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        usual = np.flatnonzero(~own)
        flat, n = self.ids.take(code[usual])
        out[np.arange(len(flat)) + np.repeat(begin[usual] - (np.cumsum(n) - n), n)] = flat
        out[np.arange(len(ids)) + np.repeat(begin[again] - at[:-1], np.diff(at))] = ids
        return out, size


def word_keys(document: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of all words of some documents: ``document`` holds a 64-bit key and
    ``words`` the number of words of each."""
    place = np.arange(int(words.sum())) - np.repeat(np.cumsum(words) - words, words)
    return mix(np.repeat(document.astype(np.uint64), words) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLD))


def _encode(path: str, dropout: float, text_at: int, draw_at: int, passed: list[int],
            back: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: columns ``passed``, then ids (and, with ``back``,
    the text decoded from them). The memory of words ends with the task:
    reused Python workers live beside a full JVM heap."""
    memory = _Memory(path, dropout)
    table = _Bytes(memory.segmenter.vocab) if back else None
    for batch in batches:
        texts = batch.column(text_at)
        draws = batch.column(draw_at).to_numpy(zero_copy_only=False)
        for a, b, _, _ in text_blocks(texts):
            memory.trim()
            rows = texts.slice(a, b - a).to_pylist()
            words: list[str] = []
            ends = [0]
            for text in rows:
                if text:
                    words += _WORDS.findall(" " + text)
                ends.append(len(words))
            ids, size = memory.encode(words, word_keys(draws[a:b], np.diff(ends)))
            off = np.concatenate(([0], np.cumsum(size)))[ends]
            null = np.array([r is None for r in rows])
            col = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(null))
            made = [col] + ([table.texts(col)] if back else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(a, b - a) for c in passed] + made,
                names=[batch.schema.names[c] for c in passed] + ["ids", "decoded"][:len(made)])
        tidy()


class _Bytes:
    """The bytes that every id stands for (control pieces: none)."""

    def __init__(self, vocab: Vocabulary):
        raw = []
        for i, p in enumerate(vocab.pieces):
            kind = vocab.kinds[i]
            raw.append(b"" if kind == "control" else bytes([vocab.byte_ids.index(i)]) if kind == "byte"
                       else p.replace(_BLANK, " ").encode())
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw])
        self.at = np.cumsum(self.size) - self.size

    def texts(self, ids: pa.Array) -> pa.Array:
        """Decoded texts; the leading blank that encoding adds is taken off."""
        values = ids.values.to_numpy(zero_copy_only=False)[ids.offsets[0].as_py():ids.offsets[-1].as_py()]
        off = ids.offsets.to_numpy() - ids.offsets[0].as_py()
        n = self.size[values]
        total = np.concatenate(([0], np.cumsum(n)))
        data = self.flat[np.arange(total[-1]) + np.repeat(self.at[values] - total[:-1], n)]
        ends = total[off]
        begins = ends[:-1]
        lead = np.flatnonzero((ends[1:] > begins))
        lead = lead[data[begins[lead]] == 0x20]
        keep = np.ones(len(data), bool)
        keep[begins[lead]] = False
        gone = np.zeros(len(ends), np.int64)
        gone[lead + 1] = 1
        out = pa.LargeStringArray.from_buffers(
            len(ids), pa.py_buffer((ends - np.cumsum(gone)).astype(np.int64).tobytes()),
            pa.py_buffer(data[keep].tobytes()))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:                            # ids that no encoder made
            raw = out.cast(pa.large_binary()).to_pylist()
            out = pa.array([r.decode("utf-8", "replace") for r in raw], pa.large_string())
        return pa.compute.if_else(ids.is_valid(), out.cast(pa.string()), pa.scalar(None, pa.string()))


def decoder(path: str, ids_at: int, passed: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Bytes(load(path))
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                ids = part.column(ids_at)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy()))),
                             pa.int32()), ids.flatten(), mask=ids.is_null())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in passed] + [table.texts(ids)],
                    names=[batch.schema.names[c] for c in passed] + ["decoded"])
            tidy()
    return run


def _schema(df: DataFrame, names: list[str]) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema.fields]


def encode(df: DataFrame, key: str | Column = "doc_id", path: str = MODEL, dropout: float = DROPOUT,
           seed: int = SEED, back: bool = False) -> DataFrame:
    """``df(text, ...)`` plus ``ids array<int>``, the pieces of the text; with
    ``back`` also ``decoded``, what ``decode`` makes of the ids, in the same pass
    (one Python worker per task instead of two).

    ``key`` and ``seed`` make a document's draws (a null: like any other value);
    all other columns pass through, an ``ids`` column is replaced. A null text
    has null ids, an empty one none; rows that repeat key and text get equal
    ids; an empty table gives an empty one. Texts are encoded whole whatever
    their length.
    """
    df = df.drop("ids", *["decoded"] * back)
    draw = F.xxhash64(F.lit(seed), F.col(key) if isinstance(key, str) else key)
    names = df.columns
    return df.select("*", draw.alias("__draw")).mapInArrow(
        partial(_encode, path, dropout, names.index("text"), len(names), list(range(len(names))), back),
        ", ".join([*_schema(df, names), "ids array<int>", *["decoded string"] * back]))


def decode(df: DataFrame, path: str = MODEL) -> DataFrame:
    """``df(ids, ...)`` plus ``decoded``, the text its ids stand for.

    Null ids give null, no ids an empty text; bytes that are no UTF-8 (ids
    that no encoder made) become replacement characters; control pieces stand
    for nothing. A ``decoded`` column is replaced, all others pass through.
    """
    df = df.drop("decoded")
    names = df.columns
    return df.mapInArrow(decoder(path, names.index("ids"), list(range(len(names)))),
                         ", ".join([*_schema(df, names), "decoded string"]))
