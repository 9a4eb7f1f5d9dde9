"""Alignment of two tokenizations by external spill counting.

A is a byte-level BPE, B a SentencePiece model; both cut the same bytes (a
blank and the text). The byte offsets at which an A and a B token both end
cut the tokens into groups; an A and a B token whose byte ranges overlap are
linked. The count of an id pair, over all texts, tells how well two
vocabularies' entries go together.

Counting never holds the pairs of the corpus. A task packs its links as
(B id, A id, document) records, sorted with the B side first, into runs: one
zstd-compressed run for each radix of the B id and each ``RECORDS`` links,
spilled to a written table in the shared folder. A run's head lists its
distinct pairs with their counts, its body the documents of each pair. Heads
meet by radix, ``FAN`` at a time, in a k-way heap merge of compressed frames,
until one remains per radix; as its pairs come B side first, a B id's highest
count is known when its pairs have passed. The counted pairs then travel to
the runs of their radix (split by number of records where a radix is heavy,
such as that of a very frequent B id), which give every document's share
back, a dense array per run, and arrays of one run set add up beside their
documents. Rows that are shuffled are runs, never single links.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import GOLD, mix, release, staged, text_blocks, tidy

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
RADIXES = 64               # classes of B ids by hash
RECORDS = 1 << 21          # links of one run set (a longer text: its own)
DOCS = 1 << 20             # texts of one run set at most (20 bits of a record)
FAN = 16                   # heads that meet in one merge
FRAME = 1 << 14            # pairs of one compressed frame of a head
GROUP = 1 << 20            # records that one group of runs of a radix holds, about

_ID_BITS, _DOC_BITS = 17, 20
_LOW = (1 << _ID_BITS) - 1


# --- token bytes ----------------------------------------------------------------

class Vocabulary:
    """The bytes of every id, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) > 1 << _ID_BITS:
            raise ValueError("more ids than a record's bits hold")
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        before = np.cumsum(n) - n
        return self.flat[np.arange(int(n.sum())) + np.repeat(self.at[ids] - before, n)]


def _byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_a(path: str):
    """(encode one text, vocabulary) of a byte-level BPE file. Its ids are in
    the order of its merges, so tiktoken, several times faster, gives the
    same ids (also where special strings stand in a text: plain text)."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as fh:
        spec = json.load(fh)
    special = {t["content"] for t in spec["added_tokens"]}
    of = _byte_chars()
    ranks = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
    if [spec["model"]["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    tokens = [b""] * (1 + max(ranks.values()))
    for t, i in ranks.items():
        tokens[i] = t
    fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except Exception:   # its pattern engine gives up on endless runs of white space
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(path))
                slow[0].encode_special_tokens = True
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode, Vocabulary(tokens)


def load_b(path: str):
    """(encode many texts, vocabulary) of a SentencePiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            tokens.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i):
            tokens.append(b"")
        else:
            tokens.append(piece.replace("▁", " ").encode())
    return partial(sp.encode, num_threads=1), Vocabulary(tokens)


# --- links and groups of a block --------------------------------------------------

class Block:
    """Both tokenizations of some texts. ``a_ids``, ``b_ids`` and their owners
    hold the tokens of texts whose joined bytes equal blank + text."""

    def __init__(self, texts: list[str], load):
        (encode_a, voc_a), (encode_b, voc_b) = load
        self.n = len(texts)
        some = [i for i, t in enumerate(texts) if t]
        want = [b" " + texts[i].encode() for i in some]
        a = [encode_a(" " + texts[i]) for i in some]
        b = [np.array(x, np.uint32) for x in encode_b([texts[i] for i in some])] if some else []
        good = []
        for k in range(len(some)):
            size = len(want[k])
            if voc_a.size[a[k]].sum() == size and voc_b.size[b[k]].sum() == size:
                good.append(k)
        if good:
            wanted = np.frombuffer(b"".join(want[k] for k in good), np.uint8)
            ends = np.cumsum([len(want[k]) for k in good])
            wrong = np.zeros(len(good), bool)
            for voc, ids in ((voc_a, a), (voc_b, b)):
                off = np.flatnonzero(voc.joined(np.concatenate([ids[k] for k in good])) != wanted)
                wrong[np.searchsorted(ends, off, side="right")] = True
            good = [k for k, w in zip(good, wrong.tolist(), strict=True) if not w]
        none = np.zeros(0, np.uint32)
        self.rows = np.array([some[k] for k in good], np.int64)
        self.n_a = np.array([len(a[k]) for k in good], np.int64)
        self.n_b = np.array([len(b[k]) for k in good], np.int64)
        self.a_ids = np.concatenate([none, *[a[k] for k in good]]).astype(np.int64)
        self.b_ids = np.concatenate([none, *[b[k] for k in good]]).astype(np.int64)
        self.a_ends, self.b_ends = np.cumsum(voc_a.size[self.a_ids]), np.cumsum(voc_b.size[self.b_ids])
        at = np.searchsorted(self.a_ends, self.b_ends)
        at = np.minimum(at, max(0, len(self.a_ends) - 1))
        self.b_cut = self.a_ends[at] == self.b_ends if len(at) else np.zeros(0, bool)
        self.a_cut = np.zeros(len(self.a_ids), bool)
        self.a_cut[at[self.b_cut]] = True
        doc_of_b = np.repeat(np.arange(len(good)), self.n_b)
        self.n_groups = np.bincount(doc_of_b[self.b_cut], minlength=len(good)).astype(np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(A id, B id, row) of every overlapping pair of tokens: one for each
        stretch between neighbouring token ends."""
        ends = np.sort(np.concatenate([self.a_ends, self.b_ends[~self.b_cut]]), kind="stable")
        i = np.searchsorted(self.a_ends, ends)
        j = np.searchsorted(self.b_ends, ends)
        row = np.repeat(self.rows, self.n_a)
        return self.a_ids[i], self.b_ids[j], row[i]

    def digests(self) -> list[str]:
        """Hex SHA-256 of ``a1,a2|b1;a3|b2,b3`` for every row of the block, ''
        for a row without tokens. The decimals of all rows are written into
        one buffer, digit by digit."""
        na, nb = len(self.a_ids), len(self.b_ids)
        out = [""] * self.n
        if not na:
            return out
        group_a = np.cumsum(self.a_cut) - self.a_cut
        group_b = np.cumsum(self.b_cut) - self.b_cut
        a_until = np.searchsorted(group_a, group_b, side="right")     # A tokens up to the B token's group
        b_before = np.searchsorted(group_b, group_a, side="left")
        at_a, at_b = np.arange(na) + b_before, np.arange(nb) + a_until
        ids, mark = np.empty(na + nb, np.int64), np.empty(na + nb, np.uint8)
        ids[at_a], ids[at_b] = self.a_ids, self.b_ids
        mark[at_a] = np.where(self.a_cut, ord("|"), ord(","))
        mark[at_b] = np.where(self.b_cut, ord(";"), ord(","))
        digits = np.ones(na + nb, np.int64)
        for p in range(1, 6):
            digits += ids >= 10 ** p
        stop = np.cumsum(digits + 1)
        text = np.empty(int(stop[-1]), np.uint8)
        text[stop - 1] = mark
        for p in range(6):
            has = digits > p
            text[stop[has] - 2 - p] = ord("0") + ids[has] // 10 ** p % 10
        ends = stop[np.cumsum(self.n_a + self.n_b) - 1].tolist()
        view, start = memoryview(text), 0
        for row, end in zip(self.rows.tolist(), ends, strict=True):
            out[row] = hashlib.sha256(view[start:end - 1]).hexdigest()
            start = end
        return out


# --- compressed arrays --------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as one zstd frame, byte planes apart (the high ones are
    nearly all zero)."""
    parts = [np.array([len(arrays)] + [x for a in arrays for x in (a.dtype.itemsize, len(a))], "<i8").tobytes()]
    for a in arrays:
        parts.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(frame: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(frame)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist()
    out, at = [], 8 + 16 * n
    for width, length in sizes:
        planes = np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}"))
        at += width * length
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=0).astype(np.uint64)


def _keys(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.astype(np.int64))


# --- runs ------------------------------------------------------------------------------

def radix_of(b_ids: np.ndarray) -> np.ndarray:
    return (mix((b_ids.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLD)) % np.uint64(RADIXES)).astype(np.int64)


class RunSet:
    """Links of one task until they are spilled as one run per radix."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.links, self.docs = 0, 0

    def add(self, block: Block) -> None:
        a, b, row = block.links()
        self.parts.append((((radix_of(b) << _ID_BITS | b) << _ID_BITS | a) << _DOC_BITS) | (self.docs + row))
        self.links += len(a)
        self.docs += block.n

    def spill(self) -> Iterator[tuple[int, int, list[bytes], bytes]]:
        """(radix, links, head frames, body) of every radix with links."""
        records = np.sort(np.concatenate(self.parts)) if self.parts else np.zeros(0, np.int64)
        self.__init__()
        if not len(records):
            return
        first = np.flatnonzero(np.concatenate(([True], records[1:] != records[:-1])))
        times = np.diff(np.append(first, len(records)))
        records = records[first]
        pair = records >> _DOC_BITS
        place = (records & ((1 << _DOC_BITS) - 1)).astype(np.uint32)
        head = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        radix = pair[head] >> 2 * _ID_BITS
        bounds = np.searchsorted(radix, np.arange(RADIXES + 1))
        until = np.append(head, len(records))
        count = np.add.reduceat(times, head)
        key = pair[head] & ((1 << 2 * _ID_BITS) - 1)
        for r in range(RADIXES):
            x, y = int(bounds[r]), int(bounds[r + 1])
            if x < y:
                lo, hi = int(until[x]), int(until[y])
                frames = [pack(_steps(key[i:min(i + FRAME, y)]), count[i:min(i + FRAME, y)].astype(np.uint64))
                          for i in range(x, y, FRAME)]
                docs_of = np.diff(until[x:y + 1]).astype(np.uint32)
                yield r, int(times[lo:hi].sum()), frames, pack(docs_of, place[lo:hi], times[lo:hi].astype(np.uint32))


_RUN = [("__set", "long"), ("__place", "int"), ("__radix", "int"), ("__links", "long"),
        ("__head", "array<binary>"), ("__body", "binary")]
_FOUND = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups_sha256", "string")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
          "array<binary>": pa.list_(pa.binary())}


def _align(a_path: str, b_path: str, text_at: int, passed: list[int],
           batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: documents (no radix) and spilled runs."""
    from pyspark import TaskContext

    load = load_a(a_path), load_b(b_path)
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    runs, fields = RunSet(), None

    def spilled() -> Iterator[pa.RecordBatch]:
        nonlocal number
        rows = list(runs.spill())
        if rows:
            cols = {"__set": [number] * len(rows), "__place": [None] * len(rows), "__radix": [r[0] for r in rows],
                    "__links": [r[1] for r in rows], "__head": [r[2] for r in rows], "__body": [r[3] for r in rows]}
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), f.type) for f in fields]
                + [pa.array(cols[n], _ARROW[t]) for n, t in _RUN]
                + [pa.nulls(len(rows), _ARROW[t]) for _, t in _FOUND], names=names)
        number += 1

    for batch in batches:
        fields = [batch.schema.field(c) for c in passed]
        names = [f.name for f in fields] + [n for n, _ in _RUN + _FOUND]
        for a, b, _, _ in text_blocks(batch.column(text_at)):
            if runs.docs + (b - a) > DOCS or runs.links >= RECORDS:
                yield from spilled()
            block = Block([t or "" for t in batch.column(text_at).slice(a, b - a).to_pylist()], load)
            place = runs.docs
            runs.add(block)
            found = np.zeros((3, b - a), np.int64)
            found[:, block.rows] = block.n_a, block.n_b, block.n_groups
            n = b - a
            run = [pa.array(np.full(n, number), pa.int64()), pa.array(np.arange(place, place + n), pa.int32()),
                   *[pa.nulls(n, _ARROW[t]) for _, t in _RUN[2:]]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(a, n) for c in passed] + run
                + [pa.array(x) for x in (*found, found[0] + found[1] - found[2])]
                + [pa.array(block.digests(), pa.string())], names=names)
    if fields is not None:
        yield from spilled()
    tidy()


# --- counting pairs: k-way merge of heads ---------------------------------------------------

def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Heads merged in pair order, counts of equal pairs added: a heap holds
    the last pair of every run's open frame, and all pairs up to the smallest
    of these are complete."""
    todo = [iter(r) for r in runs]
    open_: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(runs)
    heap: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        frame = next(todo[i], None)
        if frame is None:
            open_[i] = None
            return
        steps, count = unpack(frame)
        open_[i] = _keys(steps), count.astype(np.int64)
        heapq.heappush(heap, (int(open_[i][0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while heap:
        bound = heap[0][0]
        keys, counts = [], []
        for i, held in enumerate(open_):
            if held is not None:
                cut = int(np.searchsorted(held[0], bound, side="right"))
                keys.append(held[0][:cut])
                counts.append(held[1][:cut])
                open_[i] = held[0][cut:], held[1][cut:]
        while heap and heap[0][0] == bound:
            advance(heapq.heappop(heap)[1])
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        yield key[first], np.add.reduceat(count, first)


def with_best(blocks: Iterator[tuple[np.ndarray, np.ndarray]]
              ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (pair, count, is it the highest of its B id): pairs come B id
    by B id, the last one of a block waits for the next block."""
    key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def flagged(k: np.ndarray, c: np.ndarray):
        b = k >> _ID_BITS
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        top = np.repeat(np.maximum.reduceat(c, first), np.diff(np.append(first, len(b))))
        return k, c, c == top

    for k, c in blocks:
        key, count = np.concatenate((key, k)), np.concatenate((count, c))
        cut = int(np.searchsorted(key, (key[-1] >> _ID_BITS) << _ID_BITS))
        if cut:
            yield flagged(key[:cut], count[:cut])
            key, count = key[cut:], count[cut:]
    if len(key):
        yield flagged(key, count)


def _grouped(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of a sorted stream, by equal values of ``by``."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = tuple(row[c] for c in by)
            if rows and k != key:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


def _merge(last: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, group), rows in _grouped(batches, ["__radix", "__group"]):
        heads = [r["__head"] for r in rows]
        if last:
            frames = [pack(_steps(k), c.astype(np.uint64), b.astype(np.uint8)) for k, c, b in with_best(merged(heads))]
        elif len(heads) == 1:
            frames = heads[0]
        else:
            frames = [pack(_steps(k), c.astype(np.uint64)) for k, c in merged(heads)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([radix], pa.int32()), pa.array([group], pa.int64()),
             pa.array([frames], pa.list_(pa.binary()))], names=["__radix", "__group", "__head"])


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pair_counts(runs: DataFrame, sets: int) -> DataFrame:
    """One row per radix: its pairs with count and best flag, as frames.
    ``sets`` is the number of run sets; ``FAN`` heads meet at a time."""
    heads = runs.select("__radix", F.col("__set").alias("__group"), "__head")
    left = max(1, sets)
    while True:
        left = -(-left // FAN)
        key = F.pmod(F.xxhash64("__group"), F.lit(left)) if left > 1 else F.lit(0).cast("long")
        heads = (heads.withColumn("__group", key).repartition(_parts(runs), "__radix", "__group")
                 .sortWithinPartitions("__radix", "__group")
                 .mapInArrow(partial(_merge, left == 1), "__radix int, __group long, __head array<binary>"))
        if left == 1:
            return heads.select("__radix", "__head")


# --- shares of the documents ---------------------------------------------------------------

def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: the counted pairs of a radix, then its runs. Each run gives
    the sums of its run set's documents."""
    at, key, count, best = None, None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["__body"] is None:
                at = row["__radix"]
                parts = [unpack(f) for f in row["__head"]]
                key = np.concatenate([_keys(p[0]) for p in parts])
                count = np.concatenate([p[1].astype(np.int64) for p in parts])
                best = np.concatenate([p[2].astype(np.int64) for p in parts])
                continue
            if at != row["__radix"]:
                raise RuntimeError("a run without the counts of its radix")
            mine = np.concatenate([_keys(unpack(f)[0]) for f in row["__head"]])
            docs_of, place, times = (x.astype(np.int64) for x in unpack(row["__body"]))
            spot = np.repeat(np.searchsorted(key, mine), docs_of)
            total = np.zeros(int(place.max()) + 1, np.int64)
            top = np.zeros(len(total), np.int64)
            np.add.at(total, place, count[spot] * times)
            np.add.at(top, place, best[spot] * times)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["__set"]], pa.int64()),
                 pa.array([pack(total.astype(np.uint64), top.astype(np.uint32))], pa.binary())],
                names=["__set", "__body"])


def _add_shares(passed: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows: the arrays of a run set, then its documents."""
    at, total, top = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def grown(x: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate((x, np.zeros(max(0, n - len(x)), np.int64)))

    for batch in batches:
        sets = batch.column("__set").to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], sets[1:] != sets[:-1]))).tolist() + [len(sets)]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if y == x:
                continue
            if sets[x] != at:
                at, total, top = int(sets[x]), np.zeros(0, np.int64), np.zeros(0, np.int64)
            part = batch.slice(x, y - x)
            docs = part.column("__body").is_null().to_numpy(zero_copy_only=False)
            for frame in part.column("__body").filter(pa.array(~docs)).to_pylist():
                t, b = unpack(frame)
                total, top = grown(total, len(t)), grown(top, len(b))
                total[:len(t)] += t.astype(np.int64)
                top[:len(b)] += b.astype(np.int64)
            part = part.filter(pa.array(docs))
            if part.num_rows:
                place = part.column("__place").to_numpy()
                total, top = grown(total, int(place.max()) + 1), grown(top, int(place.max()) + 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in passed] + [pa.array(top[place]), pa.array(total[place])],
                    names=[*passed, "n_best", "count_sum"])


def align(df: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """``df(text, ...)`` without ``text``, plus ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups_sha256``, ``n_best`` and ``count_sum``.

    One row per row; repeated rows count as often as they stand. A null or empty
    text, and one whose joined tokens differ from a blank and the text (such
    as a text with U+2581), has no tokens: zeros and an empty digest, and it
    adds nothing to any pair. Ties for the highest count of a B id are all
    best. Texts are taken whole whatever their length; an empty table gives an
    empty one. Columns of the names above are replaced, those that begin with
    ``__`` are this module's own; all others pass through.
    """
    own = [n for n, _ in _FOUND] + ["n_best", "count_sum"] + [n for n, _ in _RUN]
    df = df.drop(*own)
    names = df.columns
    text_at = names.index("text")
    passed = [i for i in range(len(names)) if i != text_at]
    fields = [f"`{df.schema[i].name}` {df.schema[i].dataType.simpleString()}" for i in passed]
    own_fields = [f"{n} {t}" for n, t in _RUN + _FOUND]
    spilled, run_path = staged(df.mapInArrow(partial(_align, a_path, b_path, text_at, passed),
                                      ", ".join(fields + own_fields)), "token-runs")
    runs = spilled.where("__radix is not null").select("__set", "__radix", "__links", "__head", "__body")
    heavy = runs.groupBy("__radix").agg(F.sum("__links").alias("n"), F.count("*").alias("sets")).collect()
    salts = df.sparkSession.createDataFrame(                            # at most RADIXES rows
        [(r["__radix"], -(-r["n"] // GROUP)) for r in heavy], "__radix int, __salts long")
    counted, pair_path = staged(pair_counts(runs, max([r["sets"] for r in heavy], default=0)), "token-pairs")
    counts = (counted.join(F.broadcast(salts), "__radix")
              .select("__radix", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1)).alias("__salt"),
                      F.lit(None).cast("long").alias("__set"), "__head", F.lit(None).cast("binary").alias("__body")))
    salted = (runs.join(F.broadcast(salts), "__radix")
              .select("__radix", F.pmod(F.xxhash64("__set"), "__salts").alias("__salt"), "__set", "__head", "__body"))
    shares = (counts.unionByName(salted).repartition(_parts(df), "__radix", "__salt")
              .sortWithinPartitions("__radix", "__salt", F.col("__set").asc_nulls_first())
              .mapInArrow(_shares, "__set long, __body binary"))
    docs = spilled.where("__radix is null").drop("__radix", "__links", "__head", "__body")
    keep = [names[i] for i in passed] + [n for n, _ in _FOUND]
    out, _ = staged(docs.unionByName(shares, allowMissingColumns=True).repartition(_parts(df), "__set")
                    .sortWithinPartitions("__set", F.col("__place").asc_nulls_first())
                    .mapInArrow(partial(_add_shares, keep), ", ".join(
                        [*fields, *[f"{n} {t}" for n, t in _FOUND], "n_best long, count_sum long"])), "aligned")
    release(df.sparkSession, run_path, pair_path)
    return out
