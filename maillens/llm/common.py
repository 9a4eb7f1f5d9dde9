"""Shared pieces of the training-data operators: tables, staged results,
block-wise Arrow reading, 64-bit mixing and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maillens.session import scratch_path

BLOCK_BYTES = 1 << 19      # text bytes that one numpy block holds (a longer text: alone)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the cluster's shared folder and read it again.

    Cuts the lineage: executors lost later cost nothing, and the columns a
    later step does not name are not read. Returns the table and its path.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that no later step reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


BROADCAST_IDS = 1_000_000      # ids that may be broadcast: 16 MB at most


def rows_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the one-column table ``ids``: a
    broadcast while ids are counted and few, a shuffled join beyond that."""
    ids, _ = staged(ids, "ids")
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


# --- 64-bit mixing (splitmix finaliser), numpy arrays wrap around ----------

GOLD = 0x9E3779B97F4A7C15
M1 = 0xBF58476D1CE4E5B9
M2 = 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise uint64 values; ``x`` is not changed."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(M1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(M2)
    x ^= x >> np.uint64(31)
    return x


def mix_int(x: int) -> int:
    """The same for one Python integer."""
    x &= 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * M1) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * M2) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


# --- pattern matches with positions, in SQL expressions -----------------------

NO_MATCHES = "array<struct<start:int,end:int,text:string,before:string,after:string>>"
_MARKS = ("\ue000", "\uf8ff", "\U000f0000")    # private characters: one that the text lacks marks its matches
_FOLD = 32                                     # matches whose positions are added up in one array


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once (a lambda's variable)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str) -> Column:
    """Every match as (start, end, text, before, after), in code points.

    The pattern runs once: it puts marks around its matches, and the text is
    cut at them into gap, match, gap, ... Positions add up within blocks of
    ``_FOLD`` matches, then the blocks' lengths, so the time grows with the
    text and its matches alone. A text that holds all marks itself is
    searched and split by the pattern instead.
    """
    mark = F.when(F.instr(text, _MARKS[0]) == 0, _MARKS[0])
    for m in _MARKS[1:]:
        mark = mark.when(F.instr(text, m) == 0, m)
    marked = bound(mark, lambda m: F.split(F.regexp_replace(text, F.lit(pattern), F.concat(m, F.lit("$0"), m)), m, -1))
    plain = F.flatten(F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("g"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("t")),
        lambda x: F.array(x["g"], F.coalesce(x["t"], F.lit("")))))
    none = F.array().cast(NO_MATCHES)

    def placed(parts: Column) -> Column:
        """Matches of one block, positions from the block's begin."""
        cells = F.transform(F.sequence(F.lit(1), F.floor((F.size(parts) - 1) / 2).cast("int")), lambda i: F.struct(
            F.get(parts, 2 * i - 2).alias("gap"), F.get(parts, 2 * i - 1).alias("text"),
            F.get(parts, 2 * i).alias("rest")))

        def step(acc: Column, m: Column) -> Column:
            begin = acc["at"] + F.length(m["gap"])
            end = begin + F.length(m["text"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
                begin.alias("start"), end.alias("end"), m["text"].alias("text"),
                F.right(m["gap"], F.lit(40)).alias("before"),
                F.left(m["rest"], F.lit(1)).alias("after")))).alias("out"))

        return F.aggregate(cells, F.struct(F.lit(0).alias("at"), none.alias("out")), step)

    def listed(pieces: Column) -> Column:
        n = F.floor((F.size(pieces) - 1) / 2).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _FOLD).cast("int")), lambda b: placed(
            F.slice(pieces, 2 * _FOLD * b + 1, F.least(F.lit(2 * _FOLD), 2 * (n - _FOLD * b)) + 1)))

        def shifted(folded: Column) -> Column:
            offsets = F.aggregate(
                folded, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                lambda acc, f: F.struct((acc["at"] + f["at"]).alias("at"),
                                        F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                lambda acc: acc["out"])
            return F.flatten(F.zip_with(folded, offsets, lambda f, o: F.transform(f["out"], lambda m: F.struct(
                (m["start"] + o).alias("start"), (m["end"] + o).alias("end"), m["text"].alias("text"),
                m["before"].alias("before"), m["after"].alias("after")))))

        return F.when(n > 0, bound(blocks, shifted)).otherwise(none)

    return bound(F.when(mark.isNotNull(), marked).otherwise(plain), listed)


# --- memory of Python workers ------------------------------------------------

def tidy() -> None:
    """Give freed memory back to the system: a reused worker otherwise keeps
    the peak of every step it has run, next to the JVM's heap."""
    import ctypes

    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


# --- Arrow text columns as byte blocks --------------------------------------

def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column into (first row, last row + 1, bytes, offsets).

    ``offsets`` has one entry more than the block has rows and starts at 0;
    a null is an empty text. Whole texts only: a text longer than
    ``block_bytes`` is a block of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = (np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None
            else np.zeros(0, np.uint8))
    a, n = 0, len(column)
    while a < n:
        b = int(np.searchsorted(off, off[a] + block_bytes, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


# --- connected components ---------------------------------------------------

def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's links; emits member -> root links."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rx, ry = find(x), find(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
    nodes = [x for x in parent if find(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i:i + 50_000]
        yield pa.record_batch({"a": pa.array([find(x) for x in part], pa.int64()),
                               "b": pa.array(part, pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)`` (non-null longs).

    Returns ``(node, component)`` for every node with a link to another one;
    the component is its smallest node. Union-find inside each partition
    leaves a forest of at most one link per node and partition; the rounds
    then contract every node into the neighbour with the smallest keyed hash
    (a new key each round, so chains shrink geometrically too). Every step
    is a partial aggregate or a join that Spark can split; links and labels
    stay in staged tables. Self-links and repeated links are harmless; an
    empty input gives an empty result.
    """
    spark = links.sparkSession
    edges, path = staged(links.select(F.col("a").cast("long"), F.col("b").cast("long"))
                         .where("a != b").mapInArrow(_local_forest, "a long, b long"), "links")
    assign, assign_path = None, None
    spent = [path]
    key = 0
    while not edges.isEmpty():
        key += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.xxhash64(F.lit(key), c)
        best = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("h"), F.col("b"))).alias("m"))
        hooks, hook_path = staged(best.select(
            F.col("a").alias("u"),
            F.when(F.col("m.h") < rank("a"), F.col("m.b")).otherwise(F.col("a")).alias("p")), "hooks")
        if assign is None:
            nxt = hooks.select(F.col("u").alias("node"), F.col("p").alias("rep"))
        else:
            nxt = (assign.join(hooks, assign["rep"] == hooks["u"], "left")
                   .select("node", F.coalesce("p", "rep").alias("rep")))
        new_assign, new_path = staged(nxt, "assign")
        h2 = hooks.select(F.col("u").alias("u2"), F.col("p").alias("p2"))
        moved = (edges.join(hooks, edges["a"] == hooks["u"]).select("b", "p")
                 .join(h2, F.col("b") == F.col("u2"))
                 .select(F.col("p").alias("a"), F.col("p2").alias("b")).where("a != b"))
        edges, path = staged(moved.mapInArrow(_local_forest, "a long, b long"), "links")
        release(spark, hook_path, *spent, *([assign_path] if assign_path else []))
        assign, assign_path, spent = new_assign, new_path, [path]
    if assign is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    low = assign.groupBy("rep").agg(F.min("node").alias("component"))
    return assign.join(low, "rep").select("node", "component")
