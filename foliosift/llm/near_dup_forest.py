"""Operator 5, n-gram Jaccard join by a MinHash LSH forest.

Texts are sets of ``width``-word shingles (lower case, split at white space; a shorter text
is one shingle). Texts are linked when their sets have a Jaccard similarity of ``threshold``
or more; classes are the connected components of the links.

1. Texts with the same set are one node (a copy is a link by itself); each node has a MinHash
   signature, cut into ``trees`` strings of up to ``_DEPTH`` symbols.
2. Every tree is a trie of sorted strings. From the full length the matched prefix is
   shortened symbol by symbol until a pair at the threshold shares one in some tree with the
   target recall: 1 - (1 - threshold^depth)^trees. That depends on the parameters alone, and
   with those of production the full length of 6 symbols is enough: nothing is shortened.
3. Within a matched prefix, signatures are compared (a margin below the threshold) and only a
   spanning forest of the likely links leaves the task. Its components are the clusters.
4. In a cluster, every pair of nodes is compared exactly on the whole shingle sets. Again only
   counts and a spanning forest of the exact links leave the task. Its components are the
   classes. Links within a cluster are counted exactly, those between clusters do not exist
   but for the recall of steps 2 and 3.

A matched prefix or cluster above ``block`` nodes is dealt to pairs of blocks, so no task
holds more than two blocks, and rows grow as n * n / block only for such a group, while pairs
never become rows. Copies never meet: groups of copies with a third of all rows are combined
before the shuffle.

Null and empty texts, or of white space only, have no shingles: they link to nothing and are
classes of their own. Null and repeated ids count row by row. Extra columns are ignored by
``classes`` and kept by ``keep_one``. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import fresh_name, quoted, require_columns, row_key
from foliosift.llm.graph import components
from foliosift.session import materialise

#: The white space that ``str.split`` cuts at.
WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: Longest prefix of a tree, in symbols of 16 bits.
_DEPTH = 6
#: Standard deviations that a signature's estimate may lie below the threshold.
_MARGIN = 3.5
_KNOWN_WORDS = 200_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


class _WordHashes(dict):
    """64-bit hashes of words, remembered while they fit."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingles(text: str | None, hashes: _WordHashes, width: int) -> np.ndarray:
    """The sorted set of a text's shingles as 64-bit hashes."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(width, len(own))
    n = len(own) - size + 1
    mixed = np.full(n, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ own[k : n + k]) * np.uint64(_MULTIPLIERS[k % len(_MULTIPLIERS)])
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(found: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash symbols of 16 bits."""
    rng = np.random.default_rng(20_251)
    factors = rng.integers(1 << 31, size=count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(1 << 32, size=count, dtype=np.uint32)
    keys = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(keys), 4096):
        least = np.minimum(least, (keys[None, at : at + 4096] * factors[:, None] + shifts[:, None]).min(axis=1))
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2")


def prefix_depth(threshold: float, trees: int, recall: float) -> int:
    """Shorten the prefix until pairs at the threshold share one with the target recall."""
    for depth in range(_DEPTH, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    raise ValueError(f"{trees} trees cannot reach a recall of {recall} at {threshold}")


def _merge(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch | pa.Table]]:
    """Tables of whole groups: rows come sorted by their first ``keys`` columns, and a group
    may run over batches."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now]).combine_chunks()
        if not held.num_rows:
            continue
        starts = _starts(held, keys)
        if len(starts) > 1:
            yield held.slice(0, starts[-1])
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    """Where groups begin."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _fixed(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _block_pairs(rows: DataFrame, size: str, node: str, block: int) -> DataFrame:
    """``rows`` once for every pair of blocks (low, high) that its own block is part of;
    ``part`` is the own block. Groups up to ``block`` have one block."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(node), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("part", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("part", "other").cast("int"))
        .withColumn("high", F.greatest("part", "other").cast("int"))
    )


def _sets(docs: DataFrame, text_col: str, width: int, symbols: int) -> DataFrame:
    """``docs`` plus set_key (null: no shingles) and signature."""

    @F.pandas_udf("set_key binary, signature binary")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for texts in batches:
            keys, signatures = [], []
            for text in texts:
                found = shingles(text, hashes, width)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found, symbols).tobytes() if len(found) and symbols else None)
            yield pd.DataFrame({"set_key": keys, "signature": signatures})

    return docs.withColumn("found", describe.asNondeterministic()(F.col(text_col)))


def _likely_links(nodes: DataFrame, trees: int, depth: int, lowest: float, block: int) -> DataFrame:
    """(a, b) of a spanning forest of the likely links under each matched prefix."""
    size = 2 * _DEPTH
    labels = F.explode(
        F.array(*[F.struct(F.lit(t).alias("tree"), F.expr(f"substring(signature, {t * size + 1}, {2 * depth})").alias("prefix")) for t in range(trees)])
    )
    labelled = nodes.select("node", labels.alias("l")).select("node", "l.tree", "l.prefix")
    shared = labelled.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = labelled.join(shared, ["tree", "prefix"]).join(nodes.select("node", "signature"), "node")
    dealt = _block_pairs(member, "n", "node", block)
    tail = F.expr(f"substring(signature, tree * {size} + 1, {size})").alias("string")
    keys = ["tree", "prefix", "low", "high"]
    dealt = dealt.select(*keys, "part", tail, "node", "signature").repartition(*keys).sortWithinPartitions(*keys, "string", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 4):
            starts = _starts(table, 4)
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            part, cross = table.column("part").to_numpy(), table.column("low").to_numpy() != table.column("high").to_numpy()
            symbols = _fixed(table.column("signature"), ">u2")
            names = table.column("node").to_pylist()
            least = np.ceil(lowest * symbols.shape[1])
            found_a, found_b = [], []
            for step in range(1, int(np.diff(np.append(starts, table.num_rows)).max())):
                first = np.flatnonzero(group[:-step] == group[step:])
                first = first[~(cross[first] & (part[first] == part[first + step]))]
                for at in range(0, len(first), 8192):
                    a = first[at : at + 8192]
                    a = a[(symbols[a] == symbols[a + step]).sum(axis=1) >= least]
                    found_a.append(a)
                    found_b.append(a + step)
            if not found_a:
                continue
            root = _merge(table.num_rows, np.concatenate(found_a), np.concatenate(found_b))
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                a, b = [names[i] for i in moved], [names[i] for i in root[moved]]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(compare, "a binary, b binary")


def _exact_links(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b, texts, rows): of each node its exact links in a pair of blocks, counted by
    distinct texts' sets and by rows, and a link of the spanning forest (or itself)."""
    keys = ["cluster", "low", "high"]
    dealt = _block_pairs(members, "n", "node", block).select(*keys, "part", "node", "copies", "sets")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "part", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            names, copies = table.column("node").to_pylist(), table.column("copies").to_numpy()
            part, sets = table.column("part").to_numpy(), table.column("sets").to_pylist()
            low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
            bounds = np.append(_starts(table, 3), table.num_rows)
            out: list[tuple] = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a < 2:
                    continue
                # Within one block all pairs count, between two blocks those across.
                split = b - a if low[a] == high[a] else int((part[a:b] == low[a]).sum())
                linked = _linked([np.frombuffer(x, np.uint64) for x in sets[a:b]], split, threshold)
                texts, rows = linked.sum(axis=1), linked @ copies[a:b]
                x, y = np.nonzero(np.triu(linked))
                root = _merge(b - a, x, y)
                out += [(names[a + i], names[a + root[i]], int(texts[i]), int(rows[i])) for i in np.flatnonzero(texts)]
            if out:
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
                arrays = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "texts", "rows"])

    return dealt.mapInArrow(compare, "a binary, b binary, texts bigint, rows bigint")


def _linked(sets: list[np.ndarray], split: int, threshold: float) -> np.ndarray:
    """Which sets are similar: all pairs if ``split`` is their number, else those between the
    first ``split`` and the rest. Common elements are counted by matrix products over slices
    of the elements that occur more than once."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values, which, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = seen[which] > 1
    number = np.cumsum(seen > 1) - 1
    owner, which = owner[often], number[which[often]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    common = np.zeros((n, n), np.float32)
    width = 4096
    for at in range(0, int(which[-1]) + 1 if len(which) else 0, width):
        lo, hi = np.searchsorted(which, (at, at + width))
        here = np.zeros((n, min(width, int(which[hi - 1]) - at + 1)), np.float32)
        here[owner[lo:hi], which[lo:hi] - at] = 1
        if split == n:
            common += here @ here.T
        else:
            common[:split, split:] += here[:split] @ here[split:].T
    if split < n:
        common[split:, :split] = common[:split, split:].T
    both = sizes[:, None] + sizes[None] - common
    linked = common >= threshold * both - 1e-6
    linked &= common > 0
    np.fill_diagonal(linked, False)
    return linked


def _with_classes(
    docs: DataFrame, text_col: str, width: int, threshold: float, trees: int, recall: float, block: int
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (needs id, text; other columns stay, but for the text) with
    set_key, and per set_key: class_key, own, texts, linked rows."""
    depth = prefix_depth(threshold, trees, recall)
    symbols = trees * _DEPTH
    lowest = max(0.0, threshold - _MARGIN * (threshold * (1 - threshold) / symbols) ** 0.5)
    keyed = docs.withColumns({"k1": F.xxhash64(text_col), "k2": F.xxhash64(text_col, F.lit(1))})
    rows = _sets(keyed, text_col, width, symbols).select("*", "found.set_key", "found.signature").drop("found", text_col)
    rows = materialise(rows, "near-rows")
    nodes = materialise(
        rows.where("set_key IS NOT NULL")
        .groupBy(F.col("set_key").alias("node"))
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("k1", "k2")).alias("k"),
            F.min("signature").alias("signature"),
        ),
        "near-nodes",
    )
    likely = components(_likely_links(nodes, trees, depth, lowest, block))
    clusters = materialise(likely.select("node", F.col("root").alias("cluster")), "near-clusters")
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    wanted = clusters.join(sizes, "cluster").join(nodes.select("node", "copies", "k"), "node")
    # One text for every node: copies are combined before the shuffle.
    texts = keyed.groupBy("k1", "k2").agg(F.first(text_col).alias("text"))
    asked = wanted.select("cluster", "n", "node", "copies", F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2"))

    @F.pandas_udf("binary")
    def whole_sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = _WordHashes()
        for some in batches:
            yield pd.Series([shingles(t, hashes, width).tobytes() for t in some], dtype=object)

    members = texts.join(asked, ["k1", "k2"]).select("cluster", "n", "node", "copies", whole_sets("text").alias("sets"))
    exact = materialise(_exact_links(members, threshold, block), "near-links")
    counts = exact.groupBy(F.col("a").alias("node")).agg(F.sum("texts").alias("texts"), F.sum("rows").alias("linked"))
    classes = components(exact.select("a", "b"))
    found = (
        nodes.select("node", "copies")
        .join(counts, "node", "left")
        .join(classes, "node", "left")
        .select(
            F.col("node").alias("set_key"),
            F.coalesce("root", "node").alias("class_key"),
            "copies",
            F.coalesce("texts", F.lit(0)).alias("texts"),
            F.coalesce("linked", F.lit(0)).alias("linked"),
        )
    )
    return rows, found


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    trees: int = 20,
    recall: float = 0.995,
    block: int = 256,
) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of the class), class_size,
    n_links (other rows with a similar or equal set), n_linked_texts (other sets)."""
    require_columns(docs, id_col, text_col)
    plain = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    rows, found = _with_classes(plain, "text", width, threshold, trees, recall, block)
    own = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    of_class = (
        found.join(own, "set_key")
        .groupBy("class_key")
        .agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    )
    # Written, so that both sides of the last join are plain and Spark can split a group of copies.
    answers = materialise(found.join(of_class, "class_key").drop("class_key"), "near-classes")
    return rows.join(answers, "set_key", "left").select(
        "doc_id",
        F.coalesce("class_id", F.when(F.col("set_key").isNull(), F.col("doc_id"))).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    trees: int = 20,
    recall: float = 0.995,
    block: int = 256,
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest id
    (null last; then the smallest hash of the whole row). Texts without shingles stay."""
    require_columns(docs, id_col, text_col)
    order = F.struct(quoted(id_col).isNull().alias("n"), quoted(id_col).alias("id"), row_key(docs).alias("h"))
    plain = docs.select(order.alias("order"), quoted(text_col).alias("text"))
    rows, found = _with_classes(plain, "text", width, threshold, trees, recall, block)
    first = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("order").alias("order"), F.min_by(F.struct("k1", "k2"), "order").alias("k")
    )
    kept = (
        first.join(found.select("set_key", "class_key"), "set_key")
        .groupBy("class_key")
        .agg(F.min("order").alias("order"), F.min_by("k", "order").alias("k"))
    )
    kept = materialise(kept.select("order", "k.k1", "k.k2"), "near-kept")
    row, mark, k1, k2 = (fresh_name(docs, n) for n in ("row", "order", "k1", "k2"))
    packed = docs.select(
        order.alias(mark), F.xxhash64(quoted(text_col)).alias(k1), F.xxhash64(quoted(text_col), F.lit(1)).alias(k2),
        F.struct(*[quoted(c) for c in docs.columns]).alias(row),
    )
    wordless = F.length(F.regexp_replace(F.coalesce(F.col(row)[text_col], F.lit("")), WHITE, "")) == 0
    stay = packed.join(
        kept.select(F.col("order").alias("o"), F.col("k1").alias("t1"), F.col("k2").alias("t2")),
        (F.col(k1) == F.col("t1")) & (F.col(k2) == F.col("t2")) & F.col(mark)["id"].eqNullSafe(F.col("o.id")) & (F.col(mark)["h"] == F.col("o.h")),
    )
    # Rows equal in every column have one place in the order: one of them stays.
    one = stay.groupBy(k1, k2, mark).agg(F.first(row).alias(row))
    return one.unionByName(packed.where(wordless)).select(*[F.col(row)[c].alias(c) for c in docs.columns])
