"""Operator 1, SentencePiece encoding and decoding with N-best segmentation.

A text is a lattice of vocabulary pieces. The forward Viterbi scores of all positions are
exact heuristics for an A* search backward from the end: hypotheses leave the agenda in the
order of their full score, so the first N complete ones are the N best.

The lattice falls apart where no piece of the vocabulary can cross: before a run of spaces,
at line ends and between a letter and a mark that follows no letter inside any piece (looked
up in the vocabulary). Scores add up over such chunks, so distinct chunks are searched
once, short ones side by side as arrays, and the N best of a text combine those of its chunks; only the N - 1
chunks with the smallest loss to a second segmentation can differ from the best.

Scores are those of the vocabulary file. A unigram model's are log-probabilities; a BPE
model's are ranks of merges, so that the best sum of scores is not that model's own encoding.

Text form: one space before the text, spaces become U+2581, no other change (the vocabulary
must have an identity normaliser). Characters without a piece cost the smallest score minus
10 and are written as byte pieces. U+2581 itself reads as a space. Null gives null ids and no
alternatives, an empty text no ids. Whole texts of any length are encoded; input columns are
kept, new ones get an underscore in front where a name is taken.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain
from math import fsum, inf

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliosift.llm.common import fresh_name, require_columns

SPACE = "▁"
#: Where the public vocabulary lies; a parameter of every call.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Distinct chunks, and ids of theirs, that a task remembers before it starts afresh.
_CACHED = 400_000
_CACHED_IDS = 1 << 24
#: Rows worked on at once, and the length up to which chunks are searched side by side.
_SLICE = 512
_SIDE_BY_SIDE = 48

_EDIT = T.StructType(
    [T.StructField("at", T.IntegerType()), T.StructField("drop", T.IntegerType()), T.StructField("put", T.ArrayType(T.IntegerType()))]
)
ALTERNATIVES = T.ArrayType(
    T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(_EDIT))])
)


class Vocabulary:
    """Pieces and scores, readable without the library that made the file."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        """``byte_ids``: the 256 byte pieces in order; ids below their last are special."""
        self.pieces, self.byte_ids = pieces, byte_ids
        special = set(byte_ids) | {i for i, p in enumerate(pieces) if re.fullmatch(r"<.*>", p) and i < 3}
        self.known = {p: (i, scores[i]) for i, p in enumerate(pieces) if i not in special}
        self.unknown = min((s for _, s in self.known.values()), default=0.0) - 10.0
        self.longest = max(map(len, self.known), default=1)
        self.raw = [p.replace(SPACE, " ").encode() for p in pieces]
        for value, i in enumerate(byte_ids):
            self.raw[i] = bytes([value])
        for i in special - set(byte_ids):
            self.raw[i] = b""
        inside = {p[k : k + 2] for p in self.known for k in range(len(p) - 1)}
        self.apart = not any(a != SPACE and b == SPACE for a, b in inside) and not any("\n" in p for p in self.known)
        self.marks = "".join(m for m in ".,;:!?" if not any(b[1] == m and b[0].isalpha() for b in inside))

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ Ａ  x ") != "▁ﬁ▁Ａ▁▁x▁":
            raise ValueError("only vocabularies with an identity normaliser are supported")
        size = model.get_piece_size()
        byte_ids = [i for i in range(size) if model.is_byte(i)]
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        return cls([model.id_to_piece(i) for i in range(size)], [model.get_score(i) for i in range(size)], byte_ids)

    def pattern(self) -> re.Pattern[str]:
        """Cuts a text into chunks that no piece crosses."""
        if not self.apart:
            return re.compile(r"(?s).+")
        if not self.marks:
            return re.compile(r" *[^ \n]+| +|\n")
        m = re.escape(self.marks)
        letter = r"[^\W\d_]"
        return re.compile(rf"(?<={letter})[{m}][^ \n]*| *(?:[^ \n{m}]+|(?<!{letter})[{m}])+| +|\n")

    def lattice(self, chunk: str) -> list[tuple[int, int, float, tuple[int, ...]]]:
        """(from, to, score, ids), ordered by start."""
        known, longest, n = self.known, self.longest, len(chunk)
        arcs = []
        for i in range(n):
            if (x := known.get(chunk[i])) is None:
                raw = chunk[i].encode("utf-8", "surrogatepass")
                arcs.append((i, i + 1, self.unknown, tuple(self.byte_ids[b] for b in raw)))
            else:
                arcs.append((i, i + 1, x[1], (x[0],)))
            for j in range(i + 2, min(n, i + longest) + 1):
                if (x := known.get(chunk[i:j])) is not None:
                    arcs.append((i, j, x[1], (x[0],)))
        return arcs

    def best(self, chunk: str) -> tuple[tuple[int, ...], float, float]:
        """Ids and score of the best segmentation, and how much the second best loses."""
        chunk = chunk.replace(" ", SPACE)
        n, arcs = len(chunk), self.lattice(chunk)
        forward: list[float] = [0.0] + [-inf] * n
        back: list = [None] * (n + 1)
        for arc in arcs:
            s = forward[arc[0]] + arc[2]
            if s > forward[arc[1]]:
                forward[arc[1]] = s
                back[arc[1]] = arc
        on_path, at = [], n
        while at:
            on_path.append(back[at])
            at = back[at][0]
        second = -inf
        if len(arcs) > len(on_path):
            backward: list[float] = [-inf] * n + [0.0]
            path = {id(a) for a in on_path}
            for arc in reversed(arcs):
                s = arc[2] + backward[arc[1]]
                if s > backward[arc[0]]:
                    backward[arc[0]] = s
                if id(arc) not in path and (through := forward[arc[0]] + s) > second:
                    second = through
        return tuple(chain.from_iterable(a[3] for a in reversed(on_path))), forward[n], forward[n] - second

    def n_best(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """(score, ids) of the n best segmentations: A* backward, forward scores as heuristic.

        The heuristic is exact, so the hypotheses of one position come in the order of their
        own scores, and only the first n of them can be part of an answer: the rest are left,
        which bounds the agenda where very many segmentations tie. Hypotheses share tails."""
        chunk = chunk.replace(" ", SPACE)
        end, into = len(chunk), [[] for _ in range(len(chunk) + 1)]
        forward: list[float] = [0.0] + [-inf] * end
        for arc in self.lattice(chunk):
            forward[arc[1]] = max(forward[arc[1]], forward[arc[0]] + arc[2])
            into[arc[1]].append(arc)
        agenda: list[tuple] = [(-forward[end], 0, end, 0.0, None)]
        made, found, left = 0, [], [n] * (end + 1)
        while agenda and len(found) < n:
            value, _, at, tail, steps = heapq.heappop(agenda)
            if at == 0:
                ids: list[int] = []
                while steps:
                    ids += steps[0]
                    steps = steps[1]
                found.append((-value, tuple(ids)))
                continue
            if not left[at]:
                continue
            left[at] -= 1
            for arc in into[at]:
                made += 1
                score = tail + arc[2]
                heapq.heappush(agenda, (-(forward[arc[0]] + score), made, arc[0], score, (arc[3], steps)))
        return found

    def text(self, ids) -> str:
        """What the ids stand for, without the space put before the text."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class Trie:
    """The vocabulary as a hash table of (node, character) steps, for whole arrays of steps."""

    def __init__(self, vocabulary: Vocabulary):
        self.chars = np.array(sorted({ord(c) for p in vocabulary.known for c in p}), np.uint32)
        number = {int(c): k for k, c in enumerate(self.chars)}
        nodes: dict[tuple[int, int], int] = {}
        ends: list[int] = [-1]
        for piece, (i, _) in vocabulary.known.items():
            at = 0
            for c in piece:
                step = (at, number[ord(c)])
                if step not in nodes:
                    nodes[step] = len(ends)
                    ends.append(-1)
                at = nodes[step]
            ends[at] = i
        self.ends = np.array(ends, np.int64)
        self.scores = np.zeros(len(vocabulary.pieces))
        for i, score in vocabulary.known.values():
            self.scores[i] = score
        self.bits = max(4, int(np.ceil(np.log2(4 * len(nodes) + 16))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        self.probes = 1
        for (at, c), to in nodes.items():
            key = at << 21 | c
            slot, n = int(self._slot(np.array([key]))[0]), 1
            while self.keys[slot] != -1:
                slot, n = (slot + 1) & (len(self.keys) - 1), n + 1
            self.keys[slot], self.values[slot] = key, to
            self.probes = max(self.probes, n)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def numbers(self, points: np.ndarray) -> np.ndarray:
        """Characters by number; -1: in no piece."""
        at = np.searchsorted(self.chars, points).clip(max=len(self.chars) - 1)
        return np.where(self.chars[at] == points, at, -1)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes reached, -1 for none."""
        key = node << 21 | char
        slot = self._slot(key)
        held = self.keys[slot]
        out = np.where((held == key) & (char >= 0), self.values[slot], -1)
        left = np.flatnonzero((held != key) & (held != -1) & (char >= 0))
        for _ in range(self.probes - 1):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[left]]
            hit = held == key[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (held != -1)]
        return out


def best_together(trie: Trie, vocabulary: Vocabulary, chunks: list[str]):
    """What ``Vocabulary.best`` gives, for chunks of one length at once."""
    n, m = len(chunks[0]), len(chunks)
    points = np.frombuffer("".join(chunks).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n)
    chars = trie.numbers(points)
    forward = np.full((m, n + 1), -np.inf)
    forward[:, 0] = 0.0
    start = np.zeros((m, n + 1), np.int64)
    piece = np.zeros((m, n + 1), np.int64)
    arcs = []

    def meet(i: int, to: int, rows: np.ndarray, ids: np.ndarray, weight) -> None:
        value = forward[rows, i] + weight
        better = value > forward[rows, to]
        won = rows[better]
        forward[won, to], start[won, to], piece[won, to] = value[better], i, ids[better]
        arcs.append((i, to, rows, weight))

    for i in range(n):
        rows = np.arange(m)
        node = np.zeros(m, np.int64)
        for to in range(i + 1, min(n, i + vocabulary.longest) + 1):
            node = trie.step(node, chars[rows, to - 1])
            on = node >= 0
            end = np.where(on, trie.ends[node], -1)
            has = end >= 0
            if to == i + 1 and not has.all():  # written as bytes
                meet(i, to, rows[~has], -1 - points[rows[~has], i].astype(np.int64), vocabulary.unknown)
            if has.any():
                meet(i, to, rows[has], end[has], trie.scores[end[has]])
            rows, node = rows[on], node[on]
            if not len(rows):
                break
    on_path = np.zeros((m, n + 1), bool)
    steps, at, every = [], np.full(m, n), np.arange(m)
    while (at > 0).any():
        on_path[every, at] = True
        steps.append(np.where(at > 0, piece[every, at], np.iinfo(np.int64).min))
        at = np.where(at > 0, start[every, at], 0)
    backward = np.full((m, n + 1), -np.inf)
    backward[:, n] = 0.0
    second = np.full(m, -np.inf)
    for i, to, rows, weight in reversed(arcs):
        value = weight + backward[rows, to]
        backward[rows, i] = np.maximum(backward[rows, i], value)
        other = ~(on_path[rows, to] & (start[rows, to] == i))
        second[rows] = np.where(other, np.maximum(second[rows], forward[rows, i] + value), second[rows])
    table = np.stack(steps[::-1], axis=1)
    real = table != np.iinfo(np.int64).min
    counts = real.sum(axis=1)
    flat = table[real]
    if (flat < 0).any():
        raw = [[x] if x >= 0 else [vocabulary.byte_ids[b] for b in chr(-1 - x).encode("utf-8", "surrogatepass")] for x in flat.tolist()]
        owner = np.repeat(every, counts)
        counts = np.bincount(owner, weights=[len(r) for r in raw], minlength=m).astype(np.int64)
        flat = np.fromiter(chain.from_iterable(raw), np.int64)
    return flat, counts, forward[:, n], forward[:, n] - second


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of consecutive runs."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    """Encodes lists of texts."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        self.vocabulary, self.n, self.cut = vocabulary, n, vocabulary.pattern().findall
        self.trie = Trie(vocabulary)
        self.many: dict[str, list[tuple[float, tuple[int, ...]]]] = {}
        self._restart()

    def _restart(self) -> None:
        self.many.clear()
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.scores, self.losses = np.zeros(0), np.zeros(0)

    def _learn(self, chunks: list[str]) -> None:
        """Search new chunks and remember the results."""
        parts, by_length = [], {}
        for c in chunks:
            by_length.setdefault(len(c) if len(c) <= _SIDE_BY_SIDE else 0, []).append(c)
        for length, some in by_length.items():
            if length:
                for k in range(0, len(some), 1 << 15):
                    parts.append((some[k : k + (1 << 15)], *best_together(self.trie, self.vocabulary, some[k : k + (1 << 15)])))
                continue
            for c in some:
                ids, score, loss = self.vocabulary.best(c)
                parts.append(([c], np.array(ids, np.int64), np.array([len(ids)]), np.array([score]), np.array([loss])))
        for some, flat, counts, scores, losses in parts:
            self.number.update(zip(some, range(len(self.number), len(self.number) + len(some)), strict=True))
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.int32)))
            self.ids[self.used : self.used + len(flat)] = flat
            self.starts = np.concatenate((self.starts, self.used + np.cumsum(counts) - counts))
            self.lengths = np.concatenate((self.lengths, counts))
            self.scores = np.concatenate((self.scores, scores))
            self.losses = np.concatenate((self.losses, losses))
            self.used += len(flat)

    def encode(self, texts: list[str | None]):
        """All ids, how many belong to each text, scores and alternatives of each text."""
        if len(self.number) > _CACHED or self.used > _CACHED_IDS:
            self._restart()
        cut = [self.cut(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        self._learn(sorted(set(chain.from_iterable(cut)).difference(self.number)))
        which = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64)
        bounds = np.cumsum([0, *map(len, cut)])
        lengths = self.lengths[which]
        ids = self.ids[_ragged(self.starts[which], lengths)]
        before = np.concatenate(([0], np.cumsum(lengths)))
        counts = before[bounds[1:]] - before[bounds[:-1]]
        scores, more = [], []
        for k, text in enumerate(texts):
            own = which[bounds[k] : bounds[k + 1]]
            scores.append(None if text is None else float(fsum(self.scores[own].tolist())))
            more.append(self._alternatives(cut[k], own, scores[-1], before[bounds[k] :] - before[bounds[k]]) if len(own) else [])
        return ids, counts, scores, more

    def _alternatives(self, chunks: list[str], own: np.ndarray, score: float, before: np.ndarray):
        losses = self.losses[own]
        near = [int(p) for p in np.argsort(losses, kind="stable")[: self.n - 1] if losses[p] < inf]
        if not near:
            return []
        choices = []
        for p in near:
            if chunks[p] not in self.many:
                if len(self.many) > _CACHED // 8:
                    self.many.clear()
                found = self.vocabulary.n_best(chunks[p], self.n)
                # Of segmentations that tie, the one already chosen is the first.
                at = self.starts[own[p]]
                first = tuple(self.ids[at : at + self.lengths[own[p]]].tolist())
                others = [x for x in found if x[1] != first][: self.n - 1]
                self.many[chunks[p]] = [(found[0][0], first), *others]
            choices.append(self.many[chunks[p]])
        # Best first over the choices: every state has one predecessor, the one in which its
        # first changed chunk is a step nearer to the best.
        loss = lambda state: fsum(c[0][0] - c[k][0] for c, k in zip(choices, state, strict=True))
        agenda, out = [(0.0, (0,) * len(near))], []
        while agenda and len(out) < self.n:
            lost, state = heapq.heappop(agenda)
            out.append((lost, state))
            first = next((i for i, k in enumerate(state) if k), len(near) - 1)
            for i in range(first + 1):
                if state[i] + 1 < len(choices[i]):
                    after = state[:i] + (state[i] + 1,) + state[i + 1 :]
                    heapq.heappush(agenda, (loss(after), after))
        return [
            {
                "score": score - lost,
                "edits": [
                    {"at": int(before[p]), "drop": int(before[p + 1] - before[p]), "put": list(c[k][1])}
                    for p, c, k in sorted(zip(near, choices, state, strict=True), key=lambda x: x[0])
                    if k
                ],
            }
            for lost, state in out[1:]
        ]


def apply_edits(ids: list[int], edits) -> list[int]:
    """The ids of an alternative."""
    out, at = [], 0
    for e in edits:
        out += ids[at : e["at"]] + list(e["put"])
        at = e["at"] + e["drop"]
    return out + ids[at:]


def _add(df: DataFrame, fields: list[T.StructField], work) -> DataFrame:
    """``df`` plus columns that ``work`` (slice of the batch -> arrays) makes."""
    names = [*df.columns, *(f.name for f in fields)]
    width = len(df.columns)
    # Numbered names while in Python: any name, dots included, comes back as it was.
    kinds = [f.dataType for f in [*df.schema.fields, *fields]]
    schema = T.StructType([T.StructField(f"c{i}", kind) for i, kind in enumerate(kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = work()
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(start, _SLICE)
                columns = [rows.column(i) for i in range(width)] + make(rows)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.toDF(*schema.names[:width]).mapInArrow(run, schema).toDF(*names)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", n: int = 4) -> DataFrame:
    """``docs`` plus ids (best segmentation), score, alternatives (rank 2 to n: score and the
    edits (position, ids dropped, ids put) that turn the best ids into it)."""
    require_columns(docs, text_col)
    if n < 1:
        raise ValueError("n must be at least 1")
    at = docs.columns.index(text_col)
    fields = [
        T.StructField(fresh_name(docs, "ids"), T.ArrayType(T.IntegerType())),
        T.StructField(fresh_name(docs, "score"), T.DoubleType()),
        T.StructField(fresh_name(docs, "alternatives"), ALTERNATIVES),
    ]

    def work():
        encoder = Encoder(vocabulary, n)
        edit = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("put", pa.list_(pa.int32()))])
        kind = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

        def make(rows: pa.RecordBatch) -> list[pa.Array]:
            texts = rows.column(at).to_pylist()
            ids, counts, scores, more = encoder.encode(texts)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            none = pa.array([t is None for t in texts])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=none)
            return [lists, pa.array(scores, pa.float64()), pa.array(more, kind)]

        return make

    return _add(docs, fields, work)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """``encoded`` plus decoded, the text of ``ids_col`` (null for null)."""
    require_columns(encoded, ids_col)
    at = encoded.columns.index(ids_col)
    field = T.StructField(fresh_name(encoded, "decoded"), T.StringType())

    def work():
        lengths = np.array([len(r) for r in vocabulary.raw], np.int64)
        starts = np.cumsum(lengths) - lengths
        pool = np.frombuffer(b"".join(vocabulary.raw), np.uint8)

        def make(rows: pa.RecordBatch) -> list[pa.Array]:
            column = rows.column(at)
            ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            raw = pool[_ragged(starts[ids], lengths[ids])].tobytes()
            before = np.concatenate(([0], np.cumsum(lengths[ids])))
            ends = before[np.cumsum(counts)].tolist()
            texts, a = [], 0
            for b, null in zip(ends, column.is_null().to_pylist(), strict=True):
                own = raw[a + 1 : b] if raw[a : min(b, a + 1)] == b" " else raw[a:b]
                texts.append(None if null else own.decode("utf-8", "replace"))
                a = b
            return [pa.array(texts, pa.string())]

        return make

    return _add(encoded, [field], work)
