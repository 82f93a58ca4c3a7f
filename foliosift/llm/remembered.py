"""Token ids of texts through a memory of distinct chunks, for operators inside Arrow batches."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as public tokenizers see it (the Unicode property).
WHITE = " \t\n\r\x0b\x0c\x85\xa0  -     　"


def byte_signs() -> dict[int, str]:
    """The character that stands for each byte in the vocabularies of byte-level BPEs: printable
    ones for themselves, the others by those from U+0100 on. Held against the library."""
    from tokenizers import pre_tokenizers

    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [x for x in range(256) if x not in printable]
    signs = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    text = "".join(map(chr, [*range(0x80), *range(0x80, 0x800, 63), 0x7FF, *range(0x800, 0xD800, 997), *range(0x10000, 0x110000, 65521)]))
    if pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text)[0][0] != text.encode().decode("latin-1").translate(signs):
        raise ValueError("the installed library shows bytes differently")
    return signs


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of consecutive runs."""
    ends = np.cumsum(lengths)
    return np.arange(int(lengths.sum())) + np.repeat(starts - (ends - lengths), lengths)


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of at most ``most`` bytes of text, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes.astype(np.int64)), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def kept(name: str, make: Callable[[], object]) -> object:
    """One object per worker process, which its later tasks find again."""
    store = sys.modules.setdefault("foliosift_kept", ModuleType("foliosift_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


class Remembered:
    """Ids of distinct chunks under several tokenizers, kept until there are too many."""

    def __init__(self, encoders: list[Callable[[list[str]], list[list[int]]]], most_chunks: int = 1_000_000, most_ids: int = 1 << 23):
        self.encoders, self.most_chunks, self.most_ids = encoders, most_chunks, most_ids
        self._restart()

    def _restart(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = [np.zeros(1 << 16, np.int32) for _ in self.encoders]
        self.bounds = [np.zeros(1, np.int64) for _ in self.encoders]

    def places(self, chunks: pa.Array) -> np.ndarray:
        """The number of each of distinct ``chunks``; new ones are encoded."""
        if len(self.known) > self.most_chunks or max(int(b[-1]) for b in self.bounds) > self.most_ids:
            self._restart()
        at = pc.index_in(chunks, value_set=self.known)
        new = at.is_null()
        out = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = chunks.filter(new)
        if len(fresh):
            out[new.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(fresh))
            self.known = pa.concat_arrays([self.known, fresh])
            texts = fresh.to_pylist()
            for k, encode in enumerate(self.encoders):
                found = encode(texts)
                used = int(self.bounds[k][-1])
                ends = used + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
                flat = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]) - used)
                while ends[-1] > len(self.ids[k]):
                    self.ids[k] = np.concatenate((self.ids[k], np.zeros_like(self.ids[k])))
                self.ids[k][used : ends[-1]] = flat
                self.bounds[k] = np.concatenate((self.bounds[k], ends))
        return out

    def gather(self, places: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each tokenizer all ids, and where those of each text end; ``bounds`` are the
        texts' borders among the ``places``."""
        out = []
        for ids, ends in zip(self.ids, self.bounds, strict=True):
            starts = ends[places]
            lengths = ends[places + 1] - starts
            before = np.concatenate(([0], np.cumsum(lengths)))
            out.append((ids[ragged(starts, lengths)], before[bounds]))
        return out


def spaced_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``texts`` (no nulls), each behind one space, cut before every space that no white space
    precedes: the distinct chunks, their places in all texts in order, and the texts' borders.

    No token of a byte-level BPE whose words begin at a space, nor of a piece vocabulary that
    has spaces at the front of pieces only, crosses such a cut."""
    odd = pc.match_substring_regex(texts, "^ |[" + WHITE.replace("\\", "") + "] ").to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    plain = lists.flatten().dictionary_encode()
    chunks = pc.binary_join_element_wise("", plain.dictionary, " ")
    codes = plain.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    if not odd.any():
        return chunks, codes, bounds
    number = {c: i for i, c in enumerate(chunks.to_pylist())}
    cut = re.compile(f" [^ ]*(?:(?<=[{WHITE}]) [^ ]*)*").findall
    parts, sizes = [], counts.copy()
    for row in range(len(texts)):
        if odd[row]:
            own = cut(" " + texts[row].as_py())
            parts.append(np.array([number.setdefault(c, len(number)) for c in own], np.int64))
            sizes[row] = len(own)
        else:
            parts.append(codes[bounds[row] : bounds[row + 1]])
    return pa.array(list(number), pa.string()), np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))
