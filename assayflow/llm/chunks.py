"""Encode texts by their distinct runs of non-space bytes.

A tokenizer that splits at white space and drops it gives a text the ids of its
runs, one after the other. So each distinct run of a batch is encoded once and
the ids of a text are gathered with array operations. The table of runs is kept
in the worker between batches, up to ``MAX_RUNS`` entries.

Runs are also cut between an ASCII letter and a plain punctuation mark, where
tokenizers of this kind (words are letters alone, lower-cased) always cut, and
ASCII letters are lowered first unless a special token may stand in the block.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .bytesops import Block, blocks, ragged, word_hashes, words

#: The text rules for which runs may be cut, and letters lowered, as here.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

MAX_RUNS = 600_000
GROUP_BYTES = 3 << 20

# Marks that neither compose with a letter, nor start a contraction or a special token.
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[list(b'!"#$%&()*+,-./:;?@[]{}~')] = 2


def _cuts(data: np.ndarray) -> np.ndarray:
    kind = _KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] | kind[:-1]) == 3
    return cut


class RunTable:
    """Ids of the runs seen so far. ``encode`` maps a list of runs to their ids in a row and the number for each.

    A run is found by its hash: ``cells`` has the slot of a hash at one of two places that
    the hash names, the few runs that found both taken are in a sorted overflow."""

    BITS = 21

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.cells = np.zeros(1 << self.BITS, np.int32)  # slot 0 is no run
        self.hashes = np.zeros(1, np.uint64)
        self.starts = np.zeros(1, np.int64)
        self.lengths = np.zeros(1, np.int32)
        self.flat = np.zeros(0, np.uint32)
        self.over, self.over_slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = hashes >> np.uint64(64 - self.BITS)
        return first, (hashes >> np.uint64(8)) & np.uint64((1 << self.BITS) - 1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of the hashes; 0 where a hash is not known (or is 0)."""
        first, second = self._places(hashes)
        slots = self.cells[first]
        open_ = np.flatnonzero(self.hashes[slots] != hashes)
        again = self.cells[second[open_]]
        again[self.hashes[again] != hashes[open_]] = 0
        if len(self.over):
            left = np.flatnonzero(again == 0)
            own = hashes[open_[left]]
            at = np.searchsorted(self.over, own)
            at[at == len(self.over)] = 0
            again[left] = np.where(self.over[at] == own, self.over_slots[at], 0)
        slots[open_] = again
        return slots

    def _learn(self, hashes: np.ndarray, runs: list[bytes]) -> None:
        flat, lengths = self.encode(runs)
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        slots = np.arange(len(self.hashes), len(self.hashes) + len(runs), dtype=np.int32)
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
        self.hashes = np.concatenate([self.hashes, hashes])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        for way in (0, 1):
            places = self._places(hashes)[way]
            free = np.flatnonzero(self.cells[places] == 0)
            self.cells[places[free]] = slots[free]  # of several at one place the last stays
            left = self.cells[places] != slots
            hashes, slots = hashes[left], slots[left]
        merged = np.concatenate([self.over, hashes])
        order = np.argsort(merged, kind="stable")
        self.over, self.over_slots = merged[order], np.concatenate([self.over_slots, slots])[order]

    def ids(self, column: pa.Array) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
        """For each block of the column: the ids of its documents in a row, and ``len + 1`` offsets into them."""
        group: list[Block] = []
        for block in blocks(column):
            group.append(block)
            if sum(len(x.data) for x in group) >= GROUP_BYTES:
                yield from self._ids(group)
                group = []
        yield from self._ids(group)

    def _ids(self, group: list[Block]) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
        if len(self.hashes) > MAX_RUNS:
            self._clear()
        kept, new_hashes, new_runs = [], [], []
        for block in group:
            raw = block.data.tobytes()
            if b"<|" not in raw:
                raw = raw.lower()
            data = np.frombuffer(raw, np.uint8)
            starts, ends, at = words(data, block.offsets, _cuts(data))
            hashes = word_hashes(data, starts, ends)
            unseen = np.flatnonzero(self._find(hashes) == 0)
            unique, first = np.unique(hashes[unseen], return_index=True)
            first = unseen[first]
            new_hashes.append(unique)
            new_runs += [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            kept.append((block, hashes, at))
        if new_runs:
            unique, first = np.unique(np.concatenate(new_hashes), return_index=True)
            self._learn(unique, [new_runs[i] for i in first.tolist()])
        for block, hashes, at in kept:
            slots = self._find(hashes)
            lengths = self.lengths[slots]
            ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            yield block, self.flat[ragged(self.starts[slots], lengths)], ends[at]


def cuts_at_runs(path: str) -> None:
    """Raise unless the tokenizer file splits texts as the runs do; read once, on the driver.

    It must drop white space, split words, digits and marks by ``SPLIT_PATTERN``, lower letters, and have only special tokens that
    begin with ``<|`` and hold no white space."""
    with open(path, encoding="utf-8") as source:
        spec = json.load(source)

    def steps(name: str, within: str) -> list[dict]:
        given = spec.get(name) or {}
        return given.get(within, [given] if given else [])

    normalizers, splits = steps("normalizer", "normalizers"), steps("pre_tokenizer", "pretokenizers")
    fits = [x.get("type") for x in normalizers] == NORMALIZERS and normalizers[1].get("pattern") == {"Regex": r"\s+"} and normalizers[1].get("content") == " "
    fits = fits and [x.get("type") for x in splits] == ["Split", "ByteLevel"] and splits[0].get("pattern") == {"Regex": SPLIT_PATTERN}
    fits = fits and splits[0].get("behavior") == "Removed" and splits[0].get("invert") and not splits[1].get("add_prefix_space")
    special = [x["content"] for x in spec.get("added_tokens", [])]
    fits = fits and all(x.startswith("<|") and len(x.split()) == 1 and x == x.strip() for x in special)
    if not fits or spec.get("post_processor"):
        raise ValueError(f"{path}: the file splits texts in another way than these operators do")


_library_tables: dict[str, RunTable] = {}


def library_table(path: str) -> RunTable:
    """The runs table of a tokenizer file, encoded by the tokenizers library (one table for each worker)."""
    if path not in _library_tables:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            lengths, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
            for at in range(0, len(runs), 2048):
                texts = [x.decode("utf-8", "replace") for x in runs[at : at + 2048]]
                found = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                lengths.append(np.array([len(x) for x in found], np.int64))
                flat.append(np.array([i for x in found for i in x], np.uint32))
            return np.concatenate(flat), np.concatenate(lengths)

        _library_tables[path] = RunTable(encode)
    return _library_tables[path]
