"""Byte-pair encoding with a pair occurrence index, and decoding.

A worker encodes the distinct runs of a batch together. Their words are one
array of symbols with links to the neighbours; an index maps each mergeable
pair, by its rank, to all positions where it stands. The active ranks are
applied in ascending order, each at all its positions at once, and the lists of
the pairs that a merge makes are extended. A stale position is seen by its
symbols and skipped.

Texts are cut as the tokenizer file says: special tokens as they stand, then
NFC, lower case, and words by the file's pattern; white space only separates.
Supported are files of this kind (``BPE`` with an end-of-word suffix behind a
byte-level alphabet); others are refused when the file is read.

Defined results: a null or empty text has no ids and decodes to the empty text;
every column of the input is kept, columns called ``ids`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .bytesops import ragged
from .chunks import RunTable, cuts_at_runs

_DEAD = 1 << 16
_EDGE = (1 << 16) - 1


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Bpe:
    """A tokenizer file's vocabulary, merges and text rules."""

    def __init__(self, path: str):
        cuts_at_runs(path)
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or level["type"] != "ByteLevel":
            raise ValueError(f"{path}: not a byte-level BPE file with word ends")
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        if len(vocab) >= _EDGE:
            raise ValueError(f"{path}: more than {_EDGE - 1} tokens")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        alphabet = _byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        codes = (self.left << 16) | self.right
        order = np.argsort(codes, kind="stable")
        self.codes, self.code_ranks = codes[order], order
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        tokens = [names.get(i, "").encode() + b" " if i in names else b"" for i in range(max(names) + 1)]
        self.token_lengths = np.array([len(x) for x in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def cut(self, run: str) -> list[bytes | int]:
        """Words of a run as UTF-8, special tokens as their ids."""
        if run.isascii() and run.isalpha():
            return [run.lower().encode()]
        parts = self.special_pattern.split(run) if self.special_pattern and "<" in run else [run]
        out: list[bytes | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                plain = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
                out += [x.encode() for x in self.words.findall(plain.lower())]
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        codes = (left.astype(np.int64) << 16) | right
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == codes, self.code_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words one after the other, and their number for each word."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n, ends = len(data), np.cumsum(lengths)
        symbols = np.append(self.inner[data], _EDGE).astype(np.int32)
        symbols[ends - 1] = self.last[data[ends - 1]]
        after = np.arange(1, n + 2, dtype=np.int32)
        after[ends - 1] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[ends - lengths] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            ranks = self._ranks(symbols[positions], symbols[after[positions]])
            known = ranks >= 0
            positions, ranks = positions[known], ranks[known]
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)], strict=True):
                if a == b:
                    continue
                rank = int(ranks[a])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(positions[a:b])

        note(np.flatnonzero(after[:n] < n).astype(np.int32))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right = self.left[rank], self.right[rank]
            at = at[(symbols[at] == left) & (symbols[after[at]] == right)]
            if not len(at):
                continue
            if left == right:  # in a run of equal symbols every second pair is taken, from its start
                at = np.sort(at)
                joined = np.concatenate([[False], after[at[:-1]] == at[1:]])
                start = np.flatnonzero(~joined)
                step = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
                at = at[step % 2 == 0]
            gone = after[at]
            symbols[at], symbols[gone] = self.made[rank], _DEAD
            following = after[gone]
            after[at] = following
            before[following] = at
            before_at = before[at]
            note(np.unique(np.concatenate([before_at[before_at < n], at[following < n]])))
        alive = symbols[:n] < _EDGE
        return symbols[:n][alive], np.add.reduceat(alive.astype(np.int64), ends - lengths)

    def encode_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs one after the other, and their number for each run."""
        numbers: dict[bytes | int, int] = {}
        members, sizes = [], []
        for run in runs:
            found = self.cut(run.decode("utf-8", "replace"))
            members += [numbers.setdefault(x, len(numbers)) for x in found]
            sizes.append(len(found))
        plain = [x for x in numbers if isinstance(x, bytes)]
        flat, lengths = self.merge(plain)
        table_lengths = np.ones(len(numbers), np.int64)
        table_starts = np.zeros(len(numbers), np.int64)
        own = np.array([numbers[x] for x in plain], np.int64)
        table_lengths[own] = lengths
        table_starts[own] = np.cumsum(lengths) - lengths
        marks = [x for x in numbers if isinstance(x, int)]
        table_starts[[numbers[x] for x in marks]] = len(flat) + np.arange(len(marks))
        flat = np.concatenate([flat, np.array(marks, np.int64)])
        members = np.array(members, np.int64)
        ids = flat[ragged(table_starts[members], table_lengths[members])]
        at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return ids, np.diff(np.concatenate([[0], np.cumsum(table_lengths[members])])[at])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of the tokens of each slice joined by spaces, and its offsets. Unknown ids give nothing."""
        known = ids < len(self.token_lengths)
        lengths = np.where(known, self.token_lengths[np.where(known, ids, 0)], 0)
        data = self.token_bytes[ragged(np.where(known, self.token_starts[np.where(known, ids, 0)], 0), lengths)]
        at = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        keep = np.ones(len(data), bool)
        full = at[1:] > at[:-1]
        keep[at[1:][full] - 1] = False  # the space behind the last token
        return data[keep], at - np.concatenate([[0], np.cumsum(full)])


_loaded: dict[str, Bpe] = {}
_tables: dict[str, RunTable] = {}


def load(path: str) -> Bpe:
    """The file's tokenizer, read once for each worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _table(path: str) -> RunTable:
    if path not in _tables:
        _tables[path] = RunTable(load(path).encode_runs)
    return _tables[path]


def _schema(df: DataFrame, extra: str) -> str:
    kept = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*kept, extra])


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """The rows with ``ids`` (little-endian unsigned 32-bit integers) in place of the text.

    ``decoded=True`` adds what ``decode`` makes of these ids, in the same task."""
    source = docs.select(*[c for c in docs.columns if c not in ("ids", "decoded", text)], F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
            names = [batch.schema.names[i] for i in others]
            for block, ids, at in _table(path).ids(batch.column("__text")):
                part = batch.slice(block.first, len(block))
                made = [_binary(ids.astype("<u4").view(np.uint8), at * 4, pa.binary())]
                if decoded:
                    made.append(_binary(*load(path).decode(ids.astype(np.int64), at), pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in others], *made], [*names, "ids", *["decoded"] * decoded]
                )

    return source.mapInArrow(run, _schema(source.drop("__text"), "ids binary" + ", decoded string" * decoded))


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the tokens of the ids joined by spaces (special tokens too)."""
    source = rows.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            step = max(1, min(512, batch.num_rows))
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                column = part.column(part.schema.names.index(ids)).fill_null(b"").cast(pa.large_binary())
                at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
                raw = column.buffers()[2]
                flat = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, np.uint8)
                data, offsets = bpe.decode(flat.view("<u4").astype(np.int64), (at - at[0]) // 4)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _binary(data, offsets, pa.string())], [*part.schema.names, "decoded"]
                )

    return source.mapInArrow(run, _schema(source, "decoded string"))


def _binary(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    if len(data) >= 1 << 31:
        raise ValueError("one block of output exceeds 2 GB")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)
