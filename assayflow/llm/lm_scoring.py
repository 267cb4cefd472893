"""Language-model scoring: an interpolated modified Kneser-Ney bigram model of all training texts.

Training is three Spark jobs, each of which sums within a task before it shuffles:

1. word counts, merged by hash range into sorted arrays: the vocabulary. A word's id
   is its place in the whole sorted vocabulary;
2. counts of word pairs (context id, word id), merged by the context's range into
   sorted key arrays, with the number of followers that each context has once, twice
   and more often. The pairs of a very frequent context are dealt over all shards;
3. continuation counts: the number of distinct contexts of each word.

The arrays are files in the shared folder, memory-mapped by the workers that score.
A shard is one task's work; there are as many as the session has shuffle partitions
(64 at least), so a shard stays small if that setting follows the data. Through the
driver go only the shards' addresses and sums.

P(w | h) = (c(h w) - D) / c(h) + g(h) * P1(w)   with P1 from continuation counts,
interpolated with 1 / (V + 1), which is also what an unknown word has from the last
term. Each order has its own three discounts. After an unknown word P1 is used.

Defined results: a null text is empty; an empty text is its end token alone; other
columns of the input are kept, ours replace columns of the same name. With no
training text every probability is 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bytesops import Block, blocks, lower_ascii, mix64, segment_sums, sum_by_key, word_hashes, words
from .shared import mapped_file, scratch, staged, write_file

END = np.uint64(0xC2B2AE3D27D4EB4F)  # the end token's place among the word hashes
BEGIN_ID, UNKNOWN_ID = (1 << 32) - 1, (1 << 32) - 2
FLUSH = 2_000_000
_LOW = np.uint64(0xFFFFFFFF)
_SHIFT = np.uint64(32)


def shard_count(spark: SparkSession) -> int:
    """A power of two: the session's shuffle partitions, 64 at least."""
    return 1 << max(6, math.ceil(math.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))))


def pack(keys: np.ndarray, counts: np.ndarray, kind: str = "<u4") -> bytes:
    """Sorted keys and their counts, small: differences by byte plane."""
    size = np.dtype(kind).itemsize
    planes = [np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T, counts.astype(kind).view(np.uint8).reshape(-1, size).T]
    return zstandard.compress(b"".join(np.ascontiguousarray(x).tobytes() for x in planes), 1)


def unpack(blob: bytes, kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    n = len(raw) // (8 + size)
    keys = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(keys, dtype=np.uint64), np.ascontiguousarray(raw[8 * n :].reshape(size, n).T).view(kind).ravel()


def _merged(table: pa.Table, name: str = "blob") -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(x.as_py(), "<u8") for x in table.column(name)]
    return sum_by_key(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts of one, two, and three or more, from the numbers of items counted 1 to 4 times.

    Where these numbers give none (a zero among them), half the count is taken off, 1.5 at most."""
    found = np.array([0.5, 1.0, 1.5])
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        for i in range(3):
            if n[i]:
                found[i] = min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.0), i + 1.0)
    return found


def _discount(counts: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], found])[np.minimum(counts, 3).astype(np.int64)]


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values


@dataclass
class NgramModel:
    """Addresses and sums of the shards; all that the workers need to score."""

    starts: np.ndarray  # first id of each shard, and the number of types
    tokens: int
    texts: int
    vocabulary: list[str]
    hot: np.ndarray  # contexts whose pairs lie in all shards, ascending
    hot_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    hot_followers: np.ndarray = field(default_factory=lambda: np.zeros((0, 3), np.int64))
    pairs: list[str] = field(default_factory=list)
    followers: list[str] = field(default_factory=list)
    continuations: list[str] = field(default_factory=list)
    pair_discounts: np.ndarray = field(default_factory=lambda: np.zeros(3))
    word_discounts: np.ndarray = field(default_factory=lambda: np.zeros(3))
    contexts: int = 0  # sum of the continuation counts: the number of distinct pairs
    left_over: float = 1.0  # mass of the word level that goes to the uniform level

    @property
    def types(self) -> int:
        return int(self.starts[-1])

    def _by_hash(self, hashes: np.ndarray) -> np.ndarray:
        """Where sorted hashes pass from shard to shard."""
        shards = len(self.vocabulary)
        bounds = np.arange(1, shards, dtype=np.uint64) << np.uint64(64 - shards.bit_length() + 1)
        return np.concatenate([[0], np.searchsorted(hashes, bounds), [len(hashes)]])

    def _by_id(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(ids, self.starts)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and training counts of sorted distinct hashes (``UNKNOWN_ID`` and 0 for an unknown word)."""
        ids, counts = np.full(len(hashes), UNKNOWN_ID, np.uint64), np.zeros(len(hashes), np.int64)
        cuts = self._by_hash(hashes)
        for s, uri in enumerate(self.vocabulary):
            a, b = cuts[s], cuts[s + 1]
            if a == b or not uri:
                continue
            known, seen = mapped_file(uri).view(np.uint64).reshape(2, -1)
            at = np.searchsorted(known, hashes[a:b])
            at[at == len(known)] = 0
            hit = known[at] == hashes[a:b]
            ids[a:b][hit] = (at[hit] + self.starts[s]).astype(np.uint64)
            counts[a:b][hit] = seen[at[hit]]
        return ids, counts

    def gather(self, files: list[str], ids: np.ndarray, width: int, rows) -> np.ndarray:
        """Rows of ``width`` numbers by ascending id; zeros where the id is none of the vocabulary.

        ``rows`` makes the array by id of a file's bytes."""
        out = np.zeros((len(ids), width), np.int64)
        cuts = self._by_id(ids)
        for s, uri in enumerate(files):
            a, b = cuts[s], cuts[s + 1]
            if a < b and uri:
                out[a:b] = rows(mapped_file(uri))[ids[a:b].astype(np.int64) - self.starts[s]]
        return out

    def _in_shard(self, s: int, keys: np.ndarray) -> np.ndarray:
        if not self.pairs[s] or not len(keys):
            return np.zeros(len(keys), np.int64)
        raw = mapped_file(self.pairs[s])
        n = len(raw) // 16
        known, seen = raw[: 8 * n].view(np.uint64), raw[8 * n :].view(np.uint64)
        at = np.searchsorted(known, keys)
        at[at == n] = 0
        return np.where(known[at] == keys, seen[at], 0).astype(np.int64)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of sorted distinct pairs."""
        out = np.zeros(len(keys), np.int64)
        hot = _among(keys >> _SHIFT, self.hot)
        cold = np.flatnonzero(~hot)
        cuts = self._by_id(keys[cold] >> _SHIFT)
        for s in range(len(self.pairs)):
            own = cold[cuts[s] : cuts[s + 1]]
            out[own] = self._in_shard(s, keys[own])
        hot = np.flatnonzero(hot)
        shard = mix64(keys[hot]) & np.uint64(len(self.pairs) - 1)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(len(self.pairs) + 1))
        for s in range(len(self.pairs)):
            own = hot[order[cuts[s] : cuts[s + 1]]]
            out[own] = self._in_shard(s, keys[own])
        return out

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """P(word | context) of sorted distinct pairs."""
        uniform = 1.0 / (self.types + 1)
        word, word_at = np.unique(keys & _LOW, return_inverse=True)
        seen_after = self.gather(self.continuations, word, 1, lambda x: x.view(np.uint32).reshape(-1, 1))[:, 0]
        lower = self.left_over * uniform + (seen_after - _discount(seen_after, self.word_discounts)) / max(1, self.contexts)
        context, context_at = np.unique(keys >> _SHIFT, return_inverse=True)
        followers = self.gather(self.followers, context, 3, lambda x: x.view(np.uint32).reshape(-1, 3))
        counts = self.gather(self.vocabulary, context, 1, lambda x: x.view(np.uint64).reshape(2, -1)[1][:, None])[:, 0]
        hit = _among(context, self.hot)
        at = np.searchsorted(self.hot, context[hit])
        followers[hit], counts[hit] = self.hot_followers[at], self.hot_counts[at]
        open_mass = np.where(counts > 0, followers @ self.pair_discounts / np.maximum(counts, 1), 1.0)
        found = self.pair_counts(keys)
        upper = (found - _discount(found, self.pair_discounts)) / np.maximum(counts, 1)[context_at]
        return upper + open_mass[context_at] * lower[word_at]


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct token hashes of the block, each token's place among them, and the texts' offsets into the tokens."""
    data = lower_ascii(block.data)
    starts, ends, at = words(data, block.offsets)
    docs = len(block)
    total = np.zeros(len(starts) + docs, np.uint64)
    is_end = np.zeros(len(total), bool)
    is_end[at[1:] + np.arange(docs)] = True
    total[~is_end] = word_hashes(data, starts, ends)
    total[is_end] = END
    unique, inverse = np.unique(total, return_inverse=True)
    return unique, inverse, at + np.arange(docs + 1)


def _pairs(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    context = np.empty(len(ids), np.uint64)
    context[1:] = ids[:-1]
    context[offsets[:-1]] = BEGIN_ID
    return (context << _SHIFT) | ids


class _Sums:
    """Sums by key, handed out as blobs by shard whenever many keys have gathered."""

    def __init__(self, shards: int, place):
        self.shards, self.place, self.parts, self.size = shards, place, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, counts = sum_by_key(np.concatenate([x for x, _ in self.parts]), np.concatenate([x for _, x in self.parts]))
        self.parts, self.size = [], 0
        shard = self.place(keys)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        rows = [(s, pack(keys[own], counts[own], "<u8")) for s in range(self.shards) if len(own := order[cuts[s] : cuts[s + 1]])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["shard", "blob"]
        )


def train(docs: DataFrame, text: str = "text", shards: int | None = None) -> NgramModel:
    """Count all the texts and write the model's arrays to the shared folder."""
    spark = docs.sparkSession
    shards = shards or shard_count(spark)
    bits = np.uint64(64 - (shards.bit_length() - 1))
    folder = scratch(spark, "ngrams")
    texts = docs.select(F.col(text).alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(shards, lambda keys: (keys >> bits).astype(np.int32))
        for batch in batches:
            for block in blocks(batch.column("text")):
                unique, inverse, _ = _tokens(block)
                yield from sums.add(unique, np.bincount(inverse, minlength=len(unique)))
        yield from sums.flush()

    def merge_words(key, table):
        hashes, counts = _merged(table)
        uri = write_file(folder, f"vocabulary-{key[0].as_py()}", [hashes, counts.astype(np.uint64)])
        top = np.argsort(-counts, kind="stable")[:16]
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int32()),
                "uri": [uri],
                "types": [len(hashes)],
                "tokens": [int(counts.sum())],
                "texts": [int(counts[hashes == END].sum())],
                "top": [top.tolist()],
                "top_counts": [counts[top].tolist()],
            }
        )

    words_schema = "shard int, uri string, types long, tokens long, texts long, top array<long>, top_counts array<long>"
    counted = texts.mapInArrow(count_words, "shard int, blob binary")
    made = {r["shard"]: r for r in counted.groupBy("shard").applyInArrow(merge_words, words_schema).collect()}
    sizes = [made[s]["types"] if s in made else 0 for s in range(shards)]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if starts[-1] >= UNKNOWN_ID:
        raise ValueError("more than 2**32 - 2 distinct words")
    tokens = sum(r["tokens"] for r in made.values())
    number = sum(r["texts"] for r in made.values())
    frequent = {int(starts[s] + i): n for s, r in made.items() for i, n in zip(r["top"], r["top_counts"], strict=True) if n * shards > 2 * tokens}
    frequent[BEGIN_ID] = number
    hot = np.array(sorted(frequent), np.uint64)
    model = NgramModel(
        starts, tokens, number, [made[s]["uri"] if s in made else "" for s in range(shards)], hot,
        hot_counts=np.array([frequent[int(x)] for x in hot], np.int64), hot_followers=np.zeros((len(hot), 3), np.int64),
    )
    if not tokens:
        model.pairs = model.followers = model.continuations = [""] * shards
        return model

    def place(keys: np.ndarray) -> np.ndarray:
        context = keys >> _SHIFT
        own = np.searchsorted(starts, context.astype(np.int64), "right") - 1
        return np.where(_among(context, hot), (mix64(keys) & np.uint64(shards - 1)).astype(np.int64), own).astype(np.int32)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(shards, place)
        for batch in batches:
            for block in blocks(batch.column("text")):
                unique, inverse, offsets = _tokens(block)
                keys, counts = sum_by_key(_pairs(model.find(unique)[0][inverse], offsets))
                yield from sums.add(keys, counts)
        yield from sums.flush()

    def merge_pairs(key, table):
        shard = key[0].as_py()
        keys, counts = _merged(table)
        rows = [{"kind": "pairs", "shard": shard, "uri": write_file(folder, f"pairs-{shard}", [keys, counts.astype(np.uint64)])}]
        rows[0]["n"] = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        context = keys >> _SHIFT
        own, start = np.unique(context, return_index=True)
        of = [np.add.reduceat((counts == k) if k < 3 else (counts >= 3), start, dtype=np.int64) for k in (1, 2, 3)]
        split = _among(own, hot)
        dense = np.zeros((int(starts[shard + 1] - starts[shard]), 3), np.uint32)
        cold = own[~split].astype(np.int64) - starts[shard]
        for k in range(3):
            dense[cold, k] = of[k][~split]
        rows.append({"kind": "followers", "shard": shard, "uri": write_file(folder, f"followers-{shard}", [dense])})
        rows += [{"kind": "hot", "id": int(own[i]), "n": [int(x[i]) for x in of]} for i in np.flatnonzero(split)]
        word, contexts = sum_by_key(keys & _LOW)
        cuts = np.searchsorted(word, starts)
        rows += [
            {"kind": "word", "shard": s, "blob": pack(word[cuts[s] : cuts[s + 1]], contexts[cuts[s] : cuts[s + 1]], "<u8")}
            for s in range(shards)
            if cuts[s] < cuts[s + 1]
        ]
        return pa.Table.from_pylist(rows, pair_arrow)

    pair_schema = "kind string, shard int, uri string, blob binary, id long, n array<long>"
    pair_arrow = pa.schema(
        [("kind", pa.string()), ("shard", pa.int32()), ("uri", pa.string()), ("blob", pa.binary()), ("id", pa.int64()), ("n", pa.list_(pa.int64()))]
    )
    pairs = texts.mapInArrow(count_pairs, "shard int, blob binary").groupBy("shard").applyInArrow(merge_pairs, pair_schema)
    pairs = staged(pairs, "ngram-parts")
    written = pairs.where("kind in ('pairs', 'followers')").select("kind", "shard", "uri", "n").collect()  # two rows a shard
    address = {(r["kind"], r["shard"]): r["uri"] for r in written}
    model.pairs = [address.get(("pairs", s), "") for s in range(shards)]
    model.followers = [address.get(("followers", s), "") for s in range(shards)]
    model.pair_discounts = discounts(np.sum([r["n"] for r in written if r["kind"] == "pairs"], axis=0))
    sums = [F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(3)]
    for r in pairs.where("kind = 'hot'").groupBy("id").agg(*sums).collect():  # the hot contexts, half as many as shards at most
        model.hot_followers[np.searchsorted(hot, np.uint64(r["id"]))] = [r["n0"], r["n1"], r["n2"]]

    def merge_continuations(key, table):
        shard = key[0].as_py()
        word, contexts = _merged(table)
        dense = np.zeros(int(starts[shard + 1] - starts[shard]), np.uint32)
        dense[word.astype(np.int64) - starts[shard]] = contexts
        n = [int((contexts == k).sum()) for k in (1, 2, 3, 4)] + [int((contexts >= 3).sum()), int(contexts.sum())]
        return pa.table({"shard": pa.array([shard], pa.int32()), "uri": [write_file(folder, f"continuations-{shard}", [dense])], "n": [n]})

    after = pairs.where("kind = 'word'").select("shard", "blob").groupBy("shard")
    after = after.applyInArrow(merge_continuations, "shard int, uri string, n array<long>").collect()
    address = {r["shard"]: r["uri"] for r in after}
    model.continuations = [address.get(s, "") for s in range(shards)]
    n = np.sum([r["n"] for r in after], axis=0)
    model.word_discounts = discounts(n[:4])
    model.contexts = int(n[5])
    model.left_over = float(model.word_discounts @ [n[0], n[1], n[4]]) / model.contexts
    return model


def score(docs: DataFrame, model: NgramModel, text: str = "text") -> DataFrame:
    """The rows without the text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 probabilities of the text) and ``perplexity`` (by the model, for each token)."""
    own = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    source = docs.select(*[c for c in docs.columns if c not in (*own, text)], F.col(text).alias("__text"))
    kept = source.drop("__text")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema += "".join(f", {c} long" for c in own[:3]) + "".join(f", {c} double" for c in own[3:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
            for block in blocks(batch.column("__text")):
                unique, inverse, offsets = _tokens(block)
                ids, counts = model.find(unique)
                base = np.log10((counts + 1) / (model.tokens + model.types + 1))
                pairs, pair_at = np.unique(_pairs(ids[inverse], offsets), return_inverse=True)
                logs = np.log10(model.probabilities(pairs))
                n = np.diff(offsets)
                total = segment_sums(logs[pair_at], offsets)
                found = [
                    n,
                    segment_sums((counts > 0).astype(np.int64)[inverse], offsets),
                    np.full(len(n), model.tokens, np.int64),
                    segment_sums(base[inverse], offsets),
                    total,
                    10.0 ** np.minimum(-total / n, 300.0),
                ]
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in others], *[pa.array(x) for x in found]],
                    [*[batch.schema.names[i] for i in others], *own],
                )

    return source.mapInArrow(run, schema)
