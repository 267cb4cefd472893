"""Quality by perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of byte trigrams (three orders,
then 1 / 256), counted over three quarters of all trusted documents. Its trigram counts
are cut into shards by a hash of the context. A document's distinct trigrams and their
counts travel as arrays of a block of documents, one for each shard, and are joined with
that shard's counts; a shard holds all that its contexts need but the two lower orders,
65,536 numbers whatever the corpus. The joins' sums for each document give its perplexity.

A document is kept if its perplexity lies within its language's limits: a high and a low
quantile of the perplexities of all trusted documents that were left out of the counts. Text
that the model has not learned is above, text that repeats usual words may be below.

One estimator gives the quantile at every size (``_limits``): in logarithms, measured from the language's mean in its
deviations, a language's own quantile weighs as its left-out documents, and that of all languages, measured the same way,
as ``REACH`` documents, the number that just hold the quantile's rank; among all languages the prediction limit of Student's t
weighs as ``REACH`` documents. A language's mean and deviation are drawn towards those of all as a random effect, so with
many documents a limit is the language's quantile, and with few it passes steadily to what all languages show.

Defined results: a text that is null or only white space has perplexity null and is not
kept. A null language, or one without left-out documents, uses the limits over all of them. Without any trusted document every
document with text is kept (both limits null).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bytesops import Block, blocks, mix64, sum_by_key
from .lm_scoring import _discount, discounts, pack, shard_count, unpack
from .rows import PLACE, only, placed, without
from .shared import bounded_batches, staged, tidy

QUANTILE = 0.999
REACH = round(1 / (1 - QUANTILE))
PRIOR = 5, 0.5  # documents, and deviation of the logarithms, that are assumed before any is seen
BLOCK = 1 << 20  # with the trigrams' arrays a task holds about forty times as much


def _trigrams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Document and code of every byte's trigram; a zero byte ends a text, two stand before it."""
    docs, lengths = len(block), np.diff(block.offsets)
    padded = np.zeros(len(block.data) + 3 * docs, np.uint8)
    padded[np.arange(len(block.data)) + np.repeat(3 * np.arange(docs) + 2, lengths)] = block.data
    owner = np.repeat(np.arange(docs, dtype=np.int32), lengths + 1)
    at = np.arange(len(owner)) + 2 * owner
    codes = padded[at].astype(np.uint32) << 16
    codes |= padded[at + 1].astype(np.uint32) << 8
    codes |= padded[at + 2]
    return owner, codes


def _shard(codes: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(codes.astype(np.uint64) >> np.uint64(8)) & np.uint64(shards - 1)).astype(np.int64)


@dataclass
class ByteModel:
    """Stored shards (shard, counts) and the fixed-size rest of the model."""

    table: DataFrame
    shards: int
    top: np.ndarray  # discounts of the trigrams
    lower: np.ndarray  # P(byte | byte before), 256 x 256


def train(texts: DataFrame, text: str = "text") -> ByteModel:
    """Count the trigrams of all the given texts."""
    bounded_batches(texts.sparkSession)
    shards = shard_count(texts.sparkSession)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for block in blocks(batch.column("text")):
                parts.append(sum_by_key(_trigrams(block)[1]))
                if len(parts) == 16:
                    parts = [sum_by_key(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))]
        if parts:
            keys, counts = sum_by_key(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))
            place = _shard(keys, shards)
            own = [(s, np.flatnonzero(place == s)) for s in np.unique(place).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in own], pa.int32()), pa.array([pack(keys[x].astype(np.uint64), counts[x]) for _, x in own], pa.binary())],
                ["shard", "blob"],
            )

    def merge(key, table):
        parts = [unpack(x.as_py()) for x in table.column("blob")]
        keys, counts = sum_by_key(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))
        pairs, before = sum_by_key(keys & np.uint64(0xFFFF))
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int32()),
                "counts": pa.array([pack(keys, counts, "<u8")], pa.binary()),
                "n": pa.array([[int((counts == k).sum()) for k in (1, 2, 3, 4)]], pa.list_(pa.int64())),
                "pairs": pa.array([pack(pairs, before)], pa.binary()),
            }
        )

    rows = texts.select(F.col(text).alias("text")).where("text is not null")
    made = rows.mapInArrow(count, "shard int, blob binary").groupBy("shard")
    made = staged(made.applyInArrow(merge, "shard int, counts binary, n array<long>, pairs binary"), "byte-model")
    n, follows = np.zeros(4, np.int64), np.zeros(65536, np.int64)  # follows: contexts of each byte pair
    for r in made.select("n", "pairs").collect():
        n += r["n"]
        at, found = unpack(r["pairs"])
        follows[at.astype(np.int64)] += found
    return ByteModel(made.select("shard", "counts"), shards, discounts(n), _lower(follows.reshape(256, 256)))


def _interpolated(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney probabilities along the last axis of a table of counts."""
    off = discounts(np.array([(counts == k).sum() for k in (1, 2, 3, 4)]))
    taken = _discount(counts, off)
    total = counts.sum(axis=-1, keepdims=True)
    shared = np.where(total > 0, taken.sum(axis=-1, keepdims=True) / np.maximum(total, 1), 1.0)
    return (counts - taken) / np.maximum(total, 1) + shared * below


def _lower(follows: np.ndarray) -> np.ndarray:
    single = _interpolated((follows > 0).sum(axis=0), np.full(256, 1 / 256))
    return _interpolated(follows, single)


class _Shard:
    """One shard's counts, ready to be asked."""

    def __init__(self, blob: bytes | None, model_top: np.ndarray, lower: np.ndarray):
        self.lower = lower.ravel()
        self.keys, counts = unpack(blob, "<u8") if blob else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        taken = _discount(counts, model_top)
        self.above = counts - taken
        self.contexts, start = np.unique(self.keys >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(counts.astype(np.float64), start) if len(start) else np.zeros(0)
        self.open = np.add.reduceat(taken, start) / self.total if len(start) else np.zeros(0)

    def log2(self, codes: np.ndarray) -> np.ndarray:
        """log2 P(last byte | two bytes before) of ascending distinct codes."""
        codes = codes.astype(np.uint64)
        below = self.lower[(codes & np.uint64(0xFFFF)).astype(np.int64)]
        if not len(self.keys):
            return np.log2(below)
        at = np.searchsorted(self.contexts, codes >> np.uint64(8))
        at[at == len(self.contexts)] = 0
        known = self.contexts[at] == codes >> np.uint64(8)
        own = np.searchsorted(self.keys, codes)
        own[own == len(self.keys)] = 0
        upper = np.where(self.keys[own] == codes, self.above[own], 0.0)
        return np.log2(np.where(known, upper / self.total[at] + self.open[at] * below, below))


def perplexities(docs: DataFrame, model: ByteModel, columns: list[str], text: str = "text") -> DataFrame:
    """The chosen columns of every document (not the text) with ``n_bytes`` and ``perplexity`` (for each byte)."""
    bounded_batches(docs.sparkSession)
    shards, top, lower = model.shards, model.top, model.lower
    source = docs.select(*columns, F.coalesce(F.col(text).rlike(r"[^\s\x00]"), F.lit(False)).alias("__any"), F.col(text).alias("__text"))
    kept = source.select(*columns)
    names = kept.columns

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for block in blocks(batch.column("__text"), BLOCK):
                number += 1
                owner, codes = _trigrams(block)
                keys, counts = sum_by_key((owner.astype(np.uint64) << np.uint64(24)) | codes)
                del owner, codes
                code = keys & np.uint64(0xFFFFFF)
                place = _shard(code, shards)
                # by shard, then code, then document: small differences
                own = (code << np.uint64(24)) | (keys >> np.uint64(24))
                order = np.lexsort((own, place))
                own, counts, place = own[order], counts[order], place[order]
                at = np.searchsorted(place, np.arange(shards + 1))
                full = [s for s in range(shards) if at[s] < at[s + 1]]
                part = batch.slice(block.first, len(block))
                meta = pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(np.diff(block.offsets))], [*batch.schema.names[:-1], "__bytes"]
                )
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, meta.schema) as out:
                    out.write_batch(meta)
                blob = [pack(own[at[s] : at[s + 1]], counts[at[s] : at[s + 1]]) for s in full]
                n = len(full) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{task}-{number}"] * n),
                        pa.array([*full, -1 - number % shards], pa.int32()),  # what describes the block joins no shard
                        pa.array([len(block)] * n, pa.int32()),
                        pa.array([*blob, sink.getvalue().to_pybytes()], pa.binary()),
                    ],
                    ["block", "shard", "docs", "blob"],
                )

    @tidy
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, shard = None, None
        for batch in batches:
            out = []
            numbers, sizes = batch.column("shard").to_pylist(), batch.column("docs").to_pylist()
            blobs, counted = batch.column("blob"), batch.column("counts")
            for i, s in enumerate(numbers):
                if s < 0:
                    out.append(blobs[i].as_py())
                    continue
                if s != current:
                    current, shard = s, _Shard(counted[i].as_py(), top, lower)
                keys, counts = unpack(blobs[i].as_py())
                code = keys >> np.uint64(24)
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                log = np.repeat(shard.log2(code[first]), np.diff(np.append(first, len(code))))
                own = (keys & np.uint64(0xFFFFFF)).astype(np.int64)
                out.append(np.bincount(own, weights=log * counts, minlength=sizes[i]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array([s < 0 for s in numbers]), pa.array(out, pa.binary())], ["block", "meta", "blob"]
            )

    def gather(key, table):
        is_meta = table.column("meta").to_pylist()
        total, meta = 0.0, None
        for described, blob in zip(is_meta, table.column("blob"), strict=True):
            if described:
                meta = pa.ipc.open_stream(blob.as_py()).read_all()
            else:
                total = total + np.frombuffer(blob.as_py())
        length = meta.column("__bytes").to_numpy()
        perplexity = 2.0 ** np.minimum(-np.asarray(total) / (length + 1), 1000.0)
        none = ~meta.column("__any").to_numpy()
        return pa.table(
            [*[meta.column(c) for c in names], pa.array(length), pa.array(perplexity, mask=none)], [*names, "n_bytes", "perplexity"]
        )

    grams = source.mapInArrow(cut, "block string, shard int, docs int, blob binary")
    met = grams.join(model.table, "shard", "left").select("block", "shard", "docs", "blob", "counts")
    sums = met.mapInArrow(ask, "block string, meta boolean, blob binary")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return sums.groupBy("block").applyInArrow(gather, schema + ", n_bytes long, perplexity double")


def trusted(labels: DataFrame) -> DataFrame:
    """(doc_id, counted) of all trusted documents, each id once; a hash of the id leaves a quarter out of the counts.

    Trusted is a document that all its labels call good and none toxic."""
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    ids = ids.where("q = 1 and coalesce(t, 0) = 0").select("doc_id")
    return ids.withColumn("counted", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) != 0)


def student(quantile: float, freedom: int) -> float:
    """Quantile of Student's t, for four degrees of freedom or more (within 1 in 100; Abramowitz and Stegun 26.7.5)."""
    z = NormalDist().inv_cdf(quantile)
    terms = [
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    return sum(x / freedom**i for i, x in enumerate(terms))


@dataclass
class _Spread:
    """The logarithms of perplexities: how they lie within a language and between languages."""

    mean: float
    within: float  # variance
    between: float

    @classmethod
    def of(cls, figures: list) -> "_Spread":
        """From (n, mean, population variance) of each language."""
        n, mean, own = (np.array([r[i] for r in figures], np.float64) for i in (0, 1, 2))
        centre = float(n @ mean / n.sum())
        within = float((n @ own + PRIOR[0] * PRIOR[1] ** 2) / (n.sum() + PRIOR[0]))
        noise = within * (1 / n).mean()  # of the means themselves
        return cls(centre, within, max(0.0, float(mean.var(ddof=1)) - noise) if len(n) > 1 else 0.0)

    def language(self, n: float, mean: float, own: float) -> tuple[float, float]:
        """Mean and deviation of one more document of a language with these figures."""
        trust = n * self.between / (n * self.between + self.within)
        variance = (n * own + PRIOR[0] * self.within) / (n + PRIOR[0])
        return trust * mean + (1 - trust) * self.mean, float(np.sqrt(variance + (1 - trust) * self.between))


def _limits(n: int, quantiles: list[float], beyond: list[float], mean: float, deviation: float) -> tuple[float, float]:
    """Limits from n documents' quantiles (of logarithms) and those expected beforehand (in deviations from the mean)."""
    own = (np.array(quantiles) - mean) / deviation
    low, high = np.exp(mean + deviation * (n * own + REACH * np.array(beyond)) / (n + REACH))
    return float(low), float(high)


def thresholds(scored: DataFrame) -> tuple[dict[str, tuple[float, float]], tuple[float, float] | None]:
    """Lower and upper limit for each language, and over all, from (lang, perplexity) of trusted documents."""
    ends = [1 - QUANTILE, QUANTILE]
    rows = scored.where("perplexity is not null").select("lang", F.ln("perplexity").alias("log"))
    figures = [F.count("log"), F.avg("log"), F.var_pop("log"), F.percentile_approx("log", ends, 100_000)]
    found = [tuple(r) for r in rows.groupBy("lang").agg(*figures).collect()]  # a row for each language
    if not found:
        return {}, None
    spread = _Spread.of([r[1:4] for r in found])
    at = {r[0]: spread.language(*r[1:4]) for r in found}
    names = sorted(x for x in at if x is not None)
    table = F.create_map(*[F.lit(v) for x in names for v in (x, F.array(*[F.lit(y) for y in at[x]]))]) if names else None
    own = F.try_element_at(table, F.col("lang")) if names else F.lit(None).cast("array<double>")
    own = F.coalesce(own, F.array(*[F.lit(y) for y in at.get(None, (0.0, 1.0))]))
    n, average, variance, quantiles, relative = rows.agg(
        *figures, F.percentile_approx((F.col("log") - own[0]) / own[1], ends, 100_000)
    ).first()
    freedom = n + PRIOR[0] - 1
    reach = student(QUANTILE, freedom) * np.sqrt(1 + 1 / freedom)
    beyond = [(n * q + REACH * t) / (n + REACH) for q, t in zip(relative, (-reach, reach), strict=True)]
    whole = float(np.sqrt(spread.within + spread.between))
    return {x: _limits(k, q, beyond, *at[x]) for x, k, _, _, q in found if x is not None}, _limits(n, quantiles, beyond, average, whole)


def classify(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The chosen columns (doc_id and lang by default) of every document with n_bytes, perplexity, its limits
    threshold_low and threshold, and keep.

    The documents are scored once, and the scores (no texts) stored: the limits are taken from them."""
    columns = columns or ["doc_id", "lang"]
    ids = staged(trusted(labels), "trusted")
    rows = docs if set(PLACE) <= set(docs.columns) else placed(docs)
    counted = rows.select("doc_id", *PLACE).join(ids.where("counted"), "doc_id", "left_semi")
    model = train(only(rows.select("text", *PLACE), counted))
    scored = staged(perplexities(docs, model, list(dict.fromkeys([*columns, "doc_id", "lang"]))), "scored")
    limits, common = thresholds(scored.join(ids.where("not counted"), "doc_id", "left_semi"))
    scored = scored.select(*columns, "n_bytes", "perplexity", F.col("lang").alias("__lang"))
    for i, name in enumerate(("threshold_low", "threshold")):
        limit = F.lit(common and common[i]).cast("double")
        if limits:
            table = F.create_map(*[F.lit(x) for k, v in sorted(limits.items()) for x in (k, v[i])])
            limit = F.coalesce(F.try_element_at(table, F.col("__lang")), limit)
        scored = scored.withColumn(name, limit)
    within = F.col("threshold").isNull() | F.col("perplexity").between(F.col("threshold_low"), F.col("threshold"))
    return scored.drop("__lang").withColumn("keep", F.col("perplexity").isNotNull() & within)


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept documents, all columns. The texts are not shuffled (see ``rows``)."""
    docs = placed(docs)
    rejected = classify(docs, labels, ["lang", *PLACE]).where(~F.col("keep"))
    return without(docs, rejected)
