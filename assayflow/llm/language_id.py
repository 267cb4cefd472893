"""Language identification as inference of a language mixture.

``train`` counts byte trigrams of lower-cased texts by language. Trigrams are
hashed to ``BUCKETS`` cells, so the model is a table of languages x BUCKETS
whatever the size of the corpus; that is what is sent to the workers.

``mixtures`` gives each document its language proportions: its trigrams are
draws from a mixture of the languages' trigram distributions, whose weights
expectation-maximisation estimates. The set of languages grows from the best
single one: the language with the steepest likelihood gain is added and kept if
the likelihood, less the penalty of one more weight, rises. A document whose
gradient is negative for every other language is at its optimum already
(the likelihood is concave in the weights), so no language is tried in vain.

Defined results: a text that is null or has no letter gets language ``und``,
score 0 and an empty mixture; so does every text if nothing was learned.
A null language is not learned from; languages that tie go to the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bytesops import BLOCK_BYTES, Block, blocks, lower_ascii, segment_sums
from .shared import bounded_batches, tidy

BUCKETS = 1 << 15
SMOOTHING = 0.5
PENALTY = 1.0  # in units of log(observations) / 2 for each added weight
OVERLAP = 3.0  # each byte stands in three trigrams: observations and likelihood count a third
STEPS = 40
TOLERANCE = 1e-3
UNDETERMINED = "und"


def _trigram_counts(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of each document's distinct trigram buckets, and their offsets by document.

    Texts are padded by a space on either side, so a text of n bytes has n trigrams."""
    lengths = np.diff(block.offsets)
    n, docs = len(block.data), len(block)
    owner = np.repeat(np.arange(docs, dtype=np.int32), lengths)
    padded = np.full(n + 2 * docs, 32, np.uint8)
    at = np.arange(n) + 2 * owner + 1
    padded[at] = lower_ascii(block.data)
    code = padded[at - 1].astype(np.uint32) << 16
    code |= padded[at].astype(np.uint32) << 8
    code |= padded[at + 1]
    del at, padded
    code *= np.uint32(0x9E3779B1)
    code >>= np.uint32(32 - 15)
    keys = owner.astype(np.uint64) << np.uint64(15)
    keys |= code
    del code, owner
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if n else np.zeros(0, np.int64)
    keys_first = keys[first]
    counts = np.diff(np.append(first, n))
    offsets = np.searchsorted(keys_first, np.arange(docs + 1, dtype=np.uint64) << np.uint64(15))
    return (keys_first & np.uint64(BUCKETS - 1)).astype(np.int64), counts.astype(np.float32), offsets


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> "LanguageModel":
    """Count trigram buckets of all texts by language. The result has languages x BUCKETS cells."""
    bounded_batches(docs.sparkSession)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for block in blocks(batch.column("text")):
                bucket, counts, offsets = _trigram_counts(block)
                owner = np.repeat(np.arange(len(block)), np.diff(offsets))
                own = np.array(langs[block.first : block.last], object)
                for name in set(own.tolist()):
                    mine = (own == name)[owner]
                    table = seen.setdefault(name, np.zeros(BUCKETS))
                    table += np.bincount(bucket[mine], weights=counts[mine], minlength=BUCKETS)
        for name, table in seen.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(table[at].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.mapInArrow(count, "lang string, bucket int, n long")
    cells = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(cells["lang"].to_pylist()))
    table = np.zeros((len(names), BUCKETS))
    if names:
        index = {x: i for i, x in enumerate(names)}
        row = np.array([index[x] for x in cells["lang"].to_pylist()], np.int64)
        table[row, cells["bucket"].to_numpy()] = cells["n"].to_numpy()
    smoothed = table + SMOOTHING
    return LanguageModel(names, (smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32))


class LanguageModel:
    """Trigram-bucket probabilities, one row for each language, in the order of the names."""

    def __init__(self, names: list[str], probabilities: np.ndarray):
        self.names, self.probabilities = names, probabilities

    def proportions(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Language weights of each document of the block (a zero row for an empty text), and the mean
        log likelihood of its trigrams under that mixture."""
        bucket, counts, offsets = _trigram_counts(block)
        docs, langs = len(block), len(self.names)
        theta = np.zeros((docs, langs))
        if not langs:
            return theta, np.zeros(docs)
        lik = self.probabilities.T[bucket].astype(np.float64)
        counts = counts.astype(np.float64)
        total = segment_sums(counts, offsets)
        alone = segment_sums(counts[:, None] * np.log(lik), offsets)
        best = alone.argmax(axis=1)
        theta[np.arange(docs), best] = total > 0
        loglik = alone[np.arange(docs), best]
        open_ = np.flatnonzero(total > 0)
        for _ in range(langs - 1):
            if not len(open_):
                break
            open_ = self._grow(open_, lik, counts, offsets, total, theta, loglik)
        return theta, loglik / np.maximum(total, 1)

    @staticmethod
    def _grow(open_, lik, counts, offsets, total, theta, loglik) -> np.ndarray:
        """Try one more language for each open document; the documents that took it."""
        size = np.diff(offsets)[open_]
        rows = np.repeat(offsets[:-1][open_] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        at = np.concatenate([[0], np.cumsum(size)])
        owner = np.repeat(np.arange(len(open_)), size)
        sub, n = lik[rows], counts[rows]
        old = theta[open_]
        share = n[:, None] * sub / (sub * old[owner]).sum(axis=1, keepdims=True)
        gain = segment_sums(share, at) - total[open_][:, None]
        gain[old > 0] = -np.inf
        new = gain.argmax(axis=1)
        hopeful = gain[np.arange(len(open_)), new] > 0
        if not hopeful.any():
            return open_[:0]
        chosen = np.flatnonzero(hopeful)
        keep = hopeful[owner]
        sub, n = sub[keep], n[keep]
        size = size[chosen]
        at = np.concatenate([[0], np.cumsum(size)])
        owner = np.repeat(np.arange(len(chosen)), size)
        weights = old[chosen] * 0.9
        weights[np.arange(len(chosen)), new[chosen]] = 0.1
        mass = total[open_][chosen]
        for _ in range(STEPS):
            part = sub * weights[owner]
            part *= (n / part.sum(axis=1))[:, None]
            updated = segment_sums(part, at) / mass[:, None]
            moved = np.abs(updated - weights).max()
            weights = updated
            if moved < TOLERANCE:
                break
        reached = segment_sums(n * np.log((sub * weights[owner]).sum(axis=1)), at)
        docs = open_[chosen]
        better = (reached - loglik[docs]) / OVERLAP > PENALTY * 0.5 * np.log(np.maximum(mass / OVERLAP, 2.0))
        taken = docs[better]
        theta[taken] = weights[better]
        loglik[taken] = reached[better]
        return taken


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder


def mixtures(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents, every column kept, with ``lang_pred``, ``score``, ``lang_mix`` and ``lang_fit``.

    ``lang_pred`` is the language with the largest weight, ``score`` that weight and
    ``lang_mix`` the text ``name:weight`` of the chosen languages, largest first; ``lang_fit`` is
    the mean log likelihood of the text's trigrams under the mixture (null without one).
    Columns of these names are replaced."""
    own = ["lang_pred", "score", "lang_mix", "lang_fit", "__letters"]
    kept = docs.drop(*own)
    source = kept.withColumn("__letters", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema += ", lang_pred string, score double, lang_mix string, lang_fit double"

    bounded_batches(docs.sparkSession)
    size = max(1, BLOCK_BYTES // max(1, len(model.names)))  # a block's arrays have a column for each language

    @tidy
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("__letters").to_numpy(zero_copy_only=False).astype(bool)
            kept = [(i, name) for i, name in enumerate(batch.schema.names) if name != "__letters"]
            for block in blocks(batch.column(text), size):
                names, scores, mixes = [], [], []
                theta, fit = model.proportions(block)
                theta[~letters[block.first : block.last]] = 0
                for row in theta:
                    order = [i for i in np.argsort(-row, kind="stable") if row[i] > 0]
                    names.append(model.names[order[0]] if order else UNDETERMINED)
                    scores.append(min(1.0, float(row[order[0]])) if order else 0.0)
                    mixes.append(" ".join(f"{model.names[i]}:{row[i]:.4f}" for i in order))
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i, _ in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(mixes, pa.string()), pa.array(fit, mask=~theta.any(axis=1))],
                    [*[name for _, name in kept], "lang_pred", "score", "lang_mix", "lang_fit"],
                )

    return source.mapInArrow(predict, schema)


def least_fits(docs: DataFrame, model: LanguageModel, quantile: float) -> dict[str, float]:
    """For each language, a low quantile of ``lang_fit`` over all documents labelled with it."""
    fits = mixtures(docs.where("lang is not null").select("text", "lang"), model).where("lang_fit is not null").groupBy("lang")
    found = fits.agg(F.percentile_approx("lang_fit", quantile, 100_000).alias("least"))
    return {r["lang"]: r["least"] for r in found.collect()}  # a row for each language


def identify(docs: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Predictions for all documents by a model of those outside the held-out part."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id"), modulus, remainder))
    model = train(rows.where(~F.col("held_out")))
    return mixtures(rows.select("doc_id", "text", "held_out"), model).drop("text", "lang_fit")
