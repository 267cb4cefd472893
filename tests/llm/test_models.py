"""The learned models and the row lists against slow versions, and inputs with clashing names."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayflow.llm import language_id, lm_scoring, packing, quality, rows, simhash, token_output
from assayflow.llm.queries import word_bpe_path


def _buckets(text):
    data = b" " + bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()) + b" "
    codes = [int.from_bytes(data[i : i + 3]) for i in range(len(data) - 2)]
    return Counter((c * 0x9E3779B1 % (1 << 32)) >> 17 for c in codes)


def _likelihood(seen, table, weights):
    return sum(n * np.log(sum(w * table[x][b] for x, w in weights.items())) for b, n in seen.items())


def _mixture(text, table):
    """The set of languages of the largest penalised likelihood, among all sets, and its weights at the optimum."""
    seen = _buckets(text)
    total = sum(seen.values())
    best = None
    for size in range(1, len(table) + 1):
        for names in itertools.combinations(sorted(table), size):
            weights = dict.fromkeys(names, 1 / size)
            for _ in range(400):
                share = dict.fromkeys(names, 0.0)
                for b, n in seen.items():
                    p = {x: weights[x] * table[x][b] for x in names}
                    for x in names:
                        share[x] += n * p[x] / sum(p.values())
                weights = {x: s / total for x, s in share.items()}
            likelihood = _likelihood(seen, table, weights)
            value = likelihood / language_id.OVERLAP - (size - 1) * language_id.PENALTY * 0.5 * np.log(max(total / language_id.OVERLAP, 2))
            if best is None or value > best[0] + 1e-9:
                best = value, weights, likelihood / total
    return best[1:]


def test_language_mixtures_against_all_sets(spark):
    learned = {
        "a": "the quick brown fox jumps over the lazy dog and runs away from the wolf ",
        "b": "der schnelle braune fuchs springt über den faulen hund und läuft weg ",
        "c": "le renard brun rapide saute par dessus le chien paresseux et fuit le loup ",
    }
    seen = {x: _buckets(t * 3) for x, t in learned.items()}
    table = {}
    for x, counts in seen.items():
        total = sum(counts.values()) + language_id.SMOOTHING * language_id.BUCKETS
        table[x] = np.full(language_id.BUCKETS, language_id.SMOOTHING / total)
        for b, n in counts.items():
            table[x][b] = (n + language_id.SMOOTHING) / total
    a, b, c = learned.values()
    texts = [a, b + b, a * 2 + b * 2, a + b * 3 + c * 4, "the fox", "Fuchs", c[:40] + a[:20], "zzzz qqqq", "The WOLF und der HUND et le chien " * 6]
    model = language_id.train(spark.createDataFrame([(t * 3, x) for x, t in learned.items()], "text string, lang string"))
    found = language_id.mixtures(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), model).collect()
    assert len(found) == len(texts)
    for r in found:
        weights, fit = _mixture(r["text"], table)
        got = {x: float(w) for x, w in (part.split(":") for part in r["lang_mix"].split())}
        assert set(got) == set(weights), r["text"]
        assert all(got[x] == pytest.approx(w, abs=0.02) for x, w in weights.items())
        assert r["lang_fit"] == pytest.approx(fit, abs=2e-3) and r["lang_pred"] == max(got, key=got.get)
        assert r["score"] == pytest.approx(max(got.values()), abs=1e-4)


def _off(counts):
    """The discount of each count, by the numbers of counts of one to four."""
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    found = [0.5, 1.0, 1.5]
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        found = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0), i + 1) if n[i] else found[i] for i in range(3)]
    return lambda c: found[min(c, 3) - 1] if c else 0.0


def _slow_model(texts):
    threes = Counter()
    for t in texts:
        data = b"\0\0" + t.encode() + b"\0"
        threes.update(tuple(data[i : i + 3]) for i in range(len(data) - 2))
    twos = Counter((b, c) for _, b, c in threes)
    ones = Counter(c for _, c in twos)

    def level(counts, of):
        off, total, taken = _off(list(counts.values())), Counter(), Counter()
        for key, n in counts.items():
            total[of(key)] += n
            taken[of(key)] += off(n)

        def p(key, below):
            if not total[of(key)]:
                return below
            return (counts[key] - off(counts[key])) / total[of(key)] + taken[of(key)] / total[of(key)] * below

        return p

    one, two, three = level(ones, lambda k: None), level(twos, lambda k: k[0]), level(threes, lambda k: k[:2])

    def perplexity(text):
        data, log = b"\0\0" + text.encode() + b"\0", 0.0
        for i in range(len(data) - 2):
            a, b, c = data[i : i + 3]
            log += np.log2(three((a, b, c), two((b, c), one(c, 1 / 256))))
        return 2 ** (-log / (len(data) - 2))

    return perplexity


def test_quality_perplexities_against_slow_model(spark, docs_table):
    texts = [r["text"] for r in docs_table.collect() if r["text"] and len(r["text"]) < 2000]
    model = quality.train(spark.createDataFrame([(t,) for t in texts[:40]], "text string").repartition(3))
    perplexity = _slow_model(texts[:40])
    asked = [*texts, "Ünknown ßtuff", "x", "the the the the " * 20, texts[0] * 2]
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(asked)], "text string, blob int").repartition(4)
    found = {r["blob"]: r for r in quality.perplexities(frame, model, ["blob"]).collect()}
    assert len(found) == len(asked)
    for i, t in enumerate(asked):
        assert found[i]["n_bytes"] == len(t.encode())
        if t.strip():
            assert found[i]["perplexity"] == pytest.approx(perplexity(t), rel=1e-9)
        else:
            assert found[i]["perplexity"] is None


def test_row_lists_of_ranges(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(rows, "RANGE", 7)
    spark.range(100).select("id", (F.col("id") % 3).alias("part")).repartition(3).write.parquet(f"{tmp_dir}/t")
    at = rows.placed(spark.read.parquet(f"{tmp_dir}/t"))
    listed = at.where("id % 10 = 0 or id between 40 and 60")
    want = {i for i in range(100) if i % 10 == 0 or 40 <= i <= 60}
    assert sorted(r["id"] for r in rows.only(at, listed).collect()) == sorted(want)
    left = rows.without(at, listed)
    assert left.columns == ["id", "part"] and sorted(r["id"] for r in left.collect()) == sorted(set(range(100)) - want)
    assert rows.without(at, listed.limit(0)).count() == 100 and rows.only(at, listed.limit(0)).count() == 0


def test_files_published_twice(tmp_dir):
    from assayflow.llm import shared

    for _ in range(2):
        shared.publish(tmp_dir, "list", [np.arange(3)])
    assert shared.mapped_file(f"{tmp_dir}/list").view(np.int64).tolist() == [0, 1, 2]


CLASHING = (
    "score perplexity fingerprint component_id tile split block shard ids n n_tokens n_bytes blob bucket label codes slot sequence length start "
    "offset threshold keep lang_mix held_out part pattern rank hash docs root node"
).split()


@pytest.mark.parametrize("operator", ["language", "quality", "quality_filter", "simhash", "simhash_filter", "packing", "scoring", "tokens"])
def test_clashing_names_change_nothing(spark, docs_table, tmp_dir, operator):
    trusted = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    run = {
        "language": language_id.identify,
        "quality": lambda docs: quality.classify(docs, trusted.withColumn("counted", F.lit(False))),
        "quality_filter": lambda docs: quality.filter_documents(docs, trusted).select("doc_id", "text"),
        "simhash": simhash.near_duplicates,
        "simhash_filter": lambda docs: simhash.one_of_each(docs).select("doc_id", "text"),
        "packing": lambda docs: packing.pack_documents(docs, word_bpe_path()),
        "scoring": lambda docs: lm_scoring.score(docs, lm_scoring.train(docs)).select("doc_id", "n_tokens", "n_known", "base_score", "score"),
        "tokens": lambda docs: token_output.materialise(docs, word_bpe_path(), 5, length=64, per_shard=8).drop("file"),
    }[operator]
    docs = docs_table.select("doc_id", "text", "lang").coalesce(1)
    docs.write.parquet(f"{tmp_dir}/plain")
    docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)]).write.parquet(f"{tmp_dir}/more")
    plain, more = (run(spark.read.parquet(f"{tmp_dir}/{x}")) for x in ("plain", "more"))
    assert plain.columns == more.columns
    key = lambda r: tuple(str(x) for x in r)
    if operator == "tokens":  # the order within the corpus follows from the file's name
        plain, more = (x.select("n_tokens", "shard", "byte_offset", "slot").drop("n_tokens") for x in (plain, more))
    assert sorted(map(key, plain.collect())) == sorted(map(key, more.collect()))


def test_pipeline_of_an_empty_table(spark, docs_table, tmp_dir):
    import corpus_pipeline

    docs = docs_table.limit(0).selectExpr("doc_id", "text", "lang", "'s' source", "length(text) n_chars", "bits tile")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.read.parquet(f"{tmp_dir}/documents.parquet"), tmp_dir).count() == 0
