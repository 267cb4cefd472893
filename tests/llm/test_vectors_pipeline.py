"""The operators on vectors, components and the pipeline against brute-force versions."""

import importlib.util
import random

import numpy as np
import pytest

from assayflow.llm import embed_dedup, topk
from assayflow.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, code long"


def _vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((400, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    cosine = rng.uniform(0.981, 0.99, (400, 1))
    dense = x[0] + 0.006 * rng.standard_normal((700, 64))
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * z, dense]).astype(np.float32)
    rows = [(i, v.tolist(), i % 400 % 3, i) for i, v in enumerate(both[:800])] + [(800 + i, v.tolist(), 0, i) for i, v in enumerate(both[800:])]
    bad = [None, [0.0] * 64, [None] * 64, [float("nan")] * 64, [float("inf")] * 64, []]
    rows += [(5000 + i, v, 1, 0) for i, v in enumerate(bad)] + [(6000, rows[0][1], None, 0), (None, rows[0][1], 0, 0)]
    rows += [(6001, rows[0][1][:3], 0, 0), rows[5], rows[5]]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_embedding_links(spark):
    rows, frame = _vectors(spark)
    found = embed_dedup.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    good = [r for r in rows if r[0] is not None and r[0] < 5000]
    x = np.array([r[1] for r in good], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = dict(zip([r[0] for r in good], near.sum(axis=1).tolist(), strict=True))
    got = {r["vec_id"]: r["n_links"] for r in found}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got[i] for i in want) >= 0.99 * sum(want.values())
    assert all(r["n_links"] == 0 and r["component_id"] == r["vec_id"] and r["kept"] for r in found if r["vec_id"] is None or r["vec_id"] >= 5000)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [64, 100])
def test_embedding_links_of_planted_pairs(spark, dim):
    rng = np.random.default_rng(dim)
    x, z = rng.standard_normal((2, 500, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    cosine = rng.uniform(0.9801, 0.985, (500, 1))
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * z]).astype(np.float32)
    rows = [(i, v.tolist(), 0, i) for i, v in enumerate(both)]
    links = sum(r["n_links"] for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert 900 <= links <= 1000


def _met(x, y):
    """Whether the rows of two arrays of codes share a bucket, one's own being among both's."""
    own = (x[:, :, 0] == y[:, :, 0]).any(axis=1)
    return own | (x[:, :, 1:] == y[:, :, :1]).any(axis=(1, 2)) | (y[:, :, 1:] == x[:, :, :1]).any(axis=(1, 2))


@pytest.mark.parametrize("dim", [64, 100, 768])
@pytest.mark.parametrize("rows", [3, 1000, 320_000, 30_000_000])
def test_embedding_recall_at_every_size(dim, rows):
    rng = np.random.default_rng(dim)
    x, z = rng.standard_normal((2, 300, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9801 * x + np.sqrt(1 - 0.9801**2) * z
    bits = embed_dedup.bucket_bits(rows)
    assert _met(embed_dedup.bucket_codes(x, bits), embed_dedup.bucket_codes(y, bits)).mean() >= 0.97


def test_embedding_pairs_grow_with_the_rows():
    def pairs_of_a_row(rows):
        x = np.random.default_rng(rows).standard_normal((rows, 64))
        codes = np.concatenate([embed_dedup.bucket_codes(part, embed_dedup.bucket_bits(rows)) for part in np.array_split(x, 1 + rows // 2000)])
        met = 0
        for table in range(embed_dedup.TABLES):
            home, size = np.unique(codes[:, table, 0], return_counts=True)
            at = np.searchsorted(home, codes[:, table]).clip(0, len(home) - 1)
            met += np.where(home[at] == codes[:, table], size[at], 0).sum()
        return met / rows

    few, many = pairs_of_a_row(5_000), pairs_of_a_row(40_000)
    assert 0.5 < many / few < 2


def test_embedding_components_against_brute_force(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((40, 32))
    x = np.concatenate([c + 0.05 * rng.standard_normal((6, 32)) for c in centre] + [centre]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), i % 2, 0) for i, v in enumerate(x)], SCHEMA)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x)) % 2)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.where(near, label[None, :], len(x)).min(axis=1)
    want = {i: (int(near[i].sum()) - 1, int(label[i])) for i in range(len(x))}
    assert len(set(label)) < len(x) - 20
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(frame).collect()} == want


def test_embedding_links_of_extreme_lengths(spark):
    rows = [(1, [1e200, 1e199], 0, 0), (2, [2e200, 2.1e199], 0, 0), (3, [1e-200, 1e-201], 0, 0), (4, [-1e200, 0.0], 0, 0), (5, [1e200, 1e199], 1, 0)]
    found = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code long")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def _slow_top_k(rows):
    """Sorted result rows for (id, vector) rows."""
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            whole.append((i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]))
    out = []
    for a, (q, x) in enumerate(whole):
        if q % 100 == 0:
            scores = sorted((-sum(m * n for m, n in zip(x, v, strict=True)), i) for b, (i, v) in enumerate(whole) if a != b and len(v) == len(x))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:10], 1)]
    return sorted(out)


def test_top_k(spark):
    rows, frame = _vectors(spark)
    assert sorted(map(tuple, topk.top_k(frame).collect())) == _slow_top_k([r[:2] for r in rows])
    assert topk.top_k(frame.limit(0)).count() == 0


def test_top_k_of_repeated_ids_and_vectors(spark):
    rows = [(100, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [9.0, 9.0]), (7, [1.0, 2.0]), (8, [0.5, 0.5]), (100, [1.0, 2.0]), (200, []), (9, []), (-100, [3.0])]
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, row int, cells long").repartition(3)
    found = topk.top_k(frame)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == _slow_top_k(rows)
    assert found.agg({"score": "max"}).first()[0] == 28_311_552


def test_top_k_reads_few_exact_vectors(spark, monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(topk, "BLOCK", 300)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    assert sorted(map(tuple, topk.top_k(frame).collect())) == _slow_top_k(rows)


def test_components(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(50)] + [(100, j) for j in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    random.shuffle(edges)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, docs_table, tmp_dir):
    assert importlib.util.find_spec("corpus_pipeline")
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "packing"]
    docs = docs_table.selectExpr("doc_id", "text", "lang", "'s' source", "length(text) n_chars")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    at = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, at, tmp_dir).write.parquet(f"{tmp_dir}/{k}")
        at = spark.read.parquet(f"{tmp_dir}/{k}")
        assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(at.count())
    assert kept[0] == 63 and kept[1] == 63  # all with words: 60, the long one, two repeated rows
    ids = [r["doc_id"] for r in at.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < 62
    packed = corpus_pipeline.run(spark, tmp_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(ids)


def test_language_stage(spark, docs_table, tmp_dir):
    import corpus_pipeline

    docs = docs_table.selectExpr("doc_id", "text", "lang", "'s' source", "length(text) n_chars")
    odd = [(900, "xqzj wvkq zzxq jjqx " * 30, None, "s", 600), (901, "the lazy dog runs away from the wolf", None, "s", 36)]
    docs.union(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{tmp_dir}/mixed")
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_stage(spark, spark.read.parquet(f"{tmp_dir}/mixed"), tmp_dir).collect()}
    assert 900 not in kept and kept[901] == kept[104] == "en" and set(range(60)) <= set(kept)
    docs.selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars").write.parquet(f"{tmp_dir}/none")
    kept = corpus_pipeline.language_stage(spark, spark.read.parquet(f"{tmp_dir}/none"), tmp_dir).collect()
    assert len(kept) == 63 and all(r["lang"] is None for r in kept)
