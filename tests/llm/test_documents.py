"""The operators on documents against brute-force versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from assayflow.llm import bpe, language_id, lm_scoring, packing, quality, sharding, simhash, token_output
from assayflow.llm.bytesops import blocks
from assayflow.llm.queries import word_bpe_path

PATH = word_bpe_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_language(spark, docs_table, no_docs):
    found = language_id.identify(docs_table).collect()
    assert len(found) == docs_table.count()
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    for i in (100, 101, 102, 103, 105):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0.0
    assert by_id[104]["lang_pred"] == "en" and 0 < by_id[104]["score"] <= 1
    assert by_id[7]["held_out"] == (zlib.crc32(b"7") % 4 == 2)
    assert language_id.identify(no_docs).count() == 0


def test_language_mixture_shares(spark):
    a, b = "alpha beta gamma delta ", "zzyx wvut qqrk jjhx "
    train = spark.createDataFrame([(a * 50, "a"), (b * 50, "b")], "text string, lang string")
    mixed = spark.createDataFrame([(a * 30 + b * 10,), (a * 40,)], "text string")
    found = language_id.mixtures(mixed, language_id.train(train)).collect()
    assert found[0]["lang_pred"] == "a" and 0.6 < found[0]["score"] < 0.9 and "b:" in found[0]["lang_mix"]
    assert found[1]["score"] == 1.0


def test_simhash_against_brute_force(spark, docs_table, no_docs):
    def slow(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = docs_table.collect()
    found = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs_table).collect())
    prints = [slow(r["text"]) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    first = defaultdict(list)
    for x, r in zip(label, rows, strict=True):
        first[x].append(r["doc_id"])
    want = sorted((r["doc_id"] or -1, f"{p:016x}", min((i for i in first[x] if i is not None), default=None)) for r, p, x in zip(rows, prints, label, strict=True))
    assert found == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_tiles_find_all_links(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near])).astype(np.int64)
    frame = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    links = simhash.links(frame, tile=4).collect()
    label = np.arange(len(fps))
    at = {int(x): i for i, x in enumerate(fps)}
    simhash._join_labels(label, np.array([at[r["a"]] for r in links]), np.array([at[r["b"]] for r in links]))
    want = np.arange(len(fps))
    bits = fps.view(np.uint64)
    a, b = np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4)
    simhash._join_labels(want, a, b)
    assert (label == want).all()


def test_bpe_equals_the_library(spark, tokenizer, docs_table, no_docs):
    random.seed(5)
    texts = ["Hello World's don't", "aaaaaaaaaa ababab", "İstanbul ΟΔΟΣ", "café ÉA", "a<|endoftext|>b <|ENDOFTEXT|>", "日本 😀😀", "a\x85b\x1cc"]
    texts += ["".join(random.choice("abAB ,.!1%éßΣKİ́'<|>endoftxsrlv日\n") for _ in range(random.randint(0, 40))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string")
    for frame in (rows, docs_table):
        want = {(r["doc_id"], r["text"]): _ids(tokenizer, r["text"]) for r in frame.collect()}
        encoded = bpe.encode(frame.withColumn("own", frame["text"]), PATH)
        for r in bpe.decode(encoded, PATH).collect():
            ids = want[r["doc_id"], r["own"]]
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids
            assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.encode(no_docs, PATH, decoded=True).count() == 0


def test_packing(spark, tokenizer, docs_table, no_docs):
    rows = packing.pack_documents(docs_table, PATH, capacity=64).collect()
    want = Counter()
    for r in docs_table.collect():
        ids = np.array([*_ids(tokenizer, r["text"]), 2], "<u4")
        for at in range(0, len(ids), 64):
            want[r["doc_id"], at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    packs = defaultdict(list)
    for r in rows:
        packs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(packs) == list(range(len(packs)))
    for found in packs.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 64
    assert len(packs) <= math.ceil(sum(r["length"] for r in rows) / 64) * 1.1 + 1
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_shortest_pack_first_uses_every_length():
    patterns = packing.shortest_pack_first({10: 7, 6: 3, 4: 11, 1: 5}, 10)
    placed = Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 10
        for x in lengths:
            placed[x] += n
    assert placed == {10: 7, 6: 3, 4: 11, 1: 5}


def test_scoring_against_brute_force(spark, docs_table, no_docs):
    frame = docs_table.withColumn("held_out", language_id.held_out(docs_table["doc_id"], 7, 2))
    model = lm_scoring.train(frame.where("not held_out"))
    rows = frame.collect()
    texts = [[*(r["text"] or "").encode().lower().split(), None] for r in rows]
    words, pairs = Counter(), Counter()
    for t, r in zip(texts, rows, strict=True):
        if not r["held_out"]:
            words.update(t)
            pairs.update(zip(["begin", *t[:-1]], t, strict=True))
    total, types = sum(words.values()), len(words)
    context, follow, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (h, w), n in pairs.items():
        context[h] += n
        follow[h][min(n, 3) - 1] += 1
        before[w] += 1
    of = lambda c: np.concatenate([[0], lm_scoring.discounts(np.array([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]))])
    d2, d1 = of(pairs), of(before)
    rest = sum(d1[min(v, 3)] for v in before.values()) / len(pairs)

    def p(h, w):
        low = rest / (types + 1) + (before[w] - d1[min(before[w], 3)]) / len(pairs)
        if h not in context:
            return low
        c = pairs[h, w]
        return (c - d2[min(c, 3)]) / context[h] + sum(d2[1:] * follow[h]) / context[h] * low

    assert abs(sum(p(b"the", w) for w in words) + p(b"the", "unknown") - 1) < 1e-9
    found = lm_scoring.score(frame, model).collect()
    assert len(found) == len(rows)
    got = {(r["doc_id"], r["n_tokens"], r["n_known"]): r for r in found}
    for t, r in zip(texts, rows, strict=True):
        own = got[r["doc_id"], len(t), sum(w in words for w in t)]
        assert own["train_tokens"] == total
        assert own["base_score"] == pytest.approx(sum(math.log10((words[w] + 1) / (total + types + 1)) for w in t))
        assert own["score"] == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip(["begin", *t[:-1]], t, strict=True)))
    nothing = lm_scoring.train(no_docs)
    assert {r["score"] for r in lm_scoring.score(docs_table, nothing).collect()} == {0.0}


def test_quality(spark, docs_table, no_docs):
    trusted = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(59, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs_table, trusted).collect()
    assert len(found) == docs_table.count()
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["keep"] for i in range(60)) and by_id[104]["keep"]
    assert not any(by_id[i]["keep"] for i in (100, 101, 102, 103, 105))
    assert by_id[100]["perplexity"] is None
    kept = quality.filter_documents(docs_table, trusted)
    assert kept.columns == docs_table.columns and kept.count() == sum(r["keep"] for r in found)
    assert quality.classify(docs_table, trusted.limit(0)).where("keep").count() == 64  # all with a word
    assert quality.classify(no_docs, trusted).count() == 0


@pytest.fixture(scope="module")
def many_trusted(spark, tmp_path_factory):
    """24,000 short documents, all trusted, one in 200 of a rare language; and their labels."""
    path = str(tmp_path_factory.mktemp("many") / "documents.parquet")
    words = F.concat_ws(" ", *[F.substring(F.md5(F.concat("id", F.lit(k))), 1, 4) for k in "abcdef"])
    lang = F.when(F.col("id") % 200 == 0, "rare").otherwise("hot")
    spark.range(24_000).select(F.col("id").alias("doc_id"), words.alias("text"), lang.alias("lang")).write.parquet(path)
    docs = spark.read.parquet(path)
    return docs, docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))


def test_quality_thresholds_of_all_left_out(many_trusted):
    docs, labels = many_trusted
    found = quality.classify(docs, labels).join(quality.trusted(labels).where("not counted"), "doc_id", "left_semi").collect()
    hot = np.sort([r["perplexity"] for r in found if r["lang"] == "hot"])
    low, high = next((r["threshold_low"], r["threshold"]) for r in found if r["lang"] == "hot")
    assert high == pytest.approx(hot[int(np.ceil(quality.QUANTILE * len(hot))) - 1], rel=0.02)
    assert low == pytest.approx(hot[int(np.ceil((1 - quality.QUANTILE) * len(hot))) - 1], rel=0.02)
    rare = [r["perplexity"] for r in found if r["lang"] == "rare"]
    assert 20 <= len(rare) < 1000
    low, high = next((r["threshold_low"], r["threshold"]) for r in found if r["lang"] == "rare")
    assert low < min(rare) and high > max(rare)


def test_quality_rejects_on_both_sides(many_trusted, spark):
    docs, labels = many_trusted
    junk = [(-1, "00 " * 400, "hot"), (-2, "ÄÖÜ?! " * 5, "hot")]
    path = docs.inputFiles()[0].rsplit("/", 1)[0] + "-and-junk"
    docs.union(spark.createDataFrame(junk, docs.schema)).write.mode("overwrite").parquet(path)
    found = {r["doc_id"]: r for r in quality.classify(spark.read.parquet(path), labels).collect()}
    assert found[-1]["perplexity"] < found[-1]["threshold_low"] and found[-2]["perplexity"] > found[-2]["threshold"]
    assert not found[-1]["keep"] and not found[-2]["keep"]
    assert sum(r["keep"] for r in found.values()) > 0.99 * 24_000


def test_quality_counts_all_trusted_documents(many_trusted, monkeypatch):
    docs, labels = many_trusted
    learned, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda texts: learned.append(texts.count()) or train(texts))
    quality.classify(docs, labels)
    assert 17_500 < learned[0] < 18_500  # three quarters


def test_quality_trigrams_of_every_byte():
    texts = ["", None, "a", "\x00", "a\x00b", "漢字é\n", "ab" * 5000, *["x" * k for k in range(40)]]
    found = []
    for block in blocks(pa.array(texts), 100):
        owner, codes = quality._trigrams(block)
        found += [(block.first + int(i), int(c)) for i, c in zip(owner, codes, strict=True)]
    want = []
    for i, text in enumerate(texts):
        raw = b"\0\0" + (text or "").encode() + b"\0"
        want += [(i, raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]) for k in range(len(raw) - 2)]
    assert found == want


def test_quality_counts_beyond_32_bits():
    keys, counts = np.array([3, 9], np.uint64), np.array([7, 5 << 32], np.int64)
    assert [x.tolist() for x in quality.unpack(quality.pack(keys, counts, "<u8"), "<u8")] == [[3, 9], [7, 5 << 32]]


def test_pair_counts_beyond_32_bits(tmp_dir):
    from assayflow.llm.shared import write_file

    model = object.__new__(lm_scoring.NgramModel)
    model.pairs = [write_file(tmp_dir, "pairs", [np.array([3, 9], np.uint64), np.array([7, 5 << 32], np.uint64)])]
    assert model._in_shard(0, np.array([1, 3, 9, 10], np.uint64)).tolist() == [0, 7, 5 << 32, 0]


@pytest.mark.parametrize("n", [1, 3, 30, 300, 3000, 30_000])
def test_quality_limits_by_one_estimator(spark, n):
    assert [quality.student(0.999, k) for k in (4, 10, 100)] == pytest.approx([7.173, 4.144, 3.174], rel=0.01)
    rng = np.random.default_rng(n)
    rows = [("all", float(x)) for x in np.exp(1 + 0.1 * rng.standard_normal(5000))] + [("own", float(x)) for x in np.exp(1.5 + 0.1 * rng.standard_normal(n))]
    limits, common = quality.thresholds(spark.createDataFrame([*rows, (None, 2.7), ("all", None)], "lang string, perplexity double"))
    low, high = limits["own"]
    fresh = np.exp(1.5 + 0.1 * rng.standard_normal(20_000))
    assert np.mean((fresh < low) | (fresh > high)) < 0.01  # few documents or many
    if n >= 3000:  # the language's quantile
        logs = np.log([x for lang, x in rows if lang == "own"])
        assert np.log([low, high]) == pytest.approx(np.quantile(logs, [0.001, 0.999]), abs=0.02)
    every = np.quantile([x for _, x in rows], [0.001, 0.999])
    assert common[0] < every[0] * 1.02 and common[1] > every[1] * 0.98  # the quantiles of all, or wider


def test_quality_limits_do_not_jump():
    before, quantiles, beyond = None, [0.7, 1.4], [-3.2, 3.3]
    for n in range(1, 3000):
        now = np.log(quality._limits(n, quantiles, beyond, 1.0, 0.1))
        assert before is None or np.abs(now - before).max() < 0.001
        before = now
    assert np.log(quality._limits(10**9, quantiles, beyond, 1.0, 0.1)) == pytest.approx(quantiles, abs=1e-4)


def test_quality_limits_of_none_and_one(spark):
    empty = spark.createDataFrame([], "lang string, perplexity double")
    assert quality.thresholds(empty) == ({}, None)
    limits, common = quality.thresholds(spark.createDataFrame([("a", 3.0)], "lang string, perplexity double"))
    assert limits["a"][0] < 3.0 < limits["a"][1] and common[0] < 3.0 < common[1]


def test_quality_model_sums_to_one(spark):
    model = quality.train(spark.createDataFrame([("abracadabra banana",), ("cabana",)], "text string"))
    at = {r["shard"]: bytes(r["counts"]) for r in model.table.collect()}
    for context in (b"an", b"br", b"zz", b"\0\0"):
        codes = (int.from_bytes(context) << 8) + np.arange(256)
        shard = quality._Shard(at.get(int(quality._shard(codes[:1], model.shards)[0])), model.top, model.lower)
        assert np.exp2(shard.log2(codes)).sum() == pytest.approx(1)


def test_sharding_fits_and_splits_copies(spark, no_docs):
    rows = [(i, "x" * (i % 50)) for i in range(100)] + [(7, "hot copy text")] * 60 + [(None, None)] * 3 + [(999, "y" * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.assign(frame, 100).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in rows)
    shards = defaultdict(list)
    for r in found:
        shards[r["depth"], r["prefix"], r["part"]].append(r["bytes"])
    assert all(sum(x) <= 100 or len(x) == 1 for x in shards.values())
    assert sum(part > 0 for _, _, part in shards) >= 7
    assert sharding.assign(no_docs, 100).count() == 0


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000):
        slots = token_output.permute(np.arange(n), n, 9)
        assert sorted(slots) == list(range(n))
        assert (token_output.permute(slots, n, 9, inverse=True) == np.arange(n)).all()
    assert (token_output.permute(np.arange(1000), 1000, 9) != token_output.permute(np.arange(1000), 1000, 10)).any()


def test_training_order_round_trip(spark, tokenizer, docs_table, no_docs):
    stored = token_output.materialise(docs_table, PATH, key=5, length=32, per_shard=16)
    rows = sorted(stored.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    sequences = list(token_output.read_sequences(stored, length=32, per_shard=16))
    assert len(sequences) == len(rows)
    assert [zlib.crc32(x.tobytes()) for x in sequences] == [r["ids_crc32"] for r in rows]
    assert (next(token_output.read_sequences(stored, 21, length=32, per_shard=16)) == sequences[21]).all()
    real = [x[: r["n_tokens"]] for _, x, r in sorted(zip([r["sequence"] for r in rows], sequences, rows, strict=True), key=lambda t: t[0])]
    want = Counter(hashlib.sha256(np.array(_ids(tokenizer, r["text"]), "<u2").tobytes()).hexdigest() for r in docs_table.collect())
    flat = np.concatenate(real)
    ends = np.flatnonzero(flat == 2)
    got = Counter(hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip([0, *(ends[:-1] + 1)], ends, strict=True))
    assert got == want
    assert token_output.materialise(no_docs, PATH, key=5).count() == 0


def test_other_tokenizer_files_are_refused(tmp_dir, no_docs):
    import json

    from assayflow.llm.chunks import cuts_at_runs

    cuts_at_runs(PATH)
    with open(PATH, encoding="utf-8") as source:
        spec = json.load(source)
    changes = [
        {"pre_tokenizer": {"type": "WhitespaceSplit"}}, {"normalizer": None}, {"post_processor": {"type": "ByteLevel"}},
        {"added_tokens": [{"id": 1, "content": "end of text"}]}, {"normalizer": {"type": "Lowercase"}},
    ]
    for i, change in enumerate(changes):
        path = f"{tmp_dir}/{i}.json"
        with open(path, "w") as out:
            json.dump(spec | {"model": {}} | change, out)
        for refused in (lambda: cuts_at_runs(path), lambda: packing.pieces(no_docs, path), lambda: token_output.materialise(no_docs, path, 1)):
            with pytest.raises(ValueError, match="another way"):
                refused()


def test_several_shards_in_a_task(spark, docs_table, monkeypatch):
    monkeypatch.setattr(token_output, "SHARDS_PER_TASK", 3)
    clashing = docs_table.withColumn("split", F.lit(1)).withColumn("slot", F.lit(2))
    stored = token_output.materialise(clashing, PATH, key=5, length=16, per_shard=8)
    assert stored.select("shard").distinct().count() > 12 and stored.select("file").distinct().count() == stored.select("shard").distinct().count()
    rows = sorted(stored.collect(), key=lambda r: r["slot"])
    assert [r["byte_offset"] for r in rows] == [r["slot"] % 8 * 32 for r in rows]
    assert [zlib.crc32(x.tobytes()) for x in token_output.read_sequences(stored, length=16, per_shard=8)] == [r["ids_crc32"] for r in rows]


def test_arrow_slices_keep_their_texts():
    from assayflow.llm.bytesops import blocks

    column = pa.array(["skip", "", None, "abc", "é"]).slice(1)
    found = [(b.first + i, b.text(i)) for b in blocks(column, 3) for i in range(len(b))]
    assert found == [(0, b""), (1, b""), (2, b"abc"), (3, "é".encode())]
