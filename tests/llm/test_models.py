"""Language identification, quality classifier and language-model score."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import make  # noqa: F401
from pyspark.sql import functions as F

from llm import language_id, ppm, quality, queries

SF = "/root/testdata/sf0.01"


def test_language_id_held_out_accuracy(spark):
    found = queries.op2_language_id(spark, SF).toPandas()
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    found = found.merge(lang, on="doc_id")
    assert len(found) == len(lang)
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    assert (found[found.held_out].lang_pred == found[found.held_out].lang).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_language_id_odd_rows(given, odd_docs, no_docs):
    model = language_id.fit(given)
    rows = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(odd_docs, model).collect()}
    assert {(i, "und", 0.0) for i in (0, 1, 2, 3)} <= rows
    assert language_id.predict(odd_docs, model).count() == odd_docs.count()
    assert language_id.predict(no_docs, model).count() == 0
    nothing = language_id.fit(no_docs)
    assert {r["lang_pred"] for r in language_id.predict(given, nothing).collect()} == {"und"}


def test_far_texts_are_rejected(spark, given):
    model = language_id.fit(given)
    far = make(spark, ["щука ъеж жыр " * 50])
    assert language_id.predict(far, model).first()["rejected"]
    assert language_id.predict(given, model).where("rejected").count() < 0.1 * given.count()


def test_gram_counts_by_hand():
    one = language_id.gram_counts(["ab, Ab", "", "1 2"])
    assert one[1].sum() == one[2].sum() == 0
    # a, b, a, b; ab, b_, _a, ab, b_ ; and the triples
    again = language_id.gram_counts(["AB ab"])
    assert (one[0] == again[0]).all()


def test_centroids_of_one_language_are_several(given):
    model = language_id.fit(given, clusters=3)
    assert max(Counter(model["labels"]).values()) == 3


def test_quality_held_out(spark):
    found = queries.op3_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert ((found.score >= 0.3) == (found.predicted == 1)).all() and found.score.between(0, 1).all()
    both = found.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.93
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([(g > bad).mean() + 0.5 * (g == bad).mean() for g in good]) > 0.97


def test_class_prior_and_risk():
    rng = np.random.default_rng(5)
    p = rng.normal(2, 1, (1500, 3))
    u = np.concatenate([rng.normal(2, 1, (1400, 3)), rng.normal(-2, 1, (600, 3))])
    first = quality.minimise(p[::2], u, 0.5)
    cuts = quality.cuts_of(p[1::2] @ first[:-1])
    prior = quality.class_prior(p[1::2] @ first[:-1], cuts, ((u @ first[:-1])[None, :] >= cuts[:, None]).mean(axis=1))
    assert abs(prior - 0.7) < 0.06
    w = quality.minimise(p, u, prior)
    score = u @ w[:-1] + w[-1]
    assert (score[:1400] > 0).mean() > 0.95 and (score[1400:] < 0).mean() > 0.95


def test_quality_statistics_cover_all_texts(given):
    texts = given.select("doc_id", "text").repartition(3)
    x = quality.features([r["text"] or "" for r in texts.collect()])
    mean, spread, n = quality.moments(texts)
    assert n == len(x) and np.allclose(mean, x.mean(axis=0)) and np.allclose(spread, x.std(axis=0), atol=1e-6)
    model = {"mean": mean, "scale": spread + 0.02, "weights": np.random.default_rng(1).normal(size=x.shape[1] + 1)}
    score = np.clip((x - mean) / (spread + 0.02), -6, 6) @ model["weights"][:-1] + model["weights"][-1]
    cuts = np.quantile(score, [0.1, 0.5, 0.9]) + 1e-7
    assert quality.shares_above(texts, model, cuts).tolist() == [(score >= c).mean() for c in cuts]


def brute_risk(w, p, u, prior):
    loss = lambda x, y: math.log1p(math.exp(-y * (sum(a * b for a, b in zip(w, x)) + w[-1])))
    mean = lambda rows, y: sum(loss(x, y) for x in rows) / len(rows)
    return prior * mean(p, 1) + max(0.0, mean(u, -1) - prior * mean(p, -1)) + 5e-4 * sum(a * a for a in w[:-1])


def test_weights_minimise_the_risk():
    rng = np.random.default_rng(9)
    p = rng.normal(1, 1, (60, 2))
    u = np.concatenate([rng.normal(1, 1, (40, 2)), rng.normal(-1, 1, (40, 2))])
    w = quality.minimise(p, u, 0.5, steps=3000, rate=0.01)
    best = brute_risk(w, p, u, 0.5)
    for _ in range(200):
        assert brute_risk(w + rng.normal(0, 0.1, 3), p, u, 0.5) > best - 1e-3


def test_language_prediction_equals_brute_force(given):
    model = language_id.fit(given)
    docs = given.limit(25)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language_id.predict(docs, model).collect():
        counts = language_id.gram_counts([texts[r["doc_id"]]])[0]
        vector = [math.log1p(n) * w for n, w in zip(counts, model["idf"])]
        norm = math.sqrt(sum(x * x for x in vector))
        if not norm:
            assert r["lang_pred"] == "und"
            continue
        cosine = [sum(x * float(y) for x, y in zip(vector, c)) / norm for c in model["centres"]]
        best = {}
        for label, value in zip(model["labels"], cosine):
            best[label] = max(value, best.get(label, -1))
        assert r["lang_pred"] == max(best, key=best.get)
        top = max(best.values())
        assert r["score"] == pytest.approx(1 / sum(math.exp(25 * (v - top)) for v in best.values()), abs=1e-6)
        assert r["distance"] == pytest.approx(1 - top, abs=1e-6)


def test_quality_odd_rows(spark, odd_docs, no_docs, given):
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(150)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(given, quality.trusted(given, labels))
    assert quality.predict(odd_docs, model).count() == odd_docs.count()
    assert quality.predict(no_docs, model).count() == 0
    assert quality.fit(no_docs, no_docs) is None
    assert {r["score"] for r in quality.predict(odd_docs, None).collect()} == {0.5}
    kept = quality.keep(odd_docs, None)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def brute_model(texts, order):
    """Counts of all contexts, and the base counts."""
    trie = [defaultdict(Counter) for _ in range(order + 1)]
    words = Counter()
    for text in texts:
        found = ppm.words_of(text)
        words.update(found)
        words["end"] += 1
        symbols = [0] * order + [b + 1 for w in found for b in w + b" "] + [0]
        for i in range(order, len(symbols)):
            for j in range(order + 1):
                trie[j][tuple(symbols[i - j : i])][symbols[i]] += 1
    return trie, words


def brute_score(trie, order, text):
    symbols = [0] * order + [b + 1 for w in ppm.words_of(text) for b in w + b" "] + [0]
    total = 0.0
    for i in range(order, len(symbols)):
        excluded = set()
        for j in range(order, -1, -1):
            seen = {s: n for s, n in trie[j].get(tuple(symbols[i - j : i]), {}).items() if s not in excluded}
            room = sum(seen.values())
            if symbols[i] in seen:
                total += math.log10((seen[symbols[i]] - 0.5) / room)
                break
            if seen:
                total += math.log10(len(seen) / 2 / room)
                excluded |= set(seen)
        else:
            total -= math.log10(257 - len(excluded))
    return total


@pytest.mark.parametrize("order", [2, 4])
def test_ppm_equals_brute_force(given, order, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 60_000)  # several chunks
    docs = given.limit(70).withColumn("t", F.col("doc_id") % 3 != 1)
    rows = docs.collect()
    trie, words = brute_model([r["text"] for r in rows if r["t"]], order)
    n, v = sum(words.values()), len(words)
    texts = {r["doc_id"]: r["text"] for r in rows}
    found = ppm.score(docs, train="t", order=order).collect()
    assert len(found) == len(rows)
    for r in found:
        tokens = [*ppm.words_of(texts[r["doc_id"]]), "end"]
        base = sum(math.log10((words[w] + 1) / (n + 1 * (v + 1))) for w in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(words[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(base, abs=1e-8)
        assert r["score"] == pytest.approx(brute_score(trie, order, texts[r["doc_id"]]), abs=1e-8)


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    texts = [" ".join("".join(rng.choice(list("abc"), rng.integers(1, 4))) for _ in range(30)) for _ in range(5)]
    trie, _ = brute_model(texts, 3)
    codes, _ = ppm.grams_of([ppm._stream(ppm.words_of(t)) for t in texts], 3)
    grams, n = np.unique(codes, return_counts=True)
    low = {j: ppm._counts(grams, n, j) for j in (1, 0)}
    context = int(grams[len(grams) // 2]) >> 9 << 9
    tail = (context >> 9) & ((1 << 18) - 1)
    mates = grams[((grams >> 9) & ((1 << 18) - 1)) == tail]
    asked = np.unique(np.concatenate([mates, context + np.arange(257)]))
    counts = np.where(np.isin(asked, grams), n[np.minimum(np.searchsorted(grams, asked), len(grams) - 1)], 0)
    cost = ppm.code_lengths(asked, counts, 3, low)
    mine = (asked >> 9) == (context >> 9)
    assert (10.0 ** -cost[mine]).sum() == pytest.approx(1)


def test_ppm_odd_rows(odd_docs, no_docs):
    found = ppm.score(odd_docs).collect()
    assert len(found) == odd_docs.count()
    empty = [r for r in found if r["doc_id"] in (0, 1, 2)]
    assert {r["n_tokens"] for r in empty} == {1} and len({r["score"] for r in empty}) == 1
    assert ppm.score(no_docs).count() == 0
    untaught = ppm.score(odd_docs, train="false").collect()
    for r in untaught:
        assert r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == pytest.approx(0)
    assert [r["score"] for r in untaught if r["doc_id"] == 0] == [pytest.approx(-math.log10(257))]


def test_held_out_score_beats_bytes_alone(spark):
    """Held-out text costs far less than without contexts, and training text less than held-out text. The base is no
    bar here: it gives every unknown word, however long, the same share, which no spelling model can."""
    found = queries.op4_lm_scoring(spark, "/root/testdata/sf0.001").toPandas()
    sizes = {r["doc_id"]: len(ppm._stream(ppm.words_of(r["text"]))) + 1 for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found["per_byte"] = found.score / found.doc_id.map(sizes)
    held, taught = found[found.held_out], found[~found.held_out]
    share = lambda x: x.score.sum() / x.doc_id.map(sizes).sum()
    assert len(held) and share(held) > -0.8 and share(taught) > share(held)
    known = held[held.n_known == held.n_tokens]
    assert known.empty or known.score.sum() > 1.6 * known.base_score.sum()
