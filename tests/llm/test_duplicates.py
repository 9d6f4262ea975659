"""Line dedup, near-duplicates and benchmark passages."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_helpers import make

from llm import decontaminate, line_dedup, near_dedup, queries
from llm import words as words_module
from llm.words import word_hashes

SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows, min_chars=20, min_docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(SPACE).translate(lower)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc is not None:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lines_of(docs):
    found = line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_line_dedup_equals_brute_force(spark, given, odd_docs, no_docs):
    shared = ["A line that many documents share.", "  a LINE that many documents share.\t", "short", "Éine Zeile, die viele teilen wollen", "éine Zeile, die viele teilen wollen"]
    random.seed(4)
    made = make(spark, ["\n".join(random.choices(shared + [f"a line of its own, number {i}", ""], k=random.randint(0, 8))) for i in range(60)])
    for docs in (made, given, odd_docs, no_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert lines_of(docs) == sorted(brute_lines(rows), key=repr)


def test_line_dedup_keeps_other_columns(odd_docs):
    row = line_dedup.dedup_lines(odd_docs).select("row.*")
    assert row.columns == odd_docs.columns


def test_line_dedup_runs_no_python(spark):
    plan = queries.op8_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_line_dedup_query_sha(spark):
    rows = queries.op8_line_dedup(spark, "/root/testdata/sf0.001").collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {d: hashlib.sha256(k.encode()).hexdigest() for d, _, _, k in brute_lines(texts)}
    assert {r["doc_id"]: r["kept_sha256"] for r in rows} == want


def test_word_hashes():
    a, n = word_hashes(["The cat, sat!", "", "the CAT sat", "élan Élan", "x" * 70_000])
    assert n.tolist() == [3, 0, 3, 2, 1]
    assert (a[:3] == a[3:6]).all() and a[6] == a[7] and len(set(a.tolist())) == 5


def brute_groups(rows, least=0.8):
    """Least id with the same words, and least id of the component of all links, by comparing all pairs."""
    bags = [near_dedup.bag(word_hashes([t or ""])[0]) for _, t in rows]
    words = [word_hashes([t or ""])[0].tobytes() or (t or "") for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if words[i] == words[j] or (len(bags[i][0]) and near_dedup.similarity(bags[i], bags[j]) >= least):
                a, b = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                group[b] = a
    same = {}
    for (doc, _), w in zip(rows, words, strict=True):
        same[w] = min(same.get(w, doc), doc)
    least_id = defaultdict(lambda: 1 << 62)
    for i, (doc, _) in enumerate(rows):
        least_id[root(i)] = min(least_id[root(i)], doc)
    return sorted((doc, same[w], least_id[root(i)]) for i, ((doc, _), w) in enumerate(zip(rows, words, strict=True)))


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_near_duplicates_equal_all_pairs(spark, given, odd_docs):
    rng = random.Random(8)
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 9])):
            base = edited(base, max(1, len(base) // 150), rng)  # chains: each copy follows the one before
            texts.append(" ".join(base))
        texts += [texts[-1]] * (g % 3)
    for docs in (make(spark, texts), given, odd_docs.where("doc_id IS NOT NULL").drop("n_chars")):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        found = near_dedup.near_duplicates(docs).collect()
        assert sorted(tuple(r)[:3] for r in found) == brute_groups(rows)
        # Every link is one, and no class of a group of several is without.
        bags = {d: near_dedup.bag(word_hashes([t or ""])[0]) for d, t in rows}
        several = {g for g in {r["group_id"] for r in found} if len({r["class_id"] for r in found if r["group_id"] == g}) > 1}
        for r in found:
            assert (r["linked_to"] is not None) == (r["group_id"] in several)
            if r["linked_to"] is not None:
                assert near_dedup.similarity(bags[r["class_id"]], bags[r["linked_to"]]) >= 0.8


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["group_id"])
    assert by_id[None] == {None} and by_id[0] == by_id[1] == {0} and by_id[6] == by_id[5] == {5} and by_id[2] == {2}
    assert near_dedup.near_duplicates(no_docs).count() == 0
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "2", "3", "4", "5", "5", "7", "8", "None"]


def test_a_large_group_stays_linear(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(base, 1, rng)) for _ in range(400)]
    found = near_dedup.near_duplicates(make(spark, texts)).collect()
    assert {r["group_id"] for r in found} == {0}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    error = []
    for _ in range(80):
        keys = rng.integers(1, 1 << 62, 200).astype(np.uint64)
        keys.sort()
        a, b = rng.integers(0, 12, 200), rng.integers(0, 12, 200)
        bags = [(keys[x > 0], x[x > 0]) for x in (a, b)]
        one, two = near_dedup.signatures(bags)
        error.append((one == two).mean() - near_dedup.similarity(*bags))
    assert abs(np.mean(error)) < 0.012 and np.std(error) < 0.06


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1500), (5000, 5000)]
    found = {r["doc"]: r["root"] for r in near_dedup.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert set(found[i] for i in range(301)) == {0} and found[2000] == found[1500] == 1000 and 5000 not in found
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def levenshtein_substring(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_substring_edits():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 8))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 12))]
        got, end = decontaminate.substring_edits(np.array(item, np.uint64), np.array(text, np.uint64))
        assert got == levenshtein_substring(item, text) and 0 <= end <= len(text)


def test_passages_with_edits_are_found(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [[word() for _ in range(rng.randint(10, 60))] for _ in range(40)]
    texts, truth = [], set()
    for d in range(240):
        body = [word() for _ in range(rng.randint(20, 200))]
        if d % 2:
            k = rng.randrange(len(items))
            passage = list(items[k])
            for _ in range(int(rng.choice([0, 0.05, 0.1]) * len(passage))):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[], [word()], [passage[at], word()]])
            at = rng.randrange(len(body))
            body[at:at] = passage
            truth.add((d, k))
        texts.append(" ".join(body).capitalize())
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, ""), (92, "two words")], "item_id long, text string")
    found = decontaminate.find_passages(make(spark, texts), bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got <= truth and len(got & truth) >= 0.97 * len(truth)
    for r in found:
        assert r["edits"] == levenshtein_substring(items[r["item_id"]], texts[r["doc_id"]].lower().split())


def test_passages_equal_brute_force_on_given(spark, given):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r["item_id"], word_hashes([r["text"]])[0]) for r in bench.collect()]
    want = set()
    for r in given.collect():
        words = word_hashes([r["text"]])[0]
        for i, item in items:
            if np.isin(item, words).mean() >= 0.8 and decontaminate.substring_edits(item, words)[0] <= 0.2 * len(item):
                want.add((r["doc_id"], i))
    assert want and {(r["doc_id"], r["item_id"]) for r in decontaminate.find_passages(given, bench).collect()} == want


def test_passages_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    bench = spark.createDataFrame([(1, "the same text twice over here"), (1, "the same text twice over here"), (2, "word5 and5 word6 and6 word7 and7")], "item_id long, text string")
    pairs = [(5, 1), (6, 1), (4, 2)]
    for block in (decontaminate.BLOCK_BYTES, 20):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_passages(odd_docs, bench).collect()) == sorted(pairs)
    kept = decontaminate.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    # A leaked text goes under a null id too, and a clean row stays though it shares an id with a leaked one.
    leaked = odd_docs.where("doc_id = 5").limit(1)
    nameless = leaked.withColumn("doc_id", F.lit(None).cast("long"))
    shared = leaked.withColumn("text", F.lit("nothing of the kind"))
    assert [r["text"] for r in decontaminate.clean(leaked.union(nameless).union(shared), bench).collect()] == ["nothing of the kind"]
    assert decontaminate.find_passages(no_docs, bench).count() == 0
    assert decontaminate.find_passages(odd_docs, bench.where("false")).count() == 0


def test_repetitions_follow_the_recall():
    few, many = decontaminate.repetitions_for(5, 0.8, 0.9), decontaminate.repetitions_for(5, 0.97, 0.8)
    assert 1 <= few < many <= 64
    assert decontaminate.repetitions_for(1, 0.95, 0.8) == 0  # no edit is allowed


@pytest.mark.parametrize("length", [3, 4, 5, 6, 7, 8, 9])
def test_the_walk_alone_reaches_the_recall(length):
    """Without the segments, on other passages than those that the number of repetitions was measured on."""
    rng, found, trials = np.random.default_rng(77 + length), 0, 80
    repetitions = decontaminate.repetitions_for(length, 0.99, 0.8)
    assert repetitions > 0
    for _ in range(trials):
        n = int(rng.integers(1 << length, 2 << length))
        item = rng.integers(1, 1 << 62, n).astype(np.uint64)
        around = rng.integers(1, 1 << 62, 60).astype(np.uint64)
        text = np.concatenate([around[:30], decontaminate.edited(item, n // 5, rng), around[30:]])
        index = decontaminate.Index([0], [item], np.array([repetitions]), 0.8)
        assert not index.segments
        found += bool(decontaminate.search(index, text, np.array([len(text)]), 0.8))
    assert found >= 0.95 * trials


def test_tables_follow_the_walk():
    """Sampled words of an item, against the walk written out."""
    rng = np.random.default_rng(3)
    items = [rng.integers(1, 1 << 62, n).astype(np.uint64) for n in (5, 9, 30, 200)]
    index = decontaminate.Index(list(range(4)), items, np.full(4, 12), 0.8)
    for r, (back, bits, _, anchor, groups) in enumerate(index.tables):
        _, near, far, _ = decontaminate.draw(r)
        for b, keys, last, c, item in groups:
            for key, end, step, k in zip(keys, last, c, item):
                words = items[k][: anchor[k] + 1][::-1] if back else items[k][anchor[k] :]
                path = decontaminate.walk(words, bits)
                spelled = np.searchsorted(index.vocabulary, words)
                assert (key, end) == (spelled[0] * len(index.vocabulary) + spelled[path[b]], spelled[path[step]])
                assert (b, step) == (near, far) or path[step] == len(words) - 1


def test_short_items_match_exactly(spark):
    bench = spark.createDataFrame([(1, "rare four word item"), (2, "Single")], "item_id long, text string")
    texts = ["has a rare four word item.", "a rare four words item", "single", "no such thing"]
    found = decontaminate.find_passages(make(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 1), (2, 2)}


def test_words_of_long_texts_in_pieces(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choices("aé b.\n", k=rng.randrange(400))) for _ in range(50)] + ["x" * 900, ""]
    hashes, counts = word_hashes(texts)
    monkeypatch.setattr(words_module, "PIECE", 64)
    again, same = word_hashes(texts)
    assert (hashes == again).all() and (counts == same).all()


@pytest.mark.parametrize("name", ["op5_near_dedup", "op7_decontamination"])
def test_queries_give_integer_ids(spark, name):
    frame = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert dict(frame.dtypes)["doc_id"] == "bigint" and frame.count() > 0


def test_long_edited_passages_are_found(spark):
    rng = random.Random(11)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(rng.randint(300, 800))] for _ in range(40)]
    texts = [" ".join(edited(words, len(words) // 5, rng)) for words in items]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_passages(make(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k in range(len(items))}
    for r in found[:3]:
        assert r["edits"] == levenshtein_substring(items[r["item_id"]], texts[r["doc_id"]].split())


def test_passages_with_both_ends_changed_are_found(spark):
    rng = random.Random(12)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))] for _ in range(40)]
    texts = [" ".join(["before", *words[1:-1], "after"] if len(words) > 9 else ["before", *words[1:]]) for words in items]
    trimmed = [" ".join(words[1:-1]) for words in items if len(words) > 9]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_passages(make(spark, texts + trimmed), bench).collect()
    long = [k for k, w in enumerate(items) if len(w) > 9]
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k in range(len(items))} | {(len(items) + i, k) for i, k in enumerate(long)}
    assert {r["edits"] for r in found} == {1, 2}
