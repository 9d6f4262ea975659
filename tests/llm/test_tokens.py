"""Packing, token counts and token output."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm import packing, queries, token_counts, token_output
from llm.tokens import WordEncoder, default_tokenizer

ODD = [
    "a\x0bb\x0cc\rd\te\nf  g", "x <|endoftext|> y<|startoftext|>z", "Σας ΟΔΟΣ İstanbul", "á ́b é", "it's don't 123 4,5 \x1c a\x85b \xa0c",
    "", " ", "日本 語", "I'LL 'S ' s ª º µ ² ¼ × ÷ ß ẞ Ÿ ÿ", "Straße ÀÉÎ À naïve’s", "a\x00b \x7f \x80 I'VE'll", "x" * 5000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_give_the_ids_of_texts(tokenizer, given):
    enc = WordEncoder(default_tokenizer())
    assert enc.simple
    texts = ODD + [r["text"] for r in given.select("text").collect()]
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_memo_forgets_without_harm(tokenizer, given, monkeypatch):
    monkeypatch.setattr("llm.tokens.MEMO_WORDS", 40)
    enc = WordEncoder(default_tokenizer())
    texts = [r["text"] for r in given.select("text").limit(40).collect()]
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(enc.memo) <= 2000


def check_pieces(pieces, docs, tokenizer, window):
    want = {r["doc_id"]: expected(tokenizer, r["text"]) for r in docs.collect()}
    copies = Counter(r["doc_id"] for r in docs.collect())
    covered = Counter()
    for p in pieces:
        ids = want[p["doc_id"]]
        assert p["doc_tokens"] == len(ids)
        part = ids[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        covered[p["doc_id"]] += p["length"]
    assert covered == {d: n * len(want[d]) for d, n in copies.items()}
    rows = {}
    for p in pieces:
        rows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in rows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return rows


@pytest.mark.parametrize("window", [64, 2048])
def test_packing_covers_every_id_once(odd_docs, tokenizer, window):
    rows = check_pieces(packing.pack(odd_docs, window).collect(), odd_docs, tokenizer, window)
    assert sorted(rows) == list(range(len(rows)))
    full = [sum(n for _, n in spans) for _, spans in sorted(rows.items())]
    assert set(full[:-1]) <= {window}


def test_packing_boundaries_and_windows(given, tokenizer):
    pieces = packing.pack(given, 256, with_ids=True).cache()
    for p in pieces.collect():
        assert p["cut_before"] == (p["start"] > 0) and p["cut_after"] == (p["start"] + p["length"] < p["doc_tokens"])
    for r in packing.windows(pieces).collect():
        mine = sorted((p["offset"], p["ids"]) for p in pieces.where(f"sequence_id = {r['sequence_id']}").collect()) if r["sequence_id"] < 3 else None
        assert mine is None or (r["ids"] == b"".join(x for _, x in mine) and r["segment_starts"] == [o for o, _ in mine])


def test_empty_tables(no_docs):
    assert packing.pack(no_docs).count() == 0
    assert token_output.pack_best_fit(no_docs).count() == 0
    assert token_counts.count_tokens(no_docs).count() == 0


def greedy(pieces, text):
    n = at = 0
    longest = max(map(len, pieces))
    while at < len(text):
        size = next((k for k in range(min(longest, len(text) - at), 0, -1) if text[at : at + k] in pieces), 0)
        n += 1 if size else len(text[at].encode())
        at += size or 1
    return n


def test_automaton_is_greedy_longest_match():
    random.seed(3)
    for _ in range(60):
        pieces = {"".join(random.choices("abcé", k=random.randint(1, 5))) for _ in range(random.randint(1, 12))}
        automaton = token_counts.Automaton(sorted(pieces))
        for _ in range(100):
            text = "".join(random.choices("abcéx", k=random.randint(0, 15)))
            assert automaton.count(text) == greedy(pieces, text)


def test_token_counts(odd_docs, given):
    pieces = set(token_counts.vocabulary(token_counts.default_vocabulary()))
    for docs in (odd_docs, given.limit(15)):
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        found = token_counts.count_tokens(docs).collect()
        assert len(found) == docs.count()
        for r in found:
            if len(texts[r["doc_id"]]) > 100_000:
                continue
            words = [w for w in texts[r["doc_id"]].replace("\n", " ").replace("\t", " ").split(" ") if w]
            assert (r["n_words"], r["n_tokens"]) == (len(words), sum(greedy(pieces, "▁" + w) for w in words))


def item_by_item(lengths, window):
    rows = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rows if r >= n]
        if fits:
            rows.remove(min(fits))
        rows.append((min(fits) if fits else window) - n)
    return sorted(rows)


def test_best_fit_decreasing_plan_equals_item_by_item():
    for seed in range(80):
        random.seed(seed)
        window = random.choice([8, 16, 64, 100])
        lengths = [random.randint(1, window) for _ in range(random.randint(0, 250))]
        plan, n = token_output.best_fit_decreasing(dict(Counter(lengths)), window)
        used = [0] * n
        for length, _, count, first, offset in sorted(plan.tolist(), key=lambda r: r[4]):
            for row in range(first, first + count):
                assert used[row] == offset
                used[row] += length
        assert sorted(window - u for u in used) == item_by_item(lengths, window)
        for length, times in Counter(lengths).items():
            ranks = sorted(r for x in plan.tolist() if x[0] == length for r in range(x[1], x[1] + x[2]))
            assert ranks == list(range(times))


@pytest.mark.parametrize("window", [64, 2048])
def test_token_output_covers_every_id_once(odd_docs, tokenizer, window):
    check_pieces(token_output.pack_best_fit(odd_docs, window).collect(), odd_docs, tokenizer, window)


def test_matrices_round_trip(spark, given, tokenizer, tmp_path):
    docs = given.limit(80)
    pieces = token_output.pack_best_fit(docs, 256, with_ids=True).cache()
    check_pieces(pieces.collect(), docs, tokenizer, 256)
    token_output.write_matrices(pieces, str(tmp_path / "out"), rows_per_file=20, window=256)
    stored = {r["sequence_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rebuilt = {}
    for p in pieces.collect():
        row = stored[p["sequence_id"]]
        ids = np.frombuffer(row["ids"], "<u4")
        assert len(ids) == 256 and p["offset"] + p["length"] in row["segment_ends"]
        assert row["positions"][p["offset"] : p["offset"] + p["length"]] == list(range(p["length"]))
        rebuilt.setdefault(p["doc_id"], {})[p["start"]] = ids[p["offset"] : p["offset"] + p["length"]].tolist()
    for doc, parts in rebuilt.items():
        assert [i for _, part in sorted(parts.items()) for i in part] == expected(tokenizer, texts[doc])


def check_matrices(rows, want, copies, window):
    """Every id of every document stands once in the rows, with its segment ends and positions."""
    covered = Counter()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    for r in rows:
        ids, starts = np.frombuffer(r["ids"], "<u4"), [0, *r["segment_ends"][:-1]]
        assert len(ids) == window and len(r["positions"]) == r["segment_ends"][-1] and not ids[r["segment_ends"][-1] :].any()
        assert r["positions"] == [k for a, b in zip(starts, r["segment_ends"], strict=True) for k in range(b - a)]
        for k, (a, b) in enumerate(zip(starts, r["segment_ends"], strict=True)):
            doc, start = r["doc_ids"][k], r["starts"][k]
            assert ids[a:b].tolist() == want[doc][start : start + b - a]
            assert r["ids_crc32"][k] == zlib.crc32(ids[a:b].tobytes()) and r["doc_tokens"][k] == len(want[doc])
            covered[doc] += b - a
    assert covered == {d: n * len(want[d]) for d, n in copies.items()}


def test_token_output_query_gives_the_matrices_of_all_documents(spark, given, tokenizer):
    rows = queries.op10_token_output(spark, "/root/testdata/sf0.001").collect()
    check_matrices(rows, {r["doc_id"]: expected(tokenizer, r["text"]) for r in given.collect()}, Counter(r["doc_id"] for r in given.collect()), 2048)


def test_token_output_odd_rows(odd_docs, no_docs, tokenizer):
    want = {r["doc_id"]: expected(tokenizer, r["text"]) for r in odd_docs.collect()}
    copies = Counter(r["doc_id"] for r in odd_docs.collect())
    for stored in (token_output.token_output(odd_docs, 64, group_tokens=5_000), token_output.matrices(token_output.pack_best_fit(odd_docs, 64, with_ids=True), 64)):
        check_matrices(stored.collect(), want, copies, 64)
    assert token_output.token_output(no_docs).count() == 0


def test_groups_waste_little(spark, given, tokenizer):
    sizes = {r["doc_id"]: len(expected(tokenizer, r["text"])) for r in given.collect()}
    rows = token_output.token_output(given.coalesce(1), 512, group_tokens=20_000).count()
    groups = sum(sizes.values()) // 20_000 + 1
    assert rows <= sum(sizes.values()) / 512 * 1.02 + 2 * groups
