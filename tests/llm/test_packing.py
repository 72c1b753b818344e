import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from relgraph.llm.packing import (
    best_pattern, column_generation, pack_documents, plan_sequences, sequences_of,
)
from relgraph.llm.queries import op8_packing
from relgraph.llm.tokens import byte_bpe, default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def fast():
    return byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_ids_equal_those_of_tokenizers(tokenizer, fast):
    draw = random.Random(2)
    pieces = ["'s", "'ll", " ", "  ", "\n", "\t", "é", "ß", "日本", "😀", "<|endoftext|>", "12", "1", "a", "The", "th", " ", "\r", "\x00", "é", " ", "!?", "_"]
    for _ in range(3000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 30)))
        assert fast(text).tolist() == tokenizer(text), repr(text)


def test_added_tokens_have_their_own_id(rows):
    own, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), default_tokenizer()()
    assert fast("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    draw = random.Random(5)
    pieces = ["<|endoftext|>", "<|endoftext", "|>", "<|", " ", "  ", "\n", "a", "The", "é", "12", "'s", "<|im_end|>", "<|endofprompt|>"]
    for _ in range(2000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 20)))
        assert fast(text).tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)
    (r,) = pack_documents(rows("doc_id bigint, text string", [(1, "a <|endoftext|> b")])).collect()
    assert r.doc_tokens == 5 and r.ids_crc32 == zlib.crc32(np.array([64, 220, 50256, 275, 1], "<u4").tobytes())


def test_query_is_an_exact_cut(spark, small_docs, tokenizer):
    got = op8_packing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in small_docs[1]}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, pieces in by_doc.items():
        ids, at = [*tokenizer(texts[doc] or ""), 1], 0
        total += len(ids)
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert sorted(by_seq) == list(range(len(by_seq)))
    assert 2048 * len(by_seq) <= total * 1.05 + 2048


def test_knapsack_and_bound():
    draw = random.Random(4)
    for _ in range(30):
        prices = np.array([draw.random() for _ in range(12)])
        worth, pattern = best_pattern(prices)
        best = [0.0] * 13
        for w in range(1, 13):
            best[w] = max([best[w - 1]] + [best[w - c - 1] + prices[c] for c in range(w)])
        assert worth == pytest.approx(best[12]) and pattern @ np.arange(1, 13) <= 12
        assert prices @ pattern == pytest.approx(worth)
    patterns, amount = column_generation(np.array([0, 0, 90.0, 0, 30, 0, 0, 0]))  # sizes 3 and 5, capacity 8
    assert amount.sum() == pytest.approx(60) and (patterns.T @ np.arange(1, 9) <= 8).all()
    patterns, amount = column_generation(np.array([0, 0, 0, 0, 0, 100.0, 0, 0]))  # size 6 alone: cut into 4 and 2
    assert amount[(patterns < 0).any(axis=0)].sum() >= 49.9 and amount[(patterns >= 0).all(axis=0)].sum() < 80


@pytest.mark.parametrize("histogram", [{}, {0: 1}, {15: 7}, {0: 1000, 9: 999, 15: 3}, {9: 5000, 12: 100}, {c: 37 * c % 101 for c in range(16)}])
def test_plan_places_every_part_once(histogram):
    plan = plan_sequences(histogram, 16)
    room, slots, parts = Counter(), set(), 0
    classes = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    ranks = np.concatenate([np.arange(n) for n in histogram.values()] or [np.zeros(0, int)]).astype(np.int64)
    row, part, c, r = plan.cut(classes, ranks)
    assert Counter(row[part == 1].tolist()) == Counter(row[part == 2].tolist())
    assert sorted(row[part != 2].tolist()) == list(range(len(classes)))
    size = Counter()
    for i, n in zip(row.tolist(), c.tolist(), strict=True):
        size[i] += n + 1
    assert all(size[i] == classes[i] + 1 for i in range(len(classes)))
    for s, k, n in zip(*plan.place(c, r), c, strict=True):
        room[int(s)] += int(n) + 1
        assert (s, k) not in slots
        slots.add((s, k))
        parts += 1
    assert len(room) == plan.sequences and max(room.values(), default=0) <= 16
    least = -(-sum((c + 1) * n for c, n in histogram.items()) // 16)
    assert plan.sequences <= 1.1 * least + 3


def test_odd_rows_and_sequences(spark, odd_docs, rows, tokenizer):
    pieces = pack_documents(odd_docs, keep_ids=True)
    got = pieces.collect()
    want = Counter()
    for r in odd_docs.collect():
        if r.text is None or len(r.text) < 50_000:
            want[r.doc_id, len(tokenizer(r.text or "")) + 1] += 1
    assert not want - Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    whole = sequences_of(pieces).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in got) and max(r.length for r in whole) <= 2048
    assert pack_documents(rows("doc_id bigint, text string", [])).collect() == []
