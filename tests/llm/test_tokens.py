import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from relgraph.llm.packing import pack_documents
from relgraph.llm.queries import op12_token_counts
from relgraph.llm.tokens import (
    BOUNDARY, balanced_calls, count_tokens, default_tokenizer, json_lengths, model_lengths, pieces_of, ranked_lengths,
)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(t.encode(text, add_special_tokens=False))


def test_query_against_the_library(spark, small_docs, library):
    got = {r.doc_id: r for r in op12_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(small_docs[1])
    for r in small_docs[1]:
        n = library(r.text or "")
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len((r.text or "").encode()), n, n > 512)


PARTS = ["'s", "'ll", "don't", " ", "  ", "\n", "\t", " \n ", "é", "ß", "日本", "。", "😀", "<|endoftext|>", "12", "a", "The", "th", "\xa0", "　", "\x85", "\r", "\x00", "!?", "_", ".", ",", ", ", "x.y"]


@pytest.mark.parametrize("make", [ranked_lengths(default_tokenizer()), json_lengths(public_tokenizers.path("byte_bpe_50k.json"))])
def test_pieces_add_up(library, make):
    count, boundary = make()
    assert boundary is BOUNDARY
    draw = random.Random(4)
    cut = 0
    for _ in range(1500):
        text = "".join(draw.choices(PARTS, k=draw.randint(0, 40)))
        pieces = list(pieces_of(text, boundary, draw.randint(1, 8)))
        cut += len(pieces) > 1
        assert "".join(pieces) == text and sum(count(pieces)) == library(text), text
    assert cut > 500


def test_calls_are_balanced():
    draw = random.Random(5)
    for _ in range(300):
        sizes = np.array([draw.choice([0, 1, 5, 50]) for _ in range(draw.randint(0, 60))])
        cuts = balanced_calls(sizes, 40)
        parts = np.split(sizes, cuts)
        assert sum(map(len, parts)) == len(sizes) and max((p.sum() for p in parts), default=0) < 40 + 50
        assert len(parts) <= max(1, -(-sizes.sum() // 40))


def test_odd_rows_and_long_texts(odd_docs, rows, library):
    docs = odd_docs.unionByName(
        rows("doc_id bigint, text string", [(90, "no_blank_at_all" * 20_000), (91, "日本語の文。" * 50_000), (92, "x" + "\t" * 300_000 + "y")]), allowMissingColumns=True
    ).withColumn("N_TOKENS", odd_docs["lang"]).withColumn("over_LIMIT", odd_docs["lang"])
    got = count_tokens(docs, piece_chars=1000, call_bytes=5000).collect()
    texts = docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted((str(r.doc_id), len((r.text or "").encode()), library(r.text or "")) for r in texts)
    assert sum(c.lower() == "over_limit" for c in got[0].asDict()) == 1
    assert count_tokens(rows("doc_id bigint, text string", [])).collect() == []


def test_other_vocabularies(small_docs, rows):
    import sentencepiece

    df, texts = small_docs
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, keep=["doc_id"], lengths=model_lengths(public_tokenizers.path("piece_bpe_32k.model"))).collect()}
    assert got == {r.doc_id: len(model.encode(r.text or "")) for r in texts}
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, keep=["doc_id"], lengths=json_lengths(public_tokenizers.path("word_bpe_49k.json")), piece_chars=100).collect()}
    assert got == {r.doc_id: len(other.encode(r.text or "", add_special_tokens=False)) for r in texts}


@pytest.mark.parametrize("blank", [" ", "\n", "\t"])
def test_millions_of_blanks(rows, blank):
    text = "a" + blank * 2_000_000 + "b"
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert default_tokenizer()()(text).tolist() == want
    df = rows("doc_id bigint, text string", [(1, text), (2, "short")])
    assert {r.doc_id: r.doc_tokens for r in pack_documents(df).collect()} == {1: len(want) + 1, 2: 2}
    assert {r.doc_id: r.n_tokens for r in count_tokens(df).collect()} == {1: len(want), 2: 1}
