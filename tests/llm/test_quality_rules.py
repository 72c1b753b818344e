import re
from collections import Counter

import pytest
import zstandard

from relgraph.llm.quality_rules import Band, apply_quality_rules
from relgraph.llm.queries import op9_quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines)) if len(lines) < 3000 else None
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def test_counts_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op9_quality_rules(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)
        if texts[r.doc_id]:
            data = texts[r.doc_id].encode()
            press = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
            assert r.ratio == pytest.approx(len(press.compress(data)) / len(data))


def test_odd_rows(odd_docs):
    got = apply_quality_rules(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert "KEPT" not in got[0].asDict() and "fp" in got[0].asDict()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
        assert (r.ratio is None) == (not r.text)


def test_bands(rows):
    import random

    noise = " ".join("".join(random.Random(i).choices("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_", k=60)) for i in range(80))
    prose = " ".join("".join(random.Random(i).choices(["th", "on", "er", "ing", "es", "an", "re"], k=3)) for i in range(900))
    half = prose[:3000] + "lorem ipsum " * 2000
    df = rows("doc_id bigint, text string", [(1, noise), (2, prose), (3, "same words again and again. " * 100), (4, half)])
    loose = (Band(0, 0.0, 9.0),)
    got = {r.doc_id: r.band_verdict for r in apply_quality_rules(df).collect()}
    assert got == {1: "incompressible", 2: "inside", 3: "repetitive", 4: "repetitive"}
    got = {r.doc_id: r.band_verdict for r in apply_quality_rules(df, text_bands=loose).collect()}
    assert got[4] == "chunks" and got[2] == "inside"
    with pytest.raises(ValueError):
        apply_quality_rules(df, text_bands=(Band(5, 0.0, 1.0),))


def test_empty_table(rows):
    assert apply_quality_rules(rows("doc_id bigint, text string", [])).collect() == []
