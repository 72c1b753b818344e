import itertools
import zlib

import numpy as np
import pytest

from relgraph.llm.language_crf import Crf, features_of, has_letter, identify_languages, predict_helper, train, words_of
from relgraph.llm.queries import op4_language


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = op4_language(spark, folder).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id].lang]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_marginals_against_all_paths():
    draw = np.random.default_rng(1)
    model = Crf(["x", "y", "z"], np.zeros((4, 3), np.float32), draw.normal(size=(3, 3)).astype(np.float32))
    scores = draw.normal(size=(1, 5, 3))
    want, joint, total = np.zeros((5, 3)), np.zeros((3, 3)), 0.0
    for path in itertools.product(range(3), repeat=5):
        p = np.exp(sum(scores[0, t, k] for t, k in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += p
        for t, k in enumerate(path):
            want[t, k] += p
        for a, b in zip(path, path[1:], strict=False):
            joint[a, b] += p
    marginal, expected = model.marginals(scores.copy(), np.ones((1, 5), bool))
    assert np.allclose(marginal[0], want / total, atol=1e-5) and np.allclose(expected, joint / total, atol=1e-5)


def test_features_do_not_depend_on_neighbours():
    weights = np.random.default_rng(2).normal(size=(1 << 18, 2)).astype(np.float32)
    words = ["a", "é", "the", "straße", "x" * 100, "ab", "abc", "z"]
    words = [w.encode() for w in words]
    together = features_of(words).scores(weights)
    for w, row in zip(words, together, strict=True):
        assert np.allclose(features_of([w]).scores(weights)[0], row, atol=1e-4)


def test_code_switched_text_and_odd_rows(rows, odd_docs):
    en = "the quick brown fox jumps over the lazy dog and then runs with all of the others through the thick forest"
    es = "los niños jugaban en la plaza mientras las señoras hablaban del tiempo y de sus muchas preocupaciones"
    model = train([(en, "en")] * 3 + [(es, "es")] * 3, sequences=500)
    mixed = "the dog runs through the forest mientras las señoras hablaban del tiempo"
    pred, score, runs = predict_helper(model)([mixed.encode(), None, b"", b"12 !?", "é".encode(), "123 —".encode()])
    assert [(r["start"], r["end"], r["lang"]) for r in runs[0]] == [(0, 6, "en"), (6, 12, "es")]
    assert pred[1:4] == ["und"] * 3 and pred[4] in ("en", "es") and pred[5] == "und" and score[1] == 0
    got = identify_languages(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert (r.lang_pred == "und") == (not has_letter(r.text or ""))
        assert (r.runs[-1].end if r.runs else 0) == (len(words_of(r.text)) if r.lang_pred != "und" else 0)
    empty = train([])
    assert {r.lang_pred for r in identify_languages(odd_docs, empty).collect()} == {"und"}
    assert identify_languages(rows("doc_id bigint, text string", []), model).collect() == []


@pytest.mark.parametrize("words", [63, 64, 65, 130])
def test_long_texts_are_read_whole(words):
    model = train([("aa ab ac " * 20, "x"), ("ba bb bc " * 20, "y")], sequences=200)
    text = " ".join(["aa"] * words + ["bb"] * words)
    (pred,), _, (runs,) = predict_helper(model, chunk=50)([text.encode()])
    assert runs[0]["start"] == 0 and runs[-1]["end"] == 2 * words and runs[-1]["lang"] == "y" and pred in "xy"


def test_empty_table(spark, tmp_path, rows):
    rows("doc_id bigint, text string, lang string", []).write.parquet(str(tmp_path / "documents.parquet"))
    assert op4_language(spark, str(tmp_path)).collect() == []
