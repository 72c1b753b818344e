import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

import relgraph.llm.importance as importance
from relgraph.llm.importance import collapsed, feature_buckets, importance_resample, ngram_pattern
from relgraph.llm.queries import ORACLES, op11_resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def grams_of(text, shortest, longest):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]


def brute_force(docs, target, shortest=1, longest=1, buckets=10_000, min_words=20, percent=10):
    """{place in docs: (n_features, weight, score)}, and the drawn (score, doc_id) in order."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    own = [[bucket(g) for g in grams_of(t, shortest, longest)] for _, t in docs]
    s, t = Counter(b for row in own for b in row), Counter(bucket(g) for x in target for g in grams_of(x, shortest, longest))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for (i, _), found in zip(docs, own, strict=True):
        gains = [math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = [(-r[3], math.inf if r[0] is None else r[0]) for r, (_, x) in zip(rows, docs, strict=True) if len(words_of(x)) >= min_words]
    return rows, [(-a, b) for a, b in sorted(able)[: len(able) * percent // 100]]


def check(got, docs, target, **options):
    want, drawn = brute_force(docs, target, **options)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    ranked = sorted((r.rank, r.score, math.inf if r.doc_id is None else r.doc_id) for r in got if r.rank is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranked] == drawn


def test_query_against_brute_force_and_sql(spark, con):
    import oracle

    folder = "/root/testdata/sf0.01"
    df = op11_resample(spark, folder)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    check(df.collect(), docs, target)
    assert oracle.differences(df, oracle.connect(folder), ORACLES["op11_resample"]) == []


@pytest.mark.parametrize("n", [1, 2, 3])
def test_spans_are_the_ngrams(n):
    draw = random.Random(n)
    for _ in range(500):
        text = "".join(draw.choices(["a", "B", "é", "9", " ", "  ", ".", "\n", "_", "日本", "\x00"], k=draw.randint(0, 30)))
        data = collapsed(text.encode())
        spans = [m.span() for m in ngram_pattern(n).finditer(data, overlapped=True)]
        assert [data[a:b].decode() for a, b in spans] == grams_of(text, n, n)
        assert feature_buckets(data, [ngram_pattern(n)], 97).tolist() == [zlib.crc32(g.encode()) % 97 for g in grams_of(text, n, n)]


def test_longer_features_ties_and_odd_rows(rows, odd_docs):
    draw = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "Zeta"]
    docs = [(i % 90, " ".join(draw.choices(words, k=draw.randint(0, 30)))) for i in range(180)]  # every id twice
    docs += [(i, docs[i][1]) for i in range(20)] + [(7, docs[7][1])] * 50  # repeated rows, one very often
    target = ["alpha beta gamma", None, "", "alpha beta beta"]
    frames = rows("doc_id bigint, text string", docs), rows("text string", [(t,) for t in target])
    options = {"shortest": 1, "longest": 2, "buckets": 50, "min_words": 5, "percent": 60}
    check(importance_resample(*frames, **options).collect(), docs, target, **options)
    options["buckets"] = 70_000
    check(importance_resample(*frames, **options).collect(), docs, target, **options)
    got = importance_resample(odd_docs, frames[1], percent=100, min_words=0).collect()
    check(got, [(r.doc_id, r.text) for r in odd_docs.collect()], target, percent=100, min_words=0)
    assert {"KEPT", "n_words", "text"} <= set(got[0].asDict()) and list(got[0].asDict()).count("score") == 1


def test_empty_tables(rows):
    none, some = rows("doc_id bigint, text string", []), rows("doc_id bigint, text string", [(1, "one two"), (2, None)])
    assert importance_resample(none, some).collect() == []
    got = importance_resample(some, none, min_words=1, percent=100).collect()
    check(got, [(1, "one two"), (2, None)], [], min_words=1, percent=100)
    assert importance.bucket_gains(importance.np.zeros(3, "i8"), importance.np.zeros(3, "i8")).tolist() == [0, 0, 0]
