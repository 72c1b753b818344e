import hashlib
import random
import re

import pytest

from relgraph.llm.benchmark_search import build_tables, find_benchmark, words_hit
from relgraph.llm.queries import op10_benchmark


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(texts, items, window=10):
    patterns = {}
    for item, text in items:
        w = words_of(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            patterns.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(p) for p in patterns}
    out = []
    for text in texts:
        w, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = patterns.get(tuple(w[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = op10_benchmark(spark, folder).orderBy("doc_id").collect()
    assert len(got) == len(docs)
    for r, (n, hit, found) in zip(got, brute([d.text for d in docs], items), strict=True):
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert sum(r.contaminated for r in got) > 10


def test_random_words():
    draw = random.Random(1)
    for _ in range(300):
        items = [(str(i), " ".join(draw.choices("abc", k=draw.randint(0, 16)))) for i in range(4)]
        text = " ".join(draw.choices("abcd", k=draw.randint(0, 60)))
        tables = build_tables([(i, t.encode()) for i, t in items], 5, 3)
        own, hit = set(), set()
        for table in tables:
            for a, b in table.search([w.encode() for w in text.split()], own):
                hit.update(range(a, b))
        assert (len(hit), sorted(own)) == brute([text], items, 5)[0][1:]


@pytest.mark.parametrize("per_pass", [1_000_000, 12])
def test_passes_nulls_and_repeats(rows, odd_docs, per_pass):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (1, "word " * 12), (2, "two three"), (None, "smile"),
             (3, None), (4, ""), (5, "é"), (10, "a"), (2, "two three"), (6, "x null id null")]
    bench = rows("item_id int, text string, runs string", [(i, t, "x") for i, t in items])
    got = find_benchmark(odd_docs, bench, words_per_pass=per_pass).withColumn("hit", words_hit("runs")).collect()
    assert len(got) == odd_docs.count()
    want = brute([r.text for r in got], items)
    assert [(r.n_words, r.hit, r["items"]) for r in got] == want
    assert find_benchmark(odd_docs.where("doc_id < -1"), bench).collect() == []
    assert all(r["items"] == [] for r in find_benchmark(odd_docs, bench.where("item_id = 99")).collect())


def test_query_against_its_sql(spark):
    import oracle

    from relgraph.llm.queries import ORACLES

    folder = "/root/testdata/sf0.01"
    assert oracle.differences(op10_benchmark(spark, folder), oracle.connect(folder), ORACLES["op10_benchmark"]) == []
