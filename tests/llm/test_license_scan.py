import math
import random
import re

from relgraph.llm.license_scan import PHRASES, TEMPLATES, TemplateIndex, scan_licenses
from relgraph.llm.queries import op3_license_scan
from relgraph.llm.scan import plain_words


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text):
    words = words_of(text)
    places = sorted(
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    return len(words), places


def blocks_by_brute_force(words, templates, threshold=0.8, spread=2):
    """(label, first, last, containment): in order of place, the fullest and then shortest block that begins in the first that matches."""
    out = []
    for label, text in templates:
        t = set(words_of(text))
        needed = math.ceil(threshold * len(t) - 1e-9)

        def block(s, t=t):
            inside = words[s : s + spread * len(t)]
            n = len(t & set(inside))
            return n, s + next(k for k in range(len(inside)) if len(t & set(inside[: k + 1])) == n)

        starts, done = [s for s in range(len(words)) if words[s] in t], -1
        for s in starts:
            if s <= done or block(s)[0] < needed:
                continue
            n, last, s = max(((block(x)[0], -(block(x)[1] - x), -x) for x in starts if s <= x <= block(s)[1]), default=None)
            out.append((label, -s, block(-s)[1], n / len(t)))
            done = block(-s)[1]
    return out


def test_words():
    for text in ("MIT License\x00x", "Émile-É 1_2", "a b", "ÀA"):
        assert [w.decode() for w in plain_words(text.encode())] == words_of(text)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op3_license_scan(spark, folder).collect()
    assert len(got) == len(texts)
    hits = 0
    for r in got:
        n, places = brute(texts[r.doc_id])
        labels = sorted({label for _, label in places})
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(labels))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        best = {}
        for label, _, _, share in blocks_by_brute_force(words_of(texts[r.doc_id]), TEMPLATES):
            best[label] = max(best.get(label, 0), share)
        assert set(best) | set(labels) == set(filter(None, r.labels.split(",")))
        assert r.score == (1.0 if labels else max(best.values(), default=0.0))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        hits += bool(r.labels)
    assert hits > 10


def test_filters_lose_nothing():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"t{i}", " ".join(draw.sample(vocabulary, draw.randint(1, 12)))) for i in range(40)]
    counts = {w.encode(): draw.randint(0, 1000) for w in vocabulary}
    index = TemplateIndex(templates, counts, 0.7)
    found = 0
    for _ in range(400):
        words = draw.choices([*vocabulary, *["other"] * draw.randint(1, 60)], k=draw.randint(0, 60))
        got = sorted((index.templates[t].label, a, b, share) for t, a, b, share in index.blocks([w.encode() for w in words]))
        assert got == sorted(blocks_by_brute_force(words, templates, 0.7))
        found += len(got)
    assert found > 200


def test_wrapped_notice_and_odd_rows(rows, odd_docs):
    text = "first line\nLicensed under\nthe Apache License,\nVersion 2.0\nlast"
    (r,) = scan_licenses(rows("doc_id bigint, text string", [(1, text)])).collect()
    assert [(b.label, b.line, b.lines, b.word, b.words) for b in r.blocks] == [("apache", 1, 3, 2, 8)]
    apart = "Redistribution and use in source and\n\nbinary forms, with or without\n\n # modification,\n are permitted"
    scattered = "released " + "x " * 1000 + "under " + "y " * 1000 + "the " + "z " * 1000 + "license"
    got = scan_licenses(rows("doc_id bigint, text string", [(1, apart), (2, scattered)])).collect()
    assert [[(b.label, b.line, b.lines, b.containment) for b in r.blocks] for r in got] == [[("bsd", 0, 6, 1.0)], []]
    assert [(p.word, p.label) for p in r.places] == [(5, "apache")]
    got = scan_licenses(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert (r.n_words, [tuple(p) for p in r.places]) == brute(r.text)
    assert scan_licenses(rows("doc_id bigint, text string", [])).collect() == []
