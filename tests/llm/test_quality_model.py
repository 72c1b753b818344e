import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from relgraph.llm.queries import op5_quality
from relgraph.llm.quality_model import QualityModel, classify_quality, copy_key, document_features, fit_curve, learn_quality, prior_weight
from relgraph.plans.staging import Staging


def test_query_separates_good_from_bad(spark):
    folder = "/root/testdata/sf0.1"
    got = op5_quality(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r.rejected for r in rows if r.quality == 1 and r.toxic == 0]
    toxic = [r.rejected for r in rows if r.toxic == 1]
    low = [r.rejected for r in rows if r.quality == 0]
    assert sum(good) <= 0.04 * len(good)
    assert sum(toxic) >= 0.95 * len(toxic) and sum(low) >= 0.9 * len(low)


def posteriors(got, threshold=0.5):
    """(host rate, path rate, probability) of each row, from the text evidence of all rows."""
    p = [1 / (1 + math.exp(-r.text_log_odds)) for r in got]
    host, path = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for r, x in zip(got, p, strict=True):
        for group, key in ((host, r.source), (path, (r.source, r.lang))):
            group[key][0] += 1
            group[key][1] += x
    mean = min(1 - 1e-4, max(1e-4, sum(p) / len(p)))

    def weight(groups, center):
        sizes = {k: n for k, (n, _) in groups.items()}
        total = sum(sizes.values())
        spread = sum(n * (bad / n - center(k)) ** 2 for k, (n, bad) in groups.items())
        v = sum(n * center(k) * (1 - center(k)) for k, n in sizes.items()) / total
        if len(groups) < 2 or not v:
            return 1e4
        between = (spread - (len(groups) - 1) * v) / max(1e-9, total - sum(n * n for n in sizes.values()) / total)
        return min(1e4, max(1.0, v / max(between, 1e-9) - 1))

    k_host = weight(host, lambda k: mean)
    k_path = weight(path, lambda k: (host[k[0]][1] + k_host * mean) / (host[k[0]][0] + k_host))
    out = []
    for r, x in zip(got, p, strict=True):
        (hn, hbad), (n, bad) = host[r.source], path[r.source, r.lang]
        h = (min(hn - 1, max(0.0, hbad - x)) + k_host * mean) / (hn - 1 + k_host)
        q = (min(n - 1, max(0.0, bad - x)) + k_path * h) / (n - 1 + k_path)
        odds = r.text_log_odds + math.log(max(1e-4, min(1 - 1e-4, q)) / (1 - max(1e-4, min(1 - 1e-4, q)))) - math.log(mean / (1 - mean))
        out.append((h, q, 1 / (1 + math.exp(-odds))))
    return out


def test_query_against_brute_force(spark):
    """Text evidence by the features of each text, posteriors by plain sums over all rows."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    places = {r.doc_id: r for r in docs.collect()}
    got = op5_quality(spark, folder).join(docs.select("doc_id", "source", "lang"), "doc_id").collect()
    assert len(got) == len(places)
    model = learn_quality(docs, labels, Staging(spark))
    for r, (h, q, p_bad) in zip(got, posteriors(got), strict=True):
        scores = []
        for kind in (0, 1):
            hits = sorted((model.evidence[f][kind] for f in document_features(places[r.doc_id].text.encode()) if f in model.evidence), reverse=True)
            scores.append(sum(x for x in hits[:4] if x > 0))
        a, b, c = model.curve
        assert r.text_log_odds == pytest.approx(max(-20, min(20, a * scores[0] + b * scores[1] + c)), abs=1e-6)
        assert (r.host_rate, r.path_rate, r.p_bad) == pytest.approx((h, q, p_bad), rel=1e-6)
        assert r.rejected == (r.p_bad > 0.5)


def sites(rows, sparse_text):
    """Host a is bad, host b is good, host c has one page; texts say nothing but for marked ones."""
    data, labels, i = [], [], 0
    for host, path, n, share in (("a", "x", 200, 0.9), ("a", "y", 200, 0.6), ("b", "x", 400, 0.05), ("c", "z", 1, None)):
        for k in range(n):
            bad = share is not None and k < share * n
            text = " ".join(f"p{i}{c}" for c in "abcdefghijklmnopqrstuvwxyz") + (" awful words here " if bad else " pleasant prose here ") + f"n{i}"
            data.append((i, sparse_text if host == "c" else text, host, path))
            if host != "c":
                labels.append((i, int(not bad), 0))
            i += 1
    return rows("doc_id bigint, text string, source string, lang string", data), rows("doc_id bigint, quality int, toxic int", labels)


def test_sites_shrink_toward_the_whole(rows):
    docs, labels = sites(rows, "alpha beta gamma")
    got = {(r.source, r.lang): r for r in classify_quality(docs, labels).collect()}
    a, b, c = got["a", "x"], got["b", "x"], got["c", "z"]
    assert a.host_rate > 0.6 > 0.2 > b.host_rate
    assert a.path_rate > got["a", "y"].path_rate
    # a site of one document says nothing about it: both rates are those of the whole
    assert b.host_rate < c.host_rate < a.host_rate and c.path_rate == pytest.approx(c.host_rate)
    for r in got.values():
        assert 0 < r.p_bad < 1 and r.rejected == (r.p_bad > 0.5)


def test_prior_weight_by_moments(rows):
    alike = rows("n double, bad double", [(100.0, 30.0 + k % 2) for k in range(40)])
    apart = rows("n double, bad double", [(100.0, 90.0 * (k % 2)) for k in range(40)])
    assert prior_weight(alike, "n", "bad", 0.305) > 500
    assert prior_weight(apart, "n", "bad", 0.45) < 2
    assert prior_weight(rows("n double, bad double", []), "n", "bad", 0.5) == 1e4


def test_curve_and_scores():
    points = [(4.0, 0.0, True, 1.0)] * 30 + [(0.5, 0.0, False, 1.0)] * 60 + [(0.0, 5.0, True, 1.0)] * 30 + [(0.0, 0.5, False, 1.0)] * 60
    a, b, c = fit_curve(points)
    assert a * 4 + c > 0 > a * 0.5 + c and b * 5 + c > 0 > b * 0.5 + c
    model = QualityModel(0.1, {b"bad": (0.0, 3.0), b"#upper 9": (2.0, 0.0)}, (1.0, 1.0, -2.0))
    assert model.scores({b"bad", b"other"}) == (0.0, 3.0) and model.log_odds(2.0, 3.0) == 3.0
    assert document_features(None) == {b"#empty"} and copy_key(b"a b c d") == copy_key(b"A b  c d!")


def test_odd_rows(rows, odd_docs):
    ids = [r.doc_id for r in odd_docs.select("doc_id").collect()]
    labels = rows("doc_id bigint, quality int, toxic int", [(i, k % 2, None if k % 3 else 1) for k, i in enumerate(ids)] + [(1, None, None)])
    for given in (labels, labels.where("false"), labels.where("quality = 1 and toxic is null")):
        got = classify_quality(odd_docs.withColumns({"P_BAD": F.lit("x"), "__host": F.lit("y"), "__n": F.lit(1)}), given).collect()
        assert {r["__host"] for r in got} == {"y"}
        assert len(got) == odd_docs.count()
        assert all(0 <= r.p_bad <= 1 and math.isfinite(r.text_log_odds) for r in got)
    assert not any(r.rejected for r in got)
    assert classify_quality(odd_docs.where("doc_id < 0"), labels).collect() == []
