import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from relgraph.llm.components import connected_components
from relgraph.llm.near_dups import (
    bucket_links, bucket_members, budgets, chain_masks, equal_segments, link_fingerprints, mark_representatives, near_duplicate_groups,
)
from relgraph.llm.queries import op1_near_dups
from relgraph.plans.staging import Staging


def simhash(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, limit=4):
    """Root (smallest index) per entry, by comparing all pairs of values."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= limit) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op1_near_dups(spark, folder).collect()}
    ids = sorted(texts)
    fps = [simhash(texts[i]) for i in ids]
    roots = components(fps)
    assert sorted(got) == ids
    for i, fp, root in zip(ids, fps, roots, strict=True):
        assert got[i].fingerprint == f"{fp:016x}"
        assert got[i].component_id == ids[root]
    assert len(set(roots)) < len(ids)


def test_the_spark_hash_is_the_same(spark):
    text = "the quick brown fox"
    assert spark.sql(f"select xxhash64('{text}') h").first().h % 2**64 == xxhash.xxh64_intdigest(text, 42)


def test_every_near_pair_shares_a_key_and_a_viable_chain():
    draw = random.Random(7)
    limit, sets = budgets(4, 8), equal_segments(4, 8, 5)
    assert limit == [0, 1, 1, 2, 2, 3, 3, 4] and len(sets) == 5
    for _ in range(5000):
        per = [0] * 8
        for _ in range(draw.randint(0, 4)):
            per[draw.randrange(8)] += 1
        starts = [s for s in range(8) if all(sum(per[(s + i) % 8] for i in range(n)) <= limit[n - 1] for n in range(1, 9))]
        assert starts
        for s in starts:
            assert any(all(per[(s + p) % 8] == 0 for p in places) for places in sets)


def cloud(draw, count, center=None, spread=9):
    center = draw.getrandbits(64) if center is None else center
    out = set()
    while len(out) < count:
        fp = center
        for b in draw.sample(range(spread), draw.randint(0, spread)):
            fp ^= 1 << (7 * b % 64)
        out.add(fp)
    return out


@pytest.mark.parametrize("block", [20_000, 40])
def test_links_connect_what_brute_force_connects(spark, rows, block):
    draw = random.Random(9)
    fps = {draw.getrandbits(64) for _ in range(1500)} | {0, 2**64 - 1, 1, 3, 7, 15, 31, 63}
    for _ in range(20):
        fps |= cloud(draw, 40)
    fps |= cloud(draw, 3000, spread=16)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = rows("fingerprint bigint, salt int", [(f, k) for f in signed for k in (0, 3)])
    staging = Staging(spark)
    links, _ = staging.keep(link_fingerprints(df, staging, block=block))
    assert {r.salt for r in links.select("salt").distinct().collect()} == {0, 3}
    got = {r.node: r.root for r in connected_components(links.where("salt = 3"), staging).collect()}
    want = components(fps)
    group = {}
    for f, root in zip(signed, want, strict=True):
        assert group.setdefault(root, got.get(f, f)) == got.get(f, f)
    assert len(set(group.values())) == len(group)


def test_bucket_links_are_a_tree():
    draw = random.Random(2)
    members = np.array(sorted(cloud(draw, 400, spread=12)), np.uint64)
    links = bucket_links(members, chain_masks(4, 8, 0), slab=500)
    assert len(links) < len(members) and len({b for _, b in links}) == len(links)


def test_components_of_paths_and_stars(spark, rows):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 4000), (5, 5), (4000, 5000)]
    staging = Staging(spark)
    got = {r.node: r.root for r in connected_components(rows("a bigint, b bigint", links), staging).collect()}
    want = dict.fromkeys(range(201), 0) | dict.fromkeys(range(1000, 1100), 1000) | {4000: 4000, 5000: 4000}
    assert got == want
    assert connected_components(rows("a bigint, b bigint", []), staging).collect() == []


def test_odd_rows(odd_docs, rows):
    got = near_duplicate_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    fps = [simhash(r.text) if len(r.text or "") < 10_000 else r.fingerprint % 2**64 for r in got]
    roots = components(fps)
    for r, fp in zip(got, fps, strict=True):
        assert r.fingerprint % 2**64 == fp
    for root in set(roots):
        own = [r for r, x in zip(got, roots, strict=True) if x == root]
        least = min((r.doc_id for r in own if r.doc_id is not None), default=None)
        assert {r.component_id for r in own} == {least}
    assert near_duplicate_groups(rows("doc_id bigint, text string", [])).collect() == []


def test_representatives(rows):
    draw = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    data, groups = [], {}
    for g in range(60):
        words = draw.choices(vocabulary, k=draw.choice([8, 60, 300, 900]))
        for copy in range(g % 4 + 1):
            own = list(words)
            if len(own) > 50:
                for at in draw.sample(range(len(own)), len(own) // 200 + (copy > 0)):
                    own[at] = draw.choice(vocabulary)
            i = len(data)
            data.append((i, " ".join(own), "x"))
            groups[i] = g
    data += [(None, data[0][1], None), (data[1][0], data[1][1], None), (900, None, None), (901, "", None), (902, " ", None)]
    got = mark_representatives(rows("doc_id bigint, text string, REPRESENTATIVE string", data)).collect()
    assert len(got) == len(data)
    kept = [r.doc_id for r in got if r.representative]
    assert sorted(kept) == sorted({min(i for i, x in groups.items() if x == g) for g in groups.values()} | {900})


def test_unlike_documents_stay(rows, odd_docs):
    draw = random.Random(8)
    shared = " ".join(f"p{i}" for i in range(60))
    data = [(i, shared + " " + " ".join(draw.choices([f"v{k}" for k in range(500)], k=40))) for i in range(30)]
    got = mark_representatives(rows("doc_id bigint, text string", data)).collect()
    assert all(r.representative for r in got)
    odd = mark_representatives(odd_docs).collect()
    assert len(odd) == odd_docs.count() and sum(r.representative for r in odd) == len({tuple((r.text or "").lower().split()) if (r.text or "").isascii() else r.text for r in odd})
    assert mark_representatives(rows("doc_id bigint, text string", [])).collect() == []


def jaccard(one, other):
    a, b = ({tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (one, other))
    return len(a & b) / len(a | b)


def kept_by_brute_force(texts, limit=0.8):
    group = list(range(len(texts)))
    for i, one in enumerate(texts):
        for j in range(i):
            if group[i] != group[j] and jaccard(one, texts[j]) >= limit:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return sorted(set(group))


def test_members_of_buckets():
    draw = random.Random(14)
    for _ in range(300):
        rows = sorted((draw.randint(0, 6), draw.randint(0, 99), 5, 1) for _ in range(draw.randint(0, 25)))
        cuts = sorted(draw.sample(range(len(rows) + 1), min(len(rows), draw.randint(0, 8))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], pa.int64()) for i in range(4)], names=list("hksp")) for p in parts]
        got = [tuple(r.values()) for b in bucket_members(iter(batches)) for r in b.to_pylist()]
        want = []
        for h in range(7):
            own = [r for r in rows if r[0] == h]
            want += [(*r, *own[0][1:]) for r in own if len(own) > 1]
        assert got == want


def test_many_copies_cost_few_pairs(rows, monkeypatch):
    """A group of near copies is linked by about as many pairs as it has members, not by all."""
    draw = random.Random(15)
    words, texts = [f"w{i}" for i in range(400)], []
    for i in range(300):
        own = list(words)
        own[draw.randrange(400)] = f"x{i}"
        texts.append(" ".join(own))
    made = []
    keep = Staging.keep

    def counting(self, df, label="step"):
        out, n = keep(self, df, label)
        if label.endswith("-pairs"):
            made.append(n)
        return out, n

    monkeypatch.setattr(Staging, "keep", counting)
    got = mark_representatives(rows("doc_id bigint, text string", list(enumerate(texts)))).collect()
    assert [r.doc_id for r in got if r.representative] == [0]
    assert sum(made) < 12 * len(texts)


def test_equal_rows_and_clashing_names(rows):
    data = [(5, "some text of a few words", "a")] * 40 + [(5, "another text of five words", "b"), (5, "some text of a few words", "c"), (4, "another text of five words", "d")]
    df = rows("doc_id bigint, text string, __row string", data).selectExpr("*", "1 as __other", "2 as `key`", "3 as number", "4 as __place", "5 as __scan_text")
    got = mark_representatives(df).collect()
    assert len(got) == len(data)
    kept = [(r.doc_id, r.text) for r in got if r.representative]
    assert sorted(kept) == [(4, "another text of five words"), (5, "some text of a few words")]


@pytest.mark.parametrize("stars", [0, 2])
def test_representatives_equal_brute_force_where_word_sets_agree(rows, stars):
    draw, texts = random.Random(12), []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(60)]
        for _ in range(3):  # the same words in another order: one word set, nothing in common
            texts.append(" ".join(draw.sample(words, 60)))
        texts.append(" ".join(words))
        texts.append(" ".join([*words[5:], *words[:5]]))
    common = [f"c{i}" for i in range(70)]
    texts += [" ".join([*common, *[f"x{i}y{k}" for k in range(draw.choice([4, 12, 30]))]]) for i in range(40)]
    draw.shuffle(texts)
    got = mark_representatives(rows("doc_id bigint, text string", list(enumerate(texts))), stars=stars).collect()
    assert sorted(r.doc_id for r in got if r.representative) == kept_by_brute_force(texts)


def test_no_pair_near_the_limit_is_missed(rows):
    draw, texts = random.Random(13), []
    vocabulary = [f"w{i}" for i in range(5000)]
    for _ in range(120):
        words = draw.choices(vocabulary, k=draw.randint(100, 1000))
        n = len(words)
        at, k = draw.randrange(n // 2), round(n * draw.choice([0.05, 0.08, 0.09, 0.16, 0.18, 0.2]))
        other = draw.choice([
            [*words[:at], *draw.choices(vocabulary, k=k), *words[at + k :]],
            [*words[:at], *draw.choices(vocabulary, k=k), *words[at:]],
            words[:-k],
        ])
        texts += [" ".join(words), " ".join(other)]
    near = [jaccard(*texts[i : i + 2]) for i in range(0, len(texts), 2)]
    assert sum(0.8 <= x < 0.86 for x in near) > 20 and sum(x < 0.8 for x in near) > 10
    got = mark_representatives(rows("doc_id bigint, text string", list(enumerate(texts)))).collect()
    want = sorted([*range(0, len(texts), 2), *[2 * i + 1 for i, x in enumerate(near) if x < 0.8]])
    assert sorted(r.doc_id for r in got if r.representative) == want


def test_long_texts_are_decided_exactly(rows):
    words, texts = [f"w{i}" for i in range(2004)], []
    for g in range(40):  # 2000 shingles, of which one side lacks 399 to 401 at the end
        own = [f"{g}{w}" for w in words]
        texts += [" ".join(own), " ".join(own[: -(399 + g % 3)])]
    got = mark_representatives(rows("doc_id bigint, text string", list(enumerate(texts)))).collect()
    want = [i for i in range(80) if i % 2 == 0 or i // 2 % 3 == 2]
    assert sorted(r.doc_id for r in got if r.representative) == want


def test_members_of_buckets_that_go_over_the_edge_of_a_task():
    draw = random.Random(16)
    for _ in range(200):
        rows = sorted((draw.randint(0, 6), draw.randint(0, 99), 5, 1) for _ in range(draw.randint(1, 25)))
        got, at = [], sorted(draw.sample(range(len(rows) + 1), min(len(rows), draw.randint(0, 4))))
        edges = [0, *at, len(rows)]
        for task in [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)]:
            cuts = [0, *sorted(draw.sample(range(len(task) + 1), min(len(task), draw.randint(0, 3)))), len(task)]
            parts = [task[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], pa.int64()) for i in range(4)], names=list("hksp")) for p in parts]
            found = [tuple(r.values())[:4] for b in bucket_members(iter(batches), edges=True) for r in b.to_pylist()]
            inner = [r for r in found if task[0][0] != r[0] != task[-1][0]]
            assert all(sum(x[0] == r[0] for x in task) > 1 for r in inner)
            got += found
        assert len(got) == len(set(got)) or len(rows) > len(set(rows))
        many = [r for r in rows if sum(x[0] == r[0] for x in rows) > 1]
        assert all(got.count(r) == rows.count(r) for r in many)


def test_fingerprints_link_first_and_a_hub_costs_few_pairs(rows, monkeypatch):
    """Copies of one text that are alike it, but often not each other, are not all tried with each other."""
    draw = random.Random(17)
    base, n = [f"w{i}" for i in range(146)], 240
    texts = [" ".join(base)]
    for i in range(1, n):
        own = list(base)
        for at in draw.sample(range(4, 142), 3 if i % 3 else 1):
            own[at] = f"x{i}y{at}"
        texts.append(" ".join(own))
    draw.shuffle(texts)
    made, keep = {}, Staging.keep

    def counting(self, df, label="step"):
        out, rows = keep(self, df, label)
        made[label] = made.get(label, 0) + rows
        return out, rows

    monkeypatch.setattr(Staging, "keep", counting)
    monkeypatch.setattr("relgraph.llm.near_dups.SAMPLE", 1)  # for so few texts
    got = mark_representatives(rows("doc_id bigint, text string", list(enumerate(texts)))).collect()
    assert sorted(r.doc_id for r in got if r.representative) == kept_by_brute_force(texts)
    assert sum(m for label, m in made.items() if label.endswith("-pairs")) < 12 * n
    assert made["alike"] > 0  # links of SimHash and pigeonring chains
    assert sum(jaccard(texts[i], texts[j]) < 0.8 for i in range(n) for j in range(i)) > n * n / 8
