import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from relgraph.llm.prefix_trie import KEY, digested_lists, prefix_trie
from relgraph.llm.queries import ORACLES, op13_prefix_trie
from relgraph.plans.staging import Staging

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(turns, shared=20, heads=4):
    by_conv = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            by_conv[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(rows, key=lambda t: t[0])] for c, rows in by_conv.items()}
    full = {}
    for c in own:
        h, giver = zlib.crc32(str(c).encode()) % heads, c - (abs(c) % shared) * (1 if c >= 0 else -1)
        full[c] = tuple([*own.get(giver, [])[:h], *own[c][h:]])
    members = defaultdict(list)
    for c, turns_ in full.items():
        for d in range(len(turns_) + 1):
            members[turns_[:d]].append(c)
    children, saved, leaves = Counter(n[:-1] for n in members if n), Counter(), Counter()
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * words
            leaves[node[:d]] += children[node] == 0
    return sorted(
        (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if full[c] == node).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda t: (t[0], t[1]))


def test_query_against_its_sql(spark):
    import oracle

    folder = "/root/testdata/sf0.01"
    assert oracle.differences(op13_prefix_trie(spark, folder), oracle.connect(folder), ORACLES["op13_prefix_trie"]) == []


@pytest.mark.parametrize(("height", "block", "seed"), [(2, 4, 1), (3, 9, 2), (8, 1024, 3)])
def test_random_conversations(rows, height, block, seed):
    draw = random.Random(seed)
    texts = ["", "one", "two words", None, "a\nb  c", "é x"]
    turns = []
    for c in range(-30, 90):
        if draw.random() < 0.8:
            for turn in range(draw.choice([1, 1, 2, 3, 5, 8, 20])):
                turns.append((c, turn, draw.choice(["user", "assistant", None]) if turn > 3 else "user", draw.choice(texts[:2] if turn < 4 else texts)))
    draw.shuffle(turns)
    assert result(prefix_trie(rows(SCHEMA, turns), height=height, block=block)) == brute_force(turns)


def test_long_conversations_and_copies(rows):
    line = [(c, t, "user", f"turn {t}") for c in (0, 7, 20) for t in range(150)]
    line += [(7, 150 + t, "user", "more words here") for t in range(60)]
    line += [(c, t, "user", f"turn {t}") for c in range(100, 140) for t in range(3)]
    want = brute_force(line)
    assert result(prefix_trie(rows(SCHEMA, line), height=4, block=16)) == want
    assert result(prefix_trie(rows(SCHEMA, line), height=8, block=1024)) == want


def test_odd_rows(rows):
    turns = [
        (1, None, "user", "first"), (1, 0, "user", "second"), (1, 5, None, None), (2, 1, "", ""), (3, 3, "user", "x " * 50_000),
        (None, 0, "user", "nobody"), (20, 0, "user", "first"), (21, 0, "user", "first"), (21, 0, "user", "first"), (40, 1, "a", "b"),
    ]
    df = rows(SCHEMA, turns).withColumn("depth", F.lit("x")).withColumn("K1", F.lit(1)).withColumn("c", F.lit(2))
    assert result(prefix_trie(df)) == brute_force(turns)
    assert prefix_trie(rows(SCHEMA, [])).collect() == []
    (only,) = result(prefix_trie(rows(SCHEMA, [(7, 0, "user", "gone")])))  # crc32("7") % 4 = 3: nothing is left
    assert only[:7] == (7, 0, None, 1, 0, 1, 0)


def test_no_rebuilding(rows):
    turns = [(c, t, "user", f"{t}{'' if t < 2 else c}") for c in range(6) for t in range(4)]
    assert result(prefix_trie(rows(SCHEMA, turns), heads=1)) == brute_force(turns, heads=1)


@pytest.mark.parametrize("at_once", [1, 7, 10_000])
def test_lists_that_span_tasks(spark, at_once):
    ends = spark.range(4000).select(
        F.lit(1).cast("bigint").alias("depth"), F.when(F.col("id") < 3000, 5).otherwise(F.col("id") % 50).cast("bigint").alias("k1"),
        F.lit(0).cast("bigint").alias("k2"), (F.col("id") * 7919 % 4000 - 100).alias("c"),
    )
    want = defaultdict(list)
    for r in ends.collect():
        want[r.depth, r.k1, r.k2].append(r.c)
    got = {tuple(r[k] for k in KEY): r.ends_sha256 for r in digested_lists(ends, Staging(spark), at_once).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
