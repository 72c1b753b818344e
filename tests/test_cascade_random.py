"""The cascade against a brute-force fixpoint on random tables."""

import random

import pytest
from helpers import values

from relgraph.operators.cascade import cascade_delete
from relgraph.plans.spec import AGGREGATION, COMPOSITION, Link, Reference, RelationSpec, SharedKey

SPEC = RelationSpec(
    keys={t: "id" for t in ["top", "node", "item", "geo", "sub", "m", "extra"]},
    references=[
        Reference("node", "top_id", "top", COMPOSITION),
        Reference("node", "up", "node", COMPOSITION),
        Reference("item", "a_id", "node", AGGREGATION, multi_owner=True),
        Reference("item", "b_id", "top", AGGREGATION, multi_owner=True),
        Reference("node", "g1", "geo", AGGREGATION, owned="target"),
        Reference("item", "g2", "geo", AGGREGATION, owned="target"),
    ],
    links=[Link("l", "node", "n_id", "m", "m_id", AGGREGATION), Link("k", "m", "m_id", "item", "i_id", COMPOSITION)],
    shared_keys=[SharedKey("sub", "node"), SharedKey("extra", "node", hook=True)],
)


def brute_force(data, roots):
    gone = {t: set() for t in SPEC.keys}
    for t, ids in roots.items():
        gone[t] |= ids & {r["id"] for r in data[t]}
    while True:
        before = {t: set(s) for t, s in gone.items()}

        def unheld(geo):
            return not any(
                r["id"] not in gone[t] and r[c] == geo for t, c in [("node", "g1"), ("item", "g2")] for r in data[t]
            )

        for r in data["node"]:
            if r["top_id"] in gone["top"] or (r["up"] in gone["node"] and r["up"] != r["id"]):
                gone["node"].add(r["id"])
        for r in data["item"]:
            a_gone, b_gone = r["a_id"] in gone["node"], r["b_id"] in gone["top"]
            linked = any(q["i_id"] == r["id"] and q["m_id"] not in gone["m"] for q in data["k"])
            lone = (r["a_id"] is None or a_gone) and (r["b_id"] is None or b_gone) and not linked
            if (a_gone or b_gone) and lone:
                gone["item"].add(r["id"])
        for t, c in [("node", "g1"), ("item", "g2")]:
            for r in data[t]:
                if r["id"] in gone[t] and r[c] is not None and unheld(r[c]) and {"id": r[c]} in data["geo"]:
                    gone["geo"].add(r[c])
        for r in data["l"]:
            if r["n_id"] in gone["node"]:
                live = any(q["m_id"] == r["m_id"] and q["n_id"] not in gone["node"] for q in data["l"])
                if not live:
                    gone["m"].add(r["m_id"])
        for r in data["k"]:
            if r["m_id"] in gone["m"]:
                gone["item"].add(r["i_id"])
        subs, hooks = {r["id"] for r in data["sub"]}, {r["id"] for r in data["extra"]}
        gone["node"] |= gone["sub"] & {r["id"] for r in data["node"]}
        gone["sub"] |= gone["node"] & subs
        gone["extra"] |= gone["node"] & hooks
        if gone == before:
            return gone


def random_data(seed):
    r = random.Random(seed)
    some = lambda n, p=0.6: r.randrange(n) if r.random() < p else None
    data = {
        "top": [{"id": i} for i in range(6)],
        "node": [
            {"id": i, "top_id": some(6, 0.3), "up": some(30, 0.5), "g1": some(12)} for i in range(30)
        ],
        "item": [{"id": i, "a_id": some(30), "b_id": some(6), "g2": some(12, 0.3)} for i in range(25)],
        "geo": [{"id": i} for i in range(12)],
        "sub": [{"id": i} for i in range(30) if r.random() < 0.4],
        "extra": [{"id": i} for i in range(30) if r.random() < 0.3],
        "m": [{"id": i} for i in range(10)],
        "l": [{"n_id": r.randrange(30), "m_id": r.randrange(10)} for _ in range(15)],
        "k": [{"m_id": r.randrange(10), "i_id": r.randrange(25)} for _ in range(6)],
    }
    return data, {"top": {r.randrange(6)}, "node": {r.randrange(30)}}


@pytest.mark.parametrize("seed", range(4))
def test_cascade_matches_brute_force(spark, rows, seed):
    data, roots = random_data(seed)
    tables = {}
    for t, records in data.items():
        columns = list(records[0])
        tables[t] = rows(", ".join(f"{c} bigint" for c in columns), [tuple(x.values()) for x in records])
    result = cascade_delete(tables, SPEC, {t: rows("id bigint", [(i,) for i in s]) for t, s in roots.items()})
    want = brute_force(data, roots)
    got = {}
    for t, i in values(result.deleted):
        got.setdefault(t, []).append(i)
    assert {t: sorted(ids) for t, ids in got.items()} == {t: sorted(s) for t, s in want.items() if s}
    assert values(result.blocked) == []

    left = {t: result.survivors(t) for t in tables}
    for t in SPEC.keys:
        kept = {i for (i,) in values(left[t], "id")}
        assert kept | want[t] == {x["id"] for x in data[t]} and not kept & want[t]
    again = cascade_delete(left, SPEC, {t: rows("id bigint", [(i,) for i in s]) for t, s in roots.items()})
    assert values(again.deleted) == []
