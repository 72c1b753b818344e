"""Delete semantics on literal rows."""

import pytest
from helpers import values

from relgraph.operators import cascade, cleanup, deletion
from relgraph.plans.spec import (
    AGGREGATION,
    ASSOCIATION,
    CASCADE,
    COMPOSITION,
    SET_NULL,
    Link,
    Reference,
    RelationSpec,
    SharedKey,
    on_delete,
    shared_owner_columns,
)


def ids(rows, *keys):
    return rows("id bigint", [(k,) for k in keys])


def test_detach_nulls_the_key_of_the_deleted_parent(rows):
    # the child with id 10 must not be mistaken for the parent with id 10
    child = rows("id bigint, a_fk bigint, b_fk bigint", [(1, 10, None), (2, 10, 20), (10, 99, None)])
    kept, lost = deletion.detach_children(child, "a_fk", ids(rows, 10), multi_owner=True)
    assert values(kept) == [(1, None, None), (10, 99, None), (2, None, 20)]
    assert values(lost) == [(1,), (2,)]


def test_detach_of_a_single_owner_keeps_the_key(rows):
    child = rows("id bigint, a_fk bigint", [(1, 10), (2, 11)])
    kept, lost = deletion.detach_children(child, "a_fk", ids(rows, 10))
    assert values(kept) == [(1, 10), (2, 11)]
    assert values(lost) == [(1,)]


def test_several_owners_must_all_be_gone(rows):
    child = rows("id bigint, a_fk bigint, b_fk bigint", [(1, None, None), (2, None, 20), (3, None, None)])
    assert values(deletion.owners_all_null(child, ids(rows, 1, 2), ["a_fk", "b_fk"])) == [(1,)]
    assert values(deletion.owners_all_null(child, ids(rows, 1, 2), ["a_fk"])) == [(1,), (2,)]


def test_two_owner_cascade(rows):
    tables = {
        "item": rows("id bigint, a_fk bigint, b_fk bigint", [(1, 10, None), (2, 10, 20), (3, 10, 21), (4, None, 21)]),
        "a": ids(rows, 10, 11),
        "b": ids(rows, 20, 21),
    }
    spec = RelationSpec(
        dict.fromkeys(tables, "id"),
        [
            Reference("item", "a_fk", "a", AGGREGATION, multi_owner=True),
            Reference("item", "b_fk", "b", AGGREGATION, multi_owner=True),
        ],
    )
    result = cascade.cascade_delete(tables, spec, {"a": ids(rows, 10), "b": ids(rows, 21)})
    assert values(result.deleted) == [("a", 10), ("b", 21), ("item", 1), ("item", 3), ("item", 4)]
    assert values(result.detached) == [("item", 2, "a_fk")]
    assert values(result.survivors("item")) == [(2, None, 20)]


def test_lineage_and_class(rows):
    objects = rows(
        "id bigint, lineage string, objectclass_id int", [(1, "L", 5), (2, "L", 6), (3, None, 5)]
    )
    assert values(deletion.select_by_lineage(objects, "L", 5)) == [(1,)]
    assert values(deletion.select_by_lineage(objects, "L")) == [(1,), (2,)]


@pytest.mark.parametrize("parent,expected", [("feature_id", [10]), (None, [10, 11])])
def test_bridge_cleanup_cascades_from_empty_owners(rows, parent, expected):
    tables = {
        "payload": ids(rows, 1, 2),
        "parameter": rows("payload_id bigint", [(2,)]),
        "look": rows("id bigint, feature_id bigint", [(10, None), (11, 7), (12, None)]),
        "bridge": rows("look_id bigint, payload_id bigint", [(10, 1), (11, 1), (12, 2)]),
        "note": rows("id bigint, look_id bigint", [(100, 10), (101, 12)]),
    }
    spec = RelationSpec(
        {"payload": "id", "look": "id", "note": "id"},
        [Reference("note", "look_id", "look", COMPOSITION)],
        [Link("bridge", "look", "look_id", "payload", "payload_id")],
    )
    first, second = cleanup.cleanup_bridge(
        tables, spec, "payload", ("parameter", "payload_id"), "look", ("bridge", "look_id"), parent
    )
    assert values(first.deleted) == [("payload", 1)]
    assert values(second.deleted) == [("look", i) for i in expected] + [("note", 100)]
    _, local = cleanup.cleanup_bridge(
        tables, spec, "payload", ("parameter", "payload_id"), "look", ("bridge", "look_id"), parent, cascade=False
    )
    assert values(local.deleted) == [("look", i) for i in expected]


def test_cleanup_needs_a_referrer(rows):
    spec = RelationSpec({"t": "id"}, [Reference("t", "up", "t")])
    with pytest.raises(ValueError, match="nothing can refer to"):
        cleanup.cleanup_unreferenced({"t": rows("id bigint, up bigint", [(1, None)])}, spec, "t")


def test_cleanup_ignores_self_references_and_null_keys(rows):
    tables = {"t": rows("id bigint, up bigint", [(1, 2), (2, None), (3, None)]), "u": rows("id bigint, t_id bigint", [(1, 3), (2, None)])}
    spec = RelationSpec({"t": "id", "u": "id"}, [Reference("t", "up", "t"), Reference("u", "t_id", "t")])
    assert values(cleanup.cleanup_unreferenced(tables, spec, "t").deleted) == [("t", 1), ("t", 2)]


def test_tree_with_self_loop_and_cycle(rows):
    tree = rows("id bigint, up bigint", [(1, 1), (2, 1), (3, 4), (4, 3), (5, 4), (6, None), (7, 6)])
    assert values(cascade.part_closure(tree, ids(rows, 1), "up")) == [(1,), (2,)]
    assert values(cascade.part_closure(tree, ids(rows, 3), "up")) == [(3,), (4,), (5,)]


def test_null_ids_delete_nothing(rows):
    tree = rows("id bigint, up bigint", [(1, None), (2, None)])
    roots = rows("id bigint", [(None,), (99,)])
    assert values(cascade.part_closure(tree, roots, "up")) == []
    survivors, removed = deletion.delete_rows(tree, roots)
    assert values(survivors, "id") == [(1,), (2,)] and values(removed) == []


def test_composition_members_go_even_if_still_linked(rows):
    tables = {"a": ids(rows, 1, 2), "m": ids(rows, 7, 8), "l": rows("a_id bigint, m_id bigint", [(1, 7), (2, 7), (2, 8), (None, 8), (1, None)])}
    keys = {"a": "id", "m": "id"}
    for kind, gone in [(COMPOSITION, [7]), (AGGREGATION, []), (ASSOCIATION, [])]:
        spec = RelationSpec(keys, links=[Link("l", "a", "a_id", "m", "m_id", kind)])
        result = cascade.cascade_delete(tables, spec, {"a": ids(rows, 1)})
        assert values(result.deleted) == [("a", 1)] + [("m", i) for i in gone]
        left = [(2, 7), (2, 8), (None, 8)] if not gone else [(2, 8), (None, 8)]
        assert values(result.survivors("l")) == left
        assert result.unlinked.count() == 5 - len(left)


def test_shared_target_with_mixed_kinds_is_counted(rows):
    assert deletion.owned_kind([COMPOSITION, AGGREGATION, ASSOCIATION]) == AGGREGATION
    assert deletion.owned_kind([COMPOSITION, ASSOCIATION]) == COMPOSITION
    assert deletion.owned_kind([ASSOCIATION]) is None
    tables = {"f": rows("id bigint, g1 bigint, g2 bigint", [(1, 50, 51), (2, 51, None), (3, 52, 52)]), "g": ids(rows, 50, 51, 52)}
    refs = [Reference("f", "g1", "g", COMPOSITION, owned="target"), Reference("f", "g2", "g", AGGREGATION, owned="target")]
    result = cascade.cascade_delete(tables, RelationSpec({"f": "id", "g": "id"}, refs), {"f": ids(rows, 1, 3)})
    assert values(result.deleted) == [("f", 1), ("f", 3), ("g", 50), ("g", 52)]


def test_owner_deleted_later_in_the_same_cascade(rows):
    # the template is shared by two owners that fall in different rounds
    tables = {
        "top": ids(rows, 1),
        "part": rows("id bigint, top_id bigint, up bigint, t_id bigint", [(10, 1, None, 5), (11, None, 10, 5), (12, None, 11, 6)]),
        "t": ids(rows, 5, 6),
    }
    spec = RelationSpec(
        dict.fromkeys(tables, "id"),
        [
            Reference("part", "top_id", "top", COMPOSITION),
            Reference("part", "up", "part", COMPOSITION),
            Reference("part", "t_id", "t", AGGREGATION, owned="target"),
        ],
    )
    result = cascade.cascade_delete(tables, spec, {"top": ids(rows, 1)})
    assert values(result.deleted) == [("part", 10), ("part", 11), ("part", 12), ("t", 5), ("t", 6), ("top", 1)]


def test_two_relations_share_a_child_table(rows):
    tables = {"p": ids(rows, 1), "c": rows("id bigint, x bigint, y bigint", [(1, 1, None), (2, None, 1), (3, 1, 1), (4, None, None)])}
    spec = RelationSpec({"p": "id", "c": "id"}, [Reference("c", "x", "p", COMPOSITION), Reference("c", "y", "p", COMPOSITION)])
    result = cascade.cascade_delete(tables, spec, {"p": ids(rows, 1)})
    assert values(result.deleted) == [("c", 1), ("c", 2), ("c", 3), ("p", 1)]


def test_shared_keys_up_down_and_hooks(rows):
    tables = {
        "base": rows("id bigint, objectclass_id int", [(1, 5), (2, 6), (3, 9)]),
        "sub": ids(rows, 1, 2),
        "leaf": ids(rows, 2),
        "hook": ids(rows, 1, 3),
    }
    spec = RelationSpec(
        dict.fromkeys(tables, "id"),
        shared_keys=[
            SharedKey("sub", "base", (5, 6)),
            SharedKey("leaf", "sub", (6,)),
            SharedKey("hook", "base", hook=True),
        ],
        class_table="base",
    )

    def run(root, *keys):
        return values(cascade.cascade_delete(tables, spec, {root: ids(rows, *keys)}).deleted)

    assert run("base", 1, 3) == [("base", 1), ("base", 3), ("hook", 1), ("hook", 3), ("sub", 1)]
    assert run("leaf", 2) == [("base", 2), ("leaf", 2), ("sub", 2)]
    assert run("hook", 3) == [("hook", 3)]


def test_base_and_dispatch_callers(rows):
    base = rows("id bigint, objectclass_id int", [(1, 5), (2, 6), (3, 9)])
    kept, gone = deletion.delete_base_rows(base, ids(rows, 1), caller=deletion.FROM_BASE)
    assert kept.count() == 3 and gone.count() == 0
    kept, gone = deletion.delete_base_rows(base, ids(rows, 1))
    assert values(gone) == [(1,)]
    assert deletion.delete_base_rows(base, ids(rows, 1), hook=True)[1].count() == 0
    classes = {5: "a", 6: "b"}
    assert values(deletion.dispatch_subclasses(base, ids(rows, 1, 2, 3), classes)) == [("a", 1), ("b", 2)]
    assert deletion.dispatch_subclasses(base, ids(rows, 1), classes, caller=deletion.FROM_SUB).count() == 0


def test_policies():
    assert on_delete("1:1", COMPOSITION) == SET_NULL
    assert on_delete("1:N", ASSOCIATION) == SET_NULL
    assert on_delete("1:N", AGGREGATION) is None
    assert on_delete("1:N", ASSOCIATION, target_is_value=True) is None
    assert on_delete("M:N", ASSOCIATION) == CASCADE
    assert on_delete("M:N", COMPOSITION) is None
    assert on_delete("M:N", COMPOSITION, target_is_foreign=True) == CASCADE


def test_cascade_policy_set_null_and_blocked_rows(rows):
    tables = {"p": ids(rows, 1, 2), "c": rows("id bigint, x bigint", [(1, 1), (2, 2)])}
    keys = {"p": "id", "c": "id"}

    def run(policy):
        spec = RelationSpec(keys, [Reference("c", "x", "p", on_delete=policy)])
        return cascade.cascade_delete(tables, spec, {"p": ids(rows, 1)})

    assert values(run(CASCADE).deleted) == [("c", 1), ("p", 1)]
    assert values(run(SET_NULL).survivors("c")) == [(1, None), (2, 2)]
    assert values(run(SET_NULL).blocked) == []
    assert values(run(None).blocked) == [("c", 1, "x")]


def test_owner_columns_from_facts():
    facts = [
        {"child_id": 1, "max_occurs": None, "join_table_or_column_name": "X_ID"},
        {"child_id": 1, "max_occurs": None, "join_table_or_column_name": "AXID"},
        {"child_id": 1, "max_occurs": None, "join_table_or_column_name": "y"},
        {"child_id": 1, "max_occurs": 1, "join_table_or_column_name": "z_id"},
        {"child_id": 1, "max_occurs": None, "join_table_or_column_name": "id"},
        {"child_id": 9, "max_occurs": None, "join_table_or_column_name": "w_id"},
    ]
    found = shared_owner_columns(facts, {1: "Item"})
    assert found == {"item": ["x_id", "axid"]}
    spec = RelationSpec(
        {"item": "id", "p": "id"},
        [Reference("item", "x_id", "p", AGGREGATION), Reference("item", "axid", "p", AGGREGATION), Reference("item", "z_id", "p", AGGREGATION)],
    ).with_multi_owner(found)
    assert spec.owner_columns("item") == ["axid", "x_id"]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        RelationSpec({"a": "id"}, [Reference("b", "x", "a")])
    with pytest.raises(ValueError):
        RelationSpec({"a": "id", "l": "id"}, links=[Link("l", "a", "x", "a", "y")])
    with pytest.raises(ValueError):
        Reference("a", "x", "b", kind="FRIEND")


def test_two_owners_share_unless_told_otherwise(rows):
    tables = {
        "a": rows("id bigint", [(1,)]),
        "b": rows("id bigint", [(2,)]),
        "c": rows("id bigint, a_id bigint, b_id bigint", [(9, 1, 2), (8, 1, None)]),
    }
    keys = dict.fromkeys(tables, "id")

    def deleted(*roots, **flags):
        spec = RelationSpec(
            keys, [Reference("c", "a_id", "a", AGGREGATION, **flags), Reference("c", "b_id", "b", AGGREGATION, **flags)]
        )
        result = cascade.cascade_delete(tables, spec, {t: ids(rows, tables[t].first().id) for t in roots})
        return [i for t, i in values(result.deleted) if t == "c"]

    assert deleted("a") == [8] and sorted(deleted("a", "b")) == [8, 9]
    assert sorted(deleted("a", multi_owner=False)) == [8, 9]


def test_keys_of_different_types_meet_as_text(rows):
    tables = {
        "p": rows("id string", [("x",), ("y",)]),
        "c": rows("id bigint, p_id string", [(1, "x"), (2, "y")]),
        "m": rows("id bigint", [(5,)]),
        "l": rows("p_id string, m_id bigint", [("x", 5), ("y", 5)]),
    }
    spec = RelationSpec(
        {"p": "id", "c": "id", "m": "id"}, [Reference("c", "p_id", "p", COMPOSITION)], [Link("l", "p", "p_id", "m", "m_id", AGGREGATION)]
    )
    result = cascade.cascade_delete(tables, spec, {"p": rows("id string", [("x",)])})
    assert values(result.deleted) == [("c", "1"), ("p", "x")]
    assert values(result.unlinked) == [("l", "x", "5")]
    assert values(result.blocked) == [] and result.deleted.schema["id"].dataType.simpleString() == "string"


def test_a_long_chain_takes_few_steps(rows, monkeypatch):
    from relgraph.plans.staging import Staging

    steps, opened = [], []
    for name in ("keep_counting", "append_keys"):
        monkeypatch.setattr(Staging, name, lambda self, *a, f=getattr(Staging, name), **b: (steps.append(1), f(self, *a, **b))[1])
    paths = Staging.key_paths
    monkeypatch.setattr(Staging, "key_paths", lambda self, *a, **b: opened.append(paths(self, *a, **b)) or opened[-1])
    n = 1000
    tree = rows("id bigint, up bigint", [(i, i - 1 if i else None) for i in range(n)] + [(2000, 2001), (2001, 2000), (3000, 3000)])
    got = values(cascade.part_closure(tree, ids(rows, 3, 2000, 3000), "up"))
    assert sorted(i for (i,) in got) == [*range(3, n), 2000, 2001, 3000]
    assert len(steps) <= 16
    # every read opens only folders that hold its own set
    assert opened and all("_set=part" in p for found in opened for p in found) and max(map(len, opened)) <= 2 + cascade.WAVES


def test_a_delete_in_a_large_shallow_table_writes_what_lies_below(rows, spark, monkeypatch):
    from relgraph.plans.staging import Staging

    written = []
    keep, append = Staging.keep_counting, Staging.append_keys
    monkeypatch.setattr(Staging, "keep_counting", lambda self, *a, **b: (out := keep(self, *a, **b), written.append(out[1]))[0])
    monkeypatch.setattr(Staging, "append_keys", lambda self, *a, **b: (out := append(self, *a, **b), written.append(sum(out.values())))[0])
    tree = spark.range(20_000).selectExpr("id", "case when id > 0 then id div 27 end as up")  # 4 levels below the root
    got = values(cascade.part_closure(tree, ids(rows, 7), "up"))
    assert sorted(i for (i,) in got) == [7, *range(189, 216), *range(5103, 5832)]
    assert sum(written) == 1 + 27 + 729
    written.clear()
    assert cascade.part_closure(tree, ids(rows, 0), "up").count() == 20_000
    assert sum(written) == 20_000


@pytest.mark.parametrize("broadcast", [False, True])
def test_several_keys_of_a_row_meet_their_sets_together(rows, settings, broadcast):
    settings(autoBroadcastJoinThreshold="10485760" if broadcast else "-1")
    n = 60
    tables = {
        "a": rows("id bigint", [(i,) for i in range(n)]),
        "b": rows("id string", [(f"b{i}",) for i in range(n)]),
        "t": rows(
            "id bigint, a1 bigint, a2 bigint, b1 string, w string",
            [(i, i, (i * 7) % n if i % 3 else None, f"b{(i * 11) % n}" if i % 4 else None, f"w{i}") for i in range(n)] + [(None, 1, 2, "b3", "no id"), (5, 1, 1, "b1", "again")],
        ),
    }
    refs = [Reference("t", c, t, AGGREGATION, multi_owner=True) for c, t in (("a1", "a"), ("a2", "a"), ("b1", "b"))]
    spec = RelationSpec({"a": "id", "b": "id", "t": "id"}, refs)
    gone_a, gone_b = {0, 1, 5, 14, 21, 35, 49}, {"b0", "b1", "b3", "b11", "b55"}
    result = cascade.cascade_delete(tables, spec, {"a": ids(rows, *gone_a), "b": rows("id string", [(b,) for b in gone_b])})
    data = [tuple(r) for r in tables["t"].collect()]
    left = lambda r: [k for k, gone in ((r[1], gone_a), (r[2], gone_a), (r[3], gone_b)) if k is not None and k not in gone]
    touched = lambda r: r[1] in gone_a or r[2] in gone_a or r[3] in gone_b
    owned = {r[0] for r in data if r[0] is not None and left(r)}
    dead = {r[0] for r in data if r[0] is not None and touched(r) and r[0] not in owned}
    assert {i for t, i in values(result.deleted) if t == "t"} == {str(i) for i in dead}
    null = lambda k, gone: None if k in gone else k
    want = [(r[0], null(r[1], gone_a), null(r[2], gone_a), null(r[3], gone_b), r[4]) for r in data if r[0] not in dead]
    assert values(result.survivors("t")) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    lost = [("t", str(r[0]), c) for r in data if r[0] is not None and r[0] not in dead for c, k, gone in (("a1", r[1], gone_a), ("a2", r[2], gone_a), ("b1", r[3], gone_b)) if k in gone]
    assert [r for r in values(result.detached) if r[1] is not None] == sorted(lost)
    assert values(result.blocked) == []


def test_a_cascade_goes_on_from_what_it_has_written(rows):
    tables = {
        "p": rows("id bigint", [(1,), (2,), (3,)]),
        "c": rows("id bigint, p_id bigint, q_id bigint", [(10, 1, 7), (11, 2, 7), (12, 3, 8), (13, None, 8)]),
        "q": rows("id bigint", [(7,), (8,)]),
        "l": rows("p_id bigint, q_id bigint", [(1, 7), (2, 7), (3, 8), (2, 8)]),
    }
    spec = RelationSpec(
        {"p": "id", "c": "id", "q": "id"},
        [Reference("c", "p_id", "p", AGGREGATION, multi_owner=True), Reference("c", "q_id", "q", AGGREGATION, multi_owner=True)],
        [Link("l", "p", "p_id", "q", "q_id")],
    )
    run = cascade.Cascade(tables, spec)
    first = run.delete({"p": ids(rows, 1)})
    assert values(first.deleted) == [("p", 1)] and values(first.unlinked) == [("l", 1, 7)]
    second = run.delete({"q": ids(rows, 7), "p": ids(rows, 1)})
    assert values(second.deleted) == [("c", 10), ("q", 7)]  # 10 has lost both owners, one in each call
    assert values(second.unlinked) == [("l", 2, 7)]
    assert values(second.survivors("c")) == [(11, 2, None), (12, 3, 8), (13, None, 8)]
    assert values(second.survivors("p")) == [(2,), (3,)] and values(second.survivors("l")) == [(2, 8), (3, 8)]
    assert values(second.detached) == [("c", 11, "q_id")]
    whole = cascade.cascade_delete(tables, spec, {"q": ids(rows, 7), "p": ids(rows, 1)})
    assert values(whole.deleted) == values(first.deleted.union(second.deleted))
