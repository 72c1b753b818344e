"""Nested records to tables.  The nested inputs are built row by row from the
test tables: lines of a text, values of a row, short arrays of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relgraph.functions.boxes import point, sides
from relgraph.operators import shred as S
from relgraph.operators.assemble import assemble
from relgraph.operators.cascade import cascade_delete
from relgraph.operators.object_boxes import object_boxes
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel, ClassType, Property
from relgraph.plans.model_relations import relation_spec
from relgraph.plans.spec import AGGREGATION, COMPOSITION
from relgraph.workload.tables import EVENT_CLASSES, part_tree, table

# --- one-to-many -----------------------------------------------------------

DOCUMENT_MODEL = ClassModel(
    [
        ClassType(
            "AbstractDocument",
            (Attribute("lang"), Attribute("source", C.ENUM)),
            (Property("line", "TextLine", kind=COMPOSITION),),
        ),
        ClassType("TextLine", (Attribute("text"),)),
    ]
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda v: F.struct(v.alias("text")))
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang", "source", lines.alias("line"))


def _document_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return S.shred({"AbstractDocument": _documents(spark, folder)}, DOCUMENT_MODEL, ordered_keys=True)


def shred_document_lines(spark, folder):
    return _document_tables(spark, folder)["textline"]


def shred_documents(spark, folder):
    return _document_tables(spark, folder)["document"]


def shred_roundtrip(spark, folder):
    """Lines joined back in key order give the documents again.  The group of a
    document is as large as the record it came from."""
    lines = _document_tables(spark, folder)["textline"]
    texts = lines.groupBy(F.col("document_line_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("id", "text"))).alias("rows")
    )
    return texts.select("id", F.array_join(F.transform("rows", lambda r: r["text"]), "\n").alias("text"))


def shred_assemble(spark, folder):
    """The documents with their lines, put together again by the model."""
    back = assemble(_document_tables(spark, folder), DOCUMENT_MODEL, "AbstractDocument")
    text = F.array_join(F.transform("line", lambda v: v["text"]), "\n")
    return back.select("id", "lang", "source", F.size("line").alias("n_lines"), text.alias("text"))


# --- self references -------------------------------------------------------


def _tree_model(kind: str) -> ClassModel:
    return ClassModel(
        [ClassType("Part", (Attribute("size", type="int"),), (Property("inside", "Part", kind=kind),))]
    )


def _nested_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Each part lists the four keys that would be inside it; keys without a
    part are ignored."""
    inside = F.transform(F.array(*[F.lit(n) for n in (1, 2, 3, 4)]), lambda n: F.col("id") * 4 + n)
    return part_tree(spark, folder).select("id", F.col("p_size").alias("size"), inside.alias("inside"))


def shred_self_key(spark, folder):
    """An aggregation of parts is a key in their own table."""
    return S.shred({"Part": _nested_parts(spark, folder)}, _tree_model(AGGREGATION))["part"]


def shred_self_tree(spark, folder):
    """A composition of parts keeps the parent and the root."""
    return S.shred({"Part": _nested_parts(spark, folder)}, _tree_model(COMPOSITION))["part"]


# --- many-to-many and foreign classes --------------------------------------


def _mn_model(kind: str = "ASSOCIATION") -> ClassModel:
    return ClassModel(
        [
            ClassType("Supplier", (), (Property("serves", "Customer", kind=kind, reverse="servedBy"),)),
            ClassType("Customer", (), (Property("servedBy", "Supplier", reverse="serves"),)),
        ]
    )


def _serving(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Suppliers list four customers each, customers two suppliers each."""
    key = F.col("s_suppkey")
    suppliers = table(spark, folder, "supplier").select(
        key.alias("id"), F.array(key, key + 1, key + 2, key * 3).alias("serves")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.array(F.col("c_custkey"), F.col("c_nationkey").cast("long")).alias("servedBy")
    )
    return {"Supplier": suppliers, "Customer": customers}


def shred_mn(spark, folder):
    return S.shred(_serving(spark, folder), _mn_model())["customer_servedby_to_supplier_serves"]


def shred_mn_owned(spark, folder):
    """The owning side becomes a key on the customers; the link has all pairs of both sides."""
    tables = S.shred(_serving(spark, folder), _mn_model(AGGREGATION))
    link = tables["supplier_serves_to_customer_servedby"]
    keys = tables["customer"]
    return keys.select(
        F.lit("customer").alias("tbl"), F.col("id").alias("id1"), F.col("supplier_serves_id").alias("id2")
    ).unionByName(
        link.select(
            F.lit("link").alias("tbl"),
            F.col("customer_servedby_id").alias("id1"),
            F.col("supplier_serves_id").alias("id2"),
        )
    )


def shred_mn_self(spark, folder):
    """Parts that replace others, and parts replaced by others."""
    model = ClassModel(
        [
            ClassType(
                "Part",
                (),
                (Property("replaces", "Part", reverse="spareOf"), Property("spareOf", "Part", reverse="replaces")),
            )
        ]
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.array("p_size", F.col("p_size") + 1).cast("array<bigint>").alias("replaces"),
        F.array(F.col("p_partkey") + 1).alias("spareOf"),
    )
    return S.shred({"Part": parts}, model)["part_replaces_spareof"]


def shred_foreign_link(spark, folder):
    """Orders list parts, a class another model owns: a link, not a key."""
    model = ClassModel(
        [ClassType("Order", (), (Property("part", "Part"),)), ClassType("Part", foreign=True)]
    )
    orders = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.array("l_partkey", "l_suppkey").alias("part")
    )
    return S.shred({"Order": orders}, model)["order_to_part"]


def shred_two_foreign_links(spark, folder):
    """Two properties that lead to one foreign class keep their own links."""
    model = ClassModel(
        [ClassType("Order", (), (Property("part", "Part"), Property("spare", "Part"))), ClassType("Part", foreign=True)]
    )
    orders = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.array("l_partkey").alias("part"), F.array("l_suppkey").alias("spare")
    )
    tables = S.shred({"Order": orders}, model)
    return tables["order_part_to_part"].select(F.lit("part").alias("link"), "order_id", "part_id").unionByName(
        tables["order_spare_to_part"].select(F.lit("spare").alias("link"), "order_id", "part_id")
    )


def shred_violations(spark, folder):
    """Customers that, against the model, several suppliers list as their own."""
    model = ClassModel(
        [ClassType("Supplier", (), (Property("serves", "Customer", kind=COMPOSITION),)), ClassType("Customer")]
    )
    frames = _serving(spark, folder)
    frames["Customer"] = frames["Customer"].select("id")
    lost = S.shred(frames, model).violations
    return lost.select(F.col("table").alias("tbl"), "id", F.col("column").alias("col"), "lost_key")


def shred_content_violations(spark, folder):
    """Customers that their orders give with different contents: a microsecond
    more, or a null for an empty note; a map in another order is no difference."""
    model = ClassModel(
        [
            ClassType("Order", (), (Property("buyer", "Customer", 0, 1),)),
            ClassType("Customer", (Attribute("seen", type="dateTime"), Attribute("tags", C.UNKNOWN), Attribute("note"))),
        ]
    )
    odd, key = F.col("o_orderkey") % 2, F.col("o_custkey")
    begin, step = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"), F.expr("interval 1 microsecond")
    one, two = F.lit("a"), F.lit("b")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            key.alias("id"),
            F.when((key % 3 == 0) & (odd == 1), begin + step).otherwise(begin).alias("seen"),
            F.when(odd == 1, F.create_map(one, key, two, F.lit(1).cast("long"))).otherwise(F.create_map(two, F.lit(1).cast("long"), one, key)).alias("tags"),
            F.when((key % 5 != 0) | (odd == 1), F.lit("")).alias("note"),
        ).alias("buyer"),
    )
    lost = S.shred({"Order": orders}, model).violations
    return lost.select(F.col("table").alias("tbl"), "id", F.col("column").alias("col"), "lost_key")


# --- columns ---------------------------------------------------------------


def shred_two_inlines(spark, folder):
    """Two values of one type in one owner."""
    account = ClassType("Account", (Attribute("amount", type="decimal"),), value=True)
    properties = (Property("held", "Account", 1, 1, COMPOSITION), Property("due", "Account", 1, 1, COMPOSITION))
    model = ClassModel([ClassType("Customer", (), properties), account])
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_acctbal").alias("amount")).alias("held"),
        F.struct((-F.col("c_acctbal")).alias("AMOUNT")).alias("Due"),
    )
    return S.shred({"Customer": customers}, model)["customer"]


def shred_mixed_ids(spark, folder):
    """Customers nested with an id, with a null id and without one: keys are
    unique, so every order finds its own again."""
    model = ClassModel(
        [
            ClassType("Order", (), (Property("buyer", "Customer", 0, 1), Property("agent", "Customer", 0, 1))),
            ClassType("Customer", (Attribute("name"),)),
        ]
    )
    known = F.col("o_orderstatus") == "O"
    name = F.when(known, F.concat(F.lit("c"), "o_custkey")).otherwise(F.concat(F.lit("x"), "o_orderkey"))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(
            F.col("o_orderstatus") != "P", F.struct(F.when(known, F.col("o_custkey")).alias("id"), name.alias("name"))
        ).alias("buyer"),
        F.struct(F.concat(F.lit("a"), "o_orderkey").alias("name")).alias("agent"),
    )
    tables = S.shred({"Order": orders}, model)
    out = tables["order"]
    for role in ("buyer", "agent"):
        people = tables["customer"].select(F.col("id").alias(f"{role}_id"), F.col("name").alias(role))
        out = out.join(people, f"{role}_id", "left")
    return out.select("id", "buyer", "agent")


def shred_inline(spark, folder):
    """A plain value type folds into its owner."""
    model = ClassModel(
        [
            ClassType("Customer", (Attribute("name"),), (Property("account", "Account", 1, 1, COMPOSITION),)),
            ClassType("Account", (Attribute("balance", type="decimal"), Attribute("segment", C.ENUM)), value=True),
        ]
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")).alias("account"),
    )
    return S.shred({"Customer": customers}, model)["customer"]


def shred_ref(spark, folder):
    """A single reference is a key of the owner, nested or not."""
    model = ClassModel(
        [
            ClassType("Order", (Attribute("status"),), (Property("buyer", "Customer", 0, 1),)),
            ClassType("Customer", (Attribute("name"),)),
        ]
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.struct(F.col("o_custkey").alias("id"), F.concat(F.lit("c"), F.col("o_custkey")).alias("name")),
        ).alias("buyer"),
    )
    tables = S.shred({"Order": orders}, model)
    return (
        tables["order"]
        .select(F.lit("order").alias("tbl"), "id", F.col("status").alias("label"), "buyer_id")
        .unionByName(
            tables["customer"].select(
                F.lit("customer").alias("tbl"), "id", F.col("name").alias("label"), F.lit(None).cast("long").alias("buyer_id")
            )
        )
    )


def shred_uom(spark, folder):
    model = ClassModel(
        [ClassType("Line", (Attribute("weight", C.VALUE, "MeasureType"), Attribute("state", C.VALUE, "CodeType")))]
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.struct(F.col("l_quantity").alias("value"), F.lit("kg").alias("uom")).alias("weight"),
        F.struct(F.col("l_linestatus").alias("value"), F.lit("status").alias("codespace")).alias("state"),
    )
    rows = S.shred({"Line": lines}, model)["line"]
    return rows.groupBy("id", "weight", "weight_uom", "state", "state_codespace").agg(F.count(F.lit(1)).alias("lines"))


def shred_period(spark, folder):
    """First and last event of each user as a period, and their range as a list."""
    model = ClassModel(
        [ClassType("User", (Attribute("active", C.PERIOD), Attribute("span", C.MEASURE_LIST)))]
    )
    users = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("id"))
        .agg(
            F.struct(F.min("ts").alias("begin"), F.max("ts").alias("end")).alias("active"),
            F.struct(
                F.array(F.min("event_id"), F.max("event_id")).alias("values"), F.lit("no").alias("uom")
            ).alias("span"),
        )
    )
    return S.shred({"User": users}, model)["user"]


def shred_choice(spark, folder):
    """A choice: each order has either a note or a priority, never both."""
    model = ClassModel(
        [
            ClassType(
                "Order",
                (),
                (Property("note", "Note", 1, 1, choice=True), Property("rank", "Rank", 1, None, choice=True)),
            ),
            ClassType("Note", (Attribute("text"),), value=True),
            ClassType("Rank", (Attribute("text"),), value=True),
        ]
    )
    is_note = F.col("o_orderstatus") == "P"
    text = F.struct(F.col("o_orderpriority").alias("text"))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(is_note, text).alias("note"), F.when(~is_note, text).alias("rank")
    )
    tables = S.shred({"Order": orders}, model, ordered_keys=True)
    return tables["order"]


def _text_tables(spark: SparkSession, folder: str) -> S.Tables:
    model = ClassModel(
        [
            ClassType(
                "Event",
                (
                    Attribute("kind", C.ENUM),
                    Attribute("number", type="unsignedLong"),
                    Attribute("share", type="doubleBetween0and1"),
                    Attribute("flag", type="boolean"),
                    Attribute("rest", C.UNKNOWN),
                    Attribute("raw", C.UNKNOWN),
                ),
            )
        ]
    )
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("kind"),
        F.when(F.col("value") > 20, F.lit("n/a")).otherwise(F.get_json_object("props", "$.k")).alias("number"),
        F.col("value").cast("string").alias("share"),
        F.when(F.col("event_type") == "error", F.lit("true")).otherwise(F.lit("maybe")).alias("flag"),
        F.struct(F.col("user_id").alias("u"), F.col("event_type").alias("t")).alias("rest"),
        F.col("props").alias("raw"),
    )
    return S.shred({"Event": events}, model)


def shred_text(spark, folder):
    """Typed and unknown values: text that does not parse becomes null."""
    return _text_tables(spark, folder)["event"]


def shred_bad_values(spark, folder):
    """How many values of which column did not parse."""
    bad = _text_tables(spark, folder).bad_values
    return bad.select(F.col("table").alias("tbl"), F.col("column").alias("col"), "failed", "example")


# --- inheritance -----------------------------------------------------------


def _event_model(**flags) -> ClassModel:
    c = EVENT_CLASSES
    return ClassModel(
        [
            ClassType("AbstractEvent", (Attribute("user", type="long"),), abstract=True, class_id=1),
            ClassType("Click", (Attribute("amount", type="double"),), base="AbstractEvent", class_id=c["click"]),
            ClassType("View", (), base="AbstractEvent", class_id=c["view"]),
            ClassType(
                "Purchase",
                (Attribute("amount", type="double"), Attribute("note")),
                base="AbstractEvent",
                class_id=c["purchase"],
            ),
            ClassType("Signup", (), base="AbstractEvent", class_id=c["signup"]),
            ClassType(
                "Error",
                (Attribute("amount", type="double"), Attribute("note")),
                base="AbstractEvent",
                class_id=c["error"],
            ),
        ],
        **flags,
    )


def _event_frames(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("user"),
        F.col("value").alias("amount"),
        F.col("props").alias("note"),
        "event_type",
    )
    return {
        "Click": rows.where("event_type = 'click'").select("id", "user", "amount"),
        "View": rows.where("event_type = 'view'").select("id", "user"),
        "Purchase": rows.where("event_type = 'purchase'").select("id", "user", "amount", "note"),
        "Signup": rows.where("event_type = 'signup'").select("id", "user"),
        "Error": rows.where("event_type = 'error'").select("id", "user", "amount", "note"),
    }


def shred_merge(spark, folder):
    """Small classes share the table of their abstract parent."""
    return S.shred(_event_frames(spark, folder), _event_model())["event"]


def shred_join(spark, folder):
    """A larger class has its own table with the same key; the class of a row
    in the parent's table says where it goes on."""
    tables = S.shred(_event_frames(spark, folder), _event_model())
    parent = tables["event"].select("id", F.col("objectclass_id").alias("class_id"))
    subs = [tables[t].select(F.lit(t).alias("tbl"), "id", "amount", "note") for t in ("purchase", "error")]
    return parent.join(subs[0].unionByName(subs[1]), "id", "left").select("tbl", "id", "class_id", "amount", "note")


def model_base_delete(spark, folder):
    """From nested rows to a delete that starts in a concrete base of three levels."""
    c = EVENT_CLASSES
    model = ClassModel(
        [
            ClassType("Build", (Attribute("user", type="long"), Attribute("kind")), class_id=c["click"]),
            ClassType("Tower", (Attribute("height", type="double"), Attribute("note")), base="Build", class_id=c["view"]),
            ClassType("Spire", (Attribute("tip"), Attribute("top")), base="Tower", class_id=c["purchase"]),
        ]
    )
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("user"), F.col("event_type").alias("kind"),
        F.col("value").alias("height"), F.col("props").alias("note"), F.col("props").alias("tip"), F.col("event_type").alias("top"),
    )
    tower = ["id", "user", "kind", "height", "note"]
    frames = {
        "Build": rows.where("kind = 'click'").select("id", "user", "kind"),
        "Tower": rows.where("kind = 'view'").select(*tower),
        "Spire": rows.where("kind = 'purchase'").select(*tower, "tip", "top"),
    }
    tables = S.shred(frames, model)
    gone = tables["build"].where("user % 3 = 0").select("id")
    result = cascade_delete(tables, relation_spec(model), {"build": gone})
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def merged_same_name_delete(spark, folder):
    """Two classes of one table, each with a property ``ref`` to a class of its own."""
    model = ClassModel(
        [
            ClassType("AbstractX", abstract=True, class_id=1),
            ClassType("A", (), (Property("ref", "P", 0, 1, COMPOSITION),), base="AbstractX", class_id=2),
            ClassType("B", (), (Property("ref", "Q", 0, 1, COMPOSITION),), base="AbstractX", class_id=3),
            ClassType("P", (Attribute("name"),)),
            ClassType("Q", (Attribute("name"),)),
        ]
    )
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    frames = {
        "A": nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_regionkey").cast("long").alias("ref")),
        "B": table(spark, folder, "supplier").select(
            (F.col("s_suppkey") + 1000).alias("id"), F.col("s_nationkey").cast("long").alias("ref")
        ),
        "P": region.select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")),
        "Q": nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")),
    }
    tables = S.shred(frames, model)
    gone = tables["x"].where("id < 2").select("id")
    result = cascade_delete(tables, relation_spec(model), {"x": gone})
    return result.deleted.select(F.col("table").alias("tbl"), "id")


# --- geometry --------------------------------------------------------------


SITE_MODEL = ClassModel(
    [
        ClassType(
            "Site",
            (
                Attribute("shell", C.SURFACE),
                Attribute("route", C.LINE),
                Attribute("shape", C.HYBRID),
                Attribute("lod2Model", C.IMPLICIT),
            ),
        )
    ]
)


def _geometry_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    p = point("c_custkey", "c_nationkey", "c_acctbal")
    q = point("c_nationkey", F.lit(1), F.lit(2))
    sites = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.array(F.array(p, q), F.array(q))).alias("shell"),
        F.array(p, q).alias("route"),
        F.struct(
            F.when(F.col("c_acctbal") > 0, F.array(F.array(p))).alias("surfaces"),
            F.when(F.col("c_acctbal") <= 0, F.array(p)).alias("points"),
        ).alias("shape"),
        F.struct(
            F.when(F.col("c_nationkey") > 3, F.array(q)).alias("template"),
            q.alias("ref_point"),
            F.concat(F.lit("1 0 0 "), F.col("c_nationkey"), F.lit(" 0 1 0 0 0 0 1 0")).alias("transformation"),
        ).alias("lod2Model"),
    )
    return S.shred({"Site": sites}, SITE_MODEL, ordered_keys=True)


def shred_geometry(spark, folder):
    site = _geometry_tables(spark, folder)["site"]
    return site.select(
        "id",
        "shell_id",
        F.size("route").alias("route_points"),
        F.col("route")[0]["z"].alias("route_z"),
        "shape_brep_id",
        F.col("shape_other_geom")[0]["z"].alias("shape_z"),
        "lod2_implicit_rep_id",
        F.col("lod2_implicit_ref_point")["x"].alias("ref_x"),
        "lod2_implicit_transformation",
    )


def shred_surfaces(spark, folder):
    rows = _geometry_tables(spark, folder)["surface_geometry"]
    return rows.select("root_id", "position", F.size("geometry").alias("points"), F.col("geometry")[0]["x"].alias("x"))


def shred_templates(spark, folder):
    rows = _geometry_tables(spark, folder)["implicit_geometry"]
    return rows.select("id", F.col("relative_other_geom")[0]["x"].alias("x"))


def shred_object_boxes(spark, folder):
    """Envelopes of the sites from everything their tables hold."""
    boxes = object_boxes(_geometry_tables(spark, folder), SITE_MODEL)["site"]
    return boxes.select("id", *sides())


def shred_brep_templates(spark, folder):
    """Envelopes of sites that place templates made of surfaces."""
    model = ClassModel([ClassType("Site", (Attribute("lod2Model", C.IMPLICIT),))])
    customers, suppliers = table(spark, folder, "customer"), table(spark, folder, "supplier")
    no_shape = F.array(point(F.lit(None), F.lit(None), F.lit(None)))
    tables = {
        "site": customers.select(
            F.col("c_custkey").alias("id"),
            F.col("c_nationkey").cast("long").alias("lod2_implicit_rep_id"),
            point("c_nationkey", F.lit(0), F.lit(0)).alias("lod2_implicit_ref_point"),
            F.lit(None).cast("string").alias("lod2_implicit_transformation"),
        ),
        "implicit_geometry": suppliers.select(F.col("s_nationkey").cast("long").alias("id")).distinct().select(
            "id", F.when(F.lit(False), no_shape).alias("relative_other_geom"), (F.col("id") + 100).alias("relative_brep_id")
        ),
        "surface_geometry": suppliers.select(
            (F.col("s_nationkey").cast("long") + 100).alias("root_id"),
            F.when(F.lit(False), no_shape).alias("geometry"),
            F.array(point("s_suppkey", "s_acctbal", F.lit(0))).alias("implicit_geometry"),
        ),
    }
    return object_boxes(tables, model)["site"].select("id", *sides())


def _hook_tables(spark: SparkSession, folder: str) -> tuple[ClassModel, dict[str, DataFrame]]:
    """Customers with a point, and what another model adds to those with money."""
    model = ClassModel(
        [
            ClassType("Customer", (Attribute("spot", C.LINE), Attribute("name")), class_id=1),
            ClassType("Extra", (Attribute("reach", C.LINE), Attribute("note")), base="Customer", hook=True),
        ]
    )
    rows = table(spark, folder, "customer")
    frames = {
        "Customer": rows.select(
            F.col("c_custkey").alias("id"), F.array(point("c_custkey", F.lit(0), F.lit(0))).alias("spot"), F.col("c_name").alias("name")
        ),
        "Extra": rows.where("c_acctbal > 0").select(
            F.col("c_custkey").alias("id"), F.array(point("c_nationkey", F.lit(1), "c_acctbal")).alias("reach"), F.col("c_name").alias("note")
        ),
    }
    return model, S.shred(frames, model)


def hook_model_delete(spark, folder):
    model, tables = _hook_tables(spark, folder)
    gone = tables["customer"].where("id % 3 = 0").select("id")
    result = cascade_delete(tables, relation_spec(model), {"customer": gone})
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def hook_model_boxes(spark, folder):
    model, tables = _hook_tables(spark, folder)
    return object_boxes(tables, model)["customer"].select("id", *sides())


QUERIES = {
    f.__name__: f
    for f in [
        shred_brep_templates,
        hook_model_delete,
        hook_model_boxes,
        shred_document_lines,
        shred_documents,
        shred_roundtrip,
        shred_self_key,
        shred_self_tree,
        shred_mn,
        shred_mn_owned,
        shred_mn_self,
        shred_foreign_link,
        shred_two_foreign_links,
        shred_violations,
        shred_inline,
        shred_two_inlines,
        shred_mixed_ids,
        model_base_delete,
        merged_same_name_delete,
        shred_ref,
        shred_uom,
        shred_period,
        shred_choice,
        shred_text,
        shred_merge,
        shred_join,
        shred_content_violations,
        shred_bad_values,
        shred_assemble,
        shred_geometry,
        shred_surfaces,
        shred_templates,
        shred_object_boxes,
    ]
}

_LINES = """
    l as (select doc_id, unnest(string_split(text, chr(10))) as text,
                 unnest(range(len(string_split(text, chr(10))))) as pos from documents)"""
_PARENT = "case when p_partkey = 0 then null else (p_partkey - 1) // 4 end"
_SERVING = """
    s as (select s_suppkey as sid, unnest([s_suppkey, s_suppkey + 1, s_suppkey + 2, s_suppkey * 3]) as cid from supplier),
    c as (select c_custkey as cid, unnest([c_custkey, c_nationkey]) as sid from customer)"""
_ROOTS = """
    sh as (select c_custkey, row_number() over (order by c_custkey) as root from customer where c_mktsegment <> 'BUILDING'),
    hy as (select c_custkey, (select count(*) from sh) + row_number() over (order by c_custkey) as root
           from customer where c_acctbal > 0),
    tp as (select c_nationkey, row_number() over (order by c_nationkey) as rep
           from (select distinct c_nationkey from customer where c_nationkey > 3))"""

ORACLES = {
    "shred_document_lines": f"""
        with {_LINES} select row_number() over (order by doc_id, pos) as id, doc_id as document_line_id, text from l""",
    "shred_documents": "select doc_id as id, lang, source from documents",
    "shred_roundtrip": "select doc_id as id, text from documents",
    "shred_self_key": f"select p_partkey as id, p_size::bigint as size, {_PARENT} as part_inside_id from part",
    "shred_self_tree": f"""
        with recursive t as (select p_partkey as id, {_PARENT} as parent_id, p_size from part),
        w as (select id, id as root, parent_id as up from t
              union all select w.id, t.id, t.parent_id from w join t on t.id = w.up)
        select t.id, t.p_size::bigint as size, t.parent_id as part_parent_id, w.root as part_root_id
        from t join w on t.id = w.id where w.up is null""",
    "shred_mn": f"""
        with {_SERVING}
        select cid as customer_servedby_id, sid as supplier_serves_id from s
        union select cid, sid from c""",
    "shred_mn_owned": f"""
        with {_SERVING}
        select 'customer' as tbl, c_custkey as id1, (select min(sid) from s where s.cid = c_custkey) as id2 from customer
        union all select 'link', cid, sid from (select cid, sid from c union select cid, sid from s)""",
    "shred_mn_self": """
        select p_partkey as part_replaces_id, unnest([p_size, p_size + 1]) as part_spareof_id from part
        union select p_partkey + 1, p_partkey from part""",
    "shred_foreign_link": """
        select l_orderkey as order_id, l_partkey as part_id from lineitem union select l_orderkey, l_suppkey from lineitem""",
    "shred_inline": """
        select c_custkey as id, c_name as name, c_acctbal as account_balance, c_mktsegment as account_segment from customer""",
    "shred_ref": """
        select 'order' as tbl, o_orderkey as id, o_orderstatus as label,
               case when o_orderstatus <> 'P' then o_custkey end as buyer_id from orders
        union all select distinct 'customer', o_custkey, 'c' || o_custkey, null from orders where o_orderstatus <> 'P'""",
    "shred_uom": """
        select l_orderkey as id, l_quantity as weight, 'kg' as weight_uom, l_linestatus as state,
               'status' as state_codespace, count(*) as lines from lineitem group by all""",
    "shred_period": """
        select user_id as id, min(ts) as active_beginposition, max(ts) as active_endposition,
               min(event_id) || ' ' || max(event_id) as span, 'no' as span_uom from events group by 1""",
    "shred_choice": """
        select o_orderkey as id,
               case when o_orderstatus = 'P' then row_number() over (partition by o_orderstatus = 'P' order by o_orderkey) end as note_id,
               case when o_orderstatus <> 'P' then row_number() over (partition by o_orderstatus = 'P' order by o_orderkey) end as rank_id
        from orders""",
    "shred_text": """
        select event_id as id, event_type as kind,
               case when value > 20 then null else (props->>'$.k')::bigint end as number, value as share,
               case when event_type = 'error' then true end as flag,
               '{"u":' || user_id || ',"t":"' || event_type || '"}' as rest, props as raw from events""",
    "shred_assemble": """
        select doc_id as id, lang, source, len(string_split(text, chr(10)))::int as n_lines, text from documents""",
    "shred_bad_values": """
        select 'event' as tbl, 'number' as col, count(*) as failed, 'n/a' as example from events where value > 20 having count(*) > 0
        union all select 'event', 'flag', count(*), 'maybe' from events where event_type is distinct from 'error' having count(*) > 0""",
    "shred_content_violations": """
        select 'customer' as tbl, o_custkey::varchar as id, '(content)' as col, null::varchar as lost_key from orders
        group by o_custkey
        having count(distinct (case when o_custkey % 3 = 0 then o_orderkey % 2 else 0 end,
                               case when o_custkey % 5 = 0 and o_orderkey % 2 = 0 then 'no note' else 'empty' end)) > 1""",
    "shred_two_foreign_links": """
        select distinct 'part' as link, l_orderkey as order_id, l_partkey as part_id from lineitem
        union all select distinct 'spare', l_orderkey, l_suppkey from lineitem""",
    "shred_violations": f"""
        with {_SERVING}, d as (select distinct sid, cid from s)
        select 'customer' as tbl, cid::varchar as id, 'supplier_serves_id' as col, sid::varchar as lost_key
        from (select *, min(sid) over (partition by cid) as kept from d) where sid <> kept""",
    "shred_two_inlines": """
        select c_custkey as id, c_acctbal as held_amount, -c_acctbal as due_amount from customer""",
    "shred_mixed_ids": """
        select o_orderkey as id, case o_orderstatus when 'O' then 'c' || o_custkey when 'P' then null
               else 'x' || o_orderkey end as buyer, 'a' || o_orderkey as agent from orders""",
    "model_base_delete": """
        with e as (select event_id as id, event_type as kind from events where user_id % 3 = 0)
        select 'build' as tbl, id from e where kind in ('click', 'view', 'purchase')
        union all select 'tower', id from e where kind in ('view', 'purchase')
        union all select 'spire', id from e where kind = 'purchase'""",
    "merged_same_name_delete": """
        select 'x' as tbl, n_nationkey::bigint as id from nation where n_nationkey < 2
        union all select distinct 'p', n_regionkey::bigint from nation where n_nationkey < 2""",
    "shred_merge": """
        select event_id as id, user_id as user,
               case when event_type = 'click' then value end as amount,
               case event_type when 'click' then 10001 when 'view' then 10002 when 'signup' then 10003
                    when 'purchase' then 10004 else 10005 end as objectclass_id
        from events""",
    "shred_join": """
        select case when event_type in ('purchase', 'error') then event_type end as tbl, event_id as id,
               case event_type when 'click' then 10001 when 'view' then 10002 when 'signup' then 10003
                    when 'purchase' then 10004 else 10005 end as class_id,
               case when event_type in ('purchase', 'error') then value end as amount,
               case when event_type in ('purchase', 'error') then props end as note
        from events""",
    "shred_geometry": f"""
        with {_ROOTS}
        select c.c_custkey as id, sh.root as shell_id, 2 as route_points, c_acctbal as route_z, hy.root as shape_brep_id,
               case when c_acctbal <= 0 then c_acctbal end as shape_z, tp.rep as lod2_implicit_rep_id,
               c.c_nationkey::double as ref_x, '1 0 0 ' || c.c_nationkey || ' 0 1 0 0 0 0 1 0' as lod2_implicit_transformation
        from customer c left join sh on sh.c_custkey = c.c_custkey left join hy on hy.c_custkey = c.c_custkey
        left join tp on tp.c_nationkey = c.c_nationkey""",
    "shred_surfaces": f"""
        with {_ROOTS}
        select root as root_id, 0 as position, 2 as points, c_custkey::double as x from sh
        union all select root, 1, 1, c_nationkey::double from sh join customer using (c_custkey)
        union all select root, 0, 1, c_custkey::double from hy""",
    "shred_object_boxes": """
        with g as (
            select c_custkey as id, c_custkey::double as x, c_nationkey::double as y, c_acctbal as z from customer
            union all select c_custkey, c_nationkey, 1, 2 from customer
            union all select c_custkey, 3 * c_nationkey, 2, 4 from customer where c_nationkey > 3)
        select id, min(x) as xmin, min(y) as ymin, min(z) as zmin, max(x) as xmax, max(y) as ymax, max(z) as zmax
        from g group by id""",
    "shred_brep_templates": """
        with t as (select s_nationkey as n, min(s_suppkey)::double as x1, max(s_suppkey)::double as x2,
                          min(s_acctbal) as y1, max(s_acctbal) as y2 from supplier group by 1)
        select c_custkey as id, x1 + n as xmin, y1 as ymin, 0::double as zmin, x2 + n as xmax, y2 as ymax, 0::double as zmax
        from customer join t on n = c_nationkey""",
    "hook_model_delete": """
        select 'customer' as tbl, c_custkey as id from customer where c_custkey % 3 = 0
        union all select 'extra', c_custkey from customer where c_custkey % 3 = 0 and c_acctbal > 0""",
    "hook_model_boxes": """
        with g as (select c_custkey as id, c_custkey::double as x, 0::double as y, 0::double as z from customer
                   union all select c_custkey, c_nationkey, 1, c_acctbal from customer where c_acctbal > 0)
        select id, min(x) as xmin, min(y) as ymin, min(z) as zmin, max(x) as xmax, max(y) as ymax, max(z) as zmax
        from g group by id""",
    "shred_templates": f"with {_ROOTS} select rep as id, c_nationkey::double as x from tp",
}
