"""The prefix trie of conversations, rolled up by bands of depth.

A node is a distinct sequence of first turns.  It is known by two sums over its
turns, each turn adding a hash of its place and its content, so a node's key is
a prefix sum and the key of its parent is the same sum less the last turn: no
step walks down a tree.  Sums are taken inside blocks of turns and shifted by
the sums of the blocks before, so a very long conversation is not one task's
work, and texts are never shuffled.

Totals of subtrees go up in bands of ``height`` levels.  A node sends its value
only to the ancestors in its band.  Band roots then are the nodes of a tree that
is ``height`` times as flat, which is summed in the same way; on the way back
every completed band root sends its total to the nodes of the band above it.
So a node is exploded ``height`` times at most, and the number of rounds is
twice the logarithm, to the base ``height``, of the greatest depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relgraph.llm.scan import sliced
from relgraph.plans.staging import Staging

HEIGHT = 8
#: Turns whose sums are taken together; sums of so many hashes stay below 2**62.
BLOCK = 1024
_BITS = 52
_MASK = (1 << _BITS) - 1
_WORD = r"[^\x20\x09-\x0D]+"
#: Ids of one piece of a list that is digested piece by piece.
IDS_AT_ONCE = 2000
KEY = ["depth", "k1", "k2"]


def turn_rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, turn, d1, d2, words): conversations without their texts."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    return conversations.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("bigint").alias("c"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("d1"),
        F.xxhash64(F.lit(2), role, text).alias("d2"),
        F.regexp_count(text, F.lit(_WORD)).cast("bigint").alias("words"),
    )


def numbered_turns(turns: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(turns with part and pos, conversations by part): the latter say which number the first turn of a part has.

    Turns go by turn, nulls first, ties by content; equal rows are turns each.
    They are sorted by range, so a conversation may lie in many parts.
    """
    slim, _ = staging.keep(turns, "turns")
    order = ["c", F.col("turn").asc_nulls_first(), "d1", "d2", "tie"]
    rows = slim.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id())
    rows, _ = staging.keep(rows.select("c", "part", "pos", "d1", "d2", "words"), "sorted")
    parts = rows.groupBy("c", "part").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts, _ = staging.keep(parts, "parts")
    return rows, parts


def rebuilt_rows(rows: DataFrame, parts: DataFrame, shared: int, heads: int, staging: Staging) -> DataFrame:
    """(c, depth, d1, d2, words, last) of the rebuilt conversations; depth 0 is a row of its own."""
    sizes = parts.groupBy("c").agg(F.sum("n").alias("n"))
    sizes = sizes.withColumn("h", F.crc32(F.col("c").cast("string")) % heads).withColumn("p", F.col("c") - F.col("c") % shared)
    givers = sizes.where(F.col("c") % shared == 0).select(F.col("c").alias("p"), F.col("n").alias("given"))
    convs = sizes.join(givers, "p", "left").withColumn("m", F.least("h", F.coalesce("given", F.lit(0))))
    convs = convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs, _ = staging.keep(convs.select("c", "p", "h", "m", "length"), "convs")

    # each part of a conversation is a key of its own, so a long one is many keys
    placed = parts.join(convs, "c").select("c", "part", "before", "first_pos", "h", "m", "length")
    placed, _ = staging.keep(placed, "placed")
    numbered = rows.join(placed, ["c", "part"]).withColumn("number", F.col("pos") - F.col("first_pos") + F.col("before"))
    own = numbered.where("number >= h").select(
        "c", (F.col("m") + F.col("number") - F.col("h") + 1).alias("depth"), "d1", "d2", "words", "length"
    )
    first = numbered.where((F.col("c") % shared == 0) & (F.col("number") < heads - 1))
    first = first.select(F.col("c").alias("p"), "number", "d1", "d2", "words")
    taken = convs.where("m > 0").join(first, "p").where("number < m").select(
        "c", (F.col("number") + 1).alias("depth"), "d1", "d2", "words", "length"
    )
    zero = F.lit(0).cast("bigint")
    root = convs.select("c", zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), zero.alias("words"), "length")
    return own.union(taken).union(root).select(
        "c", F.col("depth").cast("bigint"), "d1", "d2", "words", (F.col("depth") == F.col("length")).alias("last")
    )


def keyed_rows(rebuilt: DataFrame, staging: Staging, block: int = BLOCK) -> DataFrame:
    """(c, depth, k1, k2, p1, p2, words, last): keys of each row's node and of its parent."""
    at = F.col("depth")
    turn = [
        F.when(at > 0, F.xxhash64("depth", d).bitwiseAND(F.lit(_MASK))).otherwise(F.lit(0)).alias(e)
        for d, e in (("d1", "e1"), ("d2", "e2"))
    ]
    rows = rebuilt.select("c", "depth", "words", "last", *turn, F.expr(f"depth div {block}").alias("block"))
    so_far = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    for e, k in (("e1", "k1"), ("e2", "k2")):
        rows = rows.withColumn(k, F.sum(e).over(so_far).bitwiseAND(F.lit(_MASK)))
    rows, _ = staging.keep(rows, "blocks")
    full = rows.where((at + 1) % block == 0).select("c", (F.col("block") + 1).alias("block"), "k1", "k2")
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    shift = [
        (F.sum(F.col(k).cast("decimal(38,0)")).over(earlier) % (_MASK + 1)).cast("bigint").alias(f"s{k}") for k in ("k1", "k2")
    ]
    shifts, any_long = staging.keep(full.select("c", "block", *shift), "shifts")
    if any_long:
        rows = rows.join(shifts, ["c", "block"], "left")
        for k in ("k1", "k2"):
            rows = rows.withColumn(k, (F.col(k) + F.coalesce(f"s{k}", F.lit(0))).bitwiseAND(F.lit(_MASK)))
    parent = [(F.col(k) - F.col(e)).bitwiseAND(F.lit(_MASK)).alias(p) for k, e, p in (("k1", "e1", "p1"), ("k2", "e2", "p2"))]
    rows, _ = staging.keep(rows.select("c", *KEY, *parent, "words", "last"), "rows")
    return rows


def ancestors(rows: DataFrame, step: int, height: int) -> DataFrame:
    """(depth, k1, k2, above) of the nodes at depths that ``step`` divides, the root left out.

    ``above`` are the keys of the ancestors at such depths down from the last
    band root above the node; bands are ``step * height`` levels high.
    """
    band = step * height
    own = rows.where(F.col("depth") % step == 0).withColumn("band", F.expr(f"depth div {band}"))
    # a band root is the top of its band and hangs below the band above
    below = own.where((F.col("depth") % band == 0) & (F.col("depth") > 0)).withColumn("band", F.col("band") - 1)
    before = Window.partitionBy("c", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    both = own.union(below).withColumn("above", F.collect_list(F.struct(*KEY)).over(before))
    both = both.where("size(above) > 0")
    return both.groupBy(*KEY).agg(F.first("above").alias("above"))


def band_rollup(values: DataFrame, rows: DataFrame, names: list[str], deepest: int, staging: Staging, height: int = HEIGHT) -> DataFrame:
    """Sums over subtrees: ``values`` has a row (depth, k1, k2, names) for each node, ``rows`` the paths."""

    def sent(senders: DataFrame, lists: DataFrame, keep: Column | None) -> DataFrame:
        to = senders.join(lists, KEY).select(F.explode("above").alias("to"), *names).select("to.*", *names)
        return to if keep is None else to.where(keep)

    def summed(parts: DataFrame, label: str) -> DataFrame:
        out, _ = staging.keep(parts.groupBy(*KEY).agg(*[F.sum(n).cast("bigint").alias(n) for n in names]), label)
        return out

    steps, levels = 1, []
    while True:  # up: sums inside the bands
        lists, _ = staging.keep(ancestors(rows, steps, height), "ancestors")
        band = steps * height
        inner = values.where(F.col("depth") % band != 0)
        inside = summed(values.select(*KEY, *names).union(sent(inner, lists, None)), "inside")
        levels.append((band, lists, inside))
        if deepest < band:
            break
        values, steps = inside.where(F.col("depth") % band == 0), band
    total = levels[-1][2]
    for band, lists, inside in reversed(levels[:-1]):  # down: completed band roots to the bands above them
        roots = total.where(F.col("depth") > 0)
        rest = inside.where(F.col("depth") % band != 0).union(sent(roots, lists, F.col("depth") % band != 0))
        total = total.union(summed(rest, "rest"))
    return total


def digested_lists(ends: DataFrame, staging: Staging, ids_at_once: int = IDS_AT_ONCE) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of the ids of each key, ascending, joined by commas.

    Rows are sorted by range and digested as they stream by.  A list that may
    go on in a neighbouring task is written in pieces, which are then streamed
    through the digest in order: the digest of one list is sequential by
    nature, but no task holds more than a piece of it.
    """
    sorted_rows = ends.select(*KEY, "c").repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c")
    fields = "depth bigint, k1 bigint, k2 bigint, part int, piece int, ids string, ends_sha256 string"
    names = [f.split()[0] for f in fields.split(", ")]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key, held, piece, first = None, [], 0, True
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

        def close(whole: bool) -> tuple:
            text = ",".join(map(str, held))
            if whole and not piece and not first:
                return (*key, part, None, None, hashlib.sha256(text.encode()).hexdigest())
            return (*key, part, piece, text, None)

        for batch in batches:
            *keys, ids = (c.to_pylist() for c in batch.columns)
            for *own, c in zip(*keys, ids, strict=True):
                if own != key:
                    if key is not None:
                        out.append(close(True))
                        first = False
                    key, held, piece = own, [], 0
                elif len(held) >= ids_at_once:
                    out.append(close(False))
                    held, piece = [], piece + 1
                held.append(c)
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
        if key is not None:
            out.append(close(False))
        if out:
            yield batch_of(out)

    kinds = pa.schema([(n, pa.string() if n in ("ids", "ends_sha256") else pa.int32() if n in ("part", "piece") else pa.int64()) for n in names])
    found, _ = staging.keep(sorted_rows.mapInArrow(local, fields), "lists")
    pieces = found.where("ids is not null").select(*names[:-1])
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "part", "piece")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def row_of(key: list[int], digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip([*KEY, "ends_sha256"], [*key, digest.hexdigest()], strict=True))])

        for batch in batches:
            for row in (r for part in sliced(batch) for r in part.to_pylist()):
                own = [row[k] for k in KEY]
                if own == key:
                    digest.update(b"," + row["ids"].encode())
                    continue
                if key is not None:
                    yield row_of(key, digest)
                key, digest = own, hashlib.sha256(row["ids"].encode())
        if key is not None:
            yield row_of(key, digest)

    joined = pieces.mapInArrow(stream, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")
    return found.where("ends_sha256 is not null").select(*KEY, "ends_sha256").union(joined)


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shared: int = 20,
    heads: int = 4,
    height: int = HEIGHT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Conversation ``c`` is rebuilt from the first ``h = crc32(c) % heads`` turns
    of conversation ``c - c % shared`` (remainder as in SQL, with the sign of
    ``c``) and its own turns after its first ``h``; ``heads=1`` rebuilds
    nothing.  Columns, all bigint but the digest: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.

    Null roles and texts are empty; turns go by turn, nulls first, ties by
    content, and repeated rows are turns each.  Rows without a conversation id
    belong to no conversation.  An empty table has no node.
    """
    if heads < 1 or shared < 1 or height < 2:
        raise ValueError("needs heads >= 1, shared >= 1, height >= 2")
    staging = Staging(conversations.sparkSession)
    turns, parts = numbered_turns(turn_rows(conversations, conv_col, turn_col, role_col, text_col), staging)
    rows = keyed_rows(rebuilt_rows(turns, parts, shared, heads, staging), staging, block)

    nodes = rows.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.min("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    )
    nodes, _ = staging.keep(nodes, "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    up = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = up.agg(F.count("*").alias("n_children"))
    one = F.lit(1).cast("bigint")
    known = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    known, _ = staging.keep(known, "known")
    values = known.select(
        *KEY,
        F.when(F.col("n_children") == 0, one).otherwise(one - 1).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = band_rollup(values, rows, ["n_leaves", "saved_tokens"], deepest, staging, height)
    digests = digested_lists(rows.where("last"), staging)
    parents = known.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        known.join(totals, KEY)
        .join(digests, KEY, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
