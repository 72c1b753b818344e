"""Near-duplicate groups by SimHash and pigeonring filtering.

A fingerprint of 64 bits is split into a ring of ``m`` segments.  If two
fingerprints differ in at most ``t`` bits, some segment starts a chain in which,
for every length ``l``, the first ``l`` segments together differ in at most
``l * t / m`` bits: the differences stay within their proportional budget all
along (the plain pigeonhole only says this for ``l = 1``).

The budgets are used twice.  The candidate index takes chains of ``chain``
segments: within its budgets a chain leaves only a few sets of segments that
may differ, and the others must be equal, which makes equi-join keys of several
whole segments instead of one (24 bits in five-segment chains of 8-bit
segments).  Then each candidate must hold the budget at every length from the
start of its chain before its full Hamming distance is taken.

Copies are linked, not enumerated: equal fingerprints become one node first,
and in a bucket of equal keys a search from member to member gives a tree of
its links.  Buckets that a sample shows to be large are dealt into blocks, all
pairs of blocks being searched, so no task needs a whole hot bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.llm.components import connected_components
from relgraph.llm.scan import columns_of, fresh, kept_columns, scan_texts, spaced_words
from relgraph.plans.staging import Staging

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
SEGMENTS = 8
#: Segments in the chain that makes the keys; 7 gives 32-bit keys for some billions of different texts.
CHAIN = 5
#: Buckets expected to be larger than this are dealt into blocks of about this size.
BLOCK = 20_000
SAMPLE = 64
SHINGLES_AT_ONCE = 1 << 16


# ---- fingerprints -----------------------------------------------------------------------------------------------


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the lower-cased (A-Z) words, as a signed 64-bit number; 0 without words."""
    import xxhash

    words = spaced_words((text or b"").lower())
    if not words:
        return 0
    width = min(shingle, len(words))
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    count, total = np.zeros(64, np.int64), len(words) - width + 1
    while part := list(islice(shingles, SHINGLES_AT_ONCE)):
        digests = b"".join([xxhash.xxh64_digest(s, seed) for s in part])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        count += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big", signed=True)


def add_fingerprints(
    docs: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None, shingle: int = SHINGLE
) -> DataFrame:
    """Append ``fingerprint`` (bigint).  Null texts count as empty."""

    def make() -> Callable:
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return scan_texts(docs, "fingerprint bigint", make, text_col, keep)


# ---- chains -----------------------------------------------------------------------------------------------------


def budgets(max_distance: int, segments: int) -> list[int]:
    """Bits that the first 1, 2, ... segments of a viable chain may differ in."""
    return [length * max_distance // segments for length in range(1, segments + 1)]


def equal_segments(max_distance: int, segments: int, chain: int) -> list[tuple[int, ...]]:
    """Positions in a chain that must be equal, for each largest set that may differ."""
    limit = budgets(max_distance, segments)
    return [
        tuple(sorted(set(range(chain)) - set(differ)))
        for differ in combinations(range(chain), limit[chain - 1])
        if all(sum(d < length for d in differ) <= limit[length - 1] for length in range(1, chain + 1))
    ]


def segment_bits(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of each segment."""
    edges = [64 * s // segments for s in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def chain_keys(fp: Column, salt: Column, max_distance: int, segments: int, chain: int) -> list[Column]:
    """One bigint per start and set of equal segments; the salt and the number of the pair are in the key."""
    bits, keys = segment_bits(segments), []
    sets = equal_segments(max_distance, segments, chain)
    for start in range(segments):
        for places in sets:
            key: Column = salt.cast("bigint") * (segments * len(sets)) + len(keys)
            for place in places:
                low, width = bits[(start + place) % segments]
                part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
                key = F.shiftleft(key, width).bitwiseOR(part)
            keys.append(key)
    return keys


def chain_masks(max_distance: int, segments: int, start: int) -> list[tuple[np.uint64, int]]:
    """(bits of the first l segments from a start, their budget) for every l."""
    bits, mask, out = segment_bits(segments), 0, []
    for length, limit in enumerate(budgets(max_distance, segments), 1):
        low, width = bits[(start + length - 1) % segments]
        mask |= ((1 << width) - 1) << low
        out.append((np.uint64(mask), limit))
    return out


def bucket_links(members: np.ndarray, masks: Sequence[tuple[np.uint64, int]], slab: int = 1 << 20) -> list[tuple[int, int]]:
    """A tree of links for each component of a bucket.

    ``members`` are different fingerprints (uint64).  Starts from one, adds all
    unreached ones that hold every budget (the last is the Hamming distance),
    and goes on from those: every pair is either compared or already connected.
    """
    rest, out = members, []
    while len(rest) > 1:
        frontier, rest = rest[:1], rest[1:]
        root = frontier[0]
        while len(frontier) and len(rest):
            count = max(1, min(len(frontier), slab // len(rest)))
            some, frontier = frontier[:count], frontier[count:]
            differ = some[:, None] ^ rest[None, :]
            viable = np.ones(differ.shape, bool)
            for mask, limit in masks:
                at = np.flatnonzero(viable.ravel())
                if not len(at):
                    break
                good = np.bitwise_count(differ.ravel()[at] & mask) <= limit
                viable.ravel()[at[~good]] = False
            hit = viable.any(axis=0)
            reached = rest[hit]
            out += [(int(root), int(r)) for r in reached]
            frontier, rest = np.concatenate([frontier, reached]), rest[~hit]
    return out


def link_fingerprints(
    fingerprints: DataFrame,
    staging: Staging,
    max_distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    chain: int = CHAIN,
    block: int = BLOCK,
) -> DataFrame:
    """(salt, a, b) links that connect exactly what lies within ``max_distance`` of each other.

    ``fingerprints`` has ``fingerprint`` and ``salt`` (0 to 255), of different
    values; only fingerprints of one salt are compared.  All pairs within the
    distance are connected, directly or through others.
    """
    if not 1 <= chain <= segments or max_distance >= segments:
        raise ValueError("needs 1 <= chain <= segments and max_distance < segments")
    masks = [chain_masks(max_distance, segments, start) for start in range(segments)]
    sets = len(equal_segments(max_distance, segments, chain))
    key_bits = max(
        sum(segment_bits(segments)[(s + p) % segments][1] for p in places)
        for s in range(segments)
        for places in equal_segments(max_distance, segments, chain)
    )
    if key_bits + math.log2(256 * segments * sets) > 62 or len({b for _, b in segment_bits(segments)}) > 1:
        raise ValueError("segments must be equal and keys fit 62 bits")

    def keyed(df: DataFrame) -> DataFrame:
        keys = chain_keys(F.col("fingerprint"), F.col("salt"), max_distance, segments, chain)
        return df.select("fingerprint", F.explode(F.array(*keys)).alias("key"))

    keys = keyed(fingerprints)
    # Where to split is an estimate; that all pairs of blocks are searched is not.
    sample = keyed(fingerprints.where(F.pmod(F.xxhash64("fingerprint"), F.lit(SAMPLE)) == 0))
    hot = sample.groupBy("key").agg(F.ceil(F.count("*") * SAMPLE / block).alias("blocks")).where("blocks > 1")
    hot, any_hot = staging.keep(hot, "hot")
    if any_hot:
        own = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("blocks"))
        cells = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
            lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j),
        )
        single = F.array(F.lit(0).cast("bigint"))
        keys = keys.join(hot, "key", "left").select(
            "fingerprint", "key", F.explode(F.when(F.col("blocks").isNull(), single).otherwise(cells)).alias("cell")
        )
    else:
        keys = keys.withColumn("cell", F.lit(0).cast("bigint"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            """Links of the buckets in rows (fingerprint, key, cell), sorted by key and cell."""
            edge = np.flatnonzero((rows[1, 1:] != rows[1, :-1]) | (rows[2, 1:] != rows[2, :-1])) + 1
            begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [rows.shape[1]]])
            found: list[tuple[int, int]] = []
            salts: list[int] = []
            for b in np.flatnonzero(end - begin > 1):
                one = rows[:, begin[b] : end[b]]
                salt, number = divmod(int(one[1, 0]) >> key_bits, segments * sets)
                own = bucket_links(one[0].view(np.uint64), masks[number // sets])
                found += own
                salts += [salt] * len(own)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            columns = [pa.array(salts, pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
            return pa.RecordBatch.from_arrays(columns, names=["salt", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            changes = np.flatnonzero((rows[1, 1:] != rows[1, :-1]) | (rows[2, 1:] != rows[2, :-1])) + 1
            same = held and held[-1][1, -1] == rows[1, 0] and held[-1][2, -1] == rows[2, 0]
            if held and not same:
                yield links(np.concatenate(held, axis=1))
                held = []
            if not len(changes):
                held.append(rows)
                continue
            cut = changes[-1]  # the last bucket may go on in the next batch
            yield links(np.concatenate([*held, rows[:, :cut]], axis=1))
            held = [rows[:, cut:]]
        if held:
            yield links(np.concatenate(held, axis=1))

    dealt = keys.select("fingerprint", "key", "cell").repartition("key", "cell").sortWithinPartitions("key", "cell")
    return dealt.mapInArrow(search, "salt int, a bigint, b bigint")


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    chain: int = CHAIN,
    block: int = BLOCK,
) -> DataFrame:
    """Append ``fingerprint`` and ``component_id``, the smallest id reachable over links.

    Every row is returned, repeated rows and null ids too.  Texts that are
    null, empty or without words have fingerprint 0 and are linked like any
    other.  ``component_id`` is null only if all ids of a component are null.
    """
    carried = kept_columns(docs, ["fingerprint", "component_id"], keep)
    staging = Staging(docs.sparkSession)
    if id_col not in carried:
        raise ValueError("the id column must be among the kept ones")
    marked, _ = staging.keep(add_fingerprints(docs, text_col, carried, shingle), "fingerprints")
    nodes = marked.groupBy("fingerprint").agg(F.min(f"`{id_col}`").alias("__least"))
    nodes, _ = staging.keep(nodes, "nodes")
    links = link_fingerprints(nodes.select("fingerprint", F.lit(0).alias("salt")), staging, max_distance, segments, chain, block)
    roots = connected_components(links, staging)
    linked = nodes.join(roots, F.col("fingerprint") == F.col("node")).select("fingerprint", "root", "__least")
    linked, _ = staging.keep(linked, "linked")
    least = linked.groupBy("root").agg(F.min("__least").alias("__group"))
    linked = linked.join(least, "root").select("fingerprint", "__group")
    named = nodes.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("__group", "__least").alias("component_id")
    )
    return marked.join(named, "fingerprint").select(*[F.col(f"`{c}`") for c in carried], "fingerprint", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---- groups by similarity ---------------------------------------------------------------------------------------

#: Shingles that a sample shows in very many texts come last in the order of the prefixes; at most this many are known.
COMMON_SHINGLES = 200_000
#: Rounds in which the members of a bucket are compared with one of them before all that are still open are compared.
STARS = 2
#: Bits of the parities that bound how much two sets differ before the sets themselves are read.
PARITY_BITS = 2048
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_set(words: list[bytes], shingle: int) -> np.ndarray:
    """The different 64-bit hashes of all word shingles, sorted; a shorter text is one shingle."""
    import xxhash

    width = min(shingle, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    each = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        part = each[i : i + len(total)] * _FACTORS[i % len(_FACTORS)]
        total = (total ^ part ^ (part >> np.uint64(29))) * _FACTORS[(i + 1) % len(_FACTORS)]
    return np.unique(total ^ (total >> np.uint64(32)))


def content_key(words: list[bytes]) -> int:
    """A hash of the words in their order, as a signed 64-bit number."""
    import xxhash

    return xxhash.xxh64_intdigest(b" ".join(words)) - 2**63


def prefix_of(hashes: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in a fixed order, of which two sets of the similarity share at least one.

    Both sets hold ``similarity`` of the larger one, so one of the first
    ``n - ceil(similarity * n) + 1`` must be common whatever the order is; that
    common shingles come last only keeps the buckets small.
    """
    count = len(hashes) - max(1, math.ceil(similarity * len(hashes) - 1e-9)) + 1
    late = np.searchsorted(common, hashes)
    late = common[np.minimum(late, len(common) - 1)] == hashes if len(common) else np.zeros(len(hashes), bool)
    return np.concatenate([hashes[~late], hashes[late]])[:count] if len(hashes) else hashes


def parities(hashes: np.ndarray) -> bytes:
    """For each of PARITY_BITS classes of hashes, whether the set holds an odd number of them.

    Two sets differ in at least as many hashes as their parities do.
    """
    odd = np.bincount((hashes % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) % 2
    return np.packbits(odd.astype(bool)).tobytes()


def may_be_similar(size: Column, pos: Column, size2: Column, pos2: Column, similarity: float) -> Column:
    """Whether the sizes and places of the first common shingle leave room for the similarity."""
    room = F.least(size - pos, size2 - pos2)
    return (F.least(size, size2) >= similarity * F.greatest(size, size2) - 1e-6) & (
        room * (1 + similarity) >= similarity * (size + size2) - 1e-6
    )


def bucket_members(batches: Iterator[pa.RecordBatch], edges: bool = False) -> Iterator[pa.RecordBatch]:
    """Members of the buckets that have more than one in a task, with the first of their bucket there.

    Rows are (h, key, size, pos), sorted by h and key; (center, csize, cpos) are
    added.  Nothing is held but the last row and the first of its bucket.  With
    ``edges`` the first and the last bucket are given whatever they have: their
    other members may be in the tasks before and after.
    """
    names = ["h", "key", "size", "pos", "center", "csize", "cpos"]
    last, center, alone = None, None, False  # the row before, the first of its bucket, whether it is that one itself
    opening = False  # whether the row before is the only one so far

    def batch_of(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        follows = last is not None and last[0] == rows[0, 0]
        if alone and (follows or edges and opening):
            yield batch_of(np.concatenate([last, last[1:]])[:, None])
        starts = np.append(True, rows[0, 1:] != rows[0, :-1])
        first = np.maximum.accumulate(np.where(starts, np.arange(rows.shape[1]), 0))
        centers = rows[1:, first]
        if follows:
            centers[:, first == 0] = center[:, None]
        single = starts & np.append(starts[1:], True)
        single[0] &= not follows and not (edges and last is None)
        # the last row may go on in the next batch: it is held back if it is the only one so far
        alone = bool(starts[-1]) and not (len(starts) == 1 and follows)
        opening = last is None and rows.shape[1] == 1
        last, center = rows[:, -1].copy(), centers[:, -1].copy()
        good = ~single
        good[-1] &= not alone
        yield batch_of(np.concatenate([rows, centers])[:, good])
    if edges and alone:
        yield batch_of(np.concatenate([last, last[1:]])[:, None])


def mark_representatives(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    shingle: int = 5,
    similarity: float = 0.8,
    stars: int = STARS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """Append ``representative``: true for one document of each group of near-duplicates.

    Documents are near-duplicates if their sets of word shingles have at least
    the given Jaccard similarity; groups are what such links connect.
    The first candidates are those of :func:`near_duplicate_groups`: texts whose
    SimHash is the same or, by pigeonring chains, within ``max_distance`` bits.
    Pairs of the similarity can be further apart than that, so what these leave
    apart goes on: candidates share one of the first shingles of a fixed order
    (:func:`prefix_of`), which no pair of the similarity fails to do.  All whose
    :func:`parities` do not rule it out are verified on the full sets of
    shingles.  A bucket of texts with a common shingle is linked by stars
    first: its members are verified against one, and only while they are not
    connected against a next one, in ``stars`` rounds, beginning with the one
    that has fewest rare shingles, and at last whatever is not connected
    against all others.  Only verified links connect, so a group of many copies
    costs a few links each and no pair goes untried unless it is connected
    already.  The smallest id is kept, nulls last; of repeated rows one.  Texts
    without words are copies of each other.

    Texts are not written: they are read again where their sets are needed,
    and rows are known by a hash of id and text.
    """
    carried = kept_columns(docs, ["representative"], keep)
    staging = Staging(docs.sparkSession)
    own = F.xxhash64(f"`{id_col}`", f"`{text_col}`")

    def sets() -> Callable:
        def one(text: bytes | None) -> tuple:
            words = spaced_words((text or b"").lower())
            return content_key(words), shingle_set(words, shingle).view(np.int64)

        return lambda texts: columns_of([one(t) for t in texts], 2)

    sample = docs.where(F.pmod(F.xxhash64(f"`{text_col}`"), F.lit(SAMPLE)) == 0).select(f"`{text_col}`").distinct()

    seen = scan_texts(sample, "key bigint, full array<bigint>", sets, text_col, []).select(F.explode("full").alias("h"))
    # Which shingles are common is an estimate; that all pairs share one of a prefix is not.
    seen = seen.groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(COMMON_SHINGLES)
    common = np.sort(np.array([r["h"] for r in seen.collect()], np.int64).view(np.uint64))

    def make() -> Callable:
        def one(text: bytes | None) -> tuple:
            words = spaced_words((text or b"").lower())
            found = shingle_set(words, shingle)
            prefix = prefix_of(found, common, similarity).view(np.int64)
            return content_key(words), fingerprint(text), len(found), parities(found), prefix

        return lambda texts: columns_of([one(t) for t in texts], 5)

    slim = docs.select(own.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    fields = "key bigint, fingerprint bigint, size bigint, parity binary, prefix array<bigint>"
    numbered = scan_texts(slim, fields, make, "text", ["row", "id"]).withColumn("number", F.monotonically_increasing_id())
    marked, _ = staging.keep(numbered, "marked")
    repeated = marked.groupBy("row").count().where("count > 1").select("row")
    repeated, any_repeated = staging.keep(repeated, "repeated")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "number", "row")
    facts = [F.first(c).alias(c) for c in ("fingerprint", "size", "parity")]
    nodes, _ = staging.keep(marked.groupBy("key").agg(F.min(place).alias("keeper"), *facts), "nodes")
    owners, _ = staging.keep(nodes.groupBy("fingerprint").agg(F.min("key").alias("owner")), "owners")
    alike = link_fingerprints(owners.select("fingerprint", F.lit(0).alias("salt")), staging, max_distance)
    for c in "ab":
        alike = alike.join(owners.select(F.col("fingerprint").alias(c), F.col("owner").alias(f"owner_{c}")), c)
    equal = nodes.join(owners, "fingerprint").where("key <> owner")
    alike = alike.select(F.col("owner_a").alias("a"), F.col("owner_b").alias("b")).union(equal.select("key", "owner"))
    alike, _ = staging.keep(alike.distinct(), "alike")
    prefixes = marked.join(nodes.select(F.col("keeper.number").alias("number")), "number", "left_semi")
    prefixes = prefixes.select("key", "size", F.posexplode("prefix").alias("pos", "h"))
    dealt = prefixes.select("h", "key", "size", F.col("pos").cast("bigint")).repartitionByRange("h", "key").sortWithinPartitions("h", "key")
    fields = ", ".join(f"{n} bigint" for n in ("h", "key", "size", "pos", "center", "csize", "cpos"))
    members, _ = staging.keep(dealt.mapInArrow(partial(bucket_members, edges=True), fields), "members")
    known, _ = staging.keep(marked.select("row").distinct(), "known")
    staging.drop("marked")  # the prefixes are in their buckets now

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        pairs, _ = staging.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{label}-pairs")
        for c in "ab":
            pairs = pairs.join(nodes.select(F.col("key").alias(c), F.struct("size", "parity").alias(f"p{c}")), c)
        pairs = pairs.select("a", "b", (F.col("pa.size") + F.col("pb.size")).alias("sizes"), "pa.parity", F.col("pb.parity").alias("other"))

        def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, PARITY_BITS // 64) for i in (3, 4))
                differ = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
                most = batch.column(2).to_numpy() * (1 - similarity) / (1 + similarity) + 1e-6
                yield batch.select([0, 1]).filter(pa.array(differ <= most))

        pairs, some = staging.keep(pairs.mapInArrow(bounded, "a bigint, b bigint"), f"{label}-bounded")
        if not some:
            return pairs
        ends = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
        rows, _ = staging.keep(nodes.join(ends, "key").select(F.col("keeper.row").alias("row")), f"{label}-rows")
        chosen = docs.select(own.alias("row"), F.col(f"`{text_col}`").alias("text")).join(rows, "row", "left_semi")
        full = scan_texts(chosen, "key bigint, full array<bigint>", sets, "text", [])
        if any_repeated:
            full = full.groupBy("key").agg(F.first("full").alias("full"))
        full, _ = staging.keep(full, f"{label}-sets")
        for c in "ab":
            pairs = pairs.join(full.select(F.col("key").alias(c), F.col("full").alias(f"s{c}")), c)

        both, sizes = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
        good = pairs.where(both >= similarity * (sizes - both) - 1e-9).select("a", "b")
        good, _ = staging.keep(good, f"{label}-links")
        staging.drop(f"{label}-pairs", f"{label}-bounded", f"{label}-rows", f"{label}-sets")
        return good

    def close_enough(size: str, pos: str) -> Column:
        return may_be_similar(F.col("size"), F.col("pos"), F.col(size), F.col(pos), similarity)

    first = members.where((F.col("key") != F.col("center")) & close_enough("csize", "cpos"))
    links = verified(alike.union(first.select("key", "center")), "star0")
    roots = connected_components(links, staging)
    held = members.select("h", "key", "size", "pos")
    for turn in range(1, stars + 2):
        placed = held.join(roots, F.col("key") == F.col("node"), "left").select("h", "key", "size", "pos", F.coalesce("root", "key").alias("root"))
        placed, _ = staging.keep(placed, f"placed{turn}")
        # the one with fewest rare shingles before the common one is alike the most others in the bucket
        place = F.struct("pos", F.xxhash64("key", F.lit(turn)).alias("order"), "key", "size", "root")
        main = placed.groupBy("h").agg(F.min(place).alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        main, any_open = staging.keep(main.select("h", "c"), "open")
        if not any_open:
            break
        # buckets whose members are all connected are done
        held, _ = staging.keep(placed.join(main, "h"), f"held{turn}")
        staging.drop(f"placed{turn}", f"held{turn - 1}", *["members"] * (turn == 1))
        rest, tried = held.where("root <> c.root"), held
        if turn > stars:
            tried = held.drop("c").join(rest.select("h", F.struct("key", "size", "pos", "root").alias("c")), "h")
        elif turn > 1:
            tried = held.drop("c").join(rest.groupBy("h").agg(F.min(place).alias("c")), "h")
        tried = tried.where("root <> c.root").where(close_enough("c.size", "c.pos"))
        links = links.union(verified(tried.select(F.col("key").alias("a"), F.col("c.key").alias("b")), f"star{turn}"))
        roots = connected_components(links, staging)
        held = held.select("h", "key", "size", "pos")
    named = nodes.join(roots, F.col("key") == F.col("node"), "left")
    kept = named.groupBy(F.coalesce("root", "key")).agg(F.min("keeper").alias("keeper")).select(F.col("keeper.row").alias("row"))
    kept, _ = staging.keep(kept, "kept")
    # those that go are fewer than those that stay, so the texts often need no shuffle to meet them
    gone, _ = staging.keep(known.join(kept, "row", "left_anti"), "gone")
    staging.drop("members", *[f"held{turn}" for turn in range(1, stars + 2)])

    row, other, place = (fresh(n, docs) for n in ("__row", "__other", "__place"))
    shown = [F.col(f"`{c}`") for c in carried]
    whole = docs.withColumn(row, own)
    again = repeated.join(kept, "row", "left_semi").select(F.col("row").alias(other))
    once = whole.join(again, F.col(row) == F.col(other), "left_anti") if any_repeated else whole
    flagged = once.join(gone.select(F.col("row").alias(other)), F.col(row) == F.col(other), "left")
    out = flagged.select(*shown, F.col(other).isNull().alias("representative"))
    if any_repeated:  # of equal rows one is kept: they are written with their numbers, which are facts then
        equal = whole.join(again, F.col(row) == F.col(other), "left_semi").withColumn(place, F.monotonically_increasing_id())
        equal, _ = staging.keep(equal, "equal")
        least = equal.groupBy(row).agg(F.min(place).alias(other)).select(other)
        both = equal.join(least, F.col(place) == F.col(other), "left")
        out = out.union(both.select(*shown, F.col(other).isNotNull().alias("representative")))
    return out
