"""Packing by cutting-stock column generation.

Documents are tokenized and cut: whole sequences first, then one remainder.
Lengths are counted in units of ``capacity / CLASSES`` tokens, rounded up, so
the histogram of all pieces has a fixed number of classes however large the
corpus is.  A linear program over patterns (how many pieces of each class share
a sequence) is solved by column generation: the dual prices of the classes make
a knapsack, whose dynamic program finds the pattern worth most; patterns worth
more than one sequence enter the basis until none is left.  Numbers of patterns
are rounded down and what remains is packed best-fit; both are bounded by the
classes, not by the corpus.

A piece longer than half a sequence may be cut there if the program finds that
its parts are cheaper to place, so that many documents of one awkward length
do not leave their sequences half empty.

Pieces are ranked inside their class (partition by partition, the counts of
earlier partitions added), and a rank says by arithmetic which copy of which
pattern the piece goes to.  So no task holds more than one class histogram and
a length shared by a third of all documents is dealt out evenly.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relgraph.llm.scan import hidden, kept_columns, scan_texts
from relgraph.llm.tokens import default_tokenizer
from relgraph.plans.staging import Staging

CAPACITY = 2048
#: Length classes; a piece wastes less than CAPACITY / CLASSES tokens by rounding.
CLASSES = 256
END_ID = 1
#: What cutting a piece in two counts for, in sequences.
CUT_COST = 0.01
#: The master program stops when its bound shows less than this share left to gain.
GAP = 1e-3
#: Against endless degenerate steps; stopping early only costs padding.
MAX_ROUNDS = 5000


# ---- the plan, from the histogram -------------------------------------------------------------------------------


def best_pattern(prices: np.ndarray) -> tuple[float, np.ndarray]:
    """Unbounded knapsack of size ``len(prices)``: item ``c`` has size ``c + 1`` and value ``prices[c]``."""
    size = len(prices)
    worth, choice = np.zeros(size + 1), np.full(size + 1, -1)
    for w in range(1, size + 1):
        values = worth[w - 1 :: -1] + prices[:w]
        best = int(values.argmax())
        if values[best] > worth[w - 1]:
            worth[w], choice[w] = values[best], best
        else:  # leave one unit free
            worth[w] = worth[w - 1]
    counts, w = np.zeros(size), size
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            counts[choice[w]] += 1
            w -= choice[w] + 1
    return float(worth[size]), counts


def column_generation(demand: np.ndarray, gap: float = GAP, cut_cost: float = CUT_COST) -> tuple[np.ndarray, np.ndarray]:
    """Columns and how often to use each, fractional, for the demand per class.

    A column is a pattern, or a cut: it takes a piece longer than half a
    sequence (+1) and asks for its two parts (-1 each), half a sequence and the
    rest, at the price ``cut_cost``.  A cut enters when the dual prices say that
    the parts are cheaper to place than the whole.
    """
    size = len(demand)
    half = size // 2
    long = np.arange(half, size - 1)  # classes that can be cut
    needed = demand > 0
    for c in long[needed[half : size - 1]]:
        needed[[half - 1, c - half]] = True
    used = np.flatnonzero(needed)
    if not len(used):
        return np.zeros((size, 0)), np.zeros(0)
    long = long[demand[half : size - 1] > 0]
    basis = np.zeros((len(used), len(used)))
    np.fill_diagonal(basis, size // (used + 1))
    cost = np.ones(len(used))
    inverse = np.diag(1.0 / np.diag(basis))
    amount = demand[used] / np.diag(basis)
    prices, bound = np.zeros(size), 0.0
    # einsum throughout: threads of a linear algebra library have hung beside a JVM
    for round_ in range(MAX_ROUNDS):
        if round_ % 256 == 255:  # against drift of the updated inverse: one Newton step
            off = 2 * np.eye(len(used)) - np.einsum("ij,jk->ik", basis, inverse)
            inverse = np.einsum("ij,jk->ik", inverse, off)
            amount = np.maximum(np.einsum("ij,j->i", inverse, demand[used]), 0.0)
        prices[used] = np.einsum("i,ij->j", cost, inverse)
        gains = prices[long] - prices[half - 1] - prices[long - half] - cut_cost
        if len(long) and gains.max() > 1e-7:
            c, price = long[gains.argmax()], cut_cost
            column = np.zeros(size)
            column[c] += 1
            column[half - 1] -= 1
            column[c - half] -= 1
        else:
            price = 1.0
            worth, column = best_pattern(prices)
            bound = max(bound, cost @ amount / max(worth, 1.0))  # no packing is cheaper
            if cost @ amount <= max(bound * (1 + gap), bound + 0.5):
                break
        entering = column[used]
        direction = np.einsum("ij,j->i", inverse, entering)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, amount / direction, np.inf)
        leaving = int(ratio.argmin())
        step = ratio[leaving]
        if not np.isfinite(step):
            break
        amount = np.maximum(amount - step * direction, 0.0)
        amount[leaving] = step
        basis[:, leaving], cost[leaving] = entering, price
        row = inverse[leaving] / direction[leaving]
        inverse = inverse - np.outer(direction, row)
        inverse[leaving] = row
    columns = np.zeros((size, len(used)))
    columns[used] = basis
    return columns, amount


def best_fit(rest: np.ndarray) -> list[np.ndarray]:
    """Patterns for the pieces that rounding leaves over, longest first into the fullest sequence."""
    size = len(rest)
    patterns: list[np.ndarray] = []
    free: list[list[int]] = [[] for _ in range(size + 1)]
    for c in range(size - 1, -1, -1):
        for _ in range(int(rest[c])):
            room = next((r for r in range(c + 1, size + 1) if free[r]), None)
            if room is None:
                patterns.append(np.zeros(size))
                at, room = len(patterns) - 1, size
            else:
                at = free[room].pop()
            patterns[at][c] += 1
            free[room - c - 1].append(at)
    return patterns


@dataclass(frozen=True)
class Plan:
    """Which sequence the k-th piece of a class goes to.

    The first ``cuts[c]`` pieces of class ``c`` are cut in two; the parts are
    ranked behind the other pieces of their classes.  ``starts[c]`` are the
    ranks at which a class moves on to its next pattern; of each there are
    ``per[c]`` pieces in one sequence, the first of them in slot ``slot[c]`` of
    sequence ``base[c]``.
    """

    cuts: np.ndarray
    heads: np.ndarray  # rank, among the half sequences, of the first part cut from a class
    tails: np.ndarray  # rank, in its class, of the first rest cut from a class
    starts: list[np.ndarray]
    per: list[np.ndarray]
    slot: list[np.ndarray]
    base: list[np.ndarray]
    sequences: int

    def place(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, slot) of pieces by class and rank after the cuts."""
        sequence, slot = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for c in np.unique(classes):
            rows = np.flatnonzero(classes == c)
            at = np.searchsorted(self.starts[c], ranks[rows], side="right") - 1
            inside = ranks[rows] - self.starts[c][at]
            sequence[rows] = self.base[c][at] + inside // self.per[c][at]
            slot[rows] = self.slot[c][at] + inside % self.per[c][at]
        return sequence, slot

    def cut(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, part, class, rank) after the cuts; part 0 is a whole piece, 1 a head, 2 a rest."""
        half = len(self.cuts) // 2
        is_cut = ranks < self.cuts[classes]
        whole, cut = np.flatnonzero(~is_cut), np.flatnonzero(is_cut)
        c, r = classes[cut], ranks[cut]
        return (
            np.concatenate([whole, cut, cut]),
            np.repeat([0, 1, 2], [len(whole), len(cut), len(cut)]),
            np.concatenate([classes[whole], np.full(len(cut), half - 1), c - half]).astype(np.int64),
            np.concatenate([ranks[whole] - self.cuts[classes[whole]], self.heads[c] + r, self.tails[c] + r]),
        )


def plan_sequences(histogram: dict[int, int], classes: int = CLASSES, gap: float = GAP) -> Plan:
    """The packing plan for a number of pieces per class (0 to classes - 1)."""
    half = classes // 2
    original = np.zeros(classes, np.int64)
    for c, n in histogram.items():
        original[c] = n
    columns, amount = column_generation(original.astype(float), gap)
    counts = np.rint(columns).astype(np.int64)
    whole = np.floor(amount + 1e-6).astype(np.int64)
    is_cut = (counts < 0).any(axis=0)
    cuts = np.zeros(classes, np.int64)
    for p in np.flatnonzero(is_cut):
        c = int(np.flatnonzero(counts[half:, p] > 0)[-1]) + half
        cuts[c] = min(whole[p], original[c])
    heads = original[half - 1] + np.concatenate([[0], np.cumsum(cuts)[:-1]])
    demand, tails = original - cuts, np.zeros(classes, np.int64)
    for c in np.flatnonzero(cuts):
        tails[c] = original[c - half]
        demand[half - 1] += cuts[c]
        demand[c - half] += cuts[c]
    counts, whole = counts[:, ~is_cut], whole[~is_cut]
    for p in range(len(whole)):  # rounding must not ask for more than there is
        while whole[p] > 0 and (over := (counts @ whole > demand) & (counts[:, p] > 0)).any():
            excess = ((counts @ whole - demand)[over] / counts[over, p]).max()
            whole[p] = max(0, whole[p] - max(1, int(np.ceil(excess))))
    rest = demand - counts @ whole
    chosen = [(counts[:, p], int(whole[p])) for p in range(len(whole)) if whole[p] > 0]
    chosen += [(p.astype(np.int64), 1) for p in best_fit(rest)]
    entries: list[list[tuple[int, int, int, int]]] = [[] for _ in range(classes)]
    taken, base = np.zeros(classes, np.int64), 0
    for pattern, copies in chosen:
        slot = 0
        for c in np.flatnonzero(pattern)[::-1]:
            n = int(pattern[c])
            entries[c].append((int(taken[c]), n, slot, base))
            taken[c] += n * copies
            slot += n
        base += copies
    if (taken != demand).any():
        raise AssertionError("the plan does not hold every piece once")
    parts = [[np.array(x, np.int64) for x in zip(*e, strict=True)] if e else [np.zeros(0, np.int64)] * 4 for e in entries]
    return Plan(cuts, heads, tails, *[[c[k] for c in parts] for k in range(4)], base)


# ---- tokens and pieces ------------------------------------------------------------------------------------------


def cut_documents(
    docs: DataFrame,
    text_col: str,
    keep: Sequence[str] | None,
    tokenizer: Callable,
    capacity: int,
    classes: int,
    end_id: int,
    keep_ids: bool,
) -> DataFrame:
    """One row per piece, with its class and its rank among the pieces of its class in its partition."""
    fields = (
        "doc_tokens bigint, __part int, "
        "__pieces array<struct<start:bigint,length:bigint,ids_crc32:bigint,class:int,rank:bigint"
        + ",head_crc32:bigint,rest_crc32:bigint"
        + ",ids:binary" * keep_ids
        + ">>"
    )
    unit, half = capacity // classes, capacity // 2

    def make() -> Callable:
        from pyspark import TaskContext

        encode = tokenizer()
        part = TaskContext.get().partitionId()
        ranks = [0] * classes

        def pieces(text: bytes | None) -> tuple[int, list[dict]]:
            ids = encode(text.decode("utf-8", "replace")) if text else np.zeros(0, np.uint32)
            data = np.append(ids, end_id).astype("<u4").tobytes()
            total = len(data) // 4
            out = []
            for start in range(0, total, capacity):
                piece = data[4 * start : 4 * (start + capacity)]
                length = len(piece) // 4
                c = -(-length // unit) - 1
                row = {"start": start, "length": length, "ids_crc32": zlib.crc32(piece), "class": c, "rank": ranks[c]}
                if half < length < capacity:  # the plan may cut it at half a sequence
                    row |= {"head_crc32": zlib.crc32(piece[: 4 * half]), "rest_crc32": zlib.crc32(piece[4 * half :])}
                out.append(row | {"ids": piece} if keep_ids else row)
                ranks[c] += 1
            return total, out

        def helper(texts: list[bytes | None]) -> list[list]:
            rows = [pieces(t) for t in texts]
            return [[r[0] for r in rows], [part] * len(rows), [r[1] for r in rows]]

        return helper

    found = scan_texts(docs, fields, make, text_col, keep)
    carried = [c for c in found.columns if c != "__pieces"]
    return found.select(*[F.col(f"`{c}`") for c in carried], F.explode("__pieces").alias("__piece")).select(
        *[F.col(f"`{c}`") for c in carried],
        "__piece.start",
        "__piece.length",
        "__piece.ids_crc32",
        *["__piece.ids"] * keep_ids,
        F.col("__piece.head_crc32").alias("__head"),
        F.col("__piece.rest_crc32").alias("__rest"),
        F.col("__piece.class").alias("__class"),
        F.col("__piece.rank").alias("__rank"),
    )


def pack_documents(
    docs: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    tokenizer: Callable | None = None,
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack all documents; one row per piece.

    Columns: the carried ones, ``doc_tokens`` (with the end id), ``start``,
    ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and on request
    ``ids`` (little-endian 32-bit).  A null or empty text is the end id alone.
    ``capacity`` must be a multiple of ``classes``.  Pieces are written once,
    without texts (unless ``keep`` names them: a long one would be in each of
    its many pieces) or, unless asked for, ids.
    """
    if capacity % classes:
        raise ValueError("capacity must be a multiple of classes")
    new = ("doc_tokens", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    carried = kept_columns(docs, new, keep)
    staging = Staging(docs.sparkSession)
    names, own, back = hidden(carried)
    inner = docs.select(*own, F.col(f"`{text_col}`").alias("__text"))
    cut = cut_documents(inner, "__text", names, tokenizer or default_tokenizer(), capacity, classes, end_id, keep_ids)
    pieces, _ = staging.keep(cut, "pieces")
    counts = pieces.groupBy("__class", "__part").agg(F.count("*").alias("n"))
    counts, _ = staging.keep(counts, "counts")
    before = Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__class", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    histogram = {r["__class"]: r["n"] for r in counts.groupBy("__class").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(histogram, classes)

    payload = [*names, "doc_tokens", *["ids"] * keep_ids]
    ranked = pieces.join(offsets, ["__class", "__part"]).select(
        *[F.col(f"`{c}`") for c in payload],
        "start", "length", "ids_crc32", "__head", "__rest",
        F.col("__class").cast("bigint"), (F.col("__rank") + F.col("__before")).alias("__rank"),
    )
    half = capacity // 2

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(payload)
            start, length, whole, head, rest, classes, ranks = (
                c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns[k:]
            )
            row, part, classes, ranks = plan.cut(classes, ranks)
            sequence, slot = plan.place(classes, ranks)
            held = [c.take(pa.array(row)) for c in batch.columns[:k]]
            if keep_ids:
                held[-1] = pa.array(
                    [
                        i[: 4 * half] if p == 1 else i[4 * half :] if p == 2 else i
                        for i, p in zip(held[-1].to_pylist(), part.tolist(), strict=True)
                    ],
                    pa.binary(),
                )
            numbers = [
                start[row] + half * (part == 2),
                np.choose(part, [length[row], np.full(len(row), half), length[row] - half]),
                np.choose(part, [whole[row], head[row], rest[row]]),
                sequence,
                slot,
            ]
            yield pa.RecordBatch.from_arrays([*held, *map(pa.array, numbers)], names=out.names)

    out = ranked.select(*[F.col(f"`{c}`") for c in payload], "start", "length", "ids_crc32").schema
    out = out.add("sequence_id", "long").add("__slot", "long")
    placed = ranked.mapInArrow(assign, out)
    ahead = Window.partitionBy("sequence_id").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
    return placed.select(*back, *[c for c in placed.columns if c not in (*names, "__slot")])


def sequences_of(pieces: DataFrame) -> DataFrame:
    """The token sequences of :func:`pack_documents` with ``keep_ids``: (sequence_id, length, ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
    )
