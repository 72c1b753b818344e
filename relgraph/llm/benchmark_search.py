"""Benchmark decontamination by Wu-Manber search over words.

Patterns are windows of benchmark words.  For patterns of ``m`` words and
blocks of ``b`` words a shift table holds, for each block inside a pattern, how
far the window may move until that block could end a pattern; any other block
lets it jump ``m - b + 1`` words.  At shift 0 the block selects the bucket of
patterns with that suffix, and a direct comparison confirms the occurrence.
Items shorter than a window have a table for each length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import hidden, kept_columns, plain_words, scan_texts
from relgraph.plans.staging import Staging

WINDOW = 10
BLOCK = 3
#: Benchmark words whose tables are held by a task at once; a larger benchmark is searched in several passes.
WORDS_PER_PASS = 1_000_000

Words = tuple[bytes, ...]


class PatternTable:
    """Shift table and suffix buckets of patterns with one length."""

    def __init__(self, length: int, block: int):
        self.length, self.block = length, min(block, length)
        self.far = length - self.block + 1
        self.shift: dict[Words, int] = {}
        self.buckets: dict[Words, dict[Words, set[str]]] = defaultdict(dict)

    def add(self, pattern: Words, item: str | None) -> None:
        for end in range(self.block, self.length + 1):
            part = pattern[end - self.block : end]
            self.shift[part] = min(self.shift.get(part, self.far), self.length - end)
        owners = self.buckets[pattern[-self.block :]].setdefault(pattern, set())
        if item is not None:
            owners.add(item)

    def search(self, words: list[bytes], items: set[str]) -> list[list[int]]:
        """Merged [start, end) runs of words inside occurrences; adds the items found."""
        runs: list[list[int]] = []
        size, block, far, shift = self.length, self.block, self.far, self.shift
        end, n = size, len(words)
        while end <= n:
            part = tuple(words[end - block : end])
            move = shift.get(part, far)
            if move:
                end += move
                continue
            owners = self.buckets[part].get(tuple(words[end - size : end]))
            if owners is not None:
                items |= owners
                if runs and runs[-1][1] >= end - size:
                    runs[-1][1] = end
                else:
                    runs.append([end - size, end])
            end += 1
        return runs


def build_tables(items: Sequence[tuple[str | None, bytes]], window: int, block: int) -> list[PatternTable]:
    tables: dict[int, PatternTable] = {}
    for item, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        if size:
            table = tables.setdefault(size, PatternTable(size, block))
            for at in range(len(words) - size + 1):
                table.add(tuple(words[at : at + size]), item)
    return [tables[size] for size in sorted(tables)]


def _pass(docs: DataFrame, items: list[tuple[str | None, bytes]], text_col: str, keep, number: int, window, block):
    fields = (
        f"__runs{number} array<struct<start:bigint,end:bigint>>, __items{number} array<string>"
        + ", n_words bigint" * (number == 0)
    )

    def make() -> Callable:
        tables = build_tables(items, window, block)

        def helper(texts: list[bytes | None]) -> list[list]:
            runs, found, counts = [], [], []
            for text in texts:
                words, own = plain_words(text or b""), set()
                runs.append([{"start": a, "end": b} for t in tables for a, b in t.search(words, own)])
                found.append(sorted(own))
                counts.append(len(words))
            return [runs, found, counts] if number == 0 else [runs, found]

        return helper

    return scan_texts(docs, fields, make, text_col, keep)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
    words_per_pass: int = WORDS_PER_PASS,
) -> DataFrame:
    """Append ``n_words``, ``runs`` (sorted word ranges [start, end) inside
    occurrences, which may overlap) and ``items`` (ids found, as sorted strings).

    Only the benchmark goes to the tasks, ``words_per_pass`` words at a time
    (items are dealt to passes by hash); the documents are not shuffled.  Null
    texts have no words.  A text found only in items with a null id is a hit
    without an item.
    """
    texts = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("t"))
    texts = texts.where(F.col("t").isNotNull()).distinct()
    size = texts.select(F.coalesce(F.sum(F.regexp_count("t", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))), F.lit(0)).alias("n")).first()["n"]
    passes = max(1, -(-size // words_per_pass))
    staging = Staging(docs.sparkSession) if passes > 1 else None
    carried = kept_columns(docs, ["n_words", "runs", "items"], keep)
    names, own, back = hidden(carried)
    out = docs.select(*own, F.col(f"`{text_col}`").alias("__text"))
    for number in range(passes):
        part = texts if passes == 1 else texts.where(F.pmod(F.xxhash64("item", "t"), F.lit(passes)) == number)
        items = [(r["item"], r["t"].encode()) for r in part.collect()]
        last = number == passes - 1
        held = [c for c in out.columns if c.startswith(("__runs", "__items")) or c == "n_words"] if number else []
        columns = [*names, *held, *["__text"] * (not last)]
        out = _pass(out, items, "__text", columns, number, window, block)
        if not last:
            out, _ = staging.keep(out, "benchmark")
    runs = F.array_sort(F.flatten(F.array(*[F.col(f"__runs{i}") for i in range(passes)])))
    found = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"__items{i}") for i in range(passes)]))))
    return out.select(*back, "n_words", runs.alias("runs"), found.alias("items"))


def words_hit(runs: Column | str = "runs") -> Column:
    """Words covered by sorted, possibly overlapping runs."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))

    def add(state: Column, run: Column) -> Column:
        new = run["end"] - F.greatest(run["start"], state["end"])
        return F.struct(
            (state["n"] + F.greatest(new, F.lit(0))).alias("n"), F.greatest(state["end"], run["end"]).alias("end")
        )

    return F.aggregate(runs, start, add, lambda s: s["n"])
