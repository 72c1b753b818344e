"""Importance resampling of documents toward a target collection.

Features of a text are its word n-grams, hashed to buckets.  Separators are
collapsed to single blanks first; then one pattern a length, scanned with
overlaps, gives the span of every n-gram at once: a boundary behind, the words,
a boundary ahead.  CRC-32 of the spans counts them.

The texts are read once: each row's buckets are written, two bytes a feature,
and counting, weighing and drawing go on from there.  What is gathered are the
counts of a fixed number of buckets and the histogram of whole-number scores;
only the rows at or above the drawing limit are sorted, by range, so a drawn
tenth of a very large table is ranked without one task that holds it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import _PLAIN, hidden, kept_columns, scan_texts
from relgraph.plans.staging import Staging

BUCKETS, SHORTEST, LONGEST = 10_000, 1, 1
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
_BLANKS = regex.compile(rb" +")
_ROW_BITS = 33


def ngram_pattern(n: int) -> regex.Pattern:
    """Spans of ``n`` words in bytes whose words stand between single blanks, the first and last byte being blanks."""
    return regex.compile(rb"(?<= )[^ ]+" + rb"(?: [^ ]+){%d}" % (n - 1) * (n > 1) + rb"(?= )")


def collapsed(text: bytes) -> bytes:
    """Lower-cased (A-Z) words between single blanks, a blank at both ends."""
    return _BLANKS.sub(b" ", b" " + text.translate(_PLAIN) + b" ")


def bucket_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def feature_buckets(words: bytes, patterns: Sequence[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every n-gram of :func:`collapsed` words, repeats included."""
    crc = zlib.crc32
    hashes = [crc(m[0]) for pattern in patterns for m in pattern.finditer(words, overlapped=True)]
    return (np.array(hashes, np.int64) % buckets).astype(bucket_type(buckets))


def add_features(
    docs: DataFrame, text_col: str, keep: Sequence[str] | None, shortest: int, longest: int, buckets: int
) -> DataFrame:
    """Append ``__words`` and ``n_features`` (bigint) and ``__buckets`` (binary)."""

    def make() -> Callable:
        patterns = [ngram_pattern(n) for n in range(shortest, longest + 1)]

        def helper(texts: list[bytes | None]) -> list[list]:
            words = [collapsed(t or b"") for t in texts]
            found = [feature_buckets(w, patterns, buckets) for w in words]
            return [[max(0, w.count(b" ") - 1) for w in words], [len(f) for f in found], [f.tobytes() for f in found]]

        return helper

    return scan_texts(docs, "__words bigint, n_features bigint, __buckets binary", make, text_col, keep)


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows of :func:`add_features`; one row a bucket comes to the driver."""
    kind = bucket_type(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(data, kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    parts = features.select("__buckets").mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, every bucket counted once more."""
    buckets = len(source)
    all_source, all_target = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def noise(row_id: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel variable) that depends on seed and id only; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    keep: Sequence[str] | None = None,
    shortest: int = SHORTEST,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Append ``n_features``, ``weight``, ``score`` and ``rank``.

    ``weight`` is the floored mean of the gains of a text's features (0 without
    any), ``score`` the weight with Gumbel noise of the id.  Of the N texts of
    at least ``min_words`` words the ``N * percent / 100`` (rounded down) with
    the highest scores are drawn; ``rank`` counts them from 1, ties go to the
    smaller id, nulls last, and of rows alike in both to any.  It is null for
    all others.  Every row gives one row; null texts have no words.  Carried
    columns are written with the features, so keep what is needed only.
    """
    if not 1 <= shortest <= longest:
        raise ValueError("needs 1 <= shortest <= longest")
    carried = kept_columns(docs, ["n_features", "weight", "score", "rank"], keep)
    if id_col not in carried:
        raise ValueError("the id column must be among the kept ones")
    staging = Staging(docs.sparkSession)
    names, own, back = hidden(carried)
    row_id = F.col(names[carried.index(id_col)])
    inner = docs.select(*own, F.col(f"`{text_col}`").alias("__text"))
    features, _ = staging.keep(add_features(inner, "__text", names, shortest, longest, buckets), "features")
    wanted = add_features(target, target_text_col, [], shortest, longest, buckets)
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    kind = bucket_type(buckets)
    at = len(carried)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gains[np.frombuffer(b, kind)].sum()) for b in batch.column(at + 2).to_pylist()]
            sizes = batch.column(at + 1).to_pylist()
            weights = [s // n if n else 0 for s, n in zip(sums, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: at + 2], pa.array(weights, pa.int64())], names=weighed.names)

    kept = features.select(*names, "__words", "n_features", "__buckets")
    weighed = kept.drop("__buckets").schema.add("weight", "long")
    scored = kept.mapInArrow(weigh, weighed).withColumn("score", F.col("weight") + noise(row_id, seed))
    scored, _ = staging.keep(scored, "scored")

    # whole-number scores: some ten thousand different ones however many rows there are
    able = F.col("__words") >= min_words
    histogram = scored.where(able).groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    drawn = sum(r["n"] for r in histogram) * percent // 100
    limit, above = None, 0
    for row in histogram:
        if above >= drawn:
            break
        limit, above = row["score"], above + row["n"]
    near = (able & (F.col("score") >= limit)) if limit is not None else F.lit(False)
    result = [*names, "n_features", "weight", "score"]
    order = [F.desc("score"), row_id.asc_nulls_last(), F.col("__tie")]
    high = scored.where(near).withColumn("__tie", F.monotonically_increasing_id())
    high = high.repartitionByRange(*order).sortWithinPartitions(*order).select(*result)
    high, _ = staging.keep(high.withColumn("__at", F.monotonically_increasing_id()), "high")
    part = F.shiftright("__at", _ROW_BITS)
    row_number = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    starts = high.groupBy(part.alias("__part")).agg((F.max(row_number) + 1).alias("__size")).selectExpr(
        "__part", "coalesce(sum(__size) over (order by __part rows between unbounded preceding and 1 preceding), 0) as __start"
    )
    starts, _ = staging.keep(starts, "starts")  # one row a partition
    rank = F.col("__start") + row_number + 1
    ranked = high.withColumn("__part", part).join(starts, "__part").select(
        *result, F.when(rank <= drawn, rank).cast("bigint").alias("rank")
    )
    both = ranked.union(scored.where(~near).select(*result, F.lit(None).cast("bigint").alias("rank")))
    return both.select(*back, "n_features", "weight", "score", "rank")
