"""Quality classifier: text evidence and hierarchical empirical Bayes over sites.

1. Features of labelled documents (words, word beginnings, bands of shape) are
   counted by Spark for the two ways of being bad, low quality and toxic.  The
   evidence of a feature is the log odds ratio at the lower end of a confidence
   interval, so that what was seen in few documents says little; near copies
   count as one document.  A document's evidence per way is the sum of its few
   strongest features, so a long text does not dilute what it contains.
2. A logistic curve, fitted on documents whose features were counted in the
   other half of the sample, turns evidence into a probability.
3. Rates of hosts and paths come from the probabilities of all documents by
   grouped aggregation.  Each rate is a Beta posterior: a path shrinks toward
   its host and a host toward the whole, by prior weights estimated from the
   spread of the rates (method of moments).  A document is left out of its own
   rates.
4. The log odds of text and path add up to the verdict.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import hidden, kept_columns, plain_words, scan_texts, sliced
from relgraph.plans.staging import Staging

#: Labelled documents learned from, good and bad each (in expectation); bounds the broadcast below too.
SAMPLE_EACH = 15_000
#: Bad documents that a feature must occur in, and standard deviations of the interval whose lower end counts.
SUPPORT, CAUTION = 4, 2.5
#: Weakest log odds that are kept, most features of a model, and features that make a document's evidence.
LEAST_EVIDENCE, MAX_FEATURES, STRONGEST = 1.0, 100_000, 4
BEGINNING = 5
#: Documents with a larger probability of being bad are rejected.
THRESHOLD = 0.5
LEAST_RATE = 1e-4


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=1)


def document_features(text: bytes | None) -> set[bytes]:
    """Words, beginnings of longer words (marked ~) and shape bands (marked #)."""
    text = text or b""
    words = plain_words(text)
    found = set(words)
    found |= {w[:BEGINNING] + b"~" for w in found if len(w) > BEGINNING}
    if not text:
        return found | {b"#empty"}
    size = len(text)
    letters = len(text.translate(None, bytes(range(65))))
    upper = size - len(text.translate(None, bytes(range(65, 91))))
    symbols = size - len(text.translate(None, b"#*$%&|<>!"))
    lines = [line for line in text.split(b"\n") if line.strip()]
    ratio = len(_compressor().compress(text)) / size
    length = min(20, len(words).bit_length())
    shape = {
        "symbols": min(9, math.ceil(40 * symbols / size)),
        "bars": min(9, math.ceil(40 * text.count(b"|") / size)),
        "upper": min(9, 10 * upper // max(1, letters)),
        "ratio": f"{length // 3}-{min(20, int(20 * ratio))}",
        "length": length,
        "same lines": min(9, 10 * (len(lines) - len(set(lines))) // max(1, len(lines))),
    }
    return found | {f"#{name} {band}".encode() for name, band in shape.items()}


@dataclass
class QualityModel:
    """Log odds of features for (low quality, toxic), and the curve over both kinds of evidence."""

    rate: float
    evidence: dict[bytes, tuple[float, float]] = field(default_factory=dict)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def scores(self, features: set[bytes]) -> tuple[float, float]:
        hits = [self.evidence[f] for f in features & self.evidence.keys()]
        return tuple(sum(heapq.nlargest(STRONGEST, (h[k] for h in hits if h[k] > 0))) for k in (0, 1))

    def log_odds(self, low: float, toxic: float) -> float:
        a, b, c = self.curve
        return max(-20.0, min(20.0, a * low + b * toxic + c))


def clean_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per id: (id, low, toxic, bad); several labels of an id count as their worst, rows without any label do not."""
    known = labels.where(f"`{id_col}` is not null and (quality is not null or toxic is not null)")
    one = known.groupBy(F.col(f"`{id_col}`").alias("__id")).agg(
        F.max(F.coalesce(F.col("quality") == 0, F.lit(False))).alias("__low"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("__toxic"),
    )
    return one.withColumn("__bad", F.col("__low") | F.col("__toxic"))


def shrunk_log_odds(bad: Column, total: Column, rate: float) -> Column:
    """Log odds ratio at the lower end of the Wilson interval of the feature's rate, but at most what the rate itself says."""
    z2 = CAUTION * CAUTION
    p = bad / total
    low = (p + z2 / (2 * total) - CAUTION * F.sqrt(p * (1 - p) / total + z2 / (4 * total * total))) / (1 + z2 / total)
    low = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), low))
    ratio = F.log(low / (1 - low)) - math.log(rate / (1 - rate))
    return F.when(total > 0, F.round(ratio, 6)).otherwise(0.0)  # sums may differ in their last digits


def copy_key(text: bytes | None) -> int:
    """Smallest hash of the 3-word shingles: mostly equal for copies, so that these can count as one document."""
    words = plain_words(text or b"")
    return min((zlib.crc32(b" ".join(s)) for s in zip(words, words[1:], words[2:], strict=False)), default=-len(words))


def fit_curve(points: Sequence[tuple[float, float, bool, float]]) -> tuple[float, float, float]:
    """Weighted logistic regression of bad on (low, toxic) evidence, slopes not below zero."""
    if not points:
        return 0.0, 0.0, 0.0
    x = np.array([(a, b, 1.0) for a, b, _, _ in points])
    y = np.array([float(p[2]) for p in points])
    w = np.array([p[3] for p in points])
    theta = np.array([0.5, 0.5, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip((x * theta).sum(axis=1), -30, 30)))
        pull = np.array([1e-3, 1e-3, 0.0]) * w.sum() / len(w)
        slope = (x * (w * (y - p))[:, None]).sum(axis=0) - pull * theta
        bend = np.einsum("n,ni,nj->ij", w * p * (1 - p), x, x) + np.diag(pull + 1e-6)
        step = np.linalg.solve(bend, slope)
        theta = theta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.0, float(theta[0])), max(0.0, float(theta[1])), float(theta[2])


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    staging: Staging,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_each: int = SAMPLE_EACH,
) -> QualityModel:
    """Fit the text model on a bounded sample of labelled documents.

    Without labels of both kinds there is no evidence, and every document has
    the common rate.
    """
    known = clean_labels(labels, id_col)
    sums = known.agg(
        F.count("*"), *[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)) for c in ("__bad", "__low", "__toxic")]
    ).first()
    total, bad, low, toxic = map(int, sums)
    rate = min(1 - LEAST_RATE, max(LEAST_RATE, bad / total if total else 0.0))
    if not 0 < bad < total:
        return QualityModel(rate, curve=(0.0, 0.0, math.log(rate / (1 - rate))))
    share = {True: min(1.0, sample_each / bad), False: min(1.0, sample_each / (total - bad))}
    million = 1_000_000
    limit = F.when(F.col("__bad"), int(share[True] * million) + 1).otherwise(int(share[False] * million) + 1)
    sample = known.where(F.pmod(F.xxhash64("__id"), F.lit(million)) < limit).select(
        "*",
        F.when(F.col("__bad"), 1 / share[True]).otherwise(1 / share[False]).alias("__weight"),
    )
    # about 2 * sample_each rows of some numbers: a bounded broadcast keeps the texts where they are
    texts = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    chosen = texts.join(F.broadcast(sample), "__id").select("__text", "__low", "__toxic", "__bad", "__weight")
    keyed = scan_texts(chosen, "__copy bigint", lambda: lambda ts: [[copy_key(t) for t in ts]], "__text")
    keyed = keyed.withColumn("__half", F.pmod(F.xxhash64("__copy", F.lit("half")), F.lit(2)).cast("int"))
    one = F.min_by(F.struct("__text", "__bad", "__weight", "__half"), F.xxhash64("__text"))  # the same in every run
    single = keyed.groupBy("__copy", "__low", "__toxic").agg(one.alias("r"))
    single = single.select("r.__text", "__low", "__toxic", "r.__bad", "r.__weight", "r.__half")
    chosen, _ = staging.keep(single, "labelled")
    names = [f"{kind}{half}" for half in (0, 1) for kind in ("n", "low", "toxic")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[float]] = defaultdict(lambda: [0.0] * 6)

        def out() -> pa.RecordBatch:
            columns = list(zip(*held.values(), strict=True)) if held else [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), *[pa.array(c, pa.float64()) for c in columns]], names=["feature", *names]
            )

        for whole in batches:
            for batch in sliced(whole):
                rows = zip(*[c.to_pylist() for c in [batch.column(0).cast(pa.binary()), *batch.columns[1:]]], strict=True)
                for text, is_low, is_toxic, _, weight, half in rows:
                    for f in document_features(text):
                        counts = held[f]
                        counts[3 * half] += weight
                        counts[3 * half + 1] += weight * is_low
                        counts[3 * half + 2] += weight * is_toxic
                if len(held) > 300_000:
                    yield out()
                    held.clear()
        yield out()

    schema = "feature binary, " + ", ".join(f"{n} double" for n in names)
    counts = chosen.mapInArrow(count, schema).groupBy("feature").agg(*[F.sum(n).alias(n) for n in names])
    rates = {"low": min(0.5, max(LEAST_RATE, low / total)), "toxic": min(0.5, max(LEAST_RATE, toxic / total))}
    n, parts = F.col("n0") + F.col("n1"), {k: F.col(f"{k}0") + F.col(f"{k}1") for k in rates}
    logs = {k: shrunk_log_odds(parts[k], n, rates[k]) for k in rates}
    halves = {f"{k}_{h}": shrunk_log_odds(F.col(f"{k}{h}"), F.col(f"n{h}"), rates[k]) for k in rates for h in (0, 1)}
    strong = counts.where(F.greatest(*parts.values()) * share[True] >= SUPPORT).select(
        "feature", *[c.alias(k) for k, c in {**logs, **halves}.items()]
    )
    strong = strong.where(F.greatest("low", "toxic") >= LEAST_EVIDENCE)
    rows = strong.orderBy(F.greatest("low", "toxic").desc(), "feature").limit(MAX_FEATURES).collect()
    other = [QualityModel(rate, {bytes(r["feature"]): (r[f"low_{1 - h}"], r[f"toxic_{1 - h}"]) for r in rows}) for h in (0, 1)]

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole):
                rows = zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(5).to_pylist(), strict=True)
                scores = [other[half].scores(document_features(text)) for text, half in rows]
                columns = [pa.array([s[k] for s in scores], pa.float64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(3), batch.column(4)], names=["a", "b", "bad", "w"])

    fitted = chosen.mapInArrow(points, "a double, b double, bad boolean, w double").collect()
    curve = fit_curve(sorted((r["a"], r["b"], r["bad"], r["w"]) for r in fitted))
    return QualityModel(rate, {bytes(r["feature"]): (r["low"], r["toxic"]) for r in rows}, curve)


def text_evidence(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``text_log_odds``, the log odds of being bad by the text alone."""

    def make() -> Callable:
        return lambda texts: [[model.log_odds(*model.scores(document_features(t))) for t in texts]]

    return scan_texts(docs, "text_log_odds double", make, text_col, keep)


def prior_weight(groups: DataFrame, n: str, bad: str, mean: Column | float) -> float:
    """Pseudo-count of the Beta prior of the groups' rates around ``mean``, by the method of moments.

    The spread of observed rates minus what sampling alone explains is the
    spread of true rates.  No spread gives a strong prior.
    """
    mean = F.lit(mean) if isinstance(mean, float) else mean
    size, p = F.col(n), F.col(bad) / F.col(n)
    row = groups.where(size > 0).agg(
        F.count("*").alias("k"),
        F.sum(size).alias("n"),
        F.sum(size * size).alias("nn"),
        F.sum(size * (p - mean) ** 2).alias("spread"),
        F.sum(size * mean * (1 - mean)).alias("v"),
    ).first()
    if not row["k"] or row["k"] < 2 or not row["v"]:
        return 1e4
    v = row["v"] / row["n"]
    between = (row["spread"] - (row["k"] - 1) * v) / max(1e-9, row["n"] - row["nn"] / row["n"])
    return float(min(1e4, max(1.0, v / max(between, 1e-9) - 1)))


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: str | Column = "source",
    path: str | Column = "lang",
    keep: Sequence[str] | None = None,
    threshold: float = THRESHOLD,
    sample_each: int = SAMPLE_EACH,
) -> DataFrame:
    """Append ``text_log_odds``, ``host_rate``, ``path_rate``, ``p_bad`` and ``rejected``.

    ``host`` and ``path`` are the two levels of a site, columns or expressions;
    null is a site of its own.  ``labels`` has (id, quality 0/1, toxic 0/1) and
    only serves to fit the text model.  A null text counts as an empty one.
    Sites are aggregated before they are shuffled, and a rate reaches its
    documents by a join on the site, whose document side Spark may split.
    """
    carried = kept_columns(docs, ["text_log_odds", "host_rate", "path_rate", "p_bad", "rejected"], keep)
    staging = Staging(docs.sparkSession)
    model = learn_quality(docs, labels, staging, id_col, text_col, sample_each)
    names, given, back = hidden(carried)
    levels = {"__host": host, "__path": path, "__text": text_col}
    sites = docs.select(*given, *[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in levels.items()])
    marked = text_evidence(sites, model, "__text", [*names, "__host", "__path"])
    marked, _ = staging.keep(marked, "evidence")

    p_text = 1 / (1 + F.exp(-F.col("text_log_odds")))
    own = marked.select("__host", "__path", p_text.alias("__own"))
    paths = own.groupBy("__host", "__path").agg(F.count("*").alias("__n"), F.sum("__own").alias("__bad"))
    paths, _ = staging.keep(paths, "paths")
    hosts = paths.groupBy("__host").agg(F.sum("__n").alias("__hn"), F.sum("__bad").alias("__hbad"))
    hosts, _ = staging.keep(hosts, "hosts")
    overall = hosts.agg(F.sum("__hbad") / F.sum("__hn")).first()[0]
    mean = min(1 - LEAST_RATE, max(LEAST_RATE, overall or 0.0))
    k_host = prior_weight(hosts, "__hn", "__hbad", mean)
    both = paths.join(hosts.withColumnRenamed("__host", "__h"), F.col("__host").eqNullSafe(F.col("__h"))).drop("__h")
    host_rate = (F.col("__hbad") + k_host * mean) / (F.col("__hn") + k_host)
    k_path = prior_weight(both, "__n", "__bad", host_rate)

    # written, so that its size is known: texts are only shuffled if there are very many sites
    both, _ = staging.keep(both.withColumnsRenamed({"__host": "__h", "__path": "__p"}), "sites")
    joined = marked.join(
        both, F.col("__host").eqNullSafe(F.col("__h")) & F.col("__path").eqNullSafe(F.col("__p"))
    )
    without = F.least(F.col("__n") - 1, F.greatest(F.lit(0.0), F.col("__bad") - p_text))
    host_without = F.least(F.col("__hn") - 1, F.greatest(F.lit(0.0), F.col("__hbad") - p_text))
    host_rate = (host_without + k_host * mean) / (F.col("__hn") - 1 + k_host)
    out = joined.withColumn("host_rate", host_rate)
    out = out.withColumn("path_rate", (without + k_path * F.col("host_rate")) / (F.col("__n") - 1 + k_path))
    rate = F.greatest(F.lit(LEAST_RATE), F.least(F.lit(1 - LEAST_RATE), F.col("path_rate")))
    odds = F.col("text_log_odds") + F.log(rate / (1 - rate)) - math.log(mean / (1 - mean))
    out = out.withColumn("p_bad", 1 / (1 + F.exp(-odds))).withColumn("rejected", F.col("p_bad") > threshold)
    return out.select(*back, "text_log_odds", "host_rate", "path_rate", "p_bad", "rejected")
