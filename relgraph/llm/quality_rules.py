"""Quality rules: base counts of a text and bands of its compression ratio.

A text compresses well if it repeats itself and hardly at all if it is noise.
Both the whole text and each fixed chunk of it are compressed with zstandard;
compressed size / size must lie inside a band that depends on the length, as
short inputs carry relatively more of the format's fixed cost and offer less
history to refer to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from relgraph.llm.scan import code_points, columns_of, scan_texts, spaced_words

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for inputs of at least ``from_bytes`` bytes."""

    from_bytes: int
    lowest: float
    highest: float


#: Whole texts.  Prose of the tested kind lies well inside; under 256 bytes the
#: ratio says little, so only the extremes count.
TEXT_BANDS = (
    Band(0, 0.0, 9.9),
    Band(256, 0.30, 0.85),
    Band(1024, 0.25, 0.75),
    Band(4096, 0.22, 0.70),
    Band(16384, 0.20, 0.65),
)
#: Single chunks: wider, since one table or list inside a text is no fault.
CHUNK_BANDS = (Band(0, 0.0, 9.9), Band(1024, 0.12, 0.80))
CHUNK_BYTES = 4096
#: A text fails when more than this share of its chunks leaves the band.
BAD_CHUNK_SHARE = 0.25
LEVEL = 3

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double, bad_chunk_share double, band_verdict string"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, all occurrences counted."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    size = len(known)
    pairs = ids[:-1] * size + ids[1:]
    if size > 2_000_000:  # the third factor would leave 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(windows, twice)
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= hit
    return int(inside.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def band_of(bands: Sequence[Band], size: int) -> Band:
    return [b for b in bands if b.from_bytes <= size][-1]


def rule_helper(
    text_bands: Sequence[Band], chunk_bands: Sequence[Band], chunk_bytes: int, bad_share: float, level: int
) -> Callable:
    import zstandard

    press = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)

    def ratio(data: bytes) -> float:
        return len(press.compress(data)) / len(data)

    def one(text: bytes | None) -> tuple:
        text = text or b""
        words = spaced_words(text)
        n = len(words)
        repeats = repeated_words(words)
        base_failed = n < 50 or 100 * repeats > 50 * n
        whole, share, verdict = None, None, "none"
        if text:
            whole = ratio(text)
            chunks = [text[i : i + chunk_bytes] for i in range(0, len(text), chunk_bytes)]
            out = 0
            for chunk in chunks:
                band = band_of(chunk_bands, len(chunk))
                out += not band.lowest <= (whole if len(chunks) == 1 else ratio(chunk)) <= band.highest
            share = out / len(chunks)
            band = band_of(text_bands, len(text))
            verdict = (
                "repetitive"
                if whole < band.lowest
                else "incompressible"
                if whole > band.highest
                else "chunks"
                if share > bad_share
                else "inside"
            )
        return (
            n,
            code_points(b"".join(words)),
            len(text) - len(text.translate(None, SYMBOLS)),
            duplicate_lines(text),
            repeats,
            base_failed,
            not base_failed and verdict == "inside",
            whole,
            share,
            verdict,
        )

    return lambda texts: columns_of([one(t) for t in texts], 10)


def apply_quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    text_bands: Sequence[Band] = TEXT_BANDS,
    chunk_bands: Sequence[Band] = CHUNK_BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    bad_share: float = BAD_CHUNK_SHARE,
    level: int = LEVEL,
) -> DataFrame:
    """Append the base counts, the compression figures and the verdict.

    A null or empty text has no words, ratio null and fails the base rule.
    The bands must start at 0 bytes and rise.  One pass, no shuffle; a text is
    the largest thing in memory.
    """
    for bands in (text_bands, chunk_bands):
        starts = [b.from_bytes for b in bands]
        if not starts or starts[0] != 0 or starts != sorted(starts):
            raise ValueError("bands must start at 0 bytes and rise")

    def make():
        return rule_helper(text_bands, chunk_bands, chunk_bytes, bad_share, level)

    return scan_texts(docs, FIELDS, make, text_col, keep)
