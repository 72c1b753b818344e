"""Tokenizers of public vocabularies, and token counts of whole texts.

Counts are made in Arrow batches and only lengths leave the encoder.  A long
text is split at safe boundaries, places where no token of the whole text can
reach across, so the sum of its pieces is its count; the pieces of a batch are
dealt into calls of about the same number of bytes.  So what an encoder holds
at once is bounded by the size of a call, not by the longest text.

Safe boundaries of a byte-level BPE: its words never go on behind a blank and
never mix letters with punctuation, and its pattern looks ahead only from white
space.  So a blank after a visible character, and a full stop or comma after a
letter, always begin a new word.  Both are looked for among characters whose
class is the same in every version of Unicode.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import kept_columns, scan_texts

#: Added tokens of ``byte_bpe_50k``, which its rank file does not list.
SPECIAL_TOKENS = {"<|endoftext|>": 50256}
#: Runs of white space from this length go to the slower library: the faster one gives up on very long ones.
LONG_BLANKS = 100_000
LIMIT = 512
#: Characters after which a text is split at the next safe boundary; bytes of one call of the encoder.
PIECE_CHARS, CALL_BYTES = 1 << 18, 1 << 20

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡА-яぁ-ゖァ-ヺ一-龥가-힣"
BOUNDARY = re.compile(f"(?<=[!-~{_LETTERS}])(?=[ \\t\\n\\r])|(?<=[{_LETTERS}])(?=[.,;:!?、。！，？])")
_BLANKS = re.compile(rf"\s{{{LONG_BLANKS}}}")

Lengths = Callable[[Sequence[str]], Sequence[int]]


def byte_bpe(
    ranks_path: str, pattern: str, special_tokens: dict[str, int] | None = None, json_path: str | None = None
) -> Callable[[str], np.ndarray]:
    """The byte-level BPE of a rank file as a function from text to ids.

    Gives the ids of the ``tokenizers`` library for the same vocabulary at a
    fraction of the time; a test holds the two against each other.  Marks of
    ``special_tokens`` in a text become their one id; without them they are
    text.  Texts with very long runs of white space, on which the pattern of
    the faster library fails, are encoded by the other one from ``json_path``.
    """
    import base64

    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special_tokens or {})
    slow: list = []

    def encode(text: str) -> np.ndarray:
        if json_path and len(text) >= LONG_BLANKS and _BLANKS.search(text):
            if not slow:
                slow.append(_library(json_path))
                slow[0].encode_special_tokens = not special_tokens
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return encoding.encode_to_numpy(text, allowed_special="all")

    return encode


def _library(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_tokenizer() -> Callable[[], Callable[[str], np.ndarray]]:
    """A maker of the tokenizer ``byte_bpe_50k``, called once in each task."""

    def make() -> Callable[[str], np.ndarray]:
        import public_tokenizers as public

        return byte_bpe(public.path("byte_bpe_50k.tiktoken"), public.PATTERN, SPECIAL_TOKENS, public.path("byte_bpe_50k.json"))

    return make


# ---- counting ---------------------------------------------------------------------------------------------------


def ranked_lengths(tokenizer: Callable[[], Callable[[str], np.ndarray]]) -> Callable[[], tuple[Lengths, re.Pattern | None]]:
    """Lengths by a byte-level BPE such as :func:`byte_bpe`, split at BOUNDARY."""

    def make() -> tuple[Lengths, re.Pattern | None]:
        encode = tokenizer()
        return (lambda texts: [len(encode(t)) for t in texts]), BOUNDARY

    return make


def json_lengths(path: str) -> Callable[[], tuple[Lengths, re.Pattern | None]]:
    """Lengths by the ``tokenizers`` library from its file.

    Long texts are split only where the file says that BOUNDARY is safe: a
    byte-level BPE with its own pattern and no normalizer, whose added tokens
    hold none of the characters that a piece may begin with.
    """

    def make() -> tuple[Lengths, re.Pattern | None]:
        library = _library(path)
        library.no_truncation()
        library.no_padding()
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        words = said.get("pre_tokenizer") or {}
        safe = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
        safe &= said.get("normalizer") is None and not any(
            t["lstrip"] or t["rstrip"] or re.search(r"[\s.,;:!?、。！，？]", t["content"])
            for t in said.get("added_tokens") or []
        )
        return (
            lambda texts: [len(e) for e in library.encode_batch_fast(list(texts), add_special_tokens=False)],
            BOUNDARY if safe else None,
        )

    return make


def model_lengths(path: str) -> Callable[[], tuple[Lengths, re.Pattern | None]]:
    """Lengths by the ``sentencepiece`` library from its model; texts are not split."""

    def make() -> tuple[Lengths, re.Pattern | None]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(ids) for ids in model.encode(list(texts), num_threads=1)]), None

    return make


def pieces_of(text: str, boundary: re.Pattern | None, chars: int) -> Iterator[str]:
    """The text in pieces of ``chars`` characters or a little more, each but the first beginning at a boundary.

    A stretch without a boundary stays in one piece, however long.
    """
    at = 0
    while boundary is not None and len(text) - at > chars:
        cut = boundary.search(text, at + chars)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def balanced_calls(sizes: np.ndarray, most: int) -> np.ndarray:
    """Where to cut a row of pieces so that all calls have about the same bytes, ``most`` or a little more."""
    total = np.cumsum(sizes)
    calls = -(-int(total[-1]) // most) if len(sizes) else 0
    cuts = np.unique(np.searchsorted(total, total[-1] * np.arange(1, calls) / calls) + 1) if calls > 1 else np.zeros(0, np.int64)
    return cuts[cuts < len(sizes)]


def count_tokens(
    docs: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    lengths: Callable[[], tuple[Lengths, re.Pattern | None]] | None = None,
    limit: int = LIMIT,
    piece_chars: int = PIECE_CHARS,
    call_bytes: int = CALL_BYTES,
) -> DataFrame:
    """Append ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``lengths`` makes the encoder in each task (:func:`ranked_lengths`,
    :func:`json_lengths`, :func:`model_lengths`; default ``byte_bpe_50k``).  No
    begin or end token is counted and nothing is cut off; a null text is an
    empty one: no bytes, no tokens.  Every row gives one row, repeated rows and
    null ids too.
    """
    make_lengths = lengths or ranked_lengths(default_tokenizer())

    def make() -> Callable:
        count, boundary = make_lengths()

        def helper(texts: list[bytes | None]) -> list[list]:
            owners: list[int] = []
            pieces: list[str] = []
            sizes: list[float] = []
            for i, data in enumerate(texts):
                text = (data or b"").decode("utf-8", "replace")
                for piece in pieces_of(text, boundary, piece_chars):
                    owners.append(i)
                    pieces.append(piece)
                    sizes.append(len(data or b"") * len(piece) / max(1, len(text)))
            cuts = balanced_calls(np.array(sizes), call_bytes)
            total = [0] * len(texts)
            for begin, end in zip([0, *cuts], [*cuts, len(pieces)], strict=True):
                for owner, n in zip(owners[begin:end], count(pieces[begin:end]), strict=True):
                    total[owner] += n
            return [[len(t or b"") for t in texts], total]

        return helper

    carried = kept_columns(docs, ["n_bytes", "n_tokens", "over_limit"], keep)
    counted = scan_texts(docs, "n_bytes bigint, n_tokens bigint", make, text_col, carried)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
