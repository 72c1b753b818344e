"""Language of every word by a linear-chain conditional random field.

A word's score for a language adds up learned weights of hashed features: byte
n-grams of the lower-cased word with its borders (those at a border are its
affixes) and the word itself, the lexicon.  Transitions between the languages
of neighbouring words are learned too.  Forward-backward gives each word its
marginal probabilities; a document gets the language with the largest sum.

Documents carry one language, so code-switched training text is made from them:
sequences join runs of words from several documents.  Training uses a bounded
sample (see :func:`training_sample`); prediction reads every whole text, in
blocks of a fixed number of words in which the chain starts anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import scan_texts

#: ASCII other than letters separates words; every other byte belongs to one.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
ORDERS = (2, 3, 4)
FEATURE_BITS = 18
#: Words of a chain; a longer text is several chains.
CHAIN_WORDS = 64
#: Words scored at once in a task.
CHUNK_WORDS = 60_000
#: Documents sampled per language to learn from (in expectation; there are 1 % more at most for large ones).
SAMPLE_DOCS = 400
#: Longest text of the sample.
SAMPLE_CHARS = 20_000
SEQUENCES, SEQUENCE_WORDS, EPOCHS, RATE, DECAY = 4000, 32, 6, 0.5, 1e-5
UNKNOWN = "und"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def has_letter(text: str) -> bool:
    """Quick for most texts: an ASCII letter, or else any letter at all."""
    return any(c.isalpha() for c in text[:200]) or any(c.isalpha() for c in text[200:])


@dataclass
class Features:
    """Feature instances of words, in word order for each group of features."""

    words: int
    groups: list[tuple[np.ndarray, np.ndarray]]  # (feature ids, first instance of each word)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum over the groups of the mean weight per word."""
        total = np.zeros((self.words, weights.shape[1]), np.float32)
        for ids, first in self.groups:
            count = np.diff(np.append(first, len(ids))).astype(np.float32)
            total += np.add.reduceat(weights[ids], first, axis=0) / count[:, None]
        return total

    def gradient(self, delta: np.ndarray, features: int) -> np.ndarray:
        """What a change of the word scores by ``delta`` means for the weights."""
        out = np.zeros((features, delta.shape[1]), np.float32)
        for ids, first in self.groups:
            count = np.diff(np.append(first, len(ids)))
            for k in range(delta.shape[1]):
                out[:, k] += np.bincount(ids, np.repeat(delta[:, k] / count, count), features).astype(np.float32)
        return out


_PLACES = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def features_of(words: Sequence[bytes], bits: int = FEATURE_BITS) -> Features:
    """Hashed features of a list of words, from one pass over their bytes."""
    text = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = text == 32
    start = np.flatnonzero(blank[:-1])  # the border before each word
    number = np.cumsum(blank) - 1  # of the word that a byte, or the border before it, belongs to
    shift, groups, code = np.uint32(32 - bits), [], text.astype(np.uint32)
    whole = code.copy()
    for order in range(2, max(ORDERS) + 1):
        size = len(text) - order + 1
        whole = whole[:size] * np.uint32(0x01000193) ^ code[order - 1 :]
        if order not in ORDERS:
            continue
        good = np.ones(size, bool)
        for inside in range(1, order - 1):
            good &= ~blank[inside : inside + size]
        at = np.flatnonzero(good)
        ids = ((whole[at] ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> shift
        owner = number[at]
        first = np.searchsorted(owner, np.arange(len(words)))
        has = first < np.append(first[1:], len(at))
        if not has.all():  # one-letter words have no window of the longest order
            extra = np.flatnonzero(~has)
            ids = np.insert(ids, first[extra], 0)
            first = first + np.concatenate([[0], np.cumsum(~has)[:-1]])
        groups.append((ids, first))
    inside = np.flatnonzero(~blank)
    place = (inside - start[number[inside]]) % 64
    with np.errstate(over="ignore"):
        parts = (code[inside].astype(np.uint64) + np.uint64(1)) * _PLACES[place]
        lexicon = np.add.reduceat(parts, np.searchsorted(inside, start)) * np.uint64(0x9E3779B97F4A7C15)
    groups.append(((lexicon >> np.uint64(64 - bits)).astype(np.uint32), np.arange(len(words))))
    return Features(len(words), groups)


@dataclass
class Crf:
    """Languages, feature weights (features x languages) and transitions (from x to)."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def marginals(self, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over chains at once.

        ``scores`` is (chains, words, languages), ``mask`` tells words from the
        padding at the ends.  Returns the marginals and the expected number of
        each transition.
        """
        move = np.exp(self.transitions)
        emit = np.exp(scores - scores.max(axis=2, keepdims=True))
        chains, length, n = scores.shape
        ahead = np.empty_like(emit)
        ahead[:, 0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, length):
            now = np.einsum("ci,ij->cj", ahead[:, t - 1], move) * emit[:, t]
            ahead[:, t] = now / now.sum(axis=1, keepdims=True)
        back = np.ones((chains, n), emit.dtype)
        expected = np.zeros((n, n))
        for t in range(length - 1, -1, -1):
            ahead[:, t] *= back
            ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
            if t:
                following = emit[:, t] * back
                earlier = np.einsum("cj,ij->ci", following, move)
                live = mask[:, t]
                # weight of i -> j given all words: forward of i, move, what follows j
                joint = ahead[:, t - 1, :, None] * move * following[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                expected += joint[live].sum(axis=0)
                earlier /= earlier.sum(axis=1, keepdims=True)
                back = np.where(live[:, None], earlier, np.ones_like(earlier))
        return ahead, expected


def training_sequences(
    texts: Iterable[tuple[str, str]], languages: list[str], count: int, length: int, seed: int = 3
) -> tuple[list[bytes], np.ndarray]:
    """Words of ``count`` sequences, joined from runs of one or more documents, and their languages."""
    draw = np.random.default_rng(seed)
    pool: dict[str, list[list[bytes]]] = {language: [] for language in languages}
    for text, language in texts:
        words = words_of(text)
        if words:
            pool[language].append(words)
    usable = [k for k, language in enumerate(languages) if pool[language]]
    words: list[bytes] = []
    labels: list[int] = []
    for _ in range(count if usable else 0):
        room, mixed = length, draw.random() < 0.6
        k = usable[draw.integers(len(usable))]
        while room:
            docs = pool[languages[k]]
            doc = docs[draw.integers(len(docs))]
            size = min(room, int(draw.geometric(1 / 10)) if mixed else room)
            at = draw.integers(max(1, len(doc) - size + 1))
            run = doc[at : at + size]
            words += run
            labels += [k] * len(run)
            room -= len(run)
            if mixed:
                k = usable[draw.integers(len(usable))]
    return words, np.array(labels).reshape(-1, length)


def train(
    texts: Sequence[tuple[str, str]],
    sequences: int = SEQUENCES,
    length: int = SEQUENCE_WORDS,
    epochs: int = EPOCHS,
    bits: int = FEATURE_BITS,
) -> Crf:
    """Maximize the conditional likelihood of made-up code-switched sequences by AdaGrad."""
    languages = sorted({language for _, language in texts})
    n = len(languages)
    model = Crf(languages, np.zeros((1 << bits, n), np.float32), np.zeros((n, n), np.float32))
    if n == 0:
        return model
    words, labels = training_sequences(sorted(texts), languages, sequences, length)
    if not len(words):
        return model
    step = 250
    parts = [
        (features_of(words[i * length : (i + step) * length], bits), labels[i : i + step])
        for i in range(0, len(labels), step)
    ]
    squares, move_squares = np.full_like(model.weights, 1e-6), np.full((n, n), 1e-6)
    for _ in range(epochs):
        for features, gold in parts:
            scores = features.scores(model.weights).reshape(*gold.shape, n)
            marginal, expected = model.marginals(scores, np.ones(gold.shape, bool))
            delta = (np.eye(n, dtype=np.float32)[gold] - marginal).reshape(-1, n)
            gradient = features.gradient(delta, 1 << bits) / len(gold) - DECAY * model.weights
            squares += gradient**2
            model.weights += RATE * gradient / np.sqrt(squares)
            seen = np.zeros((n, n))
            np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            gradient = (seen - expected) / len(gold)
            move_squares += gradient**2
            model.transitions += (0.2 * gradient / np.sqrt(move_squares)).astype(np.float32)
    return model


def training_sample(
    docs: DataFrame,
    learn: str,
    id_col: str,
    text_col: str,
    lang_col: str,
    per_language: int = SAMPLE_DOCS,
    longest: int = SAMPLE_CHARS,
) -> list[tuple[str, str]]:
    """A bounded sample of (text, language): about ``per_language`` documents each, chosen by a hash of the id."""
    usable = docs.where(learn).where(
        f"`{lang_col}` is not null and `{text_col}` is not null and length(`{text_col}`) <= {longest}"
    )
    counts = {r["lang"]: r["n"] for r in usable.groupBy(F.col(f"`{lang_col}`").alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64(f"`{id_col}`", f"`{text_col}`"), F.lit(1_000_000))
    limit = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, min(1_000_000, per_language * 1_000_000 // n + 1))]
    )
    chosen = usable.where(place < F.element_at(limit, F.col(f"`{lang_col}`")))
    return [(r[0], r[1]) for r in chosen.select(f"`{text_col}`", f"`{lang_col}`").collect()]


def predict_helper(model: Crf, chain: int = CHAIN_WORDS, chunk: int = CHUNK_WORDS) -> Callable:
    """Helper for :func:`scan_texts`: language, score and runs of words of one language per text."""
    n = len(model.languages)

    def probabilities(words: list[bytes], sizes: list[int]) -> np.ndarray:
        """Marginals (words x languages); ``sizes`` are the chain lengths in order."""
        scores = features_of(words).scores(model.weights)
        ends = np.cumsum(sizes)
        grid = np.arange(chain)[None, :] + (ends - sizes)[:, None]
        mask = np.arange(chain)[None, :] < np.array(sizes)[:, None]
        # padding has equal scores for all languages, so it does not matter
        padded = np.where(mask[:, :, None], scores[np.minimum(grid, len(words) - 1)], np.float32(0))
        return posterior(padded, mask)[mask]

    def posterior(scores: np.ndarray, mask: np.ndarray) -> np.ndarray:
        move = np.exp(model.transitions)
        emit = np.exp(scores - scores.max(axis=2, keepdims=True)).transpose(1, 0, 2).copy()
        ahead = np.empty_like(emit)
        ahead[0] = emit[0]
        for t in range(1, chain):
            now = np.einsum("ci,ij->cj", ahead[t - 1], move) * emit[t]
            ahead[t] = now / now.sum(axis=1, keepdims=True)
        back = np.ones_like(emit[0])
        for t in range(chain - 1, 0, -1):
            following = np.einsum("cj,ij->ci", emit[t] * back, move)
            ahead[t] *= back
            following /= following.sum(axis=1, keepdims=True)
            back = np.where(mask[:, t][:, None], following, np.float32(1))
        ahead[0] *= back
        ahead /= ahead.sum(axis=2, keepdims=True)
        return ahead.transpose(1, 0, 2)

    def helper(texts: list[bytes | None]) -> list[list]:
        total = np.zeros((len(texts), max(n, 1)))
        count = np.zeros(len(texts), np.int64)
        runs: list[list[dict]] = [[] for _ in texts]
        letters = np.zeros(len(texts), bool)
        words: list[bytes] = []
        sizes: list[int] = []
        pieces: list[tuple[int, int]] = []  # (text, words)

        def flush() -> None:
            if not words:
                return
            p = probabilities(words, sizes)
            best, at = p.argmax(axis=1), 0
            for text, size in pieces:
                own = best[at : at + size]
                total[text] += p[at : at + size].sum(axis=0)
                cut = np.flatnonzero(np.diff(own)) + 1
                for a, b in zip([0, *cut.tolist()], [*cut.tolist(), size], strict=True):
                    language, before = model.languages[own[a]], runs[text]
                    begin = int(count[text])
                    if before and before[-1]["lang"] == language:
                        before[-1]["end"] = begin + b
                    else:
                        before.append({"start": begin + a, "end": begin + b, "lang": language})
                count[text] += size
                at += size
            words.clear(), sizes.clear(), pieces.clear()

        for i, data in enumerate(texts):
            text = data.decode("utf-8", "replace") if data else ""
            letters[i] = has_letter(text)
            if not letters[i] or not n:
                continue
            own = words_of(text)
            for at in range(0, len(own), chunk):
                part = own[at : at + chunk]
                words.extend(part)
                pieces.append((i, len(part)))
                sizes.extend([chain] * (len(part) // chain) + [len(part) % chain] * (len(part) % chain > 0))
                if len(words) >= chunk:
                    flush()
        flush()
        best = total.argmax(axis=1)
        known = letters & (count > 0)
        share = total[np.arange(len(texts)), best] / np.maximum(count, 1)
        return [
            [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
            np.clip(np.where(known, share, 0.0), 0.0, 1.0),
            runs,
        ]

    return helper


def identify_languages(
    docs: DataFrame,
    model: Crf,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append ``lang_pred``, ``score`` and ``runs``.

    ``score`` is the mean marginal of the predicted language over the words;
    ``runs`` are (start, end, lang) of neighbouring words with one label, words
    counted from 0.  A text that is null or has no letter is ``und`` with score
    0 and no runs, and so is every text if the model knows no language.
    """
    fields = "lang_pred string, score double, runs array<struct<start:bigint,end:bigint,lang:string>>"
    return scan_texts(docs, fields, lambda: predict_helper(model), text_col, keep)
