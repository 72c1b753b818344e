"""Personal data by anchor expansion.

One Aho-Corasick pass over the text finds anchors: at-signs, plus signs before
digits, dots between digits, neighbouring digits, URL schemes and identifier
cues.  A deterministic parser per kind expands an anchor to both sides and
validates what it found.  Anchors come in text order, so a parser only has to
remember where its last match or digit chain ended: the whole scan is linear.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import scan_texts

#: Order of kinds at equal starts; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]

DIGITS = frozenset(string.digits)
LABEL = frozenset(string.ascii_letters + string.digits + "-")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
PHONE = frozenset(string.digits + " ().-")
#: URL schemes and cues in front of identifiers.
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "www.")
CUES = ("iban", "ssn", "passport", "account", "acct", "tax id", "konto", "compte", "cuenta")
#: Words that may stand between a cue and its identifier.
JOINING = frozenset("number numbers num nummer numero numéro número nr no id is code est ist es".split())
URL_END = frozenset(string.whitespace + "\"'<>`{}|\\^")
URL_TAIL = ".,;:!?)]*"


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if place % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around an at-sign; nothing left of ``floor`` belongs to it."""
    start, size = at, len(text)
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    labels, end, i = 0, at, at + 1
    while True:
        begin = i
        while i < size and text[i] in LABEL:
            i += 1
        if i == begin:
            break
        labels, end = labels + 1, i
        if i >= size or text[i] != ".":
            break
        i += 1
    return (start, end) if labels >= 2 else None


def dotted_at(text: str, at: int) -> tuple[int, int]:
    """The longest chain of digit groups joined by single dots around a digit."""
    start, end, size = at, at + 1, len(text)
    while start > 0 and (
        text[start - 1] in DIGITS or (text[start - 1] == "." and start > 1 and text[start - 2] in DIGITS)
    ):
        start -= 1
    while end < size and (
        text[end] in DIGITS or (text[end] == "." and end + 1 < size and text[end + 1] in DIGITS)
    ):
        end += 1
    return start, end


def addresses_in(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Each four groups of a dotted chain, in order, whose numbers are at most 255."""
    out, at, groups = [], start, text[start:end].split(".")
    for k in range(0, len(groups) - 3, 4):
        four = groups[k : k + 4]
        stop = at + sum(map(len, four)) + 3
        if all(len(g.lstrip("0")) <= 3 and int(g[-3:]) <= 255 for g in four):
            out.append((at, stop))
        at = stop + 1
    return out


def digit_chain(text: str, at: int) -> tuple[int, int]:
    """The longest run of digits with at most one blank or hyphen between two."""
    start, end, size = at, at + 1, len(text)
    while start > 0:
        if text[start - 1] in DIGITS:
            start -= 1
        elif text[start - 1] in " -" and start > 1 and text[start - 2] in DIGITS:
            start -= 2
        else:
            break
    while end < size:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return start, end


def phone_at(text: str, plus: int) -> tuple[tuple[int, int] | None, int]:
    """The number behind a plus sign, and the end of what was consumed."""
    end, size = plus + 2, len(text)
    while end < size and text[end] in PHONE:
        end += 1
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= plus + 3 or text[end - 1] not in DIGITS:
        return None, plus + 2
    n = sum(c in DIGITS for c in text[plus:end])
    return ((plus, end) if 10 <= n <= 15 else None), end


def url_at(text: str, start: int, body: int) -> tuple[int, int] | None:
    end, size = body, len(text)
    while end < size and text[end] not in URL_END:
        end += 1
    while end > body and text[end - 1] in URL_TAIL:
        end -= 1
    return (start, end) if end - body >= 3 else None


def behind_cue(text: str, at: int, cue: str) -> int:
    """Where an identifier may begin: a few separators and joining words are passed over."""
    limit = min(len(text), at + 32)
    while at < limit:
        if text[at] in " :#=.":
            at += 1
            continue
        end = at
        while end < limit and text[end].isalpha():
            end += 1
        # the letters of an IBAN may look like a joining word
        if text[at:end].lower() not in JOINING or cue == "iban" and end < len(text) and text[end] in DIGITS:
            break
        at = end
    return at


def account_after(text: str, at: int, cue: str) -> tuple[int, int] | None:
    """An identifier behind a cue: an IBAN with valid check digits, or 6 to 17
    digits, which in a passport up to two letters may come before."""
    start, size = behind_cue(text, at, cue), len(text)
    end = start
    while end < size and end < start + 42 and (text[end] in LABEL or text[end] == " " and text[end - 1] != " "):
        end += 1
    if cue == "iban":
        for stop in range(end, start + 14, -1):  # the longest that has valid check digits
            code = text[start:stop].replace(" ", "").upper()
            if text[stop - 1] != " " and 15 <= len(code) <= 34 and code[:2].isalpha() and code.isalnum():
                if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                    return start, stop
        return None
    end = start
    while cue == "passport" and end < min(size, start + 2) and text[end] in string.ascii_letters:
        end += 1
    while end < size and (text[end] in DIGITS or text[end] == "-" and end + 1 < size and text[end + 1] in DIGITS):
        end += 1
    n = sum(c in DIGITS for c in text[start:end])
    return (start, end) if 6 <= n <= 17 else None


def anchors():
    import ahocorasick

    found = ahocorasick.Automaton()

    def add(word: str, kind: str, cue: str = "") -> None:
        found.add_word(word, (kind, len(word), cue))

    add("@", "email")
    for d in string.digits:
        add(f"+{d}", "phone")
        for e in string.digits:
            add(f"{d}.{e}", "ip")
            for between in ("", " ", "-"):
                add(f"{d}{between}{e}", "card")
    for scheme in SCHEMES:
        add(scheme, "url")
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            add(form, "account", cue)
    found.make_automaton()
    return found


def spans_of(text: str, automaton) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a text, in code points, by start and kind."""
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, size, cue) in automaton.iter(text):
        at = last + 1 - size
        if at < done[kind]:
            continue
        span = None
        if kind == "email":
            span = email_at(text, at, done[kind])
        elif kind == "ip":
            start, done[kind] = dotted_at(text, at)
            out += [("ip", a, b) for a, b in addresses_in(text, start, done[kind])]
        elif kind == "card":
            start, done[kind] = digit_chain(text, at)
            if done[kind] - start <= 37:  # 19 digits and 18 separators
                digits = text[start : done[kind]].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", start, done[kind]))
        elif kind == "phone":
            span, done[kind] = phone_at(text, at)
        elif kind == "url":
            span = url_at(text, at, last + 1)
        else:
            span = account_after(text, last + 1, cue)
        if span:
            out.append((kind, *span))
            done[kind] = span[1]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


def redacted(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(
    docs: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None, redact: bool = False
) -> DataFrame:
    """Append ``spans``, an array of (kind, start, end), and on request ``redacted``.

    Starts and ends count code points, ends are exclusive.  A null text has no
    spans and stays null when redacted.  One pass, no shuffle.
    """
    fields = "spans array<struct<kind:string,start:bigint,end:bigint>>" + ", redacted string" * redact

    def make() -> Callable:
        automaton = anchors()

        def helper(texts: list[bytes | None]) -> list[list]:
            spans, clean = [], []
            for data in texts:
                text = "" if data is None else data.decode("utf-8", "replace")
                found = spans_of(text, automaton) if text else []
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                if redact:
                    clean.append(None if data is None else redacted(text, found))
            return [spans, clean] if redact else [spans]

        return helper

    return scan_texts(docs, fields, make, text_col, keep)


def count_of(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
