"""Secret scan: candidate strings, and a random forest that removes false positives.

Candidates are long runs of key-like characters.  Their features are SQL
expressions: length, shares and transitions of characters, the part covered by
dictionary words, the path, and the words next to them.  A random forest learns
from labelled findings and is turned into one SQL expression, which is applied
to the candidates inside the row of their document.  So the main path has
DataFrame functions only, needs no shuffle, and a document with very many
candidates needs no group.

Labelled findings can be given; else those that rules are sure of are used:
known formats and values assigned to a name such as ``password`` are secrets,
plain words and plain numbers elsewhere are not.  The forest then decides on
everything, also what no rule knows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.llm.scan import hidden, kept_columns
from relgraph.plans.staging import Staging

#: Characters of the neighbourhood that are looked at.
BEFORE, AFTER = 48, 16
#: Token formats, names in front of secrets, and paths of examples or of settings.
FORMATS = "^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk-[A-Za-z0-9]{32,})$"
NAMES = "password|passwd|pwd|secret|token|api_?key|apikey|access_?key|auth|credential|bearer"


def _named_values(names: str = NAMES) -> str:
    """Values of 6 or more non-blank characters right after a name and = or :, as a pattern of Java and Python.

    Python wants lookbehinds of one width each, so there is one for each width.
    Unquoted values do not end with the punctuation of a sentence.
    """
    words = [w for n in names.split("|") for w in ([n.replace("_?", "_"), n.replace("_?", "")] if "_?" in n else [n])]
    by_width: dict[int, list[str]] = {}
    for word in words:
        for quote in ("", "[\"']"):
            for blank in ("", "[ \t]"):
                for gap in ("", "[ \t]"):
                    width = len(word) + bool(quote) + bool(blank) + 1 + bool(gap)
                    by_width.setdefault(width, []).append(f"{word}{quote}{blank}[:=]{gap}")

    def behind(mark: str) -> str:
        return "(?:" + "|".join(f"(?<=(?i:{'|'.join(w)}){mark})" for w in by_width.values()) + ")"

    bare = behind("") + "[^\\s\"'<>]{5,}[^\\s\"'<>.,;:)}\\]]"
    near = "(?:(?<=[:=])|(?<=[:=][ \\t\"'])|(?<=[:=][ \\t][\"']))"  # soon says no to most places
    return f"{near}(?:" + "|".join([bare, *[behind(q) + f"[^\\s{q}]{{6,}}" for q in "\"'"]]) + ")"


#: Key-like runs, from their first character on, and whatever is assigned to a name of a secret.
CANDIDATE = f"(?:{_named_values()}|(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{{16,}}+={{0,2}})"
EXAMPLE_PATHS, SETTING_PATHS = "(?i)test|example|sample|mock|doc", "(?i)[.]env|conf|settings|secret|deploy"
#: Labelled findings learned from, of each kind; words of the dictionary, which bounds its regular expression.
SAMPLE_EACH, DICTIONARY_WORDS = 10_000, 2000
TREES, DEPTH, THRESHOLD = 20, 6, 0.5
MASK = "[SECRET]"

FEATURES = (
    "length", "digits", "upper", "lower", "hex", "different", "kind_changes", "vowel_changes", "doubles",
    "dictionary", "name_before", "assigned", "quoted", "word_before", "word_after", "example_path", "setting_path",
)


def trie_pattern(words: Sequence[str]) -> str:
    """A pattern for the longest of the words at a place, branching letter by letter."""
    out, by_first = [], {}
    for word in sorted(set(words) - {""}):
        by_first.setdefault(word[0], []).append(word)
    for group in by_first.values():
        start = os.path.commonprefix(group)
        rest = [w[len(start) :] for w in group if w != start]
        out.append(start + (f"(?:{trie_pattern(rest)})" + "?" * (start in group) if rest else ""))
    return "|".join(out)


def features_of(value: Column, before: Column, after: Column, path: Column, words: Sequence[str]) -> dict[str, Column]:
    """The features of a candidate as double columns."""
    size = F.length(value).cast("double")
    low = F.lower(value)

    def share(of: Column, pattern: str) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / size

    def flag(of: Column, pattern: str) -> Column:
        return F.coalesce(of.rlike(pattern), F.lit(False)).cast("double")

    covered = 1 - F.length(F.regexp_replace(low, trie_pattern(words), "")) / size if words else F.lit(0.0)
    columns = {
        "length": size,
        "digits": share(value, "[0-9]"),
        "upper": share(value, "[A-Z]"),
        "lower": share(value, "[a-z]"),
        "hex": share(low, "[0-9a-f]"),
        "different": F.size(F.array_distinct(F.split(value, ""))) / size,
        "kind_changes": share(value, "[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])"),
        "vowel_changes": share(low, "[aeiouy](?=[bcdfghjklmnpqrstvwxz])|[bcdfghjklmnpqrstvwxz](?=[aeiouy])"),
        "doubles": share(value, "(.)(?=\\1)"),
        "dictionary": covered,
        "name_before": flag(before, f"(?i)({NAMES})"),
        "assigned": flag(before, "[:=]\\s*[\"']?$"),
        "quoted": flag(before, "[\"']$"),
        "word_before": flag(before, "(?U)[a-z]{2,}[.,;]?\\s+$"),
        "word_after": flag(after, "(?U)^[.,;]?\\s+[A-Za-z]{2,}"),
        "example_path": flag(path, EXAMPLE_PATHS),
        "setting_path": flag(path, SETTING_PATHS),
    }
    return {n: columns[n].cast("double") for n in FEATURES}


def sure_label(value: Column, before: Column, dictionary: Column | None = None) -> Column:
    """1.0 for secrets and 0.0 for others that rules are sure of, else null."""
    named = before.rlike(f"(?i)({NAMES})[\"']?\\s*[:=]\\s*[\"']?$")
    return (
        F.when(value.rlike(FORMATS), 1.0)
        .when(named & value.rlike("[0-9]"), 1.0)
        .when(named & value.rlike("^[A-Za-z]+$") & (F.lit(0.0) if dictionary is None else dictionary).__ge__(1.0), 0.0)
        .when(~before.rlike(f"(?i)({NAMES})") & value.rlike("^([0-9]+|[^0-9]+)$"), 0.0)
    )


#: Set around candidates while a text is cut; a text that holds it is cut in two scans instead of one.
_MARK = "\ue000"


def with_candidates(docs: DataFrame, text_col: str, pattern: str) -> DataFrame:
    """Append ``__found``: (value, before, after, gap), the gap being the text since the candidate before.

    The last entry has no value and holds the text behind all candidates; a
    null text has no entries.
    """
    text = F.col(f"`{text_col}`")
    none = F.array().cast("array<string>")
    # one scan marks the candidates, the marks then cut the text: gap, value, gap, ..., gap
    cut = F.split(F.regexp_replace(text, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    marked = F.array(F.struct(F.filter(cut, lambda x, i: i % 2 == 1).alias("values"), F.filter(cut, lambda x, i: i % 2 == 0).alias("gaps")))
    scanned = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps")))
    parts = F.when(F.contains(text, F.lit(_MARK)), scanned).otherwise(marked)
    # Lambdas below use their own element only: a column of the row would be computed anew for each element.
    parts = F.transform(parts, lambda p: F.struct(F.coalesce(p["values"], none).alias("values"), F.coalesce(p["gaps"], none).alias("gaps")))
    parts = F.transform(parts, lambda p: F.arrays_zip(p["values"], p["gaps"], F.slice(p["gaps"], 2, F.greatest(F.size(p["gaps"]), F.lit(1))), F.slice(F.concat(F.array(F.lit("")), p["values"]), 1, F.size(p["gaps"]))))
    parts = F.get(parts, F.lit(0))
    found = F.transform(
        parts,
        lambda c: F.struct(
            c["values"].alias("value"),
            F.right(F.concat(F.coalesce(c["3"], F.lit("")), c["gaps"]), F.lit(BEFORE)).alias("before"),
            F.left(F.coalesce(c["2"], F.lit("")), F.lit(AFTER)).alias("after"),
            c["gaps"].alias("gap"),
        ),
    )
    return docs.withColumn("__found", found)


@dataclass(frozen=True)
class Forest:
    """Trees as nested (feature, threshold, left, right), leaves as the probability of a secret."""

    trees: tuple

    def score(self, feature: Callable[[str], Column]) -> Column:
        def node(n) -> Column:
            if not isinstance(n, tuple):
                return F.lit(float(n))
            index, threshold, left, right = n
            return F.when(feature(FEATURES[index]) <= threshold, node(left)).otherwise(node(right))

        total: Column = F.lit(0.0)
        for tree in self.trees:
            total = total + node(tree)
        return total / len(self.trees)


def train_forest(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Forest | None:
    """A forest from rows of features and ``label`` (0.0 or 1.0); None without findings of both kinds."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    kinds = {r["label"] for r in findings.select("label").distinct().collect()}
    if kinds != {0.0, 1.0}:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings.select(*FEATURES, "label"))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(vectors)

    def walk(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return node.impurityStats().prob(1.0)
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return Forest(tuple(walk(t._call_java("rootNode")) for t in model.trees))


def dictionary_of(docs: DataFrame, text_col: str, size: int) -> list[str]:
    """The most frequent words of at least 3 letters in all documents."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(f"`{text_col}`")), F.lit("[a-z]{3,}"), F.lit(0))).alias("w"))
    rows = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(size).collect()
    return sorted((r["w"] for r in rows), key=lambda w: (-len(w), w))


def labelled_findings(found: DataFrame, path: Column, words: Sequence[str], each: int, staging: Staging) -> DataFrame:
    """Features and labels of at most ``each`` findings of a kind that rules are sure of, chosen by hash.

    ``found`` comes from :func:`with_candidates`, best written before.
    """
    rows = found.select(path.cast("string").alias("path"), F.explode_outer("__found").alias("c")).select("path", "c.value", "c.before", "c.after")
    rows = rows.where("value is not null").groupBy("value", "before").agg(F.min(F.struct("after", "path")).alias("c"))
    rows = rows.select("value", "before", "c.after", "c.path")
    features = features_of(F.col("value"), F.col("before"), F.col("after"), F.col("path"), words)
    rows = rows.select("value", "before", *[x.alias(n) for n, x in features.items()])
    rows = rows.withColumn("label", sure_label(F.col("value"), F.col("before"), F.col("dictionary"))).where("label is not null")
    order = [F.xxhash64("value", "before"), "value", "before"]
    parts = [rows.where(F.col("label") == k).orderBy(*order).limit(each) for k in (0.0, 1.0)]
    kept, _ = staging.keep(parts[0].unionByName(parts[1]).select(*FEATURES, "label"), "findings")
    return kept


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | Column = "source",
    keep: Sequence[str] | None = None,
    labelled: DataFrame | None = None,
    redact: bool = True,
    pattern: str = CANDIDATE,
    threshold: float = THRESHOLD,
    sample_each: int = SAMPLE_EACH,
) -> DataFrame:
    """Append ``findings`` and ``redacted``.

    ``findings`` are all candidates of the text in order, as (n, value, before,
    score, is_secret), n from 0; ``redacted`` is the text with the secrets
    replaced.  Candidates and the text between them are written once, with the
    carried columns.  ``labelled`` may hold findings to learn from, as (value, before,
    after, path, label 0.0/1.0).  A null text has no findings and stays null.
    If there is nothing to learn from, rules alone decide.
    """
    carried = kept_columns(docs, ["findings", "redacted"], keep)
    staging = Staging(docs.sparkSession)
    where = F.col(f"`{path}`") if isinstance(path, str) else path
    words = dictionary_of(docs, text_col, DICTIONARY_WORDS)
    # candidates are looked for once; their gaps are the text, which is not read again
    names, own, back = hidden([c for c in carried if c != text_col])
    inner = docs.select(*own, F.col(f"`{text_col}`").alias("__text"), where.cast("string").alias("__path"))
    found = with_candidates(inner, "__text", pattern).withColumn("__null", F.col("__text").isNull()).drop("__text")
    found, _ = staging.keep(found, "candidates")
    if text_col in carried:
        whole = F.array_join(F.transform("__found", lambda c: F.concat(c["gap"], F.coalesce(c["value"], F.lit("")))), "")
        back.insert(carried.index(text_col), F.when(~F.col("__null"), whole).alias(text_col))
    if labelled is None:
        known = labelled_findings(found, F.col("__path"), words, sample_each, staging)
    else:
        columns = features_of(*[F.col(c) for c in ("value", "before", "after", "path")], words)
        known = labelled.select(*[c.alias(n) for n, c in columns.items()], F.col("label").cast("double").alias("label"))
    forest = train_forest(known)

    def scored(c: Column) -> Column:
        if forest is None:
            return F.coalesce(sure_label(c["value"], c["before"]), F.lit(0.0))
        return forest.score(lambda name: c[name])

    def described(c: Column) -> Column:
        features = features_of(c["value"], c["before"], c["after"], F.col("__path"), words)
        return F.struct(*[c[n].alias(n) for n in ("value", "before", "gap")], *[x.alias(n) for n, x in features.items()])

    def judged(c: Column) -> Column:
        return F.struct(*[c[n].alias(n) for n in ("value", "before", "gap")], scored(c).alias("score"))

    out = found.withColumn("__found", F.transform("__found", described)).withColumn("__scores", F.transform("__found", judged))
    findings = F.transform(
        F.filter("__scores", lambda c: c["value"].isNotNull()),
        lambda c, i: F.struct(
            i.alias("n"),
            c["value"].alias("value"),
            c["before"].alias("before"),
            c["score"].alias("score"),
            (c["score"] > threshold).alias("is_secret"),
        ),
    )
    pieces = F.transform(
        "__scores",
        lambda c: F.concat(c["gap"], F.when(c["value"].isNull(), "").when(c["score"] > threshold, MASK).otherwise(c["value"])),
    )
    clean = F.when(~F.col("__null"), F.array_join(pieces, "")).alias("redacted")
    return out.select(*back, findings.alias("findings"), *[clean] * redact)
