"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule is a predicate that rejects a text. On a sample, the planner
measures how many texts each rule rejects and how long it takes, and orders the
rules by rejection per cost. The verdict is one CASE expression in that order,
so that a rejected text never reaches the dear rules. The order moves cost, not
the verdict: a text is kept if no rule rejects it.

Null and empty texts have no words and fail the rule `few_words`. Very long
texts are read whole. Repeated rows and ties get equal verdicts. Columns of the
input stay as they are; judge() replaces a column of the name that it adds (a
parameter). An empty table gives an empty result, in the declared order of rules.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, words_of

WINDOW = 5
#: Rows of the sample from which rejection and cost are estimated (about; the sample is drawn by a fixed seed).
SAMPLE_ROWS = 200
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """rejects: maps measures (a function from a name to its column) to a boolean column, true if the text goes."""

    name: str
    rejects: object


def word_chars(words: Column) -> Column:
    return F.length(F.concat_ws("", words)).cast("long")


def symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def exclamations(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long")


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\f\r"))) > 0)


def duplicate_lines(text: Column) -> Column:
    return bound(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _covered(pairs: Column) -> Column:
    """Words under the windows whose hash occurs again; pairs: sorted (hash, position)."""

    def twice(pair: Column, i: Column) -> Column:
        def same(other: Column) -> Column:
            return F.coalesce(other["h"] == pair["h"], F.lit(False))

        return same(F.get(pairs, i - 1)) | same(F.get(pairs, i + 1))

    starts = F.sort_array(F.transform(F.filter(pairs, twice), lambda pair: pair["p"]))
    return bound(
        starts,
        lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0),
            lambda total, n: total + n,
        ),
    )


def _joined(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _from(values: Column, start: int) -> Column:
    return F.slice(values, start, F.lit(2**30))


def _distinct(hashes: Column) -> Column:
    return F.size(F.array_distinct(hashes)) == F.size(hashes)


def pair_hashes(words: Column) -> Column:
    return _joined(words, _from(words, 2))


def four_hashes(pairs: Column) -> Column:
    """A hash of every four words in a row, from the hashes of every two."""
    return F.slice(_joined(pairs, _from(pairs, 3)), 1, F.greatest(F.size(pairs) - 3, F.lit(0)))


def repeated_of(fours: Column) -> Column:
    """Words inside five-word windows that occur twice or more, from the hashes of every four words.

    A window occurs twice only if its first four words do; so a text without
    equal four-word hashes is done at once. Otherwise a sort within the row
    replaces any comparison of all pairs. Hashes have 64 bits.
    """

    def numbered(hashes: Column) -> Column:
        return F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p")))

    def fives(h: Column) -> Column:
        return F.when(_distinct(h), F.lit(0)).otherwise(bound(F.sort_array(numbered(h)), _covered))

    windows = F.slice(_joined(fours, _from(fours, 2)), 1, F.greatest(F.size(fours) - 1, F.lit(0)))
    return F.when(_distinct(fours), F.lit(0)).otherwise(bound(windows, fives)).cast("long")


def repeated_words(words: Column) -> Column:
    """repeated_of, straight from the words; 0 for texts under five words."""
    return bound(bound(pair_hashes(words), four_hashes), repeated_of)


#: Measures by name, each a function of the text and of its words.
MEASURES = {
    "n_words": lambda t, w: F.size(w).cast("long"),
    "word_chars": lambda t, w: word_chars(w),
    "n_symbols": lambda t, w: symbols(t),
    "n_marks": lambda t, w: exclamations(t),
    "n_lines": lambda t, w: F.size(lines_of(t)).cast("long"),
    "n_dup_lines": lambda t, w: duplicate_lines(t),
    "n_repeat_words": lambda t, w: repeated_words(w),
}


def measured(text: Column, words: Column):
    """Measures worked out where a rule asks for them, so that a rule that isn't reached costs nothing."""
    return lambda name: MEASURES[name](text, words)


#: The rules and their fixed thresholds. few_words and repeated_windows are the base; the others look for junk that a clean text does not have.
RULES = (
    Rule("few_words", lambda m: m("n_words") < 10),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("symbols", lambda m: m("n_symbols") > 0.3 * m("n_words")),
    Rule("exclamations", lambda m: m("n_marks") > 0.5 * m("n_words")),
    Rule("duplicate_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
)

#: The rules that base_failed stands for.
BASE = ("few_words", "repeated_windows")


def estimate(docs: DataFrame, text: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Rejection share and seconds of each rule on a sample of about sample_rows rows."""
    total = docs.count()
    if not total:
        return [{"rule": r.name, "rejects": 0.0, "cost": 0.0} for r in rules]
    drawn = docs.select(F.col(text).alias("__text")).sample(fraction=min(1.0, sample_rows / total), seed=9).repartition(1)  # only the drawn rows move
    sample = drawn.select("__text", words_of(F.col("__text")).alias("__words")).persist()
    try:
        sample.count()
        found = []
        for rule in rules:
            best = None
            for _ in range(2):  # the first run also compiles the plan
                began = time.perf_counter()
                share = sample.agg(F.avg(rule.rejects(measured(F.col("__text"), F.col("__words"))).cast("int"))).first()[0]
                best = min(best or 1e9, time.perf_counter() - began)
            found.append({"rule": rule.name, "rejects": float(share or 0.0), "cost": best})
        return found
    finally:
        sample.unpersist()


def ordered(rules, estimates: list[dict]) -> list[Rule]:
    """By rejection per cost, most first; ties by cost, then by name."""
    by_name = {e["rule"]: e for e in estimates}

    def rank(rule: Rule):
        e = by_name[rule.name]
        return (-e["rejects"] / max(e["cost"], 1e-9), e["cost"], rule.name)

    return sorted(rules, key=rank)


def first_failed(measure, rules) -> Column:
    """Name of the first rule in order that rejects, else null. CASE stops at it."""
    verdict = None
    for rule in rules:
        verdict = F.when(rule.rejects(measure), F.lit(rule.name)) if verdict is None else verdict.when(rule.rejects(measure), F.lit(rule.name))
    return verdict.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, text: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS, out: str = "failed_rule") -> DataFrame:
    """docs with the name of the rule that rejects, in column `out`: null for the texts to keep."""
    order = ordered(rules, estimate(docs, text, rules, sample_rows))
    split = docs.withColumn("__words", words_of(F.col(text)))
    return split.withColumn(out, first_failed(measured(F.col(text), F.col("__words")), order)).drop("__words")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, the measures on which the base rules rest, and the cascade's verdict.

    The measures of the result are asked for in any case, and the cascade reads
    these columns. Its other measures are worked out only for texts that the
    base and the rules before leave standing.
    """
    order = ordered(RULES, estimate(docs))
    split = docs.select("doc_id", "text", words_of(F.col("text")).alias("__words"))
    paired = split.select("*", pair_hashes(F.col("__words")).alias("__pairs"))
    hashed = paired.select("doc_id", "text", "__words", four_hashes(F.col("__pairs")).alias("__fours"))
    own = {n: MEASURES[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines")} | {"n_repeat_words": lambda t, w: repeated_of(F.col("__fours"))}
    counted = hashed.select("doc_id", "text", "__words", *[use(F.col("text"), F.col("__words")).alias(name) for name, use in own.items()])
    lazily = measured(F.col("text"), F.col("__words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = first_failed(lambda name: F.col(name) if name in own else lazily(name), [r for r in order if r.name not in BASE])
    return counted.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(verdict.isNull()).alias("kept"),
    )
