"""Secret scans over a ledger of content-addressed blobs, in built-in functions only.

Every version of every path is addressed by the SHA-256 of its text. Only pairs
of a blob and a rule version that the ledger lacks are scanned, each blob once
however many paths hold it; findings are joined back to all paths.

Null and empty texts are one blob without findings. Repeated rows and equal
texts share a blob and keep their own rows. Other columns are not read, so
their names can't clash. An empty table gives empty results. Texts are scanned
whole; offsets count code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, stored


@dataclass(frozen=True)
class Rule:
    """group: the part that must have at_least characters; matches that fail are dropped after matching."""

    kind: str
    pattern: str
    version: str
    group: int = 0
    at_least: int = 0
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns. The first three are the base, in the order in which ties are listed.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "1", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", "1", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", "1", 0, 32, True),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", "1"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", "1"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", "1"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "1"),
)

#: Matches of one text whose offsets are summed up together.
CHUNK = 256
SPANS = "array<struct<start:int,rank:int,kind:string,stop:int>>"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule's matches, leftmost first and not overlapping.

    The pieces between matches (split) and the matches (regexp_extract_all)
    alternate; their running lengths are the offsets.
    """

    def walk(hits: Column) -> Column:
        pieces = F.transform(F.split(text, rule.pattern, -1), lambda piece: F.length(piece))
        checked = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda part: F.length(part))
        steps = F.arrays_zip(F.transform(hits, lambda hit: F.length(hit)).alias("hit"), checked.alias("part"), pieces.alias("gap"))
        return F.flatten(bound(steps, in_chunks))

    def in_chunks(steps: Column) -> Column:
        """Running sums within CHUNK steps, from where the steps before end, so that no array grows by one element many times."""
        n = F.size(steps)
        parts = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / CHUNK), F.lit(0)).cast("int")), lambda k: F.slice(steps, k * CHUNK + 1, CHUNK))
        length = lambda part: F.aggregate(part, F.lit(0), lambda total, x: total + x["gap"] + F.coalesce(x["hit"], F.lit(0)))
        lengths = F.transform(parts, length)
        ends = F.aggregate(lengths, F.array(F.lit(0)), lambda all_, x: F.concat(all_, F.array(F.element_at(all_, -1) + x)))
        return bound(ends, lambda at: F.transform(parts, lambda part, k: of_chunk(part, F.get(at, k))))

    def of_chunk(steps: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast(SPANS).alias("found"))
        return F.aggregate(steps, start, step)["found"]

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.coalesce(x["hit"], F.lit(0))
        one = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("stop")))
        good = F.coalesce(x["part"] >= rule.at_least, F.lit(False))
        return F.struct(end.alias("at"), F.when(good, F.concat(state["found"], one)).otherwise(state["found"]).alias("found"))

    none = F.array().cast(SPANS)
    every = bound(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), walk)
    return F.when(F.rlike(text, F.lit(rule.pattern)), every).otherwise(none)


def addressed(versions: DataFrame, path: str, text: str) -> DataFrame:
    """path, text (null as empty) and blob."""
    content = F.coalesce(F.col(text), F.lit(""))
    return versions.select(F.col(path).alias("path"), content.alias("content"), F.sha2(content, 256).alias("blob"))


def unseen(versions: DataFrame, ledger: DataFrame | None, rules=RULES) -> DataFrame:
    """blob, one path that holds it, and the rules (kind@version) that the ledger lacks for it.

    Copies are reduced to one path a blob before the shuffle.
    """
    every = F.array(*[F.lit(r.key) for r in rules])
    blobs = versions.groupBy("blob").agg(F.min("path").alias("holder"))
    if ledger is None:
        return blobs.withColumn("todo", every)
    done = ledger.groupBy("blob").agg(F.collect_set("rule").alias("done"))
    todo = F.array_except(every, F.coalesce(F.col("done"), F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "holder", todo.alias("todo")).where(F.size("todo") > 0)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """versions: as addressed() gives them. Returns new findings and new ledger rows.

    Findings: blob and spans, for blobs with any. Ledger: blob and rule, one row
    for each pair scanned now; append it to the ledger once findings are stored.
    """
    todo = stored(unseen(versions, ledger, rules))
    pending = {row["rule"] for row in todo.select(F.explode("todo").alias("rule")).distinct().collect()}  # one for each rule at most
    own = [(i, r) for i, r in enumerate(rules) if r.key in pending]
    hit = reduce(lambda a, b: a | b, [F.rlike("content", F.lit(r.pattern)) for _, r in own], F.lit(False))
    # Texts that no pending rule hits stay where they are; only the others meet the ledger's answer.
    one = versions.where(hit).join(todo.withColumnRenamed("blob", "__blob"), (F.col("blob") == F.col("__blob")) & F.col("path").eqNullSafe(F.col("holder")))
    none = F.array().cast(SPANS)
    found = F.concat(none, *[F.when(F.array_contains("todo", r.key), spans(F.col("content"), r, i)).otherwise(none) for i, r in own])
    findings = one.select("blob", F.sort_array(found).alias("spans")).where(F.size("spans") > 0)
    return findings.groupBy("blob").agg(F.first("spans").alias("spans")), todo.select("blob", F.explode("todo").alias("rule"))


def paths_with_findings(versions: DataFrame, findings: DataFrame) -> DataFrame:
    """path, blob and spans for every path, an empty array where there is nothing."""
    kept = versions.select("path", "blob")
    return kept.join(findings, "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scanned(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES, batches=None) -> tuple[DataFrame, DataFrame]:
    """Findings and ledger of several scans, one for each batch of rules, each of which skips what the ledger has by then."""
    findings = None
    for own in batches or (rules,):
        new, pairs = scan(versions, ledger, own)
        ledger = stored(pairs if ledger is None else ledger.unionByName(pairs))
        findings = new if findings is None else findings.unionByName(new)
    every = findings.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    return every, ledger


def digest(docs: DataFrame) -> DataFrame:
    """The findings of every document, as counts, a hash of the base spans, and all spans.

    The base rules are scanned first; the method's own rules then find the base
    pairs in the ledger and scan the others only.
    """
    versions = addressed(docs, "doc_id", "text")
    base = [i for i, r in enumerate(RULES) if r.base]
    findings, _ = scanned(versions, batches=(tuple(RULES[i] for i in base), RULES))
    in_base = F.filter("spans", lambda s: s["rank"].isin(base))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return paths_with_findings(versions, findings).select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(_joined(in_base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )
