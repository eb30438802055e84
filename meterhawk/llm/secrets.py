"""Secret scans over an incremental blob ledger.

Every version of a text is a blob, named by the SHA-256 of its content; equal texts on any number of paths are one
blob. The ledger remembers which rule in which version has scanned which blob, and the spans it found. A run scans
only pairs of blob and rule version that the ledger does not hold: a first run scans all, a later one only new blobs,
and a changed rule is run over all blobs while the others rest. Findings are joined back to all paths of a blob.

A ledger row is one blob and the scans one run made of it: ``blob``, ``scans`` (kind, version, spans). Rows are only
ever added; of rows that tell the same scan one is used.

A rule's matches are the leftmost, non-overlapping ones of its pattern; a match whose group is shorter than ``least``
code points is dropped after matching. Positions come from the texts between matches: code points from 0, ends exclusive.

Blobs are brought together with one row of a blob per map task, so a text that a third of all rows hold
is not gathered in one task; the join back to the paths carries digests only.

Everything is DataFrame functions. Defined cases: a null text is the empty text, whose blob is scanned like any other;
null and repeated ids keep one result row each; repeated rows are paths of one blob; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch, text_of

LEDGER_SCHEMA = "blob string, scans array<struct<kind:string,version:int,spans:array<struct<start:bigint,end:bigint>>>>"


@dataclass(frozen=True)
class Rule:
    """``least`` code points of ``group`` make a match a finding."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1


# The base rules, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=16),
    # Only whole runs of 32 and more can match, as the pattern is greedy and holds one class.
    Rule("hex", "[0-9a-f]{32,}", least=32),
)
# Further kinds with a fixed form of their own.
EXTRA_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + EXTRA_RULES


def _spans(text: Column, matches: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the matches that are long enough."""

    def measured(match: Column, gap: Column) -> Column:
        held = match if rule.group == 0 else F.regexp_extract(match, rule.pattern, rule.group)
        return F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), (F.length(held) >= rule.least).alias("found"))

    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matches))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + m["size"]
        added = F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(end.alias("at"), F.when(m["found"], added).otherwise(state["spans"]).alias("spans"))

    folded = F.aggregate(F.zip_with(matches, gaps, measured), zero, step, lambda state: state["spans"])
    return F.when(F.size(matches) > 0, folded).otherwise(none)


def _label(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def blobs_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(blob, text), one row per distinct text."""
    text = text_of(text_col)
    return docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])


def unseen(blobs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """``blobs`` that some rule version has not scanned, with the labels of those that have."""
    if ledger is None:
        return blobs.withColumn("seen", F.array().cast("array<string>"))
    labels = F.transform("scans", lambda s: F.concat_ws("@", s["kind"], s["version"].cast("string")))
    wanted = F.array(*[F.lit(_label(r)) for r in rules])
    # At most one label per rule stays of a blob.
    held = ledger.select("blob", F.explode(F.array_intersect(labels, wanted)).alias("label"))
    seen = held.groupBy("blob").agg(F.collect_set("label").alias("seen"))
    joined = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    return joined.where(F.size("seen") < len(rules))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, seen): a scan of every rule version that is not in ``seen``."""
    found = blobs
    for n, rule in enumerate(rules):
        due = ~F.array_contains("seen", _label(rule))
        found = found.withColumn(f"matches_{n}", F.when(due, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))))
    scans = [
        F.when(
            F.col(f"matches_{n}").isNotNull(),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _spans(F.col("text"), F.col(f"matches_{n}"), r).alias("spans")),
        )
        for n, r in enumerate(rules)
    ]
    return found.select("blob", F.array_compact(F.array(*scans)).alias("scans"))


def new_scans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """The ledger rows that ``docs`` add to ``ledger``; the caller appends them to it."""
    kinds = [r.kind for r in rules]
    if not rules or len(set(kinds)) != len(kinds):
        raise ValueError("give every rule a kind of its own")
    return scan(unseen(blobs_of(docs, text_col), rules, ledger), rules)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): what the given rule versions found, by start, then in the rules' order."""
    order = {r.kind: n for n, r in enumerate(rules)}
    place = F.lit(None).cast("int")
    of_scan = lambda s: F.concat_ws("@", s["kind"], s["version"].cast("string"))
    wanted = F.array(*[F.lit(_label(r)) for r in rules])

    def placed(kind: Column) -> Column:
        out = place
        for name, n in order.items():
            out = F.when(kind == name, F.lit(n)).otherwise(out)
        return out

    def spread(s: Column) -> Column:
        return F.transform(
            s["spans"],
            lambda x: F.struct(x["start"].alias("start"), placed(s["kind"]).alias("place"), x["end"].alias("end"), s["kind"].alias("kind")),
        )

    current = F.filter("scans", lambda s: F.array_contains(wanted, of_scan(s)))
    flat = ledger.select("blob", F.flatten(F.transform(current, spread)).alias("spans"))
    # A blob has as many rows as there were runs that scanned it.
    gathered = flat.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return gathered.select("blob", F.sort_array(F.array_distinct("spans")).alias("spans"))


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(one row per path with its blob and spans, the new ledger rows). Both are staged tables the caller owns."""
    scratch = Scratch(docs.sparkSession, "secrets")
    added = scratch.put(new_scans(docs, rules, ledger, text_col), "ledger")
    every = added if ledger is None else ledger.select("blob", "scans").unionByName(added)
    paths = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text_of(text_col), 256).alias("blob"))
    # Written first, so that the join stands alone and a blob of very many paths can be split.
    found = scratch.put(findings(every, rules), "findings")
    joined = scratch.put(paths.join(found, "blob", "left"), "paths")
    scratch.drop(found)
    return joined, added


def digest(paths: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The figures of each path."""
    names = [r.kind for r in base]

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    of_base = F.filter("spans", lambda s: s["kind"].isin(*names))
    counts = [count(k).alias(f"n_{k}") for k in names]
    return paths.select("doc_id", *counts, F.sha2(shown(of_base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
