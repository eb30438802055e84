"""Mixing sources to target weights by hierarchical budgeting.

Weights run down a tree of domain, language and source. A node's budget goes to its children by weight; a
child that cannot hold its share (all its tokens, ``max_epochs`` times over) is filled, and the rest goes to
its siblings by weight until none is left over. What a node's whole subtree cannot hold is known before, so it
is handed to that node's own siblings: siblings first, then ancestors. Each leaf then takes the
prefix, by tokens, of its documents in a seeded order that is new in every epoch.

The prefix needs no task that sees a whole leaf: an order key's leading digits deal a leaf into many slices,
slice totals are summed up, whole slices below the budget are taken, and only the slice in which the budget ends
is put in order row by row.

Defined cases: a null text has no tokens and a row without tokens is never selected; a null language, source
or id is the word ``null``; rows with equal order keys are ordered by id, tokens and checksum; rows equal in all of these
may stand for each other; weights of 0 and domains without weight give nothing; an empty table gives an empty
result; other columns are carried by ``select_rows`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch, text_of

SEED = 7
SHARE = 0.8
MAX_EPOCHS = 2
# Leading hex digits of the order key that deal a leaf into slices.
SLICE_DIGITS = 3
# The tree is configuration. More leaves than this mean that a column is no source name.
MOST_LEAVES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """Weights by domain, by language and by source; names that are not listed get ``other``."""

    domains: Mapping[str, float] = field(default_factory=dict)
    langs: Mapping[str, float] = field(default_factory=dict)
    sources: Mapping[str, float] = field(default_factory=dict)
    other: float = 1.0

    def weights(self, level: int) -> Mapping[str, float]:
        return (self.domains, self.langs, self.sources)[level]


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_domain(source: Column) -> Column:
    """Source names end in a number; its remainder by 4 names the domain. Names without a number share one."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("long"), F.lit(4)))).otherwise(F.lit("unnumbered"))


def share_out(amount: int, wants: list[tuple[str, float, int]]) -> dict[str, int]:
    """Whole tokens for each (name, weight, capacity): by weight, full ones first, what is over to the rest."""
    given = {name: 0 for name, _, _ in wants}
    left = min(amount, sum(cap for _, weight, cap in wants if weight > 0))
    open_ = sorted((name, weight, cap) for name, weight, cap in wants if weight > 0 and cap > 0)
    while left > 0 and open_:
        total = sum(weight for _, weight, _ in open_)
        full = [w for w in open_ if w[2] <= left * w[1] / total]
        if full:
            for name, _, cap in full:
                given[name] = cap
                left -= cap
            open_ = [w for w in open_ if w not in full]
            continue
        exact = {name: left * weight / total for name, weight, _ in open_}
        for name, share in exact.items():
            given[name] = int(share)
        rest = left - sum(int(share) for share in exact.values())
        for name in sorted(exact, key=lambda n: (int(exact[n]) - exact[n], n))[:rest]:
            given[name] += 1
        left = 0
    return given


def leaf_budgets(totals: Mapping[tuple[str, ...], int], amount: int, mixture: Mixture, epochs: int) -> dict[tuple[str, ...], int]:
    """Budget of every leaf, from the token totals of the leaves."""

    def down(prefix: tuple[str, ...], amount: int) -> dict[tuple[str, ...], int]:
        level = len(prefix)
        if level == 3:
            return {prefix: amount}
        held: dict[str, int] = {}
        for leaf, capacity in capacities.items():
            if leaf[:level] == prefix:
                held[leaf[level]] = held.get(leaf[level], 0) + capacity
        weights = mixture.weights(level)
        shares = share_out(amount, [(name, weights.get(name, mixture.other), cap) for name, cap in held.items()])
        return {leaf: budget for name, share in shares.items() for leaf, budget in down((*prefix, name), share).items()}

    capacities = {leaf: _usable(leaf, mixture) * tokens * epochs for leaf, tokens in totals.items()}
    return down((), min(amount, sum(capacities.values())))


def _usable(leaf: tuple[str, ...], mixture: Mixture) -> int:
    return int(all(mixture.weights(level).get(name, mixture.other) > 0 for level, name in enumerate(leaf)))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id))


def _select(docs: DataFrame, mixture: Mixture, share: float, epochs: int, seed: int, domain, carried: list[str]) -> tuple[DataFrame, Scratch]:
    """Each taken row as ``row``, with its leaf, tokens, epoch and order key."""
    scratch = Scratch(docs.sparkSession, "mix")
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        count_words(text_of("text")).alias("tokens"),
        F.crc32(text_of("text").cast("binary")).alias("crc"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("null")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("null")).alias("source"),
    )
    leaves = ["domain", "lang", "source"]
    # Counted once; the passes below read what they need of it.
    sized = scratch.put(named.withColumn("domain", domain(F.col("source"))), "sized").where(F.col("tokens") > 0)
    sums = sized.groupBy(*leaves).agg(F.sum("tokens").alias("tokens")).limit(MOST_LEAVES + 1).collect()
    if len(sums) > MOST_LEAVES:
        raise ValueError("the mixture tree has too many leaves")
    totals = {(r["domain"], r["lang"], r["source"]): r["tokens"] for r in sums}
    budgets = leaf_budgets(totals, int(share * sum(totals.values())), mixture, epochs)
    plan = [(*leaf, budget, totals[leaf], budget // totals[leaf]) for leaf, budget in budgets.items() if budget > 0]
    planned = docs.sparkSession.createDataFrame(
        plan, "domain string, lang string, source string, budget long, held long, whole long"
    )
    # Leaves are configuration, at most MOST_LEAVES rows.
    due = sized.join(F.broadcast(planned), leaves)
    # Whole epochs take every row; the last one takes the prefix of what is left of the budget.
    tried = due.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int"))))
    keyed = tried.withColumn("key", order_key(seed, F.col("epoch"), F.col("id"))).withColumns(
        {
            "slice": F.substring("key", 1, SLICE_DIGITS),
            "rest": F.col("budget") - F.col("whole") * F.col("held"),
            "is_last": F.col("epoch") == F.col("whole"),
        }
    )
    slices = keyed.where("is_last").groupBy(*leaves, "rest", "slice").agg(F.sum("tokens").alias("slice_tokens"))
    running = Window.partitionBy(*leaves).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("before", F.coalesce(F.sum("slice_tokens").over(running), F.lit(0)))
    begun = starts.where(F.col("before") < F.col("rest"))
    edges = begun.groupBy(*leaves).agg(F.max("slice").alias("edge"), F.max("before").alias("before"))
    # One row per leaf.
    bounded = keyed.join(F.broadcast(edges), leaves, "left")
    taken = bounded.where(~F.col("is_last") | (F.col("slice") < F.col("edge")))
    upto = Window.partitionBy(*leaves).orderBy("key", "id", "tokens", "crc").rowsBetween(Window.unboundedPreceding, 0)
    edge = bounded.where(F.col("is_last") & (F.col("slice") == F.col("edge")))
    cut = edge.withColumn("reached", F.col("before") + F.sum("tokens").over(upto)).where(F.col("reached") <= F.col("rest"))
    columns = ["row", *leaves, "tokens", "epoch", "key"]
    return taken.select(*columns).unionByName(cut.select(*columns)), scratch


def mix(
    docs: DataFrame,
    mixture: Mixture | None = None,
    share: float = SHARE,
    epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domain=source_domain,
) -> DataFrame:
    """One row for each time a document is taken: doc_id, domain, lang, source, n_tokens, epoch, order_key."""
    taken, scratch = _select(docs, mixture or Mixture(), share, epochs, seed, domain, ["doc_id"])
    rows = taken.select(
        F.col("row.doc_id").alias("doc_id"),
        "domain",
        "lang",
        "source",
        F.col("tokens").alias("n_tokens"),
        F.col("epoch").cast("int").alias("epoch"),
        F.col("key").alias("order_key"),
    )
    return scratch.result(rows)


def select_rows(
    docs: DataFrame,
    mixture: Mixture | None = None,
    share: float = SHARE,
    epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domain=source_domain,
) -> DataFrame:
    """The taken rows of ``docs``, once for each epoch, with their columns as they were."""
    taken, scratch = _select(docs, mixture or Mixture(), share, epochs, seed, domain, docs.columns)
    return scratch.result(taken.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
