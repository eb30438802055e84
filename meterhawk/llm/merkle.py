"""Merkle manifest of a dataset by checkpoint and recompute.

Leaves are hashed where the rows are, numbered within their tree and dealt into aligned runs of ``2 ** STEP``. Of the
levels of a tree only every ``STEP``-th is written; a run's row holds its nodes in order, and hashing them pairwise
upwards gives the node that stands for the run on the next written level. Proofs go the other way: from the root down,
each run meets the proof of its top node, regenerates the unwritten nodes between, hands every node its siblings
followed by that proof, and throws the regenerated nodes away. The largest thing a task holds is a run.

An odd last node is hashed alone, and a tree of one leaf is its own root. Tops of trees, in the order of their keys, are
the leaves of one more tree, built by the same steps.

Numbers come from a range partitioning: a row's place in its sorted partition, and the counts of the partitions
before it. The only thing that is summed in one place is a row per partition and tree.

Defined cases: a null tree key is a tree of its own, the first; rows of a tree are ordered by id, null first, then by leaf, so
that ties are equal rows and interchangeable; repeated rows are separate leaves; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch

STEP = 8
_MEMBERS = "array<struct<at:bigint,id:bigint,digest:string,altered:string>>"


def field(value: Column) -> Column:
    """A value with its length in front, so that neighbours cannot run into each other."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def tree_key(column: Column) -> Column:
    """Never null, and in byte order with null first."""
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), column.cast("string")))


def _hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def heights(n: int) -> int:
    """Levels above ``n`` nodes."""
    return max(n - 1, 0).bit_length()


def regrow(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and ``levels`` levels above them."""
    grown = [nodes]
    for _ in range(levels):
        below = grown[-1]
        grown.append([_hash(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return grown


def siblings(grown: list[list[str]], at: int) -> list[str]:
    """What node ``at`` needs to reach the top: each entry tells the side a sibling stands on; empty where none does."""
    out = []
    for level in grown[:-1]:
        other = at ^ 1
        out.append("" if other >= len(level) else ("L" if other < at else "R") + level[other])
        at >>= 1
    return out


def fold(leaf: str, proof: list[str]) -> str:
    """The root a leaf and its proof lead to."""
    for entry in proof:
        leaf = _hash(entry[1:], leaf) if entry[:1] == "L" else _hash(leaf, entry[1:])
    return leaf


def number_leaves(leaves: DataFrame, scratch: Scratch, order_by: tuple[str, ...]) -> DataFrame:
    """Add ``at`` (from 0 in each tree) and ``n`` (leaves of the tree) to leaves (tree, id, digest, altered)."""
    # The last key parts rows that are equal in all others.
    spread = leaves.withColumn("any", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("tree", *order_by)]
    sorted_rows = spread.repartitionByRange(*order, "any").sortWithinPartitions(*order).drop("any")
    placed = scratch.put(sorted_rows.withColumn("row", F.monotonically_increasing_id()), "sorted")
    placed = scratch.same(placed, placed.withColumn("part", F.shiftright("row", 33)))
    parts = placed.groupBy("part", "tree").agg(F.count("*").alias("held"), F.min("row").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", "tree", "first", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"),
        F.sum("held").over(Window.partitionBy("tree")).alias("n"),
    )
    return placed.join(parts, ["part", "tree"]).select(
        "tree", "id", "digest", "altered", (F.col("offset") + F.col("row") - F.col("first")).alias("at"), "n"
    )


def _climb(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for members, left in zip(batch.column("members").to_pylist(), batch.column("n").to_pylist(), strict=True):
                tops.append(regrow([m["digest"] for m in members], min(step, heights(left)))[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("tree", "run", "n", "members")] + [pa.array(tops, pa.string())],
                names=["tree", "run", "n", "members", "top"],
            )

    return run


def _runs(nodes: DataFrame, step: int) -> DataFrame:
    """Aligned runs of nodes (tree, at, n, id, digest, altered) with the node that stands for each above."""
    member = F.struct("at", "id", "digest", "altered")
    # A run has at most 2 ** step nodes.
    runs = nodes.groupBy("tree", F.shiftright("at", step).alias("run")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members"))
    return runs.mapInArrow(_climb(step), f"tree string, run bigint, n bigint, members {_MEMBERS}, top string")


def build(
    leaves: DataFrame, scratch: Scratch, step: int = STEP, name: str = "tree", order_by: tuple[str, ...] = ("id", "digest")
) -> list[DataFrame]:
    """The written levels of all trees, lowest first; the last has one run per tree, whose top is the tree's root."""
    numbered = number_leaves(leaves, scratch, order_by)
    levels = [scratch.put(_runs(numbered, step), f"{name}-0")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1 << step:
        most = -(-most >> step)
        above = levels[-1].select(
            "tree", F.col("run").alias("at"), F.shiftright(F.col("n") + (1 << step) - 1, step).alias("n"),
            F.lit(None).cast("long").alias("id"), F.col("top").alias("digest"), F.lit(None).cast("string").alias("altered"),
        )
        levels.append(scratch.put(_runs(above, step), f"{name}-{len(levels)}"))
    return levels


def _descend(step: int):
    """Proofs of a run's nodes; for leaves also the figures of the proof."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                members, above = row["members"], row["proof"]
                grown = regrow([m["digest"] for m in members], min(step, heights(row["n"])))
                proofs = [siblings(grown, i) + above for i in range(len(members))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": [row["tree"]] * len(members), "at": [m["at"] for m in members], "id": [m["id"] for m in members],
                        "digest": [m["digest"] for m in members], "altered": [m["altered"] for m in members],
                        "subroot": [row["subroot"]] * len(members), "root": [row["root"]] * len(members), "proof": proofs,
                    },
                    schema=_PROVED,
                )

    return run


_PROVED = pa.schema(
    [("tree", pa.string()), ("at", pa.int64()), ("id", pa.int64()), ("digest", pa.string()), ("altered", pa.string()),
     ("subroot", pa.string()), ("root", pa.string()), ("proof", pa.list_(pa.string()))]
)
_PROVED_SQL = "tree string, at bigint, id bigint, digest string, altered string, subroot string, root string, proof array<string>"


def proofs(levels: list[DataFrame], tops: DataFrame, scratch: Scratch, step: int = STEP) -> DataFrame:
    """Every leaf with its proof. ``tops`` (tree, subroot, root, proof) has what follows after each tree's own root."""
    known = tops.select("tree", F.lit(0).cast("long").alias("run"), "subroot", "root", "proof")
    for n, level in reversed(list(enumerate(levels))):
        met = level.select("tree", "run", "n", "members").join(known, ["tree", "run"])
        found = met.mapInArrow(_descend(step), _PROVED_SQL)
        if n == 0:
            return found
        above = scratch.put(found.select("tree", F.col("at").alias("run"), "subroot", "root", "proof"), f"proofs-{n}")
        known = above
    raise ValueError("a tree has one level at least")


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        folded = [fold(r["altered"] or r["digest"], r["proof"]) for r in rows]
        yield pa.RecordBatch.from_pydict(
            {
                "id": [r["id"] for r in rows], "leaf": [r["digest"] for r in rows], "subroot": [r["subroot"] for r in rows],
                "root": [r["root"] for r in rows], "proof_sha256": [_hash(*[e[1:] for e in r["proof"]]) for r in rows],
                "folded_root": folded, "verified": [f == r["root"] for f, r in zip(folded, rows, strict=True)],
            }
        )


def manifest(leaves: DataFrame, step: int = STEP) -> DataFrame:
    """Every leaf's place in the manifest. ``leaves``: tree, id, digest, and altered, the digest to verify in its stead or null.

    Returns id, leaf, subroot, root, proof_sha256, folded_root (from the altered digest, if any) and verified.
    """
    scratch = Scratch(leaves.sparkSession, "merkle")
    levels = build(leaves.select("tree", F.col("id").cast("long").alias("id"), "digest", "altered"), scratch, step, "trees")
    # One row per tree.
    subroots = scratch.put(levels[-1].select("tree", F.col("top").alias("subroot")), "subroots")
    # Trees are leaves of the manifest's own tree, ordered by their keys, which go along in the column of the altered digest.
    own = subroots.select(
        F.lit("").alias("tree"), F.lit(None).cast("long").alias("id"), F.col("subroot").alias("digest"), F.col("tree").alias("altered")
    )
    top_levels = build(own, scratch, step, "top", ("altered",))
    top = top_levels[-1].select("tree", F.lit("").alias("subroot"), F.col("top").alias("root"), F.array().cast("array<string>").alias("proof"))
    tops = proofs(top_levels, top, scratch, step).select(F.col("altered").alias("tree"), F.col("digest").alias("subroot"), "root", "proof")
    proved = proofs(levels, scratch.put(tops, "tops"), scratch, step)
    checked = proved.mapInArrow(
        _check, "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return scratch.result(checked)


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaves of a documents table, one tree per language; where ``tampered`` holds, also the leaf of a changed n_chars."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    changed = [F.col(n) + 1 if n == "n_chars" else F.col(n) for n in names]
    return docs.select(
        tree_key(F.col("lang")).alias("tree"), F.col("doc_id").alias("id"), leaf_hash(*[F.col(n) for n in names]).alias("digest"),
        F.when(tampered, leaf_hash(*changed)).alias("altered"),
    )
