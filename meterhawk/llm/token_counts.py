"""Token counts of documents in flat token files by separator scan.

A flat token file is a run of 16-bit ids, documents one after the other, each followed by an end-of-document id, with
no index. It is read as blocks cut without regard to documents. Each block is searched for the separator at once;
a prefix scan over the blocks' summaries (tokens, separators, place of the last separator) then gives every
block the tokens and documents before it and the start of the document it begins in, which stitches
documents that span blocks. The scan has two levels, runs of ``RUN_BLOCKS`` blocks and the runs of a file, so
that no task orders all blocks of a large file.

``write_flat`` makes such files of encoded documents, one per input partition, with a manifest of (file, place,
doc_id). Defined cases: a document without tokens counts 0; tokens after a file's last separator are one more document;
null and repeated ids are carried as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterhawk.llm import bpe
from meterhawk.llm.common import Scratch, text_of

BLOCK_TOKENS = 1 << 18
# Documents encoded at a time.
ENCODED_ROWS = 200
RUN_BLOCKS = 1024


def _flat_task(end: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        file, block, place, held = context.partitionId() if context else 0, 0, 0, bytearray()
        mark, size = np.array([end], "<u2").tobytes(), 2 * block_tokens

        def rows(numbers: list[int], blocks: list[bytes | None], ids: list[int | None]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * len(numbers), pa.int64()), pa.array(numbers, pa.int64()), pa.array(blocks, pa.binary()), pa.array(ids, pa.int64())],
                names=["file", "number", "tokens", "doc_id"],
            )

        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                held += np.frombuffer(ids, "<u4").astype("<u2").tobytes() + mark
                while len(held) >= size:
                    yield rows([block], [bytes(held[:size])], [None])
                    del held[:size]
                    block += 1
            count = batch.num_rows
            yield rows(list(range(place, place + count)), [None] * count, batch.column("doc_id").to_pylist())
            place += count
        if held:
            yield rows([block], [bytes(held)], [None])

    return run


def _encode_task(ranks: bytes, pattern: str):
    """(doc_id, ids) of (doc_id, text), a few documents at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.text_encoder(ranks, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ENCODED_ROWS):
                part = batch.slice(start, ENCODED_ROWS)
                ids = encoder.encode_many(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
        encoder.forget()

    return run


def write_flat(
    docs: DataFrame, end: int, scratch: Scratch, block_tokens: int = BLOCK_TOKENS, encode=None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(staged table, its blocks (file, number, tokens), its manifest (file, place, doc_id)) of (doc_id, ids).

    ``encode`` makes batches of (doc_id, ids) out of those of ``docs`` in the same worker, so that an executor holds half
    the processes.
    """
    flat = _flat_task(end, block_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return flat(encode(batches) if encode else batches)

    table = scratch.put(docs.mapInArrow(run, "file long, number long, tokens binary, doc_id long"), "flat")
    blocks = table.where("tokens IS NOT NULL").select("file", "number", "tokens")
    manifest = table.where("tokens IS NULL").select("file", F.col("number").alias("place"), "doc_id")
    return table, blocks, manifest


def _separators(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for block in batch.column("tokens").to_pylist():
                ids = np.frombuffer(block, "<u2")
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == end))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("number"), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                names=["file", "number", "size", "ends"],
            )

    return run


def count_tokens(blocks: DataFrame, end: int, scratch: Scratch) -> DataFrame:
    """(file, place, start, n_tokens) of every document in flat blocks (file, number, tokens)."""
    found = scratch.put(blocks.mapInArrow(_separators(end), "file long, number long, size long, ends array<long>"), "ends")
    runs = found.withColumns(
        {
            "run": F.call_function("div", F.col("number"), F.lit(RUN_BLOCKS)),
            "docs": F.size("ends").cast("long"),
            "last": F.try_element_at("ends", F.lit(-1)) + 1,
        }
    )
    inside = Window.partitionBy("file", "run").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("file", "run").agg(
        F.sum("size").alias("run_size"), F.sum("docs").alias("run_docs")
    )
    before_run = totals.select(
        "file", "run",
        F.coalesce(F.sum("run_size").over(of_file), F.lit(0)).alias("run_at"),
        F.coalesce(F.sum("run_docs").over(of_file), F.lit(0)).alias("run_place"),
    )
    placed = runs.join(before_run, ["file", "run"]).withColumns(
        {
            "at": F.col("run_at") + F.coalesce(F.sum("size").over(inside), F.lit(0)),
            "place": F.col("run_place") + F.coalesce(F.sum("docs").over(inside), F.lit(0)),
        }
    ).withColumn("last_at", F.col("at") + F.col("last"))
    run_last = placed.groupBy("file", "run").agg(F.max("last_at").alias("run_last"))
    open_run = run_last.select("file", "run", F.max("run_last").over(of_file).alias("open_run"))
    stitched = placed.join(open_run, ["file", "run"]).withColumn(
        "open", F.coalesce(F.greatest(F.max("last_at").over(inside), "open_run"), F.lit(0))
    )
    stops = F.transform("ends", lambda e: F.col("at") + e)
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: F.col("at") + e + 1))
    whole = stitched.select("file", "place", F.posexplode(F.arrays_zip(stops.alias("stop"), F.slice(starts, F.lit(1), F.size("ends")).alias("start"))).alias("nth", "doc")).select(
        "file", (F.col("place") + F.col("nth")).alias("place"), "doc.start", (F.col("doc.stop") - F.col("doc.start")).alias("n_tokens")
    )
    ending = stitched.groupBy("file").agg(
        F.max(F.col("at") + F.col("size")).alias("size"),
        F.max(F.col("place") + F.col("docs")).alias("place"),
        F.coalesce(F.max("last_at"), F.lit(0)).alias("start"),
    )
    rest = ending.where("size > start").select("file", "place", "start", (F.col("size") - F.col("start")).alias("n_tokens"))
    return whole.unionByName(rest)


def document_tokens(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and n_tokens of every document, counted in flat files of the documents' byte-level BPE ids."""
    scratch = Scratch(docs.sparkSession, "tokens")
    end = len(bpe.parse_ranks(ranks))
    if end >= 1 << 16:
        raise ValueError("16-bit files need a vocabulary below 65,536")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    _, blocks, manifest = write_flat(texts, end, scratch, encode=_encode_task(ranks, pattern))
    counted = count_tokens(blocks, end, scratch)
    return scratch.result(counted.join(manifest, ["file", "place"]).select("doc_id", "n_tokens"))
