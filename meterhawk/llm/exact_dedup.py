"""Grace hash deduplication: equal texts found by comparing complete content.

Records are dealt into buckets by content hash, first by Spark's shuffle, then, where a bucket holds more
content than ``table_bytes``, into spill files by further bits of the hash, until a bucket fits an
open-addressing table that compares whole contents. Before the shuffle each task folds the copies it sees
into one representative per chunk, so that a text that fills a third of the table reaches its bucket as a
few records, and every row finds its group through its own representative.

Defined cases: a null text is the empty text; a null id is below every id; of rows that share the
largest id of a group exactly one is kept; an empty table gives an empty result; other columns are carried
by ``keep_one`` whatever their names and are ignored by ``group_copies``.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhawk.llm.common import Scratch, giving_back

TABLE_BYTES = 48 << 20
CHUNK_BYTES = 24 << 20
FAN_OUT_BITS = 4
LAST_LEVEL = 40

_LOWEST_ID = -(2**63)
_HEAD = struct.Struct("<qqqI")


class ContentTable:
    """Open addressing with linear probing; a slot matches only if the complete contents are equal."""

    def __init__(self) -> None:
        self.keys = array("q")
        self.contents: list[bytes] = []
        self.bytes = 0
        self._slots = array("q", [-1]) * 1024

    def find(self, key: int, content: bytes) -> int:
        """Number of the entry, or -1 - (its free slot)."""
        mask = len(self._slots) - 1
        slot = key & mask
        while (entry := self._slots[slot]) >= 0:
            if self.keys[entry] == key and self.contents[entry] == content:
                return entry
            slot = (slot + 1) & mask
        return -1 - slot

    def add(self, free: int, key: int, content: bytes) -> int:
        self._slots[-1 - free] = entry = len(self.keys)
        self.keys.append(key)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.keys) > len(self._slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self._slots = array("q", [-1]) * (2 * len(self._slots))
        mask = len(self._slots) - 1
        for entry, key in enumerate(self.keys):
            slot = key & mask
            while self._slots[slot] >= 0:
                slot = (slot + 1) & mask
            self._slots[slot] = entry


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("content").nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _fold_task(names: list[str], chunk_bytes: int):
    """Adds each row's digest, the key of its chunk's representative, and the content of representatives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 33
        for chunk in _chunks(batches, chunk_bytes):
            table, digests, entry_of = ContentTable(), [], []
            best: list[tuple[int, int]] = []
            counts: list[int] = []
            ids = chunk.column("id").to_pylist()
            for row, content in enumerate(chunk.column("content").to_pylist()):
                digest = hashlib.sha256(content).digest()
                entry = table.find(key := _key(digest), content)
                if entry < 0:
                    entry = table.add(entry, key, content)
                    best.append((_LOWEST_ID - 1, 0))
                    counts.append(0)
                rank = _LOWEST_ID if ids[row] is None else ids[row]
                best[entry] = max(best[entry], (rank, -row))
                counts[entry] += 1
                digests.append(digest)
                entry_of.append(entry)
            leads = [-best[entry][1] == row for row, entry in enumerate(entry_of)]
            columns = {name: chunk.column(name).combine_chunks() for name in names}
            columns["rep"] = pa.array([base + entry for entry in entry_of], pa.int64())
            columns["leads"] = pa.array(leads)
            columns["copies"] = pa.array([counts[e] for e in entry_of], pa.int64())
            columns["digest"] = pa.array(digests, pa.binary())
            columns["content"] = pa.array(
                [table.contents[e] if lead else None for e, lead in zip(entry_of, leads, strict=True)], pa.binary()
            )
            base += len(counts)
            yield from pa.table(columns).to_batches(max_chunksize=1000)

    return run


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("rep", "id", "copies", "digest", "content")]
        yield from zip(*columns, strict=True)


def _spilled(path: str) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    with open(path, "rb") as file:
        while head := file.read(_HEAD.size):
            rep, best, copies, size = _HEAD.unpack(head)
            yield rep, best, copies, file.read(32), file.read(size)


def _solve(records, level: int, table_bytes: int, folder: str) -> Iterator[tuple[int, int, int, bool]]:
    """(representative, id that stays, group size, whether this representative is the one that stays)."""
    table = ContentTable()
    reps, entries = array("q"), array("q")
    best: list[tuple[int, int]] = []
    sizes = array("q")
    spills: dict[int, tuple[str, object]] = {}
    for rep, row_id, copies, digest, content in records:
        rank = _LOWEST_ID if row_id is None else row_id
        entry = table.find(key := _key(digest), content)
        if entry < 0:
            if table.contents and table.bytes + len(content) > table_bytes and level < LAST_LEVEL:
                part = int.from_bytes(digest, "big") >> (FAN_OUT_BITS * level) & ((1 << FAN_OUT_BITS) - 1)
                if part not in spills:
                    path = os.path.join(folder, f"{level}-{part}-{rep}")
                    spills[part] = (path, open(path, "wb"))  # noqa: SIM115
                file = spills[part][1]
                file.write(_HEAD.pack(rep, rank, copies, len(content)) + digest + content)
                continue
            entry = table.add(entry, key, content)
            best.append((_LOWEST_ID - 1, 0))
            sizes.append(0)
        best[entry] = max(best[entry], (rank, -rep))
        sizes[entry] += copies
        reps.append(rep)
        entries.append(entry)
    for rep, entry in zip(reps, entries, strict=True):
        rank, lead = best[entry]
        yield rep, rank, sizes[entry], -lead == rep
    del table
    for _, file in spills.values():
        file.close()
    for path, _ in spills.values():
        yield from _solve(_spilled(path), level + 1, table_bytes, folder)
        os.remove(path)


def _bucket_task(table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            held: list[tuple[int, int, int, bool]] = []

            def batch() -> pa.RecordBatch:
                rep, keep, size, wins = zip(*held, strict=True)
                keep_ids = [None if k == _LOWEST_ID else k for k in keep]
                return pa.RecordBatch.from_arrays(
                    [pa.array(rep, pa.int64()), pa.array(keep_ids, pa.int64()), pa.array(size, pa.int64()), pa.array(wins)],
                    names=["rep", "keep_id", "group_size", "wins"],
                )

            for answer in _solve(_records(batches), 0, table_bytes, folder):
                held.append(answer)
                if len(held) == 10_000:
                    yield batch()
                    held.clear()
            if held:
                yield batch()

    return run


def _fold(rows: DataFrame, scratch: Scratch, chunk_bytes: int) -> DataFrame:
    names = [c for c in rows.columns if c != "content"]
    schema = T.StructType(
        [rows.schema[c] for c in names]
        + [
            T.StructField("rep", T.LongType()),
            T.StructField("leads", T.BooleanType()),
            T.StructField("copies", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
    return scratch.put(rows.mapInArrow(giving_back(_fold_task(names, chunk_bytes)), schema), "folded")


def _resolve(folded: DataFrame, table_bytes: int) -> DataFrame:
    leads = folded.where("leads").select("rep", "id", "copies", "digest", "content")
    dealt = leads.repartition(F.xxhash64("digest"))
    return dealt.mapInArrow(giving_back(_bucket_task(table_bytes)), "rep long, keep_id long, group_size long, wins boolean")


def group_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "copies")
    content = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), content.alias("content"))
    folded = _fold(rows, scratch, chunk_bytes)
    answers = _resolve(folded, table_bytes)
    joined = folded.select("id", "rep", "leads", "digest").join(answers, "rep")
    return scratch.result(
        joined.select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("leads") & F.col("wins")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns as they were."""
    scratch = Scratch(docs.sparkSession, "copies")
    content = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        content.alias("content"),
        F.col(text_col).isNull().alias("no_text"),
        F.struct(*others).alias("row"),
    )
    folded = _fold(rows, scratch, chunk_bytes)
    winners = _resolve(folded, table_bytes).where("wins").select("rep")
    stays = folded.where("leads").join(winners, "rep", "left_semi")
    text = F.when(~F.col("no_text"), F.col("content").cast("string")).cast(docs.schema[text_col].dataType)
    columns = [text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return scratch.result(stays.select(*columns))
