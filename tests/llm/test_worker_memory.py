"""A worker outlives its tasks, so what a task has freed must not stay with it."""

import os

import pyarrow as pa

from meterhawk.llm import common


def _resident() -> int:
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_a_task_gives_freed_memory_back():
    kept = []

    def task(batches):
        for batch in batches:
            held = [bytes([i % 256]) * 2_000 for i in range(60_000)]
            # What lives on beyond the freed pieces keeps them from being returned by themselves.
            kept.append(held[-1])
            yield batch
            held.clear()

    batch = pa.RecordBatch.from_pydict({"a": [1]})
    before = _resident()
    assert list(task(iter([batch]))) == [batch]
    left = _resident() - before
    assert list(common.giving_back(task)(iter([batch]))) == [batch]
    assert left > 100_000_000 and _resident() - before < 30_000_000
