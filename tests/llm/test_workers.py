"""What tasks leave behind in a Python worker, and hashes whatever the block."""

import re
import types
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tessella.llm import decontaminate, near_duplicates, text
from tessella.llm.workers import give_back, lean


def own_mb():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def batches(n, words=600):
    rng = np.random.default_rng(4)
    for k in range(n):
        texts = [" ".join(f"w{x}" for x in row) for row in rng.integers(0, 5000, (400, words)).tolist()]
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(range(400 * k, 400 * (k + 1)), pa.int64()), "text": texts})


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
@pytest.mark.parametrize("stage", ["scan", "profile"])
def test_a_task_leaves_its_worker_as_small_as_it_was(stage):
    bench = types.SimpleNamespace(value=decontaminate.phrases(["a"], [" ".join(f"w{x}" for x in range(40))], 13))
    task = {"scan": decontaminate._scan(bench, False, ["doc_id", "text"]), "profile": near_duplicates._profile(5)}[stage]
    for _ in lean(task)(batches(1)):  # tables that are made once
        pass
    give_back()
    before = own_mb()
    rows = 0
    for b in lean(task)(batches(10)):
        rows += b.num_rows
    del b
    assert rows >= 4000
    assert own_mb() - before < 16


def test_a_task_that_is_left_early_is_closed():
    seen = []

    def task(found):
        try:
            yield from found
        finally:
            seen.append(True)

    it = lean(task)(batches(2))
    next(it)
    it.close()
    assert seen == [True]


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    buf = np.frombuffer(b"ab  cdef g " * 50 + b"x" * 700, np.uint8)
    starts, ends, _ = text.word_spans(buf, np.array([0, len(buf)]), text.NON_SPACE)
    found = []
    for block in (1 << 4, 1 << 10, 1 << 20):
        monkeypatch.setattr(text, "_HASH_BLOCK", block)
        monkeypatch.setattr(text, "_POWERS", {})
        found.append(text.hash_spans(buf, starts, ends))
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()
    assert found[0][0] == found[0][3]
