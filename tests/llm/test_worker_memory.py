"""What a Python worker keeps when its task has ended."""

import re

import numpy as np
import pyarrow as pa

from replyloom.llm.common import per_batch


def _kept():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024


def test_freed_memory_goes_back():
    def work(batch):
        # many small pieces, freed but for the last, which lies above them
        pieces = [np.ones(12_000) for _ in range(1500)]
        work.last = pieces[-1]
        return batch

    before = _kept()
    assert sum(b.num_rows for b in per_batch(work)(iter([pa.RecordBatch.from_pydict({"text": ["a"]})]))) == 1
    assert _kept() - before < 60  # 144 MB stayed
