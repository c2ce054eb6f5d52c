"""What a task of the source divergence holds."""

from collections import Counter

import numpy as np
import pyarrow as pa

from seriesloom.llm import divergence


def test_counting_holds_little_of_a_large_vocabulary():
    """900,000 different words in 450 documents: the task passes rows on long before it holds them all."""
    waiting, words, n = [], 0, Counter()

    def batches():
        for i in range(450):
            waiting.append(2000 * i - words)
            text = " ".join(["every", *(f"word{i}x{j}" for j in range(2000))]).encode()
            yield pa.RecordBatch.from_pydict({"lang": pa.array([1], pa.int64()), "source": pa.array([i % 2], pa.int64()), "text": pa.array([text], pa.binary())})

    for out in divergence.counted(batches(), 3):
        records, row = divergence._unpack(out.column("groups"), divergence.OF_CHUNK)
        chunk = out.column("chunk")
        words += out.num_rows
        for r in np.flatnonzero([c == b"every" for c in chunk.to_pylist()]):
            for record in records[row == r]:
                n[int(record["source"])] += int(record["n"])
    assert n == {0: 225, 1: 225} and words >= 900_000
    assert max(waiting) < 600_000
