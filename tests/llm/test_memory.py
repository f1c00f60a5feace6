import os
from pathlib import Path

import pyarrow as pa

from coinweir.llm import packing, repeats
from coinweir.llm.memory import keep_only


def held():
    """MB of memory that this process has."""
    return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGESIZE") / 1e6


def churn():
    """Takes and frees 150 MB in small blocks and 150 in Arrow's; a block that stays keeps the heap from shrinking by itself."""
    blocks = [os.urandom(1000) for _ in range(150_000)]
    last = os.urandom(1000)
    arrays = [pa.array([os.urandom(100_000)]) for _ in range(1500)]
    most = held()
    del blocks, arrays
    return last, most


def test_freed_memory_goes_back_where_a_task_begins():
    last, most = churn()
    keep_only()
    assert last and held() < most - 200


def test_freed_memory_goes_back_where_a_task_ends():
    rows = pa.RecordBatch.from_pydict({"document": [1], "text": ["word " * 100]})
    last = []

    def batches():
        yield rows
        last.append(churn())

    assert sum(batch.num_rows for batch in repeats._pieces(200)(batches())) > 0
    assert held() < last[0][1] - 200


def test_an_encoder_is_given_back_by_another_operator():
    class Kept:
        gone = False

        def __del__(self):
            Kept.gone = True

    packing._encoders["some path"] = Kept()
    keep_only("packing")
    assert "some path" in packing._encoders and not Kept.gone
    keep_only()
    assert not packing._encoders and Kept.gone
