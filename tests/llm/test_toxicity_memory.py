import tracemalloc

import pyarrow as pa

from adlake.llm import toxicity


def test_features_of_a_batch_take_the_memory_of_a_piece():
    column = pa.array(["some words of a text that is not long " * 40] * 1500)
    tracemalloc.start()
    slots = toxicity.feature_slots(column)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(slots) == 1500 and len({tuple(s) for s in slots.to_pylist()}) == 1
    assert most < 40e6
