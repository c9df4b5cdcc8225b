"""A batch of texts is taken in stretches: what a worker holds does not follow the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.types import StructType

from millrace.llm import jaccard, quality
from millrace.llm.words import stretches
from tests.llm.cases import sentence


class Rows:
    """What the operators ask of a table, and the function they map over its batches."""

    schema, columns = StructType().add("key", "long").add("text", "string"), ["key", "text"]

    def mapInArrow(self, function, schema):  # noqa: N802
        self.function = function
        return self


def test_stretches_hold_every_row_once():
    texts = [None, "", "é" * 10, "a" * 100, None, "b", "c" * 5, ""]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["x", *texts, "y"], kind).slice(1, len(texts))
        for size, rows in ((1, 100), (20, 100), (1000, 100), (1000, 3)):
            got = list(stretches(column, size, rows))
            assert [t for _, own in got for t in own] == texts
            assert [at for at, _ in got] == np.cumsum([0, *(len(own) for _, own in got[:-1])]).tolist()
            assert all(len(own) <= rows and sum(len((t or "").encode()) for t in own[:-1]) < size for _, own in got)
        assert list(stretches(column.slice(0, 0), 10)) == []
    assert [own for _, own in stretches(pa.array([None, b"ab", b""], pa.binary()), 2)] == [[None, b"ab"], [b""]]


@pytest.mark.parametrize("operator", ["quality", "jaccard"])
def test_memory_does_not_follow_the_batch(operator, monkeypatch):
    rows = Rows()
    if operator == "quality":
        width = quality.line_features([""])[0].shape[1]
        quality.score_quality(rows, quality.LineField(np.zeros(width), np.ones(width), np.zeros(3 * width + 3), np.zeros((2, 2))))
    else:
        monkeypatch.setattr(jaccard, "materialize", lambda table, _: table)
        jaccard.describe_sets(rows, 5, 80, (np.empty(0, np.uint64), np.empty(0, np.int8)))
    own = [sentence(i, 900).replace(" ", "\n", 30) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"key": np.arange(4_000), "text": own * 100})
    assert batch.column("text").nbytes > 12_000_000
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in rows.function(iter([batch]))) == 4_000
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 60_000_000, most
