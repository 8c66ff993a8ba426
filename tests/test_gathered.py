"""Batches of fixtures are put together before they are drawn."""

import pyarrow as pa

from standwise.operators import season


def test_batches_are_gathered(monkeypatch):
    monkeypatch.setattr(season.draws, "AT_ONCE", 10)
    sizes = [0, 3, 4, 5, 12, 1, 0, 9, 1]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    batches = [pa.RecordBatch.from_pydict({"x": list(range(a, a + n))}, pa.schema([("x", pa.int64())])) for a, n in zip(starts, sizes)]
    found = list(season._gathered(iter(batches)))
    assert [b.num_rows for b in found] == [7, 5, 12, 10, 1]
    assert [x for b in found for x in b.column("x").to_pylist()] == list(range(sum(sizes)))
    assert list(season._gathered(iter([batches[0]]))) == []
