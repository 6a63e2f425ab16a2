"""What the operators share: batches in slices."""

import pyarrow as pa

from starmart.llm.common import map_batches, parts_of


class _Rows:
    """Hands over the function that Spark would run in its workers."""

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_workers_hold_one_slice_of_a_batch_at_a_time(spark):
    batch = pa.RecordBatch.from_pydict({"id": list(range(4000)), "text": ["x" * 4000] * 4000})
    seen = []

    def lengths(part):
        seen.append(part.nbytes)
        return {"id": part.column("id"), "n": [len(t) for t in part.column("text").to_pylist()]}

    out = list(map_batches(_Rows(), lengths, "id long, n int", sliced=True)([batch, batch.slice(0, 0), batch]))
    assert max(seen) <= 2 << 20 and len(seen) > 10
    assert [i for b in out for i in b.column("id").to_pylist()] == list(range(4000)) * 2
    assert {n for b in out for n in b.column("n").to_pylist()} == {4000}


def test_a_row_larger_than_a_slice_is_a_slice():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 3000, "", None]})
    assert [p.num_rows for p in parts_of(batch, 10)] == [1, 1, 1]
    assert [p.num_rows for p in parts_of(batch)] == [3]
