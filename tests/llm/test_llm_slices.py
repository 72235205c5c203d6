import pyarrow as pa

from lotcast.llm.common import SLICE_BYTES, slices


def test_stretches_hold_few_bytes_and_every_row_once():
    texts = [None, "", "a" * (3 * SLICE_BYTES), *["b" * 1000] * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    row = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(batch.columns, ["id", "text"])], ["row"])
    got = list(slices(iter([batch, batch.slice(0, 0)]), "text"))
    assert [i for b in got for i in b.column("id").to_pylist()] == list(range(len(texts)))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column("text").to_pylist()) <= SLICE_BYTES for b in got)
    assert len(got) > 5
    assert [t for b in slices(iter([row.slice(1)]), "row", "text") for t in b.column("row").field("text").to_pylist()] == texts[1:]
