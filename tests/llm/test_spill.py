"""Written tables, and what Python workers give back."""

from __future__ import annotations

import pyarrow as pa

from parcelforge.llm import spill


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    seen = []
    monkeypatch.setattr(spill, "give_back", lambda: seen.append(True))
    batches = [pa.RecordBatch.from_pydict({"a": [k]}) for k in range(3)]
    run = spill.lean(lambda rows: (b for b in rows))(batches)
    assert next(run) is batches[0] and not seen
    assert list(run) == batches[1:] and seen == [True]


def test_a_function_runs_in_the_worker_that_writes(spark, monkeypatch):
    def double(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([2 * v for v in batch.column(0).to_pylist()], pa.int64())], names=["b"])

    plans = []
    whole = spill._write_mounted
    monkeypatch.setattr(spill, "_write_mounted", lambda df, *rest: plans.append(df._jdf.queryExecution().toString()) or whole(df, *rest))
    rows = spark.range(5)
    out = spill.write_table(rows, "test", through=(double, "b bigint"))
    assert out.columns == ["b"] and sorted(r["b"] for r in out.collect()) == [0, 2, 4, 6, 8]
    assert len(plans) == 1 and "MapInArrow" not in plans[0]
    native = spill.write_table(rows, "test", native=True, through=(double, "b bigint"))
    assert sorted(r["b"] for r in native.collect()) == [0, 2, 4, 6, 8]
