"""Helpers of the corpus operators: runs of rows by their bytes."""

import pyarrow as pa
import pytest

from sluice.llm.common import slices, tidy


def batch_of(texts, type_=pa.string()):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, type_)], names=["id", "text"])


@pytest.mark.parametrize("size", [1, 5, 7, 1000])
def test_slices_are_all_rows_in_order(size):
    texts = ["", None, "abc", "é" * 9, "x", "", "yy", None]
    seen = []
    for rows, some in slices(batch_of(texts), 1, size):
        assert rows.num_rows == len(some)
        assert len("".join(some[:-1]).encode()) < size  # the last row alone passes the size
        seen += zip(rows.column(0).to_pylist(), some)
    assert seen == [(k, t or "") for k, t in enumerate(texts)]


def test_slices_of_a_part_of_a_batch_of_nothing_and_of_nulls_alone():
    part = batch_of(["aaaa", "b", "cccc", None, "d"]).slice(1, 3)
    assert [(r.column(0).to_pylist(), t) for r, t in slices(part, 1, 4)] == [([1, 2], ["b", "cccc"]), ([3], [""])]
    assert list(slices(batch_of([]), 1, 4)) == []
    assert [t for _, t in slices(batch_of([None, None], pa.null()), 1, 4)] == [["", ""]]
    assert [t for _, t in slices(batch_of(["a", None], pa.large_string()), 1, 4)] == [["a", ""]]


def test_a_tidied_function_yields_what_it_did_and_fails_as_it_did():
    assert list(tidy(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3]
    with pytest.raises(ZeroDivisionError):
        list(tidy(lambda batches: (1 // b for b in batches))([0]))
