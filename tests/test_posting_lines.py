"""Lines of postings."""

import pytest

from conftest import rows
from lexiweave.sources import postings as P


@pytest.mark.parametrize("per_part", [10, 1 << 16])
def test_long_lists_are_cut_into_full_lines(spark, per_part, monkeypatch):
    monkeypatch.setattr(P, "IDS_PER_PART", per_part)
    data = [("g", "hot", i) for i in range(50)] + [("g", "few", 1), ("h", "hot", 2), (None, "lost", 3), ("g", "few", 1)]
    df = spark.createDataFrame(data, "group_id string, term string, doc_id long")
    lines = P.posting_lines(df, per_line=3)
    sizes = sorted(line.count(",") + 1 for group, line in rows(lines.where("group_id = 'g'")) if line.startswith("hot:"))
    assert max(sizes) == 3 and sum(sizes) == 50
    if per_part == 1 << 16:
        # All lines but the last one are full, and the ids are in order.
        assert sizes == [2] + [3] * 16
        assert ("g", "hot:[0, 1, 2]") in rows(lines.where("group_id = 'g'"))
        # No list is so long that the postings have to be looked up by a shuffle.
        assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in P.parse_postings(lines).collect()} == set(data)
