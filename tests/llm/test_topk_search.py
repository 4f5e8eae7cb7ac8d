"""Top-k search against all scores."""

import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from compare import differences, duckdb_over
from tidemark.llm.queries import ORACLE_SQL, op12_topk_search
from tidemark.llm.topk_search import Index, Search, _Block, _narrow, top_k

ROWS = "vec_id long, embedding array<float>"


def plain(rows, k, every=20):
    usable = [
        (vec_id, [math.floor(64 * x) for x in vector])
        for vec_id, vector in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for place, (query, vector) in enumerate(usable):
        if query is None or query % every:
            continue
        scores = [
            (-sum(x * y for x, y in zip(vector, other)), vec_id is None, vec_id or 0, vec_id)
            for at, (vec_id, other) in enumerate(usable)
            if at != place
        ]
        out += [(query, rank, vec_id, -less) for rank, (less, _, _, vec_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("index", (Index(), Index(4, 16, 2), Index(1, 1, 1)))
def test_equals_all_scores(spark, index):
    pick = random.Random(3)
    # Few different values, so that many scores are equal.
    rows = [(number, [pick.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for number in range(90)]
    got = top_k(spark.createDataFrame(rows, ROWS), 7, index=index)
    assert rows_of(got) == plain(rows, 7)


def test_query_equals_sql(spark, checked_warehouse):
    got = op12_topk_search(spark, checked_warehouse)
    assert differences(got, duckdb_over(checked_warehouse), ORACLE_SQL["op12_topk_search"]) == []


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5]), (20, None), (20, []), (40, [None, 1.0]), (60, [inf, 1.0]), (80, [nan, 1.0]),
        (None, [1.0, 0.5]), (100, [1.0]), (100, [1.0]), (3, [-0.01, 2.0, 9.0]), (4, [1.0, 0.5]),
        (120, [1e6, -1e6]), (5, [3e4] * 3),
    ]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], f"{ROWS}, score long, VEC_ID string")
    assert rows_of(top_k(docs, 5, index=Index(2, 4, 2))) == plain(rows, 5)
    assert top_k(docs.filter("1 = 0")).collect() == []
    alone = spark.createDataFrame([(20, [1.0])], ROWS)
    assert top_k(alone).collect() == []


def test_bounds_leave_blocks_unscored():
    """Blocks far apart: only the best one is scored for a query."""
    blocks = []
    for number in range(8):
        matrix = np.full((4, 2), 10 * number, np.int64) + np.arange(8).reshape(4, 2)
        packed = _narrow(matrix)
        blocks.append(_Block({
            "first": 4 * number, "width": 2, "kind": packed.dtype.str, "vectors": packed.tobytes(),
            "ids": np.arange(4 * number, 4 * number + 4).tobytes(), "known": np.ones(4, bool).tobytes(),
            "highs": matrix.max(0).tobytes(), "lows": matrix.min(0).tobytes(),
        }))
    vector = _narrow(np.array([1, 1]))
    query = {"place": 0, "query_id": 0, "least": -math.inf, "width": 2, "kind": vector.dtype.str, "vector": vector.tobytes()}
    search, scored = Search([query], blocks, 3), []
    inner = search._score
    search._score = lambda number, *rest: (scored.append(number), inner(number, *rest))
    search.run()
    assert scored == [7]
    assert [hit[2] for hit in search.hits()] == [31, 30, 29]
