"""Pipeline stages on odd rows, on none, and with columns whose names clash."""

import os
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.test_llm_operators import DOCS, rows_of

DATA = os.environ.get("TIDELINE_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")

PLAIN = " ".join(f"w{k}" for k in range(80))
ODD = [
    (1, PLAIN), (2, PLAIN), (2, PLAIN), (None, PLAIN + " more"), (3, None), (3, None), (4, ""), (5, " \n\t"),
    (6, " ".join(f"x{k % 9000}" for k in range(30_000))), (7, "é " * 200), (8, "<|endoftext|>"),
]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_no_rows(spark, name, stage):
    none = spark.createDataFrame([], DOCS)
    out = stage(spark, none, DATA)
    assert out.count() == 0
    if name != "packing":
        assert out.columns == none.columns


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, name, stage):
    docs = spark.createDataFrame(rows_of(ODD), DOCS).repartition(3)
    out = stage(spark, docs, DATA)
    if name == "packing":
        total = Counter()
        for r in out.collect():
            total[r["doc_id"]] += r["length"]
        assert total[3] == 2 and total[4] == 1 and set(total) == {i for i, _ in ODD}
        return
    assert out.columns == docs.columns
    kept = [tuple(r) for r in out.collect()]
    assert not Counter(kept) - Counter(map(tuple, docs.collect()))
    ids = Counter(r[0] for r in kept)
    if name == "quality_rules":
        assert not ids.keys() & {3, 4, 5, 8} and ids[1] == 1
    if name == "exact_dedup":
        assert ids == Counter([1, None, 3, 6, 7, 8]) or ids == Counter([1, None, 5, 6, 7, 8])
    if name == "simhash_near_dedup":
        assert ids[1] == 1 and ids[2] == 0 and ids[3] == 1 and not ids.keys() & {4, 5}
