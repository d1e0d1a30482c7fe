from __future__ import annotations

import os
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from adoptrend.llm import mixing, queries
from adoptrend.session import cut
from tests.llm.test_packing import check
from tests.llm.test_similar import kept as kept_by_shingles
from tests.parity import compare, oracle

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(cut(stage(spark, seen[-1], FOLDER)))
    assert [len(corpus_pipeline.STAGES), *[s.columns for s in seen[1:-1]]] == [5] + [columns] * 4
    whole, good, distinct, apart, mixed, packed = ([tuple(r) for r in s.collect()] for s in seen)
    text = columns.index("text")
    assert set(good) < set(whole)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r[0] for r in good}
    assert all(i in kept for i, q in labels.items() if q == 1)
    # equal texts: the largest id stays
    want = {}
    for r in good:
        want[r[text]] = max(want.get(r[text], r), r)
    assert sorted(distinct) == sorted(want.values())
    # five-word shingles with a similarity of 0.8 or more: the smallest id stays
    stays = kept_by_shingles([(r[0], r[text]) for r in distinct])
    assert sorted(apart) == sorted(r for r in distinct if r[0] in stays)
    # the mix takes documents as often as its operator says
    taken = {r.doc_id: r.epochs + r.extra for r in mixing.takes(seen[3]).where("size > 0").collect()}
    assert Counter(r[0] for r in mixed) == Counter({i: n for i, n in taken.items() if n})
    check(seen[5].collect(), mixed, 2048)
    # the whole, by its own entry
    again = sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert again == sorted(r[:5] for r in packed)


def test_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, name):
    verdict, note = compare(spark, oracle(FOLDER), name, FOLDER, contract.queries(), contract.oracle_sql())
    assert verdict == "ok", note
