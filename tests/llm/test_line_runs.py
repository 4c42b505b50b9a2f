"""The index of line runs: merge joins over runs that are neither shuffled nor sorted again."""

import collections
import random
import re

import pytest

from tidemark.llm import line_dedup as LD

SCHEMA = "d long, th long, pos int, hi long, lo long"


def _batches(rng, n, docs, keys):
    """Line hashes of ``n`` batches of rising document ids; some keys are in every document."""
    out = []
    for b in range(n):
        rows = []
        for d in range(b * docs, (b + 1) * docs):
            held = [rng.randrange(keys) for _ in range(6)] + [0, 0, 10_000 + d]
            rows += [(d, d, p, k * 7919 - 5, k) for p, k in enumerate(held)]
        out.append(rows)
    return out


@pytest.mark.parametrize("fanout", [2, 3])
def test_the_first_document_of_a_key_keeps_it(spark, fanout):
    batches = _batches(random.Random(3), 5, 20, 60)
    owner, want = {}, collections.defaultdict(set)
    for rows in batches:
        for d, _, _, _, k in sorted(rows):
            owner.setdefault(k, d)
        for d, _, p, _, k in rows:
            if owner[k] != d:
                want[d].add(p)
    index, got = LD.LineRuns(spark, fanout=fanout), {}
    for rows in batches:
        for r in index.add(spark.createDataFrame(rows, SCHEMA)).collect():
            got[r.d] = set(r.drop)
            assert len(r.drop) == len(got[r.d])
    assert got == dict(want)
    stored = [tuple(r) for t in index.runs() for r in spark.table(t).select("lo", "owner").collect()]
    assert sorted(stored) == sorted(owner.items())                              # every key in one run
    assert all(len(level) < fanout for level in index.levels)
    index.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_runs_are_merged_without_exchange_or_sort(spark):
    index = LD.LineRuns(spark, fanout=4)
    for rows in _batches(random.Random(4), 3, 20, 60):
        index.add(spark.createDataFrame(rows, SCHEMA)).count()
    keys = index._write(spark.createDataFrame(_batches(random.Random(5), 1, 20, 60)[0], SCHEMA)
                        .groupBy("hi", "lo").agg({"d": "min"}).selectExpr("hi", "lo", "`min(d)` AS first", "`min(d)` AS last"))
    assert len(index.runs()) == 3
    with LD._sorted_scans(spark):
        for df in (index.unseen(keys), index.contested(keys), index.merged(*index.runs()[:2])):
            p = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in p and "Exchange" not in p and not re.search(r"\bSort \[", p), p
    index.drop()


def test_no_lines_at_all(spark):
    index = LD.LineRuns(spark)
    for _ in range(3):
        assert index.add(spark.createDataFrame([], SCHEMA)).isEmpty()
    index.drop()
