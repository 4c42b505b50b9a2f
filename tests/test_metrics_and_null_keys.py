"""Commit metrics against a model of the states, and source rows that share a key with a null in it."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import mutate as MU
from tidemark.operators import versions as V
from tidemark.session import materialize


def model(log):
    """[(version, inserted, updated, deleted, live)] by building every state."""
    out, state = [], set()
    for v in sorted({r[2] for r in log}):
        rows = sorted((r for r in log if r[2] == v), key=lambda r: r[4])
        before = set(state)
        after = set() if any(r[3] in ("overwrite", "begin_overwrite") for r in rows) else set(state)
        written = set()
        for k, _, _, op, _ in rows:
            if op in ("begin", "begin_overwrite"):
                continue
            if op == "delete":
                after.discard(k), written.discard(k)
            else:
                after.add(k), written.add(k)
        out.append((v, len(after - before), len(written & before), len(before - after), len(after)))
        state = after
    return out


@pytest.mark.parametrize("seed", range(6))
def test_metrics_equal_the_states(spark, seed):
    rng = random.Random(seed)
    log = []
    for v in rng.sample(range(40), 14):
        over = rng.random() < .3
        log.append((None, None, v, "begin_overwrite" if over else "begin", -1))
        for s in range(rng.randrange(0, 9)):
            log.append((rng.randrange(7), 1.0 * s, v, rng.choice(["overwrite"] if over else ["upsert", "upsert", "delete"]), s))
    df = spark.createDataFrame(log, "k long, x double, _version long, _op string, _seq long")
    got = V.commit_metrics(df, ["k"]).orderBy("version").collect()
    assert [(r.version, r.inserted, r.updated, r.deleted, r.num_live) for r in got] == model(log)


def test_metrics_of_commits(spark):
    """v0 writes 5 rows, v1 updates 2, v2 overwrites with 1 of them and 2 new ones, v3 deletes, v4 overwrites with nothing."""
    rows = lambda *ids: spark.createDataFrame([(i, 0) for i in ids], "id long, n int")
    log = materialize(V.commit(None, rows(1, 2, 3, 4, 5), "overwrite", params={"mode": "Overwrite"}), 'log')
    log = materialize(V.commit(log, V.update_changes(V.current(log, ["id"]), "id < 3", {"n": "n + 1"}), "update", params={"predicate": "id < 3"}), 'log')
    log = materialize(V.commit(log, rows(2, 8, 9), "overwrite"), 'log')
    log = materialize(V.commit(log, V.delete_changes(V.current(log, ["id"]), "id > 8"), "delete", params={"predicate": "id > 8"}), 'log')
    log = materialize(V.commit(log, rows().limit(0), "overwrite"), 'log')
    got = V.commit_metrics(log, ["id"]).orderBy("version").collect()
    assert [(r.inserted, r.updated, r.deleted, r.num_live) for r in got] == [(5, 0, 0, 5), (0, 2, 0, 5), (2, 1, 4, 3), (0, 0, 1, 2), (0, 0, 2, 0)]
    assert [r.parameters and json.loads(r.parameters) for r in got] == [{"mode": "Overwrite"}, {"predicate": "id < 3"}, None, {"predicate": "id > 8"}, None]
    assert sorted(r.id for r in V.as_of_version(log, ["id"], 3).collect()) == [2, 8] and "_commit_params" not in V.current(log, ["id"]).columns


def test_rows_that_share_a_null_key_are_inserted(spark):
    tgt = spark.createDataFrame([("B", None, 1, "d0", "h0"), ("A", "x", 1, "d0", "h0")], "t string, e string, v int, dt_ptcao string, dthr_igtao string")
    src = spark.createDataFrame([("B", None, 2, "d1", "h1"), ("B", None, 3, "d1", "h1"), ("A", "x", 5, "d1", "h1")], tgt.schema)
    got = sorted(map(str, MU.upsert_changed(tgt, src, ["t", "e"]).select("t", "e", "v", "dt_ptcao").collect()))
    assert got == sorted(map(str, spark.createDataFrame([("B", None, 1, "d0"), ("B", None, 2, "d1"), ("B", None, 3, "d1"), ("A", "x", 5, "d0")],
                                                        "t string, e string, v int, dt_ptcao string").collect()))
    assert MU.merge_into(tgt, src, ["t", "e"]).count() == 4
    with pytest.raises(Exception, match="more than one source row"):
        MU.merge_into(tgt, src.withColumn("e", F.lit("x")), ["t", "e"]).collect()
    with pytest.raises(Exception, match="more than one source row"):
        MU.upsert_changed(tgt, src, ["t", "e"], null_safe_keys=True).collect()
