"""Out-of-fold runs and importance over the matrix leave no intermediate files: shuffles, values, bins, blocks, stored tables."""

from __future__ import annotations

import datetime as dt
import glob
import time
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from riskframe.operators import boosting as BO
from riskframe.operators import oof as O
from riskframe.operators import relational as R
from riskframe.plans import q_learners as L
from riskframe.plans import q_relational as Q
from riskframe.session import checkpoint_dir

PARAMS = BO.Params(rounds=6, rate=.3, depth=2, columns=1.0, rows=.8, min_weight=2.0, inner=4, patience=6)


def shuffles(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def stored(spark) -> set[str]:
    return set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/*"))


def soon(left) -> bool:
    """Whether ``left()`` gets empty: files are deleted in the background."""
    until = time.time() + 20
    while left() and time.time() < until:
        time.sleep(0.2)
    return not left()


def test_packed_values_are_the_same_values(spark, monkeypatch):
    monkeypatch.setattr(BO, "PACK_ROWS", 7)
    rows = [(None if i == 3 else i, i % 2, [1.5 * i, float("nan") if i % 3 else -0.0, 1e300 / (i + 1)]) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, y int, x array<double>").repartition(3)
    packed = BO.packed(df).localCheckpoint()
    got = [(i, y, x.tobytes()) for r in packed.collect()
           for i, y, x in zip(r["id"], r["y"], BO._unsqueezed(bytes(r["x"]), 3), strict=True)]
    assert sorted(got, key=repr) == sorted(((i, y, np.array(x).tobytes()) for i, y, x in rows), key=repr)
    assert max(len(r["id"]) for r in packed.collect()) == 7
    cuts = BO.fit_cuts(df, 3)
    assert all(np.array_equal(a, b) for a, b in zip(cuts, BO.fit_cuts(packed, 3), strict=True))
    bins = [sorted(BO.binned(f, cuts).collect(), key=repr) for f in (df, packed)]
    assert bins[0] == bins[1] and len(bins[0]) == 50 and bins[0][0].asDict().keys() == {"id", "y", "bins"}


def test_an_out_of_fold_run_keeps_its_scores_only(spark, monkeypatch):
    r = np.random.default_rng(1)
    df = spark.createDataFrame([(i, float(v), float(w), int(v + w * .3 > .1)) for i, (v, w) in enumerate(r.normal(size=(400, 2)))],
                               "id long, a double, b double, y int")
    monkeypatch.setattr(BO, "SETTLE", 1)
    before, shuffled, most, one = stored(spark), shuffles(spark), [], BO._pass

    def passed(*args):
        most.append(len(stored(spark) - before))
        assert soon(lambda: shuffles(spark) - shuffled)
        return one(*args)

    monkeypatch.setattr(BO, "_pass", passed)
    run = O.run(df, ["a", "b"], "y", id_col="id", strata=["y"], k=2, seeds=(1,), learners={"t": PARAMS})
    assert len(run.forest.models[0].trees) > 3 and most[0] == 1 and max(most) == 2  # blocks; blocks and those with the last margins
    assert len(stored(spark) - before) == 1 and run.oof.count() == 400


def plain(df) -> list[tuple]:
    """Rows with nine digits of a double: sums are added in the order in which rows arrive."""
    return sorted((tuple(f"{v + 0.0:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.collect()))


def tables(d, n=240) -> str:
    """customer, orders, lineitem and events of ``n`` customers, some without orders or events."""
    r = np.random.default_rng(3)
    day = lambda k: dt.datetime(1995, 1, 1) + dt.timedelta(days=int(k))
    orders, items, events = 5 * n, 12 * n, 4 * n
    write = lambda name, **columns: pq.write_table(pa.table(columns), f"{d}/{name}.parquet")
    write("customer", c_custkey=range(n), c_name=[f"c{i}" for i in range(n)], c_nationkey=pa.array(r.integers(0, 25, n), pa.int32()),
          c_acctbal=r.normal(0, 3000, n).round(2), c_mktsegment=[("A", "B", None)[i % 3] for i in range(n)])
    write("orders", o_orderkey=range(orders), o_custkey=r.integers(0, n - 20, orders), o_orderstatus=[("O", "F", "P")[i % 3] for i in range(orders)],
          o_totalprice=r.uniform(100, 9000, orders).round(2), o_orderdate=[day(k) for k in r.integers(0, 1200, orders)],
          o_orderpriority=[("1-URGENT", "3-MEDIUM", "5-LOW")[i % 3] for i in range(orders)])
    write("lineitem", l_orderkey=r.integers(0, orders, items), l_partkey=range(items), l_suppkey=range(items),
          l_linenumber=pa.array(r.integers(1, 8, items), pa.int32()), l_quantity=r.uniform(1, 50, items), l_extendedprice=r.uniform(10, 900, items),
          l_discount=r.uniform(0, .1, items), l_tax=r.uniform(0, .1, items), l_returnflag=[("A", "R", "N")[i % 3] for i in range(items)],
          l_linestatus=[("O", "F")[i % 2] for i in range(items)], l_shipdate=[day(k) for k in r.integers(0, 1300, items)])
    write("events", event_id=range(events), ts=[day(k) for k in r.integers(0, 400, events)], user_id=r.integers(0, n // 2, events),
          event_type=[("error", "click", "purchase", "view")[i % 4] for i in range(events)], value=r.uniform(0, 100, events), props=["{}"] * events)
    return str(d)


def test_importance_stores_a_block_at_a_time_and_frees_it(spark, tmp_path, monkeypatch):
    d = tables(tmp_path)
    before, shuffled, names, seen, bucketed, run = stored(spark), shuffles(spark), [], {}, R.bucketed, O.run

    def watched(df, root, **how):
        assert soon(lambda: shuffles(spark) - shuffled), f"shuffles before {how['name']}"
        names.append(how["name"])
        return bucketed(df, root, **how)

    def ran(df, features, *args, release, **how):
        def released():
            release()
            seen["left"] = [f for f in stored(spark) - before if "/runs-" in f] + [x for x in names if spark.catalog.tableExists(x)]

        seen["rows"], seen["columns"], seen["features"] = plain(df), df.columns, features
        return run(df, features, *args, release=released, **how)

    monkeypatch.setattr(R, "bucketed", watched)
    monkeypatch.setattr(O, "run", ran)
    monkeypatch.setattr(L, "SEEDS", (1,))
    monkeypatch.setattr(L, "FOLDS", 2)
    monkeypatch.setattr(L, "WIDE", {"t": replace(PARAMS, rounds=2, columns=.2)})
    got = {r["source"]: r for r in L.q_importance_by_source(spark, d).collect()}
    assert len(names) == 6 and seen["left"] == []
    assert len(stored(spark) - before) == 5  # the scores, and the codes of four blocks
    assert sum(r["n_features"] for r in got.values()) == len(seen["features"]) > 600
    assert abs(sum(r["importance"] for r in got.values()) - 1) < 1e-9
    matrix = Q.q_relational_matrix(spark, d)
    assert seen["columns"] == matrix.columns and seen["rows"] == plain(matrix) and len(seen["rows"]) == 237
