"""Key index over runs, bucketed snapshots, co-moment states, file bounds and ledgers."""

import contextlib
import datetime as dt
import io
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lakeq.operators import checks, comoments, key_index, serve
from lakeq.sources import ledger, snapshots


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def _conf(spark, **settings):
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _exchanges_above(plan: str, scan: str) -> int:
    """Shuffles between the named scan and the join over it (plan as an indented tree)."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and scan in line)
    depth, n = re.search(r"[A-Z]", lines[at]).start(), 0
    for line in reversed(lines[:at]):
        here = re.search(r"[A-Z]", line)
        if here and here.start() < depth:
            depth = here.start()
            if "Join" in line:
                return n
            n += "Exchange" in line
    return n


# ---- key index -----------------------------------------------------------------

def _index(spark, tmp_dir):
    name = f"keys_{uuid.uuid4().hex[:8]}"
    key_index.create_key_index(spark, name, os.path.join(tmp_dir, name), {"a": "bigint", "b": "string"}, 6)
    return name


def _run(spark, rows):
    return spark.createDataFrame(rows, "a int, b string, v int")


def test_duplicates_against_history(spark, tmp_dir):
    index = _index(spark, tmp_dir)
    first = _run(spark, [(1, "x", 1), (1, "x", 2), (2, "x", 3), (None, "x", 4), (3, None, 5)])
    second = _run(spark, [(1, "x", 6), (2, "y", 7), (2, "y", 8), (None, "x", 9), (3, None, 10), (4, "z", 11)])
    assert sorted(r.v for r in key_index.duplicates_against_history(first, index, "r1").collect()) == [1, 2]
    key_index.add_run(first, index, "r1")
    key_index.add_run(first, index, "r1")  # a repeated run replaces its own keys
    for target in (1, 1000):  # hot keys apart, or not
        got = key_index.duplicates_against_history(second, index, "r2", target_rows=target)
        assert sorted((r.v, r.run_copies, r.prior_copies, r.first_run) for r in got.collect()) == [
            (6, 1, 2, "r1"), (7, 2, 0, None), (8, 2, 0, None)]
    key_index.add_run(second, index, "r2")
    key_index.add_run(first.limit(0), index, "r3")  # an empty run
    assert sorted(r.v for r in key_index.duplicates_against_history(first, index, "r1").collect()) == [1, 2]
    assert spark.table(index).where("run_id = 'r1'").count() == 2
    with pytest.raises(ValueError):
        key_index.add_run(first, index, "r'4")


def test_index_is_read_without_a_shuffle(spark, tmp_dir):
    index = _index(spark, tmp_dir)
    rows = _run(spark, [(i % 50, "x", i) for i in range(200)])
    key_index.add_run(rows, index, "r1")
    key_index.add_run(rows, index, "r2")
    with _conf(spark, **NO_BROADCAST):
        seen = key_index.seen_keys(rows, index, "r3")
        assert _exchanges_above(_plan(seen), index) == 0
        assert {(r.run_copies, r.prior_copies) for r in seen.collect()} == {(4, 8)}
        assert "PartitionFilters: [isnotnull(run_id" in _plan(seen)


# ---- snapshots -------------------------------------------------------------------

def _names():
    tag = uuid.uuid4().hex[:8]
    return f"fact_{tag}", f"dim_{tag}", f"snap_{tag}"


def _tables(spark, n=3000):
    """A third of the rows as copies of one row, another third without a key."""
    fact = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("p"), F.col("id") % 40)).alias("p"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("hours"), (F.col("id") % 2).alias("month"))
    dim = spark.createDataFrame([("hot", "A"), ("p2", "B"), ("p5", "C"), ("unused", "D"), (None, "E")], "p string, state string")
    return fact, dim


def test_dashboard_over_a_snapshot_equals_the_plain_join(spark, tmp_dir):
    fact, dim = _tables(spark)
    f, d, snap = _names()
    tables = snapshots.write_serving(fact, dim, key="p", fact_name=f, dim_name=d, base=tmp_dir, attempt="a-1", buckets=6,
                                     partition_cols=("month",), target_rows=100)
    assert snapshots.open_snapshot(spark, snap) == {}  # written, not committed
    assert snapshots.commit(spark, snap, tables) == 1
    served = snapshots.open_snapshot(spark, snap)
    with _conf(spark, **NO_BROADCAST):
        got = snapshots.dashboard(served[f], served[d], "p", {"st": "state"})
        plan = _plan(got)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = serve.dashboard(fact, dim, "p", {"st": "state"})
        assert got.count() == 3000
        assert got.exceptAll(want.select(*got.columns)).isEmpty() and want.select(*got.columns).exceptAll(got).isEmpty()
        assert "PartitionFilters: [isnotnull(month" in _plan(got.where("month = 1"))
    biggest = served[f].groupBy("p", "slice").count().agg(F.max("count")).first()[0]
    assert served[f].where("p = 'hot'").select("slice").distinct().count() > 1 and biggest < 1000


def test_slice_column_must_be_free(spark):
    fact, dim = _tables(spark, 9)
    with pytest.raises(ValueError):
        snapshots.with_slices(fact.withColumn("slice", F.lit(1)), dim, "p")


def test_a_run_that_dies_between_two_tables_commits_nothing(spark, tmp_dir):
    fact, dim = _tables(spark, 30)
    f, d, snap = _names()
    write = {"key": "p", "fact_name": f, "dim_name": d, "base": tmp_dir, "buckets": 2}
    snapshots.commit(spark, snap, snapshots.write_serving(fact, dim, attempt="1", **write))
    with pytest.raises(Exception):  # the fact is written, the dimension fails
        snapshots.write_serving(fact.withColumn("hours", F.lit(0)), dim.withColumn("state", F.raise_error(F.lit("lost"))),
                                attempt="2", **write)
    assert snapshots.committed(spark, snap) == {f: f"{f}__1", d: f"{d}__1"}
    assert snapshots.open_snapshot(spark, snap)[f].agg(F.sum("hours")).first()[0] > 0
    with pytest.raises(ValueError):
        snapshots.commit(spark, snap, {f: f"{f}__2", d: f"{d}__9"})
    third = snapshots.write_serving(fact, dim, attempt="3", **write)
    assert snapshots.commit(spark, snap, third) == 2
    # commits 1 and 3 stay on record, the failed attempt goes with its files
    assert snapshots.expire(spark, snap, [f, d]) and not os.path.exists(os.path.join(tmp_dir, f"{f}__2"))
    fourth = snapshots.write_serving(fact, dim, attempt="4", **write)
    snapshots.commit(spark, snap, fourth)
    assert sorted(snapshots.expire(spark, snap, [f, d])) == sorted([f"{f}__1", f"{d}__1"])
    assert not os.path.exists(os.path.join(tmp_dir, f"{f}__1")) and snapshots.committed(spark, snap) == fourth
    assert snapshots.open_snapshot(spark, snap)[f].count() == 30


# ---- co-moments --------------------------------------------------------------------

def test_merged_pair_states_equal_corr_of_all_rows(spark):
    rows = [(float(i), 1e6 + (i * 37 % 11), None if i % 5 == 0 else float(i * i % 17), float("nan") if i % 7 == 0 else 3.0)
            for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    runs = [df.where(F.col("a") < 7), df.where((F.col("a") >= 7) & (F.col("a") < 8)), df.where(F.col("a") >= 8), df.limit(0)]
    states = runs[0].transform(comoments.pair_state, ["a", "b", "c", "k"])
    for run in runs[1:]:
        states = states.unionByName(comoments.pair_state(run, ["a", "b", "c", "k"]))
    got = {(r.x, r.y): (r.n_pairs, r.correlation) for r in comoments.correlations(comoments.merge_states(states)).collect()}
    assert len(got) == 6
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        assert got[x, y][0] == both.count() and got[x, y][1] == pytest.approx(both.corr(x, y), abs=1e-9)
    assert got["a", "k"] == (60 - 9, None)  # a constant, NaN left out


# ---- bounds from files ---------------------------------------------------------------

def test_file_bounds_read_footers_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    (spark.range(100).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
                             F.col("id").cast("string").alias("s")).write.parquet(path))
    out = checks.file_bounds(spark, path, ["id", "d"])
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(d), MAX(d)]" in _plan(out)
    assert tuple(out.first()) == (100, 0, 99, dt.date(2024, 1, 1), dt.date(2024, 4, 9))
    with pytest.raises(ValueError):
        checks.file_bounds(spark, path, ["s"])


# ---- ledgers --------------------------------------------------------------------------

def _file(tmp_dir, name, data: bytes) -> str:
    path = os.path.join(tmp_dir, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_files_are_known_by_content(spark, tmp_dir):
    paths = [_file(tmp_dir, "one/a.csv", b"k,v\n1,2\n"), _file(tmp_dir, "two/moved.csv", b"k,v\n1,2\n"),
             _file(tmp_dir, "one/same size.csv", b"k,v\n1,3\n"), _file(tmp_dir, "one/empty.csv", b""),
             _file(tmp_dir, "one/latin.csv", b"\xe9\n"), _file(tmp_dir, "one/copies.csv", b"1\n1\n"),
             _file(tmp_dir, "one/more copies.csv", b"1\n1\n1\n1\n")]
    manifest = spark.createDataFrame([("d", p, os.path.getsize(p)) for p in [*paths, tmp_dir + "/one"]],
                                     "dataset string, path string, size_bytes bigint")
    digests = {os.path.basename(r.path): r.digest for r in ledger.with_digests(spark, manifest).collect()}
    assert digests["a.csv"] == digests["moved.csv"] and digests["one"] is None and digests["empty.csv"] is None
    assert len({d for d in digests.values() if d}) == 5
    assert ledger.with_digests(spark, manifest.limit(0)).count() == 0


def test_known_files_names_the_last_publishing_run(spark, tmp_dir):
    base = os.path.join(tmp_dir, "ledger")
    assert ledger.read_files(spark, base).count() == 0

    def entry(digest, refined, day):
        return spark.createDataFrame([("d", "/p", 1, digest, refined, dt.datetime(2024, 1, day))], ledger.FILE_COLUMNS)
    ledger.record_files(entry("x", "r1", 1), base, "r1", "published")
    ledger.record_files(entry("x", "r1", 3), base, "r0", "published")
    ledger.record_files(entry("y", "r3", 4), base, "r3", "landed")  # never published
    wanted = spark.createDataFrame([("d", "x"), ("d", "y"), ("e", "x"), ("d", None)], "dataset string, digest string")
    got = {(r.dataset, r.digest): (r.known_run, r.refined_run)
           for r in ledger.known_files(wanted, ledger.read_files(spark, base)).collect()}
    assert got == {("d", "x"): ("r0", "r1"), ("d", "y"): (None, None), ("e", "x"): (None, None), ("d", None): (None, None)}
    with pytest.raises(ValueError):
        ledger.record_files(entry("x", "r1", 1), base, "r1", "done")


def test_a_stage_counts_only_after_the_record_it_builds_on(spark, tmp_dir):
    base, stages = os.path.join(tmp_dir, "stages"), ("refine", "validate", "curate")
    assert ledger.finished_stages(spark, base, "r1", stages, "in") == ([], "in")
    ledger.record_stage(spark, base, "r1", "refine", "a", "in")
    ledger.record_stage(spark, base, "r1", "validate", "b", "a")
    assert ledger.finished_stages(spark, base, "r1", stages, "in") == (["refine", "validate"], "b")
    assert ledger.finished_stages(spark, base, "r1", stages, "other files") == ([], "other files")
    ledger.record_stage(spark, base, "r1", "refine", "c", "in")  # refined again
    assert ledger.finished_stages(spark, base, "r1", stages, "in") == (["refine"], "c")
