"""Runs that break off, run beside each other, or find other files than they saw before."""

import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from copies import config
from replicheck import CheckConfig, InUse, Refused, ReplicaSpec
from replicheck.operators import compare, validate
from replicheck.plans import add_pending, job, run, run_tables
from replicheck.sources import AuditStore, read_replica, readers
from replicheck.sources.commits import KEPT, CommitLog, Files
from test_keys import plan_of

SCHEMA = "k int, v string, t long"
ONE = [(k, "a", 5) for k in range(1, 41)]
TWO = [(k, "b" if k % 7 == 0 else "a", 6 if k % 7 == 0 else 5) for k in range(1, 41) if k % 11]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "audit")


def small(spark, root, *copies, **changes):
    base = dict(root=root, time_column="t", time_format="int", run_mode=0, chunk_size=4)
    return config(spark, SCHEMA, *(copies or (ONE, TWO)), **{**base, **changes})


def stored(spark, path, copies, root, files=1, **changes):
    """The same with copies that lie in files."""
    specs = []
    for i, rows in enumerate(copies, start=1):
        df = spark.createDataFrame(rows, SCHEMA).repartitionByRange(files, "k")
        df.write.mode("overwrite").parquet(f"{path}/copy {i}")
        specs.append(ReplicaSpec(i, f"dn{i}", f"{path}/copy {i}"))
    base = dict(root=root, time_column="t", time_format="int", run_mode=0, nullable_columns=("v", "t"))
    return CheckConfig(table="t", pk="k", replicas=tuple(specs), **{**base, **changes})


def audit(spark, root):
    """What readers of the audit tables see."""
    store = AuditStore(spark, root, "t")
    shape = validate.backup_schema(spark.createDataFrame([], SCHEMA).schema)
    tables = {n: store.read(n) for n in ("differ", "outcome")} | {"backup": store.backups(shape)}
    return {
        n: sorted(map(tuple, df.drop("files").collect())) if df is not None else None
        for n, df in tables.items()
    }


def rows_of(spark, spec):
    return sorted(map(tuple, read_replica(spark, spec).collect()))


# The log


def test_commits_beside_each_other_are_all_there(spark, root):
    logs = [CommitLog(spark, root, "t") for _ in range(6)]
    folder = ("f", {})
    threads = [
        threading.Thread(target=lambda log=log, i=i: log.commit(f"x{i}", {"a": (f"f{i}", {})}))
        for i, log in enumerate(logs)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    state = logs[0].state()
    assert sorted(state.parts["a"]) == [f"f{i}" for i in range(6)] and state.version == 6
    assert logs[0].commit("x3", {"a": folder}) is None
    assert logs[0].state().version == 6


def test_log_keeps_its_last_versions(spark, root):
    log = CommitLog(spark, root, "t")
    for i in range(KEPT + 5):
        log.commit(f"x{i}", {"a": (f"f{i}", {})})
    names = log.files.names(log.path)
    assert len(names) == KEPT and len(log.state().parts["a"]) == KEPT + 5


def test_files_are_created_once(spark, tmp_path):
    files, path = Files(spark), f"{tmp_path}/a b/x"
    assert files.create(path, "é") and not files.create(path, "other")
    assert files.read(path) == "é" and files.names(f"{tmp_path}/a b") == ["x"]
    assert files.names(f"{tmp_path}/nothing") == []


def test_the_same_transaction_appends_once(spark, root):
    store = AuditStore(spark, root, "t")
    for _ in range(2):
        store.append("differ", spark.range(3), "one")
    store.append("differ", spark.range(2), "two")
    assert store.read("differ").count() == 5


# One run at a time


def test_of_runs_that_start_together_one_works(spark, root):
    logs = [CommitLog(spark, root, "t", f"run{i}") for i in range(6)]
    won, lost = [], []

    def take(log):
        try:
            log.take()
            won.append(log.owner)
        except InUse:
            lost.append(log.owner)

    threads = [threading.Thread(target=take, args=(log,)) for log in logs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 5
    assert logs[0].state().owner == won[0]


def test_a_table_in_use_is_refused_until_it_is_taken_over(spark, root):
    cfg = small(spark, root)
    first = job.TableRun(spark, cfg)
    first.preflight()
    first.store.log.take()
    first.scan()
    with pytest.raises(InUse, match=first.run_id):
        run(spark, cfg)
    with pytest.raises(InUse):
        add_pending(spark, cfg, spark.createDataFrame([(1,)], "k int"))
    with pytest.raises(InUse):
        AuditStore(spark, root, "t").append("differ", spark.range(1))
    other = replace(cfg, table="u")
    assert [r.status for r in run_tables(spark, [cfg, other])] == [None, 1]
    result = run(spark, replace(cfg, take_over=True))
    assert result.counts["status_1"] == 8
    before = audit(spark, root)
    with pytest.raises(InUse, match="no longer owns"):
        first._commit("late", clear=first.store.WORKING)
    first.leave()
    assert audit(spark, root) == before
    assert first.store.log.state().owner is None


def test_refused_and_broken_runs_leave_the_table(spark, root, monkeypatch):
    cfg = small(spark, root)
    monkeypatch.setattr(job.TableRun, "repair", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, cfg)
    monkeypatch.undo()
    assert run(spark, replace(cfg, run_mode=2)).counts["status_1"] == 8


# Breaks


def breaking(monkeypatch, after):
    """Every write of an audit part beyond ``after`` of them breaks off half way."""
    write, done = AuditStore.write, []

    def broken(self, name, df, transaction):
        done.append(name)
        if len(done) > after:
            df.limit(1).write.mode("overwrite").parquet(self.folder(name, transaction))
            raise RuntimeError(f"lost while writing {name}")
        return write(self, name, df, transaction)

    monkeypatch.setattr(AuditStore, "write", broken)


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole") / "audit")
    cfg = small(spark, root)
    result = run(spark, cfg)
    copies = [rows_of(spark, s) for s in job.repaired_specs(spark, cfg, result.run_id)]
    return audit(spark, root), copies


# matrix, keys, chunk, chunk_differ, differ; then backup, outcome, manifest
@pytest.mark.parametrize("after", range(8))
def test_a_run_that_broke_off_and_is_repeated_equals_one_run(
    spark, root, monkeypatch, undisturbed, after
):
    cfg = small(spark, root)
    breaking(monkeypatch, after)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, cfg)
    monkeypatch.undo()
    found = audit(spark, root)
    assert found["outcome"] is None and found["backup"] is None
    assert found["differ"] == (undisturbed[0]["differ"] if after > 4 else None)
    if after > 4:
        cfg = replace(cfg, run_mode=2)
    elif after:  # what the scan has stored is enough
        assert run(spark, replace(cfg, run_mode=3)).status == 1
        cfg = replace(cfg, run_mode=2)
    result = run(spark, cfg)
    assert audit(spark, root) == undisturbed[0]
    copies = [rows_of(spark, s) for s in job.repaired_specs(spark, cfg, result.run_id)]
    assert copies == undisturbed[1]
    files = Files(spark)
    assert len(files.names(f"{root}/outcome/table_name=t")) == 1
    assert len(files.names(f"{root}/repaired/table_name=t")) == 1


@pytest.mark.parametrize("ranges", [0, 1, 2, 4])
def test_resume_goes_on_from_committed_ranges_without_the_replicas(
    spark, root, undisturbed, monkeypatch, ranges
):
    gone = []

    def reader(df):
        lost = F.when(F.col("k").isNotNull(), F.raise_error(F.lit("replica read"))).otherwise(F.col("v"))
        return lambda spark: df.withColumn("v", lost) if gone else df

    cfg = small(spark, root, run_mode=1, range_keys=8)
    cfg = replace(
        cfg, replicas=tuple(replace(s, reader=reader(s.reader(spark))) for s in cfg.replicas)
    )
    commit, done = job.TableRun.commit_range, []

    def counted(self, first, last):
        if len(done) == ranges and not gone:
            raise RuntimeError("lost")
        done.append((first, last))
        commit(self, first, last)

    monkeypatch.setattr(job.TableRun, "commit_range", counted)
    with pytest.raises(RuntimeError):
        run(spark, cfg)
    gone.append(True)
    assert run(spark, replace(cfg, run_mode=3)).status == 1
    # the last stored chunk is computed again, beginning with the key before it
    assert done[ranges][0] == (max(8 * ranges - 4, 1) if ranges else 1)
    found = audit(spark, root)["differ"]
    assert {r[2:] for r in map(lambda r: (r[0], *r[1:]), found)} == {
        r[2:] for r in undisturbed[0]["differ"]
    }
    with pytest.raises(Exception, match="replica read"):
        run(spark, cfg)


def test_drill_down_sorts_and_lists_nothing(spark, root):
    cfg = small(spark, root, run_mode=1)
    part = job.TableRun(spark, cfg)
    part.preflight()
    part.store.log.take()
    part.scan()
    part.order_keys()
    part.open_keys()
    for first, last in part.ranges():
        part.commit_range(first, last)
    part.work = {**part.work, "stored": 5}
    part.cfg = replace(cfg, chunk_size=10_000_000)
    part._cut_anew()
    part.open_keys()
    chunked = job.reduce(
        job.DataFrame.unionByName,
        [part.keys_between(*s) for s in job.keys.segment_spans(part.segments, part.total)],
    )
    differing = part.ws.stage(compare.chunk_differ(part.chunks(), 2), "differing")
    plan = plan_of(compare.key_differ(compare.drill_keys(chunked, differing), "k", cfg.nodes))
    assert "Generate" not in plan and "NestedLoop" not in plan
    assert plan.count(") Exchange\n") <= 1
    # the 16 keys of four chunks, the last of them again, and all behind it
    assert chunked.count() == 41
    part.leave()


# Files


def test_a_replica_written_anew_is_refused_by_name(spark, tmp_path, root, monkeypatch):
    cfg = stored(spark, str(tmp_path), (ONE, TWO), root, run_mode=1)
    monkeypatch.setattr(job.TableRun, "_conclude", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, cfg)
    monkeypatch.undo()
    stored(spark, str(tmp_path), (ONE,), root)
    with pytest.raises(Refused, match="other files of dn1$"):
        run(spark, replace(cfg, run_mode=3))
    assert run(spark, cfg).status == 1


def test_a_replica_written_during_a_repair_is_refused(spark, tmp_path, root, monkeypatch):
    cfg = stored(spark, str(tmp_path), (ONE, TWO), root)
    write = job.TableRun._write_repair

    def late(self, *args):
        spark.createDataFrame([(99, "z", 1)], SCHEMA).write.mode("append").parquet(cfg.replicas[1].source)
        write(self, *args)

    monkeypatch.setattr(job.TableRun, "_write_repair", late)
    with pytest.raises(Refused, match="during the run: dn2$"):
        run(spark, cfg)
    assert audit(spark, root)["outcome"] is None and audit(spark, root)["backup"] is None
    monkeypatch.undo()
    assert run(spark, replace(cfg, run_mode=2)).counts["status_1"] == 8


FILES, KEYS = 100, [30 * k + 7 for k in range(10)]
MANY = [(k, f"v{k}", 5) for k in range(1, 1001)]


@pytest.fixture
def many(spark, tmp_path, root):
    """Two copies in 100 files each; dn2 has ten newer rows and a new one."""
    newer = [(k, "new" if k in KEYS else v, 6 if k in KEYS else t) for k, v, t in MANY]
    return stored(spark, str(tmp_path), (MANY, [*newer, (2000, "x", 1)]), root, files=FILES, write_replicas=True)


def test_repair_rewrites_only_files_of_changed_keys(spark, many, root):
    whole = run(spark, replace(many, root=root + "-whole", write_replicas=False))
    expected = [rows_of(spark, s) for s in job.repaired_specs(spark, replace(many, root=root + "-whole"), whole.run_id)]
    result = run(spark, many)
    assert result.counts["status_1"] == 11
    copies = job.repaired_specs(spark, many, result.run_id)
    assert [rows_of(spark, s) for s in copies] == expected
    assert expected[0] == expected[1] and len(expected[0]) == 1001
    base = f"{root}/repaired/table_name=t/run={result.run_id}/files"
    kept = spark.read.parquet(f"{base}/kept").groupBy("ord").count().collect()
    # ten files of each copy, and on dn2 the one of the new row
    assert {r["ord"]: FILES - r["count"] for r in kept} == {1: 10, 2: 11}
    assert run(spark, replace(many, replicas=copies, root=root + "-again")).counts["differing_keys"] == 0


def test_lookup_reads_the_files_a_check_saw(spark, many, root):
    run(spark, replace(many, run_mode=1))
    part = job.TableRun(spark, replace(many, run_mode=2))
    part.preflight()
    pending = part.ws.stage(job.repair.pending_keys(part.differ(), "t", "k"), "pending")
    found = part._lookup(pending)
    assert len(found.inputFiles()) - len(pending.inputFiles()) <= 22
    scanned = readers.key_lookup_rows(part.rows, pending, "k")
    rows = lambda df: sorted(map(tuple, df.drop("_file").collect()))
    assert rows(found) == rows(scanned) and len(rows(found)) == 21


def test_lookup_scans_for_keys_whose_files_are_not_known(spark, many, root):
    run(spark, replace(many, run_mode=1))
    add_pending(spark, many, spark.createDataFrame([(3,)], "k int"))
    source = many.replicas[0].source
    for expected in (11 + 1, 11 + 1):
        part = job.TableRun(spark, replace(many, run_mode=2))
        part.preflight()
        pending = part.ws.stage(job.repair.pending_keys(part.differ(), "t", "k"), "pending")
        assert part._lookup(pending).select("k").distinct().count() == expected
        # other files: nothing the check saw holds any more
        spark.createDataFrame([(5000, "y", 1)], SCHEMA).write.mode("append").parquet(source)


def test_files_below_folders_that_name_columns(spark, tmp_path, root):
    specs = []
    for i, (rows, when) in enumerate(((ONE, 5), (TWO, 6)), start=1):
        path = f"{tmp_path}/parted{i}"
        spark.createDataFrame(rows, SCHEMA).withColumn("d", F.col("k") % 5).write.partitionBy("d").parquet(path)
        specs.append(ReplicaSpec(i, f"dn{i}", path))
    cfg = CheckConfig(
        table="t", pk="k", replicas=tuple(specs), root=root, run_mode=0, time_column="t",
        time_format="int", nullable_columns=("v", "t", "d"), write_replicas=True, chunk_size=4,
    )
    result = run(spark, cfg)
    copies = job.repaired_specs(spark, cfg, result.run_id)
    a, b = (rows_of(spark, s) for s in copies)
    assert a == b and len(a) == 40 and {r[3] for r in a} == set(range(5))
