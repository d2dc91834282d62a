import datetime
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from copies import config, specs
from queries import drift
from replicheck import Refused, ReplicaSpec
from replicheck.operators import repair, validate
from replicheck.plans import add_pending, job, run, run_tables
from replicheck.plans.runlog import RunLog
from replicheck.sources import AuditStore, read_replica

SF = "/root/testdata/sf0.001"
SCHEMA = "k int, v string, t long"
ONE = [(1, "a", 5), (2, "b", 5), (3, "c", 5)]
TWO = [(1, "a", 5), (2, "B", 6)]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "audit")


def small(spark, root, *copies, **changes):
    base = dict(root=root, time_column="t", time_format="int", run_mode=0)
    return config(spark, SCHEMA, *(copies or (ONE, TWO)), **{**base, **changes})


def rows_of(spark, spec):
    return sorted(tuple(r) for r in read_replica(spark, spec).collect())


@pytest.mark.parametrize("anew", [False, True])
def test_check_and_repair(spark, root, anew):
    cfg = small(spark, root, write_replicas=anew)
    result = run(spark, cfg)
    assert (result.status, result.counts["differing_keys"], result.counts["status_1"]) == (1, 2, 2)
    expected = [(1, "a", 5), (2, "B", 6), (3, "c", 5)]
    copies = job.repaired_specs(spark, cfg, result.run_id)
    assert [rows_of(spark, s) for s in copies] == [expected, expected]
    assert run(spark, replace(cfg, replicas=copies)).counts["differing_keys"] == 0


def test_change_set_has_the_size_of_the_differences(spark, root):
    same = [(k, "x", 1) for k in range(10, 40)]
    result = run(spark, small(spark, root, ONE + same, TWO + same))
    changes = spark.read.parquet(f"{root}/repaired/table_name=t/run={result.run_id}/changes")
    found = sorted(tuple(r) for r in changes.select("ord", "op", "k", "v").collect())
    assert found == [(o, "put", k, v) for o in (1, 2) for k, v in ((2, "B"), (3, "c"))]


def test_backup_holds_rows_as_they_were(spark, root):
    cfg = small(spark, root)
    run(spark, cfg)
    store = AuditStore(spark, root, "t")
    shape = validate.backup_schema(read_replica(spark, cfg.replicas[0]).schema)
    found = sorted(tuple(r) for r in store.backups(shape).collect())
    assert found == [
        (2, "B", 6, "dn2", 1, 1),
        (2, "b", 5, "dn1", 0, 1),
        (3, "c", 5, "dn1", 1, 2),
    ]


def test_other_columns_get_another_backup(spark, root):
    run(spark, small(spark, root))
    wider = config(
        spark,
        SCHEMA + ", w int",
        [(*r, 1) for r in ONE],
        [(*r, 1) for r in TWO],
        root=root,
        time_column="t",
        time_format="int",
        run_mode=0,
    )
    run(spark, wider)
    store = AuditStore(spark, root, "t")
    shapes = [
        validate.backup_schema(read_replica(spark, s).schema)
        for s in (small(spark, root).replicas[0], wider.replicas[0])
    ]
    assert [store.backups(s).count() for s in shapes] == [3, 3]
    assert validate.backup_schema_drift(read_replica(spark, wider.replicas[0]).schema, shapes[0])


def test_no_difference_leaves_older_entries_pending(spark, root):
    cfg = small(spark, root)
    run(spark, replace(cfg, run_mode=1))
    result = run(spark, small(spark, root, ONE, ONE))
    assert (result.status, result.counts["differing_keys"]) == (1, 0)
    assert AuditStore(spark, root, "t").read("outcome") is None


def test_limit(spark, root):
    cfg = small(spark, root, auto_repair_size=1)
    assert run(spark, cfg).status == 7
    assert run(spark, replace(cfg, run_mode=2, auto_repair_size=2)).counts["status_1"] == 2


def test_empty_table(spark, root):
    nothing = small(spark, root, [], [], run_mode=1)
    assert run(spark, nothing).status == 4
    with pytest.raises(Refused):
        run(spark, replace(nothing, run_mode=0))


def test_resume_needs_keys(spark, root):
    cfg = small(spark, root, run_mode=3)
    assert run(spark, cfg).status == 5
    run(spark, replace(cfg, run_mode=1))
    assert run(spark, cfg).status == 5


def interrupt(spark, cfg, keep):
    """The state a check leaves that broke off once ``keep`` of its chunks were stored."""
    part = job.TableRun(spark, replace(cfg, range_keys=cfg.chunk_size))
    part.preflight()
    part.store.log.take()
    part.scan()
    part.order_keys()
    part.open_keys()
    for first, last in part.ranges()[:keep]:
        part.commit_range(first, last)
    part.leave()
    return part


def differing(spark, root):
    found = AuditStore(spark, root, "orders").read("differ")
    return {(r["pk"], r["differ_type"]) for r in found.collect()}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole") / "audit")
    run(spark, drift.orders_config(SF, root=root, run_mode=1))
    return differing(spark, root)


@pytest.mark.parametrize("stored", [0, 1, 2, 5])
def test_resume_finds_what_a_full_check_finds(spark, root, whole, stored):
    cfg = drift.orders_config(SF, root=root, run_mode=1)
    interrupt(spark, cfg, stored)
    assert run(spark, replace(cfg, run_mode=3)).status == 1
    assert differing(spark, root) == whole


def test_resume_twice_with_other_chunk_sizes(spark, root, whole):
    cfg = drift.orders_config(SF, root=root, run_mode=3)
    interrupt(spark, replace(cfg, run_mode=1), 4)
    part = job.TableRun(spark, replace(cfg, chunk_size=30, range_keys=60))
    part.preflight()
    part.store.log.take()
    part.work = part.store.facts("check")
    part._cut_anew()
    part.open_keys()
    for first, last in part.ranges()[:3]:
        part.commit_range(first, last)
    part.leave()
    assert part.chunks().agg(F.max("chunk")).first()[0] == 9
    assert run(spark, replace(cfg, chunk_size=70)).status == 1
    assert differing(spark, root) == whole


def test_keys_put_in_by_hand(spark, root):
    cfg = small(spark, root, run_mode=2)
    assert run(spark, cfg).status == 1
    add_pending(spark, cfg, spark.createDataFrame([(2,), (9,)], "k int"))
    result = run(spark, cfg)
    assert (result.counts["status_1"], result.counts["status_2"]) == (1, 1)
    copies = job.repaired_specs(spark, cfg, result.run_id)
    assert rows_of(spark, copies[0]) == [(1, "a", 5), (2, "B", 6), (3, "c", 5)]
    assert rows_of(spark, copies[1]) == [(1, "a", 5), (2, "B", 6)]


def test_statuses_are_written_back(spark, root):
    cfg = small(spark, root, [(1, "a", 5), (2, "b", 5)], [(1, "A", 5), (2, "BB", 6)])
    run(spark, cfg)
    done = job.TableRun(spark, cfg)
    found = {r["pk"]: (r["status"], r["differ_type"]) for r in done.differ().collect()}
    assert found == {1: (5, 2), 2: (1, 2)}


def refused(spark, cfg, word):
    with pytest.raises(Refused, match=word):
        run(spark, cfg)


def test_refusals_before_the_run(spark, root):
    cfg = small(spark, root)
    gone = (*cfg.replicas, ReplicaSpec(3, "dn3", f"{root}/nothing"))
    refused(spark, replace(cfg, replicas=gone), "dn3")
    narrow = (cfg.replicas[0], *specs(spark, "k int, v string", [], [(1, "a")])[1:])
    refused(spark, replace(cfg, replicas=narrow), "dn2")
    other = (cfg.replicas[0], *specs(spark, "k int, v int, t long", [], [])[1:])
    refused(spark, replace(cfg, replicas=other), "dn2")
    refused(spark, replace(cfg, pk="nokey"), "nokey")
    refused(spark, replace(cfg, time_column="gone"), "gone")
    two = (("v",), ("t",))
    refused(spark, replace(cfg, unique_keys=two), "unique")
    assert run(spark, replace(cfg, unique_keys=two, run_mode=1)).status == 1
    assert RunLog(spark, root).runs().count() == 1


def test_repeated_or_null_keys_are_refused(spark, root):
    for bad in ([(1, "a", 5), (1, "b", 5)], [(None, "a", 5)]):
        refused(spark, small(spark, root, bad, ONE, run_mode=1), "repeats")
    assert {r["status"] for r in RunLog(spark, root).runs().collect()} == {8}


def test_repeated_unique_values_are_refused(spark, root):
    same = [(1, "a", 5), (2, "a", 5)]
    cfg = small(spark, root, same, [(1, "a", 6)], unique_keys=(("v",),))
    refused(spark, cfg, "repeats")


def test_unique_values_of_all_rows_are_verified_on_request(spark, root):
    """A value that repeats among keys that do not differ is no matter of the repair itself."""
    twice = [(8, "z", 5), (9, "z", 5)]
    cfg = small(spark, root, [*ONE, *twice], [*TWO, *twice], unique_keys=(("v",),))
    refused(spark, replace(cfg, verify_unique=True), "v is not unique on dn1, dn2")
    assert run(spark, replace(cfg, run_mode=2)).counts["status_1"] == 1


def test_files_without_a_schema(spark, root, tmp_path):
    for i, rows in enumerate((ONE, TWO), start=1):
        spark.createDataFrame(rows, SCHEMA).write.csv(f"{tmp_path}/c{i}")
    given = tuple(
        ReplicaSpec(i, f"dn{i}", f"{tmp_path}/c{i}", format="csv", schema=SCHEMA) for i in (1, 2)
    )
    cfg = replace(small(spark, root), replicas=given, nullable_columns=("v", "t"), write_replicas=True)
    result = run(spark, cfg)
    assert result.counts["differing_keys"] == 2
    a, b = (rows_of(spark, s) for s in job.repaired_specs(spark, cfg, result.run_id))
    assert a == b == [(1, "a", 5), (2, "B", 6), (3, "c", 5)]


def test_bad_time_is_refused_before_any_write(spark, root):
    schema = "k int, v string, t string"
    good, day = "2020-01-01 00:00:00", "2020-01-01"
    base = dict(root=root, time_column="t", run_mode=0)
    first = [(1, "a", good), (2, "b", None)]
    cfg = config(spark, schema, first, [(1, "a", good), (2, "c", good)], **base)
    refused(spark, cfg, "time of 1 pending keys")
    (listed,) = spark.read.parquet(f"{root}/bad_time/table_name=t").select("ord", "k").collect()
    assert tuple(listed) == (1, 2)
    assert AuditStore(spark, root, "t").read("outcome") is None
    refused(spark, config(spark, schema, [(1, "a", day)], [(1, "b", day)], **base), "read as")


def test_tables_in_turn(spark, root):
    bad = small(spark, root, [(1, "a", 5), (1, "b", 5)], ONE, table="bad")
    results = run_tables(spark, [bad, small(spark, root)])
    assert [(r.table, r.status) for r in results] == [("bad", None), ("t", 1)]
    broken = small(spark, root, decimals={"v": (2, 0)}, table="broken")
    with pytest.raises(Exception):
        run_tables(spark, [broken, small(spark, root)])
    log = {r["table_name"]: r["status"] for r in RunLog(spark, root).runs().collect()}
    assert log["broken"] == 8


def test_stale_runs_are_marked(spark, root):
    log = RunLog(spark, root)
    log.record("old", "t", 0, 1)
    run(spark, small(spark, root))
    runs = {r["run_id"]: r for r in log.runs().collect()}
    assert runs.pop("old")["status"] == 2
    (new,) = runs.values()
    assert (new["status"], new["run_mode"]) == (1, 0)
    assert new["minutes"] == 0 and new["ended"] >= new["started"]


def test_run_that_ends_after_all(spark, root):
    log = RunLog(spark, root)
    log.start("slow", "t", 1)
    log.start("elsewhere", "u", 1)
    assert log.runs().filter("run_id = 'slow'").first()["status"] == 0
    log.start("other", "t", 1)
    assert log.runs().filter("run_id = 'slow'").first()["status"] == 2
    log.record("slow", "t", 1, 1)
    assert {r["run_id"]: r["status"] for r in log.runs().collect()} == {
        "slow": 1,
        "elsewhere": 0,
        "other": 0,
    }


def test_working_tables_are_empty_afterwards(spark, root):
    run(spark, small(spark, root))
    store = AuditStore(spark, root, "t")
    assert all(store.read(name).isEmpty() for name in store.WORKING)
    assert not any(store.log.files.names(f"{root}/{name}/table_name=t") for name in store.WORKING)


def test_repair_again_changes_nothing(spark, root):
    cfg = drift.orders_config(SF, root=root, run_mode=0)
    first = run(spark, cfg)
    once = replace(cfg, replicas=job.repaired_specs(spark, cfg, first.run_id))
    second = run(spark, once)
    assert second.counts["differing_keys"] == 27 and "status_1" not in second.counts
    twice = job.repaired_specs(spark, once, second.run_id)
    for a, b in zip(once.replicas, twice):
        before, after = read_replica(spark, a), read_replica(spark, b)
        assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_text_keys_under_a_collation(spark, root):
    schema = "k string, v string, t long"
    first = [("a", "x", 1), ("B", "y", 1), ("c", "z", 1)]
    second = [("A", "x", 1), ("b", "Y", 2), ("C", "z", 1)]
    base = dict(root=root, time_column="t", time_format="int", exclude_columns=("t", "k"))
    cfg = config(spark, schema, first, second, **base, collation="UTF8_LCASE", run_mode=0)
    result = run(spark, cfg)
    assert result.counts["differing_keys"] == 1 and result.counts["status_1"] == 1
    after = [rows_of(spark, s) for s in job.repaired_specs(spark, cfg, result.run_id)]
    assert [[r[1] for r in sorted(rows, key=lambda r: r[0].lower())] for rows in after] == [
        ["x", "Y", "z"]
    ] * 2
    spelled = replace(cfg, root=root + "1", exclude_columns=("t",), run_mode=1)
    assert run(spark, spelled).counts["differing_keys"] == 3
    binary = config(spark, schema, first, second, **{**base, "root": root + "2"}, run_mode=1)
    assert run(spark, binary).counts["differing_keys"] == 6


def test_keys_of_other_types(spark, tmp_path):
    at = datetime.date(2020, 1, 1)
    for i, (dtype, one, two) in enumerate(
        [("string", "a", "b"), ("date", at, at + datetime.timedelta(1)), ("smallint", 1, 2)]
    ):
        cfg = config(
            spark,
            f"k {dtype}, v string, t long",
            [(one, "x", 1), (two, "y", 1)],
            [(one, "x", 1), (two, "z", 2)],
            root=str(tmp_path / str(i)),
            time_column="t",
            time_format="int",
            run_mode=0,
        )
        result = run(spark, cfg)
        assert (result.counts["differing_keys"], result.counts["status_1"]) == (1, 1)


def test_columns_named_like_our_own(spark, root):
    schema = "k int, winner string, t string, owner_id int, status int, uk int, chunk int"
    at = "2020-01-01 00:00:0"
    cfg = config(
        spark,
        schema,
        [(1, "a", at + "1", 7, 0, 0, 0), (2, "b", at + "1", 8, 0, 0, 0)],
        [(1, "a", at + "2", 7, 1, 0, 0), (3, "b", at + "2", 8, 0, 0, 0)],
        root=root,
        run_mode=0,
        time_column="t",
        unique_keys=(("owner_id",),),
    )
    result = run(spark, cfg)
    copies = [rows_of(spark, s) for s in job.repaired_specs(spark, cfg, result.run_id)]
    # 2 is put on both and removes 3, which has the same owner.
    expected = [(1, "a", at + "2", 7, 1, 0, 0), (2, "b", at + "1", 8, 0, 0, 0)]
    assert copies == [expected, expected]
    assert (result.counts["status_1"], result.counts["status_2"]) == (2, 1)


def test_stronger_hash_as_an_option(spark, root):
    """CRC32 is linear: the same change at the same place of two rows cancels in their chunk."""
    copies = [(1, "a", 5), (2, "b", 5)], [(1, "A", 5), (2, "B", 6)]
    cfg = small(spark, root, *copies, run_mode=1)
    assert run(spark, cfg).counts["differing_keys"] == 0
    assert run(spark, replace(cfg, algo="xxhash64")).counts["differing_keys"] == 2
    assert run(spark, replace(cfg, chunk_size=1)).counts["differing_keys"] == 2


def test_undeclared_nulls_are_refused(spark, root):
    copies = [(1, "x", None)], [(1, None, 6)]
    with pytest.raises(Refused, match="not declared nullable: v"):
        run(spark, small(spark, root, *copies, run_mode=1, nullable_columns=("t",)))
    declared = small(spark, root, *copies, run_mode=1, nullable_columns=("v", "t"))
    assert run(spark, declared).counts["differing_keys"] == 1


@pytest.mark.parametrize(
    "named", [{"nullable_columns": ("V",)}, {"exclude_columns": ("w",)}, {"decimals": {"w": (9, 2)}}]
)
def test_unknown_names_are_refused(spark, root, named):
    with pytest.raises(Refused, match=next(iter(named))):
        run(spark, small(spark, root, run_mode=1, **named))


def test_repeated_pending_keys_are_refused(spark, root):
    cfg = small(spark, root, [(1, "a", 5), (1, "b", 7)], [(1, "c", 6)], run_mode=2)
    add_pending(spark, cfg, spark.createDataFrame([(1,)], "k int"))
    with pytest.raises(Refused, match="repeats"):
        run(spark, cfg)
    with pytest.raises(Refused, match="NULL"):
        add_pending(spark, cfg, spark.createDataFrame([(None,)], "k int"))
    assert not list(Path(root).glob("backup*"))


def test_resume_refuses_another_configuration(spark, root):
    cfg = drift.orders_config(SF, root=root, run_mode=1)
    interrupt(spark, cfg, 0)
    for change in ({"exclude_columns": ("upd", "st")}, {"replicas": cfg.replicas[:2]}):
        with pytest.raises(Refused, match="other"):
            run(spark, replace(cfg, run_mode=3, **change))
    assert run(spark, replace(cfg, run_mode=3)).status == 1


def test_root_is_needed(spark):
    with pytest.raises(Refused, match="root"):
        run(spark, small(spark, ""))


def test_refused_runs_leave_nothing_staged(spark, root):
    work = Path(spark.conf.get("spark.checkpoint.dir")) / "replicheck"
    held = lambda: sum(1 for p in work.rglob("*-[0-9]*") if p.is_dir())
    before = held()
    with pytest.raises(Refused):
        run(spark, small(spark, root, [(1, "a", 5), (1, "b", 7)], run_mode=1))
    assert held() == before


def test_outcome_leaves_other_entries(spark):
    differ = spark.createDataFrame(
        [(1, "t", 7, 0, 1), (2, "t", 8, 0, 2)],
        "id long, table_name string, pk int, status int, differ_type int",
    )
    outcome = spark.createDataFrame([(2, 4, 3)], "id long, to_status int, to_type int")
    after = repair.differ_status_update(differ, outcome).orderBy("id").collect()
    assert [(r["status"], r["differ_type"]) for r in after] == [(0, 1), (4, 3)]
