import random

import pytest
from pyspark.sql import functions as F

from copies import specs
from replicheck.operators import repair
from replicheck.sources import Workspace, key_lookup_rows, read_replicas
from walk import walk

SCHEMA = "id int, u string, t long, note string"
DIFFER = "id long, table_name string, pk int, status int, differ_type int"


def repaired(spark, ws, copies, pending, unique):
    """The same as ``walk``, with the operators."""
    tables = [[(k, *row) for k, row in copy.items()] for copy in copies]
    rows = read_replicas(spark, specs(spark, SCHEMA, *tables))
    nodes = [(i + 1, f"dn{i + 1}") for i in range(len(copies))]
    cols = ("u",) if unique else ()
    differ = spark.createDataFrame([(i, "t", k, 0, 1) for i, k in pending], DIFFER)
    todo = ws.stage(repair.pending_keys(differ, "t", "id"), "todo")
    found = ws.stage(key_lookup_rows(rows, todo, "id"), "found")
    held = repair.held_rows(found, "id", "t", "int", cols)
    holders = ws.stage(repair.tuple_holders(rows, held, "id", cols), "holders") if unique else None
    plan = ws.stage(repair.repair_plan(todo, held, "id", nodes, cols, ws), "plan")
    changes = ws.stage(
        repair.repair_changes(found, plan, "id", nodes, cols, holders), "changes"
    )
    after = []
    for ord, _ in nodes:
        own = rows.filter(F.col("ord") == ord).drop("ord", "datanode")
        done = repair.replace_into(own, changes.filter(F.col("ord") == ord), "id")
        after.append({r["id"]: (r["u"], r["t"], r["note"]) for r in done.collect()})
    backups = [
        (
            r["differ_id"],
            int(r["source_dn"][2:]),
            r["id"],
            (r["u"], r["t"], r["note"]),
            r["repair_standard"],
        )
        for r in repair.backup_rows(found, plan, "id", cols).collect()
    ]
    outcomes = {r["differ_id"]: r["status"] for r in plan.collect()}
    return outcomes, after, backups


def scenarios(seed, count, replicas):
    """Many small worlds in one table: keys and unique values of each are its own."""
    rnd = random.Random(seed)
    copies, pending = [{} for _ in range(replicas)], []
    for world in range(count):
        size = rnd.randint(1, 6)
        keys = [world * 100 + i for i in range(size)]
        values = [f"{world}:{i}" for i in range(rnd.randint(1, size + 1))] + [None, None]
        for r, copy in enumerate(copies):
            free = values[:]
            for k in keys:
                if free and rnd.random() < 0.7:
                    value = free.pop(rnd.randrange(len(free)))
                    copy[k] = (value, rnd.randint(1, 3), f"n{r}")
        todo = [k for k in keys if rnd.random() < 0.8]
        todo += [k for k in keys if rnd.random() < 0.2]
        rnd.shuffle(todo)
        pending += todo
    ids = rnd.sample(range(1, 10 * len(pending)), len(pending))
    return copies, list(zip(sorted(ids), pending))


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("replicas", [1, 2, 3])
def test_as_one_after_the_other(spark, ws, unique, replicas):
    copies, pending = scenarios(replicas, 250, replicas)
    outcomes, after, backups = walk(copies, pending, unique)
    got, got_after, got_backups = repaired(spark, ws, copies, pending, unique)
    assert got == outcomes
    assert got_after == after
    assert sorted(got_backups, key=repr) == sorted(backups, key=repr)
    assert len(set(outcomes.values())) >= (2 if replicas == 1 else 3)


def test_eviction(spark, ws):
    copies = [{5: ("x", 10, "a")}, {7: ("x", 5, "b")}]
    outcomes, after, _ = repaired(spark, ws, copies, [(1, 5), (2, 7)], True)
    assert outcomes == {1: 1, 2: 2}
    assert after == [{5: ("x", 10, "a")}] * 2


def test_long_chain_settles(spark, ws):
    """Each repair frees the next key of its conflict."""
    n = 12
    first = {k: (f"c{k}", 10 + k, "a") for k in range(n)}
    second = {k: (f"c{k - 1}", 1, "b") for k in range(1, n)}
    pending = [(k + 1, k) for k in range(n)]
    expected = walk([first, second], pending, True)
    outcomes, after, _ = repaired(spark, ws, [first, second], pending, True)
    assert outcomes == expected[0] == {k + 1: 1 for k in range(n)}
    assert after == expected[1]


def counting(monkeypatch):
    """Names of tables staged in rounds."""
    stage, names = Workspace.stage, []

    def counted(self, df, name):
        if name in ("chain", "round"):
            names.append(name)
        return stage(self, df, name)

    monkeypatch.setattr(Workspace, "stage", counted)
    return names


@pytest.mark.parametrize("order", ["ascending", "descending", "mixed"])
def test_a_thousand_shifted_codes_take_few_rounds(spark, ws, monkeypatch, order):
    n = 1000
    first = {k: (f"c{k}", 10 + k % 3, "a") for k in range(n)}
    second = {k: (f"c{k - 1}", 1 + k % 2 * 20, "b") for k in range(1, n)}
    keys = list(range(n))
    if order == "descending":
        keys.reverse()
    elif order == "mixed":
        random.Random(7).shuffle(keys)
    pending = list(enumerate(keys, start=1))
    expected = walk([first, second], pending, True)
    rounds = counting(monkeypatch)
    outcomes, after, backups = repaired(spark, ws, [first, second], pending, True)
    assert len(rounds) <= 15
    assert outcomes == expected[0]
    assert after == expected[1]
    assert sorted(backups) == sorted(expected[2])


def test_chains_that_part_and_meet(spark, ws):
    """Shifted codes on three replicas, with keys pending twice in between."""
    n = 60
    copies = [
        {k: (f"c{k}", 5 + k % 4, "a") for k in range(n)},
        {k: (f"c{k - 1}", 1 + k % 5, "b") for k in range(1, n)},
        {k: (f"c{k - 1 - k % 2}", 2 + k % 7, "c") for k in range(2, n, 3)},
    ]
    copies[2] = {k: r for i, (k, r) in enumerate(copies[2].items()) if r[0] not in
                 {x[0] for j, x in copies[2].items() if j < k}}
    rnd = random.Random(3)
    keys = [*range(n), *rnd.sample(range(n), 9)]
    for seed in range(2):
        random.Random(seed).shuffle(keys)
        pending = list(enumerate(keys, start=1))
        expected = walk(copies, pending, True)
        outcomes, after, backups = repaired(spark, ws, copies, pending, True)
        assert outcomes == expected[0] and after == expected[1]
        assert sorted(backups) == sorted(expected[2])


def test_null_in_the_unique_column(spark, ws):
    copies = [{1: (None, 3, "a"), 2: (None, 1, "a")}, {1: ("q", 4, "b"), 2: (None, 2, "b")}]
    outcomes, after, _ = repaired(spark, ws, copies, [(1, 1), (2, 2)], True)
    assert outcomes == {1: 4, 2: 1}
    assert after[0][2] == after[1][2] == (None, 2, "b")
    assert after[0][1] == copies[0][1]


def test_pending_twice(spark, ws):
    copies = [{1: ("a", 1, "x")}, {1: ("a", 2, "y")}]
    outcomes, after, backups = repaired(spark, ws, copies, [(1, 1), (2, 1)], True)
    assert outcomes == {1: 1, 2: 5}
    assert after == [{1: ("a", 2, "y")}] * 2
    assert {b[0] for b in backups} == {1}


def test_unique_faults(spark, ws):
    rows = read_replicas(spark, specs(spark, SCHEMA, [(1, "a", 1, ""), (2, "a", 1, "")]))
    held = repair.held_rows(rows.filter("id = 1"), "id", "t", "int", ("u",))
    holders = repair.tuple_holders(rows, held, "id", ("u",))
    assert repair.unique_faults(holders).count() == 1
