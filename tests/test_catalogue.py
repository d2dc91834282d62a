"""What a catalogue declares of replicas that are tables."""

from dataclasses import replace

import pytest

from replicheck import CheckConfig, Refused, ReplicaSpec
from replicheck.operators import validate
from replicheck.operators.validate import Declared
from replicheck.plans import job, run


@pytest.fixture
def tables(spark, tmp_path):
    names = []

    def make(columns, *rows):
        name = f"copy_{len(names)}_{tmp_path.name[-20:]}"
        names.append(name)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{tmp_path}/{name}'")
        for row in rows:
            spark.sql(f"INSERT INTO {name} VALUES {row}")
        return ReplicaSpec(len(names), f"dn{len(names)}", name, format="table")

    yield make
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def check(root, *specs, **changes):
    base = dict(table="t", pk="k", replicas=specs, root=str(root), run_mode=1)
    return CheckConfig(**{**base, **changes})


def test_defaults_that_differ_are_refused_with_the_column(spark, tables, tmp_path):
    a = tables("k int, v string DEFAULT 'x'", (1, "a"))
    b = tables("k int, v string DEFAULT 'y'", (1, "b"))
    with pytest.raises(Refused, match="'dn2', 'v', 'default'"):
        run(spark, check(tmp_path / "audit", a, b))


def test_tables_that_are_declared_alike_are_compared(spark, tables, tmp_path):
    a = tables("k int, v string DEFAULT 'x'", (1, "a"), (2, "b"))
    b = tables("k int, v string DEFAULT 'x'", (1, "a"), (2, "c"))
    assert run(spark, check(tmp_path / "audit", a, b)).counts["differing_keys"] == 1
    mixed = replace(b, source=f"{tmp_path}/{b.source}", format="parquet")
    assert run(spark, check(tmp_path / "other", a, mixed)).counts["differing_keys"] == 1


def test_views_have_no_declarations(spark):
    spark.range(3).createOrReplaceTempView("just_a_view")
    assert validate.catalogue_columns(spark, ReplicaSpec(1, "dn1", "just_a_view", format="table")) is None
    assert validate.catalogue_columns(spark, ReplicaSpec(1, "dn1", "/path")) is None


def test_not_null_and_flags(spark, tables, tmp_path, monkeypatch):
    loose = {"k": Declared(False, None), "v": Declared(True, None)}
    strict = {"k": Declared(False, None), "v": Declared(False, None)}
    assert validate.unlike_declarations([("a", None), ("b", loose), ("c", loose)]) == []
    assert validate.unlike_declarations([("a", loose), ("b", None), ("c", strict)]) == [
        ("c", "v", "nullability", "NULL", "NOT NULL")
    ]
    a, b = tables("k int, v string", (1, "a")), tables("k int, v string", (1, "b"))
    both = {a.source: loose, b.source: loose}
    monkeypatch.setattr(validate, "catalogue_columns", lambda spark, spec: both[spec.source])
    part = job.TableRun(spark, check(tmp_path / "audit", a, b))
    part.preflight()
    assert part.nullable == ["v"] and part.watched == []
    both[b.source] = strict
    with pytest.raises(Refused, match="NOT NULL"):
        run(spark, check(tmp_path / "audit", a, b))
    given = job.TableRun(spark, check(tmp_path / "audit", a, a.__class__(2, "dn2", a.source, format="table"), nullable_columns=()))
    given.preflight()
    assert given.nullable == []
