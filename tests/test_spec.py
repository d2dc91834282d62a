import pytest

from replicheck import CheckConfig, Refused, ReplicaSpec
from replicheck.operators.validate import refuse_unique_keys, reserved_names
from replicheck.sources import jdbc_replica
from replicheck.sources.store import shared_folder
from replicheck.spec import match_replicas

ONE = (ReplicaSpec(1, "dn1", "/x"),)


@pytest.mark.parametrize(
    "bad",
    [
        {"chunk_size": 0},
        {"parallel": -1},
        {"auto_repair_size": -1},
        {"time_format": "date"},
        {"run_mode": 4},
        {"algo": "md5"},
        {"replicas": ()},
        {"replicas": ONE * 2},
        {"pk": ""},
    ],
)
def test_bad_parameters_are_refused(bad):
    with pytest.raises(ValueError):
        CheckConfig(**{"table": "t", "pk": "k", "replicas": ONE, **bad})


def test_limits_of_parameters():
    cfg = CheckConfig("t", "k", ONE, chunk_size=1, parallel=0, auto_repair_size=0)
    assert cfg.excluded == ()
    assert CheckConfig("t", "k", ONE, time_column="u").excluded == ("u",)
    assert CheckConfig("t", "k", ONE, time_column="u", exclude_columns=()).excluded == ()


def test_nodes_follow_declared_order_and_drop_unknown_hosts():
    specs = match_replicas(
        [("b", "h2", "t"), ("x", "nowhere", "t"), ("a", "h1", "t")], {"h1": "/1", "h2": "/2"}
    )
    assert [(s.ord, s.datanode, s.source) for s in specs] == [(1, "b", "/2/t"), (2, "a", "/1/t")]


def test_unique_key_rule_by_mode():
    two = (("a",), ("b",))
    with pytest.raises(Refused):
        refuse_unique_keys(two, repairs=True)
    assert refuse_unique_keys(two, repairs=False) == ("a",)
    assert refuse_unique_keys((), repairs=True) == ()


def test_reserved_names():
    assert reserved_names(["id", "ord", "chunk"], "id") == ["ord"]
    assert reserved_names(["id", "chunk"], "chunk") == ["chunk"]
    assert reserved_names(["id", "_t", "a.b", "ORD"], "id") == ["_t", "a.b", "ORD"]


def test_jdbc_replica_options():
    """Not run: there is no database here."""
    spec = jdbc_replica(2, "dn2", "jdbc:mysql://h/db", "t", "id", (0, 10), 4, user="u")
    assert spec.format == "jdbc" and spec.source is None
    assert spec.options["partitionColumn"] == "id" and spec.options["numPartitions"] == "4"
    assert spec.options["user"] == "u"


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
