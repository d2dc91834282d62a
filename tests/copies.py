"""Small copies of a table for tests."""

from replicheck import CheckConfig, ReplicaSpec
from replicheck.sources import literal_rows


def specs(spark, schema, *copies):
    """One replica per list of rows."""
    small = all(len(rows) < 50 for rows in copies)
    frames = [
        literal_rows(spark, rows, schema) if small else spark.createDataFrame(rows, schema)
        for rows in copies
    ]
    return tuple(
        ReplicaSpec(i, f"dn{i}", reader=lambda s, df=df: df) for i, df in enumerate(frames, start=1)
    )


def config(spark, schema, *copies, **changes):
    base = dict(
        table="t",
        pk="k",
        replicas=specs(spark, schema, *copies),
        chunk_size=2,
        run_mode=1,
        nullable_columns=(),
    )
    return CheckConfig(**{**base, **changes})
