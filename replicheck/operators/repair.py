"""Repair of differing keys: the newest row wins and is put on every replica."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replicheck.functions.times import time_value
from replicheck.operators.checksum import Nodes
from replicheck.sources.store import Workspace
from replicheck.spec import DELETED, FAILED, MANUAL, PENDING, REPAIRED, UNIQUE_CONFLICT


def pending_keys(differ: DataFrame, table: str, pk: str) -> DataFrame:
    """Entries not yet dealt with, also those of earlier runs or put in by hand."""
    seen = ["files"] if "files" in differ.columns else []
    return differ.filter((F.col("status") == PENDING) & (F.col("table_name") == table)).select(
        F.col("id").alias("differ_id"), F.col("pk").alias(pk), "differ_type", *seen
    )


def repair_limit(pending: DataFrame, limit: int) -> DataFrame:
    """Pending entries, the limit (0: none), and whether there are too many to repair."""
    return pending.agg(F.count("*").alias("pending")).select(
        "pending",
        F.lit(limit).cast("bigint").alias("repair_limit"),
        (F.lit(limit > 0) & (F.col("pending") > limit)).alias("refused"),
    )


def held_rows(
    found: DataFrame,
    pk: str,
    time_column: str,
    time_format: str,
    unique_cols: Sequence[str] = (),
) -> DataFrame:
    """What decides a repair, from the rows found for the pending keys: ``(pk, ord, t, uk)``;
    ``uk`` is the unique tuple, NULL where the table has no unique key."""
    t = time_value(time_column, found.schema[time_column].dataType, time_format)
    uk = F.struct(*unique_cols) if unique_cols else F.lit(None).cast("string")
    return found.select(pk, "ord", t.alias("t"), uk.alias("uk"))


def bad_times(held: DataFrame, pk: str) -> DataFrame:
    """Rows of pending keys whose time orders nothing. A repair must not start with any."""
    return held.filter(F.col("t").isNull()).select(pk, "ord")


def unique_conflict(held: DataFrame, pk: str) -> DataFrame:
    """Keys with several unique tuples among their replicas. NULL equals NULL here."""
    return (
        held.groupBy(pk)
        .agg(F.min("uk").alias("low"), F.max("uk").alias("high"))
        .filter(~F.col("low").eqNullSafe(F.col("high")))
        .select(pk)
    )


def _newest(t: str = "t") -> Column:
    """Order of a key's rows: the latest time, and the first replica among equal times."""
    return F.struct(F.col(t), -F.col("ord"))


def latest_row(rows: DataFrame, pk: str, time_column: str, time_format: str) -> DataFrame:
    """The winning row of each key, whole, with the replica it comes from."""
    t = time_value(time_column, rows.schema[time_column].dataType, time_format)
    return (
        rows.withColumn("_t", t)
        .groupBy(pk)
        .agg(F.max_by(F.struct(*rows.columns), _newest("_t")).alias("row"))
        .select("row.*")
    )


def same_time_rule(held: DataFrame, pk: str) -> DataFrame:
    """Keys that two or more replicas hold, all with one time: no row is the newest."""
    return (
        held.groupBy(pk)
        .agg(F.count("*").alias("np"), F.min("t").alias("first"), F.max("t").alias("last"))
        .filter((F.col("np") > 1) & (F.col("first") == F.col("last")))
        .select(pk)
    )


def deleted_rule(held: DataFrame, pending: DataFrame, pk: str) -> DataFrame:
    """Pending keys that no replica holds any more."""
    return pending.select(pk).distinct().join(held.select(pk), pk, "left_anti")


def _full(uk: Column, unique_cols: Sequence[str]) -> Column:
    """A tuple with a NULL in it is in nobody's way."""
    full = F.lit(True)
    for c in unique_cols:
        full = full & uk[c].isNotNull()
    return full


def _facts(held: DataFrame, by: Sequence[str]) -> DataFrame:
    """Status and winner by the rows that are held."""
    facts = held.groupBy(*by).agg(
        F.count("ord").alias("np"),
        F.min("t").alias("first"),
        F.max("t").alias("last"),
        F.min("uk").alias("low"),
        F.max("uk").alias("uk"),
        F.max_by("ord", F.when(F.col("ord").isNotNull(), _newest())).alias("winner"),
    )
    status = (
        F.when(~F.col("low").eqNullSafe(F.col("uk")), FAILED)
        .when((F.col("np") > 1) & (F.col("first") == F.col("last")), MANUAL)
        .when(F.col("np") == 0, DELETED)
        .otherwise(REPAIRED)
    )
    return facts.select(*by, status.alias("status"), "winner", "uk")


def _after_first_repair(outcome: DataFrame, pk: str, replicas: int, done_id: Column) -> DataFrame:
    """A key pending again after its repair: all replicas hold one row of one time."""
    again = F.coalesce((F.col("status") == REPAIRED) & (F.col("differ_id") > done_id), F.lit(False))
    status = F.when(again, F.lit(MANUAL if replicas > 1 else REPAIRED)).otherwise(F.col("status"))
    return outcome.withColumn("status", status).select(
        "differ_id",
        pk,
        "status",
        F.when(F.col("status") == REPAIRED, F.col("winner")).alias("winner"),
        "uk",
    )


def _plain_outcomes(entries: DataFrame, held: DataFrame, pk: str, replicas: int) -> DataFrame:
    """Outcomes of entries whose keys no other pending key can touch: those of their keys."""
    first = entries.groupBy(pk).agg(F.min("differ_id").alias("first_id"))
    by_key = first.join(_facts(held, [pk]), pk, "left")
    gone = F.coalesce(F.col("status"), F.lit(DELETED))
    outcome = entries.join(by_key.withColumn("status", gone), pk)
    return _after_first_repair(outcome, pk, replicas, F.col("first_id"))


def _tied_outcomes(
    entries: DataFrame, held: DataFrame, pk: str, replicas: int, owners: DataFrame | None
) -> DataFrame:
    """Outcomes of entries one by one, given which entry takes over which unique tuple."""
    seen = entries.join(held, pk, "left")
    if owners is not None:
        seen = seen.join(owners, F.col("uk") == F.col("_owner_uk"), "left")
        gone = (F.col("_owner_id") < F.col("differ_id")) & (F.col("_owner_pk") != F.col(pk))
        kept = ~F.coalesce(gone, F.lit(False))
        left = [F.when(kept, F.col(c)).alias(c) for c in ("ord", "t", "uk")]
        seen = seen.select("differ_id", pk, *left)
    alone = _facts(seen, ["differ_id", pk])
    done = (
        alone.filter(F.col("status") == REPAIRED)
        .groupBy(pk)
        .agg(F.min("differ_id").alias("done_id"))
    )
    fixed_before = F.col("differ_id") > F.col("done_id")
    outcome = alone.join(done, pk, "left").withColumn(
        "status", F.when(fixed_before, F.lit(REPAIRED)).otherwise(F.col("status"))
    )
    return _after_first_repair(outcome, pk, replicas, F.col("done_id"))


def tuple_owners(plan: DataFrame, pk: str, unique_cols: Sequence[str]) -> DataFrame:
    """The entry that puts each unique tuple on all replicas: the first one repaired."""
    return (
        plan.filter(F.col("winner").isNotNull() & _full(F.col("uk"), unique_cols))
        .groupBy(F.col("uk").alias("_owner_uk"))
        .agg(
            F.min("differ_id").alias("_owner_id"), F.min_by(pk, "differ_id").alias("_owner_pk")
        )
    )


def _contested(held: DataFrame, pk: str, unique_cols: Sequence[str]) -> DataFrame:
    """Pending keys that hold a unique tuple which another pending key holds, too."""
    full = held.filter(_full(F.col("uk"), unique_cols))
    shared = (
        full.groupBy("uk")
        .agg(F.min(pk).alias("low"), F.max(pk).alias("high"))
        .filter(F.col("low") != F.col("high"))
    )
    return full.join(shared.select("uk"), "uk", "left_semi").select(pk).distinct()


def _moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Entries whose outcome is another than in the round before."""
    told = ("status", "winner", "uk")
    was = before.select("differ_id", *[F.col(c).alias(f"was_{c}") for c in told])
    same = F.lit(True)
    for c in told:
        same = same & F.col(c).eqNullSafe(F.col(f"was_{c}"))
    return after.join(was, "differ_id").filter(~same)


def _links(entries: DataFrame, held: DataFrame, pk: str, unique_cols: Sequence[str]) -> DataFrame:
    """Each key that earlier entries of other keys may take rows from: ``(pk, before, alone,
    shared)`` with one of those keys, whether it is the only one and both are pending once, and
    the tuples both hold. A tuple has no more holders than there are replicas."""
    full = held.filter(_full(F.col("uk"), unique_cols)).select(pk, "uk").distinct()
    ids = entries.groupBy(pk).agg(
        F.min("differ_id").alias("first"), F.max("differ_id").alias("last"), F.count("*").alias("n")
    )
    mine = full.join(ids, pk)
    theirs = mine.select(
        "uk",
        F.col(pk).alias("before"),
        F.col("first").alias("before_first"),
        F.col("n").alias("before_n"),
    )
    return (
        mine.join(theirs, "uk")
        .filter((F.col("before") != F.col(pk)) & (F.col("before_first") < F.col("last")))
        .groupBy(pk)
        .agg(
            F.min("before").alias("before"),
            (
                (F.min("before") == F.max("before")) & (F.max("n") == 1) & (F.max("before_n") == 1)
            ).alias("alone"),
            F.collect_set("uk").alias("shared"),
        )
    )


def _put(out: Column, unique_cols: Sequence[str]) -> Column:
    """The unique tuple that an outcome puts on all replicas, NULL where none can be in the way."""
    return F.when(out["winner"].isNotNull() & _full(out["uk"], unique_cols), out["uk"])


def _given(base: Column, cases: Column, put: Column) -> Column:
    """A key's outcome once the key before it has put a tuple."""
    return F.coalesce(F.get(F.filter(cases, lambda c: c["put"] == put), F.lit(0))["out"], base)


def _chains(
    entries: DataFrame, held: DataFrame, links: DataFrame, pk: str, unique_cols: Sequence[str], ws: Workspace
) -> DataFrame:
    """Keys that depend on one other key alone, as functions of what a key further ahead puts,
    which itself is no such key: ``(differ_id, pk, before, base, cases)``.

    Such keys form chains. At first each is a function of the key before it: ``base`` if that
    one puts no shared tuple, else the case of the tuple. Then, round by round, each is combined
    with the one it depends on, which doubles the distance: a chain of n keys takes log2(n)
    rounds, not n.
    """
    alone = links.filter("alone").select(pk, "before", "shared")
    puts = alone.select(
        pk, F.explode(F.concat(F.array(F.lit(None).cast(held.schema["uk"].dataType)), "shared")).alias("put")
    )
    evicted = F.coalesce(F.col("uk") == F.col("put"), F.lit(False))
    seen = held.join(puts, pk).select(
        pk, "put", *[F.when(~evicted, F.col(c)).alias(c) for c in ("ord", "t", "uk")]
    )
    out = F.struct(
        "status", F.when(F.col("status") == REPAIRED, F.col("winner")).alias("winner"), "uk"
    )
    functions = (
        _facts(seen, [pk, "put"])
        .select(pk, "put", out.alias("out"))
        .groupBy(pk)
        .agg(
            F.max(F.when(F.col("put").isNull(), F.col("out"))).alias("base"),
            F.collect_list(F.when(F.col("put").isNotNull(), F.struct("put", "out"))).alias("cases"),
        )
    )
    nodes = alone.select(F.col(pk).alias("before"), F.lit(True).alias("open"))
    step = ws.stage(
        entries.join(functions, pk)
        .join(alone.drop("shared"), pk)
        .join(nodes, "before", "left")
        .select("differ_id", pk, "before", "base", "cases", F.coalesce("open", F.lit(False)).alias("open")),
        "chain",
    )
    while not step.filter("open").isEmpty():
        ahead = step.select(
            F.col(pk).alias("before"),
            F.col("before").alias("further"),
            F.col("base").alias("ahead_base"),
            F.col("cases").alias("ahead_cases"),
            F.col("open").alias("ahead_open"),
        )

        def after(out: Column) -> Column:
            return _given(F.col("base"), F.col("cases"), _put(out, unique_cols))

        combined = step.filter("open").join(ahead, "before").select(
            "differ_id",
            pk,
            F.col("further").alias("before"),
            after(F.col("ahead_base")).alias("base"),
            F.transform(
                "ahead_cases", lambda c: F.struct(c["put"].alias("put"), after(c["out"]).alias("out"))
            ).alias("cases"),
            F.col("ahead_open").alias("open"),
        )
        step = ws.stage(step.filter("NOT open").unionByName(combined), "chain")
    return step.drop("open")


def _along(chains: DataFrame, plan: DataFrame, pk: str, unique_cols: Sequence[str]) -> DataFrame:
    """Outcomes of keys in chains, given those of the keys that the chains depend on."""
    ahead = plan.select(F.col(pk).alias("before"), F.struct("status", "winner", "uk").alias("ahead"))
    put = _put(F.col("ahead"), unique_cols)
    out = _given(F.col("base"), F.col("cases"), put)
    return chains.join(ahead, "before").select("differ_id", pk, out.alias("out")).select(
        "differ_id", pk, "out.status", "out.winner", "out.uk"
    )


def repair_outcomes(
    pending: DataFrame,
    held: DataFrame,
    pk: str,
    replicas: int,
    unique_cols: Sequence[str],
    ws: Workspace,
) -> DataFrame:
    """``(differ_id, pk, status, winner, uk)`` of each pending entry, in ascending id as if one
    after the other; ``winner`` is the replica whose row is put on all, ``uk`` its tuple.

    Putting a row on a replica also removes another key's row with the same unique tuple. A
    later entry of that key then sees less. Keys that no earlier entry can touch have their
    outcomes by themselves, keys that only one can touch follow along chains (``_chains``). What
    several earlier entries can touch is computed again from the owners of tuples that all
    outcomes imply, until it stays the same. An entry depends on entries with smaller ids alone:
    each round settles at least the next of those entries on every way through them, and what no
    longer changes is the one-after-the-other result.
    """
    entries = pending.select("differ_id", pk)
    if not unique_cols:
        return _plain_outcomes(entries, held, pk, replicas)
    contested = ws.stage(_contested(held, pk, unique_cols), "contested")
    if contested.isEmpty():
        return _plain_outcomes(entries, held, pk, replicas)
    free = entries.join(contested, pk, "left_anti")
    tied = ws.stage(entries.join(contested, pk, "left_semi"), "tied")
    tied_held = ws.stage(held.join(contested, pk, "left_semi"), "tied_held")
    links = ws.stage(_links(tied, tied_held, pk, unique_cols), "links")
    first = tied.join(links, pk, "left_anti")
    first_held = tied_held.join(links, pk, "left_anti")
    fixed = ws.stage(_tied_outcomes(first, first_held, pk, replicas, None), "first")
    chains = _chains(tied, tied_held, links, pk, unique_cols, ws)
    several = links.filter("NOT alone").select(pk)
    moving = ws.stage(tied.join(several, pk, "left_semi"), "moving")
    if moving.isEmpty():
        plan = fixed.unionByName(_along(chains, fixed, pk, unique_cols))
        return _plain_outcomes(free, held, pk, replicas).unionByName(plan)
    moving_held = ws.stage(tied_held.join(several, pk, "left_semi"), "moving_held")
    last = ws.stage(_tied_outcomes(moving, moving_held, pk, replicas, None), "round")
    while True:
        heads = fixed.unionByName(last)
        plan = heads.unionByName(_along(chains, heads, pk, unique_cols))
        owners = tuple_owners(plan, pk, unique_cols)
        now = ws.stage(_tied_outcomes(moving, moving_held, pk, replicas, owners), "round")
        if _moved(last, now).isEmpty():
            return _plain_outcomes(free, held, pk, replicas).unionByName(plan)
        last = now


def repair_plan(
    pending: DataFrame,
    held: DataFrame,
    pk: str,
    nodes: Nodes,
    unique_cols: Sequence[str],
    ws: Workspace,
) -> DataFrame:
    """One row per pending entry: ``(differ_id, pk, status, differ_type, winner, uk)``."""
    outcome = repair_outcomes(pending, held, pk, len(nodes), unique_cols, ws)
    kinds = pending.select("differ_id", F.col("differ_type").alias("was"))
    return outcome.join(kinds, "differ_id").select(
        "differ_id",
        pk,
        F.col("status").cast("int").alias("status"),
        F.when(F.col("status") == FAILED, F.lit(UNIQUE_CONFLICT))
        .otherwise(F.col("was"))
        .cast("int")
        .alias("differ_type"),
        "winner",
        "uk",
    )


def duplicate_pending(plan: DataFrame, pk: str) -> DataFrame:
    """Entries of keys that are pending more than once, with their outcomes."""
    several = plan.groupBy(pk).agg(F.count("*").alias("n")).filter("n > 1")
    return plan.join(several.select(pk), pk, "left_semi")


def _winners(plan: DataFrame, pk: str) -> DataFrame:
    fixed = plan.filter(F.col("winner").isNotNull())
    return fixed.select(pk, F.col("winner").alias("_winner"), "differ_id")


def backup_rows(
    found: DataFrame, plan: DataFrame, pk: str, unique_cols: Sequence[str] = ()
) -> DataFrame:
    """Rows of the keys to repair as they stand before, on every replica that holds them, from
    the rows found for the pending keys."""
    before = found.join(_winners(plan, pk), pk)
    if unique_cols:
        owners = tuple_owners(plan, pk, unique_cols)
        lost = (
            (F.struct(*unique_cols) == F.col("_owner_uk"))
            & (F.col("_owner_id") < F.col("differ_id"))
            & (F.col("_owner_pk") != F.col(pk))
        )
        before = before.join(owners, lost, "left_anti")
    columns = [c for c in found.columns if c not in ("ord", "datanode")]
    return before.select(
        *columns,
        F.col("datanode").alias("source_dn"),
        (F.col("ord") == F.col("_winner")).cast("int").alias("repair_standard"),
        "differ_id",
    )


def tuple_holders(
    rows: DataFrame,
    held: DataFrame,
    pk: str,
    unique_cols: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row ``(ord, pk, uk)``, pending or not, with a unique tuple that a pending key holds.
    Reads the key and the unique columns only, and what else is to be kept."""
    tuples = held.filter(_full(F.col("uk"), unique_cols)).select("uk").distinct()
    narrow = rows.select("ord", pk, F.struct(*unique_cols).alias("uk"), *keep)
    return narrow.join(tuples, "uk", "left_semi").select("ord", pk, "uk", *keep)


def unique_faults(holders: DataFrame) -> DataFrame:
    """Tuples that one replica holds more than once although they should be unique."""
    return holders.groupBy("ord", "uk").agg(F.count("*").alias("n")).filter("n > 1")


def replace_evicts(
    holders: DataFrame, plan: DataFrame, pk: str, unique_cols: Sequence[str]
) -> DataFrame:
    """Rows ``(ord, pk)`` that leave a replica because a repaired row of another key has
    their unique tuple."""
    owners = tuple_owners(plan, pk, unique_cols)
    return (
        holders.join(owners, F.col("uk") == F.col("_owner_uk"))
        .filter(F.col(pk) != F.col("_owner_pk"))
        .select("ord", pk)
    )


def repair_changes(
    found: DataFrame,
    plan: DataFrame,
    pk: str,
    nodes: Nodes,
    unique_cols: Sequence[str] = (),
    holders: DataFrame | None = None,
) -> DataFrame:
    """The change set: per replica, rows to put (``op`` 'put') and keys to take out ('del'),
    from the rows found for the pending keys.

    Its size is that of the differences, not of the table. Putting a row replaces the row of
    the same key. A table with a unique key needs the ``holders`` of its pending tuples.
    """
    columns = [c for c in found.columns if c not in ("ord", "datanode")]
    every = F.array(*[F.lit(o).cast("int") for o, _ in nodes])
    winners = _winners(plan, pk).select(pk, "_winner").distinct()
    puts = (
        found.join(winners, pk)
        .filter(F.col("ord") == F.col("_winner"))
        .select(F.explode(every).alias("ord"), F.lit("put").alias("op"), *columns)
    )
    if not unique_cols:
        return puts
    gone = replace_evicts(holders, plan, pk, unique_cols).join(winners, pk, "left_anti")
    return puts.unionByName(
        gone.select("ord", F.lit("del").alias("op"), pk), allowMissingColumns=True
    )


def changed_files(places: DataFrame, changes: DataFrame, pk: str, file: str) -> DataFrame:
    """``(ord, file)`` of files with a row that the changes replace or take out, from the places
    ``(ord, pk, file)`` of rows."""
    changed = changes.select("ord", pk).distinct()
    known = places.filter(F.col(file).isNotNull())
    return known.join(changed, ["ord", pk]).select("ord", F.col(file).alias("file")).distinct()


def replace_into(replica: DataFrame, changes: DataFrame, pk: str) -> DataFrame:
    """One replica after its changes: changed keys taken out, rows to put added. Keys compare
    as in the changes, which carry the collation."""
    changed = changes.select(F.col(pk).alias("_changed"))
    same = F.col(pk).cast(changes.schema[pk].dataType) == F.col("_changed")
    puts = changes.filter(F.col("op") == "put").select(
        *[F.col(f.name).cast(f.dataType) for f in replica.schema.fields]
    )
    return replica.join(changed, same, "left_anti").unionByName(puts)


def differ_outcome(plan: DataFrame) -> DataFrame:
    """What becomes of each entry, as it is appended beside the differing keys."""
    return plan.select(
        F.col("differ_id").alias("id"),
        F.col("status").alias("to_status"),
        F.col("differ_type").alias("to_type"),
    )


def differ_status_update(differ: DataFrame, outcome: DataFrame) -> DataFrame:
    """Differing keys with the outcomes written in, by id."""
    changes = outcome.select("id", "to_status", "to_type")
    seen = ["files"] if "files" in differ.columns else []
    return differ.join(changes, "id", "left").select(
        "id",
        "table_name",
        "pk",
        F.coalesce("to_status", "status").alias("status"),
        F.coalesce("to_type", "differ_type").alias("differ_type"),
        *seen,
    )
