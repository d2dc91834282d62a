"""One query per operator, each over whole tables below ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries import drift
from replicheck.functions import text, times
from replicheck.operators import checksum, compare, keys, repair, validate
from replicheck.plans import job
from replicheck.plans.runlog import RunLog
from replicheck.sources import (
    AuditStore,
    Workspace,
    literal_rows,
    read_replica,
    read_replicas,
    readers,
)
from replicheck.spec import CheckConfig, ReplicaSpec, match_replicas

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Keys of the orders replicas that were put in by hand and that no replica holds.
ABSENT_KEYS = 10_000_000
# What is added to keys so that they need more than 32 bits.
WIDE_KEYS = 3_000_000_000


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


class Check:
    """The steps of a check over one set of replicas, computed as they are asked for."""

    def __init__(self, spark: SparkSession, cfg: CheckConfig):
        self.spark, self.cfg, self.pk, self.nodes = spark, cfg, cfg.pk, cfg.nodes
        self.ws = Workspace(spark)
        self.rows = read_replicas(spark, cfg.replicas)
        self.columns = validate.checksum_columns(self.rows.schema, cfg.excluded)
        self.unique_cols = validate.refuse_unique_keys(cfg.unique_keys, cfg.repairs)

    def crcs(self) -> DataFrame:
        return checksum.row_checksums(
            self.rows, self.pk, self.columns, self.cfg.nullable_columns, self.cfg.decimals
        )

    def chunked(self) -> DataFrame:
        return checksum.chunk_keys(
            self.rows,
            self.pk,
            self.columns,
            self.cfg.nullable_columns,
            self.nodes,
            self.cfg.chunk_size,
            self.ws,
            decimals=self.cfg.decimals,
        )

    def key_chunks(self) -> DataFrame:
        universe = keys.key_universe(self.rows, self.pk)
        return keys.chunk_assign(universe, self.pk, self.cfg.chunk_size, self.ws)

    def chunks(self, chunked: DataFrame) -> DataFrame:
        return checksum.chunk_checksum(chunked, self.pk, self.nodes, self.cfg.table)

    def drilled(self) -> DataFrame:
        chunked = self.chunked()
        differing = compare.chunk_differ(self.chunks(chunked), len(self.nodes))
        return compare.drill_keys(chunked, differing)

    def differing(self) -> DataFrame:
        found = compare.key_differ(self.drilled(), self.pk, self.nodes)
        return self.ws.stage(found, "found")

    def differ(self) -> DataFrame:
        return compare.numbered_differ(self.differing(), self.pk, self.cfg.table, self.ws)

    def pending(self) -> DataFrame:
        pending = repair.pending_keys(self.differ(), self.cfg.table, self.pk)
        return self.ws.stage(pending, "pending")

    def found(self, pending: DataFrame) -> DataFrame:
        """Whole rows of the pending keys: what a repair reads of the replicas."""
        return self.ws.stage(readers.key_lookup_rows(self.rows, pending, self.pk), "found_rows")

    def held(self, found: DataFrame) -> DataFrame:
        cfg = self.cfg
        return repair.held_rows(
            found, self.pk, cfg.time_column, cfg.time_format, self.unique_cols
        )

    def plan(self, pending: DataFrame, found: DataFrame) -> DataFrame:
        plan = repair.repair_plan(
            pending, self.held(found), self.pk, self.nodes, self.unique_cols, self.ws
        )
        return self.ws.stage(plan, "plan")

    def planned(self) -> tuple[DataFrame, DataFrame]:
        """Rows found for the pending keys, and the plan made from them."""
        pending = self.pending()
        found = self.found(pending)
        return found, self.plan(pending, found)

    def holders(self, plan: DataFrame) -> DataFrame:
        return repair.tuple_holders(self.rows, plan, self.pk, self.unique_cols)

    def changes(self, found: DataFrame, plan: DataFrame) -> DataFrame:
        changes = repair.repair_changes(
            found, plan, self.pk, self.nodes, self.unique_cols, self.holders(plan)
        )
        return self.ws.stage(changes, "changes")

    def repaired(self) -> DataFrame:
        return job.read_changed(self.spark, self.cfg, self.changes(*self.planned()))


def orders(spark: SparkSession, sf_dir: str, **changes) -> Check:
    return Check(spark, drift.orders_config(sf_dir, **changes))


def parts(spark: SparkSession, sf_dir: str) -> Check:
    return Check(spark, drift.part_config(sf_dir))


# Scans and sinks


@query
def replica_union(spark, sf_dir):
    return orders(spark, sf_dir).rows


@query
def matched_replicas(spark, sf_dir):
    """Three declared nodes, of which one names a host that is not declared."""
    nodes = [
        ("dn1", "host1", "customer.parquet"),
        ("dn2", "gone", "customer.parquet"),
        ("dn3", "host1", "customer.parquet"),
    ]
    rows = read_replicas(spark, match_replicas(nodes, {"host1": sf_dir}))
    return rows.select("ord", "datanode", "c_custkey", "c_name")


@query
def key_scan(spark, sf_dir):
    return readers.key_scan(orders(spark, sf_dir).rows, "id")


@query
def key_range_scan(spark, sf_dir):
    """The middle half of the key range, on every replica."""
    c = orders(spark, sf_dir)
    low, high = keys.key_min_max(keys.key_universe(c.rows, "id"), "id").first()
    return readers.key_range_scan(c.rows, "id", low + (high - low) // 4, high - (high - low) // 4)


@query
def key_lookup_rows(spark, sf_dir):
    c = orders(spark, sf_dir)
    return readers.key_lookup_rows(c.rows, c.pending(), "id")


def _in_files(c: Check, partitions: int = 8) -> CheckConfig:
    """The same check over copies that lie in files, as Spark writes them."""
    specs = []
    for s in c.cfg.replicas:
        path = f"{c.ws.path}/copies/{s.datanode}"
        copy = read_replica(c.spark, s).repartitionByRange(partitions, c.pk)
        copy.write.mode("overwrite").parquet(path)
        specs.append(ReplicaSpec(s.ord, s.datanode, path))
    return replace(c.cfg, replicas=tuple(specs), root=f"{c.ws.path}/audit")


@query
def located_rows(spark, sf_dir):
    """Rows of differing keys, from the files that the check saw them in."""
    c = orders(spark, sf_dir)
    cfg = _in_files(c)
    job.run(spark, replace(cfg, run_mode=1))
    part = job.TableRun(spark, replace(cfg, run_mode=2))
    part.preflight()
    pending = c.ws.stage(repair.pending_keys(part.differ(), cfg.table, cfg.pk), "located")
    return part._lookup(pending).select(c.rows.columns)


@query
def unique_cols_lookup(spark, sf_dir):
    c = orders(spark, sf_dir)
    return readers.unique_cols_lookup(c.rows, c.pending(), "id", ["uk"])


def _store(c: Check) -> AuditStore:
    return AuditStore(c.spark, f"{c.ws.path}/audit", c.cfg.table)


@query
def write_keys_overwrite(spark, sf_dir):
    """Keys of another table are written first; what is read back are those of orders."""
    c = orders(spark, sf_dir)
    store = _store(c)
    store.overwrite("keys", drift.table(spark, sf_dir, "part").selectExpr("p_partkey AS id"))
    return store.overwrite("keys", keys.key_universe(c.rows, "id"))


def _append_run(store: AuditStore, c: Check, found: DataFrame) -> None:
    known = store.read("differ")
    last = known.agg(F.max("id")).first()[0] if known is not None else 0
    entries = compare.numbered_differ(found, c.pk, c.cfg.table, c.ws, last)
    store.append("differ", entries)


@query
def write_differ_append(spark, sf_dir):
    """The differing keys of two runs: each key is there twice, under its own id."""
    c = orders(spark, sf_dir)
    store, found = _store(c), c.differing()
    _append_run(store, c, found)
    _append_run(store, c, found)
    return store.read("differ")


@query
def clear_working_tables(spark, sf_dir):
    c = orders(spark, sf_dir)
    store, chunked = _store(c), c.chunked()
    chunks = store.overwrite("chunk", c.chunks(chunked))
    store.overwrite("keys", chunked.select("id", "rn", "chunk"))
    store.overwrite("chunk_differ", compare.chunk_differ(chunks, 3))
    before = {name: store.read(name).count() for name in ("keys", "chunk", "chunk_differ")}
    store.clear_working_tables()
    return literal_rows(
        spark,
        [(name, n, store.read(name).count()) for name, n in before.items()],
        "working_table string, rows_before bigint, rows_after bigint",
    )


# Validation


def _text_copies(c: Check, kind: str, changed: dict[int, dict]) -> list[ReplicaSpec]:
    """Copies of a table in files that carry no types, with columns changed by replica: what
    columns there are and of which type is for the rows to say."""
    specs = []
    for s in c.cfg.replicas:
        path = f"{c.ws.path}/{kind}/{s.datanode}"
        copy = read_replica(c.spark, s).withColumns(changed.get(s.ord, {}))
        copy.write.mode("overwrite").format(kind).option("header", True).save(path)
        options = {"header": "true", "inferSchema": "true"}
        specs.append(ReplicaSpec(s.ord, s.datanode, path, format=kind, options=options))
    return specs


# Statuses of orders that a node each holds; some node holds none.
STATUSES = ("F", "O", "P", "X")


@query
def table_on_all_replicas(spark, sf_dir):
    """Orders dealt to nodes by their status: whether each node has got a table, and its rows."""
    ws = Workspace(spark)
    base = f"{ws.path}/by_status"
    drift.table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(base)
    specs = [
        ReplicaSpec(i, f"dn{i}", f"{base}/o_orderstatus={st}") for i, st in enumerate(STATUSES, 1)
    ]
    present = ws.stage(validate.table_on_all_replicas(spark, specs), "present")
    there = {r["ord"] for r in present.filter("exists").collect()}
    rows = read_replicas(spark, [s for s in specs if s.ord in there])
    counts = rows.groupBy("ord").agg(F.count("*").alias("cnt"))
    return present.join(counts, "ord", "left").fillna(0, ["cnt"])


@query
def schema_equal(spark, sf_dir):
    """Copies of orders in JSON. Some prices on dn2 are words, and no row on dn3 has a time."""
    c = orders(spark, sf_dir)
    words = F.when(F.col("id") % 1000 != 7, F.col("price").cast("string")).otherwise("n/a")
    numbers = F.col("price").cast("double")
    late = F.when(F.col("cust").isNull(), F.col("upd"))
    changed = {1: {"price": numbers}, 2: {"price": words}, 3: {"price": numbers, "upd": late}}
    copies = [(s.ord, s.datanode, read_replica(spark, s)) for s in _text_copies(c, "json", changed)]
    return validate.schema_equal(spark, copies)


@query
def pk_single(spark, sf_dir):
    """``orders`` has a single key, ``lineitem`` by its order alone has none."""
    lines = drift.table(spark, sf_dir, "lineitem").select(
        F.lit(0).alias("ord"), F.col("l_orderkey").alias("id")
    )
    rows = orders(spark, sf_dir).rows.select("ord", "id").unionByName(lines)
    return validate.pk_single(rows, "id")


@query
def pending_key_faults(spark, sf_dir):
    """Orders of several lines: as a key of ``lineitem`` they repeat."""
    lines = drift.table(spark, sf_dir, "lineitem").select(
        F.lit(1).alias("ord"), F.col("l_orderkey").alias("id")
    )
    return validate.pending_key_faults(lines, "id")


@query
def undeclared_null_faults(spark, sf_dir):
    """NULLs that a check of orders would not see if ``prio`` were not declared nullable."""
    c = orders(spark, sf_dir)
    return validate.undeclared_null_faults(c.rows, c.columns, ())


@query
def pk_type(spark, sf_dir):
    """Key types of copies in CSV, after keys were stored from dn1: those of dn2 are larger
    numbers, those of dn3 are words."""
    c = orders(spark, sf_dir)
    changed = {2: {"id": F.col("id") + WIDE_KEYS}, 3: {"id": F.concat(F.lit("K"), "id")}}
    specs = _text_copies(c, "csv", changed)
    copies = {s.ord: read_replica(spark, s).withColumnRenamed("id", "key") for s in specs}
    store = _store(c)
    stored = store.overwrite("keys", keys.key_universe(copies[1], "key")).schema
    types = [
        validate.pk_type(copies[s.ord].withColumn("ord", F.lit(s.ord)), "key", stored)
        for s in specs
    ]
    return types[0].unionByName(types[1]).unionByName(types[2])


@query
def unique_key_rule(spark, sf_dir):
    """``uk`` of orders is unique, ``cust`` is not."""
    c = orders(spark, sf_dir)
    a, b = [
        validate.unique_key_rule(c.rows, [col]).select(F.lit(col).alias("unique_key"), "*")
        for col in ("uk", "cust")
    ]
    return a.unionByName(b)


@query
def time_column_exists(spark, sf_dir):
    """Copies of orders in JSON, of which dn3 has no row with a time."""
    c = orders(spark, sf_dir)
    late = F.when(F.col("cust").isNull(), F.col("upd"))
    specs = _text_copies(c, "json", {3: {"upd": late}})
    copies = [(s.ord, s.datanode, read_replica(spark, s)) for s in specs]
    found = validate.time_column_exists(copies, "upd")
    return literal_rows(spark, found, "ord int, datanode string, exists boolean")


def _event_times(spark, sf_dir) -> DataFrame:
    """Times of events as text, some of them broken, and as integers, some of them NULL."""
    key, ts = F.col("event_id"), F.col("ts")
    written = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return drift.table(spark, sf_dir, "events").select(
        (key % 2 + 1).cast("int").alias("ord"),
        key,
        F.when(key % 31 == 0, F.substring(written, 1, 10)).otherwise(written).alias("as_text"),
        F.when(key % 37 != 0, drift.epoch(ts)).alias("as_int"),
    )


@query
def time_format_probe(spark, sf_dir):
    rows = _event_times(spark, sf_dir)
    a = validate.time_format_probe(rows, "as_text", "str")
    b = validate.time_format_probe(rows, "as_int", "int")
    return a.withColumn("time_format", F.lit("str")).unionByName(
        b.withColumn("time_format", F.lit("int"))
    )


@query
def empty_table_guard(spark, sf_dir):
    """Run status of a check over orders, and over copies of orders that hold no row."""
    cfg = drift.orders_config(sf_dir, run_mode=1)
    empty = tuple(
        replace(s, reader=lambda sp, s=s: read_replica(sp, s).filter(F.col("id") < F.lit(0)))
        for s in cfg.replicas
    )
    ws = Workspace(spark)
    out = []
    for name, c in (("orders", cfg), ("no_rows", replace(cfg, replicas=empty))):
        status = job.run(spark, replace(c, table=name, root=f"{ws.path}/audit")).status
        out.append((name, validate.empty_table_guard(read_replicas(spark, c.replicas)), status))
    return literal_rows(spark, out, "table_name string, is_empty boolean, status int")


@query
def checksum_columns(spark, sf_dir):
    """Columns of orders in declared order, whether they enter the checksum, and their NULLs."""
    c = orders(spark, sf_dir)
    names = [n for n in c.rows.columns if n not in ("ord", "datanode")]
    found = validate.undeclared_nulls(c.rows, names, c.cfg.nullable_columns)
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("column_name"))
    return found.select(
        place.cast("int").alias("position"),
        "column_name",
        F.col("column_name").isin(*c.columns).alias("in_checksum"),
        "nulls",
    )


@query
def nullable_columns(spark, sf_dir):
    c = orders(spark, sf_dir)
    nullable = validate.nullable_columns(c.rows.schema, c.columns, c.cfg.nullable_columns)
    return validate.undeclared_nulls(c.rows, c.columns, nullable)


@query
def backup_schema_drift(spark, sf_dir):
    """Columns of the backup of orders as written, whether the live table or one with another
    column would get a new backup, and the values found in them."""
    c = orders(spark, sf_dir)
    shape = validate.backup_schema(c.rows.schema)
    store = _store(c)
    backup = repair.backup_rows(*c.planned(), "id", c.unique_cols).select(*shape.names)
    store.append(store.backup_name(shape), backup)
    stored = store.backups(shape)
    wider = c.rows.withColumn("note", F.lit("x"))
    entries = [
        F.struct(
            F.lit(at).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.lit(validate.backup_schema_drift(c.rows.schema, stored.schema)).alias("drift"),
            F.lit(validate.backup_schema_drift(wider.schema, stored.schema)).alias("wider_drift"),
            F.col(f.name).alias("cnt"),
        )
        for at, f in enumerate(stored.schema.fields, start=1)
    ]
    filled = stored.agg(*[F.count(n).alias(n) for n in stored.columns])
    return filled.select(F.inline(F.array(*entries)))


# Keys and chunks


@query
def key_universe(spark, sf_dir):
    return keys.key_universe(orders(spark, sf_dir).rows, "id")


@query
def key_min_max(spark, sf_dir):
    rows = Check(spark, drift.customer_config(sf_dir)).rows
    return keys.key_min_max(keys.key_universe(rows, "name"), "name")


@query
def key_count(spark, sf_dir):
    return keys.key_count(keys.key_universe(orders(spark, sf_dir).rows, "id"))


@query
def next_key(spark, sf_dir):
    return keys.next_key(orders(spark, sf_dir).key_chunks(), "id")


@query
def chunk_assign(spark, sf_dir):
    return orders(spark, sf_dir).key_chunks()


@query
def chunk_assign_text_key(spark, sf_dir):
    return Check(spark, drift.customer_config(sf_dir)).key_chunks()


@query
def chunk_boundaries(spark, sf_dir):
    return keys.chunk_boundaries(orders(spark, sf_dir).key_chunks(), "id")


# An interrupted check had stored this many chunks.
STORED_CHUNKS = 7


@query
def chunk_resume(spark, sf_dir):
    """Boundaries of the chunks a resumed check computes."""
    c = orders(spark, sf_dir)
    chunked = c.chunked()
    stored = c.chunks(chunked).filter(F.col("chunk") <= STORED_CHUNKS)
    again = keys.chunk_resume(chunked, "id", c.ws.stage(stored, "stored"), c.cfg.chunk_size)
    return keys.chunk_boundaries(again, "id")


@query
def resumed_differ(spark, sf_dir):
    """Differing keys that a check records which broke off after its first range and was resumed."""
    ws = Workspace(spark)
    cfg = drift.orders_config(sf_dir, run_mode=1, root=f"{ws.path}/audit")
    broken = job.TableRun(spark, replace(cfg, range_keys=STORED_CHUNKS * cfg.chunk_size))
    broken.preflight()
    broken.store.log.take()
    broken.scan()
    broken.order_keys()
    broken.open_keys()
    broken.commit_range(*broken.ranges()[0])
    job.run(spark, replace(cfg, run_mode=3, take_over=True))
    return AuditStore(spark, cfg.root, cfg.table).read("differ").select("pk", "differ_type", "status")


@query
def ranged_chunks(spark, sf_dir):
    """Results of chunks, committed in ranges of three chunks each."""
    ws = Workspace(spark)
    cfg = drift.orders_config(sf_dir, run_mode=1, root=f"{ws.path}/audit")
    part = job.TableRun(spark, replace(cfg, range_keys=3 * cfg.chunk_size))
    part.preflight()
    part.store.log.take()
    part.scan()
    part.order_keys()
    part.open_keys()
    size = 1 + len(part.ranges()) // 4  # a few commits whatever the number of keys
    part.cfg = replace(part.cfg, range_keys=3 * size * cfg.chunk_size)
    for first, last in part.ranges():
        part.commit_range(first, last)
    return part.chunks()


# Checksums


@query
def row_text(spark, sf_dir):
    c = orders(spark, sf_dir)
    written = text.row_text(c.rows.schema, c.columns, c.cfg.nullable_columns)
    return c.rows.select("ord", "id", written.alias("row_text"))


@query
def row_text_decimals(spark, sf_dir):
    """Doubles of part as decimals."""
    c = parts(spark, sf_dir)
    written = text.row_text(c.rows.schema, c.columns, (), c.cfg.decimals)
    return c.rows.select("ord", "k", written.alias("row_text"))


@query
def row_crc(spark, sf_dir):
    return orders(spark, sf_dir).crcs()


@query
def document_crc(spark, sf_dir):
    """Checksum of whole documents, of any length and language."""
    docs = drift.table(spark, sf_dir, "documents").withColumn("ord", F.lit(1))
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    return checksum.row_checksums(docs, "doc_id", names, ["lang"])


def _chunk_folds(c: Check) -> DataFrame:
    return c.chunks(c.chunked())


@query
def chunk_count(spark, sf_dir):
    return _chunk_folds(orders(spark, sf_dir)).select("chunk", "ord", "cnt")


@query
def chunk_bitxor(spark, sf_dir):
    folds = _chunk_folds(orders(spark, sf_dir))
    return folds.select("chunk", "ord", F.conv("crc", 16, 10).cast("bigint").alias("fold"))


@query
def chunk_crc_hex(spark, sf_dir):
    return _chunk_folds(orders(spark, sf_dir)).select("chunk", "ord", "crc")


@query
def chunk_checksum(spark, sf_dir):
    return _chunk_folds(orders(spark, sf_dir))


@query
def chunk_checksum_text_key(spark, sf_dir):
    return _chunk_folds(Check(spark, drift.customer_config(sf_dir)))


@query
def chunk_upsert(spark, sf_dir):
    """Results of three equal copies are stored; those of every second chunk are put anew."""
    c = orders(spark, sf_dir)
    earlier = Check(spark, drift.orders_config(sf_dir, copies=(1, 1, 1)))
    new = c.chunks(c.chunked()).filter(F.col("chunk") % 2 == 0)
    return checksum.chunk_upsert(
        earlier.chunks(earlier.chunked()), c.ws.stage(new, "new")
    ).select("table_name", "datanode", "chunk", "crc", "cnt")


@query
def table_checksum(spark, sf_dir):
    return checksum.table_checksum(orders(spark, sf_dir).crcs())


# Comparison


@query
def chunk_compare(spark, sf_dir):
    return compare.chunk_compare(_chunk_folds(orders(spark, sf_dir)), 3)


@query
def chunk_differ(spark, sf_dir):
    return compare.chunk_differ(_chunk_folds(orders(spark, sf_dir)), 3)


@query
def drill_keys(spark, sf_dir):
    return orders(spark, sf_dir).drilled().select("chunk", "id")


@query
def key_checksum(spark, sf_dir):
    c = orders(spark, sf_dir)
    return compare.key_checksum(c.drilled(), "id", c.nodes)


@query
def key_differ(spark, sf_dir):
    c = orders(spark, sf_dir)
    return compare.key_differ(c.drilled(), "id", c.nodes)


@query
def key_differ_text_key(spark, sf_dir):
    c = Check(spark, drift.customer_config(sf_dir))
    return compare.key_differ(c.drilled(), "name", c.nodes)


@query
def differ_append(spark, sf_dir):
    return orders(spark, sf_dir).differ()


def _summary(c: Check) -> DataFrame:
    chunked = c.chunked()
    compared = c.ws.stage(compare.chunk_compare(c.chunks(chunked), len(c.nodes)), "compared")
    drilled = compare.drill_keys(chunked, compared.filter("differs"))
    return compare.check_summary(compared, compare.key_differ(drilled, c.pk, c.nodes))


@query
def no_difference(spark, sf_dir):
    """Three equal copies: nothing differs."""
    return _summary(Check(spark, drift.orders_config(sf_dir, copies=(1, 1, 1))))


@query
def check_summary(spark, sf_dir):
    return _summary(orders(spark, sf_dir))


# Repair


@query
def pending_keys(spark, sf_dir):
    """Entries of two tables, a third of which are dealt with."""
    differ = orders(spark, sf_dir).differ()
    done = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("status"))
    other = differ.withColumn("table_name", F.lit("customer"))
    both = differ.withColumn("status", done).unionByName(other)
    return repair.pending_keys(both, "orders", "id")


@query
def repair_limit(spark, sf_dir):
    pending = orders(spark, sf_dir).pending()
    limits = [repair.repair_limit(pending, n) for n in (0, 100, 1_000_000)]
    return limits[0].unionByName(limits[1]).unionByName(limits[2])


@query
def unique_conflict(spark, sf_dir):
    c = orders(spark, sf_dir)
    return repair.unique_conflict(c.held(c.found(c.pending())), "id")


@query
def time_value(spark, sf_dir):
    rows = _event_times(spark, sf_dir)
    schema = rows.schema
    return rows.select(
        "event_id",
        times.time_value("as_text", schema["as_text"].dataType, "str").alias("of_text"),
        times.time_value("as_int", schema["as_int"].dataType, "int").alias("of_int"),
    )


@query
def latest_row(spark, sf_dir):
    c = orders(spark, sf_dir)
    found = c.found(c.pending())
    return repair.latest_row(found, "id", c.cfg.time_column, c.cfg.time_format)


@query
def same_time_rule(spark, sf_dir):
    c = orders(spark, sf_dir)
    return repair.same_time_rule(c.held(c.found(c.pending())), "id")


def _with_absent(c: Check) -> DataFrame:
    """Pending keys, and ones put in by hand that no replica holds any more."""
    found = c.pending()
    by_hand = found.select(
        (F.col("differ_id") + ABSENT_KEYS).alias("differ_id"),
        (F.col("id") + ABSENT_KEYS).alias("id"),
        F.lit(0).cast("int").alias("differ_type"),
    )
    return c.ws.stage(found.unionByName(by_hand), "by_hand")


@query
def deleted_rule(spark, sf_dir):
    c = orders(spark, sf_dir)
    pending = _with_absent(c)
    return repair.deleted_rule(c.held(c.found(pending)), pending, "id")


def _outcome_columns(plan: DataFrame, pk: str) -> DataFrame:
    return plan.select("differ_id", pk, "status", "differ_type", F.col("winner").cast("int"))


@query
def repair_plan(spark, sf_dir):
    """Outcome of every pending key, also of keys that are gone everywhere."""
    c = orders(spark, sf_dir)
    pending = _with_absent(c)
    return _outcome_columns(c.plan(pending, c.found(pending)), "id")


@query
def backup_rows(spark, sf_dir):
    c = orders(spark, sf_dir)
    return repair.backup_rows(*c.planned(), "id", c.unique_cols)


@query
def replace_into(spark, sf_dir):
    """All replicas after the repair."""
    return orders(spark, sf_dir).repaired()


@query
def replace_files(spark, sf_dir):
    """All replicas after a repair that wrote anew only files with changed keys."""
    c = orders(spark, sf_dir)
    cfg = replace(_in_files(c), write_replicas=True)
    result = job.run(spark, cfg)
    return read_replicas(spark, job.repaired_specs(spark, cfg, result.run_id))


@query
def chain_plan(spark, sf_dir):
    """Outcomes along chains of keys that each take their code from the next one."""
    c = Check(spark, drift.chain_config(sf_dir))
    return _outcome_columns(c.planned()[1], "k")


@query
def contested_plan(spark, sf_dir):
    """Outcomes where rows put by one repair remove rows of other pending keys."""
    return _outcome_columns(parts(spark, sf_dir).planned()[1], "k")


@query
def replace_evicts(spark, sf_dir):
    c = parts(spark, sf_dir)
    _, plan = c.planned()
    return repair.replace_evicts(c.holders(plan), plan, "k", c.unique_cols)


@query
def contested_repair(spark, sf_dir):
    """Replicas after a repair that also removed rows."""
    rows = parts(spark, sf_dir).repaired()
    return rows.withColumn("price", F.col("price").cast("decimal(18,2)"))


@query
def differ_status_update(spark, sf_dir):
    c = orders(spark, sf_dir)
    differ = c.ws.stage(c.differ(), "differ_table")
    pending = c.ws.stage(repair.pending_keys(differ, "orders", "id"), "pending")
    plan = c.plan(pending, c.found(pending))
    return repair.differ_status_update(differ, repair.differ_outcome(plan))


@query
def duplicate_pending(spark, sf_dir):
    """Every key is pending twice, as after two checks without a repair."""
    c = orders(spark, sf_dir)
    once = c.pending()
    count = once.count()
    twice = once.unionByName(once.withColumn("differ_id", F.col("differ_id") + count))
    pending = c.ws.stage(twice, "twice")
    plan = c.plan(pending, c.found(pending))
    return _outcome_columns(repair.duplicate_pending(plan, "id"), "id")


@query
def post_repair_check(spark, sf_dir):
    """Keys that still differ once the repaired replicas are checked again."""
    c = orders(spark, sf_dir)
    changes = c.changes(*c.planned())
    specs = tuple(
        replace(
            s,
            reader=lambda sp, s=s: repair.replace_into(
                read_replica(sp, s), changes.filter(F.col("ord") == s.ord), "id"
            ),
        )
        for s in c.cfg.replicas
    )
    again = Check(spark, replace(c.cfg, replicas=specs))
    return compare.key_differ(again.drilled(), "id", again.nodes).select("id", "differ_type")


# Jobs


def _result_rows(spark, results) -> DataFrame:
    names = ("chunks", "differing_chunks", "differing_keys", "pending", "status_1")
    return literal_rows(
        spark,
        [
            (r.table, mode, r.status, *[r.counts.get(n) for n in names])
            for mode, r in results
        ],
        "table_name string, run_mode int, status int, "
        + ", ".join(f"{n} bigint" for n in names),
    )


def _all_modes(spark, sf_dir, root) -> list:
    """Resume without keys, check, repair what it found, then check and repair."""
    return [
        (mode, job.run(spark, drift.orders_config(sf_dir, run_mode=mode, root=root)))
        for mode in (3, 1, 2, 0)
    ]


@query
def run_mode(spark, sf_dir):
    root = f"{Workspace(spark).path}/audit"
    return _result_rows(spark, _all_modes(spark, sf_dir, root))


@query
def multi_table(spark, sf_dir):
    """Three tables in turn; the one without a single key is refused and skipped."""
    root = f"{Workspace(spark).path}/audit"
    lines = ReplicaSpec(1, "dn1", f"{sf_dir}/lineitem.parquet")
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    cfgs = [
        drift.orders_config(sf_dir, run_mode=1, root=root),
        CheckConfig(
            table="lineitem",
            pk="l_orderkey",
            replicas=(lines,),
            root=root,
            run_mode=1,
            decimals={n: (18, 2) for n in names},
        ),
        drift.customer_config(sf_dir, root=root),
    ]
    return _result_rows(spark, [(1, r) for r in job.run_tables(spark, cfgs)])


@query
def run_log(spark, sf_dir):
    """Logged runs: one that broke off, and the modes of ``run_mode`` after it."""
    root = f"{Workspace(spark).path}/audit"
    log = RunLog(spark, root)
    log.record("broken", "orders", 0, 1)
    _all_modes(spark, sf_dir, root)
    ended = F.col("ended").isNotNull().alias("ended")
    return log.runs().select("table_name", "run_mode", "status", ended)
