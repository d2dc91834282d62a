"""The job: check, resume and repair of one table or several."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import astuple, dataclass, field, replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replicheck.operators import checksum, compare, keys, repair, validate
from replicheck.plans.runlog import RunLog
from replicheck.sources.readers import (
    FILE,
    collate,
    files_of,
    in_files,
    located_rows,
    read_files,
    read_replica,
    snapshots,
    tag,
    union_replicas,
    with_file,
)
from replicheck.sources.store import AuditStore, Workspace, literal_rows
from replicheck.spec import (
    ABORTED,
    CHECK_AND_REPAIR,
    CHECK_ONLY,
    EMPTY_TABLE,
    ENDED,
    FAILED_RUN,
    NO_KEYS,
    OVER_LIMIT,
    REPAIR_ONLY,
    RESUME_CHECK,
    CheckConfig,
    Refused,
    ReplicaSpec,
)


@dataclass
class RunResult:
    run_id: str
    table: str
    status: int | None  # None where the table was refused
    counts: dict[str, int] = field(default_factory=dict)
    reason: str = ""


def _root(cfg: CheckConfig) -> str:
    if not cfg.root:
        raise Refused("root is needed: a lasting folder for audit tables, backups and changes")
    return cfg.root


#: Ranges that a check's chunks are committed in, at most, and keys of a range, at least, where
#: the configuration does not say.
RANGES, RANGE_KEYS = 64, 5_000_000

#: Where the rows of a differing key were seen.
SEEN = "array<struct<ord: int, snapshot: string, file: bigint>>"


class TableRun:
    """One run of one table. Data stays in DataFrames; the driver sees counts and branches."""

    def __init__(self, spark: SparkSession, cfg: CheckConfig):
        self.spark = spark
        self.cfg = cfg
        self.run_id = uuid.uuid4().hex
        root = self.root = _root(cfg)
        self.store = AuditStore(spark, root, cfg.table, self.run_id)
        self.log = RunLog(spark, root)
        self.ws = Workspace(spark)
        self.counts: dict[str, int] = {}

    def tidy(self) -> None:
        """Delete what broken runs left. Only the table's owner may."""
        self.store.sweep()
        listed = self.store.read("manifest")
        kept = {r["run_id"] for r in listed.select("run_id").distinct().collect()} if listed else set()
        base = f"{self.root}/repaired/table_name={self.cfg.table}"
        for name in self.store.log.files.names(base):
            if name.removeprefix("run=") not in kept:
                self.store.log.files.delete(f"{base}/{name}")

    def leave(self) -> None:
        self.store.log.leave()
        self.ws.clear()

    # pre-flight

    def preflight(self) -> None:
        """Refuse what cannot be compared or repaired before anything is written."""
        cfg, spark = self.cfg, self.spark
        specs = sorted(cfg.replicas, key=lambda s: s.ord)
        found = [(s, validate.read_if_there(spark, s)) for s in specs]
        absent = [s.datanode for s, df in found if df is None]
        if absent:
            raise Refused(f"no table {cfg.table} on {', '.join(absent)}")
        self.copies = {s.ord: df for s, df in found}
        copies = [(s.ord, s.datanode, df) for s, df in found]
        unlike = validate.unlike_columns(copies)
        if unlike:
            raise Refused(f"other columns than the first replica: {unlike}")
        declared = [(s.datanode, validate.catalogue_columns(spark, s)) for s in specs]
        unlike = validate.unlike_declarations(declared)
        if unlike:
            raise Refused(f"declared otherwise than on the first replica: {unlike}")
        first = copies[0][2]
        if cfg.pk not in first.columns:
            raise Refused(f"no column {cfg.pk}")
        taken = validate.reserved_names(first.columns, cfg.pk)
        if taken:
            raise Refused(f"columns to be renamed on reading: {taken}")
        unknown = validate.unknown_columns(first.columns, cfg.named_columns)
        if unknown:
            raise Refused(f"columns that the table lacks: {', '.join(unknown)}")
        stored = self.store.read("differ")
        self.found = found
        self.rows = collate(union_replicas(found), cfg.pk, cfg.collation)
        self.snapshots = snapshots(spark, specs)
        if stored is not None and stored.schema["pk"] != T.StructField(
            "pk", self.rows.schema[cfg.pk].dataType
        ):
            raise Refused("the key has another type than in the stored differences")
        self.unique_cols = validate.refuse_unique_keys(cfg.unique_keys, cfg.repairs)
        if cfg.repairs:
            self._probe_time(first)
        self.columns = validate.checksum_columns(first.schema, cfg.excluded)
        catalogue = next((columns for _, columns in declared if columns is not None), None)
        self.nullable = validate.nullable_columns(
            first.schema, self.columns, cfg.nullable_columns, catalogue
        )
        # typed hashes mark NULLs by themselves, the key is checked on its own
        self.watched = [
            c for c in self.columns if c not in {*self.nullable, cfg.pk} and cfg.algo == "crc32"
        ]

    def _probe_time(self, first: DataFrame) -> None:
        cfg = self.cfg
        if not cfg.time_column or cfg.time_column not in first.columns:
            raise Refused(f"no time column {cfg.time_column}")
        one = self.rows.select("ord", cfg.time_column).limit(1)
        probe = validate.time_format_probe(one, cfg.time_column, cfg.time_format).first()
        if probe is None:
            raise Refused(f"no rows in {cfg.table}")
        if probe["bad"]:
            raise Refused(f"{cfg.time_column} does not read as {cfg.time_format}")

    # check

    def row_crcs(self) -> DataFrame:
        cfg = self.cfg
        rows = union_replicas([(s, with_file(df, s)) for s, df in self.found])
        return checksum.row_checksums(
            collate(rows, cfg.pk, cfg.collation),
            cfg.pk,
            self.columns,
            self.nullable,
            cfg.decimals,
            cfg.fraction_digits,
            cfg.algo,
            self.watched,
            FILE,
        )

    def fingerprint(self) -> dict[str, str]:
        """What stored keys and checksums depend on, part by part."""
        cfg = self.cfg
        specs = sorted(cfg.replicas, key=lambda s: s.ord)
        sources = [
            (s.ord, s.datanode, s.source, s.format, sorted(s.options.items()), s.reader is not None)
            for s in specs
        ]
        parts = {
            "replicas": sources,
            **{f"files of {s.datanode}": self.snapshots.get(s.ord) for s in specs},
            "key": (cfg.pk, cfg.collation),
            "columns": self.columns,
            "nullable columns": self.nullable,
            "decimals": sorted(cfg.decimals.items()),
            "fraction digits": sorted(cfg.fraction_digits.items()),
            "checksum": cfg.algo,
            "schema": self.rows.schema.simpleString(),
        }
        return {name: repr(value) for name, value in parts.items()}

    def _refuse_other_configuration(self, known: dict[str, str]) -> None:
        """Stored checksums only serve the configuration that they were computed under."""
        own = self.fingerprint()
        other = [k for k in {**own, **known} if known.get(k) != own.get(k)]
        if other:
            raise Refused(f"the stored check was made with other {', '.join(other)}")

    def _commit(self, step: str, parts=None, clear=(), **facts) -> None:
        """Commit a step of the check at hand, with what is known of it."""
        self.work = {**self.work, **facts}
        done = {"check": self.work if self.work.get("fingerprint") else None}
        self.store.commit(f"{self.work['id']}-{step}", parts, clear, done)

    def scan(self) -> None:
        """Read the replicas, once: every key's checksums. What this run keeps from here on is
        under ``root``, so that a run that breaks off is resumed without reading them again."""
        cfg = self.cfg
        self.work = {"id": self.run_id}
        self._commit("begin", clear=self.store.WORKING)
        matrix = checksum.key_matrix(self.row_crcs(), cfg.pk, cfg.nodes)
        self._commit("matrix", {"matrix": matrix}, fingerprint=self.fingerprint())

    def order_keys(self) -> bool:
        """Sort the stored keys into their chunks. False where no replica has a row."""
        cfg = self.cfg
        matrix = self.store.read("matrix").drop("table_name")
        if matrix.isEmpty():
            return False
        ords = [o for o, _ in cfg.nodes]
        faults = []
        if not validate.key_faults(matrix, cfg.pk, ords).isEmpty():
            faults.append(f"{cfg.pk} has NULLs or repeats within a replica")
        if unmarked := checksum.null_columns(matrix, self.watched):
            faults.append(f"NULLs in columns not declared nullable: {', '.join(unmarked)}")
        if faults:
            self._commit("end", clear=self.store.WORKING, fingerprint=None)
            raise Refused("; ".join(faults))
        kept = matrix.drop(*[n for n in matrix.columns if n.startswith("nulls_")])
        placed = keys.in_order(kept, [cfg.pk], cfg.parallel)
        first = keys.Segment(1, 1, cfg.chunk_size)
        self._commit("keys", {"keys": placed}, clear=["matrix"], segments=[astuple(first)], stored=0)
        return True

    def open_keys(self) -> None:
        """Find one's way in the stored keys."""
        self.placed = self.store.read("keys").drop("table_name")
        self.starts = self.ws.stage(keys.starts(self.placed), "starts")
        listed = self.starts.collect()  # one row for each partition of the keys
        self.bounds = [(r["part"], r["start"]) for r in listed]
        self.total = sum(r["rows"] for r in listed)
        self.segments = [keys.Segment(*s) for s in self.work["segments"]]

    def keys_between(self, segment: keys.Segment, first: int, last: int) -> DataFrame:
        """Keys of these numbers with their chunks, from the files that hold them alone."""
        near = keys.in_span(self.placed, self.starts, self.bounds, first, last)
        return near.withColumn("chunk", segment.chunk_of(F.col("rn")))

    def ranges(self) -> list[tuple[int, int]]:
        """The last segment's keys from the first chunk that is not stored on, in ranges of
        whole chunks: numbers of their first and last keys."""
        segment = self.segments[-1]
        size = self.cfg.range_keys or max(RANGE_KEYS, -(-self.total // RANGES))
        step = max(1, size // segment.size) * segment.size
        stored = self.work["stored"]
        first = segment.first_key(max(stored + 1, segment.chunk))
        return [(k, min(k + step - 1, self.total)) for k in range(first, self.total + 1, step)]

    def commit_range(self, first: int, last: int) -> None:
        """Compute the chunks of a range and commit them by themselves."""
        cfg, segment = self.cfg, self.segments[-1]
        rows = checksum.chunk_checksum(
            self.keys_between(segment, first, last), cfg.pk, cfg.nodes, cfg.table
        )
        self._commit(
            f"chunks-{segment.number}-{first}",
            {"chunk": rows.withColumn("segment", F.lit(segment.number))},
            stored=segment.holding(last),
        )

    def chunks(self) -> DataFrame:
        """Stored results of chunks, the last ones of a chunk that was computed again."""
        ends = [*[s.chunk for s in self.segments[1:]], None]
        valid = F.lit(False)
        for segment, end in zip(self.segments, ends):
            own = F.col("segment") == segment.number
            valid = valid | (own if end is None else own & (F.col("chunk") < end))
        return self.store.read("chunk").filter(valid).drop("segment")

    def check(self) -> int:
        """Record differing keys. Returns the run status, or 0 to go on to a repair."""
        cfg = self.cfg
        if cfg.run_mode == RESUME_CHECK:
            self.work = self.store.facts("check")
            if not self.work:
                return NO_KEYS
            self._refuse_other_configuration(self.work["fingerprint"])
        else:
            self.scan()
        if "segments" not in self.work and not self.order_keys():
            self._commit("end", clear=self.store.WORKING, fingerprint=None)
            return EMPTY_TABLE
        if cfg.run_mode == RESUME_CHECK:
            self._cut_anew()
        self.open_keys()
        for first, last in self.ranges():
            self.commit_range(first, last)
        return self._conclude()

    def _cut_anew(self) -> None:
        """Count on from the last chunk that was stored, by the chunk size of this run."""
        known = [keys.Segment(*s) for s in self.work["segments"]]
        number = self.work.get("cuts", 1) + 1
        cut = keys.segment_after(known, self.work["stored"], self.cfg.chunk_size, number)
        self._commit(
            f"cut-{number}",
            segments=[astuple(s) for s in cut],
            stored=cut[-1].chunk - 1,
            cuts=number,
        )

    def _conclude(self) -> int:
        """From stored chunks to differing keys, recorded in one commit that ends the check."""
        cfg = self.cfg
        chunks = self.chunks()
        compared = compare.chunk_compare(chunks, len(cfg.nodes))
        differing = compare.chunk_differ(chunks, len(cfg.nodes))
        self._commit(f"compared-{self.run_id}", {"chunk_differ": differing}, clear=["chunk_differ"])
        differing = self.store.read("chunk_differ")
        if differing.isEmpty():
            last = chunks.agg(F.max("chunk")).first()[0]
            self.counts.update(chunks=last, differing_chunks=0, differing_keys=0)
            self._commit("end", clear=self.store.WORKING, fingerprint=None)
            return ENDED
        chunked = reduce(
            DataFrame.unionByName,
            [self.keys_between(*s) for s in keys.segment_spans(self.segments, self.total)],
        )
        seen = F.array(
            *[
                F.struct(
                    F.lit(o).cast("int").alias("ord"),
                    F.lit(self.snapshots.get(o)).cast("string").alias("snapshot"),
                    F.col(f"_file_{o}").alias("file"),
                )
                for o, _ in cfg.nodes
            ]
        )
        drilled = compare.drill_keys(chunked, differing)
        found = self.ws.stage(
            compare.key_differ(drilled, cfg.pk, cfg.nodes, [seen.alias("files")]), "found"
        )
        self.counts.update(compare.check_summary(compared, found).first().asDict())
        self._commit(
            "end", {"differ": self._numbered(found)}, clear=self.store.WORKING, fingerprint=None
        )
        return 0

    def _numbered(self, found: DataFrame) -> DataFrame:
        known = self.store.read("differ")
        last = known.agg(F.max("id")).first()[0] if known is not None else None
        cfg = self.cfg
        return compare.numbered_differ(
            found, cfg.pk, cfg.table, self.ws, last or 0, cfg.parallel, keep=["files"]
        )

    def add_pending(self, by_hand: DataFrame) -> None:
        """Keys put in by hand, in the key's column, for a repair without a check."""
        keyed = collate(by_hand.select(self.cfg.pk), self.cfg.pk, self.cfg.collation)
        if not keyed.filter(F.col(self.cfg.pk).isNull()).isEmpty():
            raise Refused(f"NULL as a pending {self.cfg.pk}")
        by_hand = keyed.select(
            F.lit(0).alias("chunk"),
            self.cfg.pk,
            F.lit(0).alias("differ_type"),
            F.lit(None).cast(SEEN).alias("files"),
        )
        self.store.append("differ", self._numbered(by_hand), f"{self.run_id}-by-hand")

    # repair

    def differ(self) -> DataFrame | None:
        """Differing keys with their present status."""
        known = self.store.read("differ")
        if known is None:
            return None
        outcome = self.store.read("outcome")
        return known if outcome is None else repair.differ_status_update(known, outcome)

    def repair(self) -> int:
        cfg = self.cfg
        differ = self.differ()
        if differ is None:
            return ENDED
        pending = self.ws.stage(repair.pending_keys(differ, cfg.table, cfg.pk), "pending")
        count, _, refused = repair.repair_limit(pending, cfg.auto_repair_size).first()
        self.counts["pending"] = count
        if refused:
            return OVER_LIMIT
        if not count:
            return ENDED
        if cfg.verify_unique and self.unique_cols:
            self._verify_unique()
        found = self.ws.stage(self._lookup(pending), "pending_rows")
        if not validate.pending_key_faults(found, cfg.pk).isEmpty():
            raise Refused(f"{cfg.pk} has NULLs or repeats within a replica, among pending keys")
        held = repair.held_rows(
            found, cfg.pk, cfg.time_column, cfg.time_format, self.unique_cols
        )
        self._refuse_bad_times(held)
        holders = self._holders(held)
        plan = self.ws.stage(
            repair.repair_plan(pending, held, cfg.pk, cfg.nodes, self.unique_cols, self.ws), "plan"
        )
        self._write_repair(found, plan, holders)
        by_status = plan.groupBy("status").count().collect()
        self.counts.update({f"status_{r['status']}": r["count"] for r in by_status})
        return ENDED

    def _lookup(self, pending: DataFrame) -> DataFrame:
        """Whole rows of the pending keys and their files."""
        return located_rows(
            self.spark, self.found, pending, self.cfg.pk, self.snapshots, self.cfg.collation
        )

    def _verify_unique(self) -> None:
        rule = validate.unique_key_rule(self.rows, self.unique_cols).filter("NOT is_unique")
        names = dict(self.cfg.nodes)
        bad = sorted(names[r["ord"]] for r in rule.collect())
        if bad:
            raise Refused(f"{', '.join(self.unique_cols)} is not unique on {', '.join(bad)}")

    def _refuse_bad_times(self, held: DataFrame) -> None:
        """All pending keys whose time does not read go to an audit table of their own."""
        bad = self.ws.stage(repair.bad_times(held, self.cfg.pk), "bad_times")
        count = bad.count()
        if count:
            path = f"{self.root}/bad_time/table_name={self.cfg.table}/run={self.run_id}"
            bad.write.mode("overwrite").parquet(path)
            raise Refused(f"time of {count} pending keys does not read; they are listed in {path}")

    def _holders(self, held: DataFrame) -> DataFrame | None:
        if not self.unique_cols:
            return None
        rows = union_replicas([(s, with_file(df, s)) for s, df in self.found])
        rows = collate(rows, self.cfg.pk, self.cfg.collation)
        holders = self.ws.stage(
            repair.tuple_holders(rows, held, self.cfg.pk, self.unique_cols, [FILE]), "holders"
        )
        if not repair.unique_faults(holders).isEmpty():
            raise Refused(f"{', '.join(self.unique_cols)} repeats within a replica")
        return holders

    def _write_repair(
        self, found: DataFrame, plan: DataFrame, holders: DataFrame | None
    ) -> None:
        """Changes and new copies lie in a folder of this run. They count, like the backup and
        the outcomes, once one commit names them all: a run that breaks off before has done
        nothing."""
        cfg = self.cfg
        rows = found.drop(FILE)
        backup = repair.backup_rows(rows, plan, cfg.pk, self.unique_cols)
        shape = validate.backup_schema(self.rows.schema)
        base = f"{self.root}/repaired/table_name={cfg.table}/run={self.run_id}"
        made = repair.repair_changes(rows, plan, cfg.pk, cfg.nodes, self.unique_cols, holders)
        made.write.mode("overwrite").parquet(f"{base}/changes")
        changes = self.spark.read.schema(made.schema).parquet(f"{base}/changes")
        paths = self._write_copies(base, found, holders, changes) if cfg.write_replicas else {}
        manifest = literal_rows(
            self.spark,
            [(self.run_id, ord, dn, paths.get(ord), f"{base}/changes") for ord, dn in cfg.nodes],
            "run_id string, ord int, datanode string, path string, changes string",
        )
        now = snapshots(self.spark, cfg.replicas)
        other = [dn for ord, dn in cfg.nodes if now.get(ord) != self.snapshots.get(ord)]
        if other:
            raise Refused(f"written anew during the run: {', '.join(other)}")
        self.store.commit(
            f"{self.run_id}-repair",
            {
                self.store.backup_name(shape): backup.select(*shape.names),
                "outcome": repair.differ_outcome(plan),
                "manifest": manifest,
            },
        )

    def _write_copies(
        self, base: str, found: DataFrame, holders: DataFrame | None, changes: DataFrame
    ) -> dict[int, str]:
        """New copies, each at its path. Of a copy that lies in files, only those are written
        anew that hold a changed key; its path lists the others."""
        cfg, by_file = self.cfg, [(s, df) for s, df in self.found if in_files(s)]
        paths = {}
        for spec, _ in self.found:
            if not in_files(spec):
                paths[spec.ord] = f"{base}/ord={spec.ord}"
                self.repaired(spec.ord, changes).write.mode("overwrite").parquet(paths[spec.ord])
        if not by_file:
            return paths
        places = found.select("ord", F.col(cfg.pk), FILE)
        if holders is not None:
            places = places.unionByName(holders.select("ord", F.col(cfg.pk), FILE))
        listed = repair.changed_files(places, changes, cfg.pk, FILE).collect()
        touched = {ord: set() for ord, _ in cfg.nodes}
        for r in listed:  # names of files, as few as the copies have
            touched[r["ord"]].add(r["file"])
        new, kept = [], []
        for spec, df in by_file:
            part = read_files(self.spark, spec, df.schema, sorted(touched[spec.ord]))
            own = changes.filter(F.col("ord") == spec.ord)
            new.append(tag(repair.replace_into(part, own, cfg.pk), spec).drop("datanode"))
            kept += [(spec.ord, f) for f in files_of(df) if f not in touched[spec.ord]]
            paths[spec.ord] = f"{base}/files"
        written = reduce(DataFrame.unionByName, new)
        written.write.mode("overwrite").partitionBy("ord").parquet(f"{base}/files/new")
        listing = self.spark.createDataFrame(kept, "ord int, file string")
        listing.write.mode("overwrite").parquet(f"{base}/files/kept")
        self.counts["files_rewritten"] = sum(map(len, touched.values()))
        return paths

    def repaired(self, ord: int, changes: DataFrame) -> DataFrame:
        """A replica after the run's changes."""
        own = changes.filter(F.col("ord") == ord)
        return repair.replace_into(self.copies[ord], own, self.cfg.pk)


def run(spark: SparkSession, cfg: CheckConfig) -> RunResult:
    """One table in its run mode. ``Refused`` is raised before anything is recorded, or, where
    the data itself forbids it, after the run is marked as failed. While another run works on
    the table, ``InUse`` is."""
    job = TableRun(spark, cfg)
    job.preflight()
    job.store.log.take(cfg.take_over)
    try:
        job.tidy()
        job.log.start(job.run_id, cfg.table, cfg.run_mode)
        return _logged(job)
    finally:
        job.leave()


def _logged(job: TableRun) -> RunResult:
    cfg = job.cfg
    try:
        status = 0
        if cfg.run_mode in (CHECK_AND_REPAIR, CHECK_ONLY, RESUME_CHECK):
            status = job.check()
        if not status and cfg.run_mode in (CHECK_AND_REPAIR, REPAIR_ONLY):
            status = job.repair()
        status = status or ENDED
    except KeyboardInterrupt:
        job.log.record(job.run_id, cfg.table, ABORTED, cfg.run_mode)
        raise
    except Exception:
        job.log.record(job.run_id, cfg.table, FAILED_RUN, cfg.run_mode)
        raise
    job.log.record(job.run_id, cfg.table, status, cfg.run_mode)
    return RunResult(job.run_id, cfg.table, status, job.counts)


def add_pending(spark: SparkSession, cfg: CheckConfig, by_hand: DataFrame) -> None:
    """Put keys in for a repair without a check. NULL keys are refused."""
    job = TableRun(spark, cfg)
    job.preflight()
    job.store.log.take(cfg.take_over)
    try:
        job.add_pending(by_hand)
    finally:
        job.leave()


def run_tables(spark: SparkSession, cfgs: Iterable[CheckConfig]) -> list[RunResult]:
    """Several tables, one after the other. A refused table is skipped; an error stops."""
    results = []
    for cfg in cfgs:
        try:
            results.append(run(spark, cfg))
        except Refused as e:
            results.append(RunResult("", cfg.table, None, {}, str(e)))
    return results


def repaired_specs(spark: SparkSession, cfg: CheckConfig, run_id: str) -> tuple[ReplicaSpec, ...]:
    """The replicas of ``cfg`` after its run's repair, as the manifest lists them: written anew,
    or the run's own copies with its change set applied on read."""
    manifest = AuditStore(spark, _root(cfg), cfg.table).read("manifest")
    if manifest is None:
        raise Refused(f"no repair of {cfg.table} is recorded")
    written = {r["ord"]: r for r in manifest.filter(F.col("run_id") == run_id).collect()}
    specs = []
    for spec in cfg.replicas:
        path, changes = written[spec.ord]["path"], written[spec.ord]["changes"]
        if path is None:
            specs.append(replace(spec, reader=partial(_changed, spec, cfg.pk, changes)))
        elif in_files(spec):
            specs.append(replace(spec, reader=partial(_files_and_new, spec, path)))
        else:
            specs.append(ReplicaSpec(spec.ord, spec.datanode, path))
    return tuple(specs)


def _files_and_new(spec: ReplicaSpec, path: str, spark: SparkSession) -> DataFrame:
    """A copy from the files that its repair left as they were and those it wrote anew."""
    schema = read_replica(spark, spec).schema
    listed = spark.read.parquet(f"{path}/kept").filter(F.col("ord") == spec.ord)
    kept = read_files(spark, spec, schema, [r["file"] for r in listed.collect()])
    tagged = T.StructType([*schema.fields, T.StructField("ord", T.IntegerType())])
    new = spark.read.schema(tagged).parquet(f"{path}/new").filter(F.col("ord") == spec.ord)
    return kept.unionByName(new.drop("ord"))


def _changed(spec: ReplicaSpec, pk: str, path: str, spark: SparkSession) -> DataFrame:
    own = spark.read.parquet(path).filter(F.col("ord") == spec.ord)
    return repair.replace_into(read_replica(spark, spec), own, pk)


def read_changed(spark: SparkSession, cfg: CheckConfig, changes: DataFrame) -> DataFrame:
    """All replicas with a change set applied on read, without writing them anew."""
    copies = []
    for spec in sorted(cfg.replicas, key=lambda s: s.ord):
        own = changes.filter(F.col("ord") == spec.ord)
        copies.append((spec, repair.replace_into(read_replica(spark, spec), own, cfg.pk)))
    return union_replicas(copies)
