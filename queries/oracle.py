"""SQL that gives each query's result from the given tables, for DuckDB."""

from __future__ import annotations

from queries.drift import CODES, DRIFT, HOLES, RUN
from queries.results import ABSENT_KEYS, STATUSES, STORED_CHUNKS, WIDE_KEYS


def _crc_table() -> str:
    """CRC32's byte table for the reflected polynomial."""
    entries = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ 0xEDB88320 if n & 1 else n >> 1
        entries.append(f"{n}::UBIGINT")
    return "[" + ",".join(entries) + "]"


def crc32(s: str) -> str:
    """CRC32 of the text column ``s`` over its bytes."""
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(regexp_extract_all(hex(encode({s})), '..'),
        lambda byte: ('0x' || byte)::UBIGINT)),
    lambda a, b: xor(a >> 8, ({_crc_table()})[(xor(a, b) & 255)::INT + 1])),
    4294967295::UBIGINT)::BIGINT"""


def _epoch(ts: str) -> str:
    return f"epoch(date_trunc('second', {ts}))::BIGINT"


_DRIFT = " ".join(f"WHEN o_orderkey % {n} = 0 THEN '{d}'" for d, n in DRIFT)

ROWS = f"""base AS (
  SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS st,
    o_totalprice::DECIMAL(18,2) AS price,
    CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_orderpriority END AS prio,
    'U' || o_orderkey AS uk, {_epoch('o_orderdate')} AS upd,
    CASE WHEN o_orderkey % 1000 >= 500 THEN 'same' {_DRIFT} ELSE 'same' END AS d
  FROM orders),
rows_ AS (
  SELECT 1 AS ord, 'dn1' AS datanode, id, cust,
    CASE WHEN d = 'tie_max' THEN 'X' ELSE st END AS st, price, prio, uk,
    CASE WHEN d = 'tie_max' THEN upd + 60 ELSE upd END AS upd
  FROM base WHERE d <> 'only_dn2'
  UNION ALL
  SELECT 2, 'dn2', id, cust, CASE WHEN d = 'tie_max' THEN 'Y' ELSE st END,
    CASE WHEN d IN ('dn2_newer', 'diff_then_miss')
      THEN (price + 1)::DECIMAL(18,2) ELSE price END, prio, uk,
    CASE WHEN d = 'tie_max' THEN upd + 60
      WHEN d IN ('dn2_newer', 'diff_then_miss', 'time_only') THEN upd + 3600 ELSE upd END
  FROM base WHERE d NOT IN ('miss_tie', 'miss_then_diff')
  UNION ALL
  SELECT 3, 'dn3', id, cust,
    CASE d WHEN 'same_time' THEN 'Z' WHEN 'miss_then_diff' THEN 'W' ELSE st END, price,
    CASE WHEN d <> 'null_dn3' THEN prio END,
    CASE WHEN d = 'uk_conflict' THEN uk || 'x' ELSE uk END,
    CASE WHEN d IN ('null_dn3', 'miss_then_diff') THEN upd + 3600 ELSE upd END
  FROM base WHERE d NOT IN ('only_dn2', 'diff_then_miss'))"""

NODES = "nodes AS (SELECT * FROM (VALUES (1, 'dn1'), (2, 'dn2'), (3, 'dn3')) v(ord, datanode))"


def _text(rows: str) -> str:
    return f"""SELECT ord, id, concat_ws('#', id, cust, st, price, prio, uk,
      CASE WHEN prio IS NULL THEN '1' ELSE '0' END) AS row_text FROM {rows}"""


CHECK = f"""texts AS ({_text('rows_')}),
crcs AS (SELECT ord, id, {crc32('row_text')} AS row_crc FROM texts),
universe AS (SELECT DISTINCT id FROM rows_),
keys AS (SELECT id, rn, ((rn - 1) // 100 + 1)::BIGINT AS chunk
  FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM universe)),
bounds AS (SELECT chunk, min(id) AS upper_boundary, max(id) AS lower_boundary,
  count(*) AS keys FROM keys GROUP BY chunk),
folds AS (SELECT chunk, ord, count(*) AS cnt, bit_xor(row_crc) AS fold
  FROM keys JOIN crcs USING (id) GROUP BY chunk, ord),
chunks AS (SELECT 'orders' AS table_name, chunk, upper_boundary, lower_boundary, ord, datanode,
    lower(to_hex(coalesce(fold, 0)::BIGINT)) AS crc, coalesce(cnt, 0)::BIGINT AS cnt,
    coalesce(fold, 0)::BIGINT AS fold
  FROM bounds CROSS JOIN nodes LEFT JOIN folds USING (chunk, ord)),
compared AS (SELECT table_name, chunk, any_value(upper_boundary) AS upper_boundary,
    any_value(lower_boundary) AS lower_boundary,
    count(DISTINCT (crc, cnt)) > 1 AS differs FROM chunks GROUP BY ALL),
key_crcs AS (SELECT chunk, id, ord, datanode, coalesce(lower(to_hex(row_crc)), '0') AS crc,
    (row_crc IS NOT NULL)::BIGINT AS cnt
  FROM keys JOIN compared USING (chunk) CROSS JOIN nodes LEFT JOIN crcs USING (id, ord)
  WHERE differs),
first_crcs AS (SELECT id, crc AS first_crc FROM key_crcs WHERE ord = 1),
anomalies AS (SELECT chunk, id, min(CASE WHEN cnt = 0 THEN ord END) AS missing,
    min(CASE WHEN cnt > 0 AND crc <> first_crc THEN ord END) AS unlike
  FROM key_crcs JOIN first_crcs USING (id) GROUP BY chunk, id),
found AS (SELECT chunk, id,
    CASE WHEN coalesce(missing, 99) < coalesce(unlike, 99) THEN 1 ELSE 2 END AS differ_type
  FROM anomalies WHERE missing IS NOT NULL OR unlike IS NOT NULL),
differ AS (SELECT row_number() OVER (ORDER BY chunk, id) AS id, 'orders' AS table_name,
  id AS pk, 0 AS status, differ_type FROM found)"""

REPAIR = """held AS (SELECT rows_.* FROM rows_ JOIN found USING (id)),
facts AS (SELECT id, count(*) AS np, count(DISTINCT uk) AS tuples, count(DISTINCT upd) AS times
  FROM held GROUP BY id),
newest AS (SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY upd DESC, ord) AS place FROM held)
  WHERE place = 1),
plan AS (SELECT d.id AS differ_id, d.pk AS id,
    CASE WHEN tuples > 1 THEN 4 WHEN np > 1 AND times = 1 THEN 5 ELSE 1 END AS status,
    CASE WHEN tuples > 1 THEN 3 ELSE differ_type END AS differ_type,
    CASE WHEN tuples = 1 AND (np = 1 OR times > 1) THEN n.ord END AS winner
  FROM differ d JOIN facts f ON f.id = d.pk JOIN newest n ON n.id = d.pk),
fixed AS (SELECT n.* EXCLUDE (ord, datanode), differ_id, winner
  FROM newest n JOIN plan p USING (id) WHERE status = 1),
repaired AS (
  SELECT * FROM rows_ WHERE id NOT IN (SELECT id FROM fixed)
  UNION ALL
  SELECT ord, datanode, id, cust, st, price, prio, uk, upd FROM fixed CROSS JOIN nodes)"""

_AFTER = f"""after_crcs AS (SELECT ord, id, {crc32('row_text')} AS row_crc
  FROM ({_text('repaired')})),
after_keys AS (SELECT id, any_value(chunk) AS chunk, count(*) AS n,
    count(DISTINCT row_crc) AS kinds, bool_or(ord = 1) AS on1, bool_or(ord = 2) AS on2,
    max(row_crc) FILTER (ord = 1) AS c1, max(row_crc) FILTER (ord = 2) AS c2,
    max(row_crc) FILTER (ord = 3) AS c3
  FROM after_crcs JOIN keys USING (id) GROUP BY id)"""


def orders(select: str, *more: str) -> str:
    return f"WITH {', '.join([ROWS, NODES, CHECK, REPAIR, *more])} {select}"


CUSTOMERS = f"""rows_ AS (
  SELECT 1 AS ord, c_name AS name, c_nationkey AS nation,
    c_acctbal::DECIMAL(18,2) AS bal, c_mktsegment AS seg FROM customer
  UNION ALL
  SELECT 2, c_name, c_nationkey,
    (CASE WHEN c_custkey % 59 = 0 THEN c_acctbal + 1 ELSE c_acctbal END)::DECIMAL(18,2),
    c_mktsegment FROM customer WHERE c_custkey % 53 <> 0),
texts AS (SELECT ord, name, concat_ws('#', name, nation, bal, seg, '1') AS row_text FROM rows_),
crcs AS (SELECT ord, name, {crc32('row_text')} AS row_crc FROM texts),
keys AS (SELECT name, rn, ((rn - 1) // 100 + 1)::BIGINT AS chunk FROM (
  SELECT name, row_number() OVER (ORDER BY name) AS rn FROM (SELECT DISTINCT name FROM rows_))),
chunks AS (
  SELECT chunk, ord, count(row_crc) AS cnt, lower(to_hex(coalesce(bit_xor(row_crc), 0))) AS crc,
    min(name) AS low, max(name) AS high
  FROM keys CROSS JOIN (VALUES (1), (2)) v(ord) LEFT JOIN crcs USING (ord, name)
  GROUP BY chunk, ord)"""


def customers(select: str) -> str:
    return f"WITH {CUSTOMERS} {select}"


def _part_rows(ord: int) -> str:
    code, time, absent = [], [], ["-1"]
    for place, held in CODES.items():
        if held[ord - 1] is None:
            absent.append(str(place))
            continue
        offset, at = held[ord - 1]
        code.append(f"WHEN {place} THEN {offset}")
        time.append(f"WHEN {place} THEN {at}")
    return f"""SELECT {ord} AS ord, 'dn{ord}' AS datanode, p_partkey AS k,
      'c' || (p_partkey + CASE p_partkey % 50 {' '.join(code)} ELSE 0 END) AS code,
      p_retailprice::DECIMAL(18,2) AS price,
      (CASE p_partkey % 50 {' '.join(time)} ELSE 1 END)::BIGINT AS t
    FROM part WHERE p_partkey % 50 NOT IN ({', '.join(absent)})"""


# Repairs that a repair of another key can depend on lie this far apart at most.
PART_LINKS = 4


def _part_plan() -> str:
    """Outcomes of one repair after the other, by rounds: in each, an entry sees the rows that
    no earlier entry of another key has taken from it, as the round before has it."""
    rounds = ["own0 AS (SELECT NULL::VARCHAR AS code, NULL::BIGINT AS id, NULL::BIGINT AS k WHERE false)"]
    for n in range(1, PART_LINKS + 1):
        rounds.append(f"""seen{n} AS (
  SELECT p.differ_id, p.k, p.was, r.ord, r.code, r.t FROM pending p LEFT JOIN (
    SELECT q.differ_id, r.* FROM pending q JOIN rows_ r USING (k) WHERE NOT EXISTS (
      SELECT 1 FROM own{n - 1} o WHERE o.code = r.code AND o.id < q.differ_id AND o.k <> r.k)) r
  ON r.differ_id = p.differ_id),
out{n} AS (
  SELECT differ_id, k, was, CASE WHEN count(DISTINCT code) > 1 THEN 4 WHEN count(ord) > 1 AND min(t) = max(t) THEN 5
    WHEN count(ord) = 0 THEN 2 ELSE 1 END AS status, arg_max(ord, (t, -ord)) AS best, max(code) AS code
  FROM seen{n} GROUP BY differ_id, k, was),
own{n} AS (SELECT code, min(differ_id) AS id, arg_min(k, differ_id) AS k FROM out{n} WHERE status = 1 GROUP BY code)""")
    return ", ".join(rounds)


PARTS = f"""rows_ AS ({_part_rows(1)} UNION ALL {_part_rows(2)}),
pending AS (
  SELECT row_number() OVER (ORDER BY k) AS differ_id, k, CASE WHEN count(*) < 2 THEN 1 ELSE 2 END AS was
  FROM rows_ GROUP BY k HAVING count(*) < 2 OR count(DISTINCT (code, price, t)) > 1),
{_part_plan()},
plan AS (SELECT differ_id, k, status::INT AS status, CASE status WHEN 4 THEN 3 ELSE was END::INT AS differ_type,
  CASE WHEN status = 1 THEN best END::INT AS winner FROM out{PART_LINKS}),
puts AS (SELECT r.* FROM plan p JOIN rows_ r ON r.k = p.k AND r.ord = p.winner),
evicted AS (SELECT r.ord, r.k FROM rows_ r JOIN puts p ON p.code = r.code AND p.k <> r.k)"""


def parts(select: str) -> str:
    return f"WITH {PARTS} {select}"


EVENTS = f"""times AS (SELECT (event_id % 2 + 1)::INT AS ord, event_id,
    {_epoch('ts')} AS seconds, event_id % 31 <> 0 AS is_text, event_id % 37 <> 0 AS is_int
  FROM events)"""

_COLUMNS = [
    ("id", "bigint"),
    ("cust", "bigint"),
    ("st", "string"),
    ("price", "decimal(18,2)"),
    ("prio", "string"),
    ("uk", "string"),
    ("upd", "bigint"),
]


def _column_facts(columns, facts) -> str:
    return " UNION ALL ".join(f"SELECT {facts(at, *c)}" for at, c in enumerate(columns, start=1))


def _nulls(names) -> str:
    counts = ", ".join(f"count(*) - count({n}) AS {n}" for n in names)
    return f"null_counts AS (SELECT {counts} FROM rows_)"


_RESUME = f"""resumed AS (
  SELECT id, ({STORED_CHUNKS} + (rn - {(STORED_CHUNKS - 1) * 100}) // 100)::BIGINT AS chunk
  FROM keys WHERE rn >= {(STORED_CHUNKS - 1) * 100})"""

_SUMMARY = """SELECT (SELECT count(*) FROM compared) AS chunks,
  (SELECT count(*) FROM compared WHERE differs) AS differing_chunks,
  count(*) AS differing_keys, count(*) FILTER (differ_type = 1) AS missing,
  count(*) FILTER (differ_type = 2) AS unlike FROM found"""

_STAGES = """(SELECT count(*) FROM compared) AS chunks,
  (SELECT count(*) FROM compared WHERE differs) AS differing_chunks,
  (SELECT count(*) FROM found) AS differing_keys"""

# After a repair the keys of status 4 and 5 still differ; a check and repair then finds them
# pending alone and repairs none.
_LATER = """after_chunks AS (
  SELECT chunk, count(DISTINCT sig) > 1 AS differs FROM (
    SELECT chunk, ord, (count(row_crc), bit_xor(row_crc)) AS sig
    FROM keys CROSS JOIN nodes LEFT JOIN crcs USING (id, ord) GROUP BY chunk, ord)
  GROUP BY chunk)"""


def oracle_sql() -> dict[str, str]:
    cols = "id, cust, st, price, prio, uk, upd"
    return {
        # Scans and sinks
        "replica_union": orders(f"SELECT ord, datanode, {cols} FROM rows_"),
        "matched_replicas": "SELECT ord, datanode, c_custkey, c_name FROM customer CROSS JOIN "
        "(VALUES (1, 'dn1'), (2, 'dn3')) v(ord, datanode)",
        "key_scan": orders("SELECT ord, id FROM rows_"),
        "key_range_scan": orders(
            f"""SELECT ord, datanode, {cols} FROM rows_,
            (SELECT min(id) AS low, max(id) AS high FROM rows_) b
            WHERE id BETWEEN low + (high - low) // 4 AND high - (high - low) // 4"""
        ),
        "key_lookup_rows": orders(
            f"SELECT ord, datanode, {cols} FROM rows_ WHERE id IN (SELECT id FROM found)"
        ),
        "located_rows": orders(
            f"SELECT ord, datanode, {cols} FROM rows_ WHERE id IN (SELECT id FROM found)"
        ),
        "unique_cols_lookup": orders(
            "SELECT ord, id, uk FROM rows_ WHERE id IN (SELECT id FROM found)"
        ),
        "write_keys_overwrite": orders("SELECT id, 'orders' AS table_name FROM universe"),
        "write_differ_append": orders(
            """SELECT id + run * (SELECT count(*) FROM differ) AS id, table_name, pk, status,
            differ_type FROM differ CROSS JOIN (VALUES (0), (1)) v(run)"""
        ),
        "clear_working_tables": orders(
            """SELECT 'keys' AS working_table, count(*) AS rows_before, 0::BIGINT AS rows_after
            FROM keys UNION ALL SELECT 'chunk', count(*), 0 FROM chunks
            UNION ALL SELECT 'chunk_differ', count(*), 0 FROM compared WHERE differs"""
        ),
        # Validation
        "table_on_all_replicas": f"""SELECT ord, 'dn' || ord AS datanode, count(o_orderkey) > 0 AS exists,
              count(o_orderkey) AS cnt
            FROM (VALUES {', '.join(f"({i}, '{st}')" for i, st in enumerate(STATUSES, 1))}) v(ord, st)
            LEFT JOIN orders ON o_orderstatus = st GROUP BY ord""",
        # JSON has its columns in the order of their names, and no column that is NULL throughout.
        "schema_equal": orders(
            """SELECT 2 AS ord, 'dn2' AS datanode, 3 AS position, 'price' AS expected_name,
              'double' AS expected_type, 'price' AS found_name, 'string' AS found_type
            FROM rows_ HAVING count(*) FILTER (ord = 2 AND id % 1000 = 7) > 0
            UNION ALL SELECT 3, 'dn3', 7, 'upd', 'bigint', NULL, NULL
            FROM rows_ HAVING count(*) FILTER (ord = 3 AND cust IS NULL) = 0"""
        ),
        "pk_single": orders(
            """SELECT ord, count(*) AS cnt, count(DISTINCT id) AS keys,
            (count(*) - count(id))::BIGINT AS null_keys, count(*) = count(DISTINCT id) AS is_key
            FROM (SELECT ord, id FROM rows_ UNION ALL SELECT 0, l_orderkey FROM lineitem)
            GROUP BY ord"""
        ),
        "pending_key_faults": """SELECT 1 AS ord, l_orderkey AS id, count(*) AS cnt FROM lineitem
            GROUP BY l_orderkey HAVING count(*) > 1 OR l_orderkey IS NULL""",
        "undeclared_null_faults": orders(
            """SELECT ord, 'prio' AS column_name, count(*) - count(prio) AS nulls FROM rows_
            GROUP BY ord HAVING count(*) > count(prio)"""
        ),
        "pk_type": orders(
            f"""SELECT ord, pk_type, pk_type = first_value(pk_type) OVER (ORDER BY ord) AS as_stored, cnt FROM (
              SELECT ord, count(*) AS cnt, CASE WHEN ord = 3 THEN 'string'
                WHEN max(id) + CASE ord WHEN 2 THEN {WIDE_KEYS} ELSE 0 END > 2147483647 THEN 'bigint'
                ELSE 'int' END AS pk_type FROM rows_ GROUP BY ord)"""
        ),
        "unique_key_rule": orders(
            """SELECT 'uk' AS unique_key, ord, count(uk) AS tuples,
            count(DISTINCT uk) AS distinct_tuples, count(uk) = count(DISTINCT uk) AS is_unique
            FROM rows_ GROUP BY ord UNION ALL SELECT 'cust', ord, count(cust),
            count(DISTINCT cust), count(cust) = count(DISTINCT cust) FROM rows_ GROUP BY ord"""
        ),
        "time_column_exists": orders(
            """SELECT ord, any_value(datanode) AS datanode,
              count(upd) FILTER (ord < 3 OR cust IS NULL) > 0 AS exists FROM rows_ GROUP BY ord"""
        ),
        "time_format_probe": f"""WITH {EVENTS}
            SELECT ord, count(*) AS cnt, count(*) FILTER (NOT is_text) AS bad,
              'str' AS time_format FROM times GROUP BY ord
            UNION ALL SELECT ord, count(*), count(*) FILTER (NOT is_int), 'int'
              FROM times GROUP BY ord""",
        "empty_table_guard": orders(
            """SELECT 'orders' AS table_name, count(*) = 0 AS is_empty, 1 AS status FROM rows_
            UNION ALL SELECT 'no_rows', count(*) = 0, 4 FROM rows_ WHERE id < 0"""
        ),
        "checksum_columns": orders(
            _column_facts(
                _COLUMNS,
                lambda at, n, t: f"{at} AS position, '{n}' AS column_name, "
                f"{n != 'upd'} AS in_checksum, {n} AS nulls FROM null_counts",
            ),
            _nulls([n for n, _ in _COLUMNS]),
        ),
        "nullable_columns": orders(
            _column_facts(
                _COLUMNS[:-1],
                lambda at, n, t: f"'{n}' AS column_name, {n == 'prio'} AS nullable, "
                f"{n} AS nulls FROM null_counts",
            ),
            _nulls([n for n, _ in _COLUMNS]),
        ),
        "backup_schema_drift": orders(
            _column_facts(
                [
                    *_COLUMNS,
                    ("source_dn", "string"),
                    ("repair_standard", "int"),
                    ("differ_id", "bigint"),
                ],
                lambda at, n, t: f"{at} AS position, '{n}' AS column_name, '{t}' AS column_type, "
                f"false AS drift, true AS wider_drift, count({n}) AS cnt FROM backup",
            ),
            """backup AS (SELECT h.* EXCLUDE (ord, datanode), datanode AS source_dn,
            (ord = winner)::INT AS repair_standard, differ_id
            FROM held h JOIN plan USING (id) WHERE plan.status = 1)""",
        ),
        # Keys and chunks
        "key_universe": orders("SELECT id FROM universe"),
        "key_min_max": customers(
            "SELECT min(name) AS min_key, max(name) AS max_key FROM rows_"
        ),
        "key_count": orders("SELECT count(*) AS cnt FROM universe"),
        "next_key": orders(
            """SELECT chunk, id, lead(id) OVER (PARTITION BY chunk ORDER BY id) AS next_key
            FROM keys"""
        ),
        "chunk_assign": orders("SELECT id, rn, chunk FROM keys"),
        "chunk_assign_text_key": customers("SELECT name, rn, chunk FROM keys"),
        "chunk_boundaries": orders("SELECT * FROM bounds"),
        "chunk_resume": orders(
            """SELECT chunk, min(id) AS upper_boundary, max(id) AS lower_boundary,
            count(*) AS keys FROM resumed GROUP BY chunk""",
            _RESUME,
        ),
        "resumed_differ": orders(
            """SELECT id AS pk, differ_type, 0 AS status FROM
            (SELECT id, chunk FROM keys JOIN compared USING (chunk)
               WHERE differs AND chunk < (SELECT min(chunk) FROM resumed)
             UNION ALL SELECT id, chunk FROM resumed JOIN resumed_chunks USING (chunk)
               WHERE differs)
            JOIN all_found USING (id)""",
            _RESUME,
            """resumed_chunks AS (SELECT chunk, count(DISTINCT sig) > 1 AS differs FROM (
              SELECT chunk, ord, (count(row_crc), bit_xor(row_crc)) AS sig
              FROM resumed CROSS JOIN nodes LEFT JOIN crcs USING (id, ord) GROUP BY chunk, ord)
              GROUP BY chunk),
            sides AS (SELECT id, max(row_crc) FILTER (ord = 1) AS c1,
              max(row_crc) FILTER (ord = 2) AS c2, max(row_crc) FILTER (ord = 3) AS c3
              FROM crcs GROUP BY id),
            all_found AS (SELECT id, CASE WHEN c1 IS NULL OR c2 IS NULL
                OR (c3 IS NULL AND c1 = c2) THEN 1 ELSE 2 END AS differ_type FROM sides
              WHERE (c1 IS DISTINCT FROM c2) OR (c1 IS DISTINCT FROM c3))""",
        ),
        # Checksums
        "row_text": orders("SELECT ord, id, row_text FROM texts"),
        "row_text_decimals": parts(
            "SELECT ord, k, concat_ws('#', k, code, price, t, '1') AS row_text FROM rows_"
        ),
        "row_crc": orders("SELECT ord, id, row_crc FROM crcs"),
        "document_crc": f"""WITH texts AS (SELECT doc_id, concat_ws('#', doc_id, text, lang,
            source, n_chars, CASE WHEN lang IS NULL THEN '1' ELSE '0' END) AS row_text
            FROM documents)
            SELECT 1 AS ord, doc_id, {crc32('row_text')} AS row_crc FROM texts""",
        "chunk_count": orders("SELECT chunk, ord, cnt FROM chunks"),
        "chunk_bitxor": orders("SELECT chunk, ord, fold FROM chunks"),
        "chunk_crc_hex": orders("SELECT chunk, ord, crc FROM chunks"),
        "chunk_checksum": orders("SELECT * EXCLUDE (fold) FROM chunks"),
        "ranged_chunks": orders("SELECT * EXCLUDE (fold) FROM chunks"),
        "chunk_checksum_text_key": customers(
            """SELECT 'customer' AS table_name, chunk, low AS upper_boundary,
            high AS lower_boundary, ord, 'dn' || ord AS datanode, crc, cnt FROM chunks"""
        ),
        "chunk_upsert": orders(
            """SELECT table_name, datanode, chunk, crc, cnt FROM chunks WHERE chunk % 2 = 0
            UNION ALL SELECT 'orders', datanode, chunk, crc, cnt FROM earlier CROSS JOIN nodes
            WHERE chunk NOT IN (SELECT chunk FROM chunks WHERE chunk % 2 = 0)""",
            """first_keys AS (SELECT id, row_crc,
              ((row_number() OVER (ORDER BY id) - 1) // 100 + 1)::BIGINT AS chunk
              FROM crcs WHERE ord = 1),
            earlier AS (SELECT chunk, count(*) AS cnt, lower(to_hex(bit_xor(row_crc))) AS crc
              FROM first_keys GROUP BY chunk)""",
        ),
        "table_checksum": orders(
            """SELECT ord, count(*) AS cnt, lower(to_hex(bit_xor(row_crc))) AS crc
            FROM crcs GROUP BY ord"""
        ),
        # Comparison
        "chunk_compare": orders("SELECT * FROM compared"),
        "chunk_differ": orders("SELECT * EXCLUDE (differs) FROM compared WHERE differs"),
        "drill_keys": orders("SELECT DISTINCT chunk, id FROM key_crcs"),
        "key_checksum": orders("SELECT chunk, id, ord, datanode, crc, cnt FROM key_crcs"),
        "key_differ": orders("SELECT chunk, id, differ_type FROM found"),
        "key_differ_text_key": customers(
            """SELECT k.chunk, k.name, CASE WHEN b.row_crc IS NULL THEN 1 ELSE 2 END
            AS differ_type FROM keys k JOIN crcs a ON a.name = k.name AND a.ord = 1
            LEFT JOIN crcs b ON b.name = k.name AND b.ord = 2
            WHERE a.row_crc IS DISTINCT FROM b.row_crc AND k.chunk IN (
              SELECT chunk FROM chunks GROUP BY chunk HAVING count(DISTINCT (crc, cnt)) > 1)"""
        ),
        "differ_append": orders("SELECT * FROM differ"),
        "no_difference": orders(
            """SELECT ((count(*) + 99) // 100)::BIGINT AS chunks, 0::BIGINT AS differing_chunks,
            0::BIGINT AS differing_keys, 0::BIGINT AS missing, 0::BIGINT AS unlike
            FROM rows_ WHERE ord = 1"""
        ),
        "check_summary": orders(_SUMMARY),
        # Repair
        "pending_keys": orders(
            """SELECT id AS differ_id, pk AS id, differ_type FROM differ WHERE id % 3 <> 0"""
        ),
        "repair_limit": orders(
            """SELECT pending, v.repair_limit::BIGINT AS repair_limit,
            v.repair_limit > 0 AND pending > v.repair_limit AS refused
            FROM (SELECT count(*) AS pending FROM differ)
            CROSS JOIN (VALUES (0), (100), (1000000)) v(repair_limit)"""
        ),
        "unique_conflict": orders("SELECT id FROM facts WHERE tuples > 1"),
        "time_value": f"""WITH {EVENTS} SELECT event_id,
            CASE WHEN is_text THEN seconds END AS of_text,
            CASE WHEN is_int THEN seconds END AS of_int FROM times""",
        "latest_row": orders(f"SELECT ord, datanode, {cols} FROM newest"),
        "same_time_rule": orders("SELECT id FROM facts WHERE np > 1 AND times = 1"),
        "deleted_rule": orders(f"SELECT id + {ABSENT_KEYS} AS id FROM found"),
        "repair_plan": orders(
            f"""SELECT differ_id, id, status, differ_type, winner FROM plan UNION ALL
            SELECT id + {ABSENT_KEYS}, pk + {ABSENT_KEYS}, 2, 0, NULL FROM differ"""
        ),
        "backup_rows": orders(
            f"""SELECT {cols}, datanode AS source_dn,
            (ord = winner)::INT AS repair_standard, differ_id
            FROM held JOIN plan USING (id) WHERE plan.status = 1"""
        ),
        "replace_into": orders(f"SELECT ord, datanode, {cols} FROM repaired"),
        "replace_files": orders(f"SELECT ord, datanode, {cols} FROM repaired"),
        # Up to the first hole each key has lost its second code to the key before it. The key
        # of the hole has lost its only one; from there on nothing is taken, and keys with two
        # codes cannot be repaired, but that of the second hole has one.
        "chain_plan": f"""WITH p AS (SELECT c_custkey AS k, c_custkey % {RUN} AS place FROM customer)
            SELECT row_number() OVER (ORDER BY k) AS differ_id, k,
              CASE WHEN place < {HOLES[0]} OR place = {HOLES[1]} THEN 1
                WHEN place = {HOLES[0]} THEN 2 ELSE 4 END AS status,
              CASE WHEN place IN (0, {HOLES[0]}, {HOLES[1]}) THEN 1
                WHEN place < {HOLES[0]} THEN 2 ELSE 3 END AS differ_type,
              CASE WHEN place < {HOLES[0]} THEN 1 WHEN place = {HOLES[1]} THEN 2 END AS winner FROM p""",
        "contested_plan": parts("SELECT * FROM plan"),
        "replace_evicts": parts("SELECT ord, k FROM evicted"),
        "contested_repair": parts(
            """SELECT r.* FROM rows_ r LEFT JOIN evicted e USING (ord, k)
            WHERE r.k NOT IN (SELECT k FROM puts) AND e.k IS NULL
            UNION ALL SELECT v.ord, v.datanode, p.k, p.code, p.price, p.t
            FROM puts p CROSS JOIN (VALUES (1, 'dn1'), (2, 'dn2')) v(ord, datanode)"""
        ),
        "differ_status_update": orders(
            """SELECT d.id, d.table_name, d.pk, p.status, p.differ_type
            FROM differ d JOIN plan p ON p.differ_id = d.id"""
        ),
        "duplicate_pending": orders(
            """SELECT differ_id, id, status, differ_type, winner FROM plan UNION ALL
            SELECT differ_id + (SELECT count(*) FROM differ), id,
            CASE WHEN status = 1 THEN 5 ELSE status END, differ_type, NULL FROM plan"""
        ),
        "post_repair_check": orders(
            """SELECT id, CASE WHEN c1 IS NULL OR c2 IS NULL OR (c3 IS NULL AND c1 = c2)
            THEN 1 ELSE 2 END AS differ_type FROM after_keys WHERE n < 3 OR kinds > 1""",
            _AFTER,
        ),
        # Jobs
        "run_mode": orders(
            f"""SELECT 'orders' AS table_name, 3 AS run_mode, 5 AS status,
              NULL::BIGINT AS chunks, NULL::BIGINT AS differing_chunks,
              NULL::BIGINT AS differing_keys, NULL::BIGINT AS pending, NULL::BIGINT AS status_1
            UNION ALL SELECT 'orders', 1, 1, {_STAGES}, NULL, NULL
            UNION ALL SELECT 'orders', 2, 1, NULL, NULL, NULL, (SELECT count(*) FROM differ),
              (SELECT count(*) FROM plan WHERE status = 1)
            UNION ALL SELECT 'orders', 0, 1, {_STAGES}, (SELECT count(*) FROM differ),
              (SELECT count(*) FROM plan WHERE status = 1)"""
        ),
        "multi_table": f"""WITH {ROWS}, {NODES}, {CHECK}
            SELECT 'orders' AS table_name, 1 AS run_mode, 1 AS status, {_STAGES},
              NULL::BIGINT AS pending, NULL::BIGINT AS status_1
            UNION ALL SELECT 'lineitem', 1, CASE WHEN count(*) = count(DISTINCT l_orderkey)
              THEN 1 END, NULL, NULL, NULL, NULL, NULL FROM lineitem
            UNION ALL SELECT 'customer', 1, 1, ((count(*) + 99) // 100)::BIGINT,
              count(DISTINCT c_custkey // 100) FILTER (c_custkey % 53 = 0 OR c_custkey % 59 = 0),
              count(*) FILTER (c_custkey % 53 = 0 OR c_custkey % 59 = 0), NULL, NULL
            FROM customer""",
        "run_log": orders(
            """SELECT 'orders' AS table_name, run_mode, status, true AS ended FROM
            (VALUES (1, 2), (3, 5), (2, 1)) v(run_mode, status)
            UNION ALL SELECT 'orders', mode, 1, count(*) > 0
            FROM rows_ CROSS JOIN (VALUES (0), (1)) v(mode) GROUP BY mode"""
        ),
    }
