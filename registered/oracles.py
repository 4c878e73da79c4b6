"""The registered queries in SQL, for DuckDB over the same tables."""

from __future__ import annotations

PRODUCTION = (
    "SELECT l_orderkey AS order_id, l_suppkey AS plant_id, l_quantity AS quantity, l_shipdate AS production_date "
    "FROM lineitem"
)
TRANSACTIONS = (
    "SELECT o_orderkey AS transaction_id, o_custkey AS account_id, o_totalprice AS amount, o_orderdate AS event_time "
    "FROM orders"
)
UNTYPED = (
    "SELECT event_id, ts, user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type, value, props "
    "FROM events"
)
GRADED = "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"

OUTPUT = f"""
SELECT plant_id, CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_output
FROM ({PRODUCTION}) WHERE quantity > 0 GROUP BY plant_id"""
SPEND = f"""
SELECT account_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spend
FROM ({TRANSACTIONS}) WHERE amount > 0 GROUP BY account_id"""
EVENT_COUNTS = f"""
SELECT event_type, count(*) AS event_count
FROM ({UNTYPED}) WHERE event_type IS NOT NULL GROUP BY event_type"""


def row_count(source: str, least: int, most: int | None = None) -> tuple[str, str]:
    if most is None:
        return "'row_count'", (
            f"SELECT count(*) >= {least} AS passed, 'rows=' || count(*) || ', min_required={least}' AS details "
            f"FROM ({source})"
        )
    return "'row_count'", (
        f"SELECT count(*) BETWEEN {least} AND {most} AS passed, "
        f"'rows=' || count(*) || ', min_required={least}, max_allowed={most}' AS details FROM ({source})"
    )


def not_null(source: str, column: str) -> tuple[str, str]:
    nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
    return f"'not_null_{column}'", f"SELECT {nulls} = 0 AS passed, 'nulls=' || {nulls} AS details FROM ({source})"


def unique_key(source: str, *columns: str) -> tuple[str, str]:
    listed = ", ".join(columns)
    return f"'pk_unique_{'_'.join(columns)}'", (
        f"SELECT total = found AS passed, 'total=' || total || ', distinct=' || found AS details FROM "
        f"(SELECT (SELECT count(*) FROM ({source})) AS total, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {listed} FROM ({source}))) AS found)"
    )


def fresh(source: str, column: str, limit: int, as_of: str) -> tuple[str, str]:
    return f"'freshness_{column}'", (
        f"SELECT delay <= {limit}::BIGINT * 60000000 AS passed, "
        f"'delay_minutes=' || CAST(delay / 60000000.0 AS DECIMAL(20,6)) || ', max_delay_minutes={limit}' AS details "
        f"FROM (SELECT epoch_us(TIMESTAMP '{as_of}') - epoch_us(max({column})) AS delay FROM ({source}))"
    )


def corrupt(source: str, unreadable: str, tolerated: str = "0") -> tuple[str, str]:
    found = f"count(*) FILTER (WHERE {unreadable})"
    return "'corrupt_records'", (
        f"SELECT {found} <= {tolerated} AS passed, 'corrupt=' || {found} AS details FROM ({source})"
    )


def silver_transactions(source: str, as_of: str) -> list[tuple[str, str]]:
    return [
        row_count(source, 100),
        not_null(source, "transaction_id"),
        not_null(source, "account_id"),
        unique_key(source, "transaction_id"),
        fresh(source, "event_time", 1560, as_of),
    ]


def suite(*checks: tuple[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {ordinal}::INTEGER AS ordinal, {name} AS check_name, passed, details FROM ({sql})"
        for ordinal, (name, sql) in enumerate(checks)
    )


def logged(domain: str, layer: str, *checks: tuple[str, str]) -> str:
    clean = ("'schema_drift'", "SELECT true AS passed, '' AS details")
    return (
        f"SELECT '{domain}' AS domain, '{layer}' AS layer, check_name, passed, details FROM ({suite(clean, *checks)})"
    )


def run_log(*layers: str) -> str:
    return "\nUNION ALL\n".join(layers)


AS_OF = "2024-01-31 00:00:00"
LINEITEM = "SELECT * FROM lineitem"
LINEITEM_SUITE = suite(
    row_count(LINEITEM, 10),
    not_null(LINEITEM, "l_quantity"),
    not_null(LINEITEM, "l_shipdate"),
    unique_key(LINEITEM, "l_orderkey", "l_linenumber"),
    unique_key(LINEITEM, "l_partkey", "l_suppkey"),
    fresh(LINEITEM, "l_shipdate", 60, AS_OF),
)

DRIFT = """
SELECT 'type_change' AS change_kind, column_name,
       CASE data_type WHEN 'INTEGER' THEN 'bigint' ELSE 'string' END AS source_type,
       CASE data_type WHEN 'INTEGER' THEN 'int' ELSE 'timestamp_ntz' END AS target_type
FROM information_schema.columns
WHERE table_name = 'lineitem' AND data_type IN ('INTEGER', 'TIMESTAMP')
UNION ALL
SELECT 'removed', column_name, NULL, 'double' FROM information_schema.columns
WHERE table_name = 'lineitem' AND column_name = 'l_tax'
UNION ALL
SELECT 'added', 'l_levy', 'double', NULL FROM information_schema.columns
WHERE table_name = 'lineitem' AND column_name = 'l_tax'"""


def audit_of(results: str, domain: str, layer: str, at: str, run_id: str) -> str:
    return (
        f"SELECT '{domain}' AS domain, '{layer}' AS layer, check_name, passed, details, "
        f"epoch_us(TIMESTAMP '{at}') AS run_timestamp, '{run_id}' AS run_id FROM ({results})"
    )


COMPOSITE = suite(unique_key(LINEITEM, "l_orderkey", "l_linenumber"))
DAMAGED = "event_type IN ('error', 'signup')"
TWO_DAYS = "SELECT event_type FROM events UNION ALL SELECT event_type FROM events WHERE event_type <> 'error'"
POSITIVE_TRANSACTIONS = f"SELECT * FROM ({TRANSACTIONS}) WHERE amount > 0"

EARLY = f"SELECT * FROM ({TRANSACTIONS}) WHERE event_time < TIMESTAMP '1995-01-01 00:00:00'"


def new_keys(column: str, repeated: str) -> tuple[str, str]:
    return f"'pk_new_{column}'", f"SELECT ({repeated}) = 0 AS passed, 'repeated=' || ({repeated}) AS details"


ORACLES = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_csv": LINEITEM,
    "scan_csv_inferred": "SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part",
    "scan_json": "SELECT * FROM events",
    "scan_json_inferred": "SELECT * FROM conversations",
    "scan_catalog": "SELECT * FROM supplier",
    "catalog_schema": """
        SELECT column_name, CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
            ELSE lower(data_type) END AS data_type
        FROM information_schema.columns WHERE table_name = 'part'""",
    "append_twice": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "append_evolved": """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS p_brand) FROM part
        UNION ALL SELECT * FROM part""",
    "replace_twice": "SELECT * FROM customer WHERE c_acctbal > 0",
    "replace_guarded": "SELECT *, 2::INTEGER AS reasons FROM part",
    "select_column": "SELECT l_extendedprice FROM lineitem",
    "keep_positive": "SELECT * FROM customer WHERE c_acctbal > 0",
    "keep_not_null": f"SELECT * FROM ({GRADED}) WHERE quality IS NOT NULL",
    "keep_null": f"SELECT * FROM ({GRADED}) WHERE quality IS NULL",
    "grouped_sum": f"SELECT quality, CAST(sum(toxic) AS BIGINT) AS toxic_documents FROM ({GRADED}) GROUP BY quality",
    "grouped_count": f"SELECT event_type, count(*) AS event_count FROM ({UNTYPED}) GROUP BY event_type",
    "exact_sums": """
        SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2))
            + CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM lineitem GROUP BY l_returnflag""",
    "global_measures": f"""
        SELECT count(*) AS row_total, count(*) FILTER (WHERE event_type IS NULL) AS nulls,
               epoch_us(max(ts)) AS latest_micros,
               (SELECT count(*) FROM (SELECT DISTINCT event_type FROM ({UNTYPED}))) AS distinct_values
        FROM ({UNTYPED})""",
    "manufacturing_bronze": PRODUCTION,
    "manufacturing_silver": f"SELECT * FROM ({PRODUCTION}) WHERE quantity > 0",
    "manufacturing_gold": OUTPUT,
    "finance_bronze": TRANSACTIONS,
    "finance_silver": POSITIVE_TRANSACTIONS,
    "finance_gold": SPEND,
    "sbe_bronze": UNTYPED,
    "sbe_silver": f"SELECT * FROM ({UNTYPED}) WHERE event_type IS NOT NULL",
    "sbe_gold": EVENT_COUNTS,
    "manufacturing_run": OUTPUT,
    "finance_run": SPEND,
    "sbe_run": EVENT_COUNTS,
    "finance_batches": f"""
        WITH runs AS (SELECT 1 AS run, * FROM ({TRANSACTIONS}) UNION ALL SELECT 2, * FROM ({TRANSACTIONS}))
        SELECT * EXCLUDE (run), count(*) AS copies, count(DISTINCT run) AS batches FROM runs
        GROUP BY ALL""",
    "manufacturing_run_audit": run_log(
        logged("manufacturing", "bronze", row_count(PRODUCTION, 1), not_null(PRODUCTION, "production_date"), corrupt(PRODUCTION, "order_id IS NULL")),
        logged("manufacturing", "silver", not_null(f"SELECT * FROM ({PRODUCTION}) WHERE quantity > 0", "plant_id")),
        logged("manufacturing", "gold", unique_key(OUTPUT, "plant_id")),
    ),
    "finance_run_audit": run_log(
        logged("finance", "bronze", row_count(TRANSACTIONS, 1)),
        logged(
            "finance",
            "silver",
            *silver_transactions(POSITIVE_TRANSACTIONS, "1995-01-01 00:00:00"),
        ),
        logged("finance", "gold", unique_key(SPEND, "account_id"), not_null(SPEND, "total_spend")),
    ),
    "sbe_run_audit": run_log(
        logged("sbe", "bronze", row_count(UNTYPED, 1), unique_key(UNTYPED, "event_id"), corrupt(UNTYPED, "event_id IS NULL")),
        logged("sbe", "silver", not_null(f"SELECT * FROM ({UNTYPED}) WHERE event_type IS NOT NULL", "event_type")),
        logged("sbe", "gold", row_count(EVENT_COUNTS, 1, 1000)),
    ),
    "sbe_two_days_audit": run_log(
        *[
            logged("sbe", layer, *checks)
            for layer, checks in (
                ("bronze", (row_count("SELECT * FROM events", 1), corrupt("SELECT * FROM events", "event_id IS NULL"))),
                ("bronze", (row_count("SELECT * FROM events", 1), corrupt("SELECT * FROM events", DAMAGED, "count(*)"))),
                *[("silver", (row_count(kept, 1), not_null(kept, "event_type"))) for kept in ("SELECT * FROM events", TWO_DAYS)],
                *[("gold", (unique_key("SELECT DISTINCT event_type FROM events", "event_type"),)) for _ in range(2)],
            )
        ]
    ),
    "sbe_quarantine": f"""
        SELECT event_id, (SELECT count(*) + count(*) FILTER (WHERE NOT {DAMAGED}) FROM events) AS bronze_rows
        FROM events WHERE {DAMAGED}""",
    "gate_after_failed_run": """
        SELECT 'sbe' AS domain, 'bronze' AS layer, count(*) > 0 AS gate_open FROM events
        UNION ALL SELECT 'sbe', 'silver', count(*) FILTER (WHERE event_type = 'error') = 0 FROM events""",
    "gate_after_killed_run": """
        SELECT event_type AS domain, 'bronze' AS layer, count(*) > 0 AS gate_open FROM events GROUP BY event_type
        UNION ALL SELECT event_type, 'silver', count(*) % 2 = 0 FROM events GROUP BY event_type""",
    "finance_new_keys_audit": run_log(
        logged("finance", "bronze", row_count(EARLY, 1), new_keys("transaction_id", f"SELECT count(*) FILTER (WHERE false) FROM ({EARLY})")),
        logged("finance", "bronze", row_count(TRANSACTIONS, 1), new_keys("transaction_id", f"SELECT count(*) FROM ({EARLY})")),
    ),
    "finance_incremental": SPEND,
    "sbe_incremental": EVENT_COUNTS,
    "check_row_count": suite(row_count(LINEITEM, 1), row_count(LINEITEM, 1_000_000_000)),
    "check_row_count_between": suite(
        *[row_count("SELECT * FROM nation", least, most) for least, most in ((25, 25), (26, 99), (0, 24))]
    ),
    "check_not_null": suite(*[not_null(GRADED, column) for column in ("doc_id", "quality", "toxic")]),
    "check_primary_key": suite(unique_key("SELECT * FROM orders", "o_orderkey")),
    "check_primary_key_composite": COMPOSITE,
    "check_primary_key_with_nulls": suite(unique_key(GRADED, "quality"), unique_key(GRADED, "doc_id", "quality")),
    "check_primary_key_text": suite(unique_key("SELECT * FROM documents", "text")),
    "check_primary_key_hashed": suite(
        *[unique_key("SELECT * FROM documents", *columns) for columns in (("text",), ("lang", "source"), ("doc_id", "text"))]
    ),
    "check_freshness": suite(*[fresh("SELECT * FROM events", "ts", limit, AS_OF) for limit in (2, 3, 60)]),
    "check_corrupt_records": suite(
        row_count("SELECT * FROM events", 1),
        not_null(UNTYPED, "event_type"),
        corrupt("SELECT * FROM events", DAMAGED),
    ),
    "check_corrupt_records_csv": suite(
        row_count(LINEITEM, 1), not_null(LINEITEM, "l_quantity"), corrupt(LINEITEM, "l_returnflag = 'R'")
    ),
    "check_suite": LINEITEM_SUITE,
    "check_suite_one_pass": LINEITEM_SUITE,
    "suite_verdict": f"SELECT bool_and(passed) AS passed FROM ({LINEITEM_SUITE})",
    "failed_lines": f"""
        SELECT check_name || ': FAIL (' || details || ')' AS line FROM ({LINEITEM_SUITE}) WHERE NOT passed""",
    "failure_message": f"""
        WITH failed AS (SELECT * FROM ({LINEITEM_SUITE}) WHERE NOT passed)
        SELECT CAST(row_number() OVER (ORDER BY ordinal) AS INTEGER) AS place,
               check_name || ': FAIL (' || details || ')' AS line FROM failed
        UNION ALL SELECT 0::INTEGER, 'Data Quality Checks Failed:' FROM failed HAVING count(*) > 0""",
    "expect_not_null": " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, CASE WHEN NOT passed "
        f"THEN 'Expectation failed: {column} has nulls (' || details || ')' END AS complaint FROM ({sql})"
        for column in ("doc_id", "quality")
        for _, sql in [not_null(GRADED, column)]
    ),
    "expect_unique": " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, CASE WHEN NOT passed "
        f"THEN 'Expectation failed: {column} not unique (' || details || ')' END AS complaint FROM ({sql})"
        for column in ("o_orderkey", "o_custkey")
        for _, sql in [unique_key("SELECT * FROM orders", column)]
    ),
    "rules_from_yaml_lists": suite(
        unique_key("SELECT * FROM events", "event_id"),
        fresh("SELECT * FROM events", "ts", 360, AS_OF),
    ),
    "rules_from_yaml": suite(
        *silver_transactions(TRANSACTIONS, AS_OF),
    ),
    "audit_rows": audit_of(LINEITEM_SUITE, "manufacturing", "silver", "2024-02-01 06:30:00", "run-1"),
    "audit_append": " UNION ALL ".join(
        audit_of(COMPOSITE, "manufacturing", "bronze", f"2024-02-0{day + 1} 06:30:00", f"run-{day}")
        for day in range(2)
    ),
    "audit_gate": """
        WITH log AS (
            SELECT event_type AS domain, 'layer_' || (user_id % 40) AS layer, value < 75 AS passed,
                   CAST(date_trunc('day', ts) AS TIMESTAMP) AS run_timestamp
            FROM events)
        SELECT domain, layer, run_timestamp, bool_and(passed) AS gate_open
        FROM (SELECT *, rank() OVER (PARTITION BY domain, layer ORDER BY run_timestamp DESC) AS newest FROM log)
        WHERE newest = 1 GROUP BY domain, layer, run_timestamp""",
    "schema_drift": DRIFT,
    "schema_drift_nested": f"SELECT * REPLACE ('lines[].' || column_name AS column_name) FROM ({DRIFT})",
    "schema_has_drift": """
        SELECT 'inferred' AS form, count(*) > 0 AS has_drift FROM information_schema.columns
        WHERE table_name = 'events' AND data_type NOT IN ('BIGINT', 'DOUBLE', 'VARCHAR')
        UNION ALL SELECT 'declared', false""",
    "evolution_violations": f"SELECT * FROM ({DRIFT}) WHERE change_kind = 'type_change' AND column_name = 'l_shipdate'",
}
