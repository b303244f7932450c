"""The library's tables, made of the driver's: SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (driver tables it reads, SQL)
ADAPTERS: dict[str, tuple[tuple[str, ...], str]] = {
    "voters": (
        ("customer", "nation"),
        """SELECT c_custkey AS voter_id, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS county,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name || '-' || c_mktsegment END AS precinct,
        CASE c_custkey % 4 WHEN 0 THEN 'Inactive' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Cancelled' ELSE 'Active' END AS status,
        CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE lpad(CAST((c_custkey * 7919) % 100000 AS STRING), 5, '0') END AS residence_zip5,
        CAST(1940 + c_custkey % 66 AS INT) AS birth_year, 'f' || CAST(c_custkey AS STRING) AS first_name, c_name AS last_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "suppressions": (
        ("events",),
        """SELECT 's' || CAST(event_id AS STRING) AS suppression_id, user_id AS voter_id,
        CASE WHEN event_type = 'error' THEN 'suppress' ELSE 'unsuppress' END AS action, 'request' AS reason, 'clerk' AS requested_by,
        CASE WHEN event_type = 'signup' THEN 's' || CAST(event_id - event_id % 7 AS STRING) ELSE NULL END AS supersedes, ts AS requested_at
        FROM events WHERE event_type IN ('error', 'signup')""",
    ),
    "meetings": (
        ("orders",),
        """SELECT o_orderkey AS meeting_id, CAST(o_orderdate AS DATE) AS meeting_date, 'Regular' AS meeting_type,
        CASE o_orderstatus WHEN 'F' THEN 'Clean' WHEN 'O' THEN 'Notice Concerns' ELSE 'Unreviewed' END AS compliance_status,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'Yes' WHEN o_orderpriority LIKE '2%' THEN 'No' ELSE 'Yes (3, then 4)' END AS quorum_met,
        CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' None ' ELSE 'dispute' END AS controversies,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'https://v.example/' || CAST(o_orderkey AS STRING) END AS video_url,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS DOUBLE) END AS hours_logged, 'chair ' || CAST(o_custkey % 9 AS STRING) AS chair
        FROM orders""",
    ),
    "stored_meetings": (
        ("orders",),
        """SELECT 'manual' AS source, o_orderkey AS meeting_id, CAST(o_orderdate AS DATE) AS meeting_date, CASE o_orderkey % 2 WHEN 0 THEN 'Mon' ELSE 'Tue' END AS day_of_week, 'Regular' AS meeting_type, 'Zoom' AS meeting_format,
        'chair ' || CAST(o_custkey % 9 AS STRING) AS chair, 'all' AS members_present, 'Yes' AS quorum_met, CASE WHEN o_orderkey % 4 = 0 THEN 'agenda' END AS agenda_summary, CASE WHEN o_orderkey % 5 = 0 THEN 'kept' END AS key_decisions,
        CASE WHEN o_orderkey % 3 > 0 THEN 'https://v.example/' || CAST(o_orderkey AS STRING) END AS video_url, CASE WHEN o_orderkey % 7 > 0 THEN 'https://s.example/' END AS source_url, 'Unreviewed' AS compliance_status,
        CASE WHEN o_orderkey % 6 = 0 THEN 'note' END AS compliance_notes, CASE WHEN o_orderkey % 8 = 0 THEN 'dispute' END AS controversies, CAST(o_orderkey % 25 AS DOUBLE) AS hours_logged FROM orders""",
    ),
    "videos": (
        ("lineitem",),
        """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS video_id,
        CASE WHEN l_partkey % 5 = 0 THEN l_orderkey ELSE NULL END AS meeting_id, 'https://f.example/' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS video_url,
        CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST((l_orderkey * 7 + l_partkey) % 100 * 2600 AS INT) END AS published_date, l_partkey * 100000 + l_suppkey AS load_seq, l_quantity AS quantity
        FROM lineitem""",
    ),
    "corrections": (
        ("lineitem",),
        """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS correction_id,
        l_orderkey AS meeting_id, CASE l_linenumber % 4 WHEN 0 THEN 'chair' WHEN 1 THEN 'quorum_met' WHEN 2 THEN 'hours_logged' ELSE 'video_url' END AS target_column,
        CASE WHEN l_partkey % 6 = 0 THEN NULL WHEN l_linenumber % 4 = 2 THEN CAST(l_partkey % 25 AS STRING) ELSE 'new ' || CAST(l_partkey AS STRING) END AS corrected_value,
        'clerk' AS corrected_by, 'reason' AS reason, l_shipdate AS corrected_at, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS load_seq
        FROM lineitem""",
    ),
    "instants": (
        ("lineitem",),
        """SELECT CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) || '/' || CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) AS asked_id, l_orderkey AS meeting_id,
        CAST(CAST(l_shipdate AS DATE) + CAST((l_partkey % 7 - 3) * 40 AS INT) AS TIMESTAMP) AS asked_at FROM lineitem""",
    ),
    # Entries of ledger files as people write them, some of which break a rule.
    "raw_suppressions": (
        ("events",),
        """SELECT e, k, id, user_id, source_file, source_file || '#' || lpad(CAST(e AS STRING), 10, '0') AS load_seq, CASE k WHEN 10 THEN '[1]' WHEN 11 THEN 'x{' ELSE
        '{"id": "' || id || '", "voter_id": ' || CASE k WHEN 0 THEN '"7"' WHEN 1 THEN '1.5' WHEN 2 THEN 'true' ELSE CAST(user_id AS STRING) END || ', "action": "' || CASE k WHEN 4 THEN 'hide' WHEN 7 THEN 'unsuppress' ELSE 'suppress' END || '"'
        || CASE k WHEN 3 THEN '' ELSE ', "reason": "r"' END || ', "requested_by": "clerk", "requested_at": "' || CASE k WHEN 6 THEN 'soon' ELSE '2024-05-0' || CAST(1 + e % 9 AS STRING) || 'T10:00:00' END || '"}' END AS value
        FROM (SELECT event_id AS e, event_id % 13 AS k, user_id, 'f' || CAST(event_id % 3 AS STRING) AS source_file,
        CASE event_id % 13 WHEN 5 THEN '  ' WHEN 8 THEN 's' || CAST(event_id - 9 AS STRING) WHEN 9 THEN 's' || CAST(event_id - 10 AS STRING) ELSE 's' || CAST(event_id AS STRING) END AS id FROM events) raw_events""",
    ),
    "raw_corrections": (
        ("orders",),
        """SELECT e, k, id, source_file, source_file || '#' || lpad(CAST(e AS STRING), 10, '0') AS load_seq,
        '{"id": "' || id || '", "meeting_id": ' || CASE k WHEN 0 THEN '"twelve"' WHEN 1 THEN '"12"' ELSE CAST(e AS STRING) END || ', "column": "' || CASE k WHEN 2 THEN 'meeting_date' ELSE ' chair ' END || '", "new_value": ' || CASE k WHEN 8 THEN 'null' ELSE '"new"' END
        || ', "reason": "' || CASE k WHEN 4 THEN ' ' ELSE 'typo' END || '"' || CASE k WHEN 3 THEN '' ELSE ', "corrected_by": "clerk"' END || CASE k WHEN 9 THEN '' ELSE ', "corrected_at": "' || CASE k WHEN 5 THEN '2024-02-30' ELSE '2024-02-0' || CAST(1 + e % 9 AS STRING) END || '"' END || '}' AS value
        FROM (SELECT o_orderkey AS e, o_orderkey % 11 AS k, 'f' || CAST(o_orderkey % 3 AS STRING) AS source_file,
        CASE o_orderkey % 11 WHEN 6 THEN 'c' || CAST(o_orderkey - 18 AS STRING) WHEN 7 THEN 'c' || CAST(o_orderkey - 8 AS STRING) ELSE 'c' || CAST(o_orderkey AS STRING) END AS id FROM orders) raw_orders""",
    ),
    "titles": (
        ("orders",),
        """SELECT o_orderkey AS title_id, CASE o_orderkey % 8
        WHEN 0 THEN 'Board Meeting April ' || CAST(1 + o_custkey % 31 AS STRING) || ', 2026' WHEN 1 THEN 'board sept ' || CAST(1 + o_custkey % 30 AS STRING) || ' 2025 part 2'
        WHEN 2 THEN 'Meeting 03.' || lpad(CAST(1 + o_custkey % 35 AS STRING), 2, '0') || '.26' WHEN 3 THEN 'No date here' WHEN 4 THEN 'Feb 30, 2025 and 02.28.25'
        WHEN 5 THEN 'DECEMBER ' || CAST(1 + o_custkey % 31 AS STRING) || ' 2024' WHEN 6 THEN NULL ELSE 'May 14, 2026 / 05.15.26' END AS title FROM orders""",
    ),
    "raw_registry": (
        ("customer",),
        """SELECT CASE WHEN c_custkey % 41 = 0 THEN 'x12' ELSE ' ' || CAST(c_custkey AS STRING) || ' ' END AS registration_number,
        CASE c_custkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'I' WHEN 2 THEN '' WHEN 3 THEN 'C' ELSE CASE WHEN c_custkey % 3 = 0 THEN 'Z' ELSE 'P' END END AS voter_status,
        CASE c_custkey % 4 WHEN 0 THEN '60' WHEN 1 THEN '44' WHEN 2 THEN '11' ELSE '999' END AS county_code,
        CASE WHEN c_custkey % 29 = 0 THEN ' ' ELSE c_name END AS last_name, 'ann' AS first_name,
        CASE WHEN c_custkey % 6 = 0 THEN '' ELSE CAST(1900 + c_custkey % 230 AS STRING) END AS year_of_birth,
        CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey % 99999 AS STRING) WHEN 1 THEN '303031' WHEN 2 THEN '' ELSE '30303' END AS residence_zipcode,
        CASE c_custkey % 4 WHEN 0 THEN '20240131' WHEN 1 THEN '1/31/2024' WHEN 2 THEN '2024-01-31' ELSE CASE WHEN c_custkey % 5 = 0 THEN '31.01.2024' ELSE '' END END AS registration_date,
        CAST(c_custkey % 300 AS STRING) AS residence_house_number, 'PEACH TREE' AS residence_street_name,
        CASE c_custkey % 5 WHEN 0 THEN 'street' WHEN 1 THEN 'Ave.' WHEN 2 THEN '' WHEN 3 THEN 'RANDOM' ELSE 'blvd' END AS residence_street_suffix,
        CASE WHEN c_custkey % 3 = 0 THEN 'Apt 4' ELSE ' ' END AS residence_apt_unit_nbr, CASE c_custkey % 3 WHEN 0 THEN 'stand-in  o''brien' WHEN 1 THEN 'ATLANTA' ELSE '' END AS residence_city
        FROM customer""",
    ),
    "raw_vendor": (
        ("customer",),
        """SELECT CASE c_custkey % 4 WHEN 0 THEN 'TS' || lpad(CAST(c_custkey AS STRING), 9, '0') WHEN 1 THEN 'ts' || CAST(c_custkey AS STRING) WHEN 2 THEN CAST(c_custkey AS STRING) ELSE CASE WHEN c_custkey % 3 = 0 THEN 'XX1' ELSE 'TS9' || CAST(c_custkey AS STRING) END END AS voterbase_id,
        CASE c_custkey % 5 WHEN 0 THEN '123 MAIN ST' WHEN 1 THEN 'PO BOX 17' WHEN 2 THEN '' WHEN 3 THEN '123' ELSE CAST(c_custkey AS STRING) || '  OAK LN' END AS vf_reg_address1,
        CASE c_custkey % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PURGED' WHEN 2 THEN '' WHEN 3 THEN 'inactive' ELSE 'ODD' END AS vf_voter_status,
        CASE c_custkey % 2 WHEN 0 THEN 'DEKALB' ELSE 'ST CLAIR-BIBB' END AS vf_county_name, 'ann' AS tsmart_first_name, c_name AS tsmart_last_name
        FROM customer""",
    ),
    "requests": (
        ("events",),
        """SELECT event_id, 'ip' || CAST(user_id AS STRING) AS ip, ts, event_type AS route,
        CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 500 ELSE 200 END AS status FROM events""",
    ),
}


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, sql = ADAPTERS[name]
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


def with_adapters(sql: str, *names: str) -> str:
    """``sql`` with the named adapters as its first tables, for DuckDB."""
    tables = ", ".join(f"{n} AS ({ADAPTERS[n][1]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {tables}, {body[15:]}"
    return f"WITH {tables}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {tables} {body}"
