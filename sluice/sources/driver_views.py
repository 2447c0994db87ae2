"""Bindings of the logical input tables onto the driver's TPC-H-style tables.

Each entry is a SQL template (``{table}`` placeholders) that both Spark and
DuckDB run; see ``sluice.sources.catalog``.  Every view is a projection or an
aggregate of a whole driver table, so its size grows with the scale factor.
Only syntax common to Spark SQL and DuckDB is used (``||``, ``lpad``,
``substr``, ``md5``, ``regexp_extract``, ``CAST .. AS STRING``, ``floor``).
"""

from __future__ import annotations

AS_OF = "1998-01-01"

# ── directory tables (FIXTURES.md "Directory tables") ─────────────────────
DIRECTORY_VIEWS = {
    "practices": """
        SELECT c_custkey AS PracticeID,
               CASE WHEN c_acctbal < 0 THEN NULL
                    ELSE 'TX' || lpad(CAST(c_custkey AS STRING), 7, '0') END AS TaxIDNumber,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS Archived
        FROM {customer}""",
    "practice_locations": """
        SELECT o_orderkey AS LocationID,
               o_custkey AS PracticeID,
               lpad(CAST(o_custkey AS STRING), 10, '0') AS NationalProviderID,
               o_orderstatus AS InDirectory,
               CAST(o_custkey % 25 AS INT) AS LocationTypeID,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS Archived
        FROM {orders}""",
    "user_fields": """
        SELECT l_orderkey * 10 + l_linenumber AS UserFieldRecID,
               l_orderkey AS ParentRecID,
               l_partkey AS UserDefinedFieldID,
               CASE WHEN l_linenumber = 6 THEN '0000' || CAST(l_partkey % 10 AS STRING) ELSE l_returnflag END AS Value,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS DateFrom,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate + INTERVAL 365 DAY END AS DateTo,
               CASE WHEN l_linestatus = 'F' THEN 'N' ELSE 'Y' END AS Archived
        FROM {lineitem}""",
    "user_defined_fields": """
        SELECT p_partkey AS UserDefinedFieldID,
               split_part(p_type, ' ', 1) AS FieldName,
               CAST(p_size % 10 AS BIGINT) AS RecordTypeID,
               CASE WHEN p_brand = 'Brand#13' THEN 'Y' ELSE 'N' END AS Archived
        FROM {part}""",
    "record_types": """
        SELECT s_suppkey AS RecordTypeID,
               CASE WHEN s_suppkey % 4 = 1 OR s_acctbal <= 0 THEN 'Practitioners' ELSE 'PracticeLocations' END AS TableName,
               CASE WHEN s_nationkey = 0 THEN 'Y' ELSE 'N' END AS Archived
        FROM {supplier}""",
    "practice_types": """
        SELECT n_nationkey AS PracticeTypeID,
               CASE WHEN n_nationkey % 5 = 4 THEN 'Billing' ELSE 'Service' END AS PracticeTypeName,
               n_regionkey AS StatusSetID,
               CASE WHEN n_nationkey = 12 THEN 'Y' ELSE 'N' END AS Archived
        FROM {nation}""",
    "status_sets": """
        SELECT r_regionkey AS StatusSetID,
               CASE WHEN r_name IN ('EUROPE', 'ASIA') THEN 'Location Types' ELSE 'Other Types' END AS StatusSetName
        FROM {region}""",
    # Practitioners and their state after the load: the flag cleared, padded,
    # blank or unchanged, some archived meanwhile.
    "practitioners": """
        SELECT c_custkey AS PractitionerID,
               CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS STRING), 10, '0') END AS NationalProviderID,
               CASE WHEN c_nationkey % 3 = 0 THEN 'N' ELSE 'Y' END AS ActiveMilitaryOrReserve,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS Archived
        FROM {customer}""",
    "practitioners_after": """
        SELECT c_custkey AS PractitionerID,
               CASE c_custkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN ' n' WHEN 2 THEN NULL ELSE 'Y' END AS ActiveMilitaryOrReserve,
               CASE WHEN c_mktsegment = 'MACHINERY' OR c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS Archived
        FROM {customer}""",
    # State of the locations after the loader ran (JOIN-2): some archived
    # meanwhile, the flag suppressed, padded, blank or unchanged; an audit user.
    "practice_locations_after": """
        SELECT o_orderkey AS LocationID,
               o_custkey AS PracticeID,
               lpad(CAST(o_custkey AS STRING), 10, '0') AS NationalProviderID,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'N' WHEN '2-HIGH' THEN ' n '
                    WHEN '3-MEDIUM' THEN NULL ELSE o_orderstatus END AS InDirectory,
               CAST(o_custkey % 25 AS INT) AS LocationTypeID,
               CASE WHEN o_orderkey % 11 = 0 OR (o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0) THEN 'Y' ELSE 'N' END AS Archived,
               CASE WHEN o_orderkey % 3 = 0 THEN 'svc-DataLoader' ELSE 'jsmith' END AS ModifiedBy,
               o_orderdate + INTERVAL 2000 DAY AS ModifiedAt
        FROM {orders}""",
}

# ── practitioner location snapshots before/after (JOIN-8) ─────────────────
PRACTITIONER_VIEWS = {
    "practitioner_locations_before": """
        SELECT CASE WHEN o_orderkey % 17 = 0 THEN -o_orderkey ELSE o_orderkey END AS PractitionerLocationRecID,
               o_custkey AS PractitionerID,
               o_orderkey % 1000 AS LocationID,
               CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN ' y' ELSE 'N' END AS InDirectory
        FROM {orders}""",
    "practitioner_locations_after": """
        SELECT o_orderkey AS PractitionerLocationRecID,
               o_custkey AS PractitionerID,
               o_orderkey % 1000 AS LocationID,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'N'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n '
                    WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS InDirectory,
               CASE WHEN o_orderkey % 4 = 0 THEN 'DataLoader-svc' WHEN o_orderkey % 4 = 1 THEN NULL
                    ELSE 'editor' END AS AuditUser,
               o_orderdate AS AuditTime
        FROM {orders}""",
}

# ── process status, payloads and splits (FIXTURES.md "Process status") ───
# One process in 50 is a run's own load process, keyed by the run's UUID (the
# same hash the log renders into file names), so status rows can be traced
# back to runs; the others are plain ids.
_EVENTS_H = ("(SELECT *, md5('run-' || CAST(CAST(floor(event_id / 200) AS BIGINT) % 40 AS STRING)) AS _h "
             "FROM {events})")
_PROCESS_ID = ("CASE WHEN CAST(floor(event_id / 4) AS BIGINT) % 50 = 0 THEN "
               "substr(_h, 1, 8) || '-' || substr(_h, 9, 4) || '-' || substr(_h, 13, 4) || '-' || "
               "substr(_h, 17, 4) || '-' || substr(_h, 21, 12) "
               "ELSE 'proc-' || lpad(CAST(CAST(floor(event_id / 4) AS BIGINT) AS STRING), 7, '0') END")
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

STATUS_VIEWS = {
    "process_status": f"""
        SELECT event_id AS id,
               {_PROCESS_ID} AS process_id,
               CASE event_type WHEN 'purchase' THEN 'Data-Loader-File' WHEN 'view' THEN 'File-Record'
                    WHEN 'click' THEN CASE WHEN event_id % 11 = 0 THEN ' Validation ' ELSE 'Validation' END
                    WHEN 'signup' THEN CASE WHEN event_id % 5 = 1 THEN 'Data-Loader-File' ELSE 'DL-Integration' END
                    ELSE CASE WHEN event_id % 3 = 0 THEN 'Data-Loader-File'
                              WHEN event_id % 3 = 1 THEN NULL ELSE 'File-Record' END END AS sub_process_name,
               CASE event_type
                    WHEN 'purchase' THEN 'Completed'
                    WHEN 'view' THEN ' completed '
                    WHEN 'click' THEN 'COMPLETED'
                    WHEN 'signup' THEN CASE WHEN event_id % 5 = 0 THEN 'In-Progress'
                                            WHEN event_id % 5 = 1 THEN NULL ELSE 'Completed' END
                    ELSE CASE WHEN event_id % 2 = 0 THEN 'Failed' ELSE 'error' END END AS status,
               'practice' AS entity_name,
               'TaxIDNumber' AS business_key,
               CAST(user_id AS STRING) AS business_value,
               CASE WHEN event_type = 'error' THEN
                    CASE {_K} % 4 WHEN 0 THEN ' Schema-Validation-Error ' WHEN 1 THEN 'timeout'
                                  WHEN 2 THEN 'dedupe-error' ELSE '' END END AS error,
               CASE WHEN event_id % 7 = 3 THEN NULL ELSE CAST({_K} AS STRING) END AS payload_response_id,
               CASE WHEN event_id % 3 = 0 THEN 'retry ' || CAST(event_id AS STRING) END AS notes,
               ts AS updated_at
        FROM {_EVENTS_H} AS e""",
    "payload_response": """
        SELECT CAST(item_id AS STRING) AS payload_response_id,
               CASE item_id % 4
                    WHEN 0 THEN '{"item_id": ' || CAST(item_id AS STRING) || ', "reason": "'
                                || split_part(text, ' ', 1) || '"}'
                    WHEN 1 THEN '{' || text
                    WHEN 2 THEN ''
                    ELSE text END AS response,
               CASE WHEN item_id % 5 = 0 THEN '' ELSE text || ' AppliedRule=rule-' || CAST(item_id % 20 AS STRING)
                    || CASE WHEN item_id % 3 = 0 THEN ' InDirectory=N' ELSE '' END END AS payload
        FROM {benchmark}""",
    # The entity each process is expected to be about (JOIN-11): usually one
    # of its rows' business values, sometimes an id it never mentions.
    "status_targets": f"""
        SELECT process_id,
               CASE WHEN max(event_id) % 3 = 0 THEN CAST(max(user_id) + 1000 AS STRING) ELSE CAST(max(user_id) AS STRING) END
                 AS expected_value
        FROM (SELECT {_PROCESS_ID} AS process_id, event_id, user_id FROM {_EVENTS_H} AS e) AS p
        GROUP BY process_id""",
    # The split manifest: every process, those last seen on an id divisible
    # by 3 listed again, and by 5 with a split that has no status row.
    "splits": f"""
        SELECT CAST(m.last_id * 3 + c.copy AS BIGINT) AS position,
               CASE WHEN c.copy = 2 THEN 'proc-missing-' || CAST(m.last_id AS STRING) ELSE m.process_id END AS split_process_id
        FROM (SELECT process_id, max(event_id) AS last_id
              FROM (SELECT {_PROCESS_ID} AS process_id, event_id FROM {_EVENTS_H} AS e) AS p
              GROUP BY process_id) AS m
        JOIN (SELECT CAST(r_regionkey AS BIGINT) AS copy FROM {{region}}) AS c
          ON c.copy = 0 OR (c.copy = 1 AND m.last_id % 3 = 0) OR (c.copy = 2 AND m.last_id % 5 = 0)""",
}

# ── run-log captures (FIXTURES.md "Run logs") ─────────────────────────────
_RUN = "'jr_' || lpad(CAST(o_custkey % 40 AS STRING), 3, '0')"
_UUID_SRC = ("md5('run-' || CAST(o_custkey % 40 AS STRING) || CASE WHEN o_custkey % 40 = 5 "
             "THEN '-' || CAST(o_orderkey % 2 AS STRING) ELSE '' END)")
# Orders with the run's hash computed once per row (an inner projection, so
# the expression is not repeated in every place the UUID is rendered).
_ORDERS_H = (f"(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
             f"{_UUID_SRC} AS _h FROM {{orders}})")
_UUID = ("substr(_h, 1, 8) || '-' || substr(_h, 9, 4) || '-' || "
         "substr(_h, 13, 4) || '-' || substr(_h, 17, 4) || '-' || substr(_h, 21, 12)")
_BUCKET = "CASE WHEN o_custkey % 40 = 13 AND o_orderkey % 2 = 0 THEN 'other-bucket' ELSE 'outbound-bucket' END"
_PREFIX = ("CASE WHEN o_orderkey % 5 = 0 AND o_custkey % 40 = 17 THEN '/outbound/practice_update/' "
           "WHEN o_orderkey % 5 = 1 THEN 'outbound/practitioner_update/' "
           "WHEN o_orderkey % 5 = 2 THEN 'archive/practice_update/' ELSE 'outbound/practice_update/' END")
_FILE = (f"CASE WHEN o_custkey % 40 = 9 THEN 'practice_batch_part' || CAST(o_orderkey % 3 AS STRING) || '.csv' "
         f"ELSE 'practice_' || {_UUID} || '_part' || CAST(o_orderkey % 3 AS STRING) || '.csv' END")

# Runs whose completion line is missing in some sources: 7 (api), 8 and 28
# (api, manager), 12 (everywhere).
_QUEUED = ("((o_custkey % 40 = 7 AND o_orderkey % 3 = 0) OR (o_custkey % 40 IN (8, 28) AND o_orderkey % 3 <> 2) "
           "OR o_custkey % 40 = 12)")

LOG_VIEWS = {
    "run_log_captures": f"""
        SELECT {_RUN} AS run_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'manager' ELSE 'file' END AS source,
               'output-' || {_RUN} || '-' || CAST(o_orderkey % 3 AS STRING) || '.log' AS file_name,
               o_orderdate AS modified_at,
               o_orderkey AS line_no,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN 'INFO AppliedRule=' || CASE CAST(floor(o_orderkey / 3) AS BIGINT) % 5
                         WHEN 0 THEN '15' WHEN 1 THEN 'rule-7' WHEN 2 THEN '3' WHEN 3 THEN 'Rule_15'
                         ELSE CAST(o_orderkey % 20 AS STRING) END
                         || ' rule_count=' || CASE WHEN o_orderkey % 11 = 0 THEN '0'
                              ELSE CAST(11 + CAST(floor(o_totalprice / 1000) AS BIGINT) % 6 AS STRING) END
                    WHEN '2-HIGH' THEN 'INFO records_to_s3=' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING)
                    WHEN '3-MEDIUM' THEN CASE WHEN {_QUEUED}
                         THEN 'INFO Chunk ' || CAST(o_orderkey % 3 + 1 AS STRING) || ' queued'
                         ELSE 'INFO Chunk ' || CAST(o_orderkey % 3 + 1 AS STRING) || ' written to s3://'
                              || {_BUCKET} || '/' || {_PREFIX} || {_FILE} END
                    WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 4 = 0
                         THEN 'ERROR failed to load record ' || CAST(o_orderkey AS STRING) || ' for ' || {_RUN}
                         ELSE 'INFO heartbeat' END
                    ELSE 'INFO processed batch ' || CAST(o_orderkey AS STRING) END AS message,
               CASE WHEN o_orderkey % 3 <> 2 THEN NULL
                    WHEN o_custkey % 40 = 11 THEN 'jr_999'
                    WHEN o_custkey % 40 < 20 THEN {_RUN} END AS declared_stream
        FROM {_ORDERS_H} AS o""",
    "runs": f"""
        SELECT {_RUN} AS run_id,
               CASE WHEN o_custkey % 2 = 0 THEN 'practice' ELSE 'practitioner' END AS flow_name,
               CASE WHEN o_custkey % 10 = 3 THEN 'FAILED' WHEN o_custkey % 10 IN (1, 6, 8) THEN 'SKIPPED_TRIGGER' ELSE 'SUCCEEDED' END AS state,
               min(o_orderdate) + INTERVAL 1000 DAY AS started_at,
               'directory-' || CASE WHEN o_custkey % 2 = 0 THEN 'practice' ELSE 'practitioner' END
                    || '-suppression-job' AS job_name
        FROM {{orders}}
        GROUP BY o_custkey % 40, o_custkey % 2, o_custkey % 10""",
    # Object inventory of every written key: some landed under another name
    # only, some are empty, some are old copies from before the run.
    "object_inventory": f"""
        SELECT bucket, CASE WHEN first_key % 8 = 3 THEN key || '.tmp' ELSE key END AS key,
               CAST(CASE WHEN first_key % 10 = 1 THEN 0 ELSE total END AS BIGINT) AS size,
               CASE WHEN first_key % 7 = 0 THEN last_day - INTERVAL 4000 DAY ELSE last_day + INTERVAL 1500 DAY END AS last_modified
        FROM (SELECT {_BUCKET} AS bucket, {_PREFIX} || {_FILE} AS key, min(o_orderkey) AS first_key,
                     sum(CAST(floor(o_totalprice) AS BIGINT)) AS total, max(o_orderdate) AS last_day
              FROM {_ORDERS_H} AS o
              WHERE o_orderpriority = '3-MEDIUM'
              GROUP BY {_BUCKET}, {_PREFIX} || {_FILE}) AS g""",
}

# Object write events (one per chunk written; a key written twice is
# overwritten): the streaming form of the inventory.
LOG_VIEWS["object_events"] = f"""
        SELECT {_BUCKET} AS bucket, {_PREFIX} || {_FILE} AS key, CAST(floor(o_totalprice) AS BIGINT) AS size,
               o_orderdate + INTERVAL 1500 DAY AS last_modified
        FROM {_ORDERS_H} AS o
        WHERE o_orderpriority = '3-MEDIUM'"""

# ── outbound file rows (FIXTURES.md "Outbound files") ─────────────────────
# One row per written record, and a second one in the same file for some, in
# a later run's file for others: all values are strings; ids are
# zero-padded on some rows and lost on a few; TaxIDNumber sometimes in
# scientific notation.
_COPY_RUN = "((o_custkey % 40 + CASE WHEN copy = 1 AND o_orderkey % 7 = 0 THEN 2 ELSE 0 END) % 40)"
_COPY_H = f"md5('run-' || CAST({_COPY_RUN} AS STRING) || CASE WHEN {_COPY_RUN} = 5 THEN '-' || CAST(o_orderkey % 2 AS STRING) ELSE '' END)"
_WRITTEN = f"""(SELECT orders.*, c.copy, {_COPY_RUN} AS run_no, {_COPY_H} AS _h
              FROM {{orders}}
              JOIN (SELECT CAST(r_regionkey AS BIGINT) AS copy FROM {{region}}) AS c
                ON c.copy = 0 OR (c.copy = 1 AND (o_orderkey % 7 = 0 OR o_orderkey % 4 = 0)))"""
OUTBOUND_VIEWS = {
    "outbound_rows": f"""
        SELECT 's3://outbound-bucket/outbound/' || CASE WHEN o_orderstatus = 'O' THEN 'practitioner_update' ELSE 'practice_update' END
                    || '/practice_' || {_UUID} || '_part' || CAST(o_orderkey % 4 AS STRING) || '.csv' AS file_path,
               o_orderkey * 2 + copy AS row_no,
               'jr_' || lpad(CAST(run_no AS STRING), 3, '0') AS run_id,
               CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(o_custkey AS STRING), 8, '0')
                    ELSE CAST(o_custkey AS STRING) END AS PracticeID,
               CASE WHEN o_orderkey % 9 = 0 THEN '8.41E+08' ELSE 'TX' || lpad(CAST(o_custkey AS STRING), 7, '0') END AS TaxIDNumber,
               CAST(o_orderkey AS STRING) AS BillingLocationServiceRecID,
               CASE WHEN o_orderkey % 10 = 3 THEN '' WHEN o_orderkey % 5 = 0 THEN ' ' || lpad(CAST(o_orderkey AS STRING), 9, '0')
                    ELSE CAST(o_orderkey AS STRING) END AS BillingLocationID,
               'Service' AS BillingServiceTypeName,
               o_orderpriority AS BillingServiceCategoryTypeName,
               CASE (o_orderkey + copy) % 6 WHEN 0 THEN 'Directory-Auto ' WHEN 1 THEN 'manual' ELSE 'directory-auto' END AS DataSource
        FROM {_WRITTEN} AS w""",
    # The practitioner flow's rows: the provider id padded, plain or lost.
    "practitioner_outbound_rows": f"""
        SELECT 's3://outbound-bucket/outbound/' || CASE WHEN o_orderstatus = 'O' THEN 'practitioner_update' ELSE 'practice_update' END
                    || '/practice_' || {_UUID} || '_part' || CAST(o_orderkey % 4 AS STRING) || '.csv' AS file_path,
               o_orderkey * 2 + copy AS row_no,
               'jr_' || lpad(CAST(run_no AS STRING), 3, '0') AS run_id,
               CASE WHEN o_orderkey % 10 = 3 THEN '' WHEN o_orderkey % 2 = 0 THEN ' ' || CAST(o_custkey AS STRING)
                    ELSE lpad(CAST(o_custkey AS STRING), 10, '0') END AS NationalProviderID,
               CASE (o_orderkey + copy) % 8 WHEN 0 THEN 'Y' WHEN 1 THEN ' n' ELSE 'N' END AS ActiveMilitaryOrReserve
        FROM {_WRITTEN} AS w""",
}

ALL_VIEWS: dict[str, str] = {**DIRECTORY_VIEWS, **PRACTITIONER_VIEWS, **STATUS_VIEWS, **LOG_VIEWS, **OUTBOUND_VIEWS}
