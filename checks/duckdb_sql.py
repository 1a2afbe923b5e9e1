"""The registered queries once more, as SQL for an independent engine.

Every statement stands alone: it names the layers it needs as common table
expressions. Money is compared in whole cents wherever a rule or a rounding
depends on it, so no result rests on binary fractions.
"""

from __future__ import annotations

PERIOD_FROM = "TIMESTAMP '2024-01-01 00:00:00'"
PERIOD_TO = "TIMESTAMP '2024-01-28 23:59:59'"
IN_PERIOD = f"coalesce(txn_ts_cast BETWEEN {PERIOD_FROM} AND {PERIOD_TO}, false)"

LAYERS = {
    "base": """
        SELECT event_id,
               printf('T%08d', event_id) AS txn_id,
               CASE WHEN event_id % 83 = 7 THEN 'ACC99999999'
                    ELSE printf('ACC%08d', user_id) END AS account_id,
               printf('MER%04d', event_id % 40) AS merchant_id,
               printf('MC%02d', (event_id % 40) % 12) AS merchant_category,
               CASE WHEN event_id % 127 = 5 THEN '1970-01-01 00:00:00'
                    WHEN event_id % 149 = 11 THEN 'not-a-time'
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txn_ts,
               printf('DEV%07d', CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10)
                   AS device_id,
               CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN event_id % 41 = 3 THEN 'NA'
                    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount
        FROM events""",
    "raw": """
        SELECT * EXCLUDE (event_id) FROM base
        UNION ALL
        SELECT * EXCLUDE (event_id) FROM base WHERE event_id % 97 = 9""",
    "deduped": """
        SELECT * FROM raw
        QUALIFY row_number() OVER (
            PARTITION BY txn_id
            ORDER BY txn_ts NULLS LAST, account_id NULLS LAST, merchant_id NULLS LAST,
                     merchant_category NULLS LAST, device_id NULLS LAST, status NULLS LAST,
                     amount NULLS LAST
        ) = 1""",
    "parsed": """
        SELECT *, TRY_CAST(amount AS DECIMAL(18,2)) AS amount_cast,
               TRY_CAST(txn_ts AS TIMESTAMP) AS txn_ts_cast
        FROM deduped""",
    "classified": f"""
        SELECT *,
               CASE WHEN amount_cast IS NULL THEN 'unparseable_amount'
                    WHEN account_id IS NULL OR account_id = 'ACC99999999' THEN 'unknown_account'
                    WHEN NOT {IN_PERIOD} THEN 'timestamp_out_of_range'
               END AS reject_reason
        FROM parsed""",
    "rejects": """
        SELECT txn_id, account_id, merchant_id, txn_ts, reject_reason
        FROM classified WHERE reject_reason IS NOT NULL""",
    "silver": """
        SELECT txn_id, account_id, merchant_id, merchant_category, txn_ts_cast AS txn_ts,
               device_id, status, amount_cast AS amount,
               CAST(amount_cast * 100 AS BIGINT) AS cents,
               CAST(txn_ts_cast AS DATE) AS account_day
        FROM classified WHERE reject_reason IS NULL""",
    "daily": """
        SELECT account_id, account_day, count(*) AS txns, max(cents) AS cents,
               count(DISTINCT device_id) AS distinct_devices
        FROM silver GROUP BY account_id, account_day""",
    "baseline": """
        SELECT *, CAST(sum(cents) OVER prior AS BIGINT) AS prior_cents,
               count(cents) OVER prior AS prior_txn_count
        FROM daily
        WINDOW prior AS (PARTITION BY account_id ORDER BY account_day
                         ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    "gold": """
        SELECT account_id, account_day, txns, cents, prior_cents,
               cents / 100 AS max_amount,
               distinct_devices,
               round(prior_cents / (100 * nullif(prior_txn_count, 0)), 6) AS avg_amount_30d_trailing,
               prior_txn_count,
               coalesce(prior_txn_count >= 5 AND cents * prior_txn_count >= 5 * prior_cents, false)
                   AS is_amount_spike,
               distinct_devices >= 3 AS is_device_burst
        FROM baseline""",
    "stored": """
        SELECT account_id, account_day, txns, cents, max_amount,
               (2 * prior_cents + prior_txn_count) // (2 * nullif(prior_txn_count, 0))
                   AS baseline_cents,
               prior_txn_count, distinct_devices, is_amount_spike, is_device_burst
        FROM gold""",
    "merchant": """
        SELECT merchant_id, hour(txn_ts) AS hour_of_day, count(*) AS txns,
               count(*) FILTER (status = 'FAILED') AS failed_txns
        FROM silver GROUP BY 1, 2""",
    "merchant_gold": """
        SELECT *, round(failed_txns / txns, 4) AS failure_rate FROM merchant""",
    "accounts": """
        SELECT printf('ACC%08d', c_custkey) AS account_id,
               printf('BANK%d', c_custkey % 8) AS bank,
               printf('CITY%d', c_custkey % 10) AS home_city,
               printf('DEV%07d', c_custkey) AS primary_device,
               printf('DEV9%06d', c_custkey) AS secondary_device
        FROM customer""",
}
NEEDS = {
    "raw": ["base"],
    "deduped": ["raw"],
    "parsed": ["deduped"],
    "classified": ["parsed"],
    "rejects": ["classified"],
    "silver": ["classified"],
    "daily": ["silver"],
    "baseline": ["daily"],
    "gold": ["baseline"],
    "stored": ["gold"],
    "merchant": ["silver"],
    "merchant_gold": ["merchant"],
}


def over(layers: str, select: str, raw: str | None = None) -> str:
    """``select`` behind a WITH clause for the named layers and all they need.

    ``raw`` replaces the raw payments by another source.
    """
    sources = LAYERS if raw is None else {**LAYERS, "raw": raw}
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in NEEDS.get(name, []):
            if raw is None or name != "raw":
                visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in layers.split():
        visit(name)
    clauses = ",\n".join(f"{name} AS ({sources[name]})" for name in ordered)
    return f"WITH {clauses}\n{select}"


RAW_COLUMNS = "txn_id, account_id, merchant_id, merchant_category, txn_ts, device_id, status, amount"
GOLD_COLUMNS = (
    "account_id, account_day, txns, max_amount, distinct_devices, avg_amount_30d_trailing, "
    "prior_txn_count, is_amount_spike, is_device_burst"
)
MULTIPLE = "round(cents * prior_txn_count / prior_cents, 2)"
MASKED = "'XXXXXXXX' || right(account_id, 4)"
SPIKES = f"""
    SELECT {{account}} AS account_id, account_day, max_amount,
           avg_amount_30d_trailing AS baseline_30d, {MULTIPLE} AS spike_multiplier, prior_txn_count
    FROM gold WHERE is_amount_spike"""
OFF_HOURS = """
    SELECT CASE WHEN merchant_id BETWEEN 'MER0000' AND 'MER0009'
                THEN '{risk}' ELSE '{other}' END AS merchant_group,
           CASE WHEN hour_of_day IN (23, 0, 1) THEN '{night}' ELSE 'REGULAR_HOURS' END AS time_window,
           CAST(sum(txns) AS BIGINT) AS total_txns,
           CAST(sum(failed_txns) AS BIGINT) AS total_failed,
           round(sum(failed_txns) / sum(txns) * 100, 2) AS aggregate_failure_rate_pct
    FROM merchant_gold GROUP BY 1, 2"""
MERCHANT_COLUMNS = (
    "merchant_id, CAST(hour_of_day AS INTEGER) AS hour_of_day, txns, failed_txns, failure_rate"
)

# Payments as deduplication tells them apart: by id, without one by all columns.
DISTINCT_PAYMENTS = """(SELECT count(DISTINCT txn_id) FROM raw)
    + (SELECT count(*) FROM (SELECT DISTINCT * FROM raw WHERE txn_id IS NULL))"""

# What a payment is known by in every layer, and the order-free sum of its hashes.
IDENTITY = """coalesce(txn_id, '?' || concat_ws('|', '\\N', coalesce(account_id, '\\N'),
    coalesce(merchant_id, '\\N'), coalesce(txn_ts, '\\N')))"""
CHECKSUM = "CAST(coalesce(sum(CAST('0x' || substr(md5(identity), 1, 15) AS BIGINT)), 0) AS VARCHAR)"


def audit(name: str, source: str, key: str, required: str, bounded: dict[str, int]) -> str:
    """Repeated keys, NULLs in required columns and texts beyond their bound, as one row."""
    nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in required.split()) or "0"
    longer = " + ".join(f"count(*) FILTER (length({c}) > {n})" for c, n in bounded.items()) or "0"
    repeated = f"(SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1))"
    return f"""SELECT '{name}' AS table_name, count(*) AS rows, {repeated if key else 0} AS duplicate_keys,
                  {nulls} AS null_violations, {longer} AS length_violations
           FROM {source}"""

# Order lines as text with broken values, what the declared table takes of them, and which rules the rest breaks.
LINE_TYPES = {
    "l_orderkey": "BIGINT",
    "l_linenumber": "INTEGER",
    "l_partkey": "BIGINT",
    "l_suppkey": "BIGINT",
    "l_returnflag": "VARCHAR",
    "l_shipdate": "TIMESTAMP",
}
LINE_FIELDS = ", ".join(LINE_TYPES)
LINE_TEXTS = ", ".join(f"text_{name} AS {name}" for name in LINE_TYPES)
LINE_TESTS = " || ".join(
    f"""CASE WHEN text_{name} IS NULL THEN ' null:{name}' WHEN {name} IS NULL THEN ' type:{name}' ELSE '' END"""
    + (f""" || CASE WHEN length(text_{name}) > 1 THEN ' length:{name}' ELSE '' END""" if name == "l_returnflag" else "")
    for name in LINE_TYPES
)
LOADED = f"""WITH texts AS (
    SELECT l_orderkey::VARCHAR AS text_l_orderkey,
           CASE WHEN l_orderkey % 101 = 3 THEN '99999999999' ELSE l_linenumber::VARCHAR END AS text_l_linenumber,
           CASE WHEN l_orderkey % 89 = 5 THEN NULL ELSE l_partkey::VARCHAR END AS text_l_partkey,
           CASE WHEN l_orderkey % 97 = 7 THEN 'n/a' ELSE l_suppkey::VARCHAR END AS text_l_suppkey,
           CASE WHEN l_orderkey % 83 = 11 THEN 'RR' ELSE l_returnflag END AS text_l_returnflag,
           CASE WHEN l_orderkey % 79 = 13 THEN '2024-02-30 00:00:00'
                ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS text_l_shipdate
    FROM lineitem),
typed AS (SELECT *, {", ".join(f"TRY_CAST(text_{n} AS {t}) AS {n}" for n, t in LINE_TYPES.items())} FROM texts),
checked AS (SELECT *, trim(coalesce({LINE_TESTS}, '')) AS failed_rules FROM typed),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_returnflag, l_shipdate) AS nth
    FROM checked WHERE failed_rules = ''),
loaded AS (SELECT * FROM ranked WHERE nth = 1)
"""

SQL: dict[str, str] = {
    "raw_payments": over("raw", f"SELECT {RAW_COLUMNS} FROM raw"),
    "raw_payments_union_all": over("raw", f"SELECT {RAW_COLUMNS} FROM raw"),
    "csv_roundtrip": over("raw", f"SELECT {RAW_COLUMNS} FROM raw"),
    "csv_quoted_records": over(
        "raw",
        f"""SELECT {RAW_COLUMNS} FROM (SELECT * REPLACE (
              CASE WHEN CAST(substr(txn_id, 2, 8) AS BIGINT) % 5 = 1
                   THEN device_id || chr(10) || 'old, "spare"' || chr(10) ELSE device_id END AS device_id,
              CASE WHEN CAST(substr(txn_id, 2, 8) AS BIGINT) % 7 = 2
                   THEN '"' || chr(10) || chr(10) || merchant_id ELSE merchant_id END AS merchant_id) FROM raw)""",
    ),
    "csv_inferred_counts": over("raw", "SELECT count(*) AS bronze_txns FROM raw"),
    "bronze_row_hash": over(
        "raw", f"SELECT *, sha256(concat_ws('||', {RAW_COLUMNS})) AS _row_hash FROM raw"
    ),
    "bronze_accounts": over(
        "accounts",
        """SELECT *, sha256(concat_ws('||', account_id, bank, home_city, primary_device,
                                      secondary_device)) AS _row_hash
           FROM accounts""",
    ),
    "bronze_ingest_meta": over(
        "raw",
        """SELECT count(*) AS bronze_txns, count(*) AS rows_with_source_file,
                  CAST(1 AS BIGINT) AS ingest_times, count(*) AS rows_with_fingerprint,
                  CAST(0 AS BIGINT) AS malformed_lines
           FROM raw""",
    ),
    "lake_build": over("gold", f"SELECT {GOLD_COLUMNS} FROM gold"),
    "lake_overwrite": over("merchant_gold", f"SELECT {MERCHANT_COLUMNS} FROM merchant_gold"),
    "lake_masked_rejects": over("rejects", f"SELECT * REPLACE ({MASKED} AS account_id) FROM rejects"),
    "lake_published_rejects": over("rejects", f"SELECT * REPLACE ({MASKED} AS account_id) FROM rejects"),
    "lake_published_ops": over("rejects", "SELECT * FROM rejects"),
    "dedup_exact": over("deduped", f"SELECT {RAW_COLUMNS} FROM deduped"),
    "dedup_row_number": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
                     l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST,
                     l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST
        ) = 1""",
    "typed_parse": over(
        "raw",
        """SELECT txn_id, amount, txn_ts,
                  CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount_cast,
                  TRY_CAST(txn_ts AS TIMESTAMP) AS txn_ts_cast
           FROM raw""",
    ),
    "rejects_cascade": over("rejects", "SELECT * FROM rejects"),
    "union_by_name": over(
        "silver rejects",
        """SELECT txn_id, account_id, merchant_id, merchant_category, txn_ts, device_id, status,
                  CAST(amount AS DOUBLE) AS amount, account_day
           FROM silver
           UNION ALL BY NAME
           SELECT txn_id, account_id, merchant_id, txn_ts AS raw_txn_ts, reject_reason FROM rejects""",
    ),
    "rejects_by_reason": over(
        "rejects", "SELECT reject_reason, count(*) AS rows FROM rejects GROUP BY reject_reason"
    ),
    "silver_clean": over(
        "silver",
        """SELECT txn_id, account_id, merchant_id, merchant_category, txn_ts, device_id, status,
                  CAST(amount AS DOUBLE) AS amount, account_day
           FROM silver""",
    ),
    "referential_rejects": over(
        "parsed",
        f"""SELECT * FROM (
              SELECT txn_id, account_id, merchant_id, txn_ts,
                     CASE WHEN amount_cast IS NULL THEN 'unparseable_amount'
                          WHEN NOT EXISTS (SELECT 1 FROM customer
                                           WHERE c_custkey % 13 <> 4
                                             AND printf('ACC%08d', c_custkey) = parsed.account_id)
                          THEN 'unknown_account'
                          WHEN NOT {IN_PERIOD} THEN 'timestamp_out_of_range'
                     END AS reject_reason
              FROM parsed)
            WHERE reject_reason IS NOT NULL""",
    ),
    "referential_rejects_reduced": over(
        "parsed",
        f"""SELECT * FROM (
              SELECT txn_id, account_id, merchant_id, txn_ts,
                     CASE WHEN amount_cast IS NULL THEN 'unparseable_amount'
                          WHEN NOT EXISTS (SELECT 1 FROM customer
                                           WHERE c_custkey % 13 <> 4
                                             AND printf('ACC%08d', c_custkey) = parsed.account_id)
                          THEN 'unknown_account'
                          WHEN NOT {IN_PERIOD} THEN 'timestamp_out_of_range'
                     END AS reject_reason
              FROM parsed)
            WHERE reject_reason IS NOT NULL""",
    ),
    "unlabelled_documents": """
        SELECT doc_id, lang, source, false AS labelled FROM documents
        WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""",
    "silver_reconciliation": over(
        "raw silver rejects",
        f"""SELECT *, bronze_rows - duplicate_rows - reject_rows = clean_rows
                     AND raw_checksum = kept_checksum AS balanced
           FROM (SELECT (SELECT count(*) FROM raw) AS bronze_rows,
                        {DISTINCT_PAYMENTS} AS distinct_payments,
                        (SELECT count(*) FROM raw) - {DISTINCT_PAYMENTS} AS duplicate_rows,
                        (SELECT {CHECKSUM} FROM (SELECT DISTINCT {IDENTITY} AS identity FROM raw)) AS raw_checksum,
                        (SELECT {CHECKSUM} FROM (SELECT txn_id AS identity FROM silver
                                                 UNION ALL SELECT {IDENTITY} FROM rejects)) AS kept_checksum,
                        (SELECT count(*) FROM silver) AS clean_rows,
                        count(*) AS reject_rows,
                        count(*) FILTER (reject_reason = 'malformed_line') AS malformed_line_rows,
                        count(*) FILTER (reject_reason = 'unparseable_amount')
                            AS unparseable_amount_rows,
                        count(*) FILTER (reject_reason = 'unknown_account')
                            AS unknown_account_rows,
                        count(*) FILTER (reject_reason = 'timestamp_out_of_range')
                            AS out_of_range_rows,
                        count(*) FILTER (reject_reason = 'missing_txn_id') AS missing_id_rows
                 FROM rejects)""",
    ),
    "duplicate_counts": over(
        "raw",
        f"""SELECT count(*) AS bronze_rows, {DISTINCT_PAYMENTS} AS distinct_payments,
                  count(*) - {DISTINCT_PAYMENTS} AS duplicate_rows
           FROM raw""",
    ),
    "account_daily_agg": over(
        "daily",
        """SELECT account_id, account_day, txns, cents / 100 AS max_amount, distinct_devices
           FROM daily""",
    ),
    "trailing_baseline": over(
        "gold",
        """SELECT account_id, account_day, max_amount, avg_amount_30d_trailing, prior_txn_count
           FROM gold""",
    ),
    "account_day_gold": over("gold", f"SELECT {GOLD_COLUMNS} FROM gold"),
    "gold_late_days": over("gold", f"SELECT {GOLD_COLUMNS} FROM gold"),
    "merchant_hour_gold": over("merchant_gold", f"SELECT {MERCHANT_COLUMNS} FROM merchant_gold"),
    "supplier_day_baseline": """
        WITH daily AS (
            SELECT l_suppkey AS supplier_id, CAST(l_shipdate AS DATE) AS ship_day,
                   count(*) AS txns, max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents,
                   count(DISTINCT l_partkey) AS distinct_parts
            FROM lineitem GROUP BY 1, 2),
        baseline AS (
            SELECT *, CAST(sum(cents) OVER prior AS BIGINT) AS prior_cents,
                   count(cents) OVER prior AS prior_txn_count
            FROM daily
            WINDOW prior AS (PARTITION BY supplier_id ORDER BY ship_day
                             ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
        SELECT supplier_id, ship_day, txns, cents / 100 AS max_amount, distinct_parts,
               round(prior_cents / (100 * nullif(prior_txn_count, 0)), 6) AS avg_amount_30d_trailing,
               prior_txn_count,
               coalesce(prior_txn_count >= 5 AND cents * prior_txn_count >= 5 * prior_cents, false)
                   AS is_amount_spike,
               distinct_parts >= 3 AS is_device_burst
        FROM baseline""",
    "q_spend_spikes": over("gold", SPIKES.format(account="account_id")),
    "q_spend_spikes_analyst": over("gold", SPIKES.format(account=MASKED)),
    "q_spend_spikes_stored": over(
        "stored",
        """SELECT account_id, account_day, max_amount, baseline_cents / 100 AS baseline_30d,
                  round(cents / nullif(baseline_cents, 0), 2) AS spike_multiplier, prior_txn_count
           FROM stored WHERE prior_txn_count >= 5 AND cents >= 5 * baseline_cents""",
    ),
    "q_device_bursts": over(
        "gold",
        """SELECT account_id, account_day, distinct_devices, txns AS total_daily_txns
           FROM gold WHERE is_device_burst""",
    ),
    "q_offhour_failure": over(
        "merchant_gold",
        OFF_HOURS.format(
            risk="TARGET_HIGH_RISK_GROUP", other="STANDARD_MERCHANTS", night="LATE_NIGHT_OFF_HOURS"
        ),
    ),
    "q_offhour_failure_audit": over(
        "merchant_gold",
        OFF_HOURS.format(
            risk="TARGET_GROUP (MER0000-MER0009)",
            other="OTHER_MERCHANTS",
            night="LATE_NIGHT (23,0,1)",
        ),
    ),
    "hourly_failure_curve": over(
        "merchant_gold",
        """SELECT CAST(hour_of_day AS INTEGER) AS hour_of_day,
                  round(avg(failure_rate) FILTER (merchant_id BETWEEN 'MER0000' AND 'MER0009') * 100, 6)
                      AS target_grp,
                  round(avg(failure_rate)
                        FILTER (NOT merchant_id BETWEEN 'MER0000' AND 'MER0009') * 100, 6)
                      AS normal_grp
           FROM merchant_gold GROUP BY 1""",
    ),
    "masked_accounts_analyst": over(
        "gold", f"SELECT * REPLACE ({MASKED} AS account_id) FROM (SELECT {GOLD_COLUMNS} FROM gold)"
    ),
    "masked_accounts_ops": over("gold", f"SELECT {GOLD_COLUMNS} FROM gold"),
    "masked_rejects": over("rejects", f"SELECT * REPLACE ({MASKED} AS account_id) FROM rejects"),
    "warehouse_conform": over(
        "stored",
        """SELECT account_id, account_day, txns, max_amount,
                  baseline_cents / 100 AS avg_amount_30d_trailing, prior_txn_count, distinct_devices,
                  is_amount_spike, is_device_burst
           FROM stored""",
    ),
    "warehouse_conform_merchant_hour": over(
        "merchant_gold",
        """SELECT merchant_id, CAST(hour_of_day AS INTEGER) AS hour_of_day,
                  txns, failed_txns, failure_rate
           FROM merchant_gold""",
    ),
    "warehouse_conform_rejects": over("rejects", "SELECT *, true AS has_rejected_at FROM rejects"),
    "constraint_audit": over(
        "stored merchant_gold rejects",
        " UNION ALL ".join(
            [
                audit(
                    "gold_account_day",
                    "stored",
                    "account_id, account_day",
                    "account_id account_day txns max_amount distinct_devices is_amount_spike is_device_burst",
                    {"account_id": 32},
                ),
                audit(
                    "gold_merchant_hour",
                    "merchant_gold",
                    "merchant_id, hour_of_day",
                    "merchant_id hour_of_day txns failed_txns failure_rate",
                    {"merchant_id": 32},
                ),
                audit(
                    "silver_rejects",
                    "rejects",
                    "",
                    "",
                    {"txn_id": 32, "account_id": 32, "merchant_id": 32, "txn_ts": 64, "reject_reason": 64},
                ),
            ]
        ),
    ),
    "warehouse_load": f"{LOADED} SELECT {LINE_FIELDS} FROM loaded",
    "warehouse_load_rejects": f"""{LOADED} SELECT {LINE_TEXTS}, failed_rules FROM checked WHERE failed_rules <> ''
        UNION ALL SELECT {LINE_TEXTS}, 'key:l_orderkey,l_linenumber' FROM ranked WHERE nth > 1""",
    "warehouse_load_audit": LOADED
    + audit(
        "lineitem",
        "loaded",
        "l_orderkey, l_linenumber",
        "l_orderkey l_linenumber l_partkey l_suppkey l_returnflag l_shipdate",
        {"l_returnflag": 1},
    ),
    "order_line_key_audit": audit(
        "lineitem",
        "lineitem",
        "l_orderkey, l_linenumber",
        "l_orderkey l_linenumber l_partkey l_suppkey l_returnflag l_shipdate",
        {"l_returnflag": 1},
    ),
    "layer_metrics": over(
        "accounts raw classified gold merchant_gold",
        """SELECT (SELECT count(*) FROM accounts) AS bronze_accounts,
                  (SELECT count(*) FROM raw) AS bronze_txns,
                  count(*) AS deduped_txns,
                  count(*) FILTER (reject_reason IS NOT NULL) AS silver_rejects,
                  count(*) FILTER (reject_reason IS NULL) AS silver_txns,
                  (SELECT count(*) FROM gold) AS account_days,
                  (SELECT count(*) FROM gold WHERE is_device_burst) AS device_bursts,
                  (SELECT count(*) FROM gold WHERE is_amount_spike) AS amount_spikes,
                  (SELECT count(*) FROM merchant_gold) AS merchant_hours,
                  (SELECT count(*) FROM raw) - count(*) AS duplicates
           FROM classified""",
    ),
    "scalar_math": """
        SELECT l_orderkey, l_linenumber,
               (200 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(round(l_quantity * 100) AS BIGINT))
                   // (2 * CAST(round(l_quantity * 100) AS BIGINT)) / 100 AS unit_price,
               round(l_extendedprice * l_discount, 4) AS discount_value,
               round(l_extendedprice - l_quantity * 5, 2) AS price_minus,
               l_orderkey % 45 AS bucket,
               CAST(l_quantity / 3 AS INTEGER) AS rounded_third,
               round(exp(6.2 + sin(l_orderkey) * 0.5), 2) AS wave,
               abs(l_partkey - l_suppkey) AS key_distance
        FROM lineitem""",
    "scalar_format": """
        SELECT o_orderkey, printf('T%08d', o_orderkey) AS txn_id,
               printf('DEV9%06d', o_custkey) AS device_id,
               printf('%s %02d:%02d:00',
                      strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER), '%Y-%m-%d'),
                      o_orderkey % 24, o_orderkey % 60) AS shifted_ts
        FROM orders""",
    "portable_hash_bucket": """
        SELECT c_custkey, CAST('0x' || substr(md5(c_name), 1, 8) AS BIGINT) % 100 AS bucket
        FROM customer""",
}
