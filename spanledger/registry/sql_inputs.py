"""SQL form of the derived inputs and of the mart steps, written naively (correlated subqueries, whole-table
windows) so that it checks the DataFrame forms independently."""

from __future__ import annotations

from spanledger.registry.base import CTES

CTES["fx_contact"] = """
SELECT user_id AS counterparty_rk,
       CASE event_type WHEN 'click' THEN 'NotificPhone' WHEN 'view' THEN 'ATMPhone'
            WHEN 'signup' THEN 'MobilePersonalPhone' WHEN 'purchase' THEN 'MobileWorkNumber'
            WHEN 'error' THEN 'HomePhone' END AS contact_type_cd,
       '+7-' || CAST(user_id - user_id % 2 AS VARCHAR) || '-' || CAST(event_id % 4 AS VARCHAR) AS contact_desc,
       CASE WHEN event_id % 3 = 0 THEN 'GOOD_1' ELSE 'BAD' END AS contact_quality_code,
       value > 20 AS trust_system_flg,
       CASE event_id % 6 WHEN 0 THEN 'MDMP' WHEN 1 THEN 'WAYN' WHEN 2 THEN 'RTLL' WHEN 3 THEN 'RTLS'
            WHEN 4 THEN 'CFTB' ELSE 'OTHR' END AS src_cd,
       CAST(ts AS DATE) AS effective_from_date,
       CAST(ts AS DATE) + CAST(event_id % 20 + 1 AS INTEGER) AS effective_to_date
FROM events"""

CTES["fx_counterparty"] = """
SELECT DISTINCT user_id AS counterparty_rk, CASE WHEN user_id % 5 = 0 THEN '0' ELSE '1' END AS counterparty_type_cd,
       'MDMP' AS src_cd, DATE '2023-12-01' AS effective_from_date, DATE '2999-12-31' AS effective_to_date
FROM events"""

CTES["fx_type"] = """
SELECT * FROM (VALUES
  ('0', 'юридическое лицо', 'MDMP', DATE '1900-01-01', DATE '2999-12-31'),
  ('1', 'физическое лицо', 'MDMP', DATE '1900-01-01', DATE '2999-12-31')
) v(counterparty_type_cd, counterparty_type_desc, src_cd, effective_from_date, effective_to_date)"""

CTES["fx_xref"] = """
SELECT DISTINCT user_id AS counterparty_rk, user_id - user_id % 3 AS uniq_counterparty_rk, 'RTLL' AS src_cd,
       DATE '1900-01-01' AS effective_from_date, DATE '2999-12-31' AS effective_to_date
FROM events"""

CTES["fx_phone"] = """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -1 ELSE user_id - user_id % 3 END
         AS mdm_customer_rk,
       event_type AS phone_type_cd,
       CASE WHEN event_id % 101 = 0 THEN CAST(ts AS DATE) + CAST(event_id % 20 AS INTEGER) ELSE CAST(ts AS DATE) END
         AS business_start_dt,
       CASE WHEN event_id % 101 = 0 THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) + CAST(event_id % 20 AS INTEGER) END
         AS business_end_dt,
       '+7-' || CAST(user_id - user_id % 2 AS VARCHAR) || '-' || CAST(event_id % 4 AS VARCHAR) AS phone_num,
       event_id % 7 = 0 AS notification_flg, event_type = 'view' AS atm_flg, value > 20 AS trust_system_flg,
       event_id % 5 = 0 AS duplication_flg, event_id % 3 = 0 AS main_dup_flg, event_id % 4 = 0 AS main_phone_flg
FROM events"""

CTES["fx_feed"] = """
SELECT user_id AS id,
       CASE WHEN rn = 1 AND user_id % 10 = 1 THEN 'paused' WHEN rn = 1 THEN 'accepted'
            ELSE CASE event_type WHEN 'click' THEN 'executed' WHEN 'view' THEN 'paused' WHEN 'signup' THEN 'complited'
                 WHEN 'purchase' THEN 'canselled' ELSE CASE WHEN event_id % 2 = 0 THEN 'complited' ELSE 'paused' END END
       END AS status_nm,
       first_ts AS create_dttm, ts AS update_dttm,
       CASE WHEN rn = 1 THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS operation,
       ts AS stamp
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
             min(ts) OVER (PARTITION BY user_id) AS first_ts FROM events) e
WHERE NOT (rn = 1 AND user_id % 10 = 2)"""

CTES["fx_source"] = """
SELECT id, status_nm, create_dttm, update_dttm
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY stamp DESC) AS rn FROM fx_feed) f
WHERE rn = 1 AND operation <> 'D'"""

CTES["fx_old_snapshot"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"""

CTES["fx_new_snapshot"] = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 7 = 0 THEN 'X' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"""

CTES["fx_account"] = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN '408' ELSE '452' END || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')
         || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS account_rk,
       c_custkey AS counterparty_rk, CAST(NULL AS VARCHAR) AS account_descr, '810' AS account_currency_cd
FROM customer"""

CTES["fx_plan"] = """
SELECT cd AS account_plan_cd, 'plan ' || cd AS account_plan_name
FROM (SELECT substring(account_rk, 1, 3) AS cd FROM fx_account WHERE account_rk LIKE '408%'
      UNION SELECT substring(account_rk, 1, 5) FROM fx_account WHERE substring(account_rk, 4, 2) < '50') p"""

CTES["fx_days"] = """
SELECT CAST(d AS DATE) AS date_actual
FROM (SELECT unnest(generate_series(date_trunc('year', min(ts)),
                                    date_trunc('year', max(ts)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                    INTERVAL 1 DAY)) AS d FROM events) s"""

CTES["fx_log"] = """
SELECT event_id AS id, CAST(event_id % 4 AS INTEGER) AS category,
       CASE event_id % 3 WHEN 0 THEN 'oltp_src_system.mod_' || event_type WHEN 1 THEN 'oltp_src_system.modx' || event_type
            ELSE 'dwh_stage.' || event_type END AS source,
       '' AS destination, '' AS message,
       CASE WHEN event_id % 2 = 0 THEN 'insert' ELSE 'start' END AS type_operation,
       event_id % 5 AS count_row, ts AS stamp
FROM events"""

# --- phone mart ----------------------------------------------------------------------------------------------------

CTES["customers"] = """
SELECT c.counterparty_rk, greatest(c.effective_from_date, t.effective_from_date) AS effective_from_date,
       least(c.effective_to_date, t.effective_to_date) AS effective_to_date, c.counterparty_type_cd
FROM fx_counterparty c LEFT JOIN fx_type t ON c.counterparty_type_cd = t.counterparty_type_cd
WHERE c.src_cd = 'MDMP' AND t.src_cd IN ('MDMP', 'RTLL', 'RTLS', 'CFTB', 'WAYN')
  AND t.counterparty_type_desc = 'физическое лицо'
  AND greatest(c.effective_from_date, t.effective_from_date) <= least(c.effective_to_date, t.effective_to_date)"""

CTES["resolved"] = """
SELECT a.counterparty_rk, a.contact_type_cd, greatest(a.effective_from_date, x.effective_from_date) AS effective_from_date,
       least(a.effective_to_date, x.effective_to_date) AS effective_to_date, a.contact_desc, a.contact_quality_code,
       a.trust_system_flg, x.uniq_counterparty_rk, a.src_cd
FROM fx_contact a JOIN fx_xref x ON a.counterparty_rk = x.counterparty_rk
WHERE x.src_cd IN ('MDMP', 'RTLL', 'RTLS', 'CFTB', 'WAYN') AND a.src_cd <> 'MDMP'
  AND greatest(a.effective_from_date, x.effective_from_date) <= least(a.effective_to_date, x.effective_to_date)
UNION
SELECT counterparty_rk, contact_type_cd, effective_from_date, effective_to_date, contact_desc, contact_quality_code,
       trust_system_flg, counterparty_rk, src_cd
FROM fx_contact WHERE src_cd = 'MDMP'"""

CTES["person_contacts"] = """
SELECT r.counterparty_rk, r.contact_type_cd, greatest(r.effective_from_date, p.effective_from_date) AS effective_from_date,
       least(r.effective_to_date, p.effective_to_date) AS effective_to_date, r.contact_desc, r.contact_quality_code,
       r.trust_system_flg, r.uniq_counterparty_rk, r.src_cd
FROM resolved r JOIN customers p ON r.uniq_counterparty_rk = p.counterparty_rk
WHERE greatest(r.effective_from_date, p.effective_from_date) <= least(r.effective_to_date, p.effective_to_date)"""

CTES["digested"] = """
SELECT *, md5(concat_ws('|', CAST(counterparty_rk AS VARCHAR), contact_type_cd, CAST(effective_from_date AS VARCHAR),
                        CAST(effective_to_date AS VARCHAR), contact_desc, contact_quality_code,
                        CAST(trust_system_flg AS VARCHAR), CAST(uniq_counterparty_rk AS VARCHAR), src_cd)) AS tie
FROM person_contacts WHERE src_cd IN ('MDMP', 'RTLL', 'RTLS', 'CFTB', 'WAYN')"""

CTES["ranked_contacts"] = """
SELECT uniq_counterparty_rk AS mdm_customer_rk, contact_type_cd AS phone_type_cd,
       effective_from_date AS business_start_dt, effective_to_date AS business_end_dt, contact_desc AS phone_num,
       trust_system_flg, contact_type_cd = 'NotificPhone' AS notification_flg, contact_type_cd = 'ATMPhone' AS atm_flg,
       row_number() OVER (PARTITION BY contact_desc ORDER BY effective_from_date, tie) AS rang_start_phone_num,
       row_number() OVER (PARTITION BY counterparty_rk ORDER BY effective_from_date, tie) AS rang_start_client_num,
       CASE WHEN trust_system_flg THEN 1 ELSE 0 END AS range_trust_num,
       CASE WHEN contact_quality_code LIKE '%GOOD%' THEN 1 ELSE 0 END AS range_quality_num,
       CASE src_cd WHEN 'MDMP' THEN 5 WHEN 'WAYN' THEN 4 WHEN 'RTLL' THEN 3 WHEN 'RTLS' THEN 2 WHEN 'CFTB' THEN 1 END
         AS range_src_num,
       CASE contact_type_cd WHEN 'NotificPhone' THEN 5 WHEN 'ATMPhone' THEN 4 WHEN 'MobilePersonalPhone' THEN 3
            WHEN 'MobileWorkNumber' THEN 2 WHEN 'HomePhone' THEN 1 END AS range_type_num
FROM digested"""


def fragments_sql(source: str, key: str) -> str:
    return f"""
SELECT t.* REPLACE (s.seg_start AS business_start_dt, s.seg_end AS business_end_dt)
FROM (SELECT {key} AS k, pt AS seg_start, lead(pt) OVER (PARTITION BY {key} ORDER BY pt) AS seg_end
      FROM (SELECT {key}, business_start_dt AS pt FROM {source} UNION SELECT {key}, business_end_dt FROM {source}) p) s
LEFT JOIN {source} t ON s.k = t.{key}
  AND greatest(t.business_start_dt, s.seg_start) < least(t.business_end_dt, s.seg_end)
WHERE s.seg_end IS NOT NULL AND t.mdm_customer_rk IS NOT NULL"""


def weight_sql(free: str, rank: str) -> str:
    return (
        f"{free} * CAST(100000000 AS BIGINT) + range_trust_num * 10000000 + range_quality_num * 1000000 "
        f"+ range_src_num * 100000 + range_type_num * 10000 + {rank}"
    )


CTES["phone_pieces"] = fragments_sql("ranked_contacts", "phone_num")
CTES["shared_pieces"] = """
SELECT DISTINCT a.phone_num, a.business_start_dt, a.business_end_dt
FROM phone_pieces a JOIN ranked_contacts b ON a.phone_num = b.phone_num AND a.mdm_customer_rk <> b.mdm_customer_rk
  AND greatest(a.business_start_dt, b.business_start_dt) < least(a.business_end_dt, b.business_end_dt)"""
CTES["weighed_pieces"] = f"""
SELECT *, CASE WHEN duplication_flg THEN 0 ELSE 1 END AS range_duplication_num,
       {weight_sql("CASE WHEN duplication_flg THEN 0 ELSE 1 END", "rang_start_phone_num")} AS weght_phone_num
FROM (SELECT *, (phone_num, business_start_dt, business_end_dt) IN
               (SELECT (phone_num, business_start_dt, business_end_dt) FROM shared_pieces) AS duplication_flg
      FROM phone_pieces) d"""
CTES["flagged_pieces"] = """
SELECT a.*, coalesce(weght_phone_num = (SELECT max(b.weght_phone_num) FROM weighed_pieces b
                                        WHERE a.phone_num = b.phone_num
                                          AND greatest(a.business_start_dt, b.business_start_dt)
                                            < least(a.business_end_dt, b.business_end_dt)), FALSE) AS main_dup_flg
FROM weighed_pieces a"""

PHONE_KEYS = (
    "mdm_customer_rk, phone_type_cd, phone_num, notification_flg, atm_flg, trust_system_flg, rang_start_phone_num, "
    "rang_start_client_num, range_trust_num, range_quality_num, range_src_num, range_type_num, duplication_flg, "
    "range_duplication_num, weght_phone_num, main_dup_flg"
)
MART_KEYS = (
    "mdm_customer_rk, phone_type_cd, phone_num, notification_flg, atm_flg, trust_system_flg, duplication_flg, "
    "main_dup_flg, main_phone_flg"
)


def islands_sql(source: str, keys: str, start: str, end: str, partition: str = "") -> str:
    """Islands by row order: a row opens one if nothing before it reaches its start. Then grouped by ``keys``."""
    by = f"PARTITION BY {partition} " if partition else ""
    rows = f"({by}ORDER BY {start}, {end}, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND"
    return f"""
SELECT {keys}, min({start}) AS {start}, max({end}) AS {end}
FROM (SELECT *, count(*) FILTER (WHERE reach IS NULL OR reach < {start}) OVER {rows} CURRENT ROW) AS island
      FROM (SELECT *, max({end}) OVER {rows} 1 PRECEDING) AS reach FROM {source}) r) i
GROUP BY island, {keys}"""


CTES["merged_phones"] = islands_sql("flagged_pieces", PHONE_KEYS, "business_start_dt", "business_end_dt")
CTES["client_pieces"] = f"""
SELECT *, {weight_sql("range_duplication_num", "rang_start_client_num")} AS weght_client_num
FROM ({fragments_sql("merged_phones", "mdm_customer_rk")}) c"""
CTES["flagged_clients"] = """
SELECT a.*, coalesce(weght_client_num = (SELECT max(b.weght_client_num) FROM client_pieces b
                                         WHERE a.mdm_customer_rk = b.mdm_customer_rk
                                           AND greatest(a.business_start_dt, b.business_start_dt)
                                             < least(a.business_end_dt, b.business_end_dt)), FALSE) AS main_phone_flg
FROM client_pieces a"""
CTES["mart_phones"] = "SELECT DISTINCT * FROM (" + islands_sql(
    "flagged_clients", MART_KEYS, "business_start_dt", "business_end_dt"
) + ") m"

# --- request warehouse ---------------------------------------------------------------------------------------------

CTES["keyed_feed"] = """
SELECT *, sha256(CAST(id AS VARCHAR) || trim(
         CASE date_diff('day', DATE '1900-01-01', CAST(c AS DATE)) WHEN 0 THEN '' WHEN 1 THEN '1 day'
              ELSE CAST(date_diff('day', DATE '1900-01-01', CAST(c AS DATE)) AS VARCHAR) || ' days' END
         || CASE WHEN CAST(c AS TIME) = TIME '00:00:00' AND CAST(c AS DATE) <> DATE '1900-01-01' THEN ''
                 ELSE ' ' || CAST(CAST(c AS TIME) AS VARCHAR) END)) AS hash_key
FROM (SELECT *, coalesce(create_dttm, TIMESTAMP '1901-01-01 00:00:00') AS c FROM fx_feed) f"""

OPEN = "TIMESTAMP '2999-12-31 23:59:59'"
VERSION_KEYS = "id, status_nm, create_dttm, hash_key, deleted_flg, deleted_dttm"
HISTORY_COLUMNS = (
    "id, status_nm, create_dttm, hash_key, valid_from_dttm, valid_to_dttm, deleted_flg, deleted_dttm"
)


def load_ctes(prefix: str, batch: str, before: str) -> None:
    """CTEs of one history load: new, changes, all versions, closed, merged."""
    CTES[f"{prefix}_batch"] = batch
    CTES[f"{prefix}_before"] = before
    CTES[f"{prefix}_new"] = f"""
SELECT id, status_nm, create_dttm, hash_key, stamp AS valid_from_dttm, {OPEN} AS valid_to_dttm, FALSE AS deleted_flg,
       CAST(NULL AS TIMESTAMP) AS deleted_dttm
FROM {prefix}_batch WHERE operation = 'I' AND status_nm = 'accepted'
  AND hash_key NOT IN (SELECT hash_key FROM {prefix}_before)"""
    CTES[f"{prefix}_known"] = f"""
SELECT {HISTORY_COLUMNS} FROM {prefix}_before UNION ALL SELECT {HISTORY_COLUMNS} FROM {prefix}_new"""
    CTES[f"{prefix}_changes"] = f"""
SELECT id, CASE WHEN operation = 'D' THEN NULL ELSE status_nm END AS status_nm, create_dttm, hash_key,
       stamp AS valid_from_dttm, {OPEN} AS valid_to_dttm, operation = 'D' AS deleted_flg,
       CASE WHEN operation = 'D' THEN stamp END AS deleted_dttm
FROM {prefix}_batch WHERE operation IN ('U', 'D') AND hash_key IN (SELECT hash_key FROM {prefix}_known)"""
    CTES[f"{prefix}_versions"] = f"""
SELECT {HISTORY_COLUMNS} FROM {prefix}_known UNION ALL SELECT {HISTORY_COLUMNS} FROM {prefix}_changes"""
    CTES[f"{prefix}_closed"] = f"""
SELECT * REPLACE (CASE WHEN valid_to_dttm = {OPEN} THEN lead(valid_from_dttm, 1, {OPEN})
                    OVER (PARTITION BY hash_key ORDER BY valid_from_dttm) ELSE valid_to_dttm END AS valid_to_dttm)
FROM {prefix}_versions"""
    CTES[f"{prefix}_history"] = islands_sql(
        f"{prefix}_closed", VERSION_KEYS, "valid_from_dttm", "valid_to_dttm", VERSION_KEYS
    )


load_ctes("once", "SELECT * FROM keyed_feed", f"SELECT *, {OPEN} AS valid_to_dttm, stamp AS valid_from_dttm, "
          "FALSE AS deleted_flg, stamp AS deleted_dttm FROM keyed_feed WHERE FALSE")
load_ctes(
    "part1",
    "SELECT * FROM keyed_feed WHERE stamp < TIMESTAMP '2024-01-16'",
    f"SELECT *, {OPEN} AS valid_to_dttm, stamp AS valid_from_dttm, FALSE AS deleted_flg, stamp AS deleted_dttm "
    "FROM keyed_feed WHERE FALSE",
)
load_ctes(
    "part2", "SELECT * FROM keyed_feed WHERE stamp >= TIMESTAMP '2024-01-16'", "SELECT * FROM part1_history"
)

CTES["day_history"] = """
SELECT id, status_nm, CAST(create_dttm AS DATE) AS create_dttm, hash_key, CAST(valid_from_dttm AS DATE) AS valid_from_dttm,
       CAST(valid_to_dttm AS DATE) AS valid_to_dttm, deleted_flg, CAST(deleted_dttm AS DATE) AS deleted_dttm
FROM once_history"""

CTES["calendar"] = """
SELECT CAST(date_part('year', date_actual) * 10000 + date_part('month', date_actual) * 100
            + date_part('day', date_actual) AS INTEGER) AS date_key,
       date_actual, CAST(date_part('year', date_actual) AS INTEGER) AS "year",
       CAST(date_part('quarter', date_actual) AS INTEGER) AS "quarter",
       CAST(date_part('month', date_actual) AS INTEGER) AS "month",
       CAST(date_part('week', date_actual) AS INTEGER) AS "week",
       CAST(date_part('day', date_actual) AS INTEGER) AS day_of_month,
       CAST(date_part('isodow', date_actual) AS INTEGER) AS day_of_week,
       date_part('isodow', date_actual) IN (6, 7) OR date_actual IN (DATE '2024-04-29', DATE '2024-04-30') AS is_weekday,
       date_actual IN (DATE '2024-01-01', DATE '2024-02-23', DATE '2024-05-09') AS is_holiday,
       CAST(date_part('year', date_actual) AS INTEGER) AS fiscal_year
FROM fx_days"""


def _begun(measure: str, status: str) -> str:
    return (
        f"LEFT JOIN (SELECT valid_from_dttm AS d, count(hash_key) AS n FROM day_history WHERE status_nm = '{status}' "
        f"GROUP BY 1) {measure} ON c.date_actual = {measure}.d"
    )


def _lasting(measure: str, status: str) -> str:
    return (
        f"LEFT JOIN (SELECT dd.date_actual AS d, count(h.hash_key) AS n FROM calendar dd, day_history h "
        f"WHERE h.status_nm = '{status}' AND h.valid_from_dttm <= dd.date_actual AND dd.date_actual <= h.valid_to_dttm "
        f"GROUP BY 1) {measure} ON c.date_actual = {measure}.d"
    )


CTES["work"] = f"""
SELECT c.*, coalesce(m1.n, 0) AS complited_per_day, coalesce(m2.n, 0) AS canselled_per_day,
       coalesce(m3.n, 0) AS accepted_per_day, coalesce(m4.n, 0) AS paused_per_day, coalesce(m5.n, 0) AS deleted_per_day,
       coalesce(m6.n, 0) AS executed_during_day, coalesce(m7.n, 0) AS paused_during_day
FROM calendar c
{_begun("m1", "complited")}
{_begun("m2", "canselled")}
{_begun("m3", "accepted")}
{_begun("m4", "paused")}
LEFT JOIN (SELECT deleted_dttm AS d, count(hash_key) AS n FROM day_history WHERE deleted_flg GROUP BY 1) m5
  ON c.date_actual = m5.d
{_lasting("m6", "executed")}
{_lasting("m7", "paused")}"""

# the same after two loads
CTES["day_history_2"] = CTES["day_history"].replace("once_history", "part2_history")
CTES["work_2"] = CTES["work"].replace("day_history", "day_history_2")

CTES["recovered"] = f"""
SELECT id, status_nm, create_dttm, valid_from_dttm AS update_dttm FROM once_history
WHERE NOT deleted_flg AND valid_to_dttm = {OPEN}"""
