"""DuckDB SQL that states each registered query a second time, over the trade tables.

Written join-first, the way one would say it in SQL, so that it does not share the
grouping order or the helper code of the Spark plans.
"""

from __future__ import annotations


def _rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), {places}) AS DOUBLE)"


def _rate(flag: str, places: int = 2) -> str:
    """Share of set flags in percent."""
    return _rounded(f"CAST(sum({flag}) AS DOUBLE) / count(*) * 100", places)


def _avg(value: str, places: int = 2) -> str:
    return _rounded(f"CAST(sum({value}) AS DOUBLE) / count({value})", places)


def _frac(part: str, whole: str, places: int = 6) -> str:
    return _rounded(f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE)", places)


COUNT = "CAST(count(*) AS BIGINT)"


def _isum(value: str) -> str:
    return f"CAST(sum({value}) AS BIGINT)"


def _dsum(value: str) -> str:
    return f"CAST(sum({value}) AS DOUBLE)"


# The names, texts and rates in the SQL of the feeds are fixed values of the mapping.
FEEDS = """
raw_shipments AS (
  SELECT l.l_partkey AS partkey,
         concat_ws('-', 'SHP', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS shipment_id,
         'ORD-' || l_orderkey AS order_id,
         l_orderkey AS orderkey,
         l_suppkey AS supplier_id,
         c_nationkey AS destination_warehouse_id,
         'CAR-' || (1 + ((l_partkey % 8) + 8) % 8) AS carrier_id,
         o_orderdate AS order_date,
         CAST(1 + ((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 30) + 30) % 30
              AS INTEGER) AS transit_days,
         CAST(18 + ((l_partkey % 13) + 13) % 13 AS INTEGER) AS promised_transit_days,
         (l_returnflag = 'R' AND l_linestatus = 'O') AS returned_open,
         l_tax,
         CAST(l_quantity * 12.5 AS DECIMAL(10,2)) AS weight_kg,
         CAST(l_quantity AS INTEGER) AS quantity_units,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(12,2))
           AS freight_cost_usd,
         CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Transit'
              WHEN 'P' THEN 'Customs Processing' END AS shipment_status
  FROM lineitem l
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey),
fact AS (
  SELECT shipment_id, order_id, supplier_id, destination_warehouse_id, carrier_id, order_date,
         CAST(order_date AS DATE) + promised_transit_days AS promised_delivery_date,
         CAST(order_date AS DATE) + transit_days AS actual_delivery_date,
         transit_days, promised_transit_days,
         transit_days - promised_transit_days AS transit_delay_days,
         CASE WHEN transit_days <= promised_transit_days THEN 1 ELSE 0 END AS on_time_flag,
         CASE WHEN returned_open THEN 0 ELSE 1 END AS in_full_flag,
         CASE WHEN transit_days <= promised_transit_days AND NOT returned_open THEN 1 ELSE 0 END
           AS otif_compliance_flag,
         weight_kg, quantity_units, freight_cost_usd,
         CAST(round(CAST(freight_cost_usd / weight_kg AS DECIMAL(28,10)), 4) AS DECIMAL(10,4))
           AS freight_cost_per_kg,
         CASE WHEN returned_open AND l_tax > 0.055 THEN 1 ELSE 0 END AS damage_reported_flag,
         CASE WHEN transit_days <= promised_transit_days THEN 'None'
              ELSE CASE ((orderkey % 5) + 5) % 5
                     WHEN 0 THEN 'Weather Disruption' WHEN 1 THEN 'Customs Hold'
                     WHEN 2 THEN 'Carrier Breakdown' WHEN 3 THEN 'Port Congestion'
                     ELSE 'Documentation Error' END
         END AS delay_reason,
         shipment_status
  FROM raw_shipments),
register AS (
  SELECT carrier_id, carrier_name, transport_mode, CAST(target AS DECIMAL(5,2)) AS sla_target_pct,
         CASE WHEN target >= 97 THEN 'Tier-1 Premier' WHEN target >= 94 THEN 'Tier-2 Standard'
              ELSE 'Tier-3 Economy' END AS carrier_tier
  FROM (VALUES ('CAR-1', 'Altair Cargo', 'Air', 97.5), ('CAR-2', 'Blue Meridian', 'Air/Sea', 80.0),
               ('CAR-3', 'Castellan Lines', 'Sea', 75.0),
               ('CAR-4', 'Dromedary Express', 'Road/Air', 82.0),
               ('CAR-5', 'Eastgate Haulage', 'Road', 78.0),
               ('CAR-6', 'Fennel Rail', 'Rail/Road', 93.5),
               ('CAR-7', 'Grand Passage', 'Sea/Air', 95.0),
               ('CAR-8', 'Hollow Pine Trucking', 'Road', 94.0))
       AS v(carrier_id, carrier_name, transport_mode, target)),
carriers AS (
  SELECT r.carrier_id, r.carrier_name, r.transport_mode,
         CAST(round(CAST(CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) / 1000
                         AS DECIMAL(28,10)), 4) AS DECIMAL(10,4)) AS base_rate_per_kg,
         r.sla_target_pct, r.carrier_tier
  FROM part JOIN register r ON r.carrier_id = 'CAR-' || (1 + ((p_partkey % 8) + 8) % 8)
  GROUP BY ALL),
warehouses AS (
  SELECT n_nationkey AS warehouse_id, n_name || ' DC' AS name, n_name AS city, n_name AS country,
         r_name AS region, CAST(300000 + n_nationkey * 12500 AS BIGINT) AS capacity_sqft,
         CAST(9000 + n_nationkey * 275 AS DECIMAL(12,2)) AS daily_op_cost_usd,
         CAST(round(CAST((9000.0 + n_nationkey * 275) * 365 / (300000 + n_nationkey * 12500)
                         AS DECIMAL(28,10)), 2) AS DECIMAL(10,2)) AS cost_per_sqft
  FROM nation JOIN region ON n_regionkey = r_regionkey),
suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
         CASE s_suppkey % 6 WHEN 0 THEN 'Electronics Components' WHEN 1 THEN 'Raw Packaging'
              WHEN 2 THEN 'Precision Hydraulics' WHEN 3 THEN 'Automotive Parts'
              WHEN 4 THEN 'Industrial Sensors' ELSE 'Chemical Additives' END AS category,
         n_name AS country, CAST(3 + s_suppkey % 12 AS INTEGER) AS agreed_lead_days,
         CAST((380 + (s_suppkey % 13) * 10) / 100.0 AS DECIMAL(4,2)) AS reliability_rating,
         CAST(CASE s_suppkey % 4 WHEN 0 THEN 95 WHEN 1 THEN 96 WHEN 2 THEN 98 ELSE 99 END
              AS DECIMAL(5,2)) AS contract_sla_pct,
         CASE WHEN s_suppkey % 13 >= 7 THEN 'Low Risk' WHEN s_suppkey % 13 >= 2 THEN 'Medium Risk'
              ELSE 'High Risk' END AS risk_profile
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
telematics AS (
  SELECT event_id AS telematics_id, least(value, 120.0) AS speed_kmh,
         CASE WHEN value > 5 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE 0.0 END
           AS fuel_consumption_l_100km,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS maintenance_alert_flag
  FROM events),
calendar AS (
  SELECT CAST(d AS DATE) AS full_date, year(d) AS year_num, month(d) AS month_num
  FROM (SELECT unnest(generate_series(
          CAST(date_trunc('year', min(o_orderdate)) AS TIMESTAMP),
          CAST(date_trunc('year', max(o_orderdate) + INTERVAL 30 DAY) + INTERVAL 1 YEAR
               - INTERVAL 1 DAY AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM orders))
"""


def _sql(body: str, extra: str = "") -> str:
    return f"WITH {FEEDS.strip()}{', ' + extra.strip() if extra else ''}\n{body.strip()}"


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column.split('.')[-1]}"


FACT_OUTPUT = f"""shipment_id, order_id, supplier_id, destination_warehouse_id, carrier_id,
  strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date,
  {_iso('promised_delivery_date')}, {_iso('actual_delivery_date')},
  transit_days, promised_transit_days, transit_delay_days, on_time_flag, in_full_flag,
  otif_compliance_flag, CAST(weight_kg AS DOUBLE) AS weight_kg, quantity_units,
  CAST(freight_cost_usd AS DOUBLE) AS freight_cost_usd,
  CAST(freight_cost_per_kg AS DOUBLE) AS freight_cost_per_kg, damage_reported_flag,
  delay_reason, shipment_status"""

CARRIER_OUTPUT = """carrier_id, carrier_name, transport_mode,
  CAST(base_rate_per_kg AS DOUBLE) AS base_rate_per_kg,
  CAST(sla_target_pct AS DOUBLE) AS sla_target_pct, carrier_tier"""

WAREHOUSE_OUTPUT = """warehouse_id, name, city, country, region, capacity_sqft,
  CAST(daily_op_cost_usd AS DOUBLE) AS daily_op_cost_usd,
  CAST(cost_per_sqft AS DOUBLE) AS cost_per_sqft"""

SUPPLIER_OUTPUT = """supplier_id, supplier_name, category, country, agreed_lead_days,
  CAST(reliability_rating AS DOUBLE) AS reliability_rating,
  CAST(contract_sla_pct AS DOUBLE) AS contract_sla_pct, risk_profile"""

SCORECARD = f"""
scorecard AS (
  SELECT carrier_id, carrier_name, transport_mode, CAST(sla_target_pct AS DOUBLE) AS sla_target_pct,
         {COUNT} AS total_shipments, {_isum('on_time_flag')} AS on_time_shipments,
         {_isum('in_full_flag')} AS in_full_shipments,
         {_isum('otif_compliance_flag')} AS otif_shipments,
         {_avg('transit_days')} AS avg_transit_days, {_avg('transit_delay_days')} AS avg_delay_days,
         {_dsum('freight_cost_usd')} AS total_freight_spend_usd,
         {_rate('on_time_flag')} AS actual_on_time_pct,
         {_rate('otif_compliance_flag')} AS actual_otif_pct
  FROM fact JOIN register USING (carrier_id)
  GROUP BY carrier_id, carrier_name, transport_mode, sla_target_pct)
"""

RELIABILITY = f"""
reliability AS (
  SELECT supplier_id, supplier_name, category, country, agreed_lead_days,
         CAST(reliability_rating AS DOUBLE) AS reliability_rating,
         {COUNT} AS total_orders, {_avg('transit_days')} AS avg_actual_lead_days,
         {_rate('damage_reported_flag')} AS damage_rate_pct,
         {_rate('otif_compliance_flag')} AS supplier_otif_pct
  FROM fact JOIN suppliers USING (supplier_id)
  GROUP BY supplier_id, supplier_name, category, country, agreed_lead_days, reliability_rating)
"""

WAREHOUSE_FACT = "fact JOIN warehouses w ON destination_warehouse_id = w.warehouse_id"

WAREHOUSE_MEASURES = f"""{COUNT} AS monthly_inbound_shipments,
  {_dsum('weight_kg')} AS total_inbound_weight_kg,
  {_dsum('freight_cost_usd')} AS monthly_freight_cost_usd,
  {_rate('otif_compliance_flag')} AS monthly_otif_pct"""

MONTHLY = f"""
monthly AS (
  SELECT w.warehouse_id, w.name, w.region,
         strftime(actual_delivery_date, '%Y-%m') AS delivery_month, {WAREHOUSE_MEASURES}
  FROM {WAREHOUSE_FACT} GROUP BY ALL)
"""

RANKING = f"""
ranking AS (
  SELECT carrier_id, carrier_name, transport_mode, carrier_tier,
         CAST(sla_target_pct AS DOUBLE) AS sla_target_pct, {COUNT} AS total_shipments,
         {_rate('on_time_flag')} AS actual_ontime_pct,
         {_rate('otif_compliance_flag')} AS actual_otif_pct
  FROM fact JOIN register USING (carrier_id)
  GROUP BY carrier_id, carrier_name, transport_mode, carrier_tier, sla_target_pct),
ranked AS (
  SELECT *, CASE WHEN actual_ontime_pct < sla_target_pct THEN 'BREACH' ELSE 'COMPLIANT' END
              AS sla_status,
         CAST(rank() OVER (PARTITION BY transport_mode ORDER BY actual_otif_pct DESC) AS INTEGER)
              AS mode_rank
  FROM ranking)
"""

DELAYS = """
delays AS (
  SELECT delay_reason AS reason, CAST(count(*) AS BIGINT) AS "count" FROM fact
  WHERE delay_reason IS NOT NULL AND delay_reason <> 'None' GROUP BY delay_reason)
"""


def _merge(table: str, key: str, output: str, in_target: str, in_source: str, change: str) -> str:
    """What MERGE leaves behind: untouched target rows and every source row."""
    source = f"SELECT * REPLACE ({change}) FROM {table} WHERE {in_source}"
    return _sql(
        f"""SELECT {output} FROM (SELECT * FROM {table} WHERE ({in_target}) AND {key} NOT IN
            (SELECT {key} FROM {table} WHERE {in_source}) UNION ALL {source})"""
    )


def _null_checks(name: str, source: str, columns: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, 'NOT_NULL' AS rule, '{c}' AS column_name,
            {COUNT} AS rows_checked,
            CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS violations FROM {source}"""
        for c in columns.split()
    )


def _domain_checks(name: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, '{rule}' AS rule, '{column}' AS column_name,
            {COUNT} AS rows_checked,
            CAST(count(*) FILTER ({broken}) AS BIGINT) AS violations FROM {source}"""
        for rule, column, broken in rules
    )


def _flag(column: str):
    return ("FLAG_0_1", column, f"{column} NOT IN (0, 1)")


def _length(column: str, limit: int):
    return ("MAX_LENGTH", column, f"length(CAST({column} AS VARCHAR)) > {limit}")


def _range(column: str, whole_digits: int):
    return ("DECIMAL_RANGE", column, f"abs({column}) >= 1e{whole_digits}")


def _unique_check(name: str, source: str, *key: str) -> str:
    columns = ", ".join(key)
    return f"""SELECT '{name}' AS table_name, '{'+'.join(key)}' AS key_columns,
      CAST(sum(n) AS BIGINT) AS rows_checked,
      CAST(count(*) FILTER (n > 1) AS BIGINT) AS repeated_keys,
      CAST(sum(n - 1) AS BIGINT) AS surplus_rows
      FROM (SELECT {columns}, count(*) AS n FROM {source} GROUP BY {columns})"""


def _orphan_check(column: str, dimension: str) -> str:
    return f"""SELECT 'shipments.{column}' AS relation,
      CAST(count(DISTINCT {column}) AS BIGINT) AS orphan_keys, {COUNT} AS orphan_rows
      FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {dimension} d WHERE d.key = f.{column})"""


FACT_REQUIRED = """shipment_id order_id supplier_id destination_warehouse_id carrier_id order_date
promised_delivery_date actual_delivery_date transit_days promised_transit_days transit_delay_days
on_time_flag in_full_flag otif_compliance_flag weight_kg quantity_units freight_cost_usd
freight_cost_per_kg damage_reported_flag shipment_status"""
CARRIER_REQUIRED = (
    "carrier_id carrier_name transport_mode base_rate_per_kg sla_target_pct carrier_tier"
)
WAREHOUSE_REQUIRED = (
    "warehouse_id name city country region capacity_sqft daily_op_cost_usd cost_per_sqft"
)
SUPPLIER_REQUIRED = """supplier_id supplier_name category country agreed_lead_days
reliability_rating contract_sla_pct risk_profile"""

ORACLES: dict[str, str] = {
    "bronze_json_records": """
SELECT event_id, status,
       CASE WHEN status = 'ACCEPTED' THEN CAST(user_id AS VARCHAR) END AS vehicle_id,
       CASE WHEN status = 'ACCEPTED' THEN digits END AS speed_text,
       CASE WHEN status = 'ACCEPTED' THEN event_type || ' "1.50"' END AS note, flaw,
       CASE event_id % 9 WHEN 1 THEN 2 * n WHEN 2 THEN n + 5 WHEN 3 THEN n + 14 WHEN 4 THEN 4
                         WHEN 5 THEN n - 1 END AS refused_length
FROM (SELECT *, CASE WHEN event_id % 9 BETWEEN 1 AND 5 THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS status,
             CASE event_id % 9 WHEN 1 THEN 'text after the record' WHEN 2 THEN 'text after the record'
                               WHEN 3 THEN 'repeated field' WHEN 4 THEN 'not an object'
                               WHEN 5 THEN 'broken JSON' END AS flaw,
             CAST(length('{"telematics_id":"' || event_id || '","vehicle_id":"' || user_id
               || '", "speed_kmh": ' || digits || ',"note":"' || event_type || ' \\"1.50\\""}')
               AS INTEGER) AS n
      FROM (SELECT *, CAST(CAST(value AS DECIMAL(12,4)) AS VARCHAR) || '0012345678901234567890' AS digits
            FROM events))""",
    "bronze_source_tag": _sql(
        """
SELECT 'shipments' AS feed, shipment_id AS record_id, 'TMS' AS _source_system FROM fact
UNION ALL SELECT 'carriers', carrier_id, 'ERP' FROM carriers
UNION ALL SELECT 'warehouses', CAST(warehouse_id AS VARCHAR), 'WMS' FROM warehouses
UNION ALL SELECT 'suppliers', CAST(supplier_id AS VARCHAR), 'SRM' FROM suppliers
UNION ALL SELECT 'fleet_telematics', CAST(telematics_id AS VARCHAR), 'IoT_Hub' FROM telematics"""
    ),
    "silver_not_null_gate": """
WITH lines AS (
  SELECT concat_ws('-', 'SHP', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS shipment_id,
         CASE WHEN ((l_partkey % 50) + 50) % 50 <> 0 THEN 'ORD-' || l_orderkey END AS order_id,
         l_suppkey AS supplier_id
  FROM lineitem)
SELECT *, CASE WHEN shipment_id IS NULL OR order_id IS NULL THEN 'REJECTED' ELSE 'ACCEPTED' END
            AS gate_status
FROM lines""",
    "silver_shipments": _sql(f"SELECT {FACT_OUTPUT} FROM fact"),
    "silver_shipment_hash": _sql(
        """SELECT shipment_id,
       md5(shipment_id || '||' || strftime(order_date, '%Y-%m-%d %H:%M:%S')) AS shipment_hash_key
       FROM fact"""
    ),
    "silver_carrier_tier": _sql(f"SELECT {CARRIER_OUTPUT} FROM carriers"),
    "silver_warehouse_cost": _sql(f"SELECT {WAREHOUSE_OUTPUT} FROM warehouses"),
    "silver_supplier_risk": _sql(f"SELECT {SUPPLIER_OUTPUT} FROM suppliers"),
    "gold_carrier_scorecard": _sql(
        """
SELECT *, CASE WHEN actual_on_time_pct < sla_target_pct THEN 1 ELSE 0 END AS sla_breach_flag,
       CASE WHEN actual_on_time_pct < sla_target_pct THEN '🚨 SLA Breach' ELSE '✅ Compliant' END
         AS sla_badge
FROM scorecard""",
        SCORECARD,
    ),
    "gold_carrier_scorecard_gaps": _sql(
        """
SELECT *, CASE WHEN actual_on_time_pct < sla_target_pct THEN 1 ELSE 0 END AS sla_breach_flag,
       CASE WHEN actual_on_time_pct < sla_target_pct THEN '🚨 SLA Breach' ELSE '✅ Compliant' END
         AS sla_badge
FROM scorecard""",
        SCORECARD.replace(
            "FROM fact JOIN",
            """FROM (SELECT * REPLACE (
                CASE WHEN quantity_units % 7 <> 0 THEN transit_days END AS transit_days,
                CASE WHEN quantity_units % 7 <> 0 THEN transit_delay_days END AS transit_delay_days)
              FROM fact) JOIN""",
        ),
    ),
    "gold_scorecard_by_days": _sql(
        """
SELECT *, CASE WHEN actual_on_time_pct < sla_target_pct THEN 1 ELSE 0 END AS sla_breach_flag
FROM scorecard""",
        SCORECARD.replace(
            "FROM fact JOIN register USING (carrier_id)",
            """FROM (SELECT * REPLACE (freight_cost_usd + CASE WHEN order_date >= '1995-02-01'
                         AND order_date < '1995-03-01' THEN 1 ELSE 0 END AS freight_cost_usd)
              FROM fact) JOIN (SELECT * REPLACE (carrier_name || CASE WHEN carrier_id <= 'CAR-4'
                         THEN ' Group' ELSE '' END AS carrier_name) FROM register)
              USING (carrier_id)""",
        ),
    ),
    "gold_warehouse_monthly": _sql("SELECT * FROM monthly", MONTHLY),
    "warehouse_month_trunc": _sql(
        f"""
SELECT w.warehouse_id, w.name, w.region,
       strftime(date_trunc('month', actual_delivery_date), '%Y-%m-%d') AS delivery_month_start,
       {WAREHOUSE_MEASURES}
FROM {WAREHOUSE_FACT} GROUP BY ALL"""
    ),
    "gold_supplier_reliability": _sql("SELECT * FROM reliability", RELIABILITY),
    "delay_breakdown": _sql('SELECT * FROM delays ORDER BY "count" DESC, reason', DELAYS),
    "delay_breakdown_pct": _sql(
        """SELECT reason, "count", CAST(round(CAST("count" * 100.0 /
           (SELECT max("count") FROM delays) AS DECIMAL(28,10)), 0) AS INTEGER) AS pct_of_max
           FROM delays""",
        DELAYS,
    ),
    "exec_kpi_summary": _sql(
        f"""
SELECT {COUNT} AS total_shipments, {_dsum('freight_cost_usd')} AS total_freight_spend_usd,
       {_avg('freight_cost_per_kg', 4)} AS avg_freight_cost_per_kg,
       {_rate('otif_compliance_flag')} AS otif_compliance_rate_pct,
       {_rate('damage_reported_flag')} AS damage_rate_pct,
       {_avg('transit_delay_days')} AS avg_transit_delay_days
FROM fact"""
    ),
    "carrier_sla_ranking": _sql(
        "SELECT * FROM ranked ORDER BY actual_otif_pct DESC, carrier_id", RANKING
    ),
    "warehouse_efficiency": _sql(
        f"""
SELECT w.region, w.warehouse_id, w.name AS warehouse_name, {COUNT} AS inbound_shipments,
       {_dsum('weight_kg')} AS total_inbound_weight_kg,
       {_dsum('freight_cost_usd')} AS total_freight_spend_usd,
       {_rate('otif_compliance_flag')} AS warehouse_otif_pct,
       CAST(w.cost_per_sqft AS DOUBLE) AS facility_cost_per_sqft
FROM {WAREHOUSE_FACT}
GROUP BY w.region, w.warehouse_id, w.name, w.cost_per_sqft
ORDER BY total_freight_spend_usd DESC"""
    ),
    "supplier_risk_matrix": _sql(
        f"""
SELECT supplier_id, supplier_name, country, category, risk_profile, {COUNT} AS order_count,
       {_rate('damage_reported_flag')} AS damage_rate_pct,
       {_avg('transit_delay_days')} AS avg_delay_days
FROM fact JOIN suppliers USING (supplier_id)
GROUP BY supplier_id, supplier_name, country, category, risk_profile
HAVING count(*) >= 10
ORDER BY damage_rate_pct DESC, avg_delay_days DESC"""
    ),
    "dim_date": _sql(
        """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
       strftime(full_date, '%Y-%m-%d') AS full_date,
       CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
       CAST(month_num AS INTEGER) AS month_num, monthname(full_date) AS month_name,
       CAST(quarter(full_date) AS INTEGER) AS quarter_num, CAST(year_num AS INTEGER) AS year_num,
       CASE WHEN dayofweek(full_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM calendar"""
    ),
    "dim_carrier_merge": _merge(
        "carriers",
        "carrier_id",
        CARRIER_OUTPUT + ", 1 AS is_active",
        "carrier_id <= 'CAR-5'",
        "carrier_id >= 'CAR-3'",
        "carrier_name || ' Group' AS carrier_name",
    ),
    "dim_warehouse_merge": _merge(
        "warehouses",
        "warehouse_id",
        WAREHOUSE_OUTPUT,
        "warehouse_id < 15",
        "warehouse_id >= 10",
        "capacity_sqft + 1000 AS capacity_sqft",
    ),
    "dim_supplier_merge": _merge(
        "suppliers",
        "supplier_id",
        SUPPLIER_OUTPUT,
        "supplier_id % 6 <= 2",
        "supplier_id % 6 >= 2",
        "agreed_lead_days + 1 AS agreed_lead_days",
    ),
    "dim_carrier_surrogate": _sql(
        """
SELECT carrier_id, carrier_name, CAST(CASE WHEN carrier_id <= 'CAR-5'
         THEN CAST(substr(carrier_id, 5) AS INTEGER)
         ELSE 5 + row_number() OVER (PARTITION BY carrier_id > 'CAR-5'
                                     ORDER BY substr(md5(carrier_id), 1, 3), carrier_id)
         END AS INTEGER) AS carrier_key
FROM carriers"""
    ),
    "fact_load_batch": _sql(
        f"""
SELECT {FACT_OUTPUT} FROM (
  SELECT * REPLACE (CAST(supplier_id AS VARCHAR) AS supplier_id,
                    CAST(destination_warehouse_id AS VARCHAR) AS destination_warehouse_id,
                    CASE WHEN CAST(order_date AS DATE) = DATE '1995-02-18' THEN freight_cost_usd + 1
                         ELSE freight_cost_usd END AS freight_cost_usd)
  FROM fact)"""
    ),
    "fact_load_batch_changed": _sql(
        f"""
SELECT {FACT_OUTPUT} FROM (
  SELECT * REPLACE (CAST(supplier_id AS VARCHAR) AS supplier_id,
                    CAST(destination_warehouse_id AS VARCHAR) AS destination_warehouse_id)
  FROM (SELECT * FROM fact WHERE CAST(order_date AS DATE) <> DATE '1995-02-18'
        UNION ALL
        SELECT * REPLACE (freight_cost_usd + 1 AS freight_cost_usd) FROM fact
        WHERE CAST(order_date AS DATE) = DATE '1995-02-18' AND quantity_units % 5 <> 0
        UNION ALL
        SELECT * REPLACE (shipment_id || '-M' AS shipment_id,
                          order_date - INTERVAL 1 DAY AS order_date) FROM fact
        WHERE CAST(order_date AS DATE) = DATE '1995-02-19'))"""
    ),
    "measures_shipment": _sql(
        f"""
SELECT transport_mode, {COUNT} AS total_shipments,
       {_dsum('freight_cost_usd')} AS total_freight_spend_usd, {_dsum('weight_kg')} AS total_weight_kg,
       {_frac('sum(freight_cost_usd)', 'sum(weight_kg)')} AS freight_cost_per_kg_weighted,
       {_avg('transit_days', 6)} AS avg_transit_days,
       {_avg('transit_delay_days', 6)} AS avg_transit_delay_days
FROM fact JOIN register USING (carrier_id) GROUP BY transport_mode"""
    ),
    "measures_otif": _sql(
        f"""
SELECT carrier_id, {_isum('on_time_flag')} AS on_time_shipments,
       {_isum('in_full_flag')} AS in_full_shipments,
       {_isum('otif_compliance_flag')} AS otif_shipments,
       {_frac('sum(on_time_flag)', 'count(*)')} AS on_time_rate,
       {_frac('sum(otif_compliance_flag)', 'count(*)')} AS otif_rate,
       {_frac('sum(damage_reported_flag)', 'count(*)')} AS damage_rate
FROM fact JOIN register USING (carrier_id) GROUP BY carrier_id"""
    ),
    "measures_sla": _sql(
        f"""
SELECT transport_mode, {_rounded('rate', 6)} AS on_time_rate, {_rounded('target', 6)} AS target_sla,
       {_rounded('rate - target', 6)} AS sla_variance,
       CASE WHEN rate < target THEN '🚨 SLA Breached' ELSE '✅ SLA Compliant' END
         AS sla_breach_status
FROM (SELECT transport_mode, CAST(sum(on_time_flag) AS DOUBLE) / count(*) AS rate
      FROM fact JOIN register USING (carrier_id) GROUP BY transport_mode)
JOIN (SELECT transport_mode, avg(CAST(sla_target_pct AS DOUBLE)) / 100 AS target
      FROM register GROUP BY transport_mode) USING (transport_mode)"""
    ),
    "measure_calculate_override": _sql(
        f"""
SELECT carrier_id, CAST(count(*) FILTER (on_time_flag = 0) AS BIGINT) AS total_shipments,
       CAST(count(*) FILTER (on_time_flag = 1) AS BIGINT) AS on_time_shipments,
       CAST(count(*) FILTER (on_time_flag = 0 AND in_full_flag = 1) AS BIGINT) AS in_full_shipments
FROM fact JOIN register USING (carrier_id) GROUP BY carrier_id"""
    ),
    "telematics_kpis": _sql(
        f"""
SELECT {_rounded('avg(speed_kmh)', 4)} AS avg_vehicle_speed_kmh,
       {_rounded('avg(fuel_consumption_l_100km) FILTER (speed_kmh > 5)', 4)}
         AS avg_fuel_moving_l_100km,
       {_isum('maintenance_alert_flag')} AS active_maintenance_alerts
FROM telematics"""
    ),
    "freight_yoy": _sql(
        f"""
SELECT CAST(m.year_num AS INTEGER) AS year_num, CAST(m.month_num AS INTEGER) AS month_num,
       CAST(m.freight AS DOUBLE) AS freight_usd, CAST(p.freight AS DOUBLE) AS prior_freight_usd,
       {_frac('(m.freight - p.freight)', 'p.freight')} AS yoy_growth
FROM months m LEFT JOIN months p ON p.year_num = m.year_num - 1 AND p.month_num = m.month_num""",
        """
months AS (
  SELECT year_num, month_num, sum(freight_cost_usd) AS freight
  FROM fact JOIN calendar ON actual_delivery_date = full_date GROUP BY year_num, month_num)""",
    ),
    "monthly_delivery_trend": _sql(
        f"""
SELECT strftime(actual_delivery_date, '%Y-%m') AS delivery_month, {COUNT} AS total_shipments,
       {_rate('otif_compliance_flag')} AS otif_pct, CAST(95.0 AS DOUBLE) AS target_pct
FROM fact JOIN calendar ON actual_delivery_date = full_date
GROUP BY 1 ORDER BY 1"""
    ),
    "order_intake_monthly": _sql(
        f"""
SELECT strftime(order_date, '%Y-%m') AS order_month, {COUNT} AS shipments_ordered,
       {_dsum('weight_kg')} AS ordered_weight_kg, {_dsum('freight_cost_usd')} AS ordered_freight_usd
FROM fact JOIN calendar ON CAST(order_date AS DATE) = full_date
GROUP BY 1 ORDER BY 1"""
    ),
    "report_top5_carriers": _sql(
        """SELECT carrier_id, carrier_name, total_shipments, actual_otif_pct, sla_status
           FROM ranked ORDER BY total_shipments DESC, carrier_id LIMIT 5""",
        RANKING,
    ),
    "report_region_matrix": _sql(
        f"""
SELECT w.region, CAST(w.warehouse_id AS VARCHAR) AS warehouse_id,
       CAST(grouping(w.region, w.warehouse_id) AS INTEGER) AS level,
       {_dsum('weight_kg')} AS inbound_weight_kg, {_dsum('freight_cost_usd')} AS freight_cost_usd,
       {_rate('otif_compliance_flag')} AS otif_pct
FROM {WAREHOUSE_FACT} GROUP BY ROLLUP (w.region, w.warehouse_id)"""
    ),
    "report_cost_otif_scatter": _sql(
        f"""
SELECT carrier_id, carrier_name,
       {_frac('sum(freight_cost_usd)', 'sum(weight_kg)')} AS freight_cost_per_kg_weighted,
       {_frac('sum(otif_compliance_flag)', 'count(*)')} AS otif_rate, {COUNT} AS total_shipments
FROM fact JOIN register USING (carrier_id) GROUP BY carrier_id, carrier_name"""
    ),
    "report_mode_variance": _sql(
        """
SELECT transport_mode, delivery_month, CAST(freight AS DOUBLE) AS freight_usd,
       CAST(lag(freight) OVER w AS DOUBLE) AS previous_freight_usd,
       CAST(freight - lag(freight) OVER w AS DOUBLE) AS variance_usd
FROM (SELECT transport_mode, strftime(actual_delivery_date, '%Y-%m') AS delivery_month,
             sum(freight_cost_usd) AS freight
      FROM fact JOIN register USING (carrier_id) GROUP BY 1, 2)
WINDOW w AS (PARTITION BY transport_mode ORDER BY delivery_month)"""
    ),
    "report_slicer": _sql(
        f"""
SELECT carrier_id, carrier_tier, transport_mode, {COUNT} AS total_shipments,
       {_dsum('freight_cost_usd')} AS total_freight_spend_usd,
       {_frac('sum(on_time_flag)', 'count(*)')} AS on_time_rate,
       {_frac('sum(otif_compliance_flag)', 'count(*)')} AS otif_rate
FROM fact JOIN register USING (carrier_id)
WHERE carrier_tier IN ('Tier-2 Standard', 'Tier-3 Economy')
  AND transport_mode IN ('Road', 'Sea', 'Sea/Air')
  AND actual_delivery_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
GROUP BY carrier_id, carrier_tier, transport_mode"""
    ),
    "report_delay_decomposition": _sql(
        f"""
SELECT country, category, supplier_name, delay_reason,
       CAST(grouping(country, category, supplier_name, delay_reason) AS INTEGER) AS level,
       {_isum('transit_delay_days')} AS net_delay_days,
       {_isum("CASE WHEN delay_reason <> 'None' THEN transit_delay_days ELSE 0 END")} AS late_days,
       CAST(count(*) FILTER (late) AS BIGINT) AS late_shipments
FROM (SELECT *, delay_reason <> 'None' AS late FROM fact) JOIN suppliers USING (supplier_id)
GROUP BY ROLLUP (country, category, supplier_name, delay_reason)"""
    ),
    "report_top10_risk_suppliers": _sql(
        """SELECT supplier_id, supplier_name, category, country, damage_rate_pct
           FROM reliability ORDER BY damage_rate_pct DESC, supplier_id LIMIT 10""",
        RELIABILITY,
    ),
    "summary_kpis": _sql(
        f"""
SELECT *, CASE WHEN otif_rate_pct >= 80 THEN 'GOOD' ELSE 'WARNING' END AS otif_status
FROM (SELECT {COUNT} AS total_shipments, {_rate('otif_compliance_flag', 1)} AS otif_rate_pct,
             {_rounded('sum(freight_cost_usd) / 1000000', 2)} AS total_freight_spend_musd,
             {_avg('transit_days', 1)} AS avg_transit_days,
             {_rate('damage_reported_flag')} AS damage_rate_pct,
             (SELECT {COUNT} FROM suppliers) AS active_suppliers,
             (SELECT {COUNT} FROM warehouses) AS active_warehouses
      FROM fact)"""
    ),
    "summary_top_suppliers": _sql(
        "SELECT * FROM reliability ORDER BY total_orders DESC, supplier_id LIMIT 15", RELIABILITY
    ),
    "carrier_top_volume": _sql(
        """
SELECT carrier_id, carrier_name, transport_mode, total_shipments, sla_target_pct, actual_otif_pct,
       CASE WHEN actual_otif_pct >= sla_target_pct THEN 'MET' ELSE 'MISSED' END AS otif_target_status
FROM scorecard ORDER BY total_shipments DESC, carrier_id LIMIT 6""",
        SCORECARD,
    ),
    "warehouse_otif_status": _sql(
        """
SELECT *, CASE WHEN monthly_otif_pct >= 80 THEN 'GOOD' ELSE 'WARNING' END AS otif_status
FROM monthly ORDER BY warehouse_id, name, region, delivery_month LIMIT 15""",
        MONTHLY,
    ),
    "supplier_damage_status": _sql(
        """SELECT supplier_id, supplier_name, damage_rate_pct,
           CASE WHEN damage_rate_pct > 3 THEN 'HIGH' ELSE 'NORMAL' END AS damage_status
           FROM reliability""",
        RELIABILITY,
    ),
    "rls_region_manager": _sql(
        f"""
SELECT w.warehouse_id, {COUNT} AS shipments, {_dsum('freight_cost_usd')} AS freight_cost_usd,
       {_rate('otif_compliance_flag')} AS otif_pct
FROM {WAREHOUSE_FACT}
WHERE w.region IN (SELECT region FROM (VALUES ('amara', 'EUROPE'), ('amara', 'ASIA'),
                     ('bashir', 'AFRICA')) AS g(user_name, region) WHERE user_name = 'amara')
GROUP BY w.warehouse_id"""
    ),
    "rls_supplier_manager": _sql(
        f"""
SELECT supplier_id, {COUNT} AS shipments, {_rate('damage_reported_flag')} AS damage_rate_pct,
       {_rate('otif_compliance_flag')} AS otif_pct
FROM fact JOIN suppliers USING (supplier_id)
WHERE category IN (SELECT category FROM (VALUES ('chidi', 'Raw Packaging'),
                     ('chidi', 'Industrial Sensors'), ('dora', 'Automotive Parts'))
                     AS g(user_name, category) WHERE user_name = 'chidi')
GROUP BY supplier_id"""
    ),
    "dq_not_null": _sql(
        "\nUNION ALL\n".join(
            [
                _null_checks("fact_shipment_fulfillment", "fact", FACT_REQUIRED),
                _null_checks("silver_carriers", "carriers", CARRIER_REQUIRED),
                _null_checks("silver_warehouses", "warehouses", WAREHOUSE_REQUIRED),
                _null_checks("silver_suppliers", "suppliers", SUPPLIER_REQUIRED),
            ]
        )
    ),
    "dq_domain": _sql(
        "\nUNION ALL\n".join(
            [
                _domain_checks(
                    "fact_shipment_fulfillment",
                    "fact",
                    [
                        *[
                            _length(c, 50)
                            for c in "shipment_id order_id supplier_id destination_warehouse_id "
                            "carrier_id shipment_status".split()
                        ],
                        *[
                            _flag(c)
                            for c in "on_time_flag in_full_flag otif_compliance_flag "
                            "damage_reported_flag".split()
                        ],
                        _range("weight_kg", 8),
                        _range("freight_cost_usd", 10),
                        _range("freight_cost_per_kg", 6),
                        _length("delay_reason", 100),
                    ],
                ),
                _domain_checks(
                    "silver_carriers",
                    "carriers",
                    [
                        _length("carrier_id", 50),
                        _length("carrier_name", 100),
                        _length("transport_mode", 50),
                        _length("carrier_tier", 50),
                        _range("base_rate_per_kg", 6),
                        _range("sla_target_pct", 3),
                    ],
                ),
                _domain_checks(
                    "silver_warehouses",
                    "warehouses",
                    [
                        _length("warehouse_id", 50),
                        *[_length(c, 100) for c in ("name", "city", "country")],
                        _length("region", 50),
                        _range("daily_op_cost_usd", 10),
                        _range("cost_per_sqft", 8),
                    ],
                ),
                _domain_checks(
                    "silver_suppliers",
                    "suppliers",
                    [
                        _length("supplier_id", 50),
                        _length("supplier_name", 150),
                        _length("category", 100),
                        _length("country", 100),
                        _length("risk_profile", 50),
                        _range("reliability_rating", 2),
                        _range("contract_sla_pct", 3),
                    ],
                ),
            ]
        )
    ),
    "dq_not_null_planted": _sql(
        f"""SELECT 'fact_shipment_fulfillment' AS table_name, 'NOT_NULL' AS rule,
          unnest(['carrier_id', 'order_id']) AS column_name, unnest([n, n]) AS rows_checked,
          unnest([lost, 0]) AS violations
        FROM (SELECT {COUNT} AS n, CAST(count(*) FILTER (quantity_units % 17 = 0) AS BIGINT) AS lost
              FROM fact)"""
    ),
    "dq_domain_planted": _sql(
        "\nUNION ALL\n".join(
            f"""SELECT 'fact_shipment_fulfillment' AS table_name, '{rule}' AS rule,
                '{column}' AS column_name, {COUNT} AS rows_checked,
                CAST(count(*) FILTER ({broken}) AS BIGINT) AS violations FROM fact"""
            for rule, column, broken in [
                ("FLAG_0_1", "on_time_flag", "quantity_units % 11 = 0"),
                ("FLAG_0_1", "in_full_flag", "false"),
                (
                    "MAX_LENGTH",
                    "shipment_status",
                    "quantity_units % 13 = 0 AND length(shipment_status) * 9 > 50",
                ),
                ("DECIMAL_RANGE", "weight_kg", "quantity_units % 5 = 0 AND quantity_units % 7 <> 0"),
                ("DECIMAL_SCALE", "weight_kg", "quantity_units % 7 = 0"),
                (
                    "READABLE",
                    "weight_kg",
                    "quantity_units % 3 = 0 AND quantity_units % 5 <> 0 AND quantity_units % 7 <> 0",
                ),
            ]
        )
    ),
    "dq_unique": _sql(
        "\nUNION ALL\n".join(
            [
                _unique_check("fact_shipment_fulfillment", "fact", "shipment_id"),
                _unique_check("silver_carriers", "carriers", "carrier_id"),
                _unique_check("silver_warehouses", "warehouses", "warehouse_id"),
                _unique_check("silver_suppliers", "suppliers", "supplier_id"),
                _unique_check("lineitem", "lineitem", "l_orderkey", "l_linenumber"),
            ]
        )
    ),
    "dq_orphans": _sql(
        "\nUNION ALL\n".join(
            [
                _orphan_check("carrier_id", "(SELECT carrier_id AS key FROM carriers)"),
                _orphan_check(
                    "destination_warehouse_id",
                    "(SELECT warehouse_id AS key FROM warehouses WHERE region <> 'AFRICA')",
                ),
                _orphan_check("supplier_id", "(SELECT supplier_id AS key FROM suppliers)"),
            ]
        )
    ),
}
# Answered from totals, the measures must not differ.
ORACLES["measures_shipment_rollup"] = ORACLES["measures_shipment"]
