"""Logistics feeds over the trade tables (orders, line items, parties, events).

A line item is one shipment. Feeds stay lazy: a query that does not ask for a
column does not read it, and one that does not ask for the destination does not
join the customer table at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freightmill.functions.labels import NO_DELAY

# --- fixed values of the mapping ---
# code, name, mode, on-time target %
CARRIER_REGISTER = [
    (1, "Altair Cargo", "Air", "97.50"),
    (2, "Blue Meridian", "Air/Sea", "80.00"),
    (3, "Castellan Lines", "Sea", "75.00"),
    (4, "Dromedary Express", "Road/Air", "82.00"),
    (5, "Eastgate Haulage", "Road", "78.00"),
    (6, "Fennel Rail", "Rail/Road", "93.50"),
    (7, "Grand Passage", "Sea/Air", "95.00"),
    (8, "Hollow Pine Trucking", "Road", "94.00"),
]
DELAY_REASONS = [
    "Weather Disruption",
    "Customs Hold",
    "Carrier Breakdown",
    "Port Congestion",
    "Documentation Error",
]
SUPPLIER_CATEGORIES = [
    "Electronics Components",
    "Raw Packaging",
    "Precision Hydraulics",
    "Automotive Parts",
    "Industrial Sensors",
    "Chemical Additives",
]
CONTRACT_SLA_PCTS = ["95", "96", "98", "99"]
MAX_LEAD_DAYS = 30
# --- end of fixed values ---

# Declared, so that opening a table starts no schema-reading job.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def _nth(index: str, values: list[str]) -> str:
    """SQL for the literal at a zero-based ``index``."""
    return f"elt(CAST({index} AS INT) + 1, {', '.join(repr(v) for v in values)})"


CARRIER_IDS = [f"CAR-{code}" for code, *_ in CARRIER_REGISTER]
SHIPMENT_ID = "concat_ws('-', 'SHP', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
ORDER_ID = "concat_ws('-', 'ORD', l_orderkey)"

# Line-item terms, taken before the order join: a day and two booleans are shuffled
# instead of a timestamp, two texts and a rate.
RETURNED_OPEN = "l_returnflag = 'R' AND l_linestatus = 'O'"
LINE_TERMS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "CAST(l_shipdate AS DATE) AS ship_day",
    f"{RETURNED_OPEN} AS returned_open",
    f"{RETURNED_OPEN} AND l_tax > 0.055D AS damaged",
]

# Evaluated once per joined row and used by several of the columns below.
SHARED_TERMS = [
    "CAST(o_orderdate AS DATE) AS order_day",
    "1 + pmod(date_diff(ship_day, CAST(o_orderdate AS DATE)), 30) AS lead",
    "CAST(18 + pmod(l_partkey, 13) AS INT) AS promise",
]

SHIPMENT_COLUMNS = {
    "shipment_id": SHIPMENT_ID,
    "order_id": ORDER_ID,
    "supplier_id": "l_suppkey",
    "destination_warehouse_id": "c_nationkey",
    "carrier_id": _nth("pmod(l_partkey, 8)", CARRIER_IDS),
    "order_date": "o_orderdate",
    "promised_delivery_date": "date_add(order_day, promise)",
    "actual_delivery_date": "date_add(order_day, lead)",
    "transit_days": "lead",
    "promised_transit_days": "promise",
    "on_time_flag": "CASE WHEN lead <= promise THEN 1 ELSE 0 END",
    "in_full_flag": "CASE WHEN returned_open THEN 0 ELSE 1 END",
    "weight_kg": "CAST(l_quantity * 12.5D AS DECIMAL(10,2))",
    "quantity_units": "CAST(l_quantity AS INT)",
    "freight_cost_usd": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.05BD AS DECIMAL(12,2))",
    "damage_reported_flag": "CASE WHEN damaged THEN 1 ELSE 0 END",
    "delay_reason": f"CASE WHEN lead <= promise THEN '{NO_DELAY}' "
    f"ELSE {_nth('pmod(l_orderkey, 5)', DELAY_REASONS)} END",
    "shipment_status": "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Transit' "
    "WHEN 'P' THEN 'Customs Processing' END",
}


class TradeTables:
    """Feeds built from one folder of trade tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _sql(self, text: str, *names: str) -> DataFrame:
        return self.spark.sql(text, **{name: self.table(name) for name in names})

    def shipments(self, destination: bool = False) -> DataFrame:
        """One row per line item with its order; 18 columns, 17 without the destination."""
        if destination:
            # Joined on the order side first, so the line items are shuffled only once.
            # Left, so an order without a known customer is kept for the orphan check.
            orders = self._sql(
                "SELECT o_orderkey, o_orderstatus, o_orderdate, c_nationkey "
                "FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey",
                "orders",
                "customer",
            )
        else:
            orders = self.table("orders")
        columns = [
            f"{expression} AS {name}"
            for name, expression in SHIPMENT_COLUMNS.items()
            if destination or name != "destination_warehouse_id"
        ]
        return self.spark.sql(
            f"""SELECT {", ".join(columns)}
            FROM (SELECT *, {", ".join(SHARED_TERMS)}
                  FROM {{lines}} JOIN {{orders}} ON l_orderkey = o_orderkey)""",
            lines=self.table("lineitem").selectExpr(*LINE_TERMS),
            orders=orders,
        )

    def carrier_register(self) -> DataFrame:
        """Names, modes and targets: eight constant rows, small enough to broadcast by size."""
        rows = ", ".join(
            f"('CAR-{code}', '{name}', '{mode}', CAST({target} AS DECIMAL(5,2)))"
            for code, name, mode, target in CARRIER_REGISTER
        )
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} "
            "AS t(carrier_id, carrier_name, transport_mode, sla_target_pct)"
        )

    def carriers(self) -> DataFrame:
        """The carriers that parts are assigned to, priced from those parts."""
        assigned = _nth("pmod(p_partkey, 8)", CARRIER_IDS)
        return self.spark.sql(
            f"""SELECT carrier_id, carrier_name, transport_mode,
                      CAST(round(CAST(CAST(price_sum AS DOUBLE) / parts / 1000
                                      AS DECIMAL(28,10)), 4) AS DECIMAL(10,4)) AS base_rate_per_kg,
                      sla_target_pct
               FROM {{register}}
               JOIN (SELECT carrier_id, count(*) AS parts,
                            sum(CAST(p_retailprice AS DECIMAL(12,2))) AS price_sum
                     FROM (SELECT {assigned} AS carrier_id, p_retailprice FROM {{part}})
                     GROUP BY carrier_id)
               USING (carrier_id)""",
            register=self.carrier_register(),
            part=self.table("part"),
        )

    def warehouses(self) -> DataFrame:
        return self._sql(
            """SELECT n_nationkey AS warehouse_id, concat(n_name, ' DC') AS name,
                      n_name AS city, n_name AS country, r_name AS region,
                      CAST(300000 + n_nationkey * 12500 AS BIGINT) AS capacity_sqft,
                      CAST(9000 + n_nationkey * 275 AS DECIMAL(12,2)) AS daily_op_cost_usd
               FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
            "nation",
            "region",
        )

    def suppliers(self) -> DataFrame:
        return self._sql(
            f"""SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
                      {_nth("s_suppkey % 6", SUPPLIER_CATEGORIES)} AS category,
                      n_name AS country,
                      CAST(3 + s_suppkey % 12 AS INT) AS agreed_lead_days,
                      CAST(3.80BD + CAST(s_suppkey % 13 AS DECIMAL(4,0)) * 0.10BD
                           AS DECIMAL(4,2)) AS reliability_rating,
                      CAST({_nth("s_suppkey % 4", CONTRACT_SLA_PCTS)} AS DECIMAL(5,2))
                        AS contract_sla_pct
               FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
            "supplier",
            "nation",
        )

    def telematics(self) -> DataFrame:
        return self._sql(
            """SELECT event_id AS telematics_id, user_id AS vehicle_id, ts AS timestamp,
                      least(value, 120.0D) AS speed_kmh,
                      CASE WHEN value > 5 THEN CAST(get_json_object(props, '$.k') AS DOUBLE)
                           ELSE 0.0D END AS fuel_consumption_l_100km,
                      CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS maintenance_alert_flag
               FROM {events}""",
            "events",
        )

    def telematics_lines(self) -> DataFrame:
        """The events as JSON text, with more digits than a double holds and planted faults."""
        record = r"""concat('{"telematics_id":"', event_id, '","vehicle_id":"', user_id,
            '", "speed_kmh": ', CAST(value AS DECIMAL(12,4)), '0012345678901234567890',
            ',"note":"', event_type, ' \\"1.50\\""}')"""
        told = self.table("events").selectExpr("event_id", f"{record} AS record")
        return told.selectExpr(
            "event_id",
            """CASE event_id % 9
                 WHEN 1 THEN concat(record, record)
                 WHEN 2 THEN concat(record, ' tail')
                 WHEN 3 THEN replace(record, '"note"', '"speed_kmh":0,"note"')
                 WHEN 4 THEN 'null'
                 WHEN 5 THEN left(record, length(record) - 1)
                 ELSE record END AS value""",
        )

    def calendar_bounds(self) -> DataFrame:
        """One row: first and last day any order or delivery can fall on."""
        return self._sql(
            f"""SELECT min(CAST(o_orderdate AS DATE)) AS first_day,
                       date_add(max(CAST(o_orderdate AS DATE)), {MAX_LEAD_DAYS}) AS last_day
                FROM {{orders}}""",
            "orders",
        )
