"""Row keys derived from business columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightmill.functions.temporal import second_stamp

KEY_SEPARATOR = "||"


def shipment_hash(shipment_id: Column, order_date: Column) -> Column:
    """MD5 over id and order time, the time spelled out so that no locale or zone matters."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, shipment_id, second_stamp(order_date)))
