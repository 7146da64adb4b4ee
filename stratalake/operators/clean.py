"""Typed, normalised projections and rule checks, both stated as data.

A cleaning is a list of (column, how to read it) plus a list of (rule name, SQL condition). Rows that
break a rule leave the accepted set; ``rejects`` keeps them together with the rules they broke.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.functions.calendar import event_calendar, sale_calendar
from stratalake.functions.numbers import IN_RANGE
from stratalake.functions.once import once
from stratalake.operators import rules
from stratalake.operators.dedup import latest

Reading = Callable[[Column], Column]
FAILED = rules.FAILED


def cast_to(type_name: str) -> Reading:
    return lambda c: c.try_cast(type_name)


def as_is(c: Column) -> Column:
    return c


@dataclass(frozen=True)
class Cleaning:
    keys: list[str]
    readings: dict[str, Reading]
    rules: rules.Rules
    calendar: Callable[[], dict[str, Column]] = dict

    def project(self, df: DataFrame, carry: list[str] | None = None, lenient_int: bool = False) -> DataFrame:
        """Typed columns, followed by the ``carry`` columns (default: lineage columns that exist)."""
        if carry is None:
            carry = [c for c in df.columns if c.startswith("_")]
        readings = dict(self.readings)
        if lenient_int:
            readings.update({n: text.lenient_int for n, r in readings.items() if r is INT})
        return df.select(*[read(F.col(name)).alias(name) for name, read in readings.items()], *carry)

    def judged(self, typed: DataFrame) -> DataFrame:
        """All rows, with the names of the rules each one breaks."""
        return rules.judged(typed, self.rules)

    def accepted(self, typed: DataFrame) -> DataFrame:
        for sql in self.rules.values():
            typed = typed.filter(sql)
        return typed

    def rejects(self, typed: DataFrame) -> DataFrame:
        return rules.rejects(typed, self.rules)

    def rule_hits(self, typed: DataFrame) -> DataFrame:
        """One row per rule: how many rows pass and fail it, all from one pass."""
        return rules.hits(typed, self.rules)

    def clean(self, df: DataFrame, lenient_int: bool = False, seen: Observation | None = None) -> DataFrame:
        """Project, drop rule breakers, keep the latest row per key, add calendar columns.

        ``seen`` counts the rows that meet each rule when the result is computed.
        """
        typed = self.project(df, lenient_int=lenient_int)
        if seen is not None:
            typed = typed.observe(seen, *[c.alias(n) for n, c in rules.counters(self.rules).items()])
        else:
            # As the observation does, this keeps the rules above the readings: pushed down, each reads its cell anew.
            typed = once(typed, [], {name: F.col(name) for name in typed.columns})
        kept = self.accepted(typed)
        newest = ["_ingestion_timestamp"] if "_ingestion_timestamp" in kept.columns else []
        return latest(kept, self.keys, newest).withColumns(self.calendar())



LONG, INT, DOUBLE = cast_to("bigint"), cast_to("int"), cast_to("double")
DATE, TIMESTAMP = cast_to("date"), cast_to("timestamp")

SALES = Cleaning(
    keys=["id_venta"],
    readings={
        "id_venta": LONG,
        "id_cliente": LONG,
        "id_producto": LONG,
        "cantidad": INT,
        "precio_unitario": DOUBLE,
        "monto": DOUBLE,
        "fecha_venta": DATE,
        "canal": text.trimmed_upper,
        "pais": text.trimmed_title,
        "categoria": text.trimmed_lower,
    },
    rules={
        "id_venta presente": "id_venta is not null",
        "id_cliente presente": "id_cliente is not null",
        "id_producto presente": "id_producto is not null",
        "monto positivo": "monto > 0",
        # Text such as "NaN", "Infinity" or "1e21" reads as a double, but is no amount.
        "monto en rango": f"monto is null or {IN_RANGE.format('monto')}",
        "cantidad positiva": "cantidad > 0",
        "fecha_venta presente": "fecha_venta is not null",
    },
    calendar=lambda: sale_calendar("fecha_venta"),
)

WEB_EVENTS = Cleaning(
    keys=["event_id"],
    readings={
        "event_id": text.whole,
        "id_cliente": text.whole,
        "session_id": text.trimmed,
        "page": text.trimmed_lower,
        "event_type": text.trimmed_lower,
        "device": text.trimmed_lower,
        "event_timestamp": TIMESTAMP,
        "ingestion_source": as_is,
    },
    rules={
        "event_id presente": "event_id is not null",
        "id_cliente presente": "id_cliente is not null",
        "event_timestamp presente": "event_timestamp is not null",
    },
    calendar=lambda: event_calendar("event_timestamp"),
)

PRODUCTS = Cleaning(
    keys=["id_producto"],
    readings={
        "id_producto": LONG,
        "nombre_producto": text.trimmed,
        "categoria": text.trimmed_lower,
        "proveedor": text.trimmed,
        "precio_base": DOUBLE,
        "activo": text.is_true,
    },
    rules={
        "id_producto presente": "id_producto is not null",
        "precio_base positivo": "precio_base > 0",
        "precio_base en rango": "precio_base is null or abs(precio_base) < 1e9",
    },
)
