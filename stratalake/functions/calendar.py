"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_MONTH = "yyyy-MM"


def sale_calendar(day: str) -> dict[str, Column]:
    return {
        "anio": F.year(day),
        "mes": F.month(day),
        "anio_mes": F.date_format(day, YEAR_MONTH),
    }


def event_calendar(moment: str, hour: bool = False) -> dict[str, Column]:
    columns = {
        "fecha_evento": F.to_date(moment),
        "anio_mes": F.date_format(moment, YEAR_MONTH),
    }
    if hour:
        columns["hora_evento"] = F.hour(moment)
    return columns
