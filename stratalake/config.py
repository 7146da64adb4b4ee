"""Where the layers live, how they are stored, and which datasets each layer holds."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

# Names of the landing datasets and of the Bronze lineage constants.
# dataset -> (landing folder, source system, source format)
LANDING = {
    "ventas": ("raw/csv/ventas", "ERP_POS", "CSV"),
    "web_events": ("raw/json/web_events", "WEB_API", "JSON"),
    "productos": ("raw/xml/productos.xml", "MASTER_DATA", "XML"),
}
STREAM_TABLE = "gps_camiones_streaming"
STREAM_LINEAGE = ("GPS_IOT_KAFKA", "JSON_STREAM")
# Topic and broker of the deployment.
DEFAULT_TOPIC = "gpscamiones"
DEFAULT_BROKERS = "kafka:9092"

# Quality rule text reported per Silver table.
QUALITY_RULES = {
    "ventas": "ventas limpias, monto positivo, fecha válida, sin duplicados por id_venta",
    "web_events": "eventos con id_cliente, event_id y timestamp válido",
    "productos": "productos activos/inactivos normalizados y precio válido",
    "ventas_enriquecidas": "ventas unidas con catálogo de productos para analítica final",
}

# Gold tables and the descriptions listed in the catalogue.
GOLD_TABLES = {
    "kpis_generales": "Resumen ejecutivo: ventas, clientes, ingreso total, ticket promedio y margen estimado.",
    "ventas_mensuales": "Ingresos, ventas, clientes y margen estimado por mes.",
    "cliente_mayor_volumen": "Cliente con mayor volumen total de compra.",
    "top10_ventas": "Top 10 ventas individuales de mayor importe.",
    "promedio_venta_cliente": "Monto promedio de venta por cliente y ranking de clientes.",
    "pareto_80_clientes": "Análisis Pareto para identificar clientes que concentran el 80% del ingreso.",
    "resumen_pareto": "Resumen ejecutivo del análisis Pareto.",
    "ventas_categoria_canal": "Ingresos y ventas por categoría y canal comercial.",
    "web_kpis": "Eventos web agregados por mes, tipo de evento y dispositivo.",
}
FLEET_TABLES = {
    "rt_kpis_generales": "KPIs ejecutivos de flota: camiones activos, toneladas, velocidad, ocupación y alertas.",
    "rt_kpis_por_zona": "Indicadores por zona logística para detectar rutas críticas.",
    "rt_toneladas_por_hora": "Toneladas transportadas por hora para análisis operacional.",
    "rt_estado_flota": "Distribución de eventos por estado de entrega.",
    "rt_alertas_operativas": "Alertas por riesgo alto, espera prolongada o posible detención en ruta.",
}
GOLD_CATALOG = "catalogo_gold"
FLEET_CATALOG = "rt_catalogo"
MAY_BE_EMPTY = frozenset({"rt_alertas_operativas"})

# Order of the rows of each extract; "-" is descending.
EXTRACT_ORDER = {
    "ventas_mensuales": ["anio_mes"],
    "cliente_mayor_volumen": ["ranking_cliente"],
    "top10_ventas": ["ranking_venta"],
    "promedio_venta_cliente": ["-total_comprado", "id_cliente"],
    "pareto_80_clientes": ["ranking_cliente"],
    "resumen_pareto": ["-ingreso_segmento", "segmento_pareto"],
    "ventas_categoria_canal": ["-ingreso_total", "categoria_final", "canal"],
    "web_kpis": ["anio_mes", "event_type", "device"],
    "rt_kpis_por_zona": ["-alertas_operativas", "-riesgo_promedio_pct", "zona"],
    "rt_toneladas_por_hora": ["fecha_evento", "hora_evento"],
    "rt_estado_flota": ["-total_eventos", "estado_entrega"],
    "rt_alertas_operativas": ["-riesgo_retraso_pct", "-tiempo_espera_min", "event_id"],
}
# These grow with the customers or events, so their extract is a folder of files; all others are bounded by
# months, categories, zones and the like, and are one file.
FOLDER_EXTRACTS = frozenset({"promedio_venta_cliente", "pareto_80_clientes", "rt_alertas_operativas"})

# Published data sets, in publishing order.
PUBLISHED = [*GOLD_TABLES, GOLD_CATALOG, *FLEET_TABLES, FLEET_CATALOG]


@dataclass(frozen=True)
class LakeConfig:
    """One run of the lake. ``root`` may be any Hadoop-compatible URI."""

    root: str
    fmt: str = "parquet"
    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    topic: str = DEFAULT_TOPIC
    brokers: str = DEFAULT_BROKERS
    trigger: str = "10 seconds"
    runtime_seconds: int = 120
    # Most messages that a micro-batch takes from the topic; None: all that are there.
    max_offsets: int | None = None

    @classmethod
    def from_env(cls, **overrides) -> LakeConfig:
        env = os.environ  # Fixed values: the variable names below
        values = {
            "root": env.get("APP_HOME", os.getcwd()),
            "fmt": env.get("LAKE_FORMAT", "parquet"),
            "topic": env.get("KAFKA_TOPIC", DEFAULT_TOPIC),
            "brokers": env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BROKERS),
            "runtime_seconds": int(env.get("STREAMING_RUNTIME_SECONDS", "120")),
        }
        return cls(**{**values, **overrides})

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), "data", *parts])

    def landing(self, dataset: str) -> str:
        return self.path(LANDING[dataset][0])

    def bronze(self, table: str) -> str:
        return self.path("bronze", table)

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)

    def live(self, table: str) -> str:
        """Tables that a stream keeps current; the batch jobs write to ``gold`` only."""
        return self.path("live", table)

    def extract(self, table: str) -> str:
        return self.path("powerbi", table)

    def checkpoint(self, query: str) -> str:
        return self.path("checkpoints", query)
