"""Column names and types of the inputs."""

SALES_RAW = [
    "id_venta",
    "id_cliente",
    "id_producto",
    "cantidad",
    "precio_unitario",
    "monto",
    "fecha_venta",
    "canal",
    "pais",
    "categoria",
    "created_at",
]

WEB_RAW = [
    "event_id",
    "id_cliente",
    "session_id",
    "page",
    "event_type",
    "device",
    "event_timestamp",
    "ingestion_source",
]

PRODUCT_ROW_TAG = "producto"
PRODUCT_RAW = ["id_producto", "nombre_producto", "categoria", "proveedor", "precio_base", "activo"]

ENVELOPE = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"

GPS_MESSAGE = (
    "event_id int, timestamp_evento string, camion string, zona string, lat double, lon double, "
    "toneladas double, capacidad_toneladas double, ocupacion_pct double, velocidad double, "
    "estado_entrega string, tiempo_espera_min int, riesgo_retraso double, entrega_a_tiempo boolean, "
    "fuente string"
)
GPS_COLUMNS = [field.split()[0] for field in GPS_MESSAGE.split(", ")]
