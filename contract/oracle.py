"""The registered queries stated independently in SQL over the same tables."""

from __future__ import annotations


def r(expression: str, places: int = 2) -> str:
    """Round half up on the decimal reading."""
    return f"cast(round(cast({expression} as decimal(28,8)), {places}) as double)"


def month(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m')"


def with_ctes(ctes: dict[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in ctes.items()) + "\n" + body


# --- sales ----------------------------------------------------------------------------------------

LINES = """
select l_orderkey * 10 + l_linenumber as id_venta, l_partkey as id_producto, cast(l_quantity as int) as cantidad,
       l_extendedprice as monto, cast(l_shipdate as date) as fecha_venta, l_quantity, l_suppkey, l_orderkey
from lineitem
"""
NEWEST = """
select * exclude (rn) from (
  select *, row_number() over (partition by id_venta
    order by fecha_venta desc, monto desc, id_producto desc, l_suppkey desc) as rn
  from lines) where rn = 1
"""
CONTEXT = """
select o_orderkey, o_custkey as id_cliente, substr(o_orderpriority, 3) as canal, n_name as pais,
       lower(c_mktsegment) as categoria
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def sale_columns(lines: str) -> str:
    return f"""
select id_venta, id_cliente, id_producto, cantidad, {r("monto / l_quantity")} as precio_unitario, monto,
       fecha_venta, canal, pais, categoria
from {lines} join context on l_orderkey = o_orderkey
"""


VENTAS = f"""
select *, cast(year(fecha_venta) as int) as anio, cast(month(fecha_venta) as int) as mes,
       {month("fecha_venta")} as anio_mes
from (select * from sold)
"""
PRODUCTOS = """
select case when p_partkey % 10 = 0 then -p_partkey else p_partkey end as id_producto, p_name as nombre_producto,
       lower(p_type) as categoria_producto, p_brand as proveedor, p_retailprice as precio_base,
       p_size % 2 = 0 as producto_activo
from part
"""
ENRICHED = f"""
select v.*, p.nombre_producto, p.categoria_producto, p.proveedor, p.precio_base, p.producto_activo,
       coalesce(p.categoria_producto, v.categoria) as categoria_final,
       {r("v.monto - p.precio_base * v.cantidad")} as margen_estimado
from ventas v left join productos p on v.id_producto = p.id_producto
"""
SALES = {
    "lines": LINES,
    "newest": NEWEST,
    "context": CONTEXT,
    "sold": sale_columns("newest"),
    "ventas": VENTAS,
    "productos": PRODUCTOS,
    "enriched": ENRICHED,
}


def on_sales(body: str, **more: str) -> str:
    return with_ctes({**SALES, **more}, body)


PARETO = {
    "clientes": f"""
select id_cliente, count(distinct id_venta) as cantidad_ventas,
       cast(round(cast(sum(monto) as decimal(28,8)), 2) as decimal(28,2)) as total
from enriched group by id_cliente
""",
    "acumulado": """
select *, sum(total) over (rows between unbounded preceding and unbounded following) as global_,
       row_number() over (order by total desc, id_cliente) as rk,
       sum(total) over (order by total desc range between unbounded preceding and current row) as acum
from clientes
""",
    "cuota": f"""
select *, {r("cast(acum as double) / cast(global_ as double)", 4)} as pct from acumulado
""",
    "pareto": f"""
select id_cliente, cantidad_ventas, cast(total as double) as total_comprado, cast(global_ as double) as ingreso_global,
       cast(rk as bigint) as ranking_cliente, cast(acum as double) as ingreso_acumulado,
       pct as porcentaje_acumulado, cast({r("pct * 100")} as varchar) || '%' as porcentaje_acumulado_label,
       case when pct <= 0.80 then 'Clientes que concentran el 80% del ingreso' else 'Resto de clientes' end
         as segmento_pareto
from cuota
""",
}

# --- landed (untidy) inputs -------------------------------------------------------------------------

RAW_SALES = """
select case when id_venta % 97 = 0 then 'abc' else cast(id_venta as varchar) end as id_venta,
       cast(id_cliente as varchar) as id_cliente, cast(id_producto as varchar) as id_producto,
       case when id_venta % 89 = 0 then '3.7' else cast(cantidad as varchar) end as cantidad,
       cast(precio_unitario as varchar) as precio_unitario,
       case when id_venta % 73 = 0 then '-1' when id_venta % 101 = 0 then '1e21' when id_venta % 103 = 0 then 'NaN'
         when id_venta % 79 = 0 then '' else cast(monto as varchar) end as monto,
       case when id_venta % 83 = 0 then '2026-13-01' else cast(fecha_venta as varchar) end as fecha_venta,
       '  ' || lower(canal) || ' ' as canal, ' ' || upper(pais) as pais, upper(categoria) || ' ' as categoria,
       fecha_venta as landed_on
from every_line
"""


def typed_sales(quantity: str) -> str:
    return f"""
select try_cast(id_venta as bigint) as id_venta, try_cast(id_cliente as bigint) as id_cliente,
       try_cast(id_producto as bigint) as id_producto, {quantity} as cantidad,
       try_cast(precio_unitario as double) as precio_unitario, try_cast(monto as double) as monto,
       try_cast(fecha_venta as date) as fecha_venta, upper(trim(canal)) as canal,
       upper(substr(trim(pais), 1, 1)) || lower(substr(trim(pais), 2)) as pais, lower(trim(categoria)) as categoria,
       landed_on
from raw
"""


STRICT = "case when regexp_matches(cantidad, '^-?[0-9]+$') then try_cast(cantidad as int) end"
LENIENT = "cast(trunc(try_cast(cantidad as double)) as int)"
SALES_OK = """id_venta is not null and id_cliente is not null and id_producto is not null and monto > 0 and abs(monto) < 1e12
  and cantidad > 0 and fecha_venta is not null"""


def raw_sales(quantity: str = STRICT) -> dict[str, str]:
    return {
        "lines": LINES,
        "context": CONTEXT,
        "every_line": sale_columns("lines"),
        "raw": RAW_SALES,
        "typed": typed_sales(quantity),
    }


SALE_TEXT = """id_venta, id_cliente, id_producto, cantidad, precio_unitario, monto,
       cast(fecha_venta as varchar) as fecha_venta, canal, pais, categoria"""
SALE_CALENDAR = f"""cast(year(fecha_venta) as int) as anio, cast(month(fecha_venta) as int) as mes,
       {month("fecha_venta")} as anio_mes"""
SILVER_SALES = f"""
select * exclude (rn) from (
  select *, row_number() over (partition by id_venta
    order by landed_on desc, id_cliente desc, id_producto desc, cantidad desc, precio_unitario desc, monto desc,
             fecha_venta desc, canal desc, pais desc, categoria desc) as rn
  from typed where {SALES_OK}) where rn = 1
"""

WEB = """
select event_id, user_id as id_cliente, 'sess_' || cast(user_id as varchar) || '_' || strftime(ts, '%Y-%m-%d')
       as session_id, '/' || event_type as page, event_type,
       case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end as device,
       ts as event_timestamp, 'web_api' as ingestion_source
from events
"""
RAW_WEB_TYPED = """
select case when event_id % 71 = 0 then null else event_id end as event_id,
       case when event_id % 61 = 0 then null else id_cliente end as id_cliente, session_id, lower(page) as page,
       lower(event_type) as event_type, device,
       case when event_id % 67 = 0 then null else event_timestamp end as event_timestamp, ingestion_source
from web
"""
WEB_OK = "event_id is not null and id_cliente is not null and event_timestamp is not null"
RAW_WEB = {"web": WEB, "typed": RAW_WEB_TYPED}

RAW_PRODUCTS_TYPED = """
select p_partkey as id_producto, trim(p_name) as nombre_producto, lower(trim(p_type)) as categoria,
       trim(p_brand) as proveedor, case when p_partkey % 53 = 0 then 0.0 else p_retailprice end as precio_base,
       p_partkey % 7 <> 0 and p_size % 3 <> 1 as activo
from part
"""
RAW_PRODUCTS = {"typed": RAW_PRODUCTS_TYPED}
PRODUCTS_OK = "id_producto is not null and precio_base > 0"

# --- fleet ----------------------------------------------------------------------------------------

POSITIONS = """
select event_id, user_id, ts, 'CAM-' || lpad(cast(user_id % 35 + 1 as varchar), 3, '0') as camion,
       case event_id % 5 when 0 then 'Centro_Distribucion' when 1 then 'Ruta_Atlantico' when 2 then 'Ruta_Pacifico'
         when 3 then 'Zona_Oriente' else 'Zona_Occidente' end as zona,
       case event_id % 5 when 0 then 14.6349 when 1 then 14.7200 when 2 then 14.3000 when 3 then 14.9667
         else 14.8333 end as base_lat,
       case event_id % 5 when 0 then -90.5069 when 1 then -90.3500 when 2 then -90.7800 when 3 then -89.5333
         else -91.5167 end as base_lon,
       cast(case event_id % 5 when 0 then 0.10 when 1 then 0.35 when 2 then 0.28 when 3 then 0.45 else 0.30 end
         as double) as base_risk,
       cast(case user_id % 7 when 0 then 8 when 1 then 10 when 2 then 12 when 3 then 15 when 4 then 18 when 5 then 20
         else 25 end as double) as capacidad_toneladas,
       ((event_id * 11) % 1000 - 500) / 10000.0::double as drift,
       cast((event_id * 53) % 9500 as double) / 100.0::double as velocidad,
       cast((event_id * 29) % 91 as int) as tiempo_espera_min,
       case when (event_id * 7 + user_id) % 20 < 11 then 'EN_RUTA' when (event_id * 7 + user_id) % 20 < 15 then 'EN_PATIO'
         when (event_id * 7 + user_id) % 20 < 18 then 'DESCARGANDO' else 'FINALIZADO' end as estado_entrega,
       cast((event_id * 17) % 1500 as double) / 10000.0::double as jitter
from events
"""
LOADED = f"""
select *, {r("capacidad_toneladas * ((event_id * 31) % 97 + 3) / 100")} as toneladas,
       least(1.0::double, base_risk
         + case when velocidad < 15 and estado_entrega = 'EN_RUTA' then 0.25::double else 0.0::double end
         + case when tiempo_espera_min > 45 then 0.20::double else 0.0::double end + jitter) as raw_risk
from positions
"""
GPS = f"""
select cast(event_id as int) as event_id, ts as timestamp_evento, camion, zona,
       {r("cast(base_lat as double) + drift", 6)} as lat, {r("cast(base_lon as double) + drift", 6)} as lon,
       toneladas, capacidad_toneladas, {r("toneladas / capacidad_toneladas * 100")} as ocupacion_pct, velocidad,
       estado_entrega, tiempo_espera_min, {r("raw_risk", 4)} as riesgo_retraso, raw_risk < 0.55 as entrega_a_tiempo,
       'gps_iot_simulado' as fuente
from loaded
"""
PREPARED = f"""
select *, cast(timestamp_evento as date) as fecha_evento, cast(hour(timestamp_evento) as int) as hora_evento,
       {month("timestamp_evento")} as anio_mes,
       case when riesgo_retraso >= 0.75 then 'ALTO' when riesgo_retraso >= 0.50 then 'MEDIO' else 'BAJO' end
         as nivel_riesgo,
       riesgo_retraso >= 0.75 or tiempo_espera_min >= 60 or (velocidad <= 10 and estado_entrega = 'EN_RUTA')
         as alerta_operativa
from gps
"""
FLEET = {"positions": POSITIONS, "loaded": LOADED, "gps": GPS, "prepared": PREPARED}


def on_fleet(body: str) -> str:
    return with_ctes(FLEET, body)


def count_if(condition: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint)"


ON_TIME = r(
    "cast(sum(case when entrega_a_tiempo then 1 else 0 end) as double) / cast(count(*) as double) * 100"
)
FLEET_OVERALL = on_fleet(f"""
select count(*) as total_eventos_gps, count(distinct camion) as camiones_activos,
       {r("sum(toneladas)")} as toneladas_transportadas, {r("avg(velocidad)")} as velocidad_promedio,
       {r("avg(tiempo_espera_min)")} as tiempo_espera_promedio_min, {r("avg(ocupacion_pct)")} as ocupacion_promedio_pct,
       {r("avg(riesgo_retraso) * 100")} as riesgo_retraso_promedio_pct, {ON_TIME} as entregas_a_tiempo_pct,
       {count_if("alerta_operativa")} as total_alertas_operativas,
       {count_if("nivel_riesgo = 'ALTO'")} as eventos_riesgo_alto
from prepared
""")
FLEET_ZONE = on_fleet(f"""
select zona, count(*) as total_eventos, count(distinct camion) as camiones_activos,
       {r("sum(toneladas)")} as toneladas_transportadas, {r("avg(velocidad)")} as velocidad_promedio,
       {r("avg(tiempo_espera_min)")} as tiempo_espera_promedio_min, {r("avg(ocupacion_pct)")} as ocupacion_promedio_pct,
       {r("avg(riesgo_retraso) * 100")} as riesgo_promedio_pct, {count_if("alerta_operativa")} as alertas_operativas,
       {ON_TIME} as entregas_a_tiempo_pct
from prepared group by zona order by alertas_operativas desc, riesgo_promedio_pct desc, zona
""")
HOURLY = f"""
select cast(fecha_evento as varchar) as fecha_evento, hora_evento, count(*) as total_eventos,
       count(distinct camion) as camiones_activos, {r("sum(toneladas)")} as toneladas_por_hora,
       {r("avg(velocidad)")} as velocidad_promedio, {r("avg(ocupacion_pct)")} as ocupacion_promedio_pct
from prepared
"""
FLEET_ALERTS = on_fleet(f"""
select *, case when riesgo_retraso_pct >= 75 then 'RIESGO_ALTO_RETRASO'
               when tiempo_espera_min >= 60 then 'ESPERA_PROLONGADA'
               when velocidad <= 10 and estado_entrega = 'EN_RUTA' then 'POSIBLE_DETENCION_EN_RUTA'
               else 'ALERTA_OPERATIVA' end as tipo_alerta
from (select event_id, timestamp_evento, camion, zona, lat, lon, toneladas, capacidad_toneladas, ocupacion_pct,
             velocidad, estado_entrega, tiempo_espera_min, {r("riesgo_retraso * 100")} as riesgo_retraso_pct,
             nivel_riesgo, entrega_a_tiempo
      from prepared where alerta_operativa)
order by riesgo_retraso_pct desc, tiempo_espera_min desc, event_id
""")
EXTREME = "event_id % 113 = 0 or event_id % 109 = 0 or event_id % 107 = 0 or event_id % 127 = 0"
PUBLISHED = f"""
select 'kpis_generales' as dataset, cast(1 as bigint) as record_count
union all select 'ventas_mensuales', count(distinct anio_mes) from ventas
union all select 'cliente_mayor_volumen', 1
union all select 'top10_ventas', least(10, count(*)) from ventas
union all select 'promedio_venta_cliente', count(distinct id_cliente) from ventas
union all select 'pareto_80_clientes', count(distinct id_cliente) from ventas
union all select 'resumen_pareto', count(distinct segmento_pareto) from pareto
union all select 'ventas_categoria_canal', count(*) from (select distinct categoria_final, canal from enriched)
union all select 'web_kpis', count(*) from (
  select distinct {month("event_timestamp")}, event_type, device from web)"""
BAD, ODD = "event_id % 101 = 0", "event_id % 103 = 0"
PARSED_FIELDS = ",\n       ".join(
    [
        f"case when {BAD} then null else {name} end as {name}"
        if name != "velocidad"
        else f"case when {BAD} or {ODD} then null else velocidad end as velocidad"
        for name in (
            "event_id timestamp_evento camion zona lat lon toneladas capacidad_toneladas ocupacion_pct velocidad "
            "estado_entrega tiempo_espera_min riesgo_retraso entrega_a_tiempo fuente"
        ).split()
    ]
)
MESSAGE_ID = "'gpscamiones' as _topic, cast(event_id % 3 as int) as _partition, cast(event_id // 3 as bigint) as _offset"
PARSED = f"""
select {PARSED_FIELDS},
       {MESSAGE_ID}, timestamp_evento as _kafka_timestamp, camion as _message_key
"""


def quality_row(table: str, rule: str, count: str) -> str:
    return f"select 'silver' as layer, '{table}' as table_name, ({count}) as record_count, '{rule}' as quality_rule"


def nested(ctes: dict[str, str], body: str) -> str:
    return f"select count(*) from ({with_ctes(ctes, body)})"


def rule_hits(ctes: dict[str, str], rules: dict[str, str]) -> str:
    parts = [
        f"select '{name}' as quality_rule, {count_if(sql)} as passed, {count_if(f'({sql}) is not true')} as failed "
        "from typed"
        for name, sql in rules.items()
    ]
    return "select * from (" + with_ctes(ctes, " union all ".join(parts)) + ")"


SALES_RULES = {
    "id_venta presente": "id_venta is not null",
    "id_cliente presente": "id_cliente is not null",
    "id_producto presente": "id_producto is not null",
    "monto positivo": "monto > 0",
    "monto en rango": "monto is null or abs(monto) < 1e12",
    "cantidad positiva": "cantidad > 0",
    "fecha_venta presente": "fecha_venta is not null",
}
FAILED_RULES = (
    "concat_ws('|', "
    + ", ".join(f"case when ({sql}) is not true then '{name}' end" for name, sql in SALES_RULES.items())
    + ")"
)
CSV_SALE_COLUMNS = SALE_TEXT
WEB_SILVER_COLUMNS = f"""*, cast(cast(event_timestamp as date) as varchar) as fecha_evento,
       {month("event_timestamp")} as anio_mes"""

CUSTOMER_SUMS = f"""{r("sum(monto)")} as total_comprado, {r("avg(monto)")}"""
SALES_MEASURES = f"""count(distinct id_venta) as total_ventas, count(distinct id_cliente) as clientes_unicos,
       {r("sum(monto)")} as ingreso_total, {r("avg(monto)")} as ticket_promedio,
       cast(sum(cantidad) as bigint) as unidades_vendidas"""

OVERALL = on_sales(f"""
select count(distinct id_venta) as total_ventas, count(distinct id_cliente) as clientes_unicos,
       count(distinct id_producto) as productos_vendidos, {r("sum(monto)")} as ingreso_total,
       {r("avg(monto)")} as ticket_promedio, {r("max(monto)")} as venta_maxima, {r("min(monto)")} as venta_minima,
       cast(sum(cantidad) as bigint) as unidades_vendidas, {r("avg(margen_estimado)")} as margen_promedio_estimado
from enriched""")
TOP10 = on_sales("""
select id_venta, id_cliente, id_producto, nombre_producto, categoria_final, canal, pais,
       cast(fecha_venta as varchar) as fecha_venta, cantidad, precio_unitario, monto, cast(rn as int) as ranking_venta
from (select *, row_number() over (order by monto desc, id_venta) as rn from enriched) where rn <= 10
order by rn""")

MONTHLY = on_sales(f"""
select anio_mes, {SALES_MEASURES}, {r("sum(margen_estimado)")} as margen_estimado_total
from enriched group by anio_mes order by anio_mes""")
CHANNELS = on_sales(f"""
select categoria_final, canal, {SALES_MEASURES}
from enriched group by categoria_final, canal order by ingreso_total desc, categoria_final, canal""")
WEB_ACTIVITY =     with_ctes(
        {"web": WEB},
        f"""
select {month("event_timestamp")} as anio_mes, event_type, device, count(distinct event_id) as total_eventos,
       count(distinct id_cliente) as clientes_unicos, count(distinct session_id) as sesiones_unicas
from web group by 1, 2, 3 order by 1, 2, 3""",
    )
# Ids from 1 on are in groups of 32,768, from group 1 on.
ID_GROUP = "case when id_cliente > 0 then 1 + (id_cliente - 1) // 32768 else id_cliente // 32768 end"
ROLLUP_ROWS = on_sales(f"""
select 'meses por cliente' as rollup, count(distinct (anio_mes, id_cliente)) as record_count from enriched
union all select 'meses con mapas', count(distinct (anio_mes, {ID_GROUP})) from enriched
union all select 'canales por cliente', count(distinct (categoria_final, canal, id_cliente)) from enriched
union all select 'canales con mapas', count(distinct (categoria_final, canal, {ID_GROUP})) from enriched""")
SILVER = with_ctes({**raw_sales(), "silver": SILVER_SALES}, f"select {SALE_TEXT}, {SALE_CALENDAR} from silver")
ENRICHED = on_sales("select * replace (cast(fecha_venta as varchar) as fecha_venta) from enriched")
FLEET_HOUR = on_fleet(f"{HOURLY} group by 1, 2 order by 1, 2")
FLEET_STATUS = on_fleet(f"""
select estado_entrega, count(*) as total_eventos, count(distinct camion) as camiones,
       {r("sum(toneladas)")} as toneladas, {r("avg(tiempo_espera_min)")} as tiempo_espera_promedio_min
from prepared group by estado_entrega order by total_eventos desc, estado_entrega""")


def near(exact: str, trucks: str) -> str:
    """A table whose numbers of trucks are estimated: in place of them, that each is near the exact one."""
    return f"select * exclude ({trucks}), true as cerca from ({exact})"


RULE_HITS = " union all ".join(
    [
        rule_hits(raw_sales(), SALES_RULES),
        rule_hits(
            RAW_WEB,
            {f"{c} presente": f"{c} is not null" for c in ("event_id", "id_cliente", "event_timestamp")},
        ),
        rule_hits(
            RAW_PRODUCTS,
            {"id_producto presente": "id_producto is not null", "precio_base positivo": "precio_base > 0", "precio_base en rango": "precio_base is null or abs(precio_base) < 1e9"},
        ),
    ]
)
# What each rule on events with extreme values rejects.
FLEET_BROKEN = {
    "event_id presente": "false",
    "camion presente": "false",
    "timestamp_evento presente": "false",
    "toneladas en rango": "event_id % 127 = 0",
    "capacidad_toneladas en rango": "false",
    "ocupacion_pct en rango": "false",
    "velocidad en rango": "event_id % 113 = 0 or event_id % 109 = 0",
    "riesgo_retraso en rango": "event_id % 107 = 0",
}
FLEET_RULE_HITS = " union all ".join(
    f"select '{name}' as quality_rule, count(*) filter (not ({sql})) as passed, count(*) filter ({sql}) as failed from gps"
    for name, sql in FLEET_BROKEN.items()
)


ORACLE: dict[str, str] = {
    "dedup_sales": with_ctes(
        {"lines": LINES, "newest": NEWEST},
        "select * exclude (l_quantity) replace (cast(fecha_venta as varchar) as fecha_venta) from newest",
    ),
    "clean_sales": with_ctes(raw_sales(), f"select {SALE_TEXT}, {SALE_CALENDAR} from typed where {SALES_OK}"),
    "clean_sales_lenient": with_ctes(
        raw_sales(LENIENT), f"select id_venta, id_cliente, id_producto, cantidad, monto from typed where {SALES_OK}"
    ),
    "clean_sales_rejects": with_ctes(
        raw_sales(), f"select {SALE_TEXT}, {FAILED_RULES} as failed_rules from typed where ({SALES_OK}) is not true"
    ),
    "silver_sales": SILVER,
    "silver_sales_in_buckets": SILVER,
    "clean_web": with_ctes(RAW_WEB, f"select {WEB_SILVER_COLUMNS} from typed where {WEB_OK}"),
    "clean_products": with_ctes(RAW_PRODUCTS, f"select * from typed where {PRODUCTS_OK}"),
    "enrich_sales": ENRICHED,
    "enrich_sales_in_buckets": ENRICHED,
    "kpi_overall": OVERALL,
    "kpi_monthly": MONTHLY,
    "kpi_monthly_bitmap": MONTHLY,
    "kpi_customer": on_sales(f"""
select id_cliente, count(distinct id_venta) as cantidad_ventas, {CUSTOMER_SUMS} as monto_promedio_venta,
       {r("max(monto)")} as mayor_compra, {r("min(monto)")} as menor_compra
from enriched group by id_cliente order by total_comprado desc, id_cliente"""),
    "kpi_category_channel": CHANNELS,
    "kpi_category_channel_bitmap": CHANNELS,
    "kpi_web": WEB_ACTIVITY,
    "kpi_web_bitmap": WEB_ACTIVITY,
    "kpi_overall_bitmap": OVERALL,
    "rollup_rows": ROLLUP_ROWS,
    "top_customer": on_sales(f"""
select *, cast(1 as int) as ranking_cliente from (
  select id_cliente, count(distinct id_venta) as cantidad_compras, {CUSTOMER_SUMS} as ticket_promedio_cliente,
         cast(sum(cantidad) as bigint) as unidades_compradas
  from enriched group by id_cliente order by total_comprado desc, id_cliente limit 1)"""),
    "top10_sales": TOP10,
    "pareto_customers": on_sales("select * from pareto order by ranking_cliente", **PARETO),
    "pareto_summary": on_sales(
        f"""
select segmento_pareto, count(distinct id_cliente) as cantidad_clientes,
       {r("sum(total_comprado)")} as ingreso_segmento,
       {r("max(porcentaje_acumulado) * 100")} as porcentaje_acumulado_maximo
from pareto group by segmento_pareto order by ingreso_segmento desc""",
        **PARETO,
    ),
    "gps_scored": on_fleet("select * from gps"),
    "gps_prepared": on_fleet("""
select event_id, camion, timestamp_evento, cast(fecha_evento as varchar) as fecha_evento, hora_evento, anio_mes,
       nivel_riesgo, alerta_operativa from prepared"""),
    "fleet_overall": FLEET_OVERALL,
    "fleet_zone": FLEET_ZONE,
    "fleet_hour": FLEET_HOUR,
    "fleet_status": FLEET_STATUS,
    "fleet_hour_sketch": near(FLEET_HOUR, "camiones_activos"),
    "fleet_zone_sketch": near(FLEET_ZONE, "camiones_activos"),
    "stream_fleet_hour": FLEET_HOUR,
    "stream_fleet_status_sketch": near(FLEET_STATUS, "camiones"),
    "fleet_alerts": FLEET_ALERTS,
    "fleet_overall_extremes": FLEET_OVERALL.replace("from prepared", f"from prepared where not ({EXTREME})"),
    "fleet_rejects": on_fleet(f"""
select event_id, camion, concat_ws('|',
    case when event_id % 127 = 0 then 'toneladas en rango' end,
    case when event_id % 113 = 0 or event_id % 109 = 0 then 'velocidad en rango' end,
    case when event_id % 107 = 0 then 'riesgo_retraso en rango' end) as failed_rules
from gps where {EXTREME}"""),
    "gps_messages": on_fleet("select camion as key, * exclude (timestamp_evento) from gps"),
    "gps_parse_json": on_fleet(f"{PARSED} from gps"),
    "gps_unreadable": on_fleet(f"""
select {MESSAGE_ID}, camion as _message_key, 'no json' as _raw_message from gps where {BAD}"""),
    "stream_bronze": on_fleet(
        f"{PARSED}, 'GPS_IOT_KAFKA' as _source_system, 'JSON_STREAM' as _source_format from gps"
    ),
    "stream_alerts": FLEET_ALERTS,
    "stream_hourly": FLEET_HOUR,
    "stream_dedup": on_fleet(f"select {MESSAGE_ID}, event_id, camion, timestamp_evento from gps"),
    "stream_fleet_overall": FLEET_OVERALL,
    "stream_fleet_zone": FLEET_ZONE,
    "bronze_stamp": """
select 'ERP_POS' as _source_system, 'CSV' as _source_format, 'batch-1' as _batch_id, count(*) as rows,
       cast(1 as bigint) as moments
from lineitem join orders on l_orderkey = o_orderkey""",
    "layer_roundtrip_csv": with_ctes(raw_sales(), f"select {CSV_SALE_COLUMNS} from typed where {SALES_OK}"),
    "layer_roundtrip_json": with_ctes({"web": WEB}, "select * from web"),
    "bronze_json_untidy": with_ctes(
        {
            "web": WEB,
            "kind": """
select *, case when event_id % 11 = 0 or event_id % 13 = 0 then 'plain' when event_id % 17 = 0 then 'extra'
  when event_id % 19 = 0 then 'broken' else 'plain' end as kind from web""",
        },
        """
select case when kind <> 'broken' then event_id end as event_id, case when kind <> 'broken' then id_cliente end as id_cliente,
       case when kind <> 'broken' then page end as page, case when kind <> 'broken' then event_timestamp end as event_timestamp,
       kind = 'extra' as has_extra, case when kind = 'broken' then '{broken ' || event_id::varchar end as unread
from kind""",
    ),
    "layer_roundtrip_xml": with_ctes(RAW_PRODUCTS, f"select * from typed where {PRODUCTS_OK}"),
    "layer_roundtrip_xml_split": with_ctes(RAW_PRODUCTS, f"select * from typed where {PRODUCTS_OK}"),
    "month_partitions": on_sales(f"""
select anio_mes, count(*) as ventas, {r("sum(monto)")} as ingreso_total, cast(max(fecha_venta) as varchar) as hasta
from ventas group by anio_mes"""),
    "top10_sales_of_table": TOP10,
    "kpi_overall_of_table": OVERALL,
    "quality_report": " union all ".join(
        [
            quality_row(
                "ventas",
                "ventas limpias, monto positivo, fecha válida, sin duplicados por id_venta",
                nested({**raw_sales(), "silver": SILVER_SALES}, "select * from silver"),
            ),
            quality_row(
                "web_events",
                "eventos con id_cliente, event_id y timestamp válido",
                nested(RAW_WEB, f"select * from typed where {WEB_OK}"),
            ),
            quality_row(
                "productos",
                "productos activos/inactivos normalizados y precio válido",
                nested(RAW_PRODUCTS, f"select * from typed where {PRODUCTS_OK}"),
            ),
            quality_row(
                "ventas_enriquecidas",
                "ventas unidas con catálogo de productos para analítica final",
                nested(SALES, "select * from enriched"),
            ),
        ]
    ),
    "quality_rule_hits": RULE_HITS,
    "silver_rule_hits": RULE_HITS,
    "fleet_rule_hits": on_fleet(FLEET_RULE_HITS),
    "json_unknown_fields": with_ctes(
        {"web": WEB},
        "select 'campo_nuevo' as campo, 'BIGINT' as tipo, count(*) as filas from web "
        "where event_id % 17 = 0 and event_id % 11 <> 0 and event_id % 13 <> 0",
    ),
    "json_unknown_values": with_ctes(
        {"web": WEB},
        "select event_id, cast(1 as bigint) as campo_nuevo, page from web "
        "where event_id % 17 = 0 and event_id % 11 <> 0 and event_id % 13 <> 0",
    ),
    "post_write_check": on_sales(
        f"select dataset as table_name, record_count > 0 as has_rows from ({PUBLISHED}) "
        "union all select 'rt_alertas_operativas', false",
        **PARETO,
        web=WEB,
    ),
    "stream_bounded_run": on_fleet(f"select {MESSAGE_ID}, event_id, camion, timestamp_evento, true as ended from gps"),
    "publish_gold": on_sales(PUBLISHED, **PARETO, web=WEB),
    "publish_manifest": on_sales(
        f"""
select dataset, 'EXPORTED' as status, 'Exportado correctamente' as message, record_count from ({PUBLISHED})
union all select 'catalogo_gold', 'EXPORTED', 'Exportado correctamente', 9
union all select unnest(['rt_kpis_generales', 'rt_kpis_por_zona', 'rt_toneladas_por_hora', 'rt_estado_flota',
  'rt_alertas_operativas', 'rt_catalogo']), 'SKIPPED', 'Carpeta no encontrada', null""",
        **PARETO,
        web=WEB,
    ),
    "publish_catalog": on_sales(
        f"""
select 'gold_' || dataset as table_name, 'data/powerbi/' || dataset as powerbi_path, 'gold' as layer, record_count
from ({PUBLISHED})""",
        **PARETO,
        web=WEB,
    ),
    "publish_pareto": on_sales("select *, true as in_order from pareto", **PARETO),
    "bronze_audit": """
select 'bronze' as layer, 'ventas' as dataset, 'CSV' as source_format, 'data/bronze/ventas' as target_path,
       count(*) as record_count, true as this_batch from lineitem join orders on l_orderkey = o_orderkey
union all select 'bronze', 'web_events', 'JSON', 'data/bronze/web_events', count(*), true from events
union all select 'bronze', 'productos', 'XML', 'data/bronze/productos', count(*), true from part""",
}
