"""Plain-SQL oracles (DuckDB dialect) for the registered queries.

Each oracle = the fixture derivation as CTE text + the operator written the
straightforward way with the engine's own built-ins (ROW_NUMBER, NTILE,
NOT EXISTS, global windows), so it never mirrors the Spark method.
"""

from __future__ import annotations

import hashlib

FIXTURES = """
proveedores AS (
  SELECT CAST(s.s_suppkey AS INTEGER) AS id_proveedor, s.s_name AS razon_social, n.n_name AS pais_origen,
         CAST(1 + s.s_suppkey % 15 AS INTEGER) AS tiempo_repo_dias,
         CAST(300 + s.s_suppkey % 201 AS DOUBLE) / 100 AS calificacion_calidad, 1 AS activo
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
articulos AS (
  SELECT CAST(p.p_partkey AS INTEGER) AS art_id,
         '770' || lpad(CAST(p.p_partkey AS VARCHAR), 9, '0') AS cod_barra,
         p.p_name AS desc_art,
         CASE p.p_partkey % 10 WHEN 1 THEN 'TEC' WHEN 2 THEN 'ROPA' ELSE p.p_type END AS id_categ_n1, p.p_brand AS id_categ_n2, p.p_size AS id_categ_n3,
         CAST(ls.x_supp AS INTEGER) AS id_proveedor,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS precio_lista,
         CAST(p.p_size AS DECIMAL(8,2)) AS peso_kg,
         CASE p.p_partkey % 4 WHEN 0 THEN 'UN' WHEN 1 THEN 'KG' WHEN 2 THEN 'LITRO' ELSE 'CAJA' END AS unid_medida,
         CASE WHEN p.p_partkey % 17 = 0 THEN NULL ELSE 1 END AS activo,
         DATE '1995-01-01' + CAST(p.p_partkey % 181 AS INTEGER) AS fec_alta
  FROM part p LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS x_supp FROM lineitem GROUP BY l_partkey) ls
    ON p.p_partkey = ls.l_partkey),
tiendas AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS id_tienda, n.n_name AS nom_tienda,
         CASE n.n_nationkey % 3 WHEN 0 THEN ' Hipermercado' WHEN 1 THEN 'supermercado ' ELSE 'Conveniencia' END
           AS tipo_tienda,
         CASE n.n_nationkey % 7 WHEN 0 THEN 'Bogota' WHEN 1 THEN 'CDMX' WHEN 2 THEN 'Santiago' WHEN 3 THEN 'Lima'
           WHEN 4 THEN 'Quito' WHEN 5 THEN 'Otra' ELSE NULL END AS id_ciudad,
         CASE WHEN n.n_nationkey % 6 = 5 THEN NULL ELSE r.r_name END AS id_pais,
         CAST(100 + n.n_nationkey * 137 % 3401 AS INTEGER) AS metros_cuadrados, 1 AS activo,
         DATE '1990-01-01' + CAST(n.n_nationkey * 61 AS INTEGER) AS fec_apertura
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
miembros AS (
  SELECT CAST(c.c_custkey AS INTEGER) AS id_miembro,
         DATE '1994-01-01' + CAST(c.c_custkey % 201 AS INTEGER) AS fec_registro,
         n.n_name AS id_ciudad,
         CASE c.c_custkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'Masculino' WHEN 2 THEN 'F' WHEN 3 THEN 'Femenino'
           ELSE NULL END AS genero,
         CASE c.c_custkey % 7 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-50' WHEN 3 THEN '51+'
           ELSE NULL END AS rango_edad,
         c.c_mktsegment AS canal_pref,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 13 = 0 THEN 0 ELSE 1 END AS activo,
         lo.fec_ultima_compra
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS fec_ultima_compra FROM orders GROUP BY o_custkey) lo
    ON c.c_custkey = lo.o_custkey),
lineas AS (
  SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
ventas_raw AS (
  SELECT CASE WHEN l_orderkey % 211 = 0 AND l_linenumber = 1 THEN NULL
              ELSE CAST(l_orderkey * 10 + l_linenumber AS BIGINT) END AS id_trans,
         CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS id_miembro,
         CASE WHEN l_partkey % 97 = 0 THEN -1 WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(c_nationkey AS INTEGER) END
           AS id_tienda,
         CAST(CASE WHEN l_partkey % 83 = 0 THEN -l_partkey ELSE l_partkey END AS INTEGER) AS art_id,
         CAST(o_orderdate AS DATE) AS fec_trans,
         lpad(CAST(8 + l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS hra_trans,
         CAST(l_quantity AS INTEGER) AS qty_vendida,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS precio_unitario_venta,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_discount * 100 AS DECIMAL(12,2)) END AS descuento_aplicado,
         o_orderpriority AS tipo_pago,
         CASE o_orderstatus WHEN 'F' THEN 'Fisico' WHEN 'O' THEN 'Online' WHEN 'P' THEN 'App' END AS canal_venta,
         CAST(l_suppkey AS BIGINT) AS x_supp, CAST(l_shipdate AS DATE) AS x_ship
  FROM lineas),
stock_raw AS (
  SELECT (CAST(art_id AS BIGINT) * 100 + id_tienda) * 100000000 + CAST(strftime(fec_snapshot, '%Y%m%d') AS BIGINT)
           AS id_snapshot,
         art_id, id_tienda, fec_snapshot,
         CAST((art_id * 7 + id_tienda * 13 + day(fec_snapshot)) % 500 AS INTEGER) AS stock_fisico,
         CASE WHEN art_id % 9 = 0 THEN NULL WHEN art_id % 13 = 0 THEN 'N/D'
              ELSE CAST(art_id % 100 AS VARCHAR) END AS stock_transito,
         CAST(id_tienda % 50 AS INTEGER) AS stock_reservado,
         CAST(10 + art_id % 40 AS INTEGER) AS stock_minimo_config,
         CAST(100 + art_id % 500 AS INTEGER) AS stock_maximo_config
  FROM (SELECT DISTINCT CAST(l_partkey AS INTEGER) AS art_id, CAST(c_nationkey AS INTEGER) AS id_tienda,
               CAST(o_orderdate AS DATE) + CAST(l_linenumber % 2 AS INTEGER) AS fec_snapshot FROM lineas) k),
devoluciones_raw AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id_devolucion,
         CASE WHEN l_partkey % 19 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(l_orderkey * 10 + l_linenumber AS BIGINT) END
           AS id_trans_origen,
         CAST(l_partkey AS INTEGER) AS art_id, CAST(l_suppkey % 25 AS INTEGER) AS id_tienda,
         CAST(l_shipdate AS DATE) AS fec_devolucion,
         CAST(1 + CAST(l_quantity AS INTEGER) % 2 AS INTEGER) AS qty_devuelta,
         CASE l_linenumber WHEN 1 THEN ' def ' WHEN 2 THEN 'DEFECTUOSO' WHEN 3 THEN 'tal' WHEN 4 THEN 'Talla'
           WHEN 5 THEN 'ERR' WHEN 6 THEN 'error' WHEN 7 THEN 'ARREPENTIMIENTO' END AS motivo_cod,
         CASE l_partkey % 3 WHEN 0 THEN 'Tienda' WHEN 1 THEN 'Correo' ELSE 'Casillero' END AS canal_devolucion,
         CASE l_suppkey % 3 WHEN 0 THEN 'APROBADO' WHEN 1 THEN 'PENDIENTE' ELSE 'RECHAZADO' END AS estado_devolucion,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS vr_reembolso
  FROM lineitem WHERE l_returnflag = 'R')
"""

SILVER = """
ventas_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY id_trans ORDER BY x_ship DESC NULLS LAST, art_id DESC NULLS LAST,
      x_supp DESC NULLS LAST, id_tienda DESC NULLS LAST, id_miembro DESC NULLS LAST, fec_trans DESC NULLS LAST,
      qty_vendida DESC NULLS LAST, precio_unitario_venta DESC NULLS LAST, descuento_aplicado DESC NULLS LAST,
      tipo_pago DESC NULLS LAST, canal_venta DESC NULLS LAST, hra_trans DESC NULLS LAST) AS rn
    FROM ventas_raw) WHERE rn = 1),
ventas_limpias AS (
  SELECT id_trans, id_miembro, id_tienda, art_id, fec_trans, hra_trans, qty_vendida, precio_unitario_venta,
         coalesce(descuento_aplicado, CAST(0 AS DECIMAL(12,2))) AS descuento_aplicado, tipo_pago, canal_venta,
         qty_vendida * precio_unitario_venta - coalesce(descuento_aplicado, CAST(0 AS DECIMAL(12,2)))
           AS vr_total_trans
  FROM ventas_dedup),
ventas_ok AS (
  SELECT v.* FROM ventas_limpias v
  WHERE v.id_trans IS NOT NULL
    AND EXISTS (SELECT 1 FROM articulos a WHERE a.art_id = v.art_id)
    AND EXISTS (SELECT 1 FROM tiendas t WHERE t.id_tienda = v.id_tienda)),
ventas_rechazadas AS (
  SELECT v.*, CASE WHEN v.id_trans IS NULL THEN 'ERROR_LLAVE_NULA'
                   ELSE 'ERROR_INTEGRIDAD_REFERENCIAL_ART_O_TIENDA' END AS motivo_rechazo
  FROM ventas_limpias v
  WHERE NOT EXISTS (SELECT 1 FROM ventas_ok o WHERE o.id_trans = v.id_trans)),
donantes AS (
  SELECT canal_pref, rango_edad AS donante FROM (
    SELECT canal_pref, rango_edad, ROW_NUMBER() OVER (PARTITION BY canal_pref ORDER BY id_miembro) AS rn
    FROM miembros WHERE rango_edad IS NOT NULL) WHERE rn = 1),
miembros_s AS (
  SELECT m.id_miembro, m.fec_registro, m.id_ciudad,
         coalesce(m.rango_edad, d.donante, '30-45') AS rango_edad, m.canal_pref, m.fec_ultima_compra,
         CASE WHEN m.genero IN ('M', 'Masculino') THEN 'M' WHEN m.genero IN ('F', 'Femenino') THEN 'F'
              ELSE 'No informado' END AS genero,
         sha256(CAST(m.id_miembro AS VARCHAR)) AS id_miembro_hash,
         coalesce(TRY_CAST(m.activo AS BOOLEAN), true) AS activo
  FROM miembros m LEFT JOIN donantes d ON m.canal_pref IS NOT DISTINCT FROM d.canal_pref),
articulos_s AS (
  SELECT * REPLACE (coalesce(TRY_CAST(activo AS BOOLEAN), true) AS activo) FROM articulos),
tiendas_s AS (
  SELECT * REPLACE (upper(trim(tipo_tienda)) AS tipo_tienda, CAST(metros_cuadrados AS DOUBLE) AS metros_cuadrados)
  FROM tiendas),
stock_tipado AS (
  SELECT * REPLACE (TRY_CAST(stock_transito AS INTEGER) AS stock_transito) FROM stock_raw),
stock_s AS (
  SELECT * REPLACE (coalesce(stock_fisico, 0) AS stock_fisico, coalesce(stock_transito, 0) AS stock_transito,
                    coalesce(stock_reservado, 0) AS stock_reservado)
  FROM stock_tipado),
devoluciones_s AS (
  SELECT * EXCLUDE (rn) REPLACE (upper(trim(motivo_cod)) AS motivo_cod) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY id_devolucion ORDER BY fec_devolucion DESC NULLS LAST,
      id_trans_origen DESC NULLS LAST, art_id DESC NULLS LAST, id_tienda DESC NULLS LAST,
      qty_devuelta DESC NULLS LAST, motivo_cod DESC NULLS LAST, canal_devolucion DESC NULLS LAST,
      estado_devolucion DESC NULLS LAST, vr_reembolso DESC NULLS LAST) AS rn
    FROM devoluciones_raw) WHERE rn = 1),
ref AS (SELECT max(fec_trans) AS d FROM ventas_ok)
"""

GOLD = """
dim_productos AS (
  SELECT a.art_id AS sk_producto, a.cod_barra, a.desc_art AS nombre_producto, a.id_categ_n1 AS categoria_nivel_1,
         a.id_categ_n2 AS categoria_nivel_2, a.id_categ_n3 AS categoria_nivel_3,
         CAST(a.precio_lista AS DOUBLE) AS precio_lista, CAST(a.peso_kg AS DOUBLE) AS peso_kg, a.unid_medida,
         a.activo, p.id_proveedor, p.razon_social AS nombre_proveedor, p.pais_origen AS pais_proveedor,
         p.tiempo_repo_dias,
         CAST(round(CASE WHEN CAST(a.id_categ_n1 AS VARCHAR) IN ('CAT_1', 'ELECTRONICA', 'TEC') THEN 0.25
                         WHEN CAST(a.id_categ_n1 AS VARCHAR) IN ('CAT_2', 'ROPA', 'TEXTIL') THEN 0.45
                         ELSE 0.35 END * a.precio_lista, 2) AS DOUBLE) AS margen_estimado_categoria
  FROM articulos_s a LEFT JOIN proveedores p ON a.id_proveedor = p.id_proveedor),
dim_tiendas AS (
  SELECT sk_tienda, nombre_tienda, tipo_tienda, ciudad, metros_cuadrados, fec_apertura, pais,
         'ZONA_DIST_' || upper(pais) AS zona_distribucion_asignada
  FROM (SELECT id_tienda AS sk_tienda, nom_tienda AS nombre_tienda, upper(trim(tipo_tienda)) AS tipo_tienda,
               coalesce(id_ciudad, 'CIUDAD_PRINCIPAL') AS ciudad, metros_cuadrados, fec_apertura,
               CASE WHEN upper(coalesce(id_ciudad, 'CIUDAD_PRINCIPAL')) LIKE '%SANTIAGO%' THEN 'Chile'
                    WHEN upper(coalesce(id_ciudad, 'CIUDAD_PRINCIPAL')) LIKE '%CDMX%' THEN 'Mexico'
                    WHEN upper(coalesce(id_ciudad, 'CIUDAD_PRINCIPAL')) LIKE '%BOGOTA%' THEN 'Colombia'
                    WHEN upper(coalesce(id_ciudad, 'CIUDAD_PRINCIPAL')) LIKE '%QUITO%' THEN 'Ecuador'
                    WHEN upper(coalesce(id_ciudad, 'CIUDAD_PRINCIPAL')) LIKE '%LIMA%' THEN 'Peru'
                    ELSE coalesce(id_pais, 'Colombia') END AS pais
        FROM tiendas_s)),
dim_clientes AS (
  SELECT id_miembro_hash AS sk_cliente, id_miembro AS id_miembro_bk, genero, rango_edad, canal_pref, fec_registro,
         fec_ultima_compra, activo, CAST(date_diff('day', fec_registro, (SELECT d FROM ref)) AS INTEGER)
           AS antiguedad_dias
  FROM miembros_s),
fact_ventas AS (
  SELECT v.id_trans AS id_transaccion, CAST(strftime(v.fec_trans, '%Y%m%d') AS INTEGER) AS sk_tiempo,
         v.fec_trans AS fec_transaccion, v.art_id AS sk_producto, v.id_tienda AS sk_tienda,
         coalesce(m.id_miembro_hash, 'CLIENTE_ANONIMO') AS sk_cliente, v.canal_venta, v.tipo_pago,
         v.qty_vendida AS unidades_vendidas, v.precio_unitario_venta, v.descuento_aplicado,
         v.qty_vendida * v.precio_unitario_venta - v.descuento_aplicado AS vr_venta_neto,
         coalesce(v.descuento_aplicado > 0, false) AS es_venta_con_descuento
  FROM ventas_ok v LEFT JOIN miembros_s m ON v.id_miembro = m.id_miembro),
diario AS (
  SELECT art_id, id_tienda, fec_trans, sum(qty_vendida) AS qty_diaria FROM ventas_ok GROUP BY 1, 2, 3),
consumo AS (
  SELECT *, sum(qty_diaria) OVER (PARTITION BY art_id, id_tienda) AS qsum,
         count(*) OVER (PARTITION BY art_id, id_tienda) AS ndays
  FROM diario),
fact_inventario AS (
  SELECT s.id_snapshot AS id_inventario, CAST(strftime(s.fec_snapshot, '%Y%m%d') AS INTEGER) AS sk_tiempo,
         s.fec_snapshot, s.art_id AS sk_producto, s.id_tienda AS sk_tienda, s.stock_fisico, s.stock_transito,
         s.stock_reservado, s.stock_minimo_config,
         coalesce(CAST(c.qsum AS DOUBLE) / CAST(c.ndays AS DOUBLE), 0.0) AS promedio_consumo_14dias,
         CASE WHEN c.qsum > 0
              THEN CAST((100 * CAST(s.stock_fisico AS HUGEINT) * c.ndays) // c.qsum
                     + CASE WHEN 2 * ((100 * CAST(s.stock_fisico AS HUGEINT) * c.ndays) % c.qsum) >= c.qsum THEN 1 ELSE 0 END
                     AS DOUBLE) / 100
              ELSE 999.0 END AS cobertura_dias,
         coalesce(c.qsum > 0 AND CAST(s.stock_fisico AS BIGINT) * c.ndays < 7 * c.qsum, false) AS alerta_quiebre,
         s.stock_fisico - s.stock_minimo_config AS diferencia_stock_minimo
  FROM stock_s s LEFT JOIN consumo c
    ON s.art_id = c.art_id AND s.id_tienda = c.id_tienda AND s.fec_snapshot = c.fec_trans),
fact_devoluciones AS (
  SELECT d.id_devolucion, d.id_trans_origen, CAST(strftime(d.fec_devolucion, '%Y%m%d') AS INTEGER) AS sk_tiempo,
         coalesce(m.id_miembro_hash, 'CLIENTE_ANONIMO') AS sk_cliente, d.fec_devolucion, d.art_id AS sk_producto, d.id_tienda AS sk_tienda,
         d.canal_devolucion, d.qty_devuelta, d.vr_reembolso,
         coalesce(v.precio_unitario_venta, CAST(0 AS DECIMAL(12,2))) AS precio_original_venta,
         CASE WHEN d.motivo_cod IN ('DEF', 'DEFECTUOSO') THEN 'Producto Defectuoso'
              WHEN d.motivo_cod IN ('TAL', 'TALLA') THEN 'Talla / Tamaño Incorrecto'
              WHEN d.motivo_cod IN ('ERR', 'ERROR') THEN 'Envío Erróneo'
              ELSE 'Otro Motivo' END AS motivo_descripcion,
         a.id_categ_n1 AS categoria_nivel_1
  FROM devoluciones_s d LEFT JOIN ventas_ok v ON d.id_trans_origen = v.id_trans
  LEFT JOIN miembros_s m ON v.id_miembro = m.id_miembro
  LEFT JOIN articulos_s a ON d.art_id = a.art_id),
rfm_base AS (
  SELECT id_miembro, CAST(date_diff('day', max(fec_trans), (SELECT d FROM ref)) AS INTEGER) AS recency_dias,
         count(DISTINCT id_trans) AS frequency_trans, sum(vr_total_trans) AS monetary_val
  FROM ventas_ok WHERE fec_trans >= (SELECT d FROM ref) - 90 GROUP BY id_miembro),
rfm_scores AS (
  SELECT *,
    CAST(NTILE(5) OVER (ORDER BY recency_dias DESC NULLS LAST, id_miembro ASC NULLS FIRST) AS INTEGER) AS r_score,
    CAST(NTILE(5) OVER (ORDER BY frequency_trans ASC NULLS FIRST, id_miembro ASC NULLS FIRST) AS INTEGER) AS f_score,
    CAST(NTILE(5) OVER (ORDER BY monetary_val ASC NULLS FIRST, id_miembro ASC NULLS FIRST) AS INTEGER) AS m_score
  FROM rfm_base),
rfm_segmentos AS (
  SELECT m.id_miembro_hash AS sk_cliente, s.recency_dias, s.frequency_trans, s.monetary_val, s.r_score, s.f_score,
         s.m_score, 'R' || s.r_score || '-F' || s.f_score || '-M' || s.m_score AS segmento_rfm,
         CASE WHEN s.r_score >= 4 AND s.f_score >= 4 AND s.m_score >= 4 THEN 'Champions / Pro'
              WHEN s.r_score >= 3 AND s.f_score >= 3 THEN 'Clientes Fieles'
              WHEN s.r_score <= 2 AND s.f_score >= 3 THEN 'En Riesgo'
              WHEN s.r_score = 1 AND s.f_score <= 2 THEN 'Abandono'
              ELSE 'En Desarrollo / Ocasionales' END AS nombre_segmento,
         (SELECT d FROM ref) AS fec_calculo_rfm
  FROM rfm_scores s JOIN miembros_s m ON s.id_miembro = m.id_miembro)
"""

SALES_COLS = (
    "id_trans, id_miembro, id_tienda, art_id, fec_trans, hra_trans, qty_vendida, "
    "CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, "
    "CAST(descuento_aplicado AS DOUBLE) AS descuento_aplicado, tipo_pago, canal_venta"
)
CLEAN_COLS = SALES_COLS + ", CAST(vr_total_trans AS DOUBLE) AS vr_total_trans"
FACT_SALES_COLS = (
    "id_transaccion, sk_tiempo, fec_transaccion, sk_producto, sk_tienda, sk_cliente, canal_venta, tipo_pago, "
    "unidades_vendidas, CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, "
    "CAST(descuento_aplicado AS DOUBLE) AS descuento_aplicado, CAST(vr_venta_neto AS DOUBLE) AS vr_venta_neto, "
    "es_venta_con_descuento"
)



def _hmac(version, key):
    """HMAC-SHA256 of id_miembro_bk by its definition, the padded keys written out."""
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (f"unhex('{bytes(k ^ pad for k in key).hex()}')" for pad in (0x36, 0x5C))
    return f"'{version}:' || sha256({outer} || unhex(sha256({inner} || CAST(CAST(id_miembro_bk AS VARCHAR) AS BLOB))))"


def _constraint_rows():
    """(table, source, kind, column, rule, violations) of each promise, in plain SQL."""
    sources = {
        "MSTR_PROVEEDORES": "proveedores", "MSTR_ARTICULOS": "articulos", "MSTR_TIENDAS": "tiendas", "CRM_MIEMBROS": "miembros",
        "TRANS_VENTAS": "ventas_raw", "INV_STOCK_DIARIO": "stock_raw", "POST_DEVOLUCIONES": "devoluciones_raw",
    }
    keys = ("id_proveedor", "art_id", "id_tienda", "id_miembro", "id_trans", "id_snapshot", "id_devolucion")
    for (t, src), key in zip(sources.items(), keys, strict=True):
        yield t, src, "llave", key, "NULL", f"count({key}) - count(DISTINCT {key})"
        yield t, src, "no_nulo", key, "NULL", f"count(*) - count({key})"
    for t, col in (("MSTR_ARTICULOS", "activo"), ("MSTR_TIENDAS", "id_ciudad"), ("CRM_MIEMBROS", "genero"),
                   ("TRANS_VENTAS", "id_miembro"), ("TRANS_VENTAS", "id_tienda")):
        yield t, sources[t], "no_nulo", col, "NULL", f"count(*) - count({col})"
    for t, col, n in (
        ("MSTR_PROVEEDORES", "razon_social", 150), ("MSTR_PROVEEDORES", "pais_origen", 50), ("MSTR_ARTICULOS", "cod_barra", 50),
        ("MSTR_ARTICULOS", "desc_art", 200), ("MSTR_ARTICULOS", "unid_medida", 20), ("MSTR_TIENDAS", "nom_tienda", 100),
        ("MSTR_TIENDAS", "tipo_tienda", 50), ("CRM_MIEMBROS", "rango_edad", 20), ("TRANS_VENTAS", "hra_trans", 8),
        ("POST_DEVOLUCIONES", "motivo_cod", 50),
    ):
        yield t, sources[t], "largo", col, f"'{n}'", f"count(*) FILTER (WHERE length({col}) > {n})"
    for t, col, values in (("CRM_MIEMBROS", "genero", "M,F"), ("TRANS_VENTAS", "canal_venta", "Fisico,Online,App"),
                           ("POST_DEVOLUCIONES", "estado_devolucion", "APROBADO,PENDIENTE")):
        yield t, sources[t], "dominio", col, f"'{values}'", f"count(*) FILTER (WHERE NOT list_contains(string_split('{values}', ','), {col}))"
    for t, col, rule in (
        ("MSTR_PROVEEDORES", "tiempo_repo_dias", "tiempo_repo_dias >= 0"), ("MSTR_ARTICULOS", "precio_lista", "precio_lista >= 0"),
        ("TRANS_VENTAS", "art_id", "art_id > 0"), ("TRANS_VENTAS", "qty_vendida", "qty_vendida > 0"),
        ("TRANS_VENTAS", "descuento_aplicado", "descuento_aplicado BETWEEN 0 AND precio_unitario_venta"),
        ("INV_STOCK_DIARIO", "stock_fisico", "stock_fisico >= stock_minimo_config"),
        ("POST_DEVOLUCIONES", "id_trans_origen", "id_trans_origen > 0"),
    ):
        yield t, sources[t], "condicion", col, f"'{rule}'", f"count(*) FILTER (WHERE NOT ({rule}))"
    bad = "count(*) FILTER (WHERE stock_transito IS NOT NULL AND TRY_CAST(stock_transito AS INTEGER) IS NULL)"
    yield "INV_STOCK_DIARIO", "stock_raw", "tipo", "stock_transito", "'int'", bad


BODIES = {
    "bronze_extract": """
SELECT id_trans, id_miembro, id_tienda, art_id, fec_trans, qty_vendida,
       CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, canal_venta,
       TIMESTAMP '2000-01-01 00:00:00' AS FechaIngesta, 'SQL_ORIGEN' AS SistemaFuente, 'RUN_QUERY' AS IdLote
FROM ventas_raw WHERE canal_venta = 'Online'""",
    "bronze_lenient_cast": f"""
SELECT {SALES_COLS} FROM (
  SELECT * REPLACE (TRY_CAST(CASE WHEN art_id % 101 = 0 THEN 'x1' ELSE CAST(qty_vendida AS VARCHAR) END AS INTEGER)
                      AS qty_vendida,
                    TRY_CAST(CASE WHEN art_id % 103 = 0 THEN '2024-13-45' ELSE CAST(fec_trans AS VARCHAR) END AS DATE)
                      AS fec_trans)
  FROM ventas_raw)""",
    "bronze_load_audit": " UNION ALL ".join(
        f"SELECT 'RUN_QUERY' AS IdLote, '{t}' AS NombreTablaDestino, '{t}' AS NombreTablaFuente, "
        f"'SATISFACTORIO' AS Estado, count(*) AS RegistrosCopiados, false AS ConError FROM {src}"
        for t, src in (
            ("MSTR_PROVEEDORES", "proveedores"), ("MSTR_ARTICULOS", "articulos"), ("MSTR_TIENDAS", "tiendas"),
            ("CRM_MIEMBROS", "miembros"), ("TRANS_VENTAS", "ventas_raw WHERE canal_venta = 'Online'"),
            ("INV_STOCK_DIARIO", "stock_raw"),
        )
    ) + " UNION ALL SELECT 'RUN_QUERY', 'SIN_FUENTE', 'SIN_FUENTE', 'FALLA', NULL, true",
    "bronze_days_by_contract": """
SELECT id_snapshot, art_id, TRY_CAST(stock_transito AS INTEGER) AS stock_transito, stock_fisico,
       CASE WHEN art_id % 2 = 0 THEN DATE '2000-01-01' ELSE DATE '2000-01-02' END AS fecha_ingesta,
       CAST(CASE WHEN art_id % 2 <> 0 AND stock_transito IS NOT NULL AND TRY_CAST(stock_transito AS INTEGER) IS NULL THEN 1 ELSE 0 END
         AS BIGINT) AS sin_convertir
FROM stock_raw""",
    "incremental_silver_sales": f"SELECT {CLEAN_COLS} FROM ventas_limpias",
    "silver_dedupe_latest": f"SELECT {SALES_COLS} FROM ventas_dedup",
    "silver_members": """
SELECT id_miembro, fec_registro, id_ciudad, rango_edad, canal_pref, fec_ultima_compra, genero, id_miembro_hash,
       activo FROM miembros_s""",
    "silver_impute_partition": """
SELECT m.id_miembro, m.canal_pref, coalesce(m.rango_edad, d.donante, '30-45') AS rango_edad,
       m.rango_edad AS rango_edad_origen
FROM miembros m LEFT JOIN donantes d ON m.canal_pref IS NOT DISTINCT FROM d.canal_pref""",
    "silver_products": """
SELECT * REPLACE (CAST(precio_lista AS DOUBLE) AS precio_lista, CAST(peso_kg AS DOUBLE) AS peso_kg)
FROM articulos_s""",
    "silver_suppliers": "SELECT * FROM proveedores",
    "silver_stores": "SELECT * FROM tiendas_s",
    "silver_sales": f"SELECT {CLEAN_COLS} FROM ventas_limpias",
    "silver_ri_accepted": f"SELECT {CLEAN_COLS} FROM ventas_ok",
    "silver_ri_rejected": f"SELECT {CLEAN_COLS}, motivo_rechazo FROM ventas_rechazadas",
    "silver_stock": "SELECT * FROM stock_s",
    "silver_returns": "SELECT * REPLACE (CAST(vr_reembolso AS DOUBLE) AS vr_reembolso) FROM devoluciones_s",
    "dim_products": "SELECT * FROM dim_productos",
    "dim_stores": "SELECT * FROM dim_tiendas",
    "dim_customers": "SELECT * FROM dim_clientes",
    "dim_date": """
SELECT CAST(strftime(fecha, '%Y%m%d') AS INTEGER) AS sk_fecha, fecha, CAST(year(fecha) AS INTEGER) AS anio,
       CAST(month(fecha) AS INTEGER) AS mes, strftime(fecha, '%A') AS dia_semana
FROM (SELECT CAST(unnest(generate_series(min(fec_trans), max(fec_trans), INTERVAL 1 DAY)) AS DATE) AS fecha
      FROM ventas_ok)""",
    "mask_customers": """
SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(CAST(id_miembro_bk AS VARCHAR),
         '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS id_miembro_bk)
FROM dim_clientes""",
    "pseudonymised_customers": f"""
SELECT {_hmac("v2", b"otra clave, mas larga que un bloque de sesenta y cuatro bytes, de ejemplo")} AS id_miembro_bk,
       {_hmac("v1", b"clave de ejemplo")} AS seudonimo_v1, genero, rango_edad,
       regexp_replace(regexp_replace(regexp_replace(canal_pref, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS canal_pref,
       CAST(date_trunc('month', fec_registro) AS DATE) AS fec_registro
FROM dim_clientes""",
    "agg_daily_consumption": "SELECT * FROM diario",
    "agg_reference_date": "SELECT d AS fecha_referencia FROM ref",
    "win_avg_whole": """
SELECT art_id, id_tienda, fec_trans, qty_diaria, qsum AS _qty_sum, ndays AS _day_count,
       CAST(qsum AS DOUBLE) / CAST(ndays AS DOUBLE) AS promedio FROM consumo""",
    "win_avg_14d": """
SELECT art_id, id_tienda, fec_trans, qty_diaria, _qty_sum, _day_count,
       CAST(_qty_sum AS DOUBLE) / CAST(_day_count AS DOUBLE) AS promedio
FROM (SELECT d.*,
        (SELECT sum(e.qty_diaria) FROM diario e WHERE e.art_id = d.art_id AND e.id_tienda = d.id_tienda
           AND e.fec_trans BETWEEN d.fec_trans - 13 AND d.fec_trans) AS _qty_sum,
        (SELECT count(*) FROM diario e WHERE e.art_id = d.art_id AND e.id_tienda = d.id_tienda
           AND e.fec_trans BETWEEN d.fec_trans - 13 AND d.fec_trans) AS _day_count
      FROM diario d)""",
    "win_avg_14d_category": """
SELECT id_categ_n1, id_tienda, fec_trans, qty_diaria, _qty_sum, _day_count,
       CAST(_qty_sum AS DOUBLE) / CAST(_day_count AS DOUBLE) AS promedio
FROM (SELECT *, CAST(sum(qty_diaria) OVER w AS BIGINT) AS _qty_sum, count(*) OVER w AS _day_count
      FROM (SELECT a.id_categ_n1, v.id_tienda, v.fec_trans, CAST(sum(v.qty_vendida) AS BIGINT) AS qty_diaria
            FROM ventas_ok v JOIN articulos_s a ON v.art_id = a.art_id GROUP BY 1, 2, 3)
      WINDOW w AS (PARTITION BY id_categ_n1, id_tienda ORDER BY fec_trans
                   RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND CURRENT ROW))""",
    "fact_sales": f"SELECT {FACT_SALES_COLS} FROM fact_ventas",
    "fact_inventory": "SELECT * FROM fact_inventario",
    "fact_returns": """
SELECT * REPLACE (CAST(vr_reembolso AS DOUBLE) AS vr_reembolso,
                  CAST(precio_original_venta AS DOUBLE) AS precio_original_venta)
FROM fact_devoluciones""",
    "join_heavy_hitters": """
SELECT d.id_devolucion, d.origen AS id_trans_origen, CAST(d.vr_reembolso AS DOUBLE) AS vr_reembolso,
       CAST(v.precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, v.canal_venta
FROM (SELECT *, CASE WHEN id_devolucion % 3 = 0 THEN (SELECT min(id_trans_origen) FROM devoluciones_s WHERE id_trans_origen > 0)
                     ELSE id_trans_origen END AS origen FROM devoluciones_s) d
LEFT JOIN ventas_ok v ON d.origen = v.id_trans""",
    "rfm_base": "SELECT id_miembro, recency_dias, frequency_trans, CAST(monetary_val AS DOUBLE) AS monetary_val "
                "FROM rfm_base",
    "incremental_rfm_base": "SELECT id_miembro, recency_dias, frequency_trans, CAST(monetary_val AS DOUBLE) AS monetary_val "
                            "FROM rfm_base",
    "rfm_scores": "SELECT * REPLACE (CAST(monetary_val AS DOUBLE) AS monetary_val) FROM rfm_scores",
    "rfm_segments": "SELECT * REPLACE (CAST(monetary_val AS DOUBLE) AS monetary_val) FROM rfm_segmentos",
    "rfm_churn_flag": """
SELECT * REPLACE (CAST(monetary_val AS DOUBLE) AS monetary_val),
       nombre_segmento IN ('En Riesgo', 'Abandono') AS alerta_churn
FROM rfm_segmentos""",
    "inventory_low_stock": """
SELECT id_inventario, sk_tiempo, sk_producto, sk_tienda, stock_fisico AS stock_disponible,
       stock_minimo_config AS reorder_point, stock_fisico <= stock_minimo_config AS alerta_stock_bajo
FROM fact_inventario""",
    "inventory_leadtime_risk": """
SELECT i.id_inventario, i.sk_producto, i.sk_tienda, i.fec_snapshot, i.cobertura_dias, p.tiempo_repo_dias,
       coalesce(i.promedio_consumo_14dias > 0 AND i.cobertura_dias < p.tiempo_repo_dias, false) AS riesgo_reposicion
FROM fact_inventario i LEFT JOIN dim_productos p ON i.sk_producto = p.sk_producto""",
    "kpi_gross_margin": """
SELECT categoria_nivel_1, CAST(s AS DOUBLE) AS venta_neta, CAST(c AS DOUBLE) AS costo_referencia,
       CASE WHEN s <> 0 THEN CAST(s - c AS DOUBLE) / CAST(s AS DOUBLE) END * 100 AS margen_bruto_pct
FROM (SELECT a.id_categ_n1 AS categoria_nivel_1, sum(v.vr_total_trans) AS s, sum(v.qty_vendida * a.precio_lista) AS c
      FROM ventas_ok v JOIN articulos_s a ON v.art_id = a.art_id GROUP BY 1)""",
    "kpi_discount_by_channel": """
SELECT canal_venta, CAST(sum(descuento_aplicado) AS DOUBLE) AS total_descuentos_monto,
       count(*) FILTER (WHERE descuento_aplicado > 0) AS ventas_con_descuento, count(*) AS ventas
FROM ventas_ok GROUP BY canal_venta""",
    "kpi_stock_coverage_30d": """
SELECT s.art_id AS sk_producto, s.id_tienda AS sk_tienda,
       CAST(s.st AS DOUBLE) / CAST(s.n AS DOUBLE) AS stock_promedio,
       CAST(v.u AS DOUBLE) / 30.0 AS venta_diaria_promedio,
       CASE WHEN s.n * v.u <> 0 THEN CAST(s.st * 30 AS DOUBLE) / CAST(s.n * v.u AS DOUBLE) END AS cobertura_dias_stock
FROM (SELECT art_id, id_tienda, sum(stock_fisico) AS st, count(*) AS n FROM stock_s
      WHERE fec_snapshot BETWEEN (SELECT d FROM ref) - 29 AND (SELECT d FROM ref) GROUP BY 1, 2) s
LEFT JOIN (SELECT art_id, id_tienda, sum(qty_vendida) AS u FROM ventas_ok
           WHERE fec_trans BETWEEN (SELECT d FROM ref) - 29 AND (SELECT d FROM ref) GROUP BY 1, 2) v
  ON s.art_id = v.art_id AND s.id_tienda = v.id_tienda""",
    "kpi_avg_ticket": """
SELECT canal_venta, categoria_nivel_1, transacciones, CAST(net AS DOUBLE) AS venta_neta,
       CASE WHEN transacciones <> 0 THEN CAST(net AS DOUBLE) / CAST(transacciones AS DOUBLE) END AS ticket_promedio
FROM (SELECT v.canal_venta, a.id_categ_n1 AS categoria_nivel_1, sum(v.vr_total_trans) AS net,
             count(DISTINCT v.id_trans) AS transacciones
      FROM ventas_ok v JOIN articulos_s a ON v.art_id = a.art_id GROUP BY 1, 2)""",
    "kpi_conversion": """
SELECT fecha, usuarios_vista, usuarios_compra,
       CASE WHEN usuarios_vista <> 0 THEN CAST(usuarios_compra AS DOUBLE) / CAST(usuarios_vista AS DOUBLE) END
         AS tasa_conversion
FROM (SELECT CAST(ts AS DATE) AS fecha,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS usuarios_vista,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS usuarios_compra
      FROM events GROUP BY 1)""",
    "dq_constraints": " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, '{kind}' AS restriccion, '{col}' AS columna, {rule} AS regla, count(*) AS filas, "
        f"{bad} AS violaciones FROM {src}"
        for t, src, kind, col, rule, bad in _constraint_rows()
    ),
    "kpi_ordered_conversion": """
SELECT CAST(inicio AS DATE) AS fecha, count(*) AS sesiones, count(vista) AS sesiones_vista, count(compra) AS sesiones_compra,
       count(*) FILTER (WHERE convertida) AS sesiones_convertidas,
       CASE WHEN count(vista) <> 0 THEN CAST(count(*) FILTER (WHERE convertida) AS DOUBLE) / count(vista) END AS tasa_conversion
FROM (SELECT user_id, sesion, min(ts) AS inicio, min(ts) FILTER (WHERE event_type = 'view') AS vista,
             max(ts) FILTER (WHERE event_type = 'purchase') AS compra,
             max(ts) FILTER (WHERE event_type = 'purchase') > min(ts) FILTER (WHERE event_type = 'view') AS convertida
      FROM (SELECT *, sum(nueva) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sesion
            FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 12 HOUR THEN 0 ELSE 1 END
                         AS nueva
                  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL))
      GROUP BY user_id, sesion) GROUP BY 1""",
    "kpi_returns_root_cause": """
SELECT d.motivo_descripcion, d.categoria_nivel_1, p.nombre_proveedor, d.canal_devolucion, count(*) AS devoluciones,
       sum(d.qty_devuelta) AS unidades_devueltas, CAST(sum(d.vr_reembolso) AS DOUBLE) AS monto_reembolsado
FROM fact_devoluciones d LEFT JOIN dim_productos p ON d.sk_producto = p.sk_producto GROUP BY 1, 2, 3, 4""",
    "view_store_daily": """
SELECT sk_tienda, fec_transaccion, CAST(sum(vr_venta_neto) AS DOUBLE) AS venta_neta,
       CAST(sum(descuento_aplicado) AS DOUBLE) AS descuentos,
       CAST(sum(precio_unitario_venta) AS DOUBLE) / CAST(count(precio_unitario_venta) AS DOUBLE) AS precio_promedio,
       count(*) AS transacciones
FROM fact_ventas GROUP BY 1, 2""",
    "view_daily_sales": """
SELECT f.fec_transaccion, t.pais, f.sk_tienda, t.nombre_tienda, f.canal_venta, p.categoria_nivel_1,
       sum(f.unidades_vendidas) AS unidades, CAST(sum(f.vr_venta_neto) AS DOUBLE) AS venta_neta,
       CAST(sum(f.descuento_aplicado) AS DOUBLE) AS descuentos, count(*) AS transacciones
FROM fact_ventas f LEFT JOIN dim_tiendas t ON f.sk_tienda = t.sk_tienda
LEFT JOIN dim_productos p ON f.sk_producto = p.sk_producto GROUP BY 1, 2, 3, 4, 5, 6""",
    "view_rfm_segments": """
SELECT nombre_segmento, count(*) AS clientes, CAST(sum(monetary_val) AS DOUBLE) AS valor_monetario,
       CAST(sum(recency_dias) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS recencia_promedio,
       CAST(sum(frequency_trans) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS frecuencia_promedio
FROM rfm_segmentos GROUP BY 1""",
}


# fixture CTE, contract table, primary key, deduped CTE, accepted CTE, rejected CTE, null-analysis columns
QUALITY_SOURCES = (
    ("miembros", "CRM_MIEMBROS", "id_miembro", "miembros", "miembros_s", None, ("genero", "rango_edad", "activo")),
    ("articulos", "MSTR_ARTICULOS", "art_id", "articulos", "articulos_s", None, ("id_proveedor", "activo")),
    ("proveedores", "MSTR_PROVEEDORES", "id_proveedor", "proveedores", "proveedores", None, ("pais_origen",)),
    ("tiendas", "MSTR_TIENDAS", "id_tienda", "tiendas", "tiendas_s", None, ("id_ciudad", "id_pais")),
    ("ventas_raw", "TRANS_VENTAS", "id_trans", "ventas_dedup", "ventas_ok", "ventas_rechazadas",
     ("id_miembro", "id_tienda", "descuento_aplicado")),
    ("stock_raw", "INV_STOCK_DIARIO", "id_snapshot", "stock_tipado", "stock_s", None, ("stock_transito",)),
    ("devoluciones_raw", "POST_DEVOLUCIONES", "id_devolucion", "devoluciones_s", "devoluciones_s", None,
     ("id_trans_origen",)),
)


def _dq_metrics() -> str:
    parts = []
    for raw, table, _key, dedup, acc, rej, nulls in QUALITY_SOURCES:
        pairs = ", ".join(f"'{c}', (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {dedup})" for c in nulls)
        rejected = f"(SELECT count(*) FROM {rej})" if rej else "CAST(0 AS BIGINT)"
        failures = "CAST(0 AS BIGINT)"
        if table == "INV_STOCK_DIARIO":
            failures = ("(SELECT count(*) FILTER (WHERE stock_transito IS NOT NULL"
                        " AND TRY_CAST(stock_transito AS INTEGER) IS NULL) FROM stock_raw)")
        parts.append(f"""
SELECT '{table}' AS table_name, t AS total_records, t - u AS duplicate_records, a AS accepted_records,
       r AS rejected_records,
       CASE WHEN t > 0 THEN CAST((CAST(a AS HUGEINT) * 10000) // t
                                + CASE WHEN 2 * ((CAST(a AS HUGEINT) * 10000) % t) >= t THEN 1 ELSE 0 END AS DOUBLE) / 100
            ELSE 0.0 END AS pct_conformed,
       {failures} AS conversion_failures,
       CAST(json_object({pairs}) AS VARCHAR) AS null_analysis
FROM (SELECT (SELECT count(*) FROM {raw}) AS t, (SELECT count(*) FROM {dedup}) AS u,
             (SELECT count(*) FROM {acc}) AS a, {rejected} AS r)""")
    return "\nUNION ALL".join(parts)


def _dq_null_counts() -> str:
    from almacen import schemas as S

    parts = []
    for raw, table, *_ in QUALITY_SOURCES:
        for f in S.SOURCES[table][0].fields:
            parts.append(
                f"SELECT '{table}' AS tabla, '{f.name}' AS columna, count(*) FILTER (WHERE {f.name} IS NULL) AS nulos "
                f"FROM {raw}"
            )
    return "\nUNION ALL ".join(parts)


BODIES["dq_metrics"] = _dq_metrics()
BODIES["dq_null_counts"] = _dq_null_counts()


def sql(name: str) -> str:
    return f"WITH {FIXTURES},{SILVER},{GOLD}\n{BODIES[name]}"


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}
