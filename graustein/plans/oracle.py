"""DuckDB oracle SQL for the registered queries.

``FIXTURE_VIEWS`` restates the fixture adapters of ``sources.fixtures`` as SQL over the
driver's tables; every oracle query is ``WITH <views>, <query CTEs> SELECT ...``.
The oracle is written independently of the Spark code (set-based SQL, rounding of
quotients done on scaled integers because DuckDB divides decimals as DOUBLE).
"""

from __future__ import annotations

FIXTURE_VIEWS = """
fx_elements AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         'P' || CAST(o_custkey % 20 AS VARCHAR) AS project_id,
         CASE o_orderkey % 5
           WHEN 0 THEN 'C02.0' || CAST(o_orderkey % 7 + 1 AS VARCHAR)
           WHEN 1 THEN 'C 2.' || CAST(o_orderkey % 7 + 1 AS VARCHAR)
           WHEN 2 THEN 'C2.1'
           WHEN 3 THEN ' E3 '
           ELSE 'Z9' END AS ebkp,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(14,2)) * 0.01 END AS area_net,
         CAST(o_totalprice AS DECIMAL(14,2)) * 0.001 - 50 AS length,
         o_orderstatus, o_orderpriority
  FROM orders),
fx_element_materials AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS element_id, p_name AS material_name,
         CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) - 5 AS DECIMAL(12,2)) AS volume,
         CAST(CASE WHEN MAX(p_size) % 10 = 0 THEN 0 ELSE MAX(p_size) * 50 END AS DECIMAL(8,1)) AS density
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey, p_name),
fx_mappings AS (
  SELECT p_name AS ifc_material, CAST(MIN(p_partkey) AS VARCHAR) AS kbob_id
  FROM part WHERE p_name NOT LIKE 'red %' GROUP BY p_name),
fx_kbob_base AS (
  SELECT CAST(p_partkey AS VARCHAR) AS uuid, p_name AS name,
         CAST(p_retailprice AS DECIMAL(10,3)) AS indicator_co2eq,
         CAST(CAST(p_size AS DECIMAL(10,3)) * 3.5 AS DECIMAL(10,3)) AS indicator_penre,
         CAST(p_size * 1000 AS DECIMAL(12,3)) AS indicator_ubp, p_type
  FROM part),
fx_kbob AS (
  SELECT uuid, name, indicator_co2eq, indicator_penre, indicator_ubp, '2023-v1' AS version FROM fx_kbob_base
  UNION ALL
  SELECT uuid, name, indicator_co2eq, indicator_penre, indicator_ubp, '2024-v1' AS version FROM fx_kbob_base
  WHERE p_type <> 'PROMO'),
fx_versions AS (
  SELECT * FROM (VALUES ('2023-v1', false, DATE '2023-01-01', 'previous'),
                        ('2024-v1', true, DATE '2024-01-01', 'current'))
         AS t(version, is_active, release_date, description)),
fx_life AS (
  SELECT * FROM (VALUES ('C2.1', 'a', 50), ('C2.1', 'b', 40), ('E3', 'c', 25), ('C02.03', 'd', 30))
         AS t(ebkp_code, description, "years")),
fx_cost AS (
  SELECT ebkp_code, description, unit, CAST(cost_per_unit AS DECIMAL(10,2)) AS cost_per_unit, version
  FROM (VALUES ('C2.1', 'Aussenwand', 'm2', '120.50', '2024'), ('E3', 'Fenster', 'm', '80.25', '2024'),
               ('C02.03', 'Stuetze', 'stk', '9.00', '2024'))
       AS t(ebkp_code, description, unit, cost_per_unit, version)),
fx_projects AS (
  SELECT DISTINCT project_id, 'Project ' || project_id AS name, 60 AS life_expectancy,
         '2024-v1' AS kbob_version, 'active' AS status
  FROM fx_elements),
fx_history AS (
  SELECT event_id AS id, 'P' || CAST(user_id % 20 AS VARCHAR) AS project_id,
         value AS processing_time, event_type AS kbob_version, ts AS created_at
  FROM events),
fx_catalogue_lines AS (
  SELECT r_regionkey * 10 AS line_no, 'C ' || CAST(r_regionkey AS VARCHAR) || ' ' || r_name AS value FROM region
  UNION ALL
  SELECT 1000 + n_nationkey * 2, 'C ' || CAST(n_regionkey AS VARCHAR) || '.' || lpad(CAST(n_nationkey // 5 AS VARCHAR), 2, '0') || ' ' || n_name FROM nation
  UNION ALL
  SELECT 1001 + n_nationkey * 2, '# note ' || n_name FROM nation
  UNION ALL
  SELECT 2000 + r_regionkey, 'E ' || CAST(r_regionkey AS VARCHAR) || ' ' || lower(r_name) FROM region
  UNION ALL
  SELECT 3000 + r_regionkey, 'E 0' || CAST(r_regionkey AS VARCHAR) || ' ' || r_name FROM region),
fx_properties AS (
  SELECT id AS element_id, 0 AS pset_pos, 0 AS prop_pos, 'Name' AS prop_name, o_orderpriority AS prop_value FROM fx_elements
  UNION ALL
  SELECT id, 0, 1, 'eBKP', CASE WHEN o_orderstatus <> 'F' THEN ebkp END FROM fx_elements
  UNION ALL
  SELECT id, 1, 0, 'EBKP', ebkp || ' ' FROM fx_elements),
fx_classification_refs AS (
  SELECT id AS element_id,
         CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'IFC2X3' ELSE 'IFC4' END AS schema_version,
         'eBKP' AS system,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS name,
         CASE WHEN o_orderstatus <> 'F' THEN ebkp END AS item_reference,
         trim(ebkp) AS identification
  FROM fx_elements WHERE o_orderpriority <> '5-LOW')
"""

# The LCA components (C1) as set-based SQL: validation, lookups, ordered checks, rounding.
LCA_VIEWS = """
lca_rows AS (
  SELECT m.element_id, e.project_id, e.ebkp, m.material_name, m.volume, m.density
  FROM fx_element_materials m JOIN fx_elements e ON m.element_id = e.id),
lca_valid AS (
  SELECT element_id FROM lca_rows GROUP BY element_id HAVING bool_or(volume > 0)),
lca_life AS (
  SELECT trim(ebkp_code) AS code, MIN("years") AS life_years FROM fx_life GROUP BY trim(ebkp_code)),
lca_kbob AS (
  SELECT uuid, name, indicator_co2eq, indicator_penre, indicator_ubp FROM fx_kbob WHERE version = '2024-v1'),
lca_joined AS (
  SELECT r.*, mp.kbob_id, kb.uuid AS found_uuid, kb.name AS kbob_name,
         kb.indicator_co2eq, kb.indicator_penre, kb.indicator_ubp,
         COALESCE(NULLIF(l.life_years, 0), 60) AS life_years,
         CASE WHEN r.volume IS NULL OR r.volume <= 0 THEN 'INVALID_VOLUME'
              WHEN r.density IS NULL OR r.density <= 0 THEN 'INVALID_DENSITY'
              WHEN mp.kbob_id IS NULL THEN 'MAPPING_NOT_FOUND'
              WHEN kb.uuid IS NULL THEN 'KBOB_NOT_FOUND' END AS error_code
  FROM lca_rows r
  LEFT JOIN fx_mappings mp ON mp.ifc_material = r.material_name AND mp.kbob_id IS NOT NULL AND trim(mp.kbob_id) <> ''
  LEFT JOIN lca_kbob kb ON kb.uuid = mp.kbob_id
  LEFT JOIN lca_life l ON l.code = trim(r.ebkp)
  WHERE r.element_id IN (SELECT element_id FROM lca_valid)),
lca_scaled AS (
  SELECT *,
         CAST(CAST(volume * density * indicator_co2eq AS DECIMAL(38,6)) * 1000000 AS HUGEINT) AS gwp_i,
         CAST(CAST(volume * density * indicator_penre AS DECIMAL(38,6)) * 1000000 AS HUGEINT) AS penr_i,
         CAST(CAST(volume * density * indicator_ubp AS DECIMAL(38,6)) * 1000000 AS HUGEINT) AS ubp_i
  FROM lca_joined),
lca_components AS (
  SELECT project_id, element_id, material_name,
         CASE WHEN error_code IS NULL THEN kbob_id END AS kbob_uuid,
         CASE WHEN error_code IS NULL THEN kbob_name END AS kbob_material_name,
         '2024-v1' AS kbob_version,
         CASE WHEN error_code IS NULL THEN CAST(ROUND(volume, 3) AS DOUBLE) END AS volume,
         CASE WHEN error_code IS NULL THEN CAST(ROUND(density, 3) AS DOUBLE) END AS density,
         CASE WHEN error_code IS NULL THEN CAST(life_years AS INTEGER) END AS amortization,
         ebkp AS ebkp_h,
         CASE WHEN error_code IS NULL THEN CAST((gwp_i + 500) // 1000 AS DOUBLE) / 1000 END AS gwp_absolute,
         CASE WHEN error_code IS NULL THEN CAST((gwp_i + life_years * 500) // (life_years * 1000) AS DOUBLE) / 1000 END AS gwp_relative,
         CASE WHEN error_code IS NULL THEN CAST((penr_i + 500) // 1000 AS DOUBLE) / 1000 END AS penr_absolute,
         CASE WHEN error_code IS NULL THEN CAST((penr_i + life_years * 500) // (life_years * 1000) AS DOUBLE) / 1000 END AS penr_relative,
         CASE WHEN error_code IS NULL THEN CAST((ubp_i + 500000) // 1000000 AS DOUBLE) END AS ubp_absolute,
         CASE WHEN error_code IS NULL THEN CAST((ubp_i + life_years * 500000) // (life_years * 1000000) AS DOUBLE) END AS ubp_relative,
         error_code IS NOT NULL AS failed,
         error_code,
         CASE error_code
           WHEN 'INVALID_VOLUME' THEN 'Invalid volume: ' || COALESCE(CAST(volume AS VARCHAR), 'None')
           WHEN 'INVALID_DENSITY' THEN 'Invalid density: ' || COALESCE(CAST(density AS VARCHAR), 'None')
           WHEN 'MAPPING_NOT_FOUND' THEN 'Material mapping not found: ' || material_name
           WHEN 'KBOB_NOT_FOUND' THEN 'KBOB ID not found: ' || kbob_id END AS error_message
  FROM lca_scaled)
"""

COST_VIEWS = """
cost_keys AS (
  SELECT trim(ebkp_code) AS cost_code, COUNT(*) AS n_keys, MIN(unit) AS unit, MIN(cost_per_unit) AS cost_per_unit
  FROM fx_cost WHERE version = (SELECT MAX(version) FROM fx_cost) GROUP BY trim(ebkp_code)),
cost_joined AS (
  SELECT e.project_id, e.id AS guid, trim(e.ebkp) AS ebkp_h, k.n_keys, k.unit, k.cost_per_unit,
         CASE WHEN k.unit = 'm2' THEN e.area_net WHEN k.unit = 'm' THEN e.length END AS quantity
  FROM fx_elements e LEFT JOIN cost_keys k ON trim(e.ebkp) = k.cost_code),
cost_checked AS (
  SELECT *,
         CASE WHEN n_keys IS NULL THEN 'COST_CODE_NOT_FOUND'
              WHEN n_keys > 1 THEN 'AMBIGUOUS_COST_CODE'
              WHEN unit IS NULL OR unit NOT IN ('m2', 'm') THEN 'UNKNOWN_UNIT'
              WHEN quantity IS NULL OR quantity <= 0 THEN 'INVALID_QUANTITY' END AS error_code
  FROM cost_joined),
cost_components AS (
  SELECT project_id, guid, ebkp_h,
         CASE WHEN error_code IS NULL THEN CAST(quantity AS DOUBLE) END AS quantity,
         CASE WHEN error_code IS NULL THEN unit END AS unit,
         CASE WHEN error_code IS NULL THEN CAST(ROUND(cost_per_unit, 2) AS DOUBLE) END AS unit_cost,
         CASE WHEN error_code IS NULL THEN CAST(ROUND(quantity * cost_per_unit, 2) AS DOUBLE) END AS total_cost,
         error_code IS NOT NULL AS failed, error_code,
         CASE error_code
           WHEN 'COST_CODE_NOT_FOUND' THEN '''' || COALESCE(ebkp_h, 'None') || ''''
           WHEN 'AMBIGUOUS_COST_CODE' THEN 'Ambiguous cost code: ' || ebkp_h
           WHEN 'UNKNOWN_UNIT' THEN 'Unknown unit type: ' || COALESCE(unit, 'None')
           WHEN 'INVALID_QUANTITY' THEN 'Invalid quantity: ' || COALESCE(CAST(quantity AS VARCHAR), 'nan') END AS error
  FROM cost_checked)
"""


def with_views(*view_blocks: str, body: str) -> str:
    """``WITH`` the fixture views (and further CTE blocks) followed by ``body``."""
    blocks = [FIXTURE_VIEWS.strip()] + [b.strip() for b in view_blocks]
    return "WITH " + ",\n".join(blocks) + "\n" + body.strip()
