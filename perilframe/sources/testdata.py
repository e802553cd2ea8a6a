"""Mart, feeder and snapshot tables derived from the TPC-H-like test tables.

Each table is one SELECT in the SQL subset Spark and DuckDB share, so the Spark side
and the oracle side start from the same rows. Spark groups the lines only once, by order,
supplier's side and line number, and writes these narrow groups in buckets by risk; groups
by risk and structure are taken where the lines lie, without another shuffle. The tables
are not written: texts and hashes are computed where a query reads them. Buckets are as many
as the rows ask for, so no task's memory grows with the input, and the hottest order is a
handful of rows from the first grouping on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe import schema
from perilframe.functions.fixed import CONSTRUCTION_NUMBERS, NO_PERIL, PERILS
from perilframe.sources.mart import Mart
from perilframe.sources.staging import Stage

BASE_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")
SNAPSHOTS = {
    "current": date(1998, 12, 31),
    "prior": date(1998, 6, 30),
    "prior2": date(1997, 12, 31),
}

_RISK_KEY = "l_orderkey * 10 + l_suppkey % 2"
_RPP_KEY = f"({_RISK_KEY}) * 10 + l_linenumber"
_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"


def _flags() -> str:
    return ", ".join(
        f"max(CASE WHEN l_linenumber = {n} THEN 1 ELSE 0 END) AS {flag}"
        for n, flag in enumerate(schema.PERIL_FLAGS, 1)
    )


def _rows(names: str, rows: list[tuple]) -> str:
    def text(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


_POLICY_TERM = f"""
SELECT o_orderkey AS policy_term_id, o_custkey AS policy_id,
  o_custkey % 25 AS producer_profit_center_bu_id, o_custkey % 5 AS company_id,
  CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'PIM' WHEN '2' THEN 'AED'
    WHEN '3' THEN 'GARS' WHEN '4' THEN 'AGR' ELSE 'SHS' END AS business_unit_cd,
  o_orderpriority AS business_unit_desc,
  CASE o_orderstatus WHEN 'F' THEN 'CPP' WHEN 'O' THEN 'DIC' ELSE 'EXC' END AS policy_symbol_cd,
  'Symbol ' || o_orderstatus AS policy_symbol_desc,
  lpad(CAST(o_orderkey AS STRING), 7, '0') AS policy_number_cd,
  lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') AS policy_module_cd,
  CAST(o_orderdate AS DATE) AS policy_term_effective_dt,
  CAST(o_orderdate AS DATE) + 365 AS policy_term_expiration_dt,
  CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderdate AS DATE) + 100 END
    AS cancellation_effective_dt,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 3 AS STRING) END AS current_version_no,
  o_orderstatus AS policy_status_cd,
  'Insured ' || CAST(o_custkey AS STRING) AS primary_insured_nm,
  'Underwriter ' || CAST(o_custkey % 40 AS STRING) AS underwriter_nm,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(1000 + o_orderkey % 9 AS STRING) END AS sic_cd,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'SIC ' || CAST(1000 + o_orderkey % 9 AS STRING) END
    AS sic_desc,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Entry A' ELSE 'Entry B' END AS policy_entry_system_desc,
  1 + o_orderkey % 3 AS source_system_id, md5(CAST(o_orderkey AS STRING)) AS policy_hash_txt,
  {", ".join(f"coalesce({f}, 0) AS {f}" for f in schema.PERIL_FLAGS)}
FROM {{orders}} LEFT JOIN (
  SELECT l_orderkey, {_flags()} FROM {{lineitem}} GROUP BY l_orderkey
) AS flags ON o_orderkey = l_orderkey
"""

_RISK = f"""
SELECT risk_id, max(l_orderkey) AS policy_term_id, min(l_suppkey) AS location_id,
  'BLDG' AS risk_catg_cd, 'Building' AS risk_catg_desc, 1 + risk_id % 3 AS source_system_id,
  md5(CAST(risk_id AS STRING)) AS risk_place_hash_txt
FROM (SELECT {_RISK_KEY} AS risk_id, l_orderkey, l_suppkey FROM {{lineitem}}) AS l
GROUP BY risk_id
"""

_RPP = f"""
SELECT risk_peril_product_id, max(risk_id) AS risk_id, max(l_linenumber) AS peril_id,
  min(l_partkey % 4) AS product_id,
  coalesce(max(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
                    THEN CAST(l_shipdate AS DATE) END),
           max(CASE WHEN l_orderkey % 3 = 0 THEN DATE '2099-12-31' END)) AS deleted_dt,
  'P' || CAST(max(l_linenumber) AS STRING) AS source_peril_cd,
  'Q' || CAST(min(l_partkey % 4) AS STRING) AS source_product_cd
FROM (SELECT {_RPP_KEY} AS risk_peril_product_id, {_RISK_KEY} AS risk_id, l_orderkey, l_partkey,
        l_linenumber, l_returnflag, l_linestatus, l_shipdate FROM {{lineitem}}) AS l
GROUP BY risk_peril_product_id
"""

_LINES_BY_RPP = f"""
(SELECT rpp_id, max(l_orderkey) AS term_id, max(l_linenumber) AS peril_no,
   max({_PRICE}) AS amt, max(l_quantity) AS qty
 FROM (SELECT {_RPP_KEY} AS rpp_id, l_orderkey, l_linenumber, l_extendedprice, l_quantity
       FROM {{lineitem}}) AS l
 GROUP BY rpp_id) AS r
"""

_DEDUCTIBLE = f"""
SELECT rpp_id AS deduct_property_structure_id, rpp_id AS risk_peril_product_id,
  CASE WHEN term_id % 5 IN (0, 1) THEN CASE WHEN peril_no IN (1, 4, 6) THEN 1000 ELSE 2500 END
       WHEN term_id % 35 = 3 THEN 0 END AS blanket_deductible_amt,
  CASE WHEN term_id % 5 = 2 THEN 2 END AS blanket_deductible_pcnt,
  CASE WHEN term_id % 5 IN (0, 1) THEN 'ALL' END AS blanket_deductible_cd,
  CASE WHEN qty < 20 THEN qty * 100 END AS building_deductible_amt,
  CASE WHEN qty > 40 OR qty < 4 THEN 5 END AS building_deductible_pcnt,
  CASE WHEN qty < 10 THEN qty * 50 END AS contents_deductible_amt,
  CASE WHEN qty > 45 THEN 2.5 END AS contents_deductible_pcnt,
  CASE WHEN qty < 10 THEN qty * 50 END AS bi_deductible_amt,
  CASE WHEN qty = 30 THEN 72 END AS bi_deductible_duration_no,
  CASE WHEN qty = 30 THEN 'HOURS' END AS bi_duration_unit_desc,
  1 AS source_system_id, md5(CAST(rpp_id AS STRING)) AS deductible_hash_txt
FROM {_LINES_BY_RPP}
"""

_LIMIT = f"""
SELECT rpp_id AS limit_property_structure_id, rpp_id AS risk_peril_product_id,
  CASE WHEN term_id % 7 = 0 THEN amt END AS blanket_limit_amt,
  CASE WHEN term_id % 7 = 0 THEN 'ALL' END AS blanket_limit_cd,
  CASE WHEN peril_no = 7 THEN 0 END AS blanket_building_limit_amt,
  CASE WHEN qty > 10 THEN amt END AS building_limit_amt,
  CASE WHEN qty > 45 THEN qty * 1000 WHEN qty > 25 THEN 0 END AS contents_limit_amt,
  CASE WHEN qty > 45 THEN amt END AS bi_limit_amt,
  1 AS source_system_id, md5(CAST(rpp_id AS STRING)) AS limit_hash_txt
FROM {_LINES_BY_RPP}
"""

_STRUCTURE = f"""
SELECT rps_id AS risk_property_structure_id, risk_id,
  CAST(1 + risk_id % 3 AS STRING) AS location_cd, CAST(1 + rps_id % 10 AS STRING) AS building_cd,
  'Structure ' || CAST(risk_id AS STRING) AS structure_desc,
  CASE WHEN risk_id % 13 = 0 THEN '' WHEN risk_id % 7 = 0 THEN '2.5'
       ELSE CAST(1 + risk_id % 12 AS STRING) END AS stories_no,
  CASE WHEN risk_id % 6 = 0 THEN '1900' ELSE CAST(1950 + risk_id % 60 AS STRING) END AS built_yr,
  CASE WHEN risk_id % 9 = 0 THEN '2001' END AS roof_update_yr,
  1000 + risk_id % 5000 AS square_footage_no,
  CASE WHEN risk_id % 4 = 0 THEN 'SRC' END AS construction_scheme_desc,
  CASE risk_id % 7 WHEN 0 THEN 'FRAME' WHEN 1 THEN 'FRAME ' WHEN 2 THEN 'NOT A CODE'
    WHEN 5 THEN 'UNKNOWN' WHEN 6 THEN 'NON-COMBUSTIBLE' END AS construction_cd,
  CASE risk_id % 7 WHEN 2 THEN 'JOISTED MASONRY' WHEN 3 THEN 'FIRE RESISTIVE '
    WHEN 6 THEN 'FRAME' END AS construction_desc,
  CASE WHEN risk_id % 5 <> 0 THEN 'OCC' END AS occupancy_scheme_desc,
  CASE WHEN risk_id % 5 <> 0 THEN CAST(300 + risk_id % 50 AS STRING) END AS occupancy_cd,
  CASE WHEN risk_id % 5 <> 0 THEN 'Occupancy ' || CAST(risk_id % 50 AS STRING) END
    AS occupancy_desc,
  1 + risk_id % 3 AS source_system_id,
  CASE WHEN risk_id % 17 = 0 THEN DATE '1998-09-30' WHEN risk_id % 3 = 0 THEN DATE '2099-12-31' END
    AS deleted_dt
FROM (
  SELECT rps_id, max(risk_id) AS risk_id FROM (
    SELECT {_RISK_KEY} AS risk_id,
      ({_RISK_KEY}) * 10 + CASE WHEN ({_RISK_KEY}) % 50 = 0 THEN l_linenumber % 2 ELSE 0 END
        AS rps_id
    FROM {{lineitem}}) AS l
  GROUP BY rps_id) AS s
"""

_COVERED = f"""
SELECT risk_id AS covered_property_structure_id, risk_id,
  CASE WHEN risk_id % 8 = 0 THEN 100 END AS building_percent_complete_no,
  max({_PRICE}) AS building_replacement_amt,
  CASE WHEN risk_id % 4 <> 0 THEN max(l_quantity) * 1000 END AS contents_replacement_amt,
  CASE WHEN risk_id % 3 <> 0 THEN min({_PRICE}) END AS business_int_replacement_amt,
  CASE WHEN risk_id % 8 = 1 THEN max({_PRICE}) END AS building_cvrg_a_amt,
  max(l_quantity) * 10 AS written_premium_amt, max(l_quantity) * 12 AS annualized_premium_amt,
  {", ".join(
      f"CASE WHEN risk_id % 23 <> 0 THEN max(CASE WHEN l_linenumber = {n} THEN 1 ELSE 0 END) END"
      f" AS {flag}" if flag == "hurricane_ind" else
      f"max(CASE WHEN l_linenumber = {n} THEN 1 ELSE 0 END) AS {flag}"
      for n, flag in enumerate(schema.PERIL_FLAGS, 1)
  )}
FROM (SELECT {_RISK_KEY} AS risk_id, l_extendedprice, l_quantity, l_linenumber
      FROM {{lineitem}}) AS l
GROUP BY risk_id
"""

_EXCESS = """
SELECT l_orderkey * 10 + l_linenumber AS excess_id, l_orderkey AS policy_term_id,
  CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN 8 ELSE l_linenumber END AS peril_id,
  CASE WHEN l_orderkey % 200 = 2 THEN 122 + l_linenumber % 2 ELSE 1 + l_linenumber % 2 END
    AS layer_no,
  1000000 * (1 + l_linenumber % 2) AS limit_amt,
  500000 * (1 + l_linenumber % 2) AS attachment_point_amt,
  1000000 * (1 + l_linenumber % 2) AS part_of_amt,
  CASE WHEN l_linenumber % 2 = 0 THEN 50 END AS part_of_pcnt
FROM (
  SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}
  INNER JOIN {orders} ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P') AS x
"""

_LOCATION = """
SELECT s_suppkey AS location_id, 'Place ' || CAST(s_suppkey AS STRING) AS place_desc,
  s_name AS street_address_1_txt, 'City ' || CAST(s_suppkey % 40 AS STRING) AS city_nm,
  n_name AS state_province_cd, n_name AS state_province_nm,
  lpad(CAST(s_suppkey AS STRING), 6, '0') AS postal_cd,
  CAST(n_nationkey AS STRING) AS county_cd, n_name AS county_nm,
  CASE n_regionkey WHEN 1 THEN 'CA' WHEN 4 THEN 'MX' ELSE 'US' END AS country_cd,
  'ISO' AS country_schema_cd
FROM {supplier} INNER JOIN {nation} ON s_nationkey = n_nationkey
"""

_FACULTATIVE = f"""
SELECT {_RISK_KEY} AS risk_id, l_linenumber AS peril_id, 1 AS layer_no, 10 AS ceded_pcnt
FROM {{lineitem}} WHERE l_linenumber = 1 AND l_quantity > 45
"""

BODIES: dict[str, str] = {
    "policy_term": _POLICY_TERM,
    "risk": _RISK,
    "risk_peril_product": _RPP,
    "deductible_property_structure": _DEDUCTIBLE,
    "limit_property_structure": _LIMIT,
    "risk_property_structure": _STRUCTURE,
    "covered_property_structure": _COVERED,
    "excess": _EXCESS,
    "location": _LOCATION,
    "facultative": _FACULTATIVE,
    "peril": _rows(
        "peril_id, peril_cd, peril_desc",
        [(n, p, f"Peril {p}") for n, p in enumerate((*PERILS, NO_PERIL), 1)],
    ),
    "product": _rows(
        "product_id, product_cd, product_desc",
        [(n, p, f"Product {p}") for n, p in enumerate(("PIMPROPEX", "DPG", "PROP", "DIC"))],
    ),
    "source_system": _rows(
        "source_system_id, source_system_cd, source_system_desc",
        [(n, f"S{n}", f"System {n}") for n in (1, 2)],
    ),
    "policy": "SELECT c_custkey AS policy_id, c_custkey AS customer_id FROM {customer}",
    "customer": """
SELECT c_custkey AS customer_id, c_name AS customer_cd, c_mktsegment AS customer_nm
FROM {customer}""",
    "company": """
SELECT r_regionkey AS company_id, 'C' || CAST(r_regionkey AS STRING) AS company_cd,
  r_name AS company_nm, substring(r_name, 1, 2) AS company_abrv_cd FROM {region}""",
    "producer_profit_center_bu": """
SELECT n_nationkey AS producer_profit_center_bu_id, CAST(n_nationkey AS STRING) AS producer_cd,
  n_name AS producer_desc,
  CASE WHEN n_nationkey = 3 THEN '2758' ELSE CAST(2700 + n_nationkey AS STRING) END
    AS profit_center_cd,
  'Centre ' || n_name AS profit_center_desc FROM {nation}""",
    "d_policy": """
SELECT o_orderkey AS policy_id,
  CASE o_orderstatus WHEN 'F' THEN 'CPP' WHEN 'O' THEN 'DIC' ELSE 'EXC' END AS policy_symbol,
  lpad(CAST(o_orderkey AS STRING), 7, '0') AS policy_number,
  lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') AS policy_module,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 3 AS STRING) END AS policy_version_cd
FROM {orders} WHERE o_orderkey % 8 <> 0""",
    "f_divisional_premiums": f"""
SELECT l_orderkey AS policy_id, l_linenumber AS written_transaction_id,
  {_PRICE} AS change_written_premium, year(l_shipdate) AS transaction_accounting_year
FROM {{lineitem}}""",
    "d_transaction_items": _rows(
        "transaction_items_id, rein_transaction_type_desc",
        [(n, ("Ceded", "Direct")[n % 2]) for n in range(1, 8)] + [(5, "Direct Funded")],
    ),
    "d_producer": """
SELECT CAST(n_nationkey AS STRING) AS producer_code, n_name AS location_state,
  CAST(n_nationkey % 7 AS STRING) AS state_number FROM {nation} WHERE n_nationkey <> 8""",
    "d_geography": """
SELECT n_name AS state_province_code, CAST(n_nationkey % 7 AS STRING) AS rein_state_province_code,
  CASE n_regionkey WHEN 1 THEN 'CAN' WHEN 2 THEN 'MEX' ELSE 'US' END AS country_code
FROM {nation}""",
    "construction_lookup": _rows(
        "construction_desc, construction_no, source_system_id",
        [(t, n, s) for t, n in CONSTRUCTION_NUMBERS.items() for s in (1, 2)],
    ),
    "occupancy_codes": _rows(
        "code, description, region",
        [(str(c), f"Occupancy {c} {r}", r) for c in range(300, 307) for r in ("US", "CA")],
    ),
    "construction_codes": _rows(
        "code, category, description, region",
        [
            (str(c), f"Group {c % 3}", f"Construction {c} {r}", r)
            for c in range(100, 105)
            for r in ("US", "CA")
        ],
    ),
}

_CONTRACT_KEY = """
CASE o_orderstatus WHEN 'F' THEN 'CPP' WHEN 'O' THEN 'DIC' ELSE 'EXC' END
  || lpad(CAST(o_orderkey AS STRING), 7, '0')
  || CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') END
"""


def _in_force(day: date) -> str:
    return (
        f"CAST(o_orderdate AS DATE) <= DATE '{day}' AND "
        f"CAST(o_orderdate AS DATE) + 365 > DATE '{day}'"
    )


def contract_snapshot(day: date) -> str:
    """Contract file rows of one snapshot."""
    return f"""
SELECT ContractID,
  CASE term_id % 4 WHEN 0 THEN ContractID WHEN 1 THEN ContractID || '-01'
    WHEN 2 THEN number_txt || '-' || module_txt ELSE 'BAD' || CAST(term_id AS STRING) END
    || CASE WHEN term_id % 40 = 0 THEN ' ' ELSE '' END AS LayerID,
  CASE term_id % 6 WHEN 1 THEN '' WHEN 2 THEN 'PWH' WHEN 3 THEN 'PWH, PES' WHEN 4 THEN 'PES'
    WHEN 5 THEN 'PFL' END AS SublimitPerils
FROM (
  SELECT {_CONTRACT_KEY} AS ContractID, o_orderkey AS term_id,
    lpad(CAST(o_orderkey AS STRING), 7, '0') AS number_txt,
    lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') AS module_txt
  FROM {{orders}} WHERE {_in_force(day)}) AS t
"""


_RISKS_OF_LINES = f"""  SELECT {_RISK_KEY} AS risk_id, max(l_orderkey) AS term_id, min(l_suppkey) AS place_id,
    max({_PRICE}) AS amt, max(l_quantity) AS qty
  FROM {{lineitem}} GROUP BY {_RISK_KEY}"""
_RISKS_OF_GROUPS = "  SELECT risk_id, term_id, place_id, amt, qty FROM {by_risk}"


def location_snapshot(day: date) -> str:
    """Location file rows of one snapshot. Codes move with the date, one state is new in the
    latest snapshot, one is lost, one holds no value."""
    shift = day.year + day.month
    hidden = 3 if day < SNAPSHOTS["current"] else 9
    return f"""
SELECT CASE WHEN term_id % 31 = 0 THEN 'LOST' || CAST(term_id AS STRING) ELSE ContractID END
    AS ContractID,
  CASE WHEN risk_id % 97 = 0 THEN NULL ELSE 'L' || CAST(risk_id AS STRING) END AS LocationID,
  CASE WHEN risk_id % 29 = 0 THEN '' WHEN n_nationkey = 7 THEN '0' ELSE CAST(amt AS STRING) END
    AS BuildingValue,
  CASE WHEN risk_id % 41 = 0 THEN NULL ELSE '0' END AS OtherValue,
  CASE WHEN n_nationkey = 7 THEN '0'
    ELSE CAST(CAST(qty * 1000 AS DECIMAL(18,2)) AS STRING) END AS ContentsValue,
  CASE WHEN n_nationkey = 7 THEN '0'
    ELSE CAST(CAST(qty * 10 AS DECIMAL(18,2)) AS STRING) END AS TimeElementValue,
  CASE WHEN qty < 20 THEN CAST(CAST(qty * 100 AS DECIMAL(18,2)) AS STRING) ELSE '' END
    AS DeductBldg,
  CASE WHEN risk_id % 5 <> 0 THEN CAST(300 + (risk_id + {shift}) % (6 + {shift} % 3) AS STRING)
    END AS OccupancyCode,
  CAST(100 + risk_id % 6 AS STRING) AS ConstructionCode,
  CASE n_regionkey WHEN 1 THEN 'CA' WHEN 4 THEN 'MX' ELSE 'US' END AS CountryISO,
  CASE WHEN n_nationkey <> 24 THEN n_name END AS Area
FROM (
{_RISKS_OF_LINES}) AS r
INNER JOIN (
  SELECT o_orderkey, {_CONTRACT_KEY} AS ContractID FROM {{orders}}
  WHERE {_in_force(day)} AND o_orderkey % 37 <> 0) AS c ON term_id = o_orderkey
INNER JOIN {{supplier}} ON place_id = s_suppkey
INNER JOIN {{nation}} ON s_nationkey = n_nationkey
WHERE n_nationkey <> {hidden}
"""


def reinsurance_snapshot(day: date) -> str:
    """Reinsurance rows: every third contract, some pointing at no layer."""
    return f"""
SELECT ContractID,
  CASE WHEN term_id % 7 = 0 THEN number_txt || '-' || module_txt
       WHEN term_id % 5 = 0 THEN 'NONE' || CAST(term_id AS STRING) ELSE ContractID END
    AS ExposureID
FROM (
  SELECT {_CONTRACT_KEY} AS ContractID, o_orderkey AS term_id,
    lpad(CAST(o_orderkey AS STRING), 7, '0') AS number_txt,
    lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') AS module_txt
  FROM {{orders}} WHERE o_orderkey % 3 = 0 AND {_in_force(day)}) AS t
"""


def typed_body(table: str, body: str = "") -> str:
    """SELECT giving a table its full column list and types, absent columns as NULL. ``body``
    reads the same columns from elsewhere."""
    body = body or BODIES[table]
    columns = []
    for name in schema.columns(table):
        known = re.search(rf"\b{name}\b", body)
        columns.append(f"CAST({name if known else 'NULL'} AS {schema.column_type(name)}) AS {name}")
    return f"SELECT {', '.join(columns)} FROM ({body}) AS b"


BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}
# Tables grouped or joined out of orders and lines: what they are grouped from is written once
# per session, as a mart is loaded before its queries run. The other tables are plain
# projections and stay lazy.
LOADED = ("policy_term", "risk", "risk_peril_product", "risk_property_structure",
          "covered_property_structure", "limit_property_structure",
          "deductible_property_structure", "excess")
# Rows per task where lines are grouped, about.
ROWS_PER_TASK = 250_000

_DAY_GONE = "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END"
_NARROW_LINES = f"""
SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey % 4 AS product_no,
  {_PRICE} AS amt, l_quantity AS qty, {_DAY_GONE} AS gone_dt
FROM {{lineitem}}"""
# The least amount is written only where it is not the largest as well, as it is of a line alone.
_LINES = f"""
SELECT {_RISK_KEY} AS risk_id, l_orderkey, l_linenumber, min(l_suppkey) AS l_suppkey,
  min(product_no) AS product_no, max(amt) AS amt, nullif(min(amt), max(amt)) AS lesser_amt,
  max(qty) AS qty, max(gone_dt) AS gone_dt
FROM {{dealt}} GROUP BY {_RISK_KEY}, l_orderkey, l_suppkey % 2, l_linenumber"""
# Columns of lines that are written under the mart's names.
_MART_NAMES = {"l_orderkey": "policy_term_id", "product_no": "product_id"}
_BY_RISK = f"""
SELECT risk_id, max(l_orderkey) AS term_id, min(l_suppkey) AS place_id, max(amt) AS amt,
  min(coalesce(lesser_amt, amt)) AS least_amt, max(qty) AS qty, {_flags()}
FROM {{lines}} GROUP BY risk_id"""
_RPP_LINES = f"""
SELECT {_RPP_KEY} AS rpp_id, risk_id, l_orderkey AS term_id, l_linenumber AS peril_no, product_no,
  amt, qty, gone_dt, CASE WHEN l_orderkey % 3 = 0 THEN DATE '2099-12-31' END AS far_dt
FROM {{lines}}"""
_BY_RPP = """
SELECT rpp_id, max(risk_id) AS risk_id, max(term_id) AS term_id, max(peril_no) AS peril_no,
  min(product_no) AS product_no, max(amt) AS amt, max(qty) AS qty, max(gone_dt) AS gone_dt,
  max(far_dt) AS far_dt
FROM {dealt} GROUP BY rpp_id"""
# Lines that give a key that no other line like them gives.
_OWN_RPP = "l_orderkey IS NOT NULL AND l_suppkey >= 0 AND l_linenumber BETWEEN 0 AND 9"
_STRUCTURE_LINES = """
SELECT risk_id, risk_id * 10 + CASE WHEN risk_id % 50 = 0 THEN l_linenumber % 2 ELSE 0 END AS rps_id
FROM {lines}"""
_BY_STRUCTURE = "SELECT rps_id, max(risk_id) AS risk_id FROM {dealt} GROUP BY rps_id"
# A structure's id without a line number is NULL, one for all such risks; any other tells its risk.
_OWN_STRUCTURE = "risk_id IS NOT NULL AND l_linenumber IS NOT NULL"
_OWN_STRUCTURES = f"SELECT DISTINCT risk_id, rps_id FROM ({_STRUCTURE_LINES}) AS s"
# Flags are combined by risk where the lines lie, a bit each, so two narrow rows an order, about,
# are shuffled.
_RISK_FLAGS = f"""
SELECT l_orderkey, bit_or(CASE WHEN l_linenumber BETWEEN 1 AND {len(schema.PERIL_FLAGS)}
  THEN shiftleft(1, l_linenumber - 1) ELSE 0 END) AS bits
FROM {{lines}} GROUP BY risk_id, l_orderkey"""
_ORDER_FLAGS = ", ".join(
    f"shiftright(bit_or(bits), {n}) & 1 AS {flag}" for n, flag in enumerate(schema.PERIL_FLAGS)
)
# Dates lie under the mart's names and types, so that conditions on them reach the files.
_FLAGGED_ORDERS = f"""
SELECT * EXCEPT (o_orderdate), CAST(o_orderdate AS DATE) AS policy_term_effective_dt,
  CAST(o_orderdate AS DATE) + 365 AS policy_term_expiration_dt
FROM {{dealt_orders}} LEFT JOIN (
  SELECT l_orderkey, {_ORDER_FLAGS}
  FROM {{dealt_flags}} GROUP BY l_orderkey) AS flags ON o_orderkey = l_orderkey"""


def _head(table: str, **names: str) -> str:
    """Columns of a table's SELECT, with aggregates read under the names they were written as."""
    head = BODIES[table].split("\nFROM ")[0]
    for name, aggregate in names.items():
        head = head.replace(aggregate, name)
    return head


_LINE_FLAGS = {
    flag: f"max(CASE WHEN l_linenumber = {n} THEN 1 ELSE 0 END)"
    for n, flag in enumerate(schema.PERIL_FLAGS, 1)
}
# Table -> its SELECT from the groups written.
_FROM_GROUPS: dict[str, str] = {
    "policy_term": _head(
        "policy_term",
        policy_term_expiration_dt="CAST(o_orderdate AS DATE) + 365 AS policy_term_expiration_dt",
        policy_term_effective_dt="CAST(o_orderdate AS DATE) AS policy_term_effective_dt",
    ).replace("CAST(o_orderdate AS DATE)", "policy_term_effective_dt") + "\nFROM {flagged_orders}",
    "risk": _head("risk", term_id="max(l_orderkey)", place_id="min(l_suppkey)")
    + "\nFROM {by_risk}",
    "covered_property_structure": _head(
        "covered_property_structure", amt=f"max({_PRICE})", least_amt=f"min({_PRICE})",
        qty="max(l_quantity)", **_LINE_FLAGS,
    ) + "\nFROM {by_risk}",
    "risk_property_structure": _head("risk_property_structure") + "\nFROM {by_structure}",
    "risk_peril_product": """
SELECT rpp_id AS risk_peril_product_id, risk_id, peril_no AS peril_id, product_no AS product_id,
  coalesce(gone_dt, far_dt) AS deleted_dt, 'P' || CAST(peril_no AS STRING) AS source_peril_cd,
  'Q' || CAST(product_no AS STRING) AS source_product_cd
FROM {by_rpp}""",
    "deductible_property_structure": _head("deductible_property_structure") + "\nFROM {by_rpp}",
    "limit_property_structure": _head("limit_property_structure") + "\nFROM {by_rpp}",
    "excess": BODIES["excess"].replace("{lineitem}", "{lines}"),
}


def base_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        t: spark.read.schema(ddl).parquet(f"{sf_dir}/{t}.parquet")
        for t, ddl in BASE_SCHEMAS.items()
    }


def _run(spark: SparkSession, bases: Mapping[str, DataFrame], body: str) -> DataFrame:
    used = {t: bases[t] for t in dict.fromkeys(re.findall(r"\{(\w+)\}", body))}
    return spark.sql(body, **used)


class _Groups(Mapping[str, DataFrame]):
    """Base tables of one folder, and what is grouped from them: each group is written on first
    use and read back."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._stage = Stage.of(spark)
        self._bases = base_frames(spark, sf_dir)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._bases:
            return self._bases[name]
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter((*self._bases, *self._made))

    def __len__(self) -> int:
        return len(self._bases) + len(self._made)

    def kept(self, name: str, body: str) -> DataFrame:
        """The rows of a SELECT, written on first use."""
        if name not in self._made:
            self._made[name] = self._stage.keep(_run(self._spark, self, body), name)
        return self._made[name]

    def _dealt(self, source: str, rows: str, key: str) -> tuple[DataFrame, int]:
        """The rows that a SELECT makes of ``source``, dealt by ``key`` to as many tasks as their
        number asks for, and that many. Keys are nearly unique: grouped before the shuffle they
        would hold a whole input split and combine nothing."""
        tasks = 1 + self[source].count() // ROWS_PER_TASK
        return _run(self._spark, self, rows).repartition(tasks, F.expr(key)), tasks

    def _grouped(self, name: str, rows: str, groups: str, key: str) -> DataFrame:
        dealt, _ = self._dealt("lines", rows, key)
        return self._stage.keep(self._spark.sql(groups, dealt=dealt), name)

    def _all_lines(self, condition: str) -> bool:
        return self["lines"].filter(~F.coalesce(F.expr(condition), F.lit(False))).isEmpty()

    def _lines(self) -> DataFrame:
        """The only rows of lines that are written, in buckets by risk: what is grouped or joined
        by risk is grouped and joined where it lies."""
        dealt, tasks = self._dealt("lineitem", _NARROW_LINES, _RISK_KEY)
        lines = self._spark.sql(_LINES, dealt=dealt).withColumnsRenamed(_MART_NAMES)
        kept = self._stage.keep_bucketed(lines, "lines", "risk_id", tasks)
        return kept.withColumnsRenamed({mart: name for name, mart in _MART_NAMES.items()})

    def _by_risk(self) -> DataFrame:
        return _run(self._spark, self, _BY_RISK)

    def _by_structure(self) -> DataFrame:
        """Groups by structure, which lie with their risk where every id tells it."""
        if self._all_lines(_OWN_STRUCTURE):
            return _run(self._spark, self, _OWN_STRUCTURES)
        return self._grouped("by_structure", _STRUCTURE_LINES, _BY_STRUCTURE, "rps_id")

    def _by_rpp(self) -> DataFrame:
        """Groups by risk-peril-product id. Where every line is alone in its group, the lines
        themselves are the groups."""
        if self._all_lines(_OWN_RPP):
            return _run(self._spark, self, _RPP_LINES)
        return self._grouped("by_rpp", _RPP_LINES, _BY_RPP, "rpp_id")

    def _flagged_orders(self) -> DataFrame:
        """Orders with flags, in buckets by order: of terms only those that meet them are moved.
        Both sides are dealt as the buckets ask, so they are joined and written where they lie."""
        tasks = 1 + self["orders"].count() // ROWS_PER_TASK
        sides = {
            "dealt_orders": self["orders"].repartition(tasks, "o_orderkey"),
            "dealt_flags": _run(self._spark, self, _RISK_FLAGS).repartition(tasks, "l_orderkey"),
        }
        flagged = self._spark.sql(_FLAGGED_ORDERS, **sides)
        return self._stage.keep_bucketed(flagged, "flagged_orders", "o_orderkey", tasks)


_groups: dict[tuple[str, str], _Groups] = {}


def _groups_of(spark: SparkSession, sf_dir: str) -> _Groups:
    key = (spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _groups:
        _groups[key] = _Groups(spark, sf_dir)
    return _groups[key]


def mart_of_testdata(spark: SparkSession, sf_dir: str) -> Mart:
    groups = _groups_of(spark, sf_dir)

    def build(table: str) -> DataFrame:
        if table == "excess":
            return groups.kept(table, typed_body(table, _FROM_GROUPS[table]))
        return _run(spark, groups, typed_body(table, _FROM_GROUPS.get(table, BODIES[table])))

    return Mart(spark, build)


class _LocationFiles(Mapping[str, DataFrame]):
    """Location snapshots; each is written when it is first asked for."""

    def __init__(self, groups: _Groups):
        self._groups = groups

    def __getitem__(self, name: str) -> DataFrame:
        body = location_snapshot(SNAPSHOTS[name]).replace(_RISKS_OF_LINES, _RISKS_OF_GROUPS)
        return self._groups.kept(f"location_{name}", body)

    def __iter__(self) -> Iterator[str]:
        return iter(SNAPSHOTS)

    def __len__(self) -> int:
        return len(SNAPSHOTS)


def snapshots_of_testdata(spark: SparkSession, sf_dir: str, kind: str) -> Mapping[str, DataFrame]:
    """Snapshot name -> file rows, for ``contract``, ``location`` or ``reinsurance``."""
    groups = _groups_of(spark, sf_dir)
    if kind == "location":
        return _LocationFiles(groups)
    make = {"contract": contract_snapshot, "reinsurance": reinsurance_snapshot}[kind]
    return {name: _run(spark, groups, make(day)) for name, day in SNAPSHOTS.items()}
