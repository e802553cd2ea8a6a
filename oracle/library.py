"""Independent SQL for every registered query, run by DuckDB on the same tables.

The SQL spells the semantics out the long way (every join in full, windows, self joins),
without the shortcuts the Spark side takes. Steps are named sub-queries; ``with_steps``
puts in front of a query those it needs.
"""

from __future__ import annotations

import re

from perilframe import schema
from perilframe.functions import fixed, layout
from perilframe.functions.fixed import CONSTRUCTION_NUMBERS, PERILS
from perilframe.sources import testdata as td

SOURCE_TAG = "SRC"

D = "DATE '1998-12-31'"
NOW = "TIMESTAMP '2000-01-01 00:00:00'"
FLAGS = schema.PERIL_FLAGS
ADDRESS = schema.ADDRESS

STEPS: dict[str, str] = {}
for _table in td.BODIES:
    STEPS[f"m_{_table}"] = td.typed_body(_table).format(**{t: t for t in td.BASE_TABLES})


def with_steps(query: str) -> str:
    """Prefix a query with the steps it uses, in order of definition."""
    needed: set[str] = set()
    todo = [query]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        new = (words & STEPS.keys()) - needed
        needed |= new
        todo += [STEPS[n] for n in new]
    steps = ",\n".join(f"{n} AS ({sql})" for n, sql in STEPS.items() if n in needed)
    return f"WITH {steps}\n{query}" if steps else query


def cols(alias: str, names) -> str:
    return ", ".join(f"{alias}.{n}" for n in names)


def text(*parts: str) -> str:
    """Join texts reading NULL as empty, NULL when nothing is left."""
    return "NULLIF(concat(" + ", ".join(parts) + "), '')"


def spm(t: str = "t") -> str:
    return text(f"{t}.policy_symbol_cd", f"{t}.policy_number_cd", f"{t}.policy_module_cd")


def spmv(t: str = "t") -> str:
    return text(f"{t}.policy_symbol_cd", f"{t}.policy_number_cd", f"{t}.policy_module_cd",
                f"{t}.current_version_no")


def spmvl(t: str = "t", x: str = "x") -> str:
    suffix = (f"CASE WHEN {x}.policy_term_id IS NOT NULL "
              f"THEN concat('-', lpad(CAST({x}.layer_no AS VARCHAR), 2, '0')) END")
    return text(f"{t}.policy_symbol_cd", f"{t}.policy_number_cd", f"{t}.policy_module_cd",
                f"{t}.current_version_no", suffix)


def lob(unit: str, product: str) -> str:
    return (f"CASE WHEN {unit} = 'PIM' AND {product} = 'PIMPROPEX' THEN 'PIMx' "
            f"WHEN {unit} = 'PIM' THEN 'PIMt' WHEN {unit} = 'AED' THEN 'ALT' "
            f"WHEN {unit} = 'GARS' AND {product} = 'DPG' THEN 'GARS_Condo' ELSE {unit} END")


def number(x: str) -> str:
    return f"rtrim(rtrim(CAST({x} AS VARCHAR), '0'), '.')"


# --- policies in force ---------------------------------------------------------------

_PIF = """
SELECT DISTINCT t.policy_term_id, t.business_unit_cd, p.product_id, p.product_cd, p.product_desc,
  {D} AS mod_period
FROM m_policy_term t
JOIN m_risk r ON r.policy_term_id = t.policy_term_id
JOIN m_risk_peril_product q ON q.risk_id = r.risk_id
JOIN m_product p ON p.product_id = q.product_id
WHERE t.policy_term_effective_dt <= {D} AND t.policy_term_expiration_dt > {D} {more}
"""
STEPS["pif_c"] = _PIF.format(
    D=D,
    more=f"AND (t.cancellation_effective_dt > {D} OR t.cancellation_effective_dt IS NULL)",
)
STEPS["pif_l"] = _PIF.format(D=D, more="")
for _side in "cl":
    STEPS[f"folded_{_side}"] = "SELECT policy_term_id, business_unit_cd, mod_period, " + ", ".join(
        f"string_agg(CAST({c} AS VARCHAR), '___' ORDER BY product_id) AS {c}"
        for c in ("product_id", "product_cd", "product_desc")
    ) + f" FROM pif_{_side} GROUP BY ALL"
STEPS["numbered"] = """
SELECT *, row_number() OVER (PARTITION BY business_unit_cd, product_desc
  ORDER BY policy_term_id DESC, product_id) AS bu_product_row_number FROM pif_l"""

# --- premium and layers --------------------------------------------------------------

STEPS["links"] = """
SELECT f.policy_term_id, d.policy_id FROM folded_c f
LEFT JOIN m_policy_term t ON t.policy_term_id = f.policy_term_id
LEFT JOIN m_d_policy d ON d.policy_symbol = t.policy_symbol_cd
  AND d.policy_number = t.policy_number_cd AND d.policy_module = t.policy_module_cd
  AND d.policy_version_cd = t.current_version_no"""
STEPS["premium"] = f"""
SELECT l.policy_term_id, l.policy_id,
  CAST(sum(p.change_written_premium) AS DECIMAL(38,2)) AS total_policy_premium
FROM links l
LEFT JOIN m_f_divisional_premiums p ON p.policy_id = l.policy_id
  AND p.transaction_accounting_year >= year({NOW}) - 5
LEFT JOIN m_d_transaction_items i ON i.transaction_items_id = p.written_transaction_id
  AND i.rein_transaction_type_desc IN ('Direct', 'Direct Funded')
GROUP BY l.policy_term_id, l.policy_id"""
_LAYER_TERMS = ("limit_amt", "attachment_point_amt", "part_of_amt", "part_of_pcnt")
_LAYER_FLAGS = tuple(f"layer_{f}" for f in FLAGS) + ("layer_none_ind",)
STEPS["exc"] = f"""
SELECT x.policy_term_id, x.layer_no, {cols("x", _LAYER_TERMS)},
  {", ".join(f"CAST(count(*) FILTER (WHERE p.peril_cd = '{p}') AS BIGINT) AS {f}"
             for p, f in zip((*PERILS, "(none)"), _LAYER_FLAGS))}
FROM m_excess x LEFT JOIN m_peril p ON p.peril_id = x.peril_id
GROUP BY x.policy_term_id, x.layer_no, {cols("x", _LAYER_TERMS)}"""
STEPS["lay"] = f"""
SELECT f.mod_period, t.policy_term_id, t.company_id, t.producer_profit_center_bu_id,
  t.business_unit_cd, t.business_unit_desc, b.profit_center_cd, b.profit_center_desc,
  b.producer_cd, b.producer_desc, g.country_code AS producer_country_cd, c.customer_cd,
  {spm()} AS spm, {spmv()} AS spmv, {spmvl()} AS spmvl, f.product_cd, f.product_desc,
  t.policy_symbol_cd, t.policy_symbol_desc, t.policy_number_cd, t.policy_module_cd,
  t.current_version_no, t.primary_insured_nm, t.policy_term_effective_dt,
  t.policy_term_expiration_dt, t.cancellation_effective_dt, m.company_cd, m.company_nm,
  m.company_abrv_cd, CASE WHEN x.policy_term_id IS NULL THEN 0 ELSE 1 END AS excess_policy_ind,
  {", ".join(f"t.{f} AS policy_{f}" for f in FLAGS)}, t.underwriter_nm,
  x.layer_no AS excess_layer_no, {", ".join(f"x.{c} AS excess_{c}" for c in _LAYER_TERMS)},
  {", ".join(f"x.{f} AS excess_{f}" for f in _LAYER_FLAGS)}, t.policy_entry_system_desc
FROM folded_c f
LEFT JOIN m_policy_term t ON t.policy_term_id = f.policy_term_id
LEFT JOIN m_policy y ON y.policy_id = t.policy_id
LEFT JOIN m_customer c ON c.customer_id = y.customer_id
LEFT JOIN m_producer_profit_center_bu b
  ON b.producer_profit_center_bu_id = t.producer_profit_center_bu_id
LEFT JOIN m_d_producer d ON d.producer_code = b.producer_cd
LEFT JOIN m_d_geography g ON g.state_province_code = d.location_state
  AND g.rein_state_province_code = d.state_number
LEFT JOIN m_company m ON m.company_id = t.company_id
LEFT JOIN exc x ON x.policy_term_id = t.policy_term_id"""
STEPS["layer_cnt"] = """
SELECT policy_term_id, CAST(sum(excess_policy_ind) AS BIGINT) AS layer_count
FROM lay GROUP BY policy_term_id"""
STEPS["peril_cnt"] = f"""
SELECT DISTINCT policy_term_id,
  CAST({" + ".join(f"policy_{f}" for f in FLAGS)} AS BIGINT) AS policy_peril_count,
  CAST({" + ".join(f"excess_layer_{f}" for f in FLAGS)} AS BIGINT) AS excess_layer_peril_count
FROM lay"""
STEPS["risk_cnt"] = """
SELECT l.policy_term_id, count(*) AS risk_count FROM lay l
LEFT JOIN m_risk r ON r.policy_term_id = l.policy_term_id GROUP BY l.policy_term_id"""

# --- details ---------------------------------------------------------------------------

_LAYER_COLUMNS = ("mod_period", "policy_term_id", "business_unit_cd", "business_unit_desc",
                  "profit_center_cd", "profit_center_desc", "producer_cd", "producer_desc", "spmv")
_STRUCTURE = ("risk_property_structure_id", "structure_desc", "stories_no", "square_footage_no",
              "construction_scheme_desc", "construction_cd", "construction_desc",
              "occupancy_scheme_desc", "occupancy_cd", "occupancy_desc")


def _insured(product: str) -> str:
    return f"""
FROM lay l JOIN m_risk r ON r.policy_term_id = l.policy_term_id
JOIN m_location a ON a.location_id = r.location_id
JOIN m_risk_property_structure s ON s.risk_id = r.risk_id
  AND (s.deleted_dt > l.mod_period OR s.deleted_dt IS NULL)
JOIN m_risk_peril_product q ON q.risk_id = r.risk_id
  AND (q.deleted_dt > l.mod_period OR q.deleted_dt IS NULL)
{product} JOIN m_product p ON p.product_id = q.product_id
LEFT JOIN m_peril k ON k.peril_id = q.peril_id"""


STEPS["dd"] = f"""
SELECT {cols("l", _LAYER_COLUMNS)}, r.risk_id, s.location_cd, s.building_cd, p.product_cd,
  k.peril_id, k.peril_cd, k.peril_desc, {cols("a", ADDRESS)}, {cols("s", _STRUCTURE)},
  d.deduct_property_structure_id, d.risk_peril_product_id,
  {cols("d", schema.BLANKET_DEDUCTIBLES)}, {cols("d", schema.SITE_DEDUCTIBLES)},
  d.source_system_id, d.create_ts, d.update_ts, d.deductible_hash_txt
{_insured("INNER")}
LEFT JOIN m_deductible_property_structure d ON d.risk_peril_product_id = q.risk_peril_product_id"""
STEPS["ldt"] = f"""
SELECT {cols("l", _LAYER_COLUMNS)}, r.risk_id, s.location_cd, s.building_cd, p.product_cd,
  k.peril_id, k.peril_desc, {cols("a", ADDRESS)}, {cols("s", _STRUCTURE)},
  m.risk_peril_product_id, m.limit_property_structure_id, {cols("m", schema.BLANKET_LIMITS)},
  {cols("m", schema.SITE_LIMITS)}, m.source_system_id, m.create_ts, m.update_ts, m.limit_hash_txt
{_insured("LEFT")}
LEFT JOIN m_limit_property_structure m ON m.risk_peril_product_id = q.risk_peril_product_id"""
STEPS["risk_peril_cnt"] = """
SELECT policy_term_id, peril_id, count(DISTINCT risk_id) AS policy_peril_risk_count
FROM ldt GROUP BY ALL"""
_LIMITS = (*schema.BLANKET_LIMITS, *schema.SITE_LIMITS)
STEPS["limit_grp"] = f"""
SELECT policy_term_id, spmv, peril_id, peril_desc, {", ".join(_LIMITS)},
  count(DISTINCT risk_id) AS policy_peril_location_count FROM ldt GROUP BY ALL"""
_SIX = ("blanket_building_limit_amt", "blanket_contents_limit_amt", "blanket_bi_limit_amt",
        "blanket_combined_limit_amt", "site_limit_amt", "combined_limit_amt")
STEPS["limit_blk"] = f"""
SELECT g.*, c.risk_count,
  CASE WHEN g.policy_peril_location_count = c.risk_count AND c.risk_count <> 1 THEN 1 ELSE 0 END
    AS policy_blanket_ind
FROM limit_grp g LEFT JOIN risk_cnt c ON c.policy_term_id = g.policy_term_id
WHERE NOT ({" AND ".join(
    [f"(g.{c} IS NULL OR g.{c} = 0)" for c in
     ("blanket_limit_amt", "building_limit_amt", "contents_limit_amt", "bi_limit_amt")]
    + [f"(g.{c} IS NULL AND g.{c} = 0)" for c in _SIX])})"""

# --- blanket deductibles ---------------------------------------------------------------

_SUB = tuple(f"sublimit_{f}" for f in FLAGS)
STEPS["bpd"] = f"""
SELECT policy_term_id, peril_cd,
  {", ".join(f"CASE WHEN peril_cd = '{p}' THEN 1 ELSE 0 END AS {f}" for p, f in zip(PERILS, _SUB))},
  {", ".join(schema.BLANKET_DEDUCTIBLES)}, count(*) AS blanket_risk_count FROM dd GROUP BY ALL"""
STEPS["grp"] = f"""
SELECT *, CASE WHEN blanket_risk_count = policy_risk_count THEN 1 ELSE 0 END AS policy_blanket_ind
FROM (
  SELECT b.policy_term_id, c.risk_count AS policy_risk_count, n.policy_peril_count,
    b.blanket_deductible_amt, b.blanket_deductible_pcnt, b.blanket_risk_count,
    count(*) AS blanket_peril_count, {", ".join(f"max(b.{f}) AS {f}" for f in _SUB)},
    string_agg(b.peril_cd, ', ' ORDER BY b.peril_cd) AS peril_cd_list
  FROM bpd b LEFT JOIN risk_cnt c ON c.policy_term_id = b.policy_term_id
  LEFT JOIN peril_cnt n ON n.policy_term_id = b.policy_term_id
  WHERE (b.blanket_deductible_amt IS NOT NULL AND b.blanket_deductible_amt <> 0)
     OR (b.blanket_deductible_pcnt IS NOT NULL AND b.blanket_deductible_pcnt <> 0)
  GROUP BY b.policy_term_id, c.risk_count, n.policy_peril_count, b.blanket_deductible_amt,
    b.blanket_deductible_pcnt, b.blanket_risk_count)"""
_VALUE = ("CAST(coalesce(CAST(blanket_deductible_amt AS DECIMAL(20,4)), blanket_deductible_pcnt) "
          "AS DECIMAL(20,4))")
_SUBLIMIT = "policy_blanket_ind = 1 AND sublimit_fire_ind = 0"
STEPS["ded_terms"] = f"""
SELECT *,
  CASE WHEN policy_blanket_ind = 1 AND sublimit_fire_ind = 1 THEN {_VALUE} END AS dedamt1,
  CASE WHEN {_SUBLIMIT} AND (sublimit_hurricane_ind = 1 OR sublimit_wind_hail_ind = 1)
         THEN 'AllLoc-Wind'
       WHEN {_SUBLIMIT} AND sublimit_earthquake_ind = 1 THEN 'AllLoc-EQ'
       WHEN {_SUBLIMIT} AND sublimit_flood_ind = 1 THEN 'AllLoc-Flood' END AS sublimitarea,
  CASE WHEN {_SUBLIMIT} THEN 'B' END AS sublimitdedtype,
  CASE WHEN {_SUBLIMIT} THEN {_VALUE} END AS sublimitdedamt1
FROM grp
WHERE NOT (sublimit_fire_ind = 0 AND sublimit_flood_ind = 1 AND sublimit_earthquake_ind = 0
  AND sublimit_hurricane_ind = 0 AND sublimit_wind_hail_ind = 0)"""
STEPS["ded_spread"] = f"""
SELECT policy_term_id, count(*) OVER (PARTITION BY policy_term_id) AS raw_layer_count,
  last_value(dedamt1 IGNORE NULLS) OVER (PARTITION BY policy_term_id
    ORDER BY policy_blanket_ind, sublimit_fire_ind, dedamt1 NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS dedamt1,
  {", ".join(_SUB)}, sublimitarea, sublimitdedtype, sublimitdedamt1 FROM ded_terms"""
STEPS["ded_policy"] = f"""
SELECT s.policy_term_id, s.dedamt1, {cols("s", _SUB)}, s.sublimitarea, s.sublimitdedtype,
  s.sublimitdedamt1,
  CASE WHEN {" + ".join(f"s.{f}" for f in _SUB)} = n.policy_peril_count THEN 1 ELSE 0 END
    AS isallperildeductible
FROM ded_spread s LEFT JOIN peril_cnt n ON n.policy_term_id = s.policy_term_id
WHERE s.raw_layer_count = 1 OR (s.raw_layer_count > 1 AND s.sublimitarea IS NOT NULL)"""

# --- contract file ---------------------------------------------------------------------

_FILE_FLAGS = tuple(
    f"{p}_ind" for p in ("nbcr", "terrorism", "earthquake", "hurricane", "wind_hail", "fire", "flood")
)


def _layer_amount(column: str) -> str:
    return f"CASE WHEN l.excess_policy_ind = 1 THEN l.excess_{column} END"


_ALL, _SOME = "d.isallperildeductible = 1", "d.isallperildeductible = 0"
STEPS["contract_rows"] = f"""
SELECT l.spm AS "ContractID", l.primary_insured_nm AS "InsuredName",
  {lob("l.business_unit_cd", "l.product_cd")} AS "LOB",
  CASE WHEN l.business_unit_cd = 'AED' THEN 'ALT' ELSE l.business_unit_cd END AS "UDF1",
  concat(l.profit_center_cd, '-', l.profit_center_desc) AS "UDF2",
  concat(l.producer_cd, '-', l.producer_desc) AS "ProducerName",
  l.underwriter_nm AS "Underwriter", l.excess_policy_ind,
  {", ".join(f"l.policy_{f}" for f in _FILE_FLAGS)},
  l.policy_term_effective_dt AS "InceptionDate", l.policy_term_expiration_dt AS "ExpirationDate",
  CASE WHEN l.producer_country_cd = 'CAN' THEN 'CAD' ELSE 'USD' END AS "Currency",
  CASE WHEN l.excess_policy_ind = 0 THEN concat(l.spm, '-01')
    ELSE concat(l.spm, '-', lpad(CAST(l.excess_layer_no AS VARCHAR), 2, '0')) END AS "LayerID",
  {", ".join(f"l.excess_{f}" for f in _LAYER_FLAGS)},
  CASE l.excess_policy_ind WHEN 0 THEN '' WHEN 1 THEN 'E' END AS "LimitType",
  {_layer_amount("part_of_amt")} AS "Limit1", {", ".join(f"'' AS \"Limit{x}\"" for x in "ABCD")},
  {_layer_amount("attachment_point_amt")} AS "AttachmentAmt",
  {_layer_amount("limit_amt")} AS "Limit2",
  CASE WHEN {_ALL} THEN 'MI' END AS "DedType", CASE WHEN {_ALL} THEN d.dedamt1 END AS "DedAmt1",
  '' AS "DedAmt2", p.total_policy_premium AS "Premium",
  {", ".join(f"CASE WHEN {_SOME} THEN d.{f} END AS {f}" for f in _SUB)},
  CASE WHEN {_SOME} THEN d.sublimitarea END AS "SublimitArea",
  {", ".join(f"'' AS \"{n}\"" for n in ("SublimitType", "SubLimitOcc", "SublimitLimitA",
                                        "SublimitLimitB", "SublimitLimitC", "SublimitLimitD"))},
  d.sublimitdedamt1 AS "SublimitAttachAmt",
  {", ".join(f"'' AS \"Sublimit{n}\"" for n in ("Part", "DedType", "DedAmt1", "DedAmt2"))},
  l.policy_nbcr_ind AS "UDF3", concat('{SOURCE_TAG}-', l.policy_entry_system_desc) AS "UDF4",
  {lob("l.business_unit_cd", "l.product_cd")} AS "UDF5", {NOW} AS "AsOfDate",
  l.mod_period AS "ModPeriod", l.policy_term_id, l.product_cd
FROM lay l LEFT JOIN premium p ON p.policy_term_id = l.policy_term_id
LEFT JOIN ded_policy d ON d.policy_term_id = l.policy_term_id"""

# --- location --------------------------------------------------------------------------

_POLICY = ("policy_symbol_cd", "policy_symbol_desc", "policy_number_cd", "policy_module_cd",
           "current_version_no", "primary_insured_nm", "policy_term_effective_dt",
           "policy_term_expiration_dt", "cancellation_effective_dt")
_OCCUPANCY = ("occupancy_cd", "occupancy_desc", "occupancy_scheme_desc")
_YEARS = tuple(f"{p}_update_yr" for p in ("electrical", "heating", "other", "plumbing", "roof"))
_COVER_TEXT = ("building_percent_complete_no", "contents_rate_grade_cd")
_VALUES = ("building_replacement_amt", "contents_replacement_amt", "business_int_replacement_amt",
           "building_cvrg_a_amt", "building_cvrg_b_amt", "contents_cvrg_c_amt",
           "business_int_cvrg_d_amt")
_PREMIUMS = ("written_premium_amt", "annualized_premium_amt")
_RISK_FLAGS = tuple(f"structure_{f}" for f in FLAGS)


def _policy_part(product: str) -> str:
    return f"""
  t.business_unit_cd, t.business_unit_desc, b.profit_center_cd, b.profit_center_desc,
  b.producer_cd, b.producer_desc, c.customer_cd, {spm()} AS spm, {spmv()} AS spmv,
  {cols("t", _POLICY)}, m.company_cd, m.company_nm, m.company_abrv_cd,
  {product}.product_cd, {product}.product_desc, t.sic_cd, t.sic_desc"""


_RISK_PART = f"""
  {", ".join(f"t.{f} AS policy_{f}" for f in FLAGS)}, r.risk_catg_cd, r.risk_catg_desc,
  y2.source_system_cd, y2.source_system_desc, s.location_cd, s.building_cd,
  s.deleted_dt AS risk_deleted_dt, {", ".join(f"v.{f} AS structure_{f}" for f in FLAGS)},
  {cols("a", ADDRESS)}, coalesce(k1.construction_no, k2.construction_no) AS construction_cd_num,
  s.construction_cd, s.construction_desc,
  CASE WHEN s.construction_scheme_desc IS NOT NULL THEN s.construction_scheme_desc
       WHEN k1.construction_no IS NOT NULL OR k2.construction_no IS NOT NULL THEN 'ISO_FIRE' END
    AS construction_scheme_desc,
  {cols("s", _OCCUPANCY)}, s.stories_no,
  CASE WHEN s.built_yr = '1900' THEN '9999' ELSE s.built_yr END AS built_yr,
  {cols("s", _YEARS)}, s.square_footage_no, {cols("v", _COVER_TEXT + _VALUES + _PREMIUMS)}"""
_LOC_FROM = f"""
FROM folded_l f JOIN m_policy_term t ON t.policy_term_id = f.policy_term_id
LEFT JOIN m_policy y ON y.policy_id = t.policy_id
LEFT JOIN m_customer c ON c.customer_id = y.customer_id
JOIN m_producer_profit_center_bu b
  ON b.producer_profit_center_bu_id = t.producer_profit_center_bu_id
JOIN m_company m ON m.company_id = t.company_id
JOIN m_risk r ON r.policy_term_id = t.policy_term_id
JOIN m_location a ON a.location_id = r.location_id
JOIN m_risk_property_structure s ON s.risk_id = r.risk_id
  AND (s.deleted_dt >= f.mod_period OR s.deleted_dt IS NULL)
LEFT JOIN m_construction_lookup k1 ON trim(k1.construction_desc) = trim(s.construction_cd)
  AND k1.source_system_id = s.source_system_id
LEFT JOIN m_construction_lookup k2 ON trim(k2.construction_desc) = trim(s.construction_desc)
  AND k2.source_system_id = s.source_system_id
JOIN m_covered_property_structure v ON v.risk_id = r.risk_id
LEFT JOIN m_source_system y2 ON y2.source_system_id = r.source_system_id"""
STEPS["loc_sel"] = f"""
SELECT t.policy_term_id, r.risk_id, r.location_id, r.risk_place_hash_txt,
  s.risk_property_structure_id, v.covered_property_structure_id, {_policy_part("f")},
  f.mod_period, {_RISK_PART}, {lob("f.business_unit_cd", "f.product_cd")} AS "UDF5" {_LOC_FROM}"""
STEPS["loc_det"] = f"""
SELECT t.policy_term_id, r.risk_id, r.location_id, q.risk_peril_product_id, q.peril_id,
  q.product_id, s.risk_property_structure_id, v.covered_property_structure_id,
  lm.limit_property_structure_id, de.deduct_property_structure_id, {_policy_part("p")},
  q.source_product_cd, {_RISK_PART}, k.peril_cd, k.peril_desc, q.source_peril_cd,
  {cols("lm", layout.DETAIL_LIMITS)}, {cols("de", layout.DETAIL_DEDUCTIBLES)} {_LOC_FROM}
JOIN m_risk_peril_product q ON q.risk_id = r.risk_id
  AND (s.deleted_dt >= f.mod_period OR s.deleted_dt IS NULL)
LEFT JOIN m_product p ON p.product_id = q.product_id
LEFT JOIN m_peril k ON k.peril_id = q.peril_id
LEFT JOIN m_limit_property_structure lm ON lm.risk_peril_product_id = q.risk_peril_product_id
LEFT JOIN m_deductible_property_structure de
  ON de.risk_peril_product_id = q.risk_peril_product_id"""
_MEASURES = {"bldg_limit": "building_limit_amt", "bldg_ded_amt": "building_deductible_amt",
             "bldg_ded_pcnt": "building_deductible_pcnt", "cnts_limit": "contents_limit_amt",
             "cnts_ded_amt": "contents_deductible_amt",
             "cnts_ded_pcnt": "contents_deductible_pcnt", "bi_limit": "bi_limit_amt",
             "bi_ded_amt": "bi_deductible_amt"}
STEPS["pvt"] = f"""
SELECT policy_term_id, risk_id, {", ".join(
    f"max({src}) FILTER (WHERE peril_cd = '{p}') AS \"{p}_{short}\""
    for p in sorted(PERILS) for short, src in _MEASURES.items())}
FROM loc_det GROUP BY policy_term_id, risk_id"""
STEPS["risk_flags"] = f"SELECT policy_term_id, risk_id, {', '.join(_RISK_FLAGS)} FROM loc_sel"
_BLOCK_COLUMNS = ("LocLimitType", "LimitBldg", "LimitOther", "LimitContent", "LimitTime",
                  "Participation1", "Participation2", "DeductType", "DeductBldg", "DeductOther",
                  "DeductContent", "DeductTime")
_BLOCKS = {1: ("FIRE", False), 2: ("HURRICANE", True), 3: ("EARTHQUAKE", True),
           4: ("TERRORISM", False), 5: ("WIND_HAIL", True)}


def _name(column: str, n: int) -> str:
    return f'"{column}"' if n == 1 else f'"{column} {n}"'


def _block(n: int) -> str:
    peril, deducts = _BLOCKS[n]
    flag = f"g.structure_{peril.lower()}_ind"

    def cell(short: str) -> str:
        return f'coalesce(p."{peril}_{short}", 0)'

    def amount(short: str) -> str:
        return (f"CASE WHEN {flag} = 0 THEN '' WHEN {cell(short)} > 0 "
                f"THEN {number(f'p.\"{peril}_{short}\"')} ELSE '' END")

    def deduct(part: str) -> str:
        share = f"CAST(p.\"{peril}_{part}_ded_pcnt\" * 0.01 AS DECIMAL(18,6))"
        return (f"CASE WHEN {flag} = 0 THEN '' "
                f"WHEN {cell(part + '_ded_amt')} > 0 THEN {number(f'p.\"{peril}_{part}_ded_amt\"')} "
                f"WHEN {cell(part + '_ded_pcnt')} > 0 THEN {number(share)} ELSE '' END")

    total = " + ".join(cell(s) for s in ("bldg_limit", "cnts_limit", "bi_limit"))
    if deducts:
        kind = (f"CASE WHEN {flag} = 0 THEN '' WHEN {cell('bldg_ded_pcnt')} > 0 THEN 'C' "
                f"WHEN {cell('bldg_ded_amt')} > 0 THEN 'S' ELSE 'N' END")
        ded = (deduct("bldg"), "''", deduct("cnts"), amount("bi_ded_amt"))
    else:
        kind = f"CASE WHEN {flag} = 1 THEN 'N' ELSE '' END"
        ded = ("''",) * 4
    values = (f"CASE WHEN {flag} = 0 THEN '' WHEN {total} > 0 THEN 'C' ELSE '' END",
              amount("bldg_limit"), "''", amount("cnts_limit"), amount("bi_limit"), "''", "''",
              kind, *ded)
    body = ", ".join(f"{v} AS {_name(c, n)}" for v, c in zip(values, _BLOCK_COLUMNS))
    return (f"SELECT g.policy_term_id, g.risk_id, {body} FROM risk_flags g "
            "LEFT JOIN pvt p ON p.risk_id = g.risk_id")


for _n in _BLOCKS:
    STEPS[f"block{_n}"] = _block(_n)


def _nulls(names, kind: str = "VARCHAR") -> str:
    return ", ".join(f'CAST(NULL AS {kind}) AS "{n}"' for n in names)


def _section(n: int) -> str:
    blank = "''" if n == 1 else "CAST(NULL AS VARCHAR)"
    middle = ", ".join(f"k{n}.{_name(c, n)}" for c in _BLOCK_COLUMNS)
    return f"{blank} AS {_name('LocPerils', n)}, {middle}, {blank} AS {_name('SublimitArea', n)}"


_TAG = SOURCE_TAG.lower()
STEPS["location_rows"] = f"""
SELECT l.policy_term_id, l.risk_id, l.location_cd, l.building_cd, l.product_cd,
  {lob("l.business_unit_cd", "l.product_cd")} AS "LOB", l.profit_center_cd, l.profit_center_desc,
  l.producer_cd, l.producer_desc, {", ".join(f"l.policy_{f}" for f in FLAGS)},
  {cols("l", _RISK_FLAGS)}, {NOW} AS "AsOfDate", l.mod_period, l.spm AS "ContractID",
  concat(l.spm, '_', l.risk_catg_cd, '_', l.risk_id) AS "LocationID",
  concat('Location ', l.location_cd, ', Building ', l.building_cd) AS "LocationName",
  l.street_address_1_txt AS "Street", l.city_nm AS "City", l.state_province_cd AS "Area",
  l.postal_cd AS "PostalCode",
  CASE l.country_cd WHEN 'US' THEN l.county_cd WHEN 'CA' THEN substring(l.postal_cd, 1, 3) END
    AS "SubArea",
  l.country_cd AS "CountryISO", l.construction_scheme_desc AS {_TAG}_construction_scheme_desc,
  l.construction_cd_num AS {_TAG}_construction_cd_num, l.construction_cd AS {_TAG}_construction_cd,
  l.construction_desc AS {_TAG}_construction_desc, {_nulls(("ConstructionOther",))},
  CASE WHEN l.occupancy_cd IS NULL THEN 'SIC' ELSE l.occupancy_scheme_desc END
    AS {_TAG}_occupancy_scheme_desc,
  CASE WHEN l.occupancy_cd IS NOT NULL THEN l.occupancy_cd WHEN l.sic_cd IS NOT NULL THEN l.sic_cd
    ELSE '0' END AS {_TAG}_occupancy_cd,
  CASE WHEN l.occupancy_cd IS NULL THEN l.sic_desc ELSE l.occupancy_desc END
    AS {_TAG}_occupancy_desc,
  l.built_yr AS "YearBuilt",
  CAST(ceil(TRY_CAST(NULLIF(l.stories_no, '') AS DECIMAL(18,4))) AS BIGINT) AS "NumberOfStories",
  1 AS "RiskCount", l.square_footage_no AS "GrossArea",
  {_nulls(("InceptionDate", "ExpirationDate", "ProjectCompletion", "ProjectPhaseCode",
           "IsPrimary", "LocationGroup"))},
  CASE l.country_cd WHEN 'CA' THEN 'CAD' ELSE 'USD' END AS "Currency",
  l.written_premium_amt AS "Premium", l.building_replacement_amt AS "BuildingValue",
  {_nulls(("OtherValue",), "DECIMAL(18,2)")}, l.contents_replacement_amt AS "ContentsValue",
  l.business_int_replacement_amt AS "TimeElementValue", {", ".join(_section(n) for n in _BLOCKS)},
  CASE WHEN l.business_int_replacement_amt IS NOT NULL THEN 365 END AS "DaysCovered",
  {_nulls(fixed.MODIFIER_COLUMNS)},
  concat('{SOURCE_TAG}-', l.source_system_desc) AS "UDF1", l.building_replacement_amt AS "UDF2",
  100 AS "UDF3", {_nulls(("UDF4", "UDF5", "Latitude", "Longitude", "UserGeocodeMatchLevel"))},
  l.risk_place_hash_txt
FROM loc_sel l {" ".join(f"LEFT JOIN block{n} k{n} ON k{n}.risk_id = l.risk_id" for n in _BLOCKS)}"""

# --- extracts --------------------------------------------------------------------------

STEPS["decode"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', {n})" for t, n in CONSTRUCTION_NUMBERS.items()
) + ") AS t(construction_desc, construction_no)"


def extract_from(structures: str = "", perils: str = "", decode: str = "") -> str:
    return f"""
FROM m_policy_term t
JOIN m_producer_profit_center_bu b
  ON b.producer_profit_center_bu_id = t.producer_profit_center_bu_id
JOIN m_company m ON m.company_id = t.company_id
LEFT JOIN m_excess x ON x.policy_term_id = t.policy_term_id
JOIN m_risk r ON r.policy_term_id = t.policy_term_id
JOIN m_location a ON a.location_id = r.location_id
JOIN m_risk_property_structure s ON s.risk_id = r.risk_id {structures}
{decode}
JOIN m_covered_property_structure v ON v.risk_id = r.risk_id
JOIN m_risk_peril_product q ON q.risk_id = r.risk_id {perils}
LEFT JOIN m_product p ON p.product_id = q.product_id
LEFT JOIN m_peril k ON k.peril_id = q.peril_id
LEFT JOIN m_limit_property_structure lm ON lm.risk_peril_product_id = q.risk_peril_product_id
LEFT JOIN m_deductible_property_structure de
  ON de.risk_peril_product_id = q.risk_peril_product_id
LEFT JOIN m_facultative fa ON fa.risk_id = r.risk_id"""


_OPEN = f"""
WHERE t.business_unit_cd LIKE 'A%' AND t.policy_term_effective_dt <= {D}
  AND t.policy_term_expiration_dt > {D}
  AND (t.cancellation_effective_dt > {D} OR t.cancellation_effective_dt IS NULL)
  AND (q.deleted_dt >= {D} OR q.deleted_dt IS NULL)
  AND (s.deleted_dt >= {D} OR s.deleted_dt IS NULL)"""
_EXTRACT_FLAGS = tuple(
    f"{p}_ind" for p in ("earthquake", "hurricane", "wind_hail", "fire", "terrorism", "flood", "nbcr")
)
_EMPTY = ("building_deductible_amt", "contents_deductible_amt", "bi_deductible_amt")
POLICY_TERM_EXTRACT = f"SELECT {cols('t', schema.TABLES['policy_term'])} {extract_from()} {_OPEN}"
FIRE_EXTRACT = f"""
SELECT t.business_unit_cd, t.business_unit_desc, b.profit_center_cd, b.profit_center_desc,
  p.product_cd, p.product_desc, {spmv()} AS accntnum, {spmvl()} AS policynum,
  t.primary_insured_nm AS accntname, t.policy_term_effective_dt, t.policy_term_expiration_dt,
  t.cancellation_effective_dt, t.sic_cd, t.sic_desc, r.risk_catg_cd, r.risk_catg_desc,
  a.street_address_1_txt, a.city_nm, a.state_province_cd, a.state_province_nm, a.postal_cd,
  a.country_cd, a.country_nm, s.risk_id, s.location_cd, s.building_cd, s.construction_cd,
  s.construction_desc, s.occupancy_scheme_desc, s.occupancy_cd, s.occupancy_desc,
  CASE WHEN s.stories_no = '' THEN 'Unknown' ELSE s.stories_no END AS stories_no,
  CASE WHEN s.built_yr = '1900' THEN '' ELSE s.built_yr END AS built_yr, s.square_footage_no,
  {cols("v", _VALUES[:3] + _EXTRACT_FLAGS)},
  lm.blanket_building_limit_amt, lm.blanket_contents_limit_amt, lm.blanket_bi_limit_amt,
  lm.blanket_combined_limit_amt, lm.building_limit_amt, lm.contents_limit_amt, lm.bi_limit_amt,
  de.blanket_deductible_amt, de.blanket_bldg_deductible_amt, de.blanket_cnts_deductible_amt,
  de.blanket_bi_deductible_amt, de.blanket_bi_deductible_pcnt, de.blanket_bi_deductible_dur_no,
  de.blanket_bi_duration_unit_desc, de.blanket_comb_deductible_amt, de.site_deductible_amt,
  de.combined_deductible_amt, de.contents_deductible_pcnt
{extract_from()} {_OPEN} AND b.profit_center_cd <> '2758' AND k.peril_cd IN ('FIRE')"""
HERITAGE_EXTRACT = f"""
SELECT t.policy_term_id, r.location_id, r.risk_id, s.risk_property_structure_id,
  v.covered_property_structure_id, t.business_unit_cd, t.business_unit_desc,
  {spmv()} AS accntnum, {spmvl()} AS policynum, t.primary_insured_nm AS accntname,
  b.profit_center_cd AS branchname, b.profit_center_desc, 'GARS_Condo' AS lobname,
  m.company_cd, m.company_nm, m.company_abrv_cd, {cols("t", _POLICY[:5])},
  r.risk_catg_cd, r.risk_catg_desc, {cols("a", ADDRESS)}, s.location_cd, s.building_cd,
  CAST(z.construction_no AS INTEGER) AS construction_cd_num, s.construction_cd,
  s.construction_desc, s.construction_scheme_desc, {cols("s", _OCCUPANCY)}, s.stories_no,
  CASE WHEN s.built_yr = '1900' THEN '9999' ELSE s.built_yr END AS built_yr, {cols("s", _YEARS)},
  s.square_footage_no, {cols("v", _COVER_TEXT + _VALUES + _EXTRACT_FLAGS + _PREMIUMS)},
  q.risk_peril_product_id, q.peril_id, k.peril_cd, k.peril_desc, q.source_peril_cd, q.product_id,
  p.product_cd, p.product_desc, q.source_product_cd, lm.limit_property_structure_id,
  {cols("lm", layout.DETAIL_LIMITS)}, de.deduct_property_structure_id,
  {", ".join(f"CAST(NULL AS DECIMAL(18,2)) AS {c}" if c in _EMPTY else f"de.{c}"
             for c in layout.DETAIL_DEDUCTIBLES)}
{extract_from(f"AND s.deleted_dt >= {D}", f"AND q.deleted_dt >= {D}",
              "LEFT JOIN decode z ON trim(z.construction_desc) = trim(s.construction_cd)")}
WHERE t.business_unit_cd = 'GARS' AND t.policy_term_effective_dt <= {D}
  AND t.policy_term_expiration_dt >= {D}
  AND (t.cancellation_effective_dt >= {D} OR t.cancellation_effective_dt IS NULL)"""

# --- control totals ----------------------------------------------------------------------

_KEYS = ("ContractID", "LocationID", "LayerID", "ExposureID", "SublimitPerils", "OccupancyCode",
         "ConstructionCode", "CountryISO", "Area")
_FILES = {
    "con": (td.contract_snapshot, ("ContractID", "LayerID", "SublimitPerils")),
    "loc": (td.location_snapshot,
            ("ContractID", "LocationID", "BuildingValue", "OtherValue", "ContentsValue",
             "TimeElementValue", "DeductBldg", "OccupancyCode", "ConstructionCode", "CountryISO",
             "Area")),
    "rei": (td.reinsurance_snapshot, ("ContractID", "ExposureID")),
}
for _kind, (_make, _columns) in _FILES.items():
    for _snap, _day in td.SNAPSHOTS.items():
        _sql = _make(_day).format(**{t: t for t in td.BASE_TABLES})
        _list = ", ".join(f"rtrim({c}) AS {c}" if c in _KEYS else c for c in _columns)
        STEPS[f"{_kind}_{_snap}"] = f"SELECT {_list} FROM ({_sql})"


def per_snapshot(part: str) -> str:
    """UNION ALL of a query over the three snapshots; ``{s}`` is the snapshot's name."""
    return " UNION ALL ".join(part.replace("{s}", s) for s in td.SNAPSHOTS)


def value(x: str) -> str:
    return (f"CASE WHEN trim({x}) = '' THEN CAST(0 AS DECIMAL(28,4)) "
            f"ELSE TRY_CAST({x} AS DECIMAL(28,4)) END")


def counts(kind: str, label: str) -> str:
    return per_snapshot(f"SELECT '{{s}}' AS {label}, count(*) AS rec_Count FROM {kind}_{{s}}")


def sums(column: str, label: str, total: str) -> str:
    return per_snapshot(
        f"SELECT '{{s}}' AS {label}, CAST(sum({value(column)}) AS DOUBLE) AS {total} FROM loc_{{s}}"
    )


_POL = ("CASE WHEN length(ContractID) = 12 THEN substring(ContractID, 4, 7) "
        "ELSE left(ContractID, 7) END")
for _snap in ("current", "prior"):
    STEPS[f"pol_{_snap}"] = (
        f"SELECT {_POL} AS pol, ContractID, count(DISTINCT LocationID) AS n "
        f"FROM loc_{_snap} GROUP BY ALL"
    )
LOC_DRIFT = """
SELECT b.ContractID AS "Priorcontractid", b.n AS "Prior_loccount",
  a.ContractID AS "Currentcontractid", a.n AS "Current_loccount", b.n - a.n AS "Diff"
FROM pol_current a JOIN pol_prior b ON a.pol = b.pol"""


def orphans(left: str, right: str, counted: str) -> str:
    return (f'SELECT a.ContractID AS "ContractID", count(b.{counted}) AS "{counted}_count" '
            f"FROM {left} a LEFT JOIN {right} b ON b.ContractID = a.ContractID "
            f"GROUP BY a.ContractID HAVING count(b.{counted}) = 0")


def formats(table: str, column: str, layered: bool) -> str:
    extra = (f"WHEN strpos({column}, '-') = 13 AND length({column}) = 15 "
             "THEN 'SymPolMod-LayerNumber'" if layered else "")
    return f"""
SELECT CASE WHEN strpos({column}, '-') = 8 AND length({column}) = 10 THEN '7Digit-mod' {extra}
  WHEN length({column}) = 12 THEN 'Sym+Pol+Mod' ELSE 'Check these' END AS "{column}_Format",
  count(*) AS row_count, max({column}) AS "Sample" FROM {table} GROUP BY 1"""


SUBLIMIT_PERILS = per_snapshot("""
SELECT '{s}' AS db, SublimitPerils AS "SublimitPerils", count(SublimitPerils) AS "Counts"
FROM con_{s} WHERE SublimitPerils IS NOT NULL AND SublimitPerils <> '' GROUP BY SublimitPerils""")

STEPS["occ_table"] = """
SELECT a.OccupancyCode, o.description AS AIROccupancy, CAST(sum(c.n) AS BIGINT) AS CurrentCount,
  CAST(sum(p.n) AS BIGINT) AS PriorCount,
  CAST(coalesce(sum(c.n), 0) - coalesce(sum(p.n), 0) AS BIGINT) AS diff
FROM (SELECT OccupancyCode FROM loc_current UNION SELECT OccupancyCode FROM loc_prior) a
LEFT JOIN (SELECT OccupancyCode, count(OccupancyCode) AS n FROM loc_current GROUP BY ALL) c
  ON c.OccupancyCode = a.OccupancyCode
LEFT JOIN (SELECT OccupancyCode, count(OccupancyCode) AS n FROM loc_prior GROUP BY ALL) p
  ON p.OccupancyCode = a.OccupancyCode
LEFT JOIN m_occupancy_codes o ON o.code = a.OccupancyCode AND o.region = 'US'
GROUP BY a.OccupancyCode, o.description"""
OCCUPANCY = """
SELECT * FROM occ_table UNION
SELECT 'TOTAL', '', CAST(sum(CurrentCount) AS BIGINT), CAST(sum(PriorCount) AS BIGINT),
  CAST(sum(diff) AS BIGINT) FROM occ_table"""


def construction(country_aware: bool) -> str:
    keys = ("ConstructionCode", "CountryISO") if country_aware else ("ConstructionCode",)

    def side(snap: str, alias: str) -> str:
        on = " AND ".join(f"{alias}.{k} = a.{k}" for k in keys)
        return (f"LEFT JOIN (SELECT {', '.join(keys)}, count(*) AS n FROM loc_{snap} GROUP BY ALL) "
                f"{alias} ON {on}")

    table = f"""
SELECT a.ConstructionCode, k.category AS AIRConstructionCategory,
  k.description AS AIRConstruction, CAST(sum(c.n) AS BIGINT) AS CurrentCounts,
  CAST(sum(p.n) AS BIGINT) AS PriorCounts,
  CAST(coalesce(sum(c.n), 0) - coalesce(sum(p.n), 0) AS BIGINT) AS diff
FROM (SELECT ConstructionCode, CountryISO FROM loc_current
      UNION SELECT ConstructionCode, CountryISO FROM loc_prior) a
{side("current", "c")} {side("prior", "p")}
LEFT JOIN m_construction_codes k ON k.code = a.ConstructionCode AND k.region = a.CountryISO
GROUP BY a.ConstructionCode, k.category, k.description"""
    return f"""
SELECT * FROM ({table}) UNION
SELECT 'TOTAL', '', '', CAST(sum(CurrentCounts) AS BIGINT), CAST(sum(PriorCounts) AS BIGINT),
  CAST(sum(diff) AS BIGINT) FROM ({table})"""


_TIV = " + ".join(value(c) for c in ("BuildingValue", "OtherValue", "ContentsValue",
                                     "TimeElementValue"))
for _snap in ("current", "prior"):
    STEPS[f"state_{_snap}"] = f"""
SELECT Area AS state, CAST(sum({_TIV}) AS DECIMAL(38,4)) AS tiv, count(LocationID) AS locs
FROM loc_{_snap} GROUP BY Area"""


def _signed(x: str, body: str) -> str:
    return f"CASE WHEN {x} < 0 THEN concat('-', {body}) WHEN {x} >= 0 THEN {body} END"


def _whole(x: str, sign: str = "") -> str:
    r = f"CAST(round(CAST({x} AS DECIMAL(38,4))) AS BIGINT)"
    return _signed(r, f"concat('{sign}', format('{{:,}}', abs({r})))")


def _share(change: str, base: str) -> str:
    r = (f"CAST(CAST({change} AS DOUBLE) / NULLIF(CAST({base} AS DOUBLE), 0) * 100 "
         "AS DECIMAL(28,2))")
    return _signed(r, f"concat(format('{{:,.2f}}', CAST(abs({r}) AS DOUBLE)), ' %')")


STATE_COLUMNS = f"""
  {_whole("ct", "$")} AS "Current_TIV", {_whole("pt", "$")} AS "Prior_TIV",
  {_whole("ct - pt", "$")} AS "TIV_Change", {_share("(ct - pt)", "pt")} AS "TIV % Change",
  {_whole("cl")} AS "Current_Locs", {_whole("pl")} AS "Prior_Locs",
  {_whole("cl - pl")} AS "Loc_Change", {_share("(cl - pl)", "pl")} AS "Loc % Change" """
STATE = f"""
SELECT state AS "State", {STATE_COLUMNS} FROM (
  SELECT p.state, c.tiv AS ct, p.tiv AS pt, c.locs AS cl, p.locs AS pl
  FROM state_current c LEFT JOIN state_prior p ON p.state = c.state)"""
STATE_ROLLUP = f"""
SELECT coalesce(state, {{label}}) AS "State", {STATE_COLUMNS} FROM (
  SELECT p.state, grouping(p.state) AS g, CAST(sum(c.tiv) AS DECIMAL(38,4)) AS ct,
    CAST(sum(p.tiv) AS DECIMAL(38,4)) AS pt, CAST(sum(c.locs) AS BIGINT) AS cl,
    CAST(sum(p.locs) AS BIGINT) AS pl
  FROM state_current c LEFT JOIN state_prior p ON p.state = c.state GROUP BY ROLLUP (p.state))"""
ORPHAN_EXPOSURES = """
SELECT r.ContractID AS "ContractID", c.ContractID AS "Contract_ContractID",
  r.ExposureID AS "ExposureID", c.LayerID AS "LayerID"
FROM rei_current r LEFT JOIN con_current c ON c.LayerID = r.ExposureID WHERE c.ContractID IS NULL"""

# --- reconciliations ---------------------------------------------------------------------

STEPS["ded_rows"] = "SELECT policy_term_id, count(*) AS actual_count FROM dd GROUP BY ALL"
STEPS["comparison"] = """
SELECT r.policy_term_id, l.layer_count, n.policy_peril_count, n.excess_layer_peril_count,
  c.risk_count, n.policy_peril_count * c.risk_count AS theoretical_count, r.actual_count,
  CASE WHEN n.policy_peril_count * c.risk_count = r.actual_count THEN 1 ELSE 0 END
    AS match_indicator
FROM ded_rows r LEFT JOIN layer_cnt l ON l.policy_term_id = r.policy_term_id
LEFT JOIN peril_cnt n ON n.policy_term_id = r.policy_term_id
LEFT JOIN risk_cnt c ON c.policy_term_id = r.policy_term_id"""
INITIAL_FINAL = """
SELECT 'Policy' AS granularity, 'Initial' AS source_name, count(*) AS record_count FROM pif_l
UNION SELECT 'Policy', 'Final', count(DISTINCT "ContractID") FROM location_rows
UNION SELECT 'Location', 'Initial', count(DISTINCT risk_id) FROM loc_det
UNION SELECT 'Location', 'Final', count(*) FROM location_rows"""
INITIAL_FINAL_BY_POLICY = """
SELECT 'Policy-Location' AS granularity, 'Initial' AS source_name, spm AS "ContractID",
  count(DISTINCT risk_id) AS record_count FROM loc_det GROUP BY spm
UNION SELECT 'Policy-Location', 'Final', "ContractID", count(*) FROM location_rows
GROUP BY "ContractID" """
