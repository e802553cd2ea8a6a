"""Query name -> DuckDB SQL, one per registered query."""

from __future__ import annotations

from oracle import library as lib
from oracle.library import D, with_steps
from perilframe import schema
from perilframe.registry import KEPT_TERMS, NAMED_TERMS, NUMERIC_COLUMNS

_IN_FORCE = {
    "contract": f"policy_term_expiration_dt > {D} AND (cancellation_effective_dt > {D} "
                "OR cancellation_effective_dt IS NULL)",
    "location": f"policy_term_expiration_dt > {D}",
    "heritage": f"policy_term_expiration_dt >= {D} AND (cancellation_effective_dt >= {D} "
                "OR cancellation_effective_dt IS NULL)",
}
_ALIVE = {
    "dated only": f"deleted_dt >= {D}",
    "on date or open": f"(deleted_dt >= {D} OR deleted_dt IS NULL)",
    "after date or open": f"(deleted_dt > {D} OR deleted_dt IS NULL)",
}
_SELECTIONS = {
    "one unit": "FROM m_policy_term t WHERE t.business_unit_cd = 'GARS'",
    "units like A": "FROM m_policy_term t WHERE t.business_unit_cd LIKE 'A%'",
    "other centres": "FROM m_policy_term t JOIN m_producer_profit_center_bu b "
                     "ON b.producer_profit_center_bu_id = t.producer_profit_center_bu_id "
                     "WHERE b.profit_center_cd <> '2758'",
    "fire": "FROM m_risk_peril_product q JOIN m_peril k ON k.peril_id = q.peril_id "
            "WHERE k.peril_cd = 'FIRE'",
}


def _view(table: str) -> str:
    hidden = (schema.TABLES[table][0], "create_ts", "update_ts")
    shown = (c for c in schema.TABLES[table] if c not in hidden)
    return "SELECT " + ", ".join(
        f"{c} AS {c.replace('street_address_', 'street_addr_')}" for c in shown
    ) + f" FROM m_{table}"


def _check(name: str, table: str, key: str, snapshot: str, amounts: bool = False) -> str:
    sums = ", ".join(
        f"{f'CAST(sum({lib.value(c)}) AS DOUBLE)' if amounts else 'CAST(NULL AS DOUBLE)'} AS {n}"
        for n, c in (("building_value", '"BuildingValue"'), ("deductible", '"DeductBldg"')))
    return (f"SELECT '{name}' AS \"check\", '{snapshot}' AS snapshot, {key} AS key, "
            f"CAST(count(*) AS BIGINT) AS row_count, {sums} FROM {table}_{snapshot}")


def _report(reinsured: bool) -> str:
    parts = []
    for s in lib.td.SNAPSHOTS:
        layer, exposure = (f"CASE WHEN strpos({c}, '-') = 8 AND length({c}) = 10 THEN '7Digit-mod' {extra}"
                           f"WHEN length({c}) = 12 THEN 'Sym+Pol+Mod' ELSE 'Check these' END"
                           for c, extra in (("LayerID", "WHEN strpos(LayerID, '-') = 13 AND length(LayerID) = 15 "
                                                        "THEN 'SymPolMod-LayerNumber' "), ("ExposureID", "")))
        parts += [
            _check("contract rows", "con", "CAST(NULL AS VARCHAR)", s),
            _check("contract LayerFormat", "con", layer, s) + " GROUP BY ALL",
            _check("contract SublimitPerils", "con", "nullif(SublimitPerils, '')", s) + " GROUP BY ALL",
            _check("location rows", "loc", "CAST(NULL AS VARCHAR)", s, True),
            *(_check(f"location {c}", "loc", c, s, True) + " GROUP BY ALL"
              for c in ("OccupancyCode", "ConstructionCode", "Area")),
        ]
        for name, a, b, more in (("contracts without locations", "con", "loc", "AND b.LocationID IS NOT NULL"),
                                 ("locations without contract", "loc", "con", "")):
            parts.append(
                f"SELECT '{name}', '{s}', NULL, count(DISTINCT ContractID), NULL, NULL FROM {a}_{s} a "
                f"WHERE ContractID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {b}_{s} b "
                f"WHERE b.ContractID = a.ContractID {more}) HAVING count(*) > 0")
        if reinsured:
            parts += [
                _check("reinsurance rows", "rei", "CAST(NULL AS VARCHAR)", s),
                _check("reinsurance ExposureFormat", "rei", exposure, s) + " GROUP BY ALL",
            ]
    return " UNION ALL ".join(parts)


_QUERIES: dict[str, str] = {
    "in_force_variants": " UNION ALL ".join(
        f"SELECT '{n}' AS variant, count(*) AS kept FROM m_policy_term "
        f"WHERE policy_term_effective_dt <= {D} AND {p}" for n, p in _IN_FORCE.items()),
    "alive_variants": " UNION ALL ".join(
        f"SELECT '{t}' AS source, '{n}' AS variant, count(*) AS kept FROM m_{t} WHERE {p}"
        for t in ("risk_peril_product", "risk_property_structure") for n, p in _ALIVE.items()),
    "selection_filters": " UNION ALL ".join(
        f"SELECT '{n}' AS variant, count(*) AS kept {rest}" for n, rest in _SELECTIONS.items()),
    "pif_contract": "SELECT * FROM pif_c",
    "pif_location": "SELECT * FROM pif_l",
    "pif_numbered": "SELECT * FROM numbered",
    "pif_sample_top5": "SELECT * FROM numbered WHERE bu_product_row_number <= 5",
    "pif_sample_kept": "SELECT * FROM numbered WHERE bu_product_row_number <= 5 "
                       f"OR policy_term_id IN {KEPT_TERMS}",
    "product_listagg": "SELECT * FROM folded_c",
    "policy_id_link": "SELECT * FROM links",
    "policy_premium": "SELECT * FROM premium",
    "excess_layer_pivot": "SELECT * FROM exc",
    "policy_layer_enriched": "SELECT * FROM lay",
    "layer_count": "SELECT * FROM layer_cnt",
    "peril_count": "SELECT * FROM peril_cnt",
    "risk_count": "SELECT * FROM risk_cnt",
    "deductible_detail": "SELECT * FROM dd",
    "limit_detail": "SELECT * FROM ldt",
    "peril_risk_count": "SELECT * FROM risk_peril_cnt",
    "limit_groups": "SELECT * FROM limit_grp",
    "blanket_limits": "SELECT * FROM limit_blk",
    "blanket_by_peril": "SELECT * FROM bpd",
    "blanket_groups": "SELECT * FROM grp",
    "deductible_terms": "SELECT * FROM ded_terms",
    "spread_dedamt": "SELECT * FROM ded_spread",
    "policy_deductible": "SELECT * FROM ded_policy",
    "contract_file": "SELECT * FROM contract_rows",
    "contract_file_lob":
        "SELECT * FROM contract_rows WHERE \"UDF5\" IN ('PIMx', 'PIMt', 'GARS_Condo')",
    "location_selection": "SELECT * FROM loc_sel",
    "location_lob": "SELECT * EXCLUDE (\"UDF5\") FROM loc_sel WHERE \"UDF5\" IN ('ALT', 'GARS')",
    "location_detail": "SELECT * FROM loc_det",
    "location_perils": "SELECT * FROM risk_flags",
    "peril_pivot": "SELECT * FROM pvt",
    "peril_block_fire": "SELECT * FROM block1",
    "peril_block_hurricane": "SELECT * FROM block2",
    "peril_block_earthquake": "SELECT * FROM block3",
    "peril_block_terrorism": "SELECT * FROM block4",
    "peril_block_wind": "SELECT * FROM block5",
    "location_file": "SELECT * FROM location_rows",
    "location_file_lob": "SELECT * FROM location_rows WHERE \"LOB\" = 'GARS_Condo'",
    "location_file_one_structure": "SELECT * FROM location_rows WHERE risk_id IN "
        "(SELECT risk_id FROM loc_sel GROUP BY risk_id HAVING count(*) = 1)",
    "location_detail_alive": "SELECT d.* FROM loc_det d JOIN m_risk_peril_product q "
        f"ON q.risk_peril_product_id = d.risk_peril_product_id WHERE {_ALIVE['on date or open']}",
    "policy_premium_direct": "SELECT l.policy_term_id, l.policy_id, "
        "CAST(sum(x.amount) AS DECIMAL(38,2)) AS total_policy_premium FROM links l LEFT JOIN ("
        "SELECT p.policy_id, p.change_written_premium AS amount FROM m_f_divisional_premiums p "
        "JOIN m_d_transaction_items i ON i.transaction_items_id = p.written_transaction_id "
        "AND i.rein_transaction_type_desc IN ('Direct', 'Direct Funded') "
        "WHERE p.transaction_accounting_year >= 1995) x ON x.policy_id = l.policy_id GROUP BY ALL",
    "contract_file_rewritten":
        "SELECT * FROM contract_rows WHERE \"LOB\" <> 'GARS' OR excess_policy_ind = 1",
    "pif_text_date": lib.STEPS["pif_l"].replace(D, "DATE '1997-12-31'"),
    "terms_by_parameter": "SELECT business_unit_cd AS value, count(*) AS terms FROM m_policy_term "
        f"WHERE policy_term_effective_dt <= {D} AND policy_term_expiration_dt > {D} GROUP BY ALL",
    "heritage_extract": lib.HERITAGE_EXTRACT,
    "fire_extract": lib.FIRE_EXTRACT,
    "policy_term_extract": lib.POLICY_TERM_EXTRACT,
    **{f"view_{t}": _view(t) for t in schema.VIEWED},
    "ct_contract_counts": lib.counts("con", "Contract_rec_Count"),
    "ct_location_counts": lib.counts("loc", "Location_rec_Count"),
    "ct_building_sum": lib.sums("BuildingValue", "Location_sum_Building", "SumBuildingValue"),
    "ct_deduct_sum": lib.sums("DeductBldg", "Location_sum_DeductBldg", "SumDeductBldg"),
    "ct_loc_drift": lib.LOC_DRIFT,
    "ct_contract_orphans": lib.orphans("con_current", "loc_current", "LocationID"),
    "ct_location_orphans": lib.orphans("loc_current", "con_current", "ContractID"),
    "ct_sublimit_perils": lib.SUBLIMIT_PERILS,
    "ct_layerid_format": lib.formats("con_current", "LayerID", True),
    "ct_occupancy": lib.OCCUPANCY,
    "ct_construction": lib.construction(False),
    "ct_construction_by_country": lib.construction(True),
    "ct_state": lib.STATE,
    "ct_state_rollup": lib.STATE_ROLLUP.replace("{label}", "'TOTAL'"),
    "ct_state_rollup_new": lib.STATE_ROLLUP.replace(
        "{label}", "CASE WHEN g = 1 THEN 'TOTAL' ELSE '(new)' END"),
    "ct_exposure_orphans": lib.ORPHAN_EXPOSURES,
    "ct_exposureid_format": lib.formats("rei_current", "ExposureID", False),
    "ct_contract_orphans_collated":
        'SELECT a.ContractID AS "ContractID", CAST(0 AS BIGINT) AS "LocationID_count" FROM con_current a '
        "LEFT JOIN (SELECT rtrim(lower(ContractID) || '  ') AS k, LocationID FROM loc_prior) b "
        "ON b.k = lower(rtrim(a.ContractID)) GROUP BY a.ContractID HAVING count(b.LocationID) = 0",
    "ct_rejected_values": " UNION ALL ".join(
        lib.per_snapshot(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count_if({c} IS NULL)::BIGINT AS missing, "
            f"count_if(trim({c}) = '')::BIGINT AS blank, "
            f"count_if({c} IS NOT NULL AND trim({c}) <> '' AND TRY_CAST({c} AS DECIMAL(28,4)) IS NULL)::BIGINT "
            f"AS rejected, CAST(sum({lib.value(c)}) AS DOUBLE) AS total, '{{s}}' AS snapshot FROM loc_{{s}}")
        for c in NUMERIC_COLUMNS),
    "ct_rows_by_parameter": lib.per_snapshot(
        "SELECT '{s}' AS snapshot, count(*) AS row_count, "
        "count_if(CountryISO IN ('CA', 'MX'))::BIGINT AS matching FROM loc_{s}"),
    "ct_report": _report(False),
    "ct_report_reinsured": _report(True),
    "dq_named_policies": "SELECT g.*, l.spm FROM grp g LEFT JOIN lay l "
                         f"ON l.policy_term_id = g.policy_term_id WHERE g.policy_term_id IN {NAMED_TERMS}",
    "dq_deductible_rows": "SELECT * FROM ded_rows",
    "dq_count_comparison": "SELECT * FROM comparison",
    "dq_count_mismatches": "SELECT * FROM comparison WHERE match_indicator = 0",
    "dq_small_blankets": "SELECT l.* FROM lay l JOIN grp g ON g.policy_term_id = l.policy_term_id "
                         "WHERE g.blanket_peril_count <= 2",
    "dq_pif_summary": "SELECT f.mod_period, t.business_unit_desc, f.product_desc, "
                      "count(*) AS pif_count FROM pif_c f JOIN m_policy_term t "
                      "ON t.policy_term_id = f.policy_term_id GROUP BY ALL",
    "dq_initial_final": lib.INITIAL_FINAL,
    "dq_initial_final_policy": lib.INITIAL_FINAL_BY_POLICY,
    "dq_hash_subset": "SELECT a.* FROM location_rows a JOIN (SELECT r.risk_place_hash_txt "
                      "FROM m_risk r WHERE r.policy_term_id IN "
                      "(SELECT x.policy_term_id FROM m_excess x)) b "
                      "ON b.risk_place_hash_txt = a.risk_place_hash_txt",
    "dq_preview": lib.POLICY_TERM_EXTRACT
                  + " ORDER BY t.policy_number_cd, t.policy_module_cd LIMIT 100",
}

ORACLE_SQL = {name: with_steps(query) for name, query in _QUERIES.items()}
