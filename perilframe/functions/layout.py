"""Column names of the mart and of the files.

These names, and their order, are part of the layouts this engine reproduces; they must stay
exactly as they are for results to match.
"""

# Peril columns of terms and coverages, in the order of the perils.
PERIL_FLAGS = (
    "fire_ind", "hurricane_ind", "earthquake_ind", "flood_ind", "wind_hail_ind",
    "terrorism_ind", "nbcr_ind",
)
# The same in the order of the contract file, and of the extracts.
FILE_FLAGS = (
    "nbcr_ind", "terrorism_ind", "earthquake_ind", "hurricane_ind", "wind_hail_ind", "fire_ind",
    "flood_ind",
)
EXTRACT_FLAGS = (
    "earthquake_ind", "hurricane_ind", "wind_hail_ind", "fire_ind", "terrorism_ind",
    "flood_ind", "nbcr_ind",
)
# Address columns.
STREETS = (
    "street_address_1_txt", "street_address_2_txt", "street_address_3_txt",
    "street_address_4_txt",
)
# Limits: of the mart, of the location detail and of the fire extract.
BLANKET_LIMITS = (
    "blanket_agg_limit_amt", "blanket_agg_limit_cd", "blanket_limit_amt", "blanket_limit_cd",
    "blanket_building_limit_amt", "blanket_building_limit_cd", "blanket_contents_limit_amt",
    "blanket_contents_limit_cd", "blanket_bi_limit_amt", "blanket_bi_limit_cd",
    "blanket_combined_limit_amt", "blanket_combined_limit_cd",
)
SITE_LIMITS = (
    "site_limit_amt", "combined_limit_amt", "building_limit_amt", "contents_limit_amt",
    "bi_limit_amt",
)
DETAIL_LIMITS = (
    "blanket_agg_limit_cd", "blanket_agg_limit_amt", "blanket_limit_cd", "blanket_limit_amt",
    "blanket_building_limit_cd", "blanket_building_limit_amt", "blanket_contents_limit_cd",
    "blanket_contents_limit_amt", "blanket_bi_limit_cd", "blanket_bi_limit_amt",
    "blanket_combined_limit_amt", "blanket_combined_limit_cd", "site_limit_amt",
    "combined_limit_amt", "building_limit_amt", "contents_limit_amt", "bi_limit_amt",
)
FIRE_LIMITS = (
    "blanket_building_limit_amt", "blanket_contents_limit_amt", "blanket_bi_limit_amt",
    "blanket_combined_limit_amt", "building_limit_amt", "contents_limit_amt", "bi_limit_amt",
)
# Deductibles: of the mart, of the location detail and of the fire extract.
BLANKET_DEDUCTIBLES = (
    "blanket_agg_deductible_amt", "blanket_agg_deductible_cd", "blanket_deductible_amt",
    "blanket_deductible_pcnt", "blanket_deductible_cd", "blanket_bldg_deductible_amt",
    "blanket_bldg_deductible_cd", "blanket_cnts_deductible_amt", "blanket_cnts_deductible_cd",
    "blanket_bi_deductible_amt", "blanket_bi_deductible_pcnt", "blanket_bi_deductible_dur_no",
    "blanket_bi_duration_unit_desc", "blanket_bi_deductible_cd", "blanket_comb_deductible_amt",
    "blanket_comb_deductible_cd",
)
SITE_DEDUCTIBLES = (
    "site_deductible_amt", "combined_deductible_amt", "building_deductible_amt",
    "building_deductible_pcnt", "contents_deductible_amt", "contents_deductible_pcnt",
    "bi_deductible_amt", "bi_deductible_pcnt", "bi_deductible_duration_no",
    "bi_duration_unit_desc",
)
DETAIL_DEDUCTIBLES = (
    "blanket_agg_deductible_cd", "blanket_agg_deductible_amt", "blanket_deductible_cd",
    "blanket_deductible_amt", "blanket_bldg_deductible_cd", "blanket_bldg_deductible_amt",
    "blanket_cnts_deductible_cd", "blanket_cnts_deductible_amt", "blanket_bi_deductible_cd",
    "blanket_bi_deductible_amt", "blanket_bi_deductible_pcnt", "blanket_bi_deductible_dur_no",
    "blanket_bi_duration_unit_desc", "blanket_comb_deductible_amt",
    "blanket_comb_deductible_cd", "site_deductible_amt", "combined_deductible_amt",
    "building_deductible_amt", "building_deductible_pcnt", "contents_deductible_amt",
    "contents_deductible_pcnt", "bi_deductible_amt", "bi_deductible_duration_no",
    "bi_duration_unit_desc",
)
FIRE_DEDUCTIBLES = (
    "blanket_deductible_amt", "blanket_bldg_deductible_amt", "blanket_cnts_deductible_amt",
    "blanket_bi_deductible_amt", "blanket_bi_deductible_pcnt", "blanket_bi_deductible_dur_no",
    "blanket_bi_duration_unit_desc", "blanket_comb_deductible_amt", "site_deductible_amt",
    "combined_deductible_amt", "contents_deductible_pcnt",
)
# Years in which parts of a building were renewed.
UPDATE_YEARS = (
    "electrical_update_yr", "heating_update_yr", "other_update_yr", "plumbing_update_yr",
    "roof_update_yr",
)
