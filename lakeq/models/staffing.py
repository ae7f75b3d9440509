"""The staffing-hours configuration: the two column contracts, the rules and
the curation mapping, as data.

Fixed values: the standardised column names and types of the staffing file
(33 columns) and the provider file (103 columns), in file order, plus the key,
range-rule and dimension mappings. They must equal the source pipeline's
contract for refined tables to match it.
"""

from __future__ import annotations

from lakeq.contracts import TableContract, ValidationRules

D10 = "decimal(10,2)"
D97 = "decimal(9,7)"

# The 24 hour columns of the staffing file, in file order.
HOUR_COLUMNS = (
    "hrs_rndon", "hrs_rndon_emp", "hrs_rndon_ctr",
    "hrs_rnadmin", "hrs_rnadmin_emp", "hrs_rnadmin_ctr",
    "hrs_rn", "hrs_rn_emp", "hrs_rn_ctr",
    "hrs_lpnadmin", "hrs_lpnadmin_emp", "hrs_lpnadmin_ctr",
    "hrs_lpn", "hrs_lpn_emp", "hrs_lpn_ctr",
    "hrs_cna", "hrs_cna_emp", "hrs_cna_ctr",
    "hrs_natrn", "hrs_natrn_emp", "hrs_natrn_ctr",
    "hrs_medaide", "hrs_medaide_emp", "hrs_medaide_ctr",
)
# Totals per staff type, and the employee / contractor parts (never added to the totals).
TOTAL_HOUR_COLUMNS = tuple(c for c in HOUR_COLUMNS if not c.endswith(("_emp", "_ctr")))
EMP_HOUR_COLUMNS = tuple(c for c in HOUR_COLUMNS if c.endswith("_emp"))
CTR_HOUR_COLUMNS = tuple(c for c in HOUR_COLUMNS if c.endswith("_ctr"))

STAFFING = TableContract(
    name="staffing_hours",
    columns={
        "provnum": "string", "provname": "string", "city": "string", "state": "string",
        "county_name": "string", "county_fips": "string", "cy_qtr": "string", "workdate": "string",
        "mdscensus": "int",
        **{c: D10 for c in HOUR_COLUMNS},
    },
    keys=("provnum", "workdate"),
)

_S = "string"
PROVIDER = TableContract(
    name="provider_reference",
    columns={
        "cms_certification_number_ccn": _S, "provider_name": _S, "provider_address": _S, "city_town": _S,
        "state": _S, "zip_code": _S, "telephone_number": _S, "provider_ssa_county_code": _S,
        "county_parish": _S, "ownership_type": _S,
        "number_of_certified_beds": "int",
        "average_number_of_residents_per_day": "decimal(6,2)",
        "average_number_of_residents_per_day_footnote": _S, "provider_type": _S,
        "provider_resides_in_hospital": _S, "legal_business_name": _S,
        "date_first_approved_to_provide_medicare_and_medicaid_services": _S, "affiliated_entity_name": _S,
        "affiliated_entity_id": _S, "continuing_care_retirement_community": _S, "special_focus_status": _S,
        "abuse_icon": _S, "most_recent_health_inspection_more_than_2_years_ago": _S,
        "provider_changed_ownership_in_last_12_months": _S, "with_a_resident_and_family_council": _S,
        "automatic_sprinkler_systems_in_all_required_areas": _S, "overall_rating": _S,
        "overall_rating_footnote": _S, "health_inspection_rating": _S, "health_inspection_rating_footnote": _S,
        "qm_rating": _S, "qm_rating_footnote": _S, "long_stay_qm_rating": _S, "long_stay_qm_rating_footnote": _S,
        "short_stay_qm_rating": _S, "short_stay_qm_rating_footnote": _S, "staffing_rating": _S,
        "staffing_rating_footnote": _S, "reported_staffing_footnote": _S,
        "physical_therapist_staffing_footnote": _S,
        "reported_nurse_aide_staffing_hours_per_resident_per_day": D97,
        "reported_lpn_staffing_hours_per_resident_per_day": D97,
        "reported_rn_staffing_hours_per_resident_per_day": D97,
        "reported_licensed_staffing_hours_per_resident_per_day": D97,
        "reported_total_nurse_staffing_hours_per_resident_per_day": D97,
        "total_number_of_nurse_staff_hours_per_resident_per_day_on_the_weekend": D97,
        "registered_nurse_hours_per_resident_per_day_on_the_weekend": D97,
        "reported_physical_therapist_staffing_hours_per_resident_per_day": D97,
        "total_nursing_staff_turnover": "decimal(5,2)",
        "total_nursing_staff_turnover_footnote": _S,
        "registered_nurse_turnover": "decimal(5,2)",
        "registered_nurse_turnover_footnote": _S,
        "number_of_administrators_who_have_left_the_nursing_home": "int",
        "administrator_turnover_footnote": _S,
        "nursing_case_mix_index": D97, "nursing_case_mix_index_ratio": D97,
        "case_mix_nurse_aide_staffing_hours_per_resident_per_day": D97,
        "case_mix_lpn_staffing_hours_per_resident_per_day": D97,
        "case_mix_rn_staffing_hours_per_resident_per_day": D97,
        "case_mix_total_nurse_staffing_hours_per_resident_per_day": D97,
        "case_mix_weekend_total_nurse_staffing_hours_per_resident_per_day": D97,
        "adjusted_nurse_aide_staffing_hours_per_resident_per_day": D97,
        "adjusted_lpn_staffing_hours_per_resident_per_day": D97,
        "adjusted_rn_staffing_hours_per_resident_per_day": D97,
        "adjusted_total_nurse_staffing_hours_per_resident_per_day": D97,
        "adjusted_weekend_total_nurse_staffing_hours_per_resident_per_day": D97,
        "rating_cycle_1_standard_survey_health_date": _S,
        "rating_cycle_1_total_number_of_health_deficiencies": "int",
        "rating_cycle_1_number_of_standard_health_deficiencies": "int",
        "rating_cycle_1_number_of_complaint_health_deficiencies": "int",
        "rating_cycle_1_health_deficiency_score": "int",
        "rating_cycle_1_number_of_health_revisits": "int",
        "rating_cycle_1_health_revisit_score": "int",
        "rating_cycle_1_total_health_score": "int",
        "rating_cycle_2_standard_health_survey_date": _S,
        "rating_cycle_2_total_number_of_health_deficiencies": "int",
        "rating_cycle_2_number_of_standard_health_deficiencies": "int",
        "rating_cycle_2_number_of_complaint_health_deficiencies": "int",
        "rating_cycle_2_health_deficiency_score": "int",
        "rating_cycle_2_number_of_health_revisits": "int",
        "rating_cycle_2_health_revisit_score": "int",
        "rating_cycle_2_total_health_score": "int",
        "rating_cycle_3_standard_health_survey_date": _S,
        "rating_cycle_3_total_number_of_health_deficiencies": "int",
        "rating_cycle_3_number_of_standard_health_deficiencies": "int",
        "rating_cycle_3_number_of_complaint_health_deficiencies": "int",
        "rating_cycle_3_health_deficiency_score": "int",
        "rating_cycle_3_number_of_health_revisits": "int",
        "rating_cycle_3_health_revisit_score": "int",
        "rating_cycle_3_total_health_score": "int",
        "total_weighted_health_survey_score": "decimal(8,4)",
        "number_of_facility_reported_incidents": "int", "number_of_substantiated_complaints": "int",
        "number_of_citations_from_infection_control_inspections": "int", "number_of_fines": "int",
        "total_amount_of_fines_in_dollars": "decimal(8,2)",
        "number_of_payment_denials": "int", "total_number_of_penalties": "int",
        "location": _S,
        "latitude": "decimal(8,5)", "longitude": "decimal(8,5)",
        "geocoding_footnote": _S, "processing_date": _S,
    },
    keys=("cms_certification_number_ccn",),
)

RULES = ValidationRules(
    fact_keys=("provnum", "workdate"),
    ref_keys=("cms_certification_number_ccn",),
    nonnegative=HOUR_COLUMNS,
    fact_ref_key="provnum",
    ref_key="cms_certification_number_ccn",
    fact_label="staffing",
    ref_label="provider",
    measure_label="hours",
)

# Fixed values. Curation: staffing attributes that fill inferred provider rows, and the one
# attribute carried onto every dimension row.
INFERRED_ATTRS = {"provname": "provider_name", "city": "city_town", "state": "state",
                  "county_name": "county_parish"}
CARRIED = {"county_fips": "county_fips"}
FACT_DROPS = ("workdate", "provname", "city", "state", "county_name", "county_fips")

# Serving: the dashboard's attribute projection of the dimension.
DASHBOARD_ATTRS = {"num_beds": "number_of_certified_beds", "in_hospital_flg": "provider_resides_in_hospital",
                   "overall_rating": "overall_rating"}

# The declared key of each profiled dataset (standardised column
# names); the aggregate-performance file is a single row and has no key.
DATASET_KEYS = {
    "PBJ_Daily_Nurse_Staffing_Q2_2024": ("provnum", "workdate"),
    "NH_ProviderInfo_Oct2024": ("cms_certification_number_ccn",),
    "NH_CitationDescriptions_Oct2024": ("deficiency_prefix_and_number",),
    "NH_CovidVaxAverages_20241027": ("state",),
    "NH_CovidVaxProvider_20241027": ("cms_certification_number_ccn",),
    "NH_DataCollectionIntervals_Oct2024": ("measure_code",),
    "NH_FireSafetyCitations_Oct2024": ("cms_certification_number_ccn", "survey_date", "deficiency_tag_number"),
    "NH_HealthCitations_Oct2024": ("cms_certification_number_ccn", "survey_date", "deficiency_tag_number"),
    "NH_HlthInspecCutpointsState_Oct2024": ("state",),
    "NH_Ownership_Oct2024": ("cms_certification_number_ccn", "role_played_by_owner_or_manager_in_facility",
                             "owner_name"),
    "NH_Penalties_Oct2024": ("cms_certification_number_ccn", "penalty_date", "fine_amount"),
    "NH_QualityMsr_Claims_Oct2024": ("cms_certification_number_ccn", "measure_code"),
    "NH_QualityMsr_MDS_Oct2024": ("cms_certification_number_ccn", "measure_code"),
    "NH_StateUSAverages_Oct2024": ("state_or_nation",),
    "NH_SurveyDates_Oct2024": ("cms_certification_number_ccn", "survey_date", "survey_type"),
    "NH_SurveySummary_Oct2024": ("cms_certification_number_ccn", "inspection_cycle"),
    "Skilled_Nursing_Facility_Quality_Reporting_Program_National_Data_Oct2024": ("measure_code",),
    "Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_Oct2024": ("cms_certification_number_ccn",
                                                                                 "measure_code"),
    "Swing_Bed_SNF_data_Oct2024": ("cms_certification_number_ccn", "measure_code"),
    "FY_2024_SNF_VBP_Aggregate_Performance": (),
    "FY_2024_SNF_VBP_Facility_Performance": ("cms_certification_number_ccn",),
}

# Serving contracts (the declared views), derived by rule from the contracts above.
DIM_FLAGS = ("provider_match_status", "provider_reference_source", "provider_reference_gap_flag")


def dim_view_columns() -> list[tuple[str, str]]:
    """Declared dimension view: provider columns in file order with the key
    named ``provnum``, ``county_fips`` after ``county_parish``, then the
    provenance flags and run stamps (lineage columns are not served, D3)."""
    cols = []
    for c, t in PROVIDER.columns.items():
        cols.append(("provnum" if c == "cms_certification_number_ccn" else c, t))
        if c == "county_parish":
            cols.append(("county_fips", "string"))
    return cols + [(f, "string") for f in DIM_FLAGS] + [("run_id", "string"), ("curated_ts_utc", "timestamp")]


def fact_view_columns() -> list[tuple[str, str]]:
    """Declared fact view: mdscensus served as decimal(10,2) (D1), the match
    flags joined from the dimension (D2), partition columns last."""
    return ([("provnum", "string"), ("cy_qtr", "string"), ("work_date", "date"), ("work_day", "int"),
             ("mdscensus", D10)] + [(c, D10) for c in HOUR_COLUMNS]
            + [("dataset_name", "string"), ("source_file_name", "string"), ("ingest_ts_utc", "timestamp")]
            + [(f, "string") for f in DIM_FLAGS]
            + [("run_id", "string"), ("curated_ts_utc", "timestamp"), ("work_year", "int"), ("work_month", "int")])
