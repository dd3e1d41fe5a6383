"""Table layouts, era renames and the fixed code lists."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column layouts of the unified tables.
# ---------------------------------------------------------------------------
TABLES: dict[str, list[str]] = {
    "demo": [
        "primaryid", "caseid", "caseversion", "i_f_cod", "sex", "age", "age_cod", "age_grp", "wt", "wt_cod",
        "reporter_country", "occr_country", "event_dt", "rept_dt", "mfr_dt", "init_fda_dt", "fda_dt", "rept_cod",
        "occp_cod", "mfr_num", "mfr_sndr", "to_mfr", "e_sub", "quarter", "auth_num", "lit_ref",
    ],
    "drug": ["primaryid", "drug_seq", "role_cod", "drugname", "prod_ai"],
    "drug_info": [
        "primaryid", "drug_seq", "val_vbm", "nda_num", "lot_num", "route", "dose_form", "dose_freq", "exp_dt",
        "dose_vbm", "cum_dose_unit", "cum_dose_chr", "dose_amt", "dose_unit", "dechal", "rechal",
    ],
    "indi": ["primaryid", "drug_seq", "indi_pt"],
    "outc": ["primaryid", "outc_cod"],
    "reac": ["primaryid", "pt", "drug_rec_act"],
    "rpsr": ["primaryid", "rpsr_cod"],
    "ther": ["primaryid", "drug_seq", "start_dt", "end_dt", "dur", "dur_cod"],
}

# ---------------------------------------------------------------------------
# Names that changed between the two eras (old -> unified).
# Names are matched ignoring case; all other names only change to lower case.
# ---------------------------------------------------------------------------
ERA_NAMES: dict[str, dict[str, str]] = {
    "demo": {
        "isr": "primaryid",
        "case": "caseid",
        "foll_seq": "caseversion",
        "gndr_cod": "sex",
        "i_f_code": "i_f_cod",
    },
    "drug": {"isr": "primaryid"},
    "drug_info": {"isr": "primaryid", "lot_nbr": "lot_num"},
    "indi": {"isr": "primaryid", "indi_drug_seq": "drug_seq"},
    "outc": {"isr": "primaryid", "outc_code": "outc_cod"},
    "reac": {"isr": "primaryid"},
    "rpsr": {"isr": "primaryid"},
    "ther": {"isr": "primaryid", "dsg_drug_seq": "drug_seq"},
}

# File kinds a quarterly drop holds; DRUG files feed both drug and drug_info.
FILE_KINDS = ["demo", "drug", "reac", "outc", "rpsr", "ther", "indi"]

# ---------------------------------------------------------------------------
# Code lists.
# ---------------------------------------------------------------------------
SEX_CODES = ["F", "M"]
OCCUPATION_CODES = ["MD", "CN", "OT", "PH", "HP", "LW", "RN"]
OUTCOME_NAMES = {
    "DE": "Death",
    "LT": "Life-Threatening",
    "HO": "Hospitalization",
    "DS": "Disability",
    "CA": "Congenital Anomaly",
    "RI": "Required Intervention",
    "OT": "Other",
}
ROLE_ORDER = ["C", "I", "SS", "PS"]
OUTCOME_ORDER = ["OT", "CA", "HO", "RI", "DS", "LT", "DE"]
DEMO_FACTORS = [
    "caseversion", "sex", "quarter", "i_f_cod", "rept_cod", "occp_cod", "e_sub", "age_grp", "occr_country",
    "reporter_country",
]

# ---------------------------------------------------------------------------
# Unit factors and plausibility limits.
# The HR, MIN and SEC age factors give years, not days; kept so that results
# agree with earlier cleaned releases. Pass other factors to override.
# ---------------------------------------------------------------------------
AGE_FACTORS = {
    "DEC": 3650.0,
    "YR": 365.0,
    "MON": 30.41667,
    "WK": 7.0,
    "DY": 1.0,
    "HR": 0.00011415525114155251,
    "MIN": 1.9025875190259e-06,
    "SEC": 3.1709791983764586e-08,
}
AGE_MAX_DAYS = 122 * 365
WEIGHT_FACTORS = {
    "LBS": 0.453592,
    "IB": 0.453592,
    "KG": 1.0,
    "KGS": 1.0,
    "GMS": 0.001,
    "MG": 0.000001,
}
WEIGHT_MAX_KG = 635
ONSET_CUTOFF = "20121231"

# ---------------------------------------------------------------------------
# Terms that mean "nothing reported" and the trial marker.
# ---------------------------------------------------------------------------
EMPTY_SUBSTANCES = ["no medication", "unspecified"]
EMPTY_REACTIONS = ["no adverse event"]
UNKNOWN_SUBSTANCE = "UNKNOWN"
TRIAL_MARK = ", trial"

# ---------------------------------------------------------------------------
# Validation rules per kind. A rule lists the allowed values;
# rules marked upper compare the upper-cased value.
# ---------------------------------------------------------------------------
REQUIRED: dict[str, list[str]] = {
    "demo": ["primaryid", "i_f_cod", "event_dt", "sex"],
    "drug": ["primaryid", "drug_seq", "drugname"],
    "reac": ["primaryid", "pt"],
    "outc": ["primaryid", "outc_cod"],
    "indi": ["primaryid", "drug_seq", "indi_pt"],
    "ther": ["primaryid", "drug_seq", "start_dt"],
}
ALLOWED: dict[str, dict[str, list[str]]] = {
    "demo": {"sex": ["M", "F", "UNK"], "age_cod": ["YR", "MON", "WK", "DY", "HR"]},
    "drug": {
        "role_cod": ["PS", "SS", "C", "I"],
        "route": ["ORAL", "INTRAVENOUS", "SUBCUTANEOUS", "INTRAMUSCULAR", "TOPICAL"],
    },
    "outc": {"outc_cod": list(OUTCOME_NAMES)},
}
UPPER_RULES = {"route", "outc_cod"}
DATE_FIELDS: dict[str, list[str]] = {
    "demo": ["event_dt", "fda_dt", "rept_dt"],
    "ther": ["start_dt", "end_dt"],
}

# ---------------------------------------------------------------------------
# Columns of the tables the cleaned release is split into.
# ---------------------------------------------------------------------------
SPLIT: dict[str, list[str]] = {
    "demo": [
        "primaryid", "sex", "age_in_days", "wt_in_kgs", "occr_country", "event_dt", "occp_cod", "reporter_country",
        "rept_cod", "init_fda_dt", "fda_dt", "premarketing", "literature",
    ],
    "demo_supp": [
        "primaryid", "caseid", "caseversion", "i_f_cod", "auth_num", "e_sub", "lit_ref", "rept_dt", "to_mfr",
        "mfr_sndr", "mfr_num", "mfr_dt", "quarter",
    ],
    "drug": ["primaryid", "drug_seq", "substance", "role_cod"],
    "drug_name": ["primaryid", "drug_seq", "drugname", "prod_ai"],
    "reac": ["primaryid", "pt", "drug_rec_act"],
    "outc": ["primaryid", "outc_cod"],
    "indi": ["primaryid", "drug_seq", "indi_pt"],
    "ther": ["primaryid", "drug_seq", "start_dt", "dur_in_days", "end_dt", "time_to_onset", "event_dt"],
    "doses": [
        "primaryid", "drug_seq", "dose_vbm", "cum_dose_unit", "cum_dose_chr", "dose_amt", "dose_unit", "dose_freq",
    ],
    "drug_supp": ["primaryid", "drug_seq", "route", "dose_form", "dechal", "rechal", "lot_num", "exp_dt"],
}


def text_schema(columns: list[str]) -> T.StructType:
    """All raw columns are text; values are typed by the operators."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
