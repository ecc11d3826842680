"""Job specifications: source column names, rename maps and name-edit tables.

FIXED VALUES. These must equal the values the reference's jobs use, because they
name columns of the published source files and repair area names so that they
match the boundary files' names. They are metadata (driver-side dicts), never data.
"""

from __future__ import annotations

import json
from pathlib import Path

CRIME = {
    "column_rename": {
        "PSOS_MMW_Name": "ward_name_2022",
        "COUNCIL NAME": "council_name",
        "CALENDAR YEAR": "year",
        "CALENDAR MONTH": "month",
        "DETECTED CRIME": "count",
    },
    "excluded_councils": ["Western Isles - Eilean Siar", "North Ayrshire"],
    "excluded_wards": [".Other / Unknown", "Other / Unknown"],
    # applied before the name key is built
    "manual_ward_edits": {
        "Eilean a Cheo": "Eilean Ã¡ ChÃ¨o",
        "Ft William and Ardnamurchan": "fortwilliamardnamurchan",
        "Glenboig and Moodiesburn": "gartcoshglenboigmoodiesburn",
        "Lerwick North": "lerwicknorthbressay",
    },
}

EDUCATION_2011 = {
    "skiprows": 12, "skipfooter": 5,
    "index": "Electoral Ward 2007", "columns": "Highest level of qualification", "values": "Count",
    "column_rename": {
        "Electoral Ward 2007": "ward_name_2007",
        "All people aged 16 and over: Level 1": "qual_level_1",
        "All people aged 16 and over: Level 2": "qual_level_2",
        "All people aged 16 and over: Level 3": "qual_level_3",
        "All people aged 16 and over: Level 4 and above": "qual_level_4",
        "All people aged 16 and over: No qualifications": "no_qual",
        "All people aged 16 and over: Total": "total_population",
    },
    # applied after the name key is built
    "manual_ward_edits": {
        "ste?rnabhaghadeas": "steornabhaghadeas",
        "ste?rnabhaghatuath": "steornabhaghatuath",
        "landcaithnessward": "landwardcaithness",
        "eileanach?o": "eileanacheo",
        "invernessmillburn": "invernessmilburn",
        "monifiethsidlaw": "monifeithsidlaw",
        "landcaithness": "landwardcaithness",
        "busbyclarkstoneagleshamward": "busbyclarkstoneaglesham",
    },
    "with_qual": ["qual_level_3", "qual_level_4"],
    "without_qual": ["qual_level_1", "qual_level_2", "no_qual"],
    "date": "2011-01-01",
}

EDUCATION_2022 = {
    "skiprows": 10, "skipfooter": 8,
    "index": "Electoral Ward 2022", "columns": "Highest level of qualification", "values": "Count",
    "column_rename": {
        "Electoral Ward 2022": "ward_name_2022",
        "All people aged 16 and over": "total_population",
        "No qualifications": "no_qual",
        "Lower school qualifications": "qual_level_1",
        "Upper school qualifications": "qual_level_2",
        "Further Education and sub-degree Higher Education qualifications incl. HNC/HNDs": "qual_level_3",
        # renamed without the dot of the source config ("qual_level_3.5"), see N12
        "Apprenticeship qualifications": "qual_level_3_5",
        "Degree level qualifications or above": "qual_level_4",
    },
    "manual_ward_edits": {
        "eileanacheo": "eileanacha o",
        "sgiruigecarlabhagh": "sgaraigecarlabhagh",
        "sgireanrubha": "sgareanrubha",
        "sgirenanloch": "sgarenanloch",
        "steornabhaghadeas": "stea2rnabhaghadeas",
        "steornabhaghatuath": "stea2rnabhaghatuath",
        "uibhistadeaseirisgeighbeinnnafaoghla": "uibhistadeasairisgeighbeinnnafaoghla",
    },
    "with_qual": ["qual_level_3", "qual_level_3_5", "qual_level_4"],
    "without_qual": ["qual_level_1", "qual_level_2", "no_qual"],
    "date": "2022-01-01",
}

EMPLOYMENT_2011 = {
    "skiprows": 12, "skipfooter": 5,
    "column_rename": {
        "Electoral Ward 2007": "ward_name_2007",
        "All people aged 16 to 74": "total_pop",
        "Economically inactive: Looking after home or family": "caring_for_family",
        "Economically inactive: Long-term sick or disabled": "long_term_sick_or_disabled",
        "Economically active: Unemployed": "unemployed_adults",
    },
    "manual_ward_edits": {
        "ste?rnabhaghadeas": "steornabhaghadeas",
        "ste?rnabhaghatuath": "steornabhaghatuath",
        "eileanach?o": "eileanacheo",
        "landcaithness": "landwardcaithness",
        "invernessmillburn": "invernessmilburn",
        "monifiethsidlaw": "monifeithsidlaw",
    },
    # Denominator of the unemployment rate: the columns whose (renamed) name says
    # "economically active" (X3: the reference's rename hides the unemployed column
    # from this sum; pass an explicit list to include it).
    "active_contains": "economically active",
    "date": "2011-01-01",
}

EMPLOYMENT_2022 = {
    "skiprows": 8, "skipfooter": 5,
    "column_rename": {
        "Economic activity - 20 groups, all": "ward_name_2022",
        "All people aged 16 and over": "total_pop",
        "Economically inactive - Looking after home/ family": "caring_for_family",
        "Economically inactive - Long term sick or disabled": "long_term_sick_or_disabled",
    },
    "active_columns": ["Economically Active (excluding full-time students) - Total",
                       "Economically Active full-time students - Total"],
    "unemployed_columns": ["Economically Active (excluding full-time students) - Unemployed - Available for work",
                           "Economically Active full-time students - Unemployed - Available for work"],
    "manual_ward_edits": EDUCATION_2022["manual_ward_edits"],
    "date": "2022-01-01",
}

BOUNDARIES_2022 = {
    "code": "WD25CD", "name": "WD25NM",
    "name_disambiguation": {
        "S13002737": "northislesorkneyislands",
        "S13002772": "northislesshetlandislands",
        "S13002830": "northeastdundeecity",
        "S13003133": "northeastglasgowcity",
    },
}

BOUNDARIES_2007 = {
    "code": "ONS_2010", "name": "Name",
    "name_disambiguation": {
        "S13002772": "northislesorkney",
        "S13002737": "northislesshetland",
        "S13002550": "northeastdundeecity",
        "S13002661": "northeastglasgowcity",
    },
}

POPULATION = {
    "header_regex": "Electoral Ward 2022 Name",
    "drop_contains": "Age",
    "sex_col": "Sex", "sex_value": "Persons",
    "column_rename": {"Electoral Ward 2022 Code": "ward_code", "Total": "total_population"},
    "drop": ["Sex", "Electoral Ward 2022 Name"],
    "years": {"2001": "2001-01-01", "2021": "2021-01-01"},
    "end_date": "2025-01-01",
}

WARD_AREA = {
    "code": "WD24CD", "name": "WD24NM", "area": "Shape__Area",
    "code_contains": "S",
    "rename": {"WD24CD": "ward_code", "Shape__Area": "area"},
    "scale": 1e-6,
}

SIMPLIFY_TOLERANCE_DEGREES = 0.002


def load_specs(path: str | Path) -> dict:
    """Job specs from a JSON file (same keys as the dicts above); metadata only."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)
