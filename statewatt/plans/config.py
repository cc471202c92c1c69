"""Fixed values of the models: class lists, factors, thresholds and labels.

They must stay as published for results to agree.
"""

from __future__ import annotations

FIRST_DAY = "2019-01-01"
REPORT_YEAR = 2024
RELIABILITY_YEARS = (2019, 2024)
EARLY_YEARS = ["2019", "2020", "2021"]
LATE_YEARS = ["2022", "2023", "2024"]

NON_CONTIGUOUS = ["AK", "HI", "PR"]
COUNTRY_ROW = "US"

RENEWABLE = ["solar", "wind", "hydro"]
VARIABLE_RENEWABLE = ["solar", "wind"]
FOSSIL = ["gas", "coal", "oil"]

# mmbtu per mwh
HEAT_RATES = {"gas": 7.0, "coal": 10.5, "oil": 11.0}
HIGH_NULL_PCT = 40

CUSTOMER_CLASSES = ["residential", "commercial", "industrial"]
BUSINESS_CLASSES = ["commercial", "industrial"]

RAPID_GROWTH = 0.05
MODERATE_GROWTH = 0.02
HIGH_CONCENTRATION = 0.7
MODERATE_CONCENTRATION = 0.4

RESIDENTIAL_ACCESS = [
    (["TX", "OH", "PA", "IL", "NH", "RI", "MA"], 5),
    (["NY", "NJ", "MD", "CT", "ME", "DC"], 4),
    (["DE"], 3),
    (["OR", "NV", "CA"], 2),
]
RESIDENTIAL_ACCESS_DEFAULT = 1

WHOLESALE_COMPLEXITY = [(["ERCOT"], 5), (["PJM", "MISO", "NYISO", "ISO_NE"], 3)]
WHOLESALE_COMPLEXITY_DEFAULT = 1

NO_MARKET_OPERATOR = "non_ISO"
CENTRAL_MARKET = ("ERCOT", 5)
# (market structure, inside a market operator's area) -> score
MARKET_STRUCTURE_SCORES = [
    ("deregulated", True, 5),
    ("restricted", True, 4),
    ("regulated", True, 3),
    ("restricted", False, 3),
    ("regulated", False, 2),
]
MARKET_STRUCTURE_DEFAULT = 2

# lower bound of the percentage with supplier choice -> score
CHOICE_ACCESS = [(50, 5), (30, 4), (15, 3), (5, 2)]
CHOICE_ACCESS_DEFAULT = 1

HIGH_INVESTMENT = 5
HIGH_CONSTRUCTION_MW = 500
HIGH_FLAGS = 2
MEDIUM_INVESTMENT = (1, 4.9)
MEDIUM_FLAGS = 1

MIN_LOAD_TWH = 0.5
CONSTRAINT_WEIGHTS = {"dc_grid_constraint_flag": 3, "dc_fossil_delay_flag": 2, "dc_onsite_gen_flag": 2}
OPERATOR_POINTS = {"PJM": 2, "MISO": 1, "ISO_NE": 1, "NYISO": 1, "ERCOT": 0}

# growth flags corrected by hand after research
GROWTH_OVERRIDES = [("VA", "High"), ("IL", "High"), ("NJ", "High"), ("WA", "High"), ("IA", "High"), ("CA", "Medium")]

MATCH_THRESHOLD = 60.0
TERRITORY_TYPE = "COOPERATIVE"

RETAIL_DIRECT = "Direct Retail Model"
RETAIL_LIMITED = "Direct Retail — Limited Access"
RETAIL_PARTNERSHIP = "C&I Access Only — Partnership for Residential"
UTILITY_ONLY = "Utility Partnership Only"
BUSINESS_AND_CENTERS = "Direct C&I + Data Center Partnership"
CENTERS = "Data Center Partnership"
BUSINESS_DIRECT = "Direct C&I Model"
CENTER_PIPELINE = "Utility Partnership — Data Center Pipeline"
