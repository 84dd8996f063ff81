"""Fixed values that results depend on: names in the input tables, constants, texts."""

# --- fixed values: constant columns -------------------------------------------------------
BG = "SDBG"
BU = ""
LOCAL = "NTD"
FOREIGN = "USD"
PROFIT_CENTER = "PCA000"
PROFIT_CENTER_NAME = "SDBG"
UPDATE_FREQUENCY = "monthly"

# --- fixed values: ledger types ------------------------------------------------------------
TYPES = ["Actual", "Budget", "R3M"]
PREDICTED = {"arima": "PredictARIMA", "es": "PredictES", "ma": "PredictMA"}

# --- fixed values: line items ----------------------------------------------------------------
INVOICE_QUANTITY = "Invoice quantity"
PRODUCTION_QUANTITY = "Production quantity"
PPV = "Material cost_Purchase price variance"
MUV = "Material cost_Material usage variance"
NORMAL_SHIPMENT = "Sales_Normal shipment"
RETURN_ALLOWANCE = "Sales_Sales return & allowance"
VARIANCE_OF_ITEM = {
    PPV: "price_variance",
    MUV: "usage_variance",
    NORMAL_SHIPMENT: "shipment",
    RETURN_ALLOWANCE: "allowance",
}
APP_ITEMS = [
    "revenue",
    "material_cost",
    "other_cost",
    "opex",
    "moh",
    "production_volume",
    "shipment_volume",
]

# --- fixed values: raw profit-and-loss columns ------------------------------------------------
PL_IDS = ["Year", "Month", "Period", "Site", "Project"]
SHIPPED_UNITS = "11.1 F/G+Zbox+base unit"
INVOICED_UNITS = "11.9 Invoice quantity"

# --- fixed values: manufacturing overhead ----------------------------------------------------
FIXED_MOH_INPUT = ["Depreciation-W-buy", "IDL", "Facilities", "other utilities"]
FIXED_MOH_ALERT = [" Electricity&Water", "other utilities", "IDL", "Depreciation-W-buy"]
SITE_MOH = ["MOH_WEKS", "MOH_WMI"]
MOH_NOT_AT_SITE = [("WMI", "MOH_WEKS"), ("WKS", "MOH_WMI")]
ALERT_COST_GROUPS = ["Other cost", "OPEX"]

# --- fixed values: cost categories -------------------------------------------------------------
LEVEL0_NAMES = {"oc": "other", "mc": "mat"}
LEVEL0_PREFIX = "ucg_"
AGGREGATE = "aggregate"
ALL = "ALL"

# --- fixed values: health scores -----------------------------------------------------------------
SCORES = [
    "shipment/apr",
    "production/apr",
    "moh/quote",
    "ads/ads_target",
    "yield/yield_target",
    "material/m_target",
]
MASS_PRODUCTION = "MP"

# --- fixed values: alert thresholds and titles ---------------------------------------------------
IMPACT = 0.00001
PRODUCTION_SHARE = 0.5
ADS_SHARE = 1.1
COST_SHARE = 1.2
FIRST_YEAR = 2018
TITLES = {
    1: "Capacity under-usage",
    2: "Shipment below APR",
    3: "Average days stock too high",
    4: "Scrap rate too high",
    5: "Yield rate target unmet",
    6: "Positive material cost variance",
}
