"""Default parameters of the business rules.

Fixed values: constants that must equal the source rules for the derived
tables to match (rates, thresholds, formats).  Where the original rule drew a
random number from a range, the default is the midpoint of that range and the
value is a parameter.
"""

from __future__ import annotations

import datetime as _dt

# Clock of the fixture data: all "as of today" rules take this date.
AS_OF = _dt.date(2001, 9, 15)

# Keyed draws: default seed.
SEED = 42

# Shipments: a line-level freight upcharge applies above this total weight.
UPCHARGE_WEIGHT_LB = 250
UPCHARGE_AMOUNT = 50.00

# Invoices.
DEFAULT_TAX_RATE = 0.07
FREIGHT_BASE = 5.0
FREIGHT_PER_CUFT = 0.4         # midpoint of 0.2 .. 0.6
FREIGHT_PER_50LB = 1.0         # midpoint of 0.5 .. 1.5
FREIGHT_DEFAULT_CUBE = 0.1
FREIGHT_DEFAULT_WEIGHT = 1.0
# payment terms: (name, days, early-pay discount share); chosen by order key
PAYMENT_TERMS = [("Net 30", 30, 0.0), ("Net 45", 45, 0.0), ("Net 60", 60, 0.0),
                 ("2% 10 Net 30", 30, 0.02), ("1% 10 Net 45", 45, 0.01)]
DISCOUNT_TAKEN_RATE = 0.6
INVOICE_LAG_DAYS = 1           # midpoint of 0 .. 2
POSTING_LAG_DAYS = 2           # 0 .. 5 in the source; a parameter here

# AR ledger.
AR_HOLD_RISK = 0.6
AR_HOLD_DAYS = 30
AR_WRITE_OFF_BALANCE = 200
AR_WRITE_OFF_DAYS = 90
AGING_BUCKETS = ["Current", "1-30", "31-60", "61-90", "90+"]

# Freight class (NMFC) overrides by subcategory, then category.
NMFC_OVERRIDES = {
    "Furniture": "125",
    "Office Supplies": "150",
    "Paper": "70",
    "Envelopes": "150",
    "Labels": "150",
    "Binders": "150",
    "Fasteners": "150",
    "Storage": "150",
    "Art": "150",
    "Appliances": "125",
    "Technology": "100",
    "Phones": "100",
    "Machines": "100",
    "Copiers": "92.5",
    "Accessories": "100",
}
# density staircase (upper bound exclusive, class); null density -> 150
NMFC_DENSITY_STEPS = [(1, "300"), (2, "250"), (4, "150"), (6, "125"), (8, "100"), (10, "92.5")]
NMFC_DENSITY_TOP = "70"
NMFC_NULL_DENSITY = "150"

DIM_WEIGHT_DIVISOR = 139.0
CUBIC_INCHES_PER_FT = 1728.0

# Time zones: zone -> states; states not listed fall back to Central.
TIME_ZONES = {
    "Eastern": ["NY", "NJ", "MA", "PA", "GA", "FL", "NC", "SC", "VA", "OH", "MI"],
    "Central": ["TX", "IL", "WI", "MN", "MO", "TN", "AL", "LA"],
    "Mountain": ["CO", "UT", "AZ", "NM"],
    "Pacific": ["CA", "WA", "OR", "NV"],
}
DEFAULT_TIME_ZONE = "Central"


# ---------------------------------------------------------------------------
# Lookup lists and tables that must equal the source rules.
# ---------------------------------------------------------------------------
# forecast error: base MAPE by ABC class, variability by XYZ class
MAPE_BASE = {"A": 0.05, "B": 0.10, "C": 0.18}
XYZ_VARIABILITY = {"X": 0.8, "Y": 1.2, "Z": 1.8}
# credit factor by return condition
CONDITION_FACTOR = {"Resalable": 1.00, "Damaged": 0.50, "Defective": 0.25, "Destroyed": 0.00}
RETURN_REASONS = ["Damaged", "Wrong Item", "Not as Described", "Overshipment", "Customer Preference", "Defective"]
RETURN_REASON_WEIGHTS = [0.24, 0.10, 0.16, 0.06, 0.28, 0.16]
BACKORDER_REASONS = ["Insufficient Inventory", "Vendor Delay", "Damaged Inbound Shipment",
                     "Unexpected Demand Spike", "Quality Hold"]
# inventory adjustments: types and the reasons valid for each
ADJUSTMENT_TYPES = ["Cycle Count", "Damage", "Shrink", "Return to Stock", "Administrative Correction"]
ADJUSTMENT_REASONS = {
    "Cycle Count": ["Count Variance", "Recount Adjustment", "Audit Correction"],
    "Damage": ["Crushed", "Leaking", "Broken", "Packaging Damage"],
    "Shrink": ["Lost", "Misplaced", "Theft Suspected"],
    "Return to Stock": ["Customer Return", "Restock", "RMA"],
    "Administrative Correction": ["Data Entry Error", "Unit of Measure Correction", "Transfer Correction"],
}
# labor: weekly base hours, role and hourly rate range per department
DEPARTMENT_BASE_HOURS = {"Receiving": 120, "Picking": 200, "Packing": 160, "Shipping": 140,
                         "Inventory Control": 80}
DEPARTMENT_ROLE = {"Receiving": "Receiving Associate", "Picking": "Picker", "Packing": "Packer",
                   "Shipping": "Shipping Clerk", "Inventory Control": "Inventory Analyst"}
DEPARTMENT_RATE_RANGE = {"Receiving": (19.0, 23.0), "Picking": (18.0, 22.0), "Packing": (18.0, 21.0),
                         "Shipping": (20.0, 24.0), "Inventory Control": (22.0, 27.0)}
OVERTIME_MULTIPLIER = 1.5
# driver costs: cost types, the floor of each rate range, company share of the LTL minimum
COST_TYPES = ["hourly", "per_mile", "per_stop"]
DRIVER_RATE_FLOOR = {"hourly": 18.0, "per_mile": 0.30, "per_stop": 8.0}
COMPANY_SHARE = 0.8
# tracking milestones: (sequence, hours after ship date, event type, location type)
MILESTONES = [(0, 0, "departed_dc", "DC"), (1, 6, "arrived_hub", "carrier_facility"),
              (2, 12, "out_for_delivery", "carrier_facility"), (3, 18, "delivered", "carrier_facility")]
# catalog file header (with its misspelt subcategory column) and postal file layout
CATALOG_COLUMNS = ["product_code", "description", "product_category", "produc_subcategory", "unit_cost",
                   "unit_price", "shipping_cost_per_unit", "length_in", "width_in", "height_in", "weight_lbs",
                   "cubic_ft"]
POSTAL_FIELDS = ["country_code", "postal_code", "place_name", "admin_name1", "admin_code1", "admin_name2",
                 "admin_code2", "admin_name3", "admin_code3", "latitude", "longitude", "accuracy"]
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
