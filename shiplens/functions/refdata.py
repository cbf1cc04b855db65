"""Reference data that must equal the studied system's values.

Everything below the "Fixed values" markers is stated plainly, in the
order the source lists it; the dimension tables Spark joins against are built
from these lists by rule (see :mod:`shiplens.functions.scalars`).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# ZIP 3-digit prefix intervals -> USPS zone, in list order
# (first matching interval wins; no match -> DEFAULT_ZIP_ZONE).
# Chart "utils" (the lookup utility).
ZIP_CHART_UTILS = [
    # zone 8
    (5, 139, 8), (170, 176, 8), (178, 212, 8), (214, 214, 8), (216, 225, 8),
    (230, 238, 8), (278, 279, 8), (283, 285, 8), (294, 294, 8), (320, 322, 8),
    (327, 342, 8), (346, 347, 8), (349, 349, 8), (967, 969, 8), (995, 997, 8),
    # zone 7
    (140, 169, 7), (177, 177, 7), (215, 215, 7), (226, 229, 7), (239, 268, 7),
    (270, 277, 7), (280, 282, 7), (286, 293, 7), (295, 319, 7), (323, 326, 7),
    (344, 344, 7), (350, 352, 7), (355, 368, 7), (373, 374, 7), (376, 379, 7),
    (385, 385, 7), (395, 395, 7), (398, 399, 7), (403, 418, 7), (425, 426, 7),
    (430, 459, 7), (470, 470, 7), (480, 487, 7), (492, 492, 7),
    (700, 701, 7), (998, 998, 7),
    # zone 6
    (354, 354, 6), (369, 372, 6), (375, 375, 6), (380, 384, 6), (386, 394, 6),
    (396, 397, 6), (400, 402, 6), (420, 424, 6), (460, 469, 6),
    (471, 479, 6), (488, 491, 6), (493, 499, 6), (520, 524, 6), (526, 528, 6),
    (530, 532, 6), (534, 535, 6), (537, 539, 6), (541, 549, 6), (556, 559, 6),
    (600, 620, 6), (622, 631, 6), (633, 639, 6), (648, 648, 6), (650, 658, 6),
    (703, 708, 6), (710, 714, 6), (716, 726, 6), (728, 729, 6), (733, 733, 6),
    (749, 749, 6), (755, 759, 6), (770, 789, 6), (999, 999, 6),
    (300, 309, 6), (980, 989, 6), (330, 339, 6),
    # zone 5
    (500, 516, 5), (525, 525, 5), (540, 540, 5), (550, 551, 5), (553, 555, 5),
    (560, 567, 5), (570, 576, 5), (640, 641, 5), (644, 647, 5), (649, 649, 5),
    (660, 662, 5), (664, 676, 5), (678, 681, 5), (683, 689, 5), (727, 727, 5),
    (730, 731, 5), (734, 741, 5), (743, 748, 5), (750, 754, 5), (760, 769, 5),
    (790, 799, 5), (880, 882, 5), (885, 885, 5), (919, 921, 5), (931, 931, 5),
    (934, 934, 5), (949, 949, 5), (954, 955, 5), (970, 974, 5), (980, 986, 5),
    # zone 4
    (577, 577, 4), (590, 599, 4), (677, 677, 4), (690, 693, 4), (800, 813, 4),
    (820, 822, 4), (827, 828, 4), (835, 835, 4), (838, 838, 4), (850, 850, 4),
    (852, 853, 4), (855, 857, 4), (859, 860, 4), (863, 865, 4), (870, 875, 4),
    (877, 879, 4), (883, 884, 4), (889, 891, 4), (894, 895, 4), (897, 897, 4),
    (900, 908, 4), (910, 918, 4), (922, 928, 4), (930, 930, 4), (932, 933, 4),
    (935, 948, 4), (950, 953, 4), (956, 966, 4), (975, 978, 4), (988, 994, 4),
    # zone 3
    (814, 816, 3), (823, 826, 3), (833, 833, 3), (836, 837, 3), (893, 893, 3),
    (898, 898, 3), (979, 979, 3),
    # zone 2
    (829, 832, 2), (834, 834, 2), (840, 847, 2),
]
# Chart "cost" (the cost data rules) is the same list without the three
# "coverage" intervals (300-309, 980-989, 330-339 -> 6) and with prefix 427
# mapped to zone 6.
ZIP_CHART_COST_DROPPED = [(300, 309, 6), (980, 989, 6), (330, 339, 6)]
ZIP_CHART_COST_ADDED = [(427, 427, 6)]
DEFAULT_ZIP_ZONE = 5

# ---------------------------------------------------------------------------
# Rate cards by service level and rate zone 1..9.
RATE_SERVICES = ["Ground", "Express", "Priority", "Overnight"]
BASE_TRANSIT_DAYS = {
    "Overnight": [1.3, 1.4, 1.5, 1.6, 1.7, 1.8, 1.9, 1.9, 2.1],
    "Express": [2.2, 2.3, 2.5, 2.7, 2.8, 3.0, 3.1, 3.3, 3.5],
    "Priority": [3.4, 3.6, 3.7, 3.9, 4.1, 4.3, 4.5, 4.7, 5.0],
    "Ground": [5.7, 6.0, 6.4, 6.6, 7.0, 7.3, 7.6, 8.1, 8.1],
}
BASE_COST_USD = {
    "Overnight": [28.0, 28.5, 29.0, 29.5, 30.0, 30.5, 31.0, 31.5, 32.0],
    "Express": [20.5, 21.0, 21.5, 22.0, 22.5, 23.0, 23.5, 24.0, 24.5],
    "Priority": [15.0, 15.3, 15.8, 16.2, 16.8, 17.3, 17.8, 18.3, 18.8],
    "Ground": [11.0, 11.4, 12.0, 12.6, 13.2, 13.8, 14.6, 15.0, 15.5],
}
# carrier effect on transit days (added) and on cost (multiplied); other carriers: 0 / 1
CARRIER_DAYS_OFFSET = {
    "USPS": 0.0, "FedEx": -0.4, "UPS": -0.2, "DHL": 0.2, "Amazon_Logistics": 0.1,
    "OnTrac": 0.3, "LaserShip": 0.5, "Regional_Express": 0.6,
}
CARRIER_COST_MULT = {
    "USPS": 0.82, "FedEx": 1.15, "UPS": 1.08, "DHL": 1.25, "Amazon_Logistics": 0.88,
    "OnTrac": 0.92, "LaserShip": 0.78, "Regional_Express": 0.88,
}
DIM_FACTOR = 166.0          # cubic inches per dimensional pound
BILLABLE_COST_STEP = 0.08   # cost factor per billable pound above 1
FUEL_STEP = 0.005           # surcharge per (month mod 12)
MIN_TRANSIT_DAYS, MAX_TRANSIT_DAYS = 1.0, 30.0
MIN_COST_USD = 3.00

# ---------------------------------------------------------------------------
# Linear rate model per service level (statistical data rules).
# service: (base_time, zone_factor, base_cost)
SERVICE_SPECS = {
    "OVERNIGHT": (1.3, 0.08, 28.0),
    "EXPRESS": (2.2, 0.14, 20.5),
    "PRIORITY": (3.4, 0.19, 15.0),
    "STANDARD": (5.7, 0.30, 11.0),
    "ECONOMY": (8.6, 0.35, 9.0),
}
# carrier: (time_mult, cost_mult)
CARRIER_ADJUSTMENTS = {
    "USPS": (1.0, 0.82), "FedEx": (0.85, 1.15), "UPS": (0.90, 1.08), "DHL": (1.08, 1.25),
    "Amazon_Logistics": (1.02, 0.88), "OnTrac": (1.12, 0.92), "LaserShip": (1.18, 0.78),
}
TIME_MULT_CLAMP = (0.7, 1.4)
COST_MULT_CLAMP = (0.75, 1.35)
MIN_MODEL_DAYS, MIN_MODEL_COST = 0.8, 2.50
HEAVY_LBS, HEAVY_MULT, LIGHT_LBS, LIGHT_MULT = 10.0, 1.2, 1.0, 0.9
WEIGHT_COST, VOLUME_COST = 0.3, 0.0005

# ---------------------------------------------------------------------------
# Request schema (prediction endpoint).
REQUEST_CARRIERS = ["USPS", "FedEx", "UPS", "DHL", "Amazon_Logistics", "OnTrac", "LaserShip",
                    "Regional_Express"]
REQUEST_SERVICES = ["Ground", "Express", "Priority", "Overnight"]
REQUEST_RANGES = {
    "zone": (1, 9),
    "package_weight_lbs": (0.1, 70.0),
    "package_length_in": (1.0, 100.0),
    "package_width_in": (1.0, 100.0),
    "package_height_in": (1.0, 100.0),
    "insurance_value": (0.0, 10000.0),
}
REQUEST_REQUIRED = ["ship_date", "zone", "carrier", "service_level", "package_weight_lbs",
                    "package_length_in", "package_width_in", "package_height_in", "insurance_value"]

# Zone-only serving defaults of the rolling medians.
ZONE_ONLY_MEDIAN_TIME, ZONE_ONLY_MEDIAN_COST = 4.0, 15.0

# Carriers quoted for a request.
QUOTE_CARRIERS = ["USPS", "UPS", "FedEx"]

# Region codes grouped as "regional" by the distance category rule.
REGIONAL_GROUPS = [("US", "CANADA")]


def zip_chart(chart: str = "utils") -> list[tuple[int, int, int]]:
    """Interval list of a chart, in first-match order."""
    if chart == "utils":
        return list(ZIP_CHART_UTILS)
    if chart == "cost":
        out = [iv for iv in ZIP_CHART_UTILS if iv not in ZIP_CHART_COST_DROPPED]
        return out + list(ZIP_CHART_COST_ADDED)
    raise ValueError("chart must be 'utils' or 'cost'")


def prefix_zone_rows(chart: str = "utils") -> list[tuple[int, int]]:
    """Flatten a chart to (prefix 0..999, zone): first match wins, default otherwise."""
    ivs = zip_chart(chart)
    rows = []
    for p in range(1000):
        z = next((zone for lo, hi, zone in ivs if lo <= p <= hi), DEFAULT_ZIP_ZONE)
        rows.append((p, z))
    return rows
