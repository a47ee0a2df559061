"""Fixed values of the sepsis measure: codes, patterns and limits it is defined by."""

# Diagnosis codes.
SEPSIS = "99591"
SEVERE_SEPSIS = "99592"
SEPTIC_SHOCK = "78552"

# Item codes.
LACTATE = 50813
BLOOD_CULTURE = 70012
FLUIDS = (30061, 30062, 30063)
VASOPRESSORS = (221906, 221289, 221749, 222315, 221662)
MEAN_ARTERIAL_PRESSURE = (52, 456, 6702, 443, 220052, 220181, 225312)
WEIGHT_KG = 226512
WEIGHT_LB = 226531

# Units and limits.
KG_PER_LB = 0.453592
WEIGHT_RANGE_KG = (30, 300)
LOW_PRESSURE = 65
LACTATE_REPEAT_ABOVE = 2
LACTATE_HIGH = 4

# Text patterns (a % inside a pattern is a wildcard).
SEPSIS_TITLES = ("sepsis", "septicemia", "septic")
LACTATE_LABELS = ("lactate",)
LACTATE_LABELS_EXCLUDED = ("dehydrogenase",)
BLOOD_SPECIMENS = ("blood",)
WEIGHT_LABELS = ("weight",)
PRESSURE_LABELS = ("mean%bp", "map")
TIME_ZERO_DRUGS = ("cefepime", "vancomycin", "piperacillin")
ANTIBIOTIC_NAMES = (
    "cefepime", "ceftazidime", "piperacillin", "tazobactam", "zosyn", "meropenem", "imipenem",
    "doripenem", "aztreonam", "levofloxacin", "ciprofloxacin", "moxifloxacin", "vancomycin",
    "linezolid", "daptomycin", "ampicillin/sulbactam", "unasyn", "ticarcillin", "clavulanate",
)
CRYSTALLOID_LABELS = (
    "normal saline", "sodium chloride 0.9%", "na cl 0.9%", "0.9% saline", "lactated ringer",
    "ringer% lactate", "plasma%lyte",
)
VASOPRESSOR_LABELS = (
    "norepinephrine", "noradrenaline", "levophed", "epinephrine", "phenylephrine", "vasopressin",
    "dopamine",
)
