"""Fixed values that must equal the reference's for identical results.

FIXED VALUES — labels, band edges, thresholds and defaults, stated as text in
their natural order.
"""

import datetime as _dt

# Calendar names (Monday first; January first)
WEEKDAY_NAMES_FR = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
MONTH_NAMES_FR = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
                  "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre"]

# Sex normalisation
SEX_MALE_SPELLINGS = ["HOMME", "H", "MALE"]
SEX_FEMALE_SPELLINGS = ["FEMME", "FEMALE", "FE"]
SEX_VALID = ["M", "F"]

# Age band used by the warehouse (upper bounds exclusive): <18, <31, <51, <66, else
AGE_BAND_WAREHOUSE = [(18, "0-17"), (31, "18-30"), (51, "31-50"), (66, "51-65")]
AGE_BAND_WAREHOUSE_ELSE = "65+"
AGE_BAND_WAREHOUSE_UNPARSABLE = "31-50"

# Age band used in staging: right-closed intervals (0,14] (14,29] ... (89,120]
AGE_BAND_STAGING_EDGES = [0, 14, 29, 44, 59, 74, 89, 120]
AGE_BAND_STAGING_LABELS = ["0-14", "15-29", "30-44", "45-59", "60-74", "75-89", "90+"]

# Valid age range
AGE_MIN, AGE_MAX = 0, 120

# Length-of-stay classes (first match wins)
STAY_SHORT, STAY_MEDIUM, STAY_LONG, STAY_UNKNOWN = "Courte (<= 3j)", "Moyenne (4-7j)", "Longue (> 7j)", "Inconnue"

# Occupancy levels: < 60, < 85, >= 85
OCC_LOW, OCC_NORMAL, OCC_CRITICAL, OCC_UNKNOWN = "Faible", "Normal", "Critique", "Inconnu"
OCC_LOW_BELOW, OCC_NORMAL_BELOW = 60, 85

# Admission modes, discharge mode
MODE_URGENT, MODE_PLANNED = "Urgence", "Programmée"
DISCHARGE_MODE = "Domicile"

# Emergency dispositions
DISPOSITION_ADMITTED = "Hospitalisé"
DISPOSITIONS = ["Hospitalisé", "Renvoyé", "Transféré", "DAMA"]

# Dimension defaults
DEFAULT_HOSPITAL_BEDS = 200
DEFAULT_HOSPITAL_DOCTORS = 50
DEFAULT_SERVICE_BEDS = 20
DEFAULT_DISEASE_SEVERITY = 3
DEFAULT_CHRONIC = 0
DEFAULT_RX_DAYS = 7

# Quality score
SCORE_DUP_MALUS_CAP = 20
SCORE_NULL_MALUS_CAP = 30
SCORE_LEVELS = [(90, "EXCELLENT"), (70, "BON"), (50, "MOYEN")]
SCORE_LEVEL_ELSE = "FAIBLE"
SCORE_FAIL_BELOW = 50

# Run log statuses accepted
RUN_STATUSES = ["RUNNING", "SUCCESS", "FAILED", "SKIPPED"]

# Epidemic statuses that count as active
EPIDEMIC_ACTIVE = ["Active", "Alerte"]

# Readmission window (days between previous discharge and new admission)
READMISSION_DAYS = 30

# Pipeline parameters (ours): reproducible replacements of the reference's
# clock and random draws.
DAILY_RATE = 500.0
CALENDAR_START = _dt.date(1995, 1, 1)
CALENDAR_END = _dt.date(2024, 12, 31)
AS_OF_ADMISSIONS = _dt.date(2000, 12, 31)
AS_OF_EVENTS = _dt.date(2024, 1, 30)
COMPUTED_AT = "2000-12-31T00:00:00"
