"""Lists, lookup tables and constants that results depend on.

Everything in this module is a given value, stated as it is, in its natural order.
"""

from __future__ import annotations

# --- Fixed values: source status words and the status each one means -------------
STATUS_WORDS = {
    "completed": "completed",
    "complete": "completed",
    "attended": "completed",
    "arrived": "arrived",
    "booked": "booked",
    "confirmed": "booked",
    "cancelled": "cancelled",
    "canceled": "cancelled",
    "dna": "dna",
    "no show": "dna",
    "no_show": "dna",
    "did not attend": "dna",
    "rescheduled": "rescheduled",
}

# --- Fixed values: match rules, strongest first ----------------------------------
# rule name, confidence, the fields that must all be equal
MATCH_RULES = [
    ("email_dob", 0.99, ["email_norm", "date_of_birth"]),
    ("email", 0.95, ["email_norm"]),
    ("phone_name", 0.93, ["phone_norm", "name_key"]),
    ("name_dob_postcode", 0.88, ["name_key", "date_of_birth", "postcode"]),
]
AUTO_LINK_CONFIDENCE = 0.90

# --- Fixed values: attributes given to dimension members in id order -------------
CLINIC_NAMES = ["Bondi Junction", "Parramatta", "Chatswood", "Newtown", "Liverpool", "Manly"]
CLINIC_STATES = ["NSW", "NSW", "NSW", "NSW", "NSW", "NSW"]
CLINIC_ROOMS = [6, 8, 5, 4, 7, 5]
CLINIC_TIMEZONE = "Australia/Sydney"

PRACTITIONER_FIRST_NAMES = [
    "Sarah", "James", "Priya", "Wei", "Mohammed", "Emma",
    "Liam", "Aroha", "Daniel", "Sophie", "Raj", "Chloe",
]
PRACTITIONER_LAST_NAMES = [
    "Mitchell", "Nguyen", "Patel", "Chen", "Okafor", "Wilson",
    "Brown", "Taylor", "Singh", "Kaur", "Novak", "Ferrari",
]
DISCIPLINES = [
    ("Physiotherapy", 95.0),
    ("Podiatry", 88.0),
    ("Exercise Physiology", 78.0),
    ("Occupational Therapy", 92.0),
    ("Dietetics", 82.0),
]
FULL_TIME_FTE = 1.0
PART_TIME_FTE = 0.6
PART_TIME_EVERY = 4

# name, fee, minutes, payer
SERVICES = [
    ("Initial Consultation", 140.0, 45, "Private"),
    ("Standard Consultation", 95.0, 30, "Private"),
    ("Extended Consultation", 165.0, 60, "Private"),
    ("DVA Standard", 88.0, 30, "DVA"),
    ("NDIS Session", 193.99, 60, "NDIS"),
    ("Home Care Visit", 110.0, 45, "HomeCare"),
]

# --- Fixed values: pricing and capacity ------------------------------------------
DNA_FEE_RATE = 0.50
DNA_BILLABLE_PAYER = "Private"
DEFAULT_COSTED_MINUTES = 30
BILLABLE_HOURS_PER_DAY = 6.5

# --- Fixed values: patient value and lapse ---------------------------------------
LAPSED_AFTER_DAYS = 90
HIGH_VALUE_FROM = 0.80
MEDIUM_VALUE_FROM = 0.40

# --- Fixed values: quality thresholds --------------------------------------------
MAX_NULL_CLINIC_RATE = 0.01
MAX_BOOKED_RATE = 0.60
MAX_FUTURE_DAYS = 365
MAX_DURATION_MIN = 480
MAX_BAD_DURATION_RATE = 0.05
MAX_NULL_PHONE_RATE = 0.30
MAX_NULL_EMAIL_RATE = 0.40
MAX_UNMATCHABLE_RATE = 0.10

# --- Fixed values: incremental extraction ----------------------------------------
OVERLAP_HOURS = 48
DEFAULT_BACKFILL_DAYS = 730
MAX_ERROR_CHARS = 1000
BUSINESS_TIMEZONE = "Australia/Sydney"

# entity, key of the record list in a response, field that says when a record changed
# (None: the entity has no such field and is always read in full)
ENTITIES = {
    "appointments": {"results_key": "appointments", "modified_field": "lastModified"},
    "patients": {"results_key": "patients", "modified_field": "DateModified"},
    "practitioners": {"results_key": "practitioners", "modified_field": None},
    "locations": {"results_key": "locations", "modified_field": None},
    "invoices": {"results_key": "invoices", "modified_field": None},
    "appointment_types": {"results_key": "services", "modified_field": None},
}

# --- Fixed values: catalog layout -------------------------------------------------
LAYERS = ["landing", "bronze", "silver", "gold", "gold_secure", "ops", "ml"]
OPS_TABLES = ["watermark", "ingest_audit", "dq_results", "recon_results"]
GOLD_TABLES = [
    "dim_date", "dim_clinic", "dim_practitioner", "dim_service",
    "fct_appointment", "fct_capacity",
    "mart_clinic_monthly", "mart_practitioner_monthly",
    "mart_service_monthly", "mart_patient_summary",
]

# --- Fixed values: rate scale on dashboards ---------------------------------------
RATE_NAME_PARTS = ["pct", "rate", "ratio", "utilisation", "utilization"]
PROPORTION_LIMIT = 1.5
