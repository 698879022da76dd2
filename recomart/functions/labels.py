"""Label tables of the CRM forms.

FIXED VALUES. Every string below must equal the answer text the CRM stores,
code point for code point (Cyrillic look-alikes, en dashes, curly apostrophes
and trailing spaces are deliberate); the classes and numbers are the mart
vocabulary. Order inside each table is the natural reading order of the rules.
"""

# --- fixed values: maximum rent duration (English, German answer) ----------
# answers, class, typical nights, minimum nights, maximum nights
MAX_RENT_DURATION = [
    (("Less than one month", "Unter einem Monat"), "<1 mo", 15, 1, 29),
    (("One month", "Einen Monat"), "1 mo", 30, 30, 30),
    (("One to three months", "Einen bis drei Monate"), "1-3 mo", 60, 31, 89),
    (("Three to six months", "Drei bis sechs Monate"), "3-6 mo", 120, 91, 179),
    (("Longer than six months", "Länger als sechs Monate"), ">6 mo", 200, 181, 360),
]

# --- fixed values: rent per person -------------------------------------------
# answers, class, number (None = NULL)
RENT_PER_PERSON = [
    (("Kostenlos", "I would rent it for free"), "for_free", 0),
    (("über 500€ pro Monat", "More than 500 Euros/month"), ">500 mo", 1000),
    (("Ich bin mir nicht sicher", "I'm unsure"), "unsure", None),
    (("Under 250 Euros/month", "Unter 250€ pro Monat"), "<250 mo", 250),
    (("250 - 500€ pro Monat", "Between 250 - 500 Euros/month"), "250-500 mo", 500),
]
UNSURE_CLASS = "unsure"

# --- fixed values: pets possible ---------------------------------------------
# answers, class, boolean (None = NULL)
PETS_POSSIBLE = [
    (("Vielleicht", "Maybe"), "maybe", None),
    (("Nein", "No"), "no", False),
    (("Ja", "Yes"), "yes", True),
]

UNDEFINED = "undefined"

# --- fixed values: "no" answers compared literally (wildcards NOT applied) ----
LITERAL_NO_ANSWERS = ("%no %", "%without", "None%")

# --- fixed values: LIKE rules over lower-cased free text ---------------------
# has-pets "no" patterns, rule C and rule D (rule D also treats '' as "no")
PETS_NO_LIKE_C = ("%no %", "%without", "none%")
PETS_NO_LIKE_D = ("%no%", "%without%", "%don%")
# has-disability "no" patterns, rule B and rule C (rule C also treats '' as "no")
DISABILITY_NO_LIKE_B = ("%no%", "%without", "%none%", "%don%")
DISABILITY_NO_LIKE_C = ("%no%", "%without", "%don%")

# --- fixed values: deal status and reasons -----------------------------------
STATUS_OPEN, STATUS_LOST, STATUS_WON = "open", "lost", "won"
EXCLUDED_LOST_REASONS = ("Flawed/Fake Data Entry", "Duplicate Data")
LANDLORD_PIPELINE = 2
TENANT_PIPELINE = 1

# --- fixed values: product price classes (thresholds in EUR/month) -----------
PRICE_FREE, PRICE_LOW, PRICE_MID, PRICE_HIGH = "for_free", "<250 mo", "250-500 mo", ">500 mo"

# --- fixed values: stay classes from nights (note: exactly 90 nights has none) -
NIGHTS_LT_1, NIGHTS_1, NIGHTS_1_3, NIGHTS_3_6, NIGHTS_GT_6 = "<1 mo", "1 mo", "1-3 mo", "3-6 mo", ">6 mo"

# --- fixed values: source flags ----------------------------------------------
BOTH, CRM_ONLY, PRODUCT_ONLY = "both_sources", "in_pipedrive_only", "in_product_only"

# --- fixed values: free-text "needed months" answers, in rule order ---------
# Equality answers per class. Two LIKE rules sit in the middle of the rule
# list: '%know%' -> Unknown, then '%indef%' -> '>6 mo'. No equality answer
# listed after them contains either fragment, so equality first, then the
# LIKE rules, then the default gives the same class for every input.
NEEDED_MONTHS_UNKNOWN = "Unknown"
NEEDED_MONTHS_EQUALS = [
    ("<1  month", "<1 mo"),
    ("<1 Monat", "<1 mo"),
    ("<1 month", "<1 mo"),
    ("<1 months", "<1 mo"),
    ("<1 мonth", "<1 mo"),
    ("<1 месяц", "<1 mo"),
    ("<1 місяць", "<1 mo"),
    ("<1month", "<1 mo"),
    ("1", "1 mo"),
    ("1 month", "1 mo"),
    ("1 month,", "1 mo"),
    ("1 to 3 months", "1-3 mo"),
    ("1-2 months", "1-3 mo"),
    ("1-3", "1-3 mo"),
    ("1-3 months", "1-3 mo"),
    ("1–3 Monat", "1-3 mo"),
    ("1–3 Monate", "1-3 mo"),
    ("1–3 month", "1-3 mo"),
    ("1–3 monthes", "1-3 mo"),
    ("1–3 months", "1-3 mo"),
    ("1–3 мonate", "1-3 mo"),
    ("1–3 мonths", "1-3 mo"),
    ("1–3 місяці", "1-3 mo"),
    ("1–3 місяці / 1-3 months", "1-3 mo"),
    ("1–3months", "1-3 mo"),
    ("2", "1-3 mo"),
    ("3 - 6 months", "3-6 mo"),
    ("3 to 6 months", "3-6 mo"),
    ("3-6 Monate", "3-6 mo"),
    ("3-6 month", "3-6 mo"),
    ("3-6 months", "3-6 mo"),
    ("3-6 months ", "3-6 mo"),
    ("3–6 Monate", "3-6 mo"),
    ("3–6 month", "3-6 mo"),
    ("3–6 months", "3-6 mo"),
    ("3–6 мonths", "3-6 mo"),
    ("3–6 місяців", "3-6 mo"),
    ("As long as it's not in", "Unknown"),
    ("As long as it's not in dotted", "Unknown"),
    ("As long as it's not in text", "Unknown"),
    ("as long as possible", "Unknown"),
    ("As long as required", "Unknown"),
    ("Between 1 and 3 Months", "1-3 mo"),
    ("From 1 - 3 months", "1-3 mo"),
    ("from 1 to 3 months", "1-3 mo"),
    ("from 1 tо 3 months", "1-3 mo"),
    ("from 3 to 6 month", "3-6 mo"),
    ("from 3 to 6 months", "3-6 mo"),
    ("I am not sure", "Unknown"),
    ("I can't pay", "Unknown"),
    ("I can’t pay rent", "Unknown"),
    ("less a month", "1 mo"),
    ("less than 1 month", "1 mo"),
    ("Less than 1 month - <1 місяць", "1 mo"),
    ("less than a month", "1 mo"),
    ("Less than a month - <1 місяць", "1 mo"),
    ("less than a month,", "1 mo"),
    ("less than one month", "1 mo"),
    ("Not defined yet", "Unknown"),
    ("Not sure", "Unknown"),
    ("Not sure so far, я ще не знаю", "Unknown"),
    ("Not sure yet.", "Unknown"),
    ("open.", "Unknown"),
    ("s", "Unknown"),
    ("So far, no strings attached", ">6 mo"),
    ("So far, no strings attached.", ">6 mo"),
    ("So far, no strings attached.ž", ">6 mo"),
    ("So long as it's in no particular order", ">6 mo"),
    ("Uncertain", ">6 mo"),
    ("Undetermined", ">6 mo"),
    ("Unlimited term", ">6 mo"),
    ("от 1 3 months", "1-3 mo"),
    ("от 1 до 3 месяцев", "1-3 mo"),
    ("от 3 до 6 месяцев", "3-6 mo"),
    ("Пока на неопределенный срок", ">6 mo"),
    ("Поки що безстроково", ">6 mo"),
    ("Я еще не знаю", "Unknown"),
    ("я ще не знаю", "Unknown"),
]
NEEDED_MONTHS_LIKE = [("%know%", "Unknown"), ("%indef%", ">6 mo")]

# --- fixed values: typical nights per "needed months" class ------------------
NEEDED_MONTHS_NIGHTS = [("<1 mo", 15), ("1 mo", 30), ("1-3 mo", 60), ("3-6 mo", 120), (">6 mo", 360)]
