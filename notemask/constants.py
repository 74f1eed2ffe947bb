"""Tags, word lists and patterns the results depend on."""

# --- Fixed values: tags -----------------------------------------------------------------
NAME_TAG = "PersonName"
ADDRESS_TAG = "PAddress"
SSN_TAG = "SSNumber"
PHONE_TAG = "PhoneNumber"
EMAIL_TAG = "EAddress"
URL_TAG = "URLAddress"
IP_TAG = "IPAddress"
ACCOUNT_TAG = "AccountNumber"
TAGS = [PHONE_TAG, SSN_TAG, NAME_TAG, ADDRESS_TAG, EMAIL_TAG, URL_TAG, IP_TAG, ACCOUNT_TAG]
LENGTH_ERROR_TEXT = "ReportText Lenght Error Ocurred"

# --- Fixed values: word lists -----------------------------------------------------------
US_TERRITORIES = ["Guam", "Puerto Rico", "Virgin Islands", "American Samoa"]
STATE_ABBREVIATIONS = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM",
    "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA",
    "WV", "WI", "WY", "GU", "PR", "VI", "AS",
]
NOT_A_CITY_CODE = "88"
NON_CITY_WORDS = [
    "Enterprise", "Call", "Veteran", "Clear", "Section", "Check", "Standard", "Home", "Telephone",
    "Blue", "Points", "Florida", "Center", "Only", "Post", "Advance", "Onset", "Light", "Range",
    "Transfer", "Foley", "Hygiene", "Given", "Normal", "Start", "Comfort", "Falls", "Likely", "Day",
    "Money", "Calcium", "Felt", "Colon", "Mountain", "Tell", "Force", "Gateway", "Vista", "Morse",
    "Monitor", "Muse", "Drain", "Agency", "Street", "Success", "Cope", "Wells", "Effort", "Issue",
    "Hurt", "Power", "Hill", "House", "Cataract", "Deputy", "Accident", "Oral", "Index", "Reading",
    "United", "Early", "History", "Diabetes", "Tobacco", "Use", "SNOMED", "of", "Exposure",
    "Diverticulosis", "Happy", "May", "Green", "VA", "Iron", "Supply", "Wake", "Liberal", "Saline",
    "Intercourse", "Braden", "Paneled", "Mode", "Max", "Bath", "Brush", "White", "Vera", "University",
    "Man", "Levels", "paneled", "readings", "Rescue", "Orient", "Spray", "Ord", "Institute",
    "Universal", "Barrett", "Sun", "State", "Park", "State Park", "State park", "Vial", "Ideal",
]
NON_CITY_PHRASES = ["Mary D", "Cut Off", "D Lo"]
CLINIC_WORDS = [
    "VA", "CBOC", "Hospital", "Center", "Clinic", "CLC", "VISN", "County", "Medical", "Healthcare",
    "Health", "Division", "System", "Care", "Outpatient", "Primary", "Memorial",
]
ROLE_WORDS = ["Intern", "Nurse", "Doctor", "Physician", "Surgeon"]
CUTOFF_WORDS = [
    "JAN", "FEB", "MAR", "APR", "MAY", "JUNE", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC", "VA",
    "STAFF", "JANUARY", "FEBRUARY", "MARCH", "APRIL", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER",
    "NOVEMBER", "DECEMBER", "INTERN", "DOCTOR", "SURGEON", "NURSE",
]
STREET_WORDS = [
    "street", "st", "avenue", "ave", "road", "rd", "terrace", "lane", "ln", "highway", "hwy",
    "square", "sq", "trail", "trl", "way", "drive", "dr", "parkway", "pkwy", "court", "ct",
    "circle", "cir", "boulevard", "blvd", "place", "pl",
]
DIRECTION_WORDS = ["New", "North", "South", "West", "Puerto", "American"]

# --- Fixed values: patterns -------------------------------------------------------------
EMAIL_PATTERN = r"\S{1,}@\S{2,}\.\S{2,}"
SSN_DASHED_PATTERN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE_PATTERN = r"(?:[0-9]-)?[\+]?[(]?[0-9]{3}[)]?[-\s\.]{0,2}[0-9]{3}[-\s\.]?[0-9]{4,6}[)]?"
URL_PATTERN = (
    r"(https?:\/\/(?:www\.|(?!www))[a-zA-Z0-9][a-zA-Z0-9-]+[a-zA-Z0-9]\.[^\s]{2,}"
    r"|www\.[a-zA-Z0-9][a-zA-Z0-9-]+[a-zA-Z0-9]\.[^\s]{2,}"
    r"|https?:\/\/(?:www\.|(?!www))[a-zA-Z0-9]+\.[^\s]{2,}|www\.[a-zA-Z0-9]+\.[^\s]{2,})"
)
IP_PATTERN = (
    r"(\b25[0-5]|\b2[0-4][0-9]|\b[01]?[0-9][0-9]?)(\.(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)){3}"
)
