"""Values that results depend on."""

# ---- fixed values: country labels -------------------------------------------------------------------------------

COUNTRY_SHORTCUTS = [("(FRENCH)", "France")]

COUNTRY_CUT_AT = " ("

COUNTRY_REPLACEMENTS = [
    ("'", ""),
    ("Is.", "Islands"),
    ("Isls", "Islands"),
    ("Invalid: ", ""),
    ("St.", "Saint"),
]

COUNTRY_KEYWORDS = [
    ("Cocos", "Cocos (Keeling) Islands"),
    ("Johnson Island", "Johnston Island"),
    ("Ussr", "USSR"),
    ("Laos", "Lao People's Democratic Republic"),
    ("Kampuchea", "Cambodia"),
    ("Maarten", "Sint Maarten"),
]

MIN_SCORE = 70

NO_MATCH = "No match found"

# ---- fixed values: port labels ----------------------------------------------------------------------------------

UNUSABLE_PORT_LABELS = ["No PORT Code", "Collapsed"]

PORT_NOISE = [
    "INVALID - ",
    " (BPS)",
    " (I-91)",
    " (RT. 5)",
    " (BP - SECTOR HQ)",
    " #ARPT",
    "#ARPT",
    "-ARPT",
    "ARPT",
]

PORT_REPLACEMENTS = [
    ("NETH ANTILLES", "Netherlands Antilles"),
    ("WASHINGTON #INTL", "WA"),
    ("MEXICO Land (Banco de Mexico)", "Mexico City, Mexico"),
    ("PASO DEL NORTE,TX", "PASO DEL NORTE, TX"),
    ("WASHINGTON DC", "WASHINGTON, DC"),
    ("MARIPOSA AZ", "MARIPOSA, AZ"),
    ("SAIPAN, SPN", "SAIPAN, MP"),
    ("Abu Dhabi", "ABU DHABI, UNITED ARAB EMIRATES"),
    ("SEOUL KOREA", "SEOUL, SOUTH KOREA"),
    ("PRC", "CHINA"),
    ("TURK & CAIMAN", "Turks and Caicos Islands"),
    ("PAPUA, NEW GUINEA", "SEPIK PLAINS, PAPUA NEW GUINEA"),
    ("ENGLAND", "UNITED KINGDOM"),
    ("UNIDENTIFED AIR / SEAPORT", "Unknown code"),
    ("UNKNOWN POE", "Unknown code"),
    ("NOT REPORTED/UNKNOWN", "Unknown code"),
]

# Words that tell countries of otherwise like names apart.
GUARD_WORDS = ["north", "south", "east", "west", "northern", "southern", "eastern", "western", "new", "old"]

# ---- fixed values: raw column -> published column ---------------------------------------------------------------

STATE_COLUMNS = {
    "stusab": "state_code",
    "name": "state_name",
    "centlat": "latitude",
    "centlon": "longitude",
}

CITY_COLUMNS = ["state_code", "state", "city", "male_population", "female_population", "median_age"]

ISO_COLUMNS = {
    "country": "iban_country",
    "alpha-2_code": "iban_iso2",
    "alpha-3_code": "iban_iso3",
}

COORDINATE_COLUMNS = {
    "alpha-3_code": "ccc_iso3",
    "alpha-2_code": "ccc_iso2",
    "country": "ccc_country",
    "latitude_average": "ccc_lat",
    "longitude_average": "ccc_long",
}

AIRPORT_RENAMES = {"iso_country": "iso2_country", "iso_region": "iso2_region"}

AIRPORT_NO_PLACE = "0, 0"

TEMPERATURE_COLUMNS = [
    "date",
    "country_iso3166",
    "city",
    "averagetemperature",
    "averagetemperatureuncertainty",
    "latitude",
    "longitude",
]

ARRIVAL_COLUMNS = [
    "cicid",
    "i94yr",
    "i94mon",
    "biryear",
    "gender",
    "i94res",
    "i94cit",
    "arrdate",
    "i94mode",
    "i94port",
    "airline",
    "fltno",
    "i94visa",
    "i94addr",
    "depdate",
]

# ---- types of the columns that are no text ------------------------------------------------------------------------

STATE_TYPES = {"centlat": "double", "centlon": "double"}

CITY_TYPES = {"median_age": "double", "male_population": "int", "female_population": "int"}

AIRPORT_TYPES = {"elevation_ft": "int"}

ARRIVAL_TYPES = {
    "cicid": "double",
    "i94yr": "double",
    "i94mon": "double",
    "i94res": "double",
    "i94cit": "double",
    "arrdate": "double",
    "i94mode": "double",
    "i94visa": "double",
    "depdate": "double",
    "biryear": "string",
    "i94port": "string",
    "i94addr": "string",
    "gender": "string",
    "airline": "string",
    "fltno": "string",
}

ARRIVAL_INTEGERS = ["cicid", "i94yr", "i94mon", "biryear", "i94res", "i94cit"]

ARRIVAL_RENAMES = {
    "i94yr": "year",
    "i94mon": "month",
    "biryear": "birth_year",
    "i94res": "residence_country",
    "i94cit": "citizenship_country",
    "i94port": "port_of_entry",
    "fltno": "flight_no",
    "i94addr": "address_state",
}

ARRIVAL_KEY = ["cicid", "year", "month"]

# ---- fixed values: key columns that must not be null, per published table ---------------------------------------

TABLE_KEYS = {
    "state_boundaries": ["state_code"],
    "city_demographics": ["city", "state_code"],
    "countries": ["i94_cntyl_code"],
    "ports": ["i94_prtl_code"],
    "arrivals": ARRIVAL_KEY,
    "temperatures": ["date", "city", "country_iso3166"],
    "time": ["date", "year", "month", "day_of_month", "day_of_week", "week_of_year"],
}
