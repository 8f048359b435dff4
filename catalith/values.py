"""Word lists, patterns, thresholds and sentences.

They must be exactly these for results to come out right.  Every pack is a
default; the functions that use one take it as a parameter.
"""

from __future__ import annotations

from catalith.functions.rules import Rule

# Missing data, years, numbers ---------------------------------

MISSING_TEXTS = ("", "nan", "none", "null")
PLACEHOLDER = "placeholder"
OPEN_YEARS = ("now", "present", "current")
DASHES = "‐‑‒–—―−"
YEAR_PATTERN = r"(19\d{2}|20\d{2})"
OLD_YEAR_PATTERN = r"198\d|199\d"
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DIGITS_PATTERN = r"^[0-9]+$"
ZERO_TEXTS = ("0", "0.0", "")

# Text clean-up ------------------------------------------------

TAIL_PATTERNS = (r"© \d{4}-\d{4}", r"Bauer Media Group")
ESSENCE_WORDS = 150
FIELD_ESSENCE_WORDS = 160
SPECS_BUDGET = 8000

STRONG_BOILERPLATE = (
    r"follow\s+(?:three|3)\s+simple\s+steps\s+to\s+get\s+to\s+your\s+desired\s+version",
)
WEAK_BOILERPLATE = (
    r"step\s*1\s*of\s*3\s*-\s*select\s*trim\s*level",
    r"step\s*2\s*of\s*3\s*-\s*select\s*engine",
    r"step\s*3\s*of\s*3\s*-\s*select\s*version",
    r"select\s+one\s+of\s+the\s+versions\s+below",
    r"brief\s+specification\s+overview",
    r"enter\s+the\s+car\s+registration",
)
BOILERPLATE_HITS = 2

# Column maps --------------------------------------------------

HEADER_MAP = {
    "Make": "make",
    "Model": "model",
    "Series (production years start-end)": "series_production_years",
    "Year start": "year_start",
    "Year end": "year_end",
    "Real Body Type": "real_body_type",
    "engine type": "engine_type",
    "Power (bhp)": "power_bhp",
    "Transmission": "transmission",
    "Doors": "doors",
    "Seats": "seats",
    "Min. of used price low helper": "used_price_low_min",
    "Max. of used price high helper": "used_price_high_max",
    "Min. of mpg low helper": "mpg_low_min",
    "Min. of Insurance group": "insurance_group_min",
    "Min. of 0-60 mph (secs)": "zero_to_sixty_secs_min",
    "Average of Length (mm)": "length_mm_avg",
    "Average of Width (mm)": "width_mm_avg",
    "Average of Height (mm)": "height_mm_avg",
    "Average of Luggage Capacity (litres)": "luggage_capacity_litres_avg",
}
STRUCTURED_MAP = {
    "engine type": "engine_type",
    "Transmission": "transmission_type",
    "Min. of Power (bhp)": "bhp_min",
    "Max. of Power (bhp)": "bhp_max",
    "Min. of Insurance group": "insurance_group_min",
    "Max. of Insurance group": "insurance_group_max",
    "Min. of mpg low helper": "mpg_min",
    "Max. of mpg high helper": "mpg_max",
    "Min. of used price low helper": "price_min",
    "Max. of used price high helper": "price_max",
}
REVIEW_FIELDS = (
    "author", "publish_date", "new_price_min", "new_price_max", "used_price_min",
    "used_price_max", "road_tax_min", "road_tax_max", "insurance_group", "fuel_economy",
    "range_min", "range_max", "doors", "fuel_types", "pros", "cons", "rivals",
)

# Size and body rules ------------------------------------------

SUV = ("suv", "crossover")
SALOON = ("saloon", "sedan")
ESTATE = ("estate", "touring")
WAGON = ("estate", "wagon")
SPORTBACK = ("sportback", "fastback", "gran coupe", "gran-coupe", "grancoupe")
OPEN_TOP = ("convertible", "cabrio", "roadster")

SIZE_BUCKET = (
    Rule("small hatchback", any_of=("hatch",), below=4300, or_missing=True),
    Rule("medium hatchback", any_of=("hatch",)),
    Rule("estate", any_of=ESTATE),
    Rule("crossover SUV", any_of=SUV, below=4600, or_missing=True),
    Rule("large SUV", any_of=SUV),
    Rule("gran coupe", all_of=("coupe", "gran")),
    Rule("coupe", any_of=("coupe",)),
    Rule("small saloon", any_of=SALOON, below=4700, or_missing=True),
    Rule("executive saloon", any_of=SALOON),
    Rule("MPV", any_of=("mpv",)),
)
SIZE_DESCRIPTOR = (
    Rule("large executive hatchback (gran coupe style)", any_of=SPORTBACK, at_least=4850),
    Rule("executive hatchback (gran coupe style)", any_of=SPORTBACK),
    Rule("premium estate", any_of=ESTATE, all_of=("premium",)),
    Rule("estate", any_of=ESTATE),
    Rule("large SUV", any_of=SUV, at_least=4700),
    Rule("crossover SUV", any_of=SUV),
    Rule("executive saloon", any_of=SALOON, at_least=4700, or_missing=True),
    Rule("small saloon", any_of=SALOON),
    Rule("medium hatchback", any_of=("hatch",), at_least=4300, or_missing=True),
    Rule("small hatchback", any_of=("hatch",)),
    Rule("MPV", any_of=("mpv",)),
    Rule("coupe", any_of=("coupe",)),
    Rule("large executive car", at_least=4850),
)
COARSE_SIZE = (
    Rule("large SUV", any_of=SUV, at_least=4600),
    Rule("exec saloon", at_least=4900),
    Rule("large", at_least=4600),
    Rule("crossover SUV", any_of=SUV, at_least=4400),
    Rule("medium", at_least=4400),
    Rule("small hatchback", any_of=("hatch",), below=4400),
    Rule("crossover SUV", any_of=("suv",), below=4400),
    Rule("compact", below=4400),
    Rule("crossover SUV", any_of=SUV),
    Rule("small saloon", any_of=SALOON),
    Rule("estate", any_of=WAGON),
    Rule("small hatchback", any_of=("hatch",)),
    Rule("mpv", any_of=("mpv",)),
    Rule("coupe", any_of=("coupe",)),
)
SIZE_CLASS = (
    Rule("full-size", equals=SUV, at_least=4800),
    Rule("executive", at_least=4900),
    Rule("large", at_least=4600),
    Rule("mid-size", at_least=4400),
    Rule("compact", below=4400),
    Rule("compact", equals=SUV, missing=True),
    Rule("executive", equals=SALOON + WAGON, missing=True),
)
BODY_LABEL = (
    Rule("executive hatchback (gran coupe style)", any_of=SPORTBACK, at_least=4850),
    Rule("gran coupe", any_of=SPORTBACK),
    Rule("estate", any_of=ESTATE),
    Rule("convertible", any_of=OPEN_TOP),
    Rule("MPV", any_of=("mpv",)),
    Rule("coupe", any_of=("coupe",)),
    Rule("large SUV", any_of=SUV, at_least=4700),
    Rule("crossover SUV", any_of=SUV),
    Rule("executive saloon", any_of=SALOON, at_least=4700),
    Rule("small saloon", any_of=SALOON),
    Rule("medium hatchback", any_of=("hatch",), at_least=4300, or_missing=True),
    Rule("small hatchback", any_of=("hatch",)),
)
DEFAULT_BODY_LABEL = "medium hatchback"
VAGUE_BODIES = ("other", "unknown", "")
LONG_HATCHBACK_MM = 4850

CANONICAL_LABELS = (
    "small hatchback", "medium hatchback", "estate", "crossover SUV", "large SUV", "small saloon",
    "executive saloon", "coupe", "gran coupe", "executive hatchback (gran coupe style)",
    "convertible", "MPV", "pickup",
)
LABEL_CASCADE = (
    Rule("gran coupe", all_of=("gran", "coupe")),
    Rule("executive hatchback (gran coupe style)", all_of=("executive",), any_of=("hatch", "gran")),
    Rule("executive saloon", any_of=SALOON, all_of=("executive",)),
    Rule("small saloon", any_of=SALOON),
    Rule("estate", any_of=ESTATE),
    Rule("MPV", any_of=("mpv",)),
    Rule("convertible", any_of=OPEN_TOP),
    Rule("coupe", any_of=("coupe",)),
    Rule("large SUV", any_of=SUV, all_of=("large",)),
    Rule("crossover SUV", any_of=SUV),
    Rule("medium hatchback", any_of=("hatch",)),
)
BODY_KEYWORDS = (
    "hatchback", "saloon", "sedan", "estate", "wagon", "coupe", "gran coupe", "fastback", "suv",
    "crossover", "convertible", "roadster", "mpv",
)

# Metric buckets -----------------------------------------------

PERFORMANCE = (
    Rule("supercar", below=3.5),
    Rule("very fast", below=5),
    Rule("decent performance", below=7),
    Rule("average slow", below=10),
    Rule("very slow", at_least=10),
)
ECONOMY = (
    Rule("strong economy", at_least=55),
    Rule("good economy", at_least=45),
    Rule("average economy", at_least=35),
    Rule("lower economy", below=35),
)
BOOT = (
    Rule("pack light", below=300),
    Rule("usable hatch practicality", below=450),
    Rule("generous boot capacity", below=600),
    Rule("extra-large cargo space", at_least=600),
)

# Fuel and mileage ---------------------------------------------

FUEL_TYPES = ("petrol", "diesel", "mild hybrid", "plug in hybrid", "electric")
FUEL_RULES = (
    Rule("electric", any_of=("electric", "ev")),
    Rule("plug in hybrid", all_of=("hybrid", "plug")),
    Rule("mild hybrid", any_of=("hybrid",)),
    Rule("diesel", any_of=("diesel",)),
)
SHORT_MILEAGE = "0–80k miles"
LASTING_MILEAGE = "0–100k miles"
HIGH_MILEAGE = "40k–100k miles"
MILEAGE_FUELS = ("electric", "hybrid")
MILEAGE_LASTING_MAKES = ("toyota", "lexus", "honda")
MILEAGE_HIGH_MAKES = ("bmw", "audi", "mercedes")
MILEAGE_AGE_YEAR = 2024

# Variant sentences --------------------------------------------

AUTOMATIC = ("auto", "dsg", "dct", "tronic")
ALL_WHEEL = ("quattro", "xdrive", "4matic", "awd", "4wd")
SMALL_ENGINE = r"\b(1\.0|1\.2|1\.3|1\.4)\b"
MID_ENGINE = r"\b(1\.5|1\.6|1\.8|2\.0)\b"
SPORT_ENGINE = r"\b(?:m|amg|rs|vrs|type\s*r|sti|gti|p\s*tuned)\b"
SMALL_OR_LOW_POWER = r"\b(1\.0|1\.2|1\.3|1\.4)\b|\b(110|120|125)\b"

VARIANT_DIESEL = "suited to long-distance efficiency and relaxed motorway cruising"
VARIANT_PLUGIN = "great for low running costs and tax, especially around town"
VARIANT_HYBRID = "quiet and frugal in stop-start driving"
VARIANT_ELECTRIC = "very quiet with instant response; best if you can charge at home"
VARIANT_ENGINE = (
    Rule("genuinely quick and more enthusiast-leaning", pattern=SPORT_ENGINE),
    Rule("nippy and economical for city-friendly use", pattern=SMALL_OR_LOW_POWER),
    Rule("balanced for daily driving, mixing pace and efficiency", pattern=MID_ENGINE),
)
VARIANT_PETROL = "responsive and easy-going for everyday use"
VARIANT_GEARBOX = (
    Rule("smoother shifting for hassle-free driving", any_of=AUTOMATIC),
    Rule("more engaging feel if you like to be involved", any_of=("manual",)),
)
VARIANT_DRIVE = (Rule("added all-weather confidence", any_of=ALL_WHEEL),)
VARIANT_NONE = "A sensible choice for typical daily driving."

NOTE_PERFORMANCE = (
    r"(?i)\b(m|amg|rs|vrs|sti|type[\s-]?r|gti|cupra|quadrifoglio|s\/?|\br\/?)(?:\b|[^a-z])"
)
NOTE_BIG = r"(?i)\b(3\.\d|4\.\d|V6|V8|V12)\b"
NOTE_SMALL = r"\b(0\.9|1\.0|1\.2|1\.3|1\.4)\b|(\b1[0-4]\d?\s?t)|\b(110|120)\s?ps\b"
NOTE_DIESEL_ENGINE = r"\btdi|dci|cdi|hdi|cdti\b"
NOTE_MID_SIZES = ("1.5", "1.6", "1.8", "2.0")
NOTE_MID_MARKS = ("t", "tsi", "tfs", "turbo", "na")
NOTE_ALL_WHEEL = ("awd", "4matic", "xdrive", "quattro")
# A note holds where one of its first tests does and none of its second: (field, words or pattern).
NOTE_RULES = (
    ("diesel", (("fuel", ("diesel",)), ("engine", NOTE_DIESEL_ENGINE)), ()),
    ("hybrid", (("fuel", ("hybrid",)),), (("fuel", ("plug",)),)),
    ("plugin", (("fuel", ("plug", "phev")),), ()),
    ("electric", (("fuel", ("ev", "electric")),), ()),
    ("quick", (("badge", NOTE_PERFORMANCE), ("badge", NOTE_BIG)), ()),
    ("small", (("engine", NOTE_SMALL),), (("badge", NOTE_PERFORMANCE),)),
    ("mid", (("engine", NOTE_MID_SIZES),), (("badge", NOTE_PERFORMANCE), ("unmarked engine", NOTE_MID_MARKS))),
    ("automatic", (("gearbox", AUTOMATIC),), ()),
    ("manual", (("gearbox", ("manual",)),), ()),
    ("all_wheel", (("drive", NOTE_ALL_WHEEL),), ()),
)
NOTE_TEXTS = {
    "diesel": "great for long motorway journeys with relaxed cruising and strong economy",
    "hybrid": "suited to mixed driving with lower running costs in town",
    "plugin": "ideal for short commutes with low tax and the ability to drive on electric power in town",
    "electric": "very quiet and smooth with instant response; best if you can home-charge",
    "quick": "genuinely quick and aimed at enthusiasts",
    "small": "nippy and efficient, easy to live with in the city",
    "mid": "a balanced choice mixing pace and efficiency for daily use",
    "automatic": "smoother automatic gearbox for effortless driving",
    "manual": "manual gearbox for a more engaging feel",
    "all_wheel": "added confidence from all-wheel drive in poor weather",
    "none": "a straightforward, easygoing choice for everyday driving",
}

# Use cases, highlights, audiences -----------------------------

USE_CASES = (
    Rule("family trips and everyday versatility", any_of=SUV + WAGON),
    Rule("comfortable commuting and long-distance cruising", any_of=SALOON),
    Rule("family hauling and practicality", any_of=("mpv",)),
    Rule("weekend drives and style-focused buyers", any_of=("coupe",)),
    Rule("city duties and easy daily use", any_of=("hatch",)),
)
USE_CASE_DEFAULT = "general everyday driving"
HIGHLIGHTS = (
    Rule("space and visibility, refined ride", any_of=SUV),
    Rule("comfort and refinement, premium feel", any_of=SALOON),
    Rule("big boot and practicality, long-trip comfort", any_of=WAGON),
    Rule("clever interior, family-friendly usability", any_of=("mpv",)),
    Rule("style and engagement", any_of=("coupe",)),
    Rule("easy to park, efficient running", any_of=("hatch",)),
)
HIGHLIGHTS_DEFAULT = "easy to live with"

BUYER_ECO_WORDS = ("ev", "electric", "phev", "plug")
BUYER_DIESEL_WORDS = ("diesel", "tdi", "dci", "cdi")
BUYER_FAMILY_WORDS = ESTATE + SUV
BUYER_GOOD_ECONOMY = ("strong economy", "good economy")
BUYER_ECO = "eco-conscious commuters"
BUYER_MILES = "high-mileage professionals"
BUYER_FAMILY = "practical families"
BUYER_DEFAULT = "city and suburban commuters"

AUDIENCES = (
    Rule("ideal for city use and new drivers", any_of=("small hatchback",)),
    Rule(
        "great for families and daily commuting",
        any_of=("medium hatchback", "estate", "crossover"),
    ),
    Rule(
        "well-suited to professionals and long-distance commuters",
        any_of=("executive", "saloon", "gran coupe"),
    ),
    Rule("best for those who value style and weekend enjoyment", any_of=("coupe",)),
)
AUDIENCE_DEFAULT = "a versatile choice for a wide range of drivers"
STRENGTHS = {
    "small hatchback": "easy to park, low running costs",
    "medium hatchback": "good balance of space and efficiency",
    "estate": "huge boot and family practicality",
    "crossover SUV": "higher driving position and family-friendly usability",
    "large SUV": "spacious interior and long-distance comfort",
    "executive saloon": "refinement, comfort and a premium cabin",
    "small saloon": "comfort and a more grown-up feel than a hatchback",
    "gran coupe": "sleek looks with more practicality than a traditional coupe",
    "coupe": "standout styling and an engaging drive",
    "MPV": "ultimate people-moving practicality",
}
STRENGTH_DEFAULT = "a sensible mix of comfort, usability and value"
BRAND_HINTS = {
    "bmw": "driver-focused feel with premium refinement",
    "audi": "tech-led interior and solid refinement",
    "mercedes-benz": "comfort and luxury first",
    "mercedes": "comfort and luxury first",
    "vw": "all-round capability and quality",
    "volkswagen": "all-round capability and quality",
    "skoda": "space and value",
    "seat": "youthful, sporty vibe",
    "kia": "strong value and long warranties",
    "hyundai": "value, warranty and ease of use",
    "toyota": "reliability and efficiency",
    "honda": "usability and longevity",
    "mazda": "driver involvement with efficiency",
}
BRAND_HINT_DEFAULT = "a well-rounded package"

# Essence sentences --------------------------------------------

DRIVING_ENGINE = (
    Rule("quiet, tax-friendly running in town on electric power", any_of=("phev", "plug-in")),
    Rule("quiet, efficient progress in stop-start driving", any_of=("hybrid",)),
    Rule("silent, instant response, best with home charging", any_of=("ev", "electric")),
    Rule("relaxed long‑distance cruising with strong economy", any_of=BUYER_DIESEL_WORDS),
    Rule("nippy, efficient feel that suits urban and suburban use", pattern=SMALL_ENGINE),
    Rule("balanced everyday pace with sensible running costs", pattern=MID_ENGINE),
)
DRIVING_GEARBOX = (
    Rule("an effortless automatic to keep things smooth", any_of=AUTOMATIC),
    Rule("a more engaging manual shift", any_of=("manual",)),
)
DRIVING_PACE = {
    "supercar": "ferociously quick with explosive acceleration",
    "very fast": "genuinely rapid when you want to push on",
    "decent performance": "brisk everyday pace",
    "average slow": "relaxed rather than outright quick",
    "very slow": "focused more on economy than speed",
}
FAMILY_OUTRO = "Stands out as easy to live with and broadly appealing."
FIELD_STRENGTH_DEFAULT = "It offers a range of engines with balanced performance and refinement."
FIELD_TRADE_DEFAULT = "Inside, it focuses on comfort and useful tech, with everyday practicality."
FIELD_VERDICT = "Best for buyers who want a sensible mix of usability and value."
SPECS_VARY = "key specs vary"

# Extraction patterns ------------------------------------------

GLANCE = {
    "new_price_min": (r"Price new £([\d,]+) - £([\d,]+)", 1),
    "new_price_max": (r"Price new £([\d,]+) - £([\d,]+)", 2),
    "used_price_min": (r"Used prices £([\d,]+) - £([\d,]+)", 1),
    "used_price_max": (r"Used prices £([\d,]+) - £([\d,]+)", 2),
    "road_tax_min": (r"Road tax cost £([\d,]+) - £([\d,]+)", 1),
    "road_tax_max": (r"Road tax cost £([\d,]+) - £([\d,]+)", 2),
    "insurance_group": (r"Insurance group ([\d-]+)", 1),
    "fuel_economy": (r"Fuel economy ([^R]+) Range ([\d,]+) - ([\d,]+) miles", 1),
    "range_min": (r"Fuel economy ([^R]+) Range ([\d,]+) - ([\d,]+) miles", 2),
    "range_max": (r"Fuel economy ([^R]+) Range ([\d,]+) - ([\d,]+) miles", 3),
    "doors": (r"Number of doors ([\d]+)", 1),
    "fuel_types": (r"Available fuel types ([^V]+)", 1),
}
SECTION_PROS = r"(?is)PROS\s*(.*?)(?:CONS|$)"
SECTION_CONS = r"(?is)CONS\s*(.*?)(?:PROS|$)"
# (what the text must hold for the pattern to have a chance, pattern)
PAGE_PROS = (
    ("pro", r"(?is)pros?[:\s]+(.*?)(?:cons?|verdict|overview|$)"),
    ("advantage", r"(?is)advantages?[:\s]+(.*?)(?:disadvantages?|verdict|overview|$)"),
    ("good point", r"(?is)good points?[:\s]+(.*?)(?:bad points?|verdict|overview|$)"),
    ("strength", r"(?is)strengths?[:\s]+(.*?)(?:weaknesses?|verdict|overview|$)"),
    ("benefit", r"(?is)benefits?[:\s]+(.*?)(?:drawbacks|verdict|overview|$)"),
)
PAGE_CONS = (
    ("con", r"(?is)cons?[:\s]+(.*?)(?:pros?|verdict|overview|$)"),
    ("disadvantage", r"(?is)disadvantages?[:\s]+(.*?)(?:advantages?|verdict|overview|$)"),
    ("bad point", r"(?is)bad points?[:\s]+(.*?)(?:good points?|verdict|overview|$)"),
    ("weakness", r"(?is)weaknesses?[:\s]+(.*?)(?:strengths?|verdict|overview|$)"),
    ("drawback", r"(?is)drawbacks?[:\s]+(.*?)(?:benefits|verdict|overview|$)"),
)
PAGE_MIN_CHARS = 5
PAGE_MAX_CHARS = 1000
AUTHOR_DATE = r"Written by ([^P]+) Published: ([^W]+)"
AUTHOR_ONLY = r"Written by ([^,\n]+)"
OUT_OF_FIVE = r"([A-Za-z\s]+)\s+([\d.]+)\s+out of\s+5"
ANCHOR = r'<a[^>]*href="([^"]*)"[^>]*>([^<]+)</a>'
RIVAL_URL_MARKS = ("rival", "competitor")
RIVAL_RATING = r"([A-Za-z0-9][A-Za-z0-9\-&' ]+)\s*:\s*([\d.]+)/5"
RIVAL_CONTEXT = r"\)?:\s*([^|]+)"
RIVAL_NAME_BEFORE_URL = r"([A-Za-z][A-Za-z0-9\-&' ]{2,})$"
RIVAL_CONTEXT_CHARS = 120
RIVAL_NAME_CHARS = 60
RIVAL_LIMIT = 5
RIVAL_DEFAULT_CONTEXT = "similar size and price"
PROSE_FUELS = ("diesel", "petrol", "hybrid", "plug-in hybrid", "phev", "electric")
PROSE_DRIVES = ("rwd", "fwd", "awd", "4wd")
PROSE_POWER = r"(\d{2,4})\s*(?:bhp|hp)"
PROSE_SPRINT = r"0\s*[–-]\s*62\s*mph[^\d]*(\d{1,2}(?:\.\d)?)s"
PROSE_MPG = r"(\d{2,3})\s*mpg"
POUNDS = r"£\s*([\d,]+)"
PRICE_MARKS = (
    'data-testid="search-listing-price"',
    'data-testid="advert-price"',
    'class="vehicle-price"',
    'class="product-card-pricing__price"',
)

# URLs ---------------------------------------------------------

REVIEW_ENDINGS = ("/review", "/used-review", "/owners-reviews")
YEAR_TAIL = r"(?i)^([a-z0-9-]+)-(?:19|20)\d{2}$"

# Price and spec sanity ----------------------------------------

PRICE_FLOOR = 100
TRIM_FROM = 20
MPG_MAX = 200
INSURANCE_MIN, INSURANCE_MAX = 1, 50
SPRINT_MAX = 30
NO_ANSWER = ("low", "no-parse")
DEFAULT_CONFIDENCE = "medium"

# Vectors ------------------------------------------------------

CELL_LIMIT = 32767
NORM_RANGE = (0.97, 1.03)
MAIN_WEIGHT, RIVALS_WEIGHT = 0.75, 0.25
FIRST_STAGE, SECOND_STAGE = 150, 50
