"""Places: splitting, states, hubs, strict city matching, pollution."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from postgrove.contract import NOT_SPECIFIED, QUALITY_MISSING, missing, trimmed
from postgrove.functions.text import clean, metadata_cut

#: State codes.
STATES = {
    "KA": "Karnataka", "TS": "Telangana", "TG": "Telangana", "TN": "Tamil Nadu", "MH": "Maharashtra", "DL": "Delhi NCR", "UP": "Uttar Pradesh",
    "HR": "Haryana", "WB": "West Bengal", "GJ": "Gujarat", "AP": "Andhra Pradesh", "KL": "Kerala", "MP": "Madhya Pradesh", "RJ": "Rajasthan",
    "PB": "Punjab", "OR": "Odisha", "OD": "Odisha", "CH": "Chandigarh", "AS": "Assam", "IN": "India",
}
#: States and territories recognised by name.
STATE_NAMES = [
    "Andhra Pradesh", "Arunachal Pradesh", "Assam", "Bihar", "Chhattisgarh", "Goa", "Gujarat", "Haryana", "Himachal Pradesh", "Jharkhand", "Karnataka", "Kerala",
    "Madhya Pradesh", "Maharashtra", "Manipur", "Meghalaya", "Mizoram", "Nagaland", "Odisha", "Punjab", "Rajasthan", "Sikkim", "Tamil Nadu", "Telangana", "Tripura",
    "Uttar Pradesh", "Uttarakhand", "West Bengal", "Delhi", "Jammu and Kashmir", "Ladakh", "Puducherry", "Chandigarh", "Andaman and Nicobar Islands",
    "Dadra and Nagar Haveli and Daman and Diu", "Lakshadweep",
]
#: State codes of the normalizer; those of the dashboard's hubs (``STATES``) differ.
STATE_CODES = {
    "KA": "Karnataka", "TN": "Tamil Nadu", "MH": "Maharashtra", "DL": "Delhi", "TG": "Telangana", "TS": "Telangana", "HR": "Haryana", "UP": "Uttar Pradesh", "WB": "West Bengal",
    "GJ": "Gujarat", "KL": "Kerala", "AP": "Andhra Pradesh", "MP": "Madhya Pradesh", "RJ": "Rajasthan", "PB": "Punjab", "OR": "Odisha", "OD": "Odisha", "CH": "Chandigarh",
    "JH": "Jharkhand", "UT": "Uttarakhand", "UK": "Uttarakhand", "AS": "Assam", "BR": "Bihar", "GA": "Goa", "HP": "Himachal Pradesh", "JK": "Jammu and Kashmir", "PY": "Puducherry",
    "TR": "Tripura", "ML": "Meghalaya", "MN": "Manipur", "NL": "Nagaland", "MZ": "Mizoram", "AR": "Arunachal Pradesh", "SK": "Sikkim", "CG": "Chhattisgarh",
}
#: The map's states by id; two more ids in use follow.
MAP_STATES = {
    "an": "Andaman and Nicobar Islands", "ap": "Andhra Pradesh", "ar": "Arunachal Pradesh", "as": "Assam", "br": "Bihar", "ch": "Chandigarh", "ct": "Chhattisgarh", "dn": "Dadra and Nagar Haveli",
    "dd": "Daman and Diu", "dl": "Delhi", "ga": "Goa", "gj": "Gujarat", "hr": "Haryana", "hp": "Himachal Pradesh", "jk": "Jammu and Kashmir", "jh": "Jharkhand", "ka": "Karnataka", "kl": "Kerala",
    "ld": "Lakshadweep", "mp": "Madhya Pradesh", "mh": "Maharashtra", "mn": "Manipur", "ml": "Meghalaya", "mz": "Mizoram", "nl": "Nagaland", "or": "Odisha", "py": "Puducherry", "pb": "Punjab",
    "rj": "Rajasthan", "sk": "Sikkim", "tn": "Tamil Nadu", "tg": "Telangana", "tr": "Tripura", "up": "Uttar Pradesh", "ut": "Uttarakhand", "wb": "West Bengal",
    "od": "Odisha", "ts": "Telangana",
}
#: Metro hubs and the label of each, in order.
METROS = [
    ("bengaluru|bangalore", "Bengaluru, Karnataka"), ("hyderabad", "Hyderabad, Telangana"), ("pune", "Pune, Maharashtra"), ("mumbai", "Mumbai, Maharashtra"),
    ("chennai", "Chennai, Tamil Nadu"), ("noida", "Noida, Delhi NCR"), ("gurugram|gurgaon", "Gurugram, Delhi NCR"), ("delhi", "Delhi NCR"), ("kolkata", "Kolkata, West Bengal"),
]
#: The hubs and the names each goes by, for the strict city filter.
HUBS = {
    "bengaluru": ["bengaluru", "bangalore"], "chennai": ["chennai"], "hyderabad": ["hyderabad"], "pune": ["pune", "pimpri"], "mumbai": ["mumbai", "navi mumbai", "thane"],
    "delhi": ["delhi", "noida", "gurugram", "gurgaon", "new delhi", "delhi ncr", "ghaziabad", "greater noida"], "kolkata": ["kolkata", "calcutta"], "coimbatore": ["coimbatore"],
    "ahmedabad": ["ahmedabad", "gandhinagar"], "kochi": ["kochi", "cochin", "ernakulam"], "thiruvananthapuram": ["thiruvananthapuram", "trivandrum"], "jaipur": ["jaipur"],
    "chandigarh": ["chandigarh", "mohali", "panchkula"], "indore": ["indore"], "bhopal": ["bhopal"], "lucknow": ["lucknow"], "nagpur": ["nagpur"], "surat": ["surat"],
    "vadodara": ["vadodara", "baroda"], "rajkot": ["rajkot"], "visakhapatnam": ["visakhapatnam", "vizag"], "bhubaneswar": ["bhubaneswar"], "patna": ["patna"],
    "dehradun": ["dehradun"], "madurai": ["madurai"], "mysuru": ["mysuru", "mysore"], "mangaluru": ["mangaluru", "mangalore"], "salem": ["salem"], "tiruppur": ["tiruppur"],
    "tiruchirappalli": ["tiruchirappalli", "trichy"], "warangal": ["warangal"], "guwahati": ["guwahati"], "goa": ["goa", "panaji"], "gwalior": ["gwalior"], "kanpur": ["kanpur"],
    "prayagraj": ["prayagraj", "allahabad"], "varanasi": ["varanasi"], "agra": ["agra"], "nashik": ["nashik"], "aurangabad": ["aurangabad", "chhatrapati sambhajinagar"],
    "udaipur": ["udaipur"], "hubballi": ["hubballi", "hubli", "dharwad"], "belagavi": ["belagavi", "belgaum"], "itanagar": ["itanagar"], "jharsuguda": ["jharsuguda"],
    "ramban": ["ramban"], "hosur": ["hosur"], "tumakuru": ["tumakuru"], "kozhikode": ["kozhikode", "calicut"], "vijayawada": ["vijayawada"], "ranchi": ["ranchi", "jamshedpur"],
}
#: Places abroad that make a location mixed.
ABROAD = ["dubai", "kuwait", "united arab emirates", "uae", "canada", "singapore", "omaha", "usa", "australia"]
#: The state of a city where only the city is given.
CITY_STATE = {
    "Ahmedabad": "Gujarat", "Bengaluru": "Karnataka", "Bangalore": "Karnataka", "Bhubaneswar": "Odisha", "Chennai": "Tamil Nadu", "Coimbatore": "Tamil Nadu", "Delhi": "Delhi",
    "Faridabad": "Haryana", "Gurgaon": "Haryana", "Gurugram": "Haryana", "Hyderabad": "Telangana", "Jaipur": "Rajasthan", "Kolkata": "West Bengal", "Lucknow": "Uttar Pradesh",
    "Mumbai": "Maharashtra", "Noida": "Uttar Pradesh", "Pune": "Maharashtra", "Ranchi": "Jharkhand", "Visakhapatnam": "Andhra Pradesh",
}
_NAMES = "|".join(re.escape(n) for n in sorted(STATE_NAMES, key=len, reverse=True))


def _lookup(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def known_state(c: Column) -> Column:
    """The state a text names exactly, by code or name in any case; else null."""
    v = F.upper(clean(c))
    return F.coalesce(_lookup(v, STATE_CODES), _lookup(v, {n.upper(): n for n in STATE_NAMES}))


def map_state(c: Column) -> Column:
    """The map's state of which a text is the id or the name, in any case; else null."""
    return _lookup(F.lower(trimmed(c)), MAP_STATES | {n.lower(): n for n in MAP_STATES.values()})


def india_suffix(c: Column) -> Column:
    """``…, TelanganaIndia`` -> ``…, Telangana, India``."""
    return F.regexp_replace(c, rf"(?i)\b({_NAMES})\s*,?\s*India\s*$", "$1, India")


def split_location(c: Column) -> Column:
    """struct(city, state, country): a closing India, a closing state, the rest is the city.

    A city alone gives its state where that is known; a city or a state makes the country India, foreign cities too.
    """
    parts = F.filter(F.transform(F.split(india_suffix(metadata_cut(c)), ","), clean), lambda x: (x != "") & (F.lower(x) != "not specified"))

    def cut(ps: Column) -> Column:
        n = F.size(ps)
        india = F.lower(F.try_element_at(ps, F.lit(-1))) == "india"
        rest = F.when(india, F.slice(ps, 1, n - 1)).otherwise(ps)
        return F.struct(F.coalesce(india, F.lit(False)).alias("india"), rest.alias("rest"))

    def name(x: Column) -> Column:
        rest = x["rest"]
        state = known_state(F.try_element_at(rest, F.lit(-1)))
        city = F.array_join(F.when(state.isNotNull(), F.slice(rest, 1, F.size(rest) - 1)).otherwise(rest), ", ")
        city = F.nullif(city, F.lit(""))
        state = F.coalesce(state, _lookup(F.lower(city), {c.lower(): s for c, s in CITY_STATE.items()}))
        country = F.when(x["india"] | city.isNotNull() | state.isNotNull(), F.lit("India"))
        return F.struct(F.coalesce(city, F.lit(NOT_SPECIFIED)).alias("city"), F.coalesce(state, F.lit(NOT_SPECIFIED)).alias("state"), F.coalesce(country, F.lit(NOT_SPECIFIED)).alias("country"))

    return F.transform(F.transform(F.array(parts), cut), name)[0]


def repair_fields(city: Column, state: Column, country: Column) -> Column:
    """struct(city, state, country) from three fields of which any may hold the others' text."""
    held = lambda x: F.when(F.lower(F.coalesce(clean(x), F.lit(""))).isin("", "not specified"), F.lit(None)).otherwise(clean(x))
    return split_location(F.concat_ws(", ", F.array_distinct(F.array_compact(F.array(held(city), held(state), F.when(F.lower(held(country)) == "india", None).otherwise(held(country)))))))


def indian_hub(city: Column, state: Column) -> Column:
    """The hub label of a place; ordered rules, the last resort is the country."""
    c, s = F.trim(F.coalesce(city, F.lit(""))), F.trim(F.coalesce(state, F.lit("")))
    token = F.when(F.upper(c).endswith(", IN"), F.trim(F.substr(c, F.lit(1), F.length(c) - 4))).when(
        F.upper(c).endswith(", INDIA"), F.trim(F.substr(c, F.lit(1), F.length(c) - 7))).otherwise(c)
    out = F.when(F.lower(c).contains("remote") | F.lower(s).contains("remote"), "Remote")
    for pattern, label in METROS:
        out = out.when(F.lower(c).rlike(pattern), label)
    by_code = _lookup(F.upper(token), STATES)
    full = F.coalesce(_lookup(F.upper(s), STATES), s)
    second = F.when((full != "") & (full != NOT_SPECIFIED) & (full != "India") & (full != token), full)
    first = F.when((token != "") & (token != NOT_SPECIFIED), token)
    joined = F.concat_ws(", ", first, second)
    return (
        out.when(F.upper(token).isin("CT", "CT, INDIA"), "Pan-India (Flexible)")
        .when(by_code == "India", "India (Not Specified)").when(by_code.isNotNull(), by_code)
        .when(joined != "", joined).otherwise("India (Not Specified)")
    )


def strict_city(city: Column, target: str, normalized: Column | None = None) -> Column:
    """The target is named, no other hub is, and no place abroad: two alternations."""
    if not target or target == "All India":
        return F.lit(True)
    t = target.lower()
    blob = F.lower(F.concat_ws(" ", F.coalesce(city, F.lit("")), F.coalesce(normalized, F.lit("")) if normalized is not None else F.lit("")))
    mine = "|".join(map(re.escape, HUBS.get(t, [t])))
    others = "|".join(re.escape(x) for hub, names in HUBS.items() if hub != t for x in names)
    abroad = "|".join(re.escape(x) for x in ABROAD if x != t)
    return blob.rlike(mine) & ~blob.rlike(f"{others}|{abroad}")


#: What scrapers leave in a place field.
PLACE_GARBAGE = [
    r"\b\d+\s+(?:minute|minutes|hour|hours|day|days|week|weeks|month|months)\s+ago\b", r"\b\d+\s+applicants?\b", r"\bbe\s+among\s+the\s+first\b", r"\bpromoted\b", r"\beasy\s+apply\b",
    r"\bactively\s+recruiting\b", r"\bpeople\s+clicked\s+apply\b",
]
#: States that are found glued to the country.
GLUED_STATES = ["telangana", "karnataka", r"tamil\s*nadu", "kerala", "maharashtra", "gujarat", "haryana", "delhi", r"west\s*bengal", "rajasthan", r"uttar\s*pradesh", r"madhya\s*pradesh"]
#: Companies that are found glued to a city.
GLUED_COMPANIES = ["StateStreet", "AmericanExpress", "GLOBELANCE", "Crunchyroll", "Capco", "TriNetTriNet", "Andaz"]
#: Pieces of patterns in a degree.
EDUCATION_GARBAGE = [r"\\\.", r"\(\?:", r"\?:", r"\(\?=", r"\(\?!", r"\[\^"]
_PLACE_GARBAGE = "(?i)" + "|".join([*PLACE_GARBAGE, f"(?:{'|'.join(GLUED_STATES)})india$"])


def _found(c: Column, pattern: str) -> Column:
    """The cleaned text is known and holds the pattern; never null."""
    return F.when(missing(clean(c), QUALITY_MISSING), False).otherwise(clean(c).rlike(pattern))


def polluted_city(c: Column) -> Column:
    return _found(c, f"{_PLACE_GARBAGE}|^(?:{'|'.join(GLUED_COMPANIES)})\\s+")


def polluted_state(c: Column) -> Column:
    return _found(c, _PLACE_GARBAGE)


def polluted_country(c: Column) -> Column:
    """Garbage, or more than the country beside its name."""
    return _found(c, _PLACE_GARBAGE) | (_found(c, "(?i)india") & (F.lower(clean(c)) != "india"))


def polluted_education(c: Column) -> Column:
    return _found(c, "|".join(EDUCATION_GARBAGE))
