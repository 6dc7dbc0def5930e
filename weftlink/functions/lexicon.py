"""Word lists of the normalizer.

All tables here are fixed values that results depend on, in their natural order.
"""

from __future__ import annotations

# Legal form of a company, by variant.
LEGAL_FORMS = {
    "private": "pvt", "pvt": "pvt", "limited": "ltd", "ltd": "ltd", "corporation": "corp", "corp": "corp", "incorporated": "inc",
    "inc": "inc", "company": "co", "co": "co", "llc": "llc", "llp": "llp", "pllc": "pllc", "pc": "pc", "plc": "plc", "lp": "lp",
    "sarl": "sarl", "sas": "sas", "sasu": "sasu", "eurl": "eurl", "sa": "sa", "snc": "snc",
}
LEGAL_CODES = sorted(set(LEGAL_FORMS.values()))

# Words that are dropped from names, and the characters stripped from their ends.
HONORIFICS = ["the", "dr", "shri", "sri", "smt", "messrs"]
JUNK = "-<>#*~_=+| "

# Company words and states in Indian scripts.
NATIVE_LEGAL = {
    "प्राइवेट": "private", "प्रा": "pvt", "लिमिटेड": "limited", "लि": "ltd", "एलएलपी": "llp", "एलएलसी": "llc", "कंपनी": "company",
    "कं": "co", "প্রাইভেট": "private", "লিমিটেড": "limited", "লিমি": "ltd", "এলএলপি": "llp", "কোম্পানি": "company",
    "ಪ್ರೈವೇಟ್": "private", "ಲಿಮಿಟೆಡ್": "limited", "பிரைவேட்": "private", "லிமிடெட்": "limited", "ప్రైవేట్": "private",
    "లిమిటెడ్": "limited", "પ્રાઇવેટ": "private", "લિમિટેડ": "limited", "ਪ੍ਰਾਈਵੇਟ": "private", "ਲਿਮਟਿਡ": "limited",
}
NATIVE_STATES = {
    "राजस्थान": "RJ", "महाराष्ट्र": "MH", "गुजरात": "GJ", "दिल्ली": "DL", "उत्तर प्रदेश": "UP", "पश्चिम बंगाल": "WB", "কর্ণাটক": "KA",
    "ಕರ್ನಾಟಕ": "KA", "தமிழ்நாடு": "TN", "తెలంగాణ": "TG", "కేరళ": "KL", "কেরালা": "KL", "পাঞ্জাব": "PB", "ਪੰਜਾਬ": "PB", "হরিয়ানা": "HR",
    "मध्य प्रदेश": "MP", "बिहार": "BR", "ओडिशा": "OR", "ওড়িশা": "OR", "पंजाब": "PB", "हरियाणा": "HR", "केरल": "KL", "कर्नाटक": "KA",
    "आंध्र प्रदेश": "AP",
}

# States and regions by name; the first that is found counts.
INDIA_STATES = {
    "rajasthan": "RJ", "maharashtra": "MH", "gujarat": "GJ", "delhi": "DL", "new delhi": "DL", "uttar pradesh": "UP",
    "west bengal": "WB", "karnataka": "KA", "tamil nadu": "TN", "telangana": "TG", "kerala": "KL", "punjab": "PB", "haryana": "HR",
    "madhya pradesh": "MP", "bihar": "BR", "odisha": "OR", "orissa": "OR", "andhra pradesh": "AP", "assam": "AS", "jharkhand": "JH",
    "chhattisgarh": "CG", "uttarakhand": "UK", "himachal pradesh": "HP", "goa": "GA", "tripura": "TR", "manipur": "MN",
    "meghalaya": "ML", "nagaland": "NL", "sikkim": "SK", "mizoram": "MZ", "arunachal pradesh": "AR", "jammu and kashmir": "JK",
    "ladakh": "LA", "chandigarh": "CH", "puducherry": "PY",
}
US_STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT",
    "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH",
    "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD",
    "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY",
}
FRANCE_REGIONS = {
    "ile-de-france": "IDF", "ile de france": "IDF", "nouvelle-aquitaine": "NAQ", "nouvelle aquitaine": "NAQ",
    "auvergne-rhone-alpes": "ARA", "occitanie": "OCC", "hauts-de-france": "HDF", "hauts de france": "HDF", "grand est": "GES",
    "pays de la loire": "PDL", "bretagne": "BRE", "normandie": "NOR", "bourgogne-franche-comte": "BFC", "centre-val de loire": "CVL",
    "provence-alpes-cote d'azur": "PAC", "corse": "COR",
}

# Older names of cities.
CITIES = {
    "bombay": "mumbai", "calcutta": "kolkata", "madras": "chennai", "bangalore": "bengaluru", "poona": "pune", "baroda": "vadodara",
    "cawnpore": "kanpur", "trivandrum": "thiruvananthapuram", "mysore": "mysuru", "gurgaon": "gurugram", "allahabad": "prayagraj",
}

# Short forms of address words by country.
ADDRESS_WORDS = {
    "US": {
        "road": "rd", "rd": "rd", "street": "st", "st": "st", "saint": "st", "avenue": "ave", "ave": "ave", "av": "ave",
        "boulevard": "blvd", "blvd": "blvd", "lane": "ln", "ln": "ln", "drive": "dr", "dr": "dr", "court": "ct", "ct": "ct",
        "highway": "hwy", "hwy": "hwy", "parkway": "pkwy", "pkwy": "pkwy", "place": "pl", "pl": "pl", "trail": "trl", "trl": "trl",
        "circle": "cir", "cir": "cir", "terrace": "ter", "ter": "ter", "square": "sq", "sq": "sq", "way": "way", "north": "n",
        "south": "s", "east": "e", "west": "w", "apartment": "apt", "apt": "apt", "unit": "unit", "suite": "ste", "ste": "ste",
        "floor": "fl", "fl": "fl", "building": "bldg", "bldg": "bldg", "number": "no", "no": "no",
    },
    "India": {
        "nagar": "nagar", "marg": "marg", "road": "rd", "rd": "rd", "bypass": "byp", "bye": "byp", "pass": "byp", "opposite": "opp",
        "opp": "opp", "near": "nr", "nr": "nr", "building": "bldg", "bldg": "bldg", "floor": "fl", "fl": "fl", "flr": "fl",
        "ground": "grd", "grd": "grd", "cross": "crs", "crs": "crs", "sector": "sec", "sec": "sec", "phase": "ph", "ph": "ph",
        "colony": "col", "col": "col", "taluka": "tal", "tal": "tal", "tehsil": "tal", "district": "dist", "dist": "dist",
        "village": "vil", "vil": "vil", "block": "blk", "blk": "blk", "apartment": "apt", "apartments": "apt", "apt": "apt",
        "society": "soc", "soc": "soc",
    },
    "France": {
        "avenue": "av", "av": "av", "boulevard": "bd", "boul": "bd", "bd": "bd", "chemin": "chem", "chem": "chem", "impasse": "imp",
        "imp": "imp", "place": "pl", "pl": "pl", "route": "rte", "rte": "rte", "allee": "all", "all": "all", "faubourg": "fbg",
        "fbg": "fbg", "rue": "rue", "saint": "st", "sainte": "ste", "st": "st", "ste": "ste",
    },
}

# Ordinals, empty markers, and words that begin a landmark.
ORDINALS = {
    "first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th", "sixth": "6th", "seventh": "7th", "eighth": "8th",
    "ninth": "9th", "tenth": "10th", "eleventh": "11th", "twelfth": "12th",
}
EMPTY_WORDS = ["null", "none", "nan", "na"]
LANDMARK_WORDS = ["near", "nr", "opp", "opposite", "behind", "beside", "next to", "adjacent to", "in front of", "close to"]
