"""Fixed values of the name and address vocabulary."""

from __future__ import annotations

# --- fixed values: legal forms, canonical code -> written forms --------------------------
LEGAL_FORMS = {
    "inc": ["inc", "inc.", "incorporated", "incorp"],
    "llc": ["llc", "l.l.c", "l.l.c.", "lc"],
    "corp": ["corp", "corp.", "corporation", "corpn"],
    "ltd": ["ltd", "ltd.", "limited", "limitee", "limiteda", "ltda"],
    "pvt": ["pvt", "pvt.", "private", "pravate", "pvtltd"],
    "llp": ["llp", "l.l.p", "elelpi", "elelpii"],
    "lp": ["lp", "l.p"],
    "plc": ["plc", "p.l.c"],
    "pc": ["pc", "p.c"],
    "pllc": ["pllc"],
    "pa": ["pa", "p.a"],
    "co": ["co", "co.", "company", "kompany"],
    "opc": ["opc"],
    "huf": ["huf"],
    "gmbh": ["gmbh"],
    "sarl": ["sarl", "s.a.r.l", "sarlu"],
    "sas": ["sas", "s.a.s", "sasu"],
    "sa": ["sa", "s.a"],
    "sci": ["sci", "s.c.i"],
    "eurl": ["eurl"],
    "snc": ["snc"],
    "scop": ["scop"],
    "scm": ["scm"],
    "selarl": ["selarl"],
    "trust": ["trust"],
    "assn": ["assn", "association"],
}
# --- fixed values: legal codes that may stand for each other -----------------------------
LEGAL_EQUAL = {"pvt": "ltd", "corp": "inc", "pllc": "llc", "lp": "llp"}
# --- fixed values: a skeleton counts for words this long with skeletons this long --------
LEGAL_WORD_MIN, LEGAL_SKELETON_MIN = 5, 3

# --- fixed values: street words, canonical form -> written forms; "" drops the word ------
STREET_FORMS = {
    "st": ["street", "st", "str", "saint"],
    "rd": ["road", "rd", "marg"],
    "ave": ["avenue", "ave", "av"],
    "dr": ["drive", "dr"],
    "ln": ["lane", "ln", "galli"],
    "blvd": ["boulevard", "blvd", "boulvard", "bd"],
    "ct": ["court", "ct"],
    "pl": ["place", "pl"],
    "cir": ["circle", "cir"],
    "hwy": ["highway", "hwy"],
    "pkwy": ["parkway", "pkwy"],
    "ter": ["terrace", "ter"],
    "trl": ["trail", "trl"],
    "sq": ["square", "sq"],
    "ste": ["suite", "ste"],
    "fl": ["floor", "flr", "fl"],
    "apt": ["apartment", "apartments", "apt"],
    "bldg": ["building", "bldg"],
    "blk": ["block", "blk"],
    "ph": ["phase"],
    "sec": ["sector", "sec"],
    "nagar": ["nagar"],
    "colony": ["colony"],
    "rue": ["rue", "r"],
    "chemin": ["chemin"],
    "allee": ["allee"],
    "impasse": ["impasse"],
    "quai": ["quai"],
    "cours": ["cours"],
    "hno": ["house", "hno", "hn", "h"],
    "no": ["number", "no", "num", "nos"],
    "": ["near", "opp", "opposite", "behind", "beside", "next", "above", "below", "landmark"],
}
# --- fixed values: number words, each at the place of its value ---------------------------
CARDINALS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
ORDINALS = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
TENS = {20: ["twenty", "twentieth"], 30: ["thirty", "thirtieth"], 40: ["forty", "fourty", "fortieth"], 50: ["fifty", "fiftieth"], 60: ["sixty", "sixtieth"], 70: ["seventy", "seventieth"], 80: ["eighty", "eightieth"], 90: ["ninety", "ninetieth"]}
ROMAN = "i ii iii iv v vi vii viii ix x xi xii".split()
# --- fixed values: words that mean "no address" ------------------------------------------
NO_ADDRESS = ["<null>", "null", "n/a", "na", "none", "-", "--", "nil", ""]
# --- fixed values: patterns (the same text works in Java and RE2) -------------------------
EDGE_CLASS = r"[\s\-\.#<>\*\|\+~\^_/\\,;:!\?\"'\[\]\(\)\{\}]+"
LEADING_NOISE = r"^(?:m/s\.?|messrs\.?|the)\s+"
TRADE_NAME = r"\b(?:dba|d/b/a|d\.b\.a\.?|doing\s+business\s+as|trading\s+as|t/a)\b"
DOMAIN = r"^(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:com|net|org|biz|info|io|co|in|co\.in|fr|us|uk|shop|online|store)$"
ORDINAL_DIGITS = r"^([0-9]+)(?:st|nd|rd|th)$"
SPLIT_POSTAL = r"([0-9]{3})[\s\-]([0-9]{3})\b"


def legal_words() -> dict[str, str]:
    """Written form, with and without dots -> code, later forms first."""
    found: dict[str, str] = {}
    for code, forms in LEGAL_FORMS.items():
        for form in forms:
            found[form] = found[form.replace(".", "")] = code
    return found


def skeleton(text: str) -> str:
    """Consonants and digits, runs of one character as one."""
    kept = [c for c in text.lower().replace("ph", "f") if c.isalnum() and c not in "aeiou"]
    return "".join(c for i, c in enumerate(kept) if i == 0 or c != kept[i - 1])


def legal_skeletons() -> dict[str, str]:
    """Skeleton of a long written form -> code, earlier forms first."""
    found: dict[str, str] = {}
    for code, forms in LEGAL_FORMS.items():
        for form in forms:
            key = skeleton(form)
            if len(form) >= LEGAL_WORD_MIN and len(key) >= LEGAL_SKELETON_MIN:
                found.setdefault(key, code)
    return found


def address_words() -> dict[str, str]:
    """Word -> canonical word; numbers before streets before Roman numerals."""
    found = {w: str(i + 1) for i, w in enumerate(ROMAN)}
    found |= {w: canon for canon, forms in STREET_FORMS.items() for w in forms}
    found |= {w: str(i) for words in (CARDINALS, ORDINALS) for i, w in enumerate(words)}
    found |= {w: str(n) for n, words in TENS.items() for w in words}
    return found


def latin_letters() -> tuple[str, str]:
    """Letters of U+00C0..U+024F whose decomposition starts with an ASCII letter, and that letter."""
    import unicodedata

    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha()]
    pairs += [("ø", "o"), ("Ø", "O"), ("đ", "d"), ("Đ", "D"), ("ł", "l"), ("Ł", "L"), ("ħ", "h"), ("Ħ", "H"), ("ı", "i"), ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"), ("¿", "?"), ("¡", "!"), (" ", " ")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


#: Letters that become two.
DOUBLE_LETTERS = [("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("þ", "th"), ("Þ", "Th"), ("…", "...")]
