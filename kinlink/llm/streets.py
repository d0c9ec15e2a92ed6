"""Reading postal addresses typed by people: number, direction, street, type and unit."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from kinlink.functions.values import STAND_INS

# How people write directions, street types and prefixes of names.
DIRECTIONS = {
    "n": "n north no", "s": "s south so", "e": "e east", "w": "w west",
    "ne": "ne northeast", "nw": "nw northwest", "se": "se southeast", "sw": "sw southwest",
}
TYPES = {
    "alley": "alley aly allee", "annex": "annex anx", "arcade": "arcade arc", "avenue": "avenue ave av aven", "bend": "bend bnd", "bluff": "bluff blf", "boulevard": "boulevard blvd boul",
    "branch": "branch br", "bridge": "bridge brg", "bypass": "bypass byp", "causeway": "causeway cswy", "center": "center centre ctr", "circle": "circle cir circ crcl", "commons": "commons cmns",
    "corner": "corner cor", "corners": "corners cors", "course": "course crse", "court": "court ct crt", "cove": "cove cv", "creek": "creek crk", "crescent": "crescent cres",
    "crest": "crest crst", "crossing": "crossing xing crssng", "crossroad": "crossroad xrd", "curve": "curve curv", "drive": "drive dr drv driv", "estates": "estates ests", "expressway": "expressway expy expwy",
    "extension": "extension ext", "freeway": "freeway fwy", "gardens": "gardens gdns", "gateway": "gateway gtwy", "glen": "glen gln", "green": "green grn", "grove": "grove grv", "heights": "heights hts",
    "highway": "highway hwy hiway hway", "hill": "hill hl", "hills": "hills hls", "hollow": "hollow holw", "junction": "junction jct", "knoll": "knoll knl", "landing": "landing lndg", "lane": "lane ln la",
    "loop": "loop", "mall": "mall", "manor": "manor mnr", "meadows": "meadows mdws", "mews": "mews", "motorway": "motorway mtwy", "parkway": "parkway pkwy pky parkwy", "pass": "pass", "path": "path",
    "pike": "pike", "place": "place pl", "plaza": "plaza plz plza", "point": "point", "promenade": "promenade prom", "ridge": "ridge rdg", "road": "road rd", "route": "route rte", "row": "row", "run": "run",
    "square": "square sq sqr", "station": "station sta stn", "street": "street st str strt", "terrace": "terrace ter terr", "trace": "trace trce", "track": "track trak", "trail": "trail trl",
    "turnpike": "turnpike tpke trnpk", "valley": "valley vly", "view": "view vw", "village": "village vlg", "vista": "vista vis", "walk": "walk", "way": "way",
}
PREFIXES = {"mt": "mount", "ft": "fort", "st": "saint", "pt": "port", "lk": "lake"}
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
UNITS = "suite ste unit room rm building bldg apartment apt floor fl"

_DIR = {w: k for k, v in DIRECTIONS.items() for w in v.split()}
_TYPE = {w: k for k, v in TYPES.items() for w in v.split()}
# street types within a name are written out; "st" is Saint there, and these are articles
_INNER = {w: k for w, k in _TYPE.items() if w not in ("st", "la", "pass", "arc", "ext")}
_ORDINAL = {w: f"{i}{'st' if i == 1 else 'nd' if i == 2 else 'rd' if i == 3 else 'th'}" for i, w in enumerate(ORDINALS, 1)}
_UNIT = re.compile(rf"\b(?:{'|'.join(UNITS.split())})\b\.?\s*(?:no\.?\s*|#\s*)?([a-z]\b|\d+[a-z]?\b)")
_HASH = re.compile(r"#\s*([a-z]\b|\d+[a-z]?\b)")
_BOX = re.compile(r"\b(?:p\s*\.?\s*o\s*\.?\s*|post\s+office\s+)?box\s*(?:no\.?\s*|#\s*)?\d+\b")
_CARE = re.compile(r"^\s*(?:attn\b\.?:?|attention\b:?|c\s*/\s*o\b)")
_DESK = re.compile(r"^.*?\b(?:office|registrar|admissions|principal|department|dept)\b\.?")
_DOTTED = re.compile(r"\b([nsew])\.\s?([nsew])\b\.?")
# a house number: with a letter, of a range or a half
_HOUSE = r"\d+[a-z]?(?:-\d+[a-z]?|½)?"
_NUMBER = re.compile(_HOUSE)
_HALF = re.compile(r"\b(\d+)[ -]1/2\b")
# most addresses are a number and plain words, none of which needs a closer look
_PLAIN = re.compile(r"\s*(\d+),?\s+((?:(?:[a-z]+|\d+(?:st|nd|rd|th)) )*[a-z]+)\.?\s*")
_NOT_PLAIN = frozenset(f"{UNITS} box po post attn attention care no".split())


_NUMBERED = frozenset(w for w, k in _TYPE.items() if k in ("highway", "route"))
_LETTER = re.compile("[a-z]")
_NO_NAME = frozenset("na none null tbd unknown xxx notonfile notavailable blank box".split())


class Address(NamedTuple):
    number: str  # empty where none is stated
    direction: str
    name: str  # letters and digits of the street's name, prefixes written out
    kind: str  # street type, empty where none is stated
    unit: str


def words_of(s: str) -> list[str]:
    """Words, numbers (ranges and halves are one) and # of an address in lower case."""
    s = _HALF.sub(r"\1½", s.replace("'", ""))
    return re.findall(rf"[a-z]+|\d+(?:st|nd|rd|th)\b|{_HOUSE}(?![a-z])|\d+|#", s)


@lru_cache(maxsize=50_000)
def place_key(s: str | None) -> str:
    """A place's name with directions and prefixes written out, as letters only."""
    if not s:
        return ""
    long = {"n": "north", "s": "south", "e": "east", "w": "west", "no": "north", "so": "south"} | PREFIXES
    w = re.findall(r"[a-z]+", _DOTTED.sub(r"\1\2", s.lower()).replace("'", ""))
    return "".join(long.get(x, x) if k == 0 and len(w) > 1 else x for k, x in enumerate(w))


def read_address(street: str | None, place: str | None = None) -> Address | None:
    """The parts of an address line; None if it states no street address.

    Addressees, post-office boxes and the town's name beside the street are left out. A unit is
    kept apart. The number may follow the street.
    """
    if not street or street.strip().lower() in STAND_INS:
        return None
    s = street.lower()
    if m := _PLAIN.fullmatch(s):
        w = m.group(2).split()
        if _NOT_PLAIN.isdisjoint(w):
            return _street(m.group(1), w, "")
    s = _DOTTED.sub(r"\1\2 ", s.replace('"', " "))
    s = _BOX.sub(" ", s)
    unit = ""
    for m in _UNIT.finditer(s):
        unit = m.group(1)
    s = _UNIT.sub(" ", s)
    if m := _HASH.search(s):
        # "#4" is a unit beside another number, else the house number
        if not m.group(1)[0].isdigit() or re.search(r"\d", _HASH.sub(" ", s)):
            unit, s = unit or m.group(1), _HASH.sub(" ", s)
    parts = [p.strip(" .;") for p in re.split(r"[,;]", s)]
    parts = [p for p in parts if p]
    if parts and _CARE.match(parts[0]):
        first = _CARE.sub("", parts[0])
        # an addressee ends with the comma, behind the name of a desk or where the number begins
        behind, desks = _DESK.subn("", first)
        m = re.search(r"\d", behind)
        parts = ([behind if desks else behind[m.start() :]] if m else []) + parts[1:]
    if len(parts) > 1 and not any(c.isdigit() for c in parts[-1]) and (place_key(parts[-1]) == place_key(place) or (any(c.isdigit() for c in " ".join(parts[:-1])) and not all(w in _DIR or w in _TYPE for w in words_of(parts[-1])) and len(" ".join(parts[:-1]).split()) > 1)):
        parts = parts[:-1]
    s = " ".join(parts)
    number = ""
    w = words_of(s)
    if not w:
        return None
    # number before the street, or after it behind "no" or "#"
    if _NUMBER.fullmatch(w[0]) and len(w) > 1:
        number, w = w[0], w[1:]
        if "#" in w:
            at = w.index("#")
            unit = unit or "".join(w[at + 1 : at + 2])
            w = w[:at] + w[at + 2 :]
    else:
        if len(w) > 2 and w[-2] in ("no", "#") and _NUMBER.fullmatch(w[-1]):
            number, w = w[-1], w[:-2]
        elif len(w) > 1 and _NUMBER.fullmatch(w[-1]) and _TYPE.get(w[-2]) not in ("highway", "route"):
            number, w = w[-1], w[:-1]
        elif len(w) > 1 and w[-1] in _DIR and re.fullmatch(r"\d+", w[-2]) and not (len(w) > 2 and _TYPE.get(w[-3]) in ("highway", "route")):
            number, w = w[-2], w[:-2] + w[-1:]
    w = [x for x in w if x != "#"]
    if not w:
        return None
    return _street(number, w, unit)


def _street(number: str, w: list[str], unit: str) -> Address | None:
    # highways and routes: "state hwy 16", "highway 16", "16 state highway"
    if not _NUMBERED.isdisjoint(w):
        numbered = next(_TYPE[x] for x in w if x in _NUMBERED)
        digits = [x for x in w if re.fullmatch(r"\d+[a-z]?", x)]
        if digits:
            dirs = [_DIR[x] for x in w if x in _DIR]
            return Address(number.lstrip("0"), dirs[0] if dirs else "", digits[0], numbered, unit)
    direction, kind = "", ""
    if len(w) > 1 and w[-1] in _DIR and not (w[-1] in ("no", "so") and len(w) < 3):
        direction, w = _DIR[w[-1]], w[:-1]
    if len(w) > 1 and w[0] in _DIR:
        direction, w = direction or _DIR[w[0]], w[1:]
    if len(w) > 1 and w[-1] in _TYPE:
        kind, w = _TYPE[w[-1]], w[:-1]
    if not direction and len(w) > 1 and w[-1] in _DIR:
        direction, w = _DIR[w[-1]], w[:-1]
    name = "".join(_ORDINAL.get(x) or (PREFIXES.get(x, x) if k == 0 and len(w) > 1 else _INNER.get(x, x) if k else x) for k, x in enumerate(w))
    if name.isdigit() or not _LETTER.search(name) or name in _NO_NAME:
        return None
    return Address(number.lstrip("0"), direction, name, kind, unit)


@lru_cache(maxsize=100_000)
def address_fields(street: str | None, city: str | None) -> tuple[str | None, ...]:
    """(town, number, direction, street, kind, unit); all but the town null where no number is stated.

    Registries repeat addresses from edition to edition, so a worker keeps the latest it has read.
    """
    a = read_address(street, city)
    return (place_key(city), *(a if a and a.number else (None,) * 5))
