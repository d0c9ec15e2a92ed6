"""The rewriting rules of names, one list for each registry."""

from __future__ import annotations

from kinlink.functions.regex import Rule

# Order and patterns decide which names become equal, so they are stated as they are.
CEEB_SCHOOL_NAME = [
    "lower",
    Rule(r"\.|'|\:|,", r"", every=True),
    "tighten",
    Rule(r"-|\\|\/", r" ", every=True),
    Rule(r" \(the\) ", r" "),
    Rule(r"\(|\)", r"", every=True),
    Rule(r"\bsaint\b", r"st"),
    Rule(r" the$|^the ", r""),
    Rule(r" and ", r" & ", every=True),
    Rule(r" (\w) & (\w) ", r" \1&\2 "),
    Rule(r"@", r" at "),
    Rule(r" (no|#|number)\s?(\d+)", r" \2"),
    Rule(r"pcss", r"pioneer charter school of science"),
    Rule(r"pcs", r" public charter school "),
    Rule(r" pc(\s|$)", r" public charter "),
    Rule(r" ps(\s|$)", r" public school "),
    Rule(r" cs$", r" charter school"),
    Rule(r"chtr", r"charter"),
    Rule(r" ecse$", r" early childhood education center"),
    Rule(r" ed(\s|$)", r" education"),
    Rule(r"ms shs", r"middle senior high school"),
    Rule(r"el$|elementary$| e school", r" elementary school"),
    Rule(r" acad$", r" academy"),
    Rule(r"middle$", r"middle school"),
    Rule(r" hs$", r" high school"),
    Rule(r" jh$| jhs$", r" junior high school"),
    Rule(r" shs$", r" senior high school"),
    Rule(r"jshs", r"junior senior high school"),
    Rule(r"jr & sr|jr sr|jrsr", r"junior senior"),
    Rule(r" jr ", r" junior "),
    Rule(r" sr ", r" senior "),
    Rule(r"([pre]?\s?k) (\d+)", r"\1\2"),
    Rule(r" int[er]?(\s|$)|intrmd", r" intermediate "),
    Rule(r"juvenile justice academy for academic excellence", r"jjaep"),
    Rule(r"regional safe school program", r"rssp"),
    Rule(r"lrng?", r"learning"),
    Rule(r"\bctr\b|\bcntr\b", r"center"),
    Rule(r"\belc\b", r"enhanced learning center"),
    Rule(r" co | cnty ", r" county "),
    Rule(r" cons ", r" consolidated "),
    Rule(r" const ", r" construction "),
    Rule(r" educ ", r" education "),
    Rule(r" prep ", r" preparatory "),
    Rule(r"\s{2,}", r" ", every=True),
    "trim",
]

NCES_SCHOOL_NAME = [
    "lower",
    Rule(r"\.|'|\:|,", r"", every=True),
    "tighten",
    Rule(r"-|\\|\/", r" ", every=True),
    Rule(r" \(the\) ", r" "),
    Rule(r"\(|\)", r"", every=True),
    Rule(r"\bsaint\b", r"st"),
    Rule(r" the$|^the ", r""),
    Rule(r" and ", r" & ", every=True),
    Rule(r" (\w) & (\w) ", r" \1&\2 "),
    Rule(r"@", r" at "),
    Rule(r" (no|#|number)\s?(\d+)", r" \2"),
    Rule(r"sch ", r"school "),
    Rule(r"sch$", r"school"),
    Rule(r"pcss", r"pioneer charter school of science"),
    Rule(r"pcs", r" public charter school "),
    Rule(r" pc(\s|$)", r" public charter "),
    Rule(r" ps(\s|$)", r" public school "),
    Rule(r" cs$", r" charter school"),
    Rule(r"chtr", r"charter"),
    Rule(r" ecse$", r" early childhood education center"),
    Rule(r" ed(\s|$)", r" education"),
    Rule(r"ms shs", r"middle senior high school"),
    Rule(r" el | el$| elem | elem$", r" elementary "),
    Rule(r"\bacad\b", r"academy"),
    Rule(r" es$", r" elementary school"),
    Rule(r" ms$", r" middle school"),
    Rule(r"middle$", r"middle school"),
    Rule(r"elementary\s?$| e school", r"elementary school"),
    Rule(r" h s$| high$| hi school$| h school$", r" high school"),
    Rule(r" hs(\s|$)", r" high school "),
    Rule(r"j\s?shs", r"junior senior high school"),
    Rule(r" shs$", r" senior high school"),
    Rule(r" jh$| jhs$", r" junior high school"),
    Rule(r"jr & sr|jr sr|jrsr", r"junior senior"),
    Rule(r" jr ", r" junior "),
    Rule(r" sr ", r" senior "),
    Rule(r"([pre]?\s?k) (\d+)", r"\1\2"),
    Rule(r" int[er]?(\s|$)|intrmd", r" intermediate "),
    Rule(r"twnshp", r"township"),
    Rule(r" co | cnty ", r" county "),
    Rule(r"regional safe school program", r"rssp"),
    Rule(r"lrng?", r"learning"),
    Rule(r"\bctr\b", r"center"),
    Rule(r"\belc\b", r"enhanced learning center"),
    Rule(r" cons ", r" consolidated "),
    Rule(r" const ", r" construction "),
    Rule(r" educ ", r" education "),
    Rule(r" prep ", r" preparatory "),
    Rule(r"\s{2,}", r" ", every=True),
    "trim",
]

CEEB_UNIVERSITY_NAME = [
    Rule(r"A & M|A&M|Agricultural (and|&) Mechanical", r"A&M"),
    Rule(r" and ", r" & ", every=True),
    Rule(r"St\.? ", r"Saint ", every=True),
    Rule(r"Ft\.? ", r"Fort ", every=True),
    Rule(r"^The ", r""),
    Rule(r": |-", r" ", every=True),
    Rule(r"\.", r"", every=True),
    Rule(r"\\|\/", r" ", every=True),
    Rule(r"^UW ", r"University of Wisconsin "),
    Rule(r"City University of New York", r"CUNY"),
    Rule(r"Advanced Technical Institute", r"ATI"),
    Rule(r"Tuscon", r"Tucson"),
    Rule(r"^Texas A&M University$", "Texas A&M University College Station"),
    Rule(r"Main Campus", r""),
    Rule(r"Campus", r""),
    Rule(r"Apply$", r""),
    Rule(r" at ", r" "),
    Rule(r"\(.*\)", r"", every=True),
    Rule(r"\s{2,}", r" ", every=True),
    "trim",
]

# IPEDS names lose their quote marks first (see kinlink.plans.he)
IPEDS_NAME = [
    Rule(r"A & M|A&M|Agricultural (and|&) Mechanical", r"A&M"),
    Rule(r" and ", r" & ", every=True),
    Rule(r"St\.? ", r"Saint ", every=True),
    Rule(r"Ft\.? ", r"Fort ", every=True),
    Rule(r"^The ", r""),
    Rule(r": |-", r" ", every=True),
    Rule(r"\.", r"", every=True),
    Rule(r"\\|\/", r" ", every=True),
    Rule(r"City University of New York", r"CUNY"),
    Rule(r"Advanced Technical Institute", r"ATI"),
    Rule(r"Main Campus", r""),
    Rule(r"Campus", r""),
    Rule(r" at ", r" "),
    Rule(r"\(.*\)", r"", every=True),
    Rule(r"\s{2,}", r" ", every=True),
    "trim",
]

ADDRESS = ["lower", Rule(r"\.", r"", every=True)]
CITY = ["lower"]
