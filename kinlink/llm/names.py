"""Variant spellings of institutions' names, and the codes that belong together by them."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.values import STAND_INS
from kinlink.llm.streets import PREFIXES

# Short forms of given names, and how people abbreviate the words of institutions' names.
NICKNAMES = {
    "abigail": "abby", "alexander": "alec alex", "andrew": "andy", "anthony": "tony", "barbara": "barb", "benjamin": "ben benny", "catherine": "cathy",
    "charles": "chuck charlie", "christopher": "chris", "daniel": "dan danny", "david": "dave", "dorothy": "dot dottie", "edward": "ned ed eddie",
    "eleanor": "nell nellie", "elizabeth": "betty beth liz", "frances": "fran", "frederick": "fred freddy", "gerald": "jerry", "henrietta": "hattie etta",
    "henry": "hank", "jacob": "jake", "james": "jim jimmy", "john": "jack", "joseph": "joe joey", "josephine": "josie jo", "katherine": "kate kathy",
    "kenneth": "ken", "lawrence": "larry", "margaret": "peggy maggie", "martha": "marty mattie", "matthew": "matt", "michael": "mike", "nathaniel": "nate nat",
    "nicholas": "nick", "patricia": "pat patty", "peter": "pete", "philip": "phil", "rebecca": "becky", "richard": "dick rick", "robert": "bob rob",
    "roberta": "bobbie", "ronald": "ron", "samuel": "sam sammy", "stephen": "steve", "susan": "sue susie", "theodore": "ted teddy", "thomas": "tom tommy",
    "timothy": "tim", "victoria": "vicky", "walter": "walt", "william": "bill will", "wilma": "willie",
}
ABBREVIATIONS = {
    "school": "sch schl", "high": "hgh", "senior": "sr", "junior": "jr", "elementary": "elem el", "primary": "prim", "middle": "mid", "academy": "acad acdmy",
    "charter": "chtr", "preparatory": "prep", "center": "ctr cntr centre", "university": "univ u", "college": "coll col", "institute": "inst", "technical": "tech",
    "community": "comm", "nursing": "nrsg", "seminary": "sem semin", "public": "pub", "international": "intl", "department": "dept",
}
JOINED = {
    "hs": "high school", "shs": "senior high school", "jhs": "junior high school", "ms": "middle school", "es": "elementary school", "ps": "public school",
    "cs": "charter school", "cc": "community college", "jc": "junior college", "it": "institute of technology",
}
DROPPED = frozenset("the of and at for a school sch schl campus main no number senior center".split())
CLASS_WORDS = frozenset("high juniorhigh middle elementary primary academy charter preparatory career public university college community junior institute technical technology seminary nursing beauty state".split())
ANY_KIND = "school"
SIDES = {"n": "north", "s": "south", "e": "east", "w": "west", "so": "south", "nw": "northwest", "ne": "northeast", "sw": "southwest", "se": "southeast"}

_GIVEN = {n: k for k, v in NICKNAMES.items() for n in (k, *v.split())}
_ABBREVIATED = {w: k for k, v in ABBREVIATIONS.items() for w in (k, *v.split())}
_VOCABULARY = frozenset(_ABBREVIATED.values()) | CLASS_WORDS | frozenset("global online sciences science arts health hospital montessori campus main central".split())


def _deleted(w: str) -> set[str]:
    return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}


_NEAR: dict[str, str] = {}
for _w in sorted({*_VOCABULARY, *NICKNAMES, "north", "south", "east", "west", "saint", "mount", "fort"}, key=len):
    if len(_w) > 4:
        for _d in _deleted(_w):
            _NEAR.setdefault(_d, _w)


@lru_cache(maxsize=200_000)
def one_edit(a: str, b: str) -> bool:
    """Equal, or one letter exchanged, added, left out, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


@lru_cache(maxsize=300_000)
def tidy_word(w: str) -> str:
    """The word written out; misspellings of the words institutions share, and of given names, put right."""
    if w in _ABBREVIATED:
        return _ABBREVIATED[w]
    if w in _GIVEN:
        return _GIVEN[w]
    if len(w) > 3 and w not in _VOCABULARY:
        for d in _deleted(w):
            known = _NEAR.get(d)
            if known and one_edit(w, known):
                return known
    return w


_NAME_WORDS = re.compile(r"[a-z]+|\d+").findall
_INITIALS = re.compile(r"\b([a-z])\.(?=[a-z]\b)")
_READ_WITH_CARE = frozenset({*JOINED, "st", "ne", "nw", "se", "sw", "tech", *PREFIXES, "so", "no"})


class Name(NamedTuple):
    kind: str  # what sort of institution: its class words, sorted
    core: tuple[str, ...]  # the other words in order, given names written out
    key: str  # what a trie holds: the core without given names, initials and compass points, else #number
    number: str


def read_name(text: str | None) -> Name | None:
    """The parts of an institution's name; None if it states none.

    A place in brackets, articles and the order "Surname, Given Kind" or "Kind, Rest" are put
    right; abbreviations are written out.
    """
    if not text or text.strip().lower() in STAND_INS:
        return None
    s = text.lower().replace('"', " ").replace("'", "")
    if "(" in s:
        s = re.sub(r"\([^)]*\)?", " ", s)
    if "." in s:
        s = _INITIALS.sub(r"\1", s)
    # "X, First Kind": the surname goes behind the given name, else the part behind the comma goes first
    if s.count(",") == 1:
        a, b = (x.strip() for x in s.split(","))
        w = re.findall(r"[a-z]+", b)
        if w and w[-1] in ("of", "at"):
            s = f"{b} {a}"
        elif w and re.findall(r"[a-z]+", a) and "".join(re.findall(r"[a-z]+", a)) not in JOINED and not ({_ABBREVIATED.get(x, x) for x in re.findall(r"[a-z]+", a)} | {x for x in re.findall(r"[a-z]+", a) if x in JOINED}) & {*CLASS_WORDS, *JOINED, "school"}:
            given = 1 + (len(w) > 2 and len(w[1]) == 1)
            parts = b.split()
            s = " ".join((*parts[:given], a, *parts[given:]))
    raw = _NAME_WORDS(s.replace("&", " and "))
    # "h s", "p s", "e s" typed apart
    words: list[str] = []
    i = 0
    while i < len(raw):
        single = len(raw[i]) == 1
        pair = raw[i] + raw[i + 1] if single and i + 1 < len(raw) else ""
        if len(pair) == 2 and pair in ("hs", "ps", "es", "ms", "cs", "cc", "jc") and (i + 2 == len(raw) or pair == "ps" or raw[i + 2].isdigit() or raw[i + 2] in ("no", "number")):
            words += JOINED[pair].split()
            i += 2
        elif single and i + 2 < len(raw) and raw[i] + raw[i + 1] + raw[i + 2] in ("jhs", "shs"):
            words += JOINED[raw[i] + raw[i + 1] + raw[i + 2]].split()
            i += 3
        else:
            w = raw[i]
            if w not in _READ_WITH_CARE:
                words.append(w)
            elif w in JOINED and not (w == "it" and len(raw) < 2):
                words += JOINED[w].split()
            elif w == "st":
                behind = _ABBREVIATED.get(raw[i + 1], raw[i + 1]) if i + 1 < len(raw) else ""
                words.append("state" if behind in ("university", "college") else "saint")
            elif w in ("ne", "nw", "se", "sw"):
                words += [{"n": "north", "s": "south"}[w[0]], {"e": "east", "w": "west"}[w[1]]]
            elif w == "tech" and i and raw[i - 1] == "of":
                words.append("technology")
            elif w in PREFIXES and i + 1 < len(raw):
                words.append(PREFIXES[w])
            elif w == "so" or (w == "no" and i + 1 < len(raw) and not raw[i + 1].isdigit()):
                words.append("south" if w == "so" else "north")
            else:
                words.append(w)
            i += 1
    number = next((w.lstrip("0") for w in words if w.isdigit()), "")
    words = [tidy_word(w) for w in words if not w.isdigit()]
    # a junior high school is no high school
    joined: list[str] = []
    for w in words:
        if w == "high" and joined and joined[-1] == "junior":
            joined[-1] = "juniorhigh"
        else:
            joined.append(w)
    kind = sorted({w for w in joined if w in CLASS_WORDS})
    core = tuple(w for w in joined if w not in CLASS_WORDS and w not in DROPPED)
    long = [w for w in core if len(w) > 1 and w not in NICKNAMES and w not in SIDES.values() and w not in PREFIXES.values()]
    key = "".join(long) or "".join(w for w in core if len(w) > 1)
    if not (core or number or kind):
        return None
    return Name(" ".join(kind) or ANY_KIND, core, key or (f"#{number}" if number else ""), number)


def words_agree(a: str, b: str) -> bool:
    if len(a) == 1 or len(b) == 1:
        return a[0] == b[0]
    if a in NICKNAMES and b in NICKNAMES:
        return a == b
    return one_edit(a, b) if min(len(a), len(b)) >= 4 else a == b


def names_agree(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """How well two cores agree in any order of words, 0 if they contradict each other.

    Every word of the shorter must have a partner of its own in the longer: equal, one edit away or its
    initial. Words left over may only be initials or given names, as people leave these out.
    """
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    left, score = list(b), 0.0
    for full in (True, False):  # exact partners first, so that they aren't taken by initials
        rest = []
        for w in a:
            hit = next((x for x in left if (x == w if full else words_agree(w, x))), None)
            if hit is None:
                rest.append(w)
            else:
                left.remove(hit)
                score += 1.0 if full else 0.5 if len(w) == 1 or len(hit) == 1 else 0.8
        a = tuple(rest)
    if a or any(len(x) > 1 and x not in NICKNAMES for x in left):
        return 0.0
    n = len(b)
    return (score + 0.5 * len(left)) / n - 0.05 if n and (score or n == len(left)) else 0.0


def within_edits(a: str, b: str, most: int) -> bool:
    """Whether a and b are at most most edits apart (a swap of neighbours counts as one)."""
    while True:
        if a == b:
            return True
        if not most or abs(len(a) - len(b)) > most:
            return False
        # what is alike at the start needs no edit
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        a, b = a[i:], b[i:]
        if not a or not b:
            return True
        if most == 1:
            return a[1:] == b[1:] or a[1:] == b or a == b[1:] or (a[:2] == b[1::-1] and a[2:] == b[2:])
        most -= 1
        if within_edits(a[1:], b, most) or within_edits(a, b[1:], most) or (a[:2] == b[1::-1] and within_edits(a[2:], b[2:], most)):
            return True
        a, b = a[1:], b[1:]


class Trie:
    """Keys by letter, a trie for each length, searched by a Levenshtein automaton.

    A branch that leads to one key only is kept as (rest of the key, its items), on which the automaton runs on as on a string.
    """

    def __init__(self):
        self.roots: dict[int, dict] = {}

    def add(self, key: str, item) -> None:
        node, i = self.roots.setdefault(len(key), {}), 0
        while True:
            c, rest = key[i : i + 1], key[i + 1 :]
            child = node.get(c)
            if child is None:
                node[c] = (rest, [item])
                return
            if type(child) is tuple:
                if child[0] == rest:
                    child[1].append(item)
                    return
                child = node[c] = {child[0][:1]: (child[0][1:], child[1])}
            node, i = child, i + 1

    def forget(self, shorter_than: int) -> None:
        for n in [n for n in self.roots if n < shorter_than]:
            del self.roots[n]

    def within(self, word: str, most: int) -> list:
        """Items of all keys at most most edits from word (a swap of neighbours counts as one), each once."""
        out: list = []
        for length, root in self.roots.items():
            if abs(length - len(word)) <= most:
                self._search(root, word, length - len(word), most, out)
        return out

    def _search(self, root: dict, word: str, longer: int, most: int, out: list) -> None:
        """longer: letters the keys have more than word. What is left of a key less what is left of word can't be more
        than the edits left, which prunes most states before they are looked at."""
        done: set[int] = set()

        def reach(child, i: int, e: int, g: int) -> None:
            while type(child) is dict:
                if e < most:
                    todo.append((child, i, e, g))
                    return
                # no edit is left: the rest must be there as it is
                child = child.get(word[i : i + 1])
                i += 1
            if child is not None and id(child) not in done and within_edits(child[0], word[i:], most - e):
                done.add(id(child))
                out.extend(child[1])

        # a state: node, letters of word read, edits made, letters the node's keys have left more than word
        todo: list = []
        reach(root, 0, 0, longer)
        seen = set()
        while todo:
            node, i, e, g = todo.pop()
            if (state := (id(node), i, e)) in seen:
                continue
            seen.add(state)
            c, left = word[i : i + 1], most - e - 1
            if (child := node.get(c)) is not None:
                reach(child, i + 1, e, g)
            if c and abs(g + 1) <= left:
                reach(node, i + 1, e + 1, g + 1)
            other, more = c and abs(g) <= left, abs(g - 1) <= left
            if not other and not more:
                continue
            here, rest, behind, last = word[i:], word[i + 1 :], word[i + 1 : i + 2], not left
            for d, child in node.items():
                if not d:
                    continue
                # with the last edit most branches end here, before any call
                if more and (not last or (child[0] == here if type(child) is tuple else c in child)):
                    reach(child, i, e + 1, g - 1)
                if other and d != c:
                    if not last or (child[0] == rest if type(child) is tuple else behind in child):
                        reach(child, i + 1, e + 1, g)
                    if d == behind:
                        if type(child) is dict:
                            if c in child:
                                reach(child[c], i + 2, e + 1, g)
                        elif child[0][:1] == c and id(child) not in done and within_edits(child[0][1:], word[i + 2 :], left):
                            done.add(id(child))
                            out.extend(child[1])


# Edits allowed by the letters of a key: none below 4, one from 4 on, two from 10 on.
EDITS = ((4, 1), (10, 2))


def edits_for(key: str, edits: tuple[tuple[int, int], ...] = EDITS) -> int:
    """Edits allowed in key; a key of a number alone (#12) must agree as it is."""
    n = 0 if key.startswith("#") else len(key)
    return max((e for least, e in edits if n >= least), default=0)


@lru_cache(maxsize=50_000)
def orders(core: tuple[str, ...], key: str) -> frozenset[str]:
    """The key, and those of other orders of its words: all for two or three such words, see sorted_keys for more."""
    long = _long(core)
    return frozenset(map("".join, itertools.permutations(long)) if 2 <= len(long) <= 3 else (key, *sorted_keys(core, key)))


def sorted_keys(core: tuple[str, ...], key: str) -> set[str]:
    """The keys of four or more such words sorted by their starts and by their ends, else none.

    Names of any order meet in them, and an edit at the start of a word leaves the order by ends as it is.
    """
    long = _long(core) if len(core) > 3 else []
    if len(long) < 4:
        return set()
    both = (sorted(long), sorted(long, key=lambda w: w[::-1]))
    return {x for x in ("".join(p) for p in both) if len(x) == len(key)}


def _long(core: tuple[str, ...]) -> list[str]:
    return [w for w in core if len(w) > 1 and w not in NICKNAMES and w not in SIDES.values() and w not in PREFIXES.values()]


def sorts_agree(kind_a: str, kind_b: str, number_a: str, number_b: str) -> float:
    """How well kinds and numbers agree: 1 if both are equal, less for each that one name leaves out, 0 if they contradict.

    A kind is left out if a name has none ("school") or only some of the other's class words (high, charter high).
    """
    if number_a != number_b and number_a and number_b:
        return 0.0
    left_out = number_a != number_b
    if kind_a != kind_b:
        if kind_a != ANY_KIND and kind_b != ANY_KIND:
            a, b = set(kind_a.split()), set(kind_b.split())
            if not (a <= b or b <= a):
                return 0.0
        left_out += 1
    return (1.0, 0.8, 0.6)[left_out]


def prefix_deletions(form: str, most: int) -> set[str]:
    """What the first PREFIX letters of form become with up to most letters left out.

    Of two strings at most most edits apart (a swap of neighbours counts as one), some of these are the same.
    """
    out = level = {form[:PREFIX]}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out = out | level
    return out


BLOCK, PREFIX, PART_NAMES = 6, 6, 20_000


def variants(names: DataFrame, edits: tuple[tuple[int, int], ...] = EDITS, part_names: int = PART_NAMES) -> DataFrame:
    """(shard, code_a, code_b, agree) for codes of one shard under variants of one name.

    names: shard (string), code, kind, core (array), key, number; repeated rows are made one. A shard is
    split by length of key; rows are sorted by length, a part is read once, and only the tries of the last
    three lengths are kept, as no name within two edits is shorter. A part of more than part_names names of its own is split
    further: its names go to one part for each of the prefix_deletions of their key's forms, in one of which any
    two names within the bound meet, so a shard of a third of all names is many small tasks. Neighbours in the
    trie are then checked word by word in any order, and by kind and number. agree is the best over the codes' names.
    """
    d = names.where("shard is not null and code is not null and key is not null").select("shard", "code", "kind", "number", "key", "core")
    d = d.withColumn("len", F.length("key"))
    # a shard is spread over blocks of BLOCK lengths; the two lengths below a block are its guests, which are only found
    block, part = F.floor(F.col("len") / BLOCK), lambda b: F.concat_ws("|", "shard", b)
    large = d.groupBy("shard", block.alias("block")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_names).select(part(F.col("block")).alias("part"))
    homes = F.array(F.struct(block.alias("block"), F.lit(False).alias("guest")), F.when(F.col("len") % BLOCK >= BLOCK - 2, F.struct((block + 1).alias("block"), F.lit(True).alias("guest"))))
    d = d.withColumn("h", F.explode(F.array_compact(homes))).withColumn("part", part(F.col("h.block")))
    d = d.select("part", "shard", "code", "key", "core", "kind", "number", "len", "h.guest")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            take, parts = [], []
            for i, (part, key, core) in enumerate(zip(*(t.column(c).to_pylist() for c in (0, 3, 4)))):
                most = edits_for(key if key.startswith("#") else key + "  ", edits)  # a name two letters longer may look for it
                to = {f"{part}|{w}" for form in orders(tuple(core), key) for w in prefix_deletions(form, most)}
                take += [i] * len(to)
                parts += to
            rows = t.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), *rows.columns[1:]], t.schema.names)

    if not large.isEmpty():
        d = d.join(large, "part", "left_anti").unionByName(d.join(large, "part", "left_semi").mapInArrow(split, d.schema))
    d = d.repartition("part").sortWithinPartitions("part", "len", "key", "code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, trie, out = None, Trie(), []
        last, same, found = None, set(), {}
        names = ["shard", "code_a", "code_b", "agree"]

        def batch() -> pa.RecordBatch:
            columns = zip(*out) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*[pa.string()] * 3, pa.float64()])], names)

        def search(key: str, forms: frozenset[str]) -> list:
            """The names within the bound of any of the forms, each once. Names of one key lie together and are searched for
            once; those of the key itself that come in between are added to what was found."""
            if forms not in found:
                most = edits_for(key, edits)
                hits = [x for form in forms for x in trie.within(form, most)]
                found[forms] = hits if len(forms) == 1 else [*{id(x): x for x in hits}.values()]
            return found[forms]

        for t in batches:
            for p, shard, code, key, core, kind, number, n, guest in zip(*(t.column(k).to_pylist() for k in range(9))):
                if p != part:
                    part, trie, last = p, Trie(), None
                if last is None or last[0] != key:
                    found = {}
                # repeated names of a code are worked on once
                if last != (key, code):
                    last, same = (key, code), set()
                name = (tuple(core), kind, number)
                if name in same:
                    continue
                same.add(name)
                core, stored = name[0], {key, *sorted_keys(name[0], key)}
                trie.forget(n - 2)
                if not guest:
                    seen: dict[str, float] = {}
                    for other, (words, its_kind, its_number) in search(key, orders(core, key)):
                        if other != code and (sort := sorts_agree(kind, its_kind, number, its_number)) and (a := sort * names_agree(core, words)) > seen.get(other, 0):
                            seen[other] = a
                    out += [(shard, min(code, o), max(code, o), a) for o, a in seen.items()]
                item = (code, name)
                for form in stored:
                    trie.add(form, item)
                for forms, hits in found.items():
                    if not stored.isdisjoint(forms):
                        hits.append(item)
            if len(out) > 50_000:
                yield batch()
                out = []
        yield batch()

    pairs = d.mapInArrow(run, "shard string, code_a string, code_b string, agree double")
    return pairs.groupBy("shard", "code_a", "code_b").agg(F.max("agree").alias("agree"))


@lru_cache(maxsize=50_000)
def _fields(text: str | None) -> tuple:
    n = read_name(text)
    return (n.kind, list(n.core), n.key, n.number) if n else (None,) * 4


def with_name(rows: DataFrame, column: str) -> DataFrame:
    """rows with kind, core, key and number of the name in column; rows that state none drop out."""

    @F.arrow_udf("struct<kind:string,core:array<string>,key:string,number:string>")
    def read(names: pa.Array) -> pa.Array:
        columns = zip(*map(_fields, names.to_pylist())) if len(names) else [[]] * 4
        types = [pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["kind", "core", "key", "number"])

    # not deterministic for the optimiser only: else the filter is pushed below a distinct and the names are read twice
    return rows.withColumn("_n", read.asNondeterministic()(column)).where("_n.kind is not null").select(*rows.columns, "_n.*")


def name_pairs(names: DataFrame, cut, by_town: bool = True) -> DataFrame:
    """(registry_a, code_a, registry_b, code_b, agree) of variants in one town (or state).

    names: registry, code, state, place and the parts with_name gives. Registries in one call meet each
    other too; the pair is ordered by registry, then code. A name is worked on once however many rows bear it.
    """
    shard = F.concat_ws("|", "state", "place") if by_town else F.col("state")
    n = names.where("code is not null" + (" and place != ''" if by_town else ""))
    v = variants(n.select(shard.alias("shard"), F.concat_ws("|", "registry", "code").alias("code"), "kind", "core", "key", "number"))
    side = lambda c: [F.split_part(c, F.lit("|"), F.lit(1)).alias(f"registry_{c[-1]}"), F.split_part(c, F.lit("|"), F.lit(2)).alias(c)]
    return cut(v.groupBy("code_a", "code_b").agg(F.max("agree").alias("agree")).select(*side("code_a"), *side("code_b"), "agree"))


def with_places(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """pairs with together: true if the codes share a location, false if both state some but share none, else null."""
    p = places.where("code is not null and location is not null")
    keys = ["registry_a", "code_a", "registry_b", "code_b"]
    at = lambda x: p.select(F.col("registry").alias(f"registry_{x}"), F.col("code").alias(f"code_{x}"), F.col("location").alias(f"at_{x}"))
    d = pairs.join(at("a"), ["registry_a", "code_a"], "left").join(at("b"), ["registry_b", "code_b"], "left")
    # null where either code states no location; else whether any of theirs is the same
    return d.groupBy(*keys).agg(F.max("agree").alias("agree"), F.max(F.col("at_a") == F.col("at_b")).alias("together"))


def rare_pairs(pairs: DataFrame, names: DataFrame, cut) -> DataFrame:
    """The pairs of one registry whose places can't tell and whose names agree in part, if the name is theirs alone.

    Neither code may have a variant at a third code of its registry and town that isn't at its own location,
    and each name of either code must agree with one of the other's, of the same kind and number.
    """
    one = pairs.where("registry_a = registry_b").select(F.col("registry_a").alias("registry"), "code_a", "code_b", "agree", "together")
    apart = one.where("together is null or not together").select("registry", F.explode(F.array("code_a", "code_b")).alias("code"))
    common = apart.groupBy("registry", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("registry", "code")
    d = one.where("together is null and agree < 0.99").select("registry", "code_a", "code_b")
    for x in ("code_a", "code_b"):
        d = d.join(common.withColumnRenamed("code", x), ["registry", x], "left_anti")
    d = cut(d)
    asked = d.select("registry", F.explode(F.array("code_a", "code_b")).alias("code")).distinct()
    cores = names.select("registry", "code", "core", "kind", "number").join(asked, ["registry", "code"], "left_semi").groupBy("registry", "code").agg(F.collect_set(F.struct("core", "kind", "number")).alias("cores"))
    for x in "ab":
        d = d.join(cores.select("registry", F.col("code").alias(f"code_{x}"), F.col("cores").alias(f"cores_{x}")), ["registry", f"code_{x}"])

    @F.arrow_udf("boolean")
    def agree(a: pa.Array, b: pa.Array) -> pa.Array:
        one = lambda m, n: (m["kind"], m["number"]) == (n["kind"], n["number"]) and names_agree(tuple(m["core"]), tuple(n["core"]))
        meets = lambda x, y: all(any(one(m, n) for n in y) for m in x)
        return pa.array([meets(x, y) and meets(y, x) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    return d.where(agree("cores_a", "cores_b")).select("registry", "code_a", "code_b")


def codes_together(pairs: DataFrame, names: DataFrame | None = None, cut=None) -> DataFrame:
    """(registry, code_a, code_b) of one institution, code_a < code_b, from with_places' rows.

    Variants of one name in one town count as one institution if the codes share a location, or if
    they can't contradict each other: one of them states no location at all and the names agree fully,
    or, where names (and cut) are given, in part but are borne by these two alone (see rare_pairs).
    """
    one = pairs.where("registry_a = registry_b and (together or (together is null and agree >= 0.99))")
    one = one.select(F.col("registry_a").alias("registry"), "code_a", "code_b")
    return (one if names is None else one.unionByName(rare_pairs(pairs, names, cut))).distinct()
