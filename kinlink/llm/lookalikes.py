"""One consistent form of texts that look the same in other characters.

The vocabulary of a corpus is every word that is spelled cleanly somewhere: composed letters of one script. A word
that might be another's look-alike is walked through tries of the vocabulary by an edit automaton in which
exchanging look-alike letters and skipping invisible characters cost nothing; the spellings it reaches are
what it may stand for. Of several scripts (cop, \u0441\u043e\u0440) the text's own decides, which is told by the letters no other script
has, as these are the same in all texts that look alike. Words that reach no spelling, and all that is no word,
are normalised by table. Both give one form to everything that looks alike, and leave cleanly spelled texts as they are.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters that look like a Latin letter, after the Unicode confusables (UTS 39),
# without those that many fonts tell apart.
LOOK_ALIKES = {
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "і", "j": "јϳ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛզ", "s": "ѕ", "u": "սυ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "у",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜϺ", "N": "Ν", "O": "ОΟՕ",
    "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "U": "Ս", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "УΥҮ", "Z": "Ζ",
}
BLANKS = "\t               　"
HYPHENS = "‐‑"

FOLD = {c: latin for latin, chars in LOOK_ALIKES.items() for c in chars}
# compatibility forms that look like their letters: full width, ligatures, Roman numerals, Kelvin and Angstrom
_COMPAT = {c: k for c in [*range(0xFF01, 0xFF5F), *range(0xFB00, 0xFB07), *range(0x2160, 0x2180), 0x212A, 0x212B] if (k := unicodedata.normalize("NFKC", chr(c))) != chr(c)}
_IGNORED = [c for c in [0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE01F0)]]
_IGNORED += [c for c in range(0xAD, 0x10000) if unicodedata.category(chr(c)) == "Cf"]
IGNORED = frozenset(map(chr, _IGNORED))
_TABLE = {**_COMPAT, **dict.fromkeys(_IGNORED), **{ord(c): " " for c in BLANKS}, **{ord(c): "-" for c in HYPHENS}, 0x2028: "\n", 0x2029: "\n"}
_LETTERS = {c: k for c, k in _COMPAT.items()}


def _letter_class() -> str:
    """Non-ASCII letters, marks, letter numbers and invisible characters of the basic plane as ranges of a character class.

    No letter beyond it has a look-alike here; those are left to the table (and the class stays a bitmap)."""
    fit = [c for c in range(0x80, 0xD800) if unicodedata.category(chr(c))[0] in "LM" or unicodedata.category(chr(c)) == "Nl" or chr(c) in IGNORED]
    starts = [c for k, c in enumerate(fit) if not k or fit[k - 1] != c - 1]
    ends = [c for k, c in enumerate(fit) if k + 1 == len(fit) or fit[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends)) + "\\uf900-\\ufdff\\ufe00-\\ufe0f\\ufe70-\\ufeff\\uff21-\\uff3a\\uff41-\\uff5a\\uff66-\\uffdc"


_FOREIGN = _letter_class()
_RUN = re.compile(rf"[A-Za-z{_FOREIGN}]+")
_ASCII_RUN = re.compile("[A-Za-z]+").findall


_BY_TABLE = re.compile("[" + "".join(re.escape(chr(c)) for c in _TABLE if c < 0x10000) + "]")
_BY_TABLE_BEYOND = re.compile("[\U000e0000-\U000e01ef]")
_TAIL = re.compile(r" +(?=\n)")
_VISIBLE = regex.compile(r"[^\s\p{C}]")


def spelled(word: str) -> str:
    """The letters a word is made of: compatibility forms expanded, accents as combining marks."""
    return unicodedata.normalize("NFD", word.translate(_LETTERS))


def skeleton(word: str) -> str:
    """The form by table: invisible characters dropped, look-alikes exchanged, accents composed."""
    bare = "".join(FOLD.get(c, c) for c in spelled("".join(c for c in word if c not in IGNORED)))
    return unicodedata.normalize("NFC", bare)


@lru_cache(maxsize=200_000)
def _script(c: str) -> str:
    return unicodedata.name(c, "?").split()[0]


LATIN = "LATIN"
# the class of each look-alike letter, and of each class the letter a script is written with: its first, should it have two
_CLASS = {c: latin for latin, chars in LOOK_ALIKES.items() for c in (latin, *chars)}
_OF_SCRIPT: dict[tuple[str, str], str] = {}
for _c, _latin in _CLASS.items():
    _OF_SCRIPT.setdefault((_latin, _script(_c)), _c)
_ALIKE = {c: (latin, *LOOK_ALIKES[latin]) for c, latin in _CLASS.items()}


@lru_cache(maxsize=200_000)
def own_script(c: str) -> str | None:
    """The script of a letter that no other script's looks like; None for all other characters."""
    base = spelled(c)[:1]
    return _script(base) if base and base not in _CLASS and unicodedata.category(base)[0] == "L" and base not in IGNORED else None


def text_script(s: str) -> str:
    """The script of most letters that tell one, Latin if there are none. The same for all texts that look alike."""
    scripts: Counter = Counter()
    for c, n in Counter(s).items():
        if (x := own_script(c)) is not None:
            scripts[x] += n
    return min(scripts, key=lambda x: (-scripts[x], x)) if scripts else LATIN


def is_clean(word: str) -> bool:
    """A spelling fit to be canonical: composed letters of one script as it is written with, none of them invisible or a compatibility form."""
    if word.isascii():
        return True
    if any(c in IGNORED or ord(c) in _COMPAT for c in word) or not unicodedata.is_normalized("NFC", word):
        return False
    letters = [c for c in spelled(word) if unicodedata.category(c)[0] != "M"]
    scripts = {_script(c) for c in letters}
    return len(scripts) == 1 and all(_OF_SCRIPT[_CLASS[c], _script(c)] == c for c in letters if c in _CLASS)


@lru_cache(maxsize=300_000)
def is_settled(word: str) -> bool:
    """Whether the word's own form is canonical in any text, as no other clean spelling looks like it."""
    if not word.isascii() and (any(c in IGNORED or ord(c) in _COMPAT for c in word) or not unicodedata.is_normalized("NFC", word)):
        return False
    letters = [c for c in (word if word.isascii() else spelled(word)) if unicodedata.category(c)[0] != "M"]
    alike = [c in _CLASS for c in letters]
    return not any(alike) or (not all(alike) and is_clean(word))


def by_table(word: str, script: str) -> str:
    """The word without invisible characters, look-alikes exchanged for letters of one script: that of the word's own letters,
    else the text's; Latin where that script lacks one of them."""
    bare = skeleton(word)
    letters = unicodedata.normalize("NFD", bare)
    own = {x for c in letters if (x := own_script(c))}
    to = next(iter(own)) if len(own) == 1 else script
    if all((c, to) in _OF_SCRIPT for c in letters if c in LOOK_ALIKES):
        bare = unicodedata.normalize("NFC", "".join(_OF_SCRIPT.get((c, to), c) for c in letters))
    return bare


class Trie:
    """Spellings by letter; the end of one is under the empty key as a list of (-count, spelling)."""

    def __init__(self):
        self.root: dict = {}

    def add(self, word: str, n: int) -> None:
        node = self.root
        for c in spelled(word):
            node = node.setdefault(c, {})
        node.setdefault("", []).append((-n, word))

    def reached(self, word: str, most: float = 0.0, cost: float = 1.0) -> list[tuple[float, int, str]]:
        """(weight, -count, spelling) of all spellings of weight most at most from word, the least first.

        Weights: look-alike letters and skipped invisible characters 0; any other letter exchanged,
        left out or put in cost.
        """
        letters, best = spelled(word), {}
        todo, seen = [(0.0, 0, self.root)], {}
        while todo:
            w, i, node = todo.pop()
            if w > most or seen.get((i, id(node)), most + 1) <= w:
                continue
            seen[i, id(node)] = w
            if i == len(letters):
                for n, spelling in node.get("", ()):
                    best[spelling] = min(best.get(spelling, (w, n)), (w, n))
                if w + cost <= most:
                    todo += [(w + cost, i, n) for c, n in node.items() if c]
                continue
            c = letters[i]
            if c in IGNORED:
                todo.append((w, i + 1, node))
                continue
            alike = _ALIKE.get(c) or (c,)
            todo += [(w, i + 1, node[x]) for x in alike if x in node]
            if w + cost <= most:
                todo.append((w + cost, i + 1, node))
                for d, n in node.items():
                    if d:
                        todo.append((w + cost, i, n))
                        if d not in alike:
                            todo.append((w + cost, i + 1, n))
        return sorted((*wn, x) for x, wn in best.items())


class Canonical:
    """The consistent form of texts, by what the tries told about words. Forms of words are kept, words of them at most.

    known: word -> the spellings it reaches, the most frequent first; a clean word that isn't there reaches but itself.
    """

    def __init__(self, known: dict[str, list[str]], words: int = 300_000):
        self.known, self.words, self.forms = known, words, {}

    def word(self, word: str, script: str, known: dict[str, list[str]] | None = None) -> str:
        if is_settled(word):
            return word
        reached = (self.known if known is None else known).get(word)
        if not reached:
            return word if is_clean(word) else by_table(word, script)
        return next((x for x in reached if (LATIN if x.isascii() else _script(x[0])) == script), reached[0])

    def text(self, s: str, known: dict[str, list[str]] | None = None) -> str:
        """The consistent form of a whole text; blanks at line ends and empty lines at its end are dropped.

        known: for this text alone, else that of the corpus.
        """
        if not s.isascii():
            script = text_script(s)
            forms = self.forms if known is None else {}

            def form(m: re.Match) -> str:
                key = script, m.group()
                f = forms.get(key)
                if f is None:
                    f = self.word(key[1], script, known)
                    if len(forms) >= self.words:
                        forms.clear()
                    if len(key[1]) <= 64:
                        forms[key] = f
                return f

            s = _RUN.sub(form, s)
            if _BY_TABLE.search(s) or _BY_TABLE_BEYOND.search(s):
                s = s.translate(_TABLE)
            s = s if unicodedata.is_normalized("NFC", s) else unicodedata.normalize("NFC", s)
        elif "\t" in s:
            s = s.replace("\t", " ")
        if "\r" in s:
            s = s.replace("\r\n", "\n").replace("\r", "\n")
        if " \n" in s:
            s = _TAIL.sub("", s)
        return s.rstrip(" \n")


def words_of_corpus(df: DataFrame, text_col: str) -> DataFrame:
    """(skeleton, word, clean, asked, n): all different words of all texts, the clean ones and those that aren't settled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = [(w if w.isascii() else skeleton(w), w, is_clean(w), not is_settled(w), n) for w, n in seen.items()]
            columns = zip(*rows) if rows else [[]] * 5
            types = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["skeleton", "word", "clean", "asked", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(_ASCII_RUN(t) if t.isascii() else _RUN.findall(t))
            if len(seen) > 200_000:  # counts are summed again, so memory stays bounded
                yield out()
                seen.clear()
        yield out()

    w = df.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(count, "skeleton string, word string, clean boolean, asked boolean, n bigint")
    return w.groupBy("skeleton", "word", "clean", "asked").agg(F.sum("n").alias("n"))


def spellings_reached(words: DataFrame, trie_words: int = 10_000) -> DataFrame:
    """(word, reached): the clean spellings that words not settled reach at no cost, the most frequent first; clean words
    that reach but themselves have no row.

    words: of words_of_corpus. Spellings at no cost have the word's skeleton, so the vocabulary is spread by skeleton;
    a task fills a trie with about trie_words spellings of whole skeletons, walks their words through it and begins another.
    Nothing reaches the driver, and no word is left out.
    """
    asked = words.where("asked").select("skeleton").distinct()
    d = words.join(asked, "skeleton", "left_semi").repartition("skeleton").sortWithinPartitions("skeleton", "word")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, todo, size, last = Trie(), [], 0, None

        def out() -> pa.RecordBatch:
            rows = [(w, r) for w in todo if (r := [x for _, _, x in trie.reached(w)]) and r != [w]]
            columns = zip(*rows) if rows else [[]] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.list_(pa.string())])], ["word", "reached"])

        for b in batches:
            for s, word, clean, is_asked, n in zip(*(b.column(k).to_pylist() for k in range(5))):
                if s != last and size + len(todo) >= trie_words:
                    yield out()
                    trie, todo, size = Trie(), [], 0
                last = s
                if clean:
                    trie.add(word, n)
                    size += 1
                if is_asked:
                    todo.append(word)
        yield out()

    return d.select("skeleton", "word", "clean", "asked", "n").mapInArrow(walk, "word string, reached array<string>")


SMALL = 100_000


def with_words(df: DataFrame, id_col: str, text_col: str, reached: DataFrame) -> DataFrame:
    """df's id and text with known, (word, reached) of the words of each text that aren't settled."""
    kind = dict(df.dtypes)[id_col]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                if t and not t.isascii():
                    w = {x for x in _RUN.findall(t) if not is_settled(x)}
                    ids += [k] * len(w)
                    found += w
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(found, pa.string())], ["id", "word"])

    d = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    of = d.mapInArrow(asked, f"id {kind}, word string").distinct().join(reached, "word").groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("word", "reached")).alias("known"))
    return d.join(of, F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "text", "known")


def _formed(df: DataFrame, id_col: str, text_col: str, cut, small: int, run, schema: str) -> DataFrame:
    """run(canonical texts of a batch, batch) over all texts. Up to small words that aren't settled are broadcast, as their number is
    counted first; beyond, each text gets those of its own by a join."""
    reached = cut(spellings_reached(cut(words_of_corpus(df, text_col))))
    if reached.count() <= small:
        known = df.sparkSession.sparkContext.broadcast({r.word: list(r.reached) for r in reached.collect()})

        def broadcast_form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = Canonical(known.value)
            for b in batches:
                yield run([None if t is None else c.text(t) for t in b.column(1).to_pylist()], b)

        return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(broadcast_form, schema)

    def joined_form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Canonical({})
        for b in batches:
            texts = zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            yield run([None if t is None else c.text(t, {x["word"]: x["reached"] for x in k or ()}) for t, k in texts], b)

    return with_words(df, id_col, text_col, reached).mapInArrow(joined_form, schema)


def canonical_texts(df: DataFrame, id_col: str, text_col: str, cut, small: int = SMALL) -> DataFrame:
    """(id_col, text): the consistent form of each text; null stays null, an empty text empty."""

    def run(forms: list[str | None], b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, pa.string())], [id_col, "text"])

    return _formed(df, id_col, text_col, cut, small, run, f"`{id_col}` {dict(df.dtypes)[id_col]}, text string")


def look_keys(df: DataFrame, id_col: str, text_col: str, cut, small: int = SMALL) -> DataFrame:
    """(id, look, stored): digests of the consistent form and of the stored text; texts with nothing visible have no row."""

    def run(forms: list[str | None], b: pa.RecordBatch) -> pa.RecordBatch:
        at, looks, stored = [], [], []
        for k, (form, t) in enumerate(zip(forms, b.column(1).to_pylist())):
            if t and _VISIBLE.search(form):
                at.append(k)
                looks.append(hashlib.md5(form.encode("utf-8", "surrogatepass")).digest())
                stored.append(hashlib.md5(t.encode("utf-8", "surrogatepass")).digest())
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(looks, pa.binary()), pa.array(stored, pa.binary())], ["id", "look", "stored"])

    return _formed(df, id_col, text_col, cut, small, run, f"id {dict(df.dtypes)[id_col]}, look binary, stored binary")


def look_alike_pairs(keys: DataFrame) -> DataFrame:
    """(a, b), a < b, of ids with the same look but another stored text, from look_keys' rows.

    Different stored texts of one look are paired first, then their ids take the texts' places, so copies of a
    text are never compared with each other: the work is the different texts and the pairs that come out.
    Looks of one stored text leave early, by a pre-aggregated minimum and maximum.
    """
    mixed = keys.groupBy("look").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi")).where("lo != hi").select("look")
    k = keys.where("id is not null").join(mixed, "look").select("look", "stored", "id").distinct()
    texts = k.select("look", "stored").distinct()
    two = texts.withColumnRenamed("stored", "sa").join(texts.withColumnRenamed("stored", "sb"), "look").where("sa < sb")
    two = two.join(k.select("look", F.col("stored").alias("sa"), F.col("id").alias("x")), ["look", "sa"])
    two = two.join(k.select("look", F.col("stored").alias("sb"), F.col("id").alias("y")), ["look", "sb"])
    return two.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
