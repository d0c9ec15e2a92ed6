"""Ordered rewriting rules in RE2's dialect, run by Spark's Java engine with RE2's meaning."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"  # ASCII words, as in RE2


class Rule(NamedTuple):
    pattern: str
    replacement: str = ""
    every: bool = False  # all matches, else the first only


def re2_to_java(pattern: str) -> str:
    """The pattern with the meaning it has in RE2: $ is the absolute end, \\b knows ASCII words, \\s no vertical tab."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            d = pattern[i + 1]
            if d == "s":
                out.append(r"\t\n\f\r " if in_class else r"[\t\n\f\r ]")
            elif d == "S" and not in_class:
                out.append(r"[^\t\n\f\r ]")
            elif d == "b" and not in_class:
                out.append(_BOUNDARY)
            else:
                out.append(c + d)
            i += 2
            continue
        if c == "[" and not in_class:
            in_class = True
        elif c == "]" and in_class:
            in_class = False
        out.append(r"\z" if c == "$" and not in_class else c)
        i += 1
    return "".join(out)


def _replacement(text: str, shift: int) -> str:
    out, i = [], 0
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text) and text[i + 1].isdigit():
            out.append(f"${int(text[i + 1]) + shift}")
            i += 2
            continue
        out.append("\\" + c if c in "$\\" else c)
        i += 1
    return "".join(out)


def replace_all(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, F.lit(re2_to_java(pattern)), F.lit(_replacement(replacement, 0)))


def replace_first(c: Column, pattern: str, replacement: str) -> Column:
    """Only the first match: what stands before it is matched lazily and put back."""
    return F.regexp_replace(c, F.lit(rf"\A((?s:.*?))(?:{re2_to_java(pattern)})"), F.lit("$1" + _replacement(replacement, 1)))


def search(c: Column, pattern: str) -> Column:
    return c.rlike(re2_to_java(pattern))


def tighten(c: Column) -> Column:
    """Runs of two or more one-character words made one word ("p s 12" -> "ps 12"); the last must end with a blank or the text."""
    return F.regexp_replace(c, r"(?U)(?<=\b\w) +(?=\w(?:\s|\z))", "")


def rewrite(c: Column, rules: list[Rule | str]) -> Column:
    """The rules in order. Null stays null. Names of functions stand for themselves: lower, trim, tighten."""
    named = {"lower": F.lower, "trim": F.trim, "tighten": tighten}

    def step(x: Column, r: Rule | str) -> Column:
        if isinstance(r, str):
            return named[r](x)
        return replace_all(x, r.pattern, r.replacement) if r.every else replace_first(x, r.pattern, r.replacement)

    return reduce(step, rules, c)


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rewrite_sql(c: str, rules: list[Rule | str]) -> str:
    """The same as an expression of DuckDB's SQL, whose regular expressions are RE2's."""

    def step(x: str, r: Rule | str) -> str:
        if r == "tighten":
            # one blank of each run goes per pass, marked so that the words keep their border
            for _ in range(6):
                x = f"regexp_replace({x}, '(^|[^\\w])(\\w) +(\\w)(\\s|$)', '\\1\\2' || chr(1) || '\\3\\4', 'g')"
            return f"replace({x}, chr(1), '')"
        if isinstance(r, str):
            return f"{r}({x})"
        return f"regexp_replace({x}, {quoted(r.pattern)}, {quoted(r.replacement)}" + (", 'g')" if r.every else ")")

    return reduce(step, rules, c)
