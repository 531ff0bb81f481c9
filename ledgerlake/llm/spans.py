"""Spans of regular expressions as SQL expressions: all matches of a pattern with their
places in code points, without Python.

``split`` gives the gaps between the matches of a pattern and ``regexp_extract_all`` the
matches; the running sum of both lengths places every match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for a separator inside a number or a dot inside a host name, see joined().
JOINT = "\x01"


def found(text: Column, pattern: str, worth: Column | None = None, group: int = 0) -> Column:
    """array<struct<s int, e int, hit string, sub string>> of the leftmost, non-overlapping
    matches; ``sub`` is ``group`` of each. ``worth``: a cheap test; texts that fail it have no match."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    subs = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.zip_with(F.zip_with(hits, subs, lambda h, s: F.struct(h.alias("h"), s.alias("s"))),
                       F.slice(gaps, F.lit(1), F.size(hits)),
                       lambda p, g: F.struct(g.alias("g"), p["h"].alias("h"), p["s"].alias("s")))
    row = "struct<s:int,e:int,hit:string,sub:string>"
    none = F.array().cast(f"array<{row}>")

    def place(done, x):
        start = done["at"] + x["g"]
        end = start + F.length(x["h"])
        one = F.struct(start.alias("s"), end.alias("e"), x["h"].alias("hit"), x["s"].alias("sub")).cast(row)
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    placed = F.aggregate(steps, zero, place, lambda done: done["out"])
    return placed if worth is None else F.when(worth, placed).otherwise(none)


def joined(text: Column, between: str, joint: str) -> Column:
    """``text`` with each ``joint`` character that stands between two characters of class
    ``between`` replaced by JOINT (a JOINT of the text itself becomes \\x02 first). Code
    points keep their places, and ``x([joint]?x)+`` becomes a run of one character class, which
    Java's matcher walks without recursion however long it is."""
    return F.regexp_replace(F.translate(text, JOINT, "\x02"), f"(?<={between}){joint}(?={between})", JOINT)


def marked(spans: Column, kind: int) -> Column:
    """The spans as struct(s, k, e), which sorts by start, then kind."""
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, every second digit counts as its double's digit sum."""
    doubled = F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def weight(d: Column, i: Column) -> Column:
        value = F.coalesce(d.try_cast("int"), F.lit(0))  # the split's last part is empty
        return F.when(i % 2 == 0, value).otherwise(F.element_at(doubled, value + 1))

    digits_back = F.split(F.reverse(number), "")
    return F.aggregate(F.transform(digits_back, weight), F.lit(0), lambda total, x: total + x) % 10 == 0
