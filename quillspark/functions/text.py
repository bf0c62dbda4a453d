"""Text functions on columns: all matches with offsets, trimming, word boundaries. Offsets count characters from 0."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word boundaries before and behind a word, for letters of any script.
BEFORE = r"(?<![\p{L}\p{N}_])"
BEHIND = r"(?![\p{L}\p{N}_])"
MARK = "\u0001"
#: White space of any script, and the four separators of ASCII.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MENTION = "array<struct<name:string,start:int,end:int>>"


_built: dict[tuple, tuple] = {}


def built_once(make: Callable) -> Callable:
    """Keep what a function makes of hashable arguments, columns included, as long as the JVM runs: large expressions take longer to hand over than to plan."""

    @wraps(make)
    def get(*key: Hashable):
        place, jvm = (make.__module__, make.__qualname__, key), SparkContext._gateway
        if place not in _built or _built[place][0] is not jvm:
            _built[place] = jvm, make(*key)
        return _built[place][1]

    return get


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: lambdas evaluate the expressions in their bodies for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def between(text: Column, start: Column, end: Column) -> Column:
    """The characters from start up to end."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def alternation(words: Iterable[str]) -> str:
    """A pattern for any of some literal words, longest first."""
    quoted = ("".join(f"\\{c}" if not c.isalnum() and c != " " else c for c in w) for w in sorted(set(words), key=lambda w: (-len(w), w)))
    return "|".join(quoted)


def any_of(words: Iterable[str]) -> str:
    """A pattern that is found where any of some literal words occurs as a substring, with common beginnings shared.

    Words that hold another one of them add nothing and are left out.
    """
    least = [w for w in set(words) if not any(o != w and o in w for o in words)]
    return prefix_tree(least)


def prefix_tree(words: Iterable[str]) -> str:
    """A pattern for exactly some literal words, with common beginnings shared."""
    words = sorted(set(words))
    heads = sorted({w[0] for w in words if w})
    quoted = lambda c: c if c.isalnum() or c == " " else f"\\{c}"
    branches = [quoted(c) + prefix_tree(w[1:] for w in words if w[:1] == c) for c in heads]
    if len(branches) > 1 or (branches and "" in words):
        return f"(?:{'|'.join(branches)}){'?' if '' in words else ''}"
    return "".join(branches)


#: Elements that are added up at a stretch.
STRETCH = 64


def running(values: Column) -> Column:
    """For each number of an array the sum of those before it: by stretches, so that the work grows with the array's length and not its square."""
    zero, none = F.lit(0), F.array().cast("array<int>")

    def sums(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def before(xs: Column, first: Column) -> Column:
        return F.aggregate(xs, F.struct(first.alias("at"), none.alias("out")), sums, lambda acc: acc["out"])

    def stretches(all_: Column) -> Column:
        cut = F.transform(F.sequence(zero, F.greatest(F.floor((F.size(all_) - 1) / STRETCH).cast("int"), zero)), lambda b: F.slice(all_, b * STRETCH + 1, F.lit(STRETCH)))
        totals = lambda parts: F.transform(parts, lambda xs: F.aggregate(xs, zero, lambda a, x: a + x))
        return F.when(F.size(all_) <= STRETCH, before(all_, zero)).otherwise(let(cut, lambda parts: F.flatten(F.zip_with(parts, before(totals(parts), zero), before))))

    return let(values, stretches)


def count_below(items: Column, value: Column, key: Callable[[Column], Column]) -> Column:
    """How many elements of an array that is sorted by ``key`` lie below a value: by halving."""
    steps = F.sequence(F.ceil(F.log2(F.size(items) + 1.0)).cast("int"), F.lit(0), F.lit(-1))

    def step(low: Column, bit: Column) -> Column:
        at = low + F.call_function("shiftleft", F.lit(1), bit)
        return F.when((at <= F.size(items)) & (key(F.get(items, at - 1)) < value), at).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def firsts(items: Column, key: Callable[[Column], Column]) -> Column:
    """The first element of each run of equal keys in a sorted array."""
    return let(items, lambda all_: F.filter(all_, lambda x, i: (i == 0) | (key(F.get(all_, i - 1)) != key(x))))


def find_all(text: Column, pattern: str) -> Column:
    """All matches from left to right: array of (name, start, end). The pattern must hold no capturing group.

    Matches are fenced by a mark and the text is split there: every other part is a match, and the lengths of the parts give the offsets.
    """
    parts = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), f"(?U)({pattern})", f"{MARK}$1{MARK}"), MARK, -1)

    def found(all_: Column) -> Column:
        starts = running(F.transform(all_, lambda p: F.length(p)))
        placed = F.zip_with(all_, starts, lambda p, at: F.struct(p.alias("name"), at.alias("start"), (at + F.length(p)).alias("end")))
        return F.filter(placed, lambda _, i: i % 2 == 1)

    return let(parts, found)


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(values: Iterable[str]) -> Column:
    """An array literal, parsed at once: hundreds of single literals take seconds to hand over."""
    return F.expr(f"CAST(array({', '.join(map(sql_string, values))}) AS array<string>)")


def one_of(name: Column, names: Iterable[str] | Column) -> Column:
    """Whether a name is on a list of literals, which share their beginnings in one pattern, or in an array column."""
    if isinstance(names, Column):
        return F.array_contains(names, name)
    listed = [n for n in names if n]
    return name.rlike(rf"\A(?:{prefix_tree(listed)})\z") if listed else F.lit(False)


def count_words(text: Column, words: Iterable[str]) -> Column:
    """How many of the words occur in a text, each counted once."""
    return let(text, lambda t: F.size(F.filter(literals(words), lambda w: F.contains(t, w))))


def lookup(pairs: Iterable[tuple[str, str]]) -> Column:
    """A map literal; take values with try_element_at."""
    return F.expr(f"map({', '.join(sql_string(x) for pair in pairs for x in pair)})")
