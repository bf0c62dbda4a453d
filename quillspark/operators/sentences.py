"""Sentence splitting and lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import ABBREVIATIONS
from quillspark.functions.text import MARK, alternation, between, count_below, let, running, strip

DIGIT = r"[\p{Nd}²³¹]"
#: The end of a sentence with the spaces behind it: no digit or lower-case letter right behind the mark, an upper-case
#: letter or digit behind the spaces, and no abbreviation before it.
BOUNDARY = rf"[.!?](?<!(?<!\p{{L}})(?i:{alternation(ABBREVIATIONS)})[.!?])(?!\p{{IsLowercase}}|{DIGIT})[ \t\r]*(?=\p{{IsUppercase}}|{DIGIT})"


def split_sentences(text: Column) -> Column:
    """Sentences as array of (start, end, text, gap): ends hold the spaces behind; paragraphs (blank lines) end one, too, without them.

    ``gap`` is what lies between a sentence and the next one: nothing but white space.
    """
    segments = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), f"({BOUNDARY})|(\n\n)", f"$1{MARK}$2{MARK}"), MARK, -1)
    # contents and separators take turns; a separator is empty behind a sentence mark
    trimmed = lambda s: F.regexp_replace(s, r"[ \t\r\n]+\z", "")

    def split_up(x: Column) -> Column:
        all_, marked = x["parts"], x["marked"]
        at = lambda i: F.coalesce(F.get(all_, i), F.lit(""))
        starts = running(F.transform(all_, lambda s: F.length(s)))

        def sentence(s: Column, start: Column, i: Column) -> Column:
            kept = F.when(F.get(all_, i + 1) == "", s).otherwise(trimmed(s))
            behind = F.when(at(i + 2).rlike(r"\A[ \t\r\n]*\z"), F.concat(at(i + 2), at(i + 3))).otherwise("")

            def made(k: Column) -> Column:
                gap = F.concat(F.substring(s, F.length(k) + 1, F.length(s)), at(i + 1), behind)
                said = F.when(marked, between(text, start, start + F.length(k))).otherwise(k)  # marks were blanked out
                return F.struct(start.alias("start"), (start + F.length(k)).alias("end"), said.alias("text"), gap.alias("gap"))

            return let(kept, made)

        placed = F.zip_with(all_, starts, lambda s, x: F.struct(s.alias("s"), x.alias("x")))
        every = F.transform(placed, lambda p, i: F.when(i % 2 == 0, sentence(p["s"], p["x"], i)))
        return F.filter(every, lambda s: s["end"] > s["start"])

    return let(F.struct(segments.alias("parts"), F.contains(text, F.lit(MARK)).alias("marked")), split_up)


def sentence_at(sentences: Column, position: Column) -> Column:
    """The index of the sentence that holds a position; the first for positions before all, else the last. 0 without sentences."""
    last = F.greatest(F.size(sentences) - 1, F.lit(0))
    found = count_below(sentences, position + 1, lambda s: s["start"]) - 1
    return let(found, lambda i: F.when(i < 0, 0).when(position < F.get(sentences, i)["end"], i).otherwise(last))


def sentence_span(text: Column, sentences: Column, first: Column, last: Column) -> Column:
    """The stripped sentences from one index to another (either order), joined by spaces."""
    low, high = F.least(first, last), F.greatest(first, last)
    parts = F.transform(F.slice(sentences, low + 1, high - low + 1), lambda s: strip(between(text, s["start"], s["end"])))
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def fallback_span(text: Column, start: Column, end: Column, reach: int = 800) -> Column:
    """The text around a span up to the nearest . ! ? or line feed on each side, at most ``reach`` characters away."""
    before = between(text, F.greatest(start - reach, F.lit(0)) + 1, start + 1)
    head = F.regexp_extract(before, r"([^.!?\n]*)\z", 1)
    head = F.when(F.length(head) == F.length(before), between(text, F.greatest(start - reach, F.lit(0)), start + 1)).otherwise(head)
    behind = between(text, end, end + reach)
    return strip(F.concat(head, between(text, start + 1, end), F.regexp_extract(behind, r"\A([^.!?\n]*[.!?\n]?)", 1)))
