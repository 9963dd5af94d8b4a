"""People lists: splitting, prefixes, tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles in front of names, and the spellings of a junior's suffix in the order in which they are tried.
PREFIXES = ("DR.", "PROFESSOR", "SENATOR", "LORD", "BRIG. GENERAL (RET)", "MAYOR")
JUNIOR = (", Jr.;", ",Jr.;", " Jr.;", ", Jr.,", ",Jr.,", " Jr.,", ", Jr.", ", Jr,", " Jr.", " Jr,")
_MARK = "--JRS--"


def split_people(text: Column) -> Column:
    """'A, B, and C' to [A, B, C]; null to [], '' to ['']. A junior's suffix stays with its name as ' Jr.'."""
    bare = F.btrim(text, F.lit("],["))
    joined = F.replace(F.replace(F.replace(bare, F.lit(" & "), F.lit(",")), F.lit(" and "), F.lit(",")), F.lit(",,"), F.lit(","))
    marked = joined
    for spelling in JUNIOR:
        marked = F.replace(marked, F.lit(spelling), F.lit(_MARK + ","))
    for ending in (", Jr", ",Jr"):
        marked = F.when(marked.endswith(ending), F.replace(marked, F.lit(ending), F.lit(_MARK + ","))).otherwise(marked)

    def one(part: Column) -> Column:
        named = F.replace(F.trim(part), F.lit(_MARK), F.lit(" Jr."))
        return F.trim(F.when(named.endswith("Jr"), F.replace(named, F.lit("Jr"), F.lit(" Jr."))).otherwise(named))

    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.transform(F.split(marked, ","), one))


def strip_prefix(name: Column, prefixes=PREFIXES) -> Column:
    """The first of the prefixes that the name starts with, in any case, is removed once."""
    pattern = "(?i)^(?:" + "|".join(map(re.escape, prefixes)) + ")"
    return F.trim(F.regexp_replace(F.trim(name), pattern, ""))


def name_tokens(names: Column) -> Column:
    """Of each name: its first word, first two, ..., all, and its last word; lower-cased, distinct, in order."""

    def of(name: Column) -> Column:
        words = F.filter(F.split(F.lower(F.trim(name)), r"\s+"), lambda w: w != "")
        leads = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " "))
        return F.when(F.size(words) > 0, F.concat(leads, F.array(F.element_at(words, -1)))).otherwise(F.array().cast("array<string>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(names, of))))


def distinct_people(*lists: Column) -> Column:
    """All people of several lists once, in order, without empty names."""
    return F.array_sort(F.array_distinct(F.filter(F.concat(*lists), lambda x: ~x.isin("", " "))))
