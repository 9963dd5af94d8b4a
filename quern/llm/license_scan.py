"""Licence scan: Dice coefficient over word bigrams between normalised text and licence templates, DataFrame functions only.

Units of a document are its lines, its paragraphs and its whole text. Two bigram sets of sizes a, b can reach a coefficient t only
if a (2 - t) >= t b and b (2 - t) >= t a, so a template is compared with units of fitting size only. A unit that matches must
also hold one of a few words of the template: enough of them that the bigrams without them are too few for t. Texts with none of
those words are not split at all. Templates are a fixed list (a literal in the plan): the only thing that is compared with
every candidate unit, and no join is needed.

Units are what the SQL of the query compares. With `windows` the words of the whole text are searched as well, across lines and
paragraphs, so a notice inside a line or wrapped in a longer paragraph is found: a window runs from one bigram of the template to
another one and has as many bigrams as the size bound allows, at most. The bigrams of all windows from one start are counted in one pass, by
the place where each stood last, so the work is at most the template's hits times its size. `embedded` has the templates that a window
reaches, each with its best coefficient (of equal ones the first window); a template is left out if a better one that is no shorter
overlaps its best window.

Normal form: A-Z lower-cased, everything but a-z, 0-9 and dots inside numbers becomes one space.
Defined cases: null, empty and blank texts have no licence; ties of the coefficient go to the template of smaller name; repeated
lines count once in the coefficient and each time in n_units; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: The public wording of licences and licence notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mit-disclaimer": "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}

COMMON = frozenset("a all an and any are as at be by for from in is it law not of on or other so that the this to under use with without you".split())


def plain_words(text: str) -> list[str]:
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", lower)


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def needed(size: int, threshold: float) -> int:
    """The least overlap with a set of this size at which any other set can reach the threshold."""
    return max(1, math.ceil(size * threshold / (2 - threshold) - 1e-9))


def anchor_words(words: list[str], threshold: float) -> set[str]:
    """Words of which every matching unit holds one: the bigrams without them are fewer than any match needs."""
    pairs, chosen = [tuple(x.split(" ")) for x in bigrams(words)], set()
    for word in sorted(set(words), key=lambda w: (w in COMMON, -len(w), w)):
        if sum(not chosen & set(p) for p in pairs) < needed(len(pairs), threshold):
            break
        chosen.add(word)
    return chosen


def anchor_pattern(words: list[str]) -> str:
    """Every text whose normal form holds one of the words matches. '_' ends a word; so does the digit of a number's end before a
    letter ('2.0x' is '2.0' and 'x'), hence a word may begin behind a digit and a number may end before a letter."""
    ends = lambda w: re.escape(w) + ("(?![0-9])" if "." in w else "(?![a-z0-9])")
    return rf"(?i)(?<![a-z])(?:{'|'.join(map(ends, words))})"


def all_bigrams(unit: Column) -> Column:
    lower = F.translate(unit, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(r"([a-z0-9]+(?:\.[0-9]+)*)"), F.lit(1))
    pairs = lambda w: F.when(F.size(w) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda k: F.concat_ws(" ", F.get(w, k), F.get(w, k + 1))))
    return let(words, pairs)


def unit_bigrams(unit: Column) -> Column:
    return F.array_distinct(all_bigrams(unit))


def embedded(text: Column, sets: dict[str, list[str]], threshold: float) -> Column:
    """array<struct<dice, name>> of the templates that a window of the text's words reaches, best first."""
    fixed = F.array(*(F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, s)).alias("grams"), F.lit(needed(len(s), threshold)).alias("least"), F.lit(math.floor(len(s) * (2 - threshold) / threshold + 1e-9)).alias("most")) for n, s in sets.items()))
    def place_before(grams: Column) -> Column:
        """For each bigram the place where the same one stood last, -1 if nowhere: by sorting, not by comparing all."""
        ranked = F.array_sort(F.transform(grams, lambda g, k: F.struct(g.alias("g"), k.alias("k"))))
        last = lambda r, x, k: F.when((k > 0) & (F.get(r, k - 1)["g"] == x["g"]), F.get(r, k - 1)["k"]).otherwise(F.lit(-1))
        placed = let(ranked, lambda r: F.array_sort(F.transform(r, lambda x, k: F.struct(x["k"].alias("k"), last(r, x, k).alias("last")))))
        return F.transform(placed, lambda x: x["last"])

    def search(grams: Column) -> Column:
        def windows(last: Column) -> Column:
            def best_window(t: Column) -> Column:
                def from_flags(hit: Column) -> Column:
                    """From each place of a template's bigram the distinct bigrams are counted once through, as far as a window may reach."""
                    size = F.size(t["grams"])

                    def from_hits(hits: Column) -> Column:
                        """A start is tried only if enough hits for any match lie within reach, and none after a whole match."""
                        near = F.filter(F.transform(hits, lambda i, h: F.when(F.get(hits, h + t["least"] - 1) < i + t["most"], i)), lambda i: i.isNotNull())

                        def from_start(best: Column, i: Column) -> Column:
                            def step(acc: Column, k: Column) -> Column:
                                new = F.get(last, k) < i
                                own = acc["own"] + F.when(new, 1).otherwise(0)
                                shared = acc["shared"] + F.when(new & F.get(hit, k), 1).otherwise(0)

                                def counted(c: Column) -> Column:
                                    dice = 2.0 * c["shared"] / (c["own"] + size)
                                    better = F.get(hit, k) & (dice > acc["dice"])
                                    return F.struct(c["own"].alias("own"), c["shared"].alias("shared"), F.when(better, dice).otherwise(acc["dice"]).alias("dice"), F.when(better, i).otherwise(acc["start"]).alias("start"), F.when(better, k).otherwise(acc["end"]).alias("end"))

                                return let(F.struct(own.alias("own"), shared.alias("shared")), counted)

                            reach = F.sequence(i, F.least(i + t["most"], F.size(grams)) - 1)
                            begin = F.struct(F.lit(0).alias("own"), F.lit(0).alias("shared"), best["dice"].alias("dice"), best["start"].alias("start"), best["end"].alias("end"))
                            return F.when(best["dice"] >= 1.0, best).otherwise(F.aggregate(reach, begin, step, lambda acc: F.struct(acc["dice"].alias("dice"), acc["start"].alias("start"), acc["end"].alias("end"))))

                        nothing = F.struct(F.lit(0.0).alias("dice"), F.lit(0).alias("start"), F.lit(0).alias("end"))
                        return F.aggregate(near, nothing, from_start, lambda best: F.struct(best["dice"].alias("dice"), t["name"].alias("name"), best["start"].alias("start"), best["end"].alias("end")))

                    return let(F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda k: F.get(hit, k)), from_hits)

                return let(F.transform(grams, lambda g: F.array_contains(t["grams"], g)), from_flags)

            return best_window

        def best_of_all(possible: Column) -> Column:
            found = let(place_before(grams), lambda last: F.transform(possible, windows(last)))
            return F.when(F.size(possible) > 0, F.filter(found, lambda x: x["dice"] >= threshold))

        possible = F.filter(fixed, lambda t: F.size(F.array_intersect(grams, t["grams"])) >= t["least"])
        return F.when(F.size(grams) > 0, let(possible, best_of_all))

    def alone(found: Column) -> Column:
        better = lambda f: F.exists(found, lambda g: (g["dice"] > f["dice"]) & (g["end"] - g["start"] >= f["end"] - f["start"]) & (g["start"] <= f["end"]) & (f["start"] <= g["end"]))
        ranked = F.array_sort(F.transform(F.filter(found, lambda f: ~better(f)), lambda f: F.struct((-f["dice"]).alias("less"), f["name"].alias("name"))))
        return F.transform(ranked, lambda f: F.struct((-f["less"]).alias("dice"), f["name"].alias("name")))

    return let(let(all_bigrams(text), search), alone)


def scan(docs: DataFrame, *, id_col="doc_id", text_col="text", threshold: float = 0.8, templates=None, windows: bool = True) -> DataFrame:
    """Per row: doc_id, licence (best match or null), dice, n_units (matching units), licences (all names found in units) and, with
    windows, embedded (templates found anywhere in the text, with their coefficient)."""
    sets = {name: bigrams(plain_words(text)) for name, text in sorted((TEMPLATES if templates is None else templates).items())}
    words = sorted(set().union(*(anchor_words(plain_words(t), threshold) for t in (TEMPLATES if templates is None else templates).values())))
    literal = F.array(*(F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, s)).alias("grams")) for n, s in sets.items()))
    text = F.coalesce(docs[text_col], F.lit(""))
    maybe = text.rlike(anchor_pattern(words))

    def best(unit: Column) -> Column:
        def compared(own: Column) -> Column:
            size = F.size(own)
            fits = F.filter(literal, lambda t: (size * (2 - threshold) >= threshold * F.size(t["grams"])) & (F.size(t["grams"]) * (2 - threshold) >= threshold * size))
            scored = F.transform(fits, lambda t: F.struct((2.0 * F.size(F.array_intersect(own, t["grams"])) / (size + F.size(t["grams"]))).alias("dice"), t["name"].alias("name")))
            good = F.filter(scored, lambda s: s["dice"] >= threshold)
            # the greatest coefficient, then the smaller name: literal is in order of names, so the first of the greatest
            return F.aggregate(good, F.struct(F.lit(0.0).alias("dice"), F.lit(None).cast("string").alias("name")), lambda acc, s: F.when(s["dice"] > acc["dice"], s).otherwise(acc))

        return let(unit_bigrams(unit), compared)

    paragraphs = F.split(text, r"\n[\x20\t\r]*\n")
    units = F.concat(F.split(text, "\n"), F.filter(paragraphs, lambda p: F.contains(p, F.lit("\n"))), F.when(F.size(paragraphs) > 1, F.array(text)).otherwise(F.array().cast("array<string>")))
    found = F.when(maybe, F.filter(F.transform(units, best), lambda s: s["name"].isNotNull())).otherwise(F.array().cast("array<struct<dice:double,name:string>>"))
    top = lambda f: F.aggregate(f, F.struct(F.lit(0.0).alias("dice"), F.lit(None).cast("string").alias("name")), lambda acc, s: F.when((s["dice"] > acc["dice"]) | ((s["dice"] == acc["dice"]) & (s["name"] < acc["name"])), s).otherwise(acc))
    result = let(found, lambda f: F.struct(top(f).alias("best"), F.size(f).cast("long").alias("n_units"), F.array_sort(F.array_distinct(F.transform(f, lambda s: s["name"]))).alias("licences")))
    empty = F.array().cast("array<struct<dice:double,name:string>>")
    inside = [F.when(maybe, F.coalesce(embedded(text, sets, threshold), empty)).otherwise(empty).alias("embedded")] if windows else []
    return docs.select(F.col(id_col).alias("doc_id"), result.alias("r"), *inside).select("doc_id", F.col("r.best.name").alias("licence"), F.when(F.col("r.best.name").isNotNull(), F.col("r.best.dice")).alias("dice"), "r.n_units", "r.licences", *(["embedded"] if windows else []))
