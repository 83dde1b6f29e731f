"""Licence scans by Dice coefficient over word bigrams.

Texts are normalised to lower-case words. Each line, each paragraph of several
lines, and each text of several paragraphs is a unit; a unit's distinct word
bigrams are compared with those of the licence templates. Two sets whose sizes
differ too much cannot reach the least Dice coefficient, so a unit meets only
the templates within its size bounds. Each document is judged in its own row:
nothing is joined or shuffled. Spark expressions only.

A longer template is also looked for in runs of consecutive lines, over blank
lines too, in texts that hold enough of its bigrams to reach the least Dice
coefficient at all.
"""

from __future__ import annotations

import json
import re
from fractions import Fraction
from pathlib import Path

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of

MIN_DICE = 0.8

# Fixed texts: common licences and their customary notices.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.""",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "GPL-3.0-or-later notice": """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "BSD-3-Clause line": "Released under the BSD 3-Clause License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "CC-BY-4.0 line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0 line": "Licensed under CC BY-NC-SA 4.0.",
    "CC0-1.0 line": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "All rights reserved line": "All rights reserved. No part of this work may be reproduced without permission.",
    # the customary variants that no text above reaches
    "All rights reserved short line": "All rights reserved.",
    "All rights reserved copying line": "All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    "MIT licensed line": "Licensed under the MIT License.",
    "MIT project line": "This project is licensed under the MIT License.",
    "MIT distributed line": "Distributed under the MIT License.",
    "MIT title line": "The MIT License (MIT)",
    "Apache-2.0 short line": "Licensed under the Apache License 2.0.",
    "BSD-2-Clause line": "Released under the BSD 2-Clause License.",
    "GPL-3.0 released line": "Released under the GNU General Public License, version 3.",
    "GPL-3.0 short line": "Licensed under the GNU GPL v3.",
    "GPL-3.0 later line": "Licensed under the GNU General Public License, version 3 or later.",
    "GPL-2.0 released line": "Released under the GNU General Public License, version 2.",
    "GPL-2.0 short line": "Licensed under the GNU GPL v2.",
    "LGPL-3.0 released line": "Released under the GNU Lesser General Public License, version 3.",
    "MPL-2.0 line": "Licensed under the Mozilla Public License, version 2.0.",
    "MPL-2.0 short line": "Licensed under the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0 work line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 work line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 work line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0 work line": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-4.0 short work line": "This work is licensed under CC BY 4.0.",
    "CC0-1.0 dedication line": "This work is dedicated to the public domain under CC0 1.0.",
}

# the full texts
TEMPLATES["BSD-3-Clause"] = TEMPLATES["BSD-2-Clause"].replace("THIS SOFTWARE IS", """3. Neither the name of the copyright holder
nor the names of its contributors may be used to endorse or promote products derived from this software without specific
prior written permission. THIS SOFTWARE IS""", 1)
TEMPLATES |= {x.stem: x.read_text("utf-8") for x in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

#: Templates of fewer bigrams are lines, which aren't looked for in runs of lines.
LEAST_RUN = 20
_NOT_WORD = r"[^\p{L}\p{N}]+"
_GAP = r"\n[\x20\x09-\x0D]*\n"


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).strip().split()


def _gram(a: str, b: str) -> int:
    h = xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))
    return h - (1 << 64) if h >> 63 else h


def _table(rows: list[dict], schema: str) -> Column:
    """The templates as one constant, which the optimizer reads once: as many
    literals as they have bigrams would take seconds to plan."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")


def size_bounds(n: int, least: float) -> tuple[int, int]:
    """The set sizes that can reach a Dice coefficient of ``least`` with ``n``."""
    t = Fraction(str(least))
    return -(-n * t.numerator // (2 * t.denominator - t.numerator)), n * (2 * t.denominator - t.numerator) // t.numerator


def _bigrams(units: Column) -> Column:
    """Hashes of the distinct word bigrams of each text of an array. Each step
    binds its value to a lambda, so that it is worked out once a unit."""
    words = F.transform(units, lambda x: F.split(F.trim(F.regexp_replace(F.lower(x), _NOT_WORD, " ")), " "))
    return F.transform(words, lambda ws: F.array_distinct(F.transform(
        F.slice(ws, 1, F.size(ws) - 1), lambda w, i: F.xxhash64(w, F.get(ws, i + 1)))))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = MIN_DICE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, license, dice, unit (line, paragraph, text or
    lines, a run of them) and place (its number from 0, of a run its first line's).

    Null and empty texts, and units of fewer than two words, match nothing. A
    unit may match several templates, and a document one template in several
    places: all are returned. Repeated rows repeat their matches. Other columns
    are left out."""
    known = []
    for name, text in sorted(templates.items()):
        words = template_words(text)
        grams = sorted({_gram(a, b) for a, b in zip(words, words[1:])})
        if grams:
            low, high = size_bounds(len(grams), least)
            known.append({"license": name, "grams": grams, "n": len(grams), "low": low, "high": high})
    text = text_of(text_col)
    lines, paragraphs = F.split(text, "\n"), F.split(text, _GAP)
    several = F.filter(F.transform(paragraphs, lambda x, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("place"), x.alias("t"))),
                       lambda p: F.instr(p["t"], "\n") > 0)
    whole = F.when(F.size(paragraphs) > 1, F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("place"), text.alias("t"))))
    units = F.concat(F.transform(lines, lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("place"), x.alias("t"))),
                     several, F.coalesce(whole, F.filter(several, lambda p: F.lit(False))))
    table = _table(known, "license string, grams array<bigint>, n int, low int, high int")

    def matches(u):
        n = F.size(u["grams"])
        near = F.filter(table, lambda t: n.between(t["low"], t["high"]))
        met = F.transform(near, lambda t: F.struct(
            t["license"].alias("license"),
            (F.lit(2.0) * F.size(F.array_intersect(u["grams"], t["grams"])) / (n + t["n"])).alias("dice"),
            u["unit"].alias("unit"), u["place"].alias("place")))
        return F.filter(met, lambda m: m["dice"] >= least)

    grams = F.arrays_zip(F.col("units.unit").alias("unit"), F.col("units.place").alias("place"), _bigrams(F.col("units.t")).alias("grams"))
    found = (docs.select(F.col(id_col).alias("doc_id"), units.alias("units"))
             .select("doc_id", F.explode(F.flatten(F.transform(grams, matches))).alias("m")))
    found = found.select("doc_id", "m.license", "m.dice", "m.unit", "m.place")
    return found.unionByName(_runs(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")), templates, least))


def _bound(df: DataFrame, *cols: Column) -> DataFrame:
    """Columns worked out once a row: no later expression takes them in."""
    return df.select(F.explode(F.array(F.struct(*cols))).alias("x")).select("x.*")


#: Items of a chunk of running sums.
SUM_CHUNK = 512


def _summed(df: DataFrame, **arrays: Column) -> DataFrame:
    """``df`` with the running sums of arrays of whole numbers, from 0 on (one
    item more than the array). Chunks are summed by themselves, then their
    totals, so the work follows the length and not its square."""
    old, names = [F.col(x) for x in df.columns], list(arrays)
    text = lambda tag: [F.col(f"{n}{tag}") for n in names]
    fold = lambda xs: F.aggregate(xs, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    df = _bound(df, *old, *[x.alias(f"{n}_x") for n, x in arrays.items()])

    def chunks(x: str) -> Column:
        last = F.floor(F.greatest(F.size(x) - 1, F.lit(0)) / SUM_CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: fold(F.slice(x, k * SUM_CHUNK + 1, SUM_CHUNK)))
    df = _bound(df, *old, *[chunks(f"{n}_x").alias(f"{n}_c") for n in names])
    df = _bound(df, *old, *text("_c"), *[fold(F.transform(f"{n}_c", lambda c: F.element_at(c, -1))).alias(f"{n}_t") for n in names])

    def whole(n: str) -> Column:
        return F.concat(F.array(F.lit(0)), F.flatten(F.transform(f"{n}_c", lambda c, i: F.transform(
            F.slice(c, 2, SUM_CHUNK), lambda v: v + F.get(F.col(f"{n}_t"), i)))))
    return _bound(df, *old, *[whole(n).alias(n) for n in names])


def _runs(docs: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    """The matches of runs of two lines or more: of those that overlap the best
    one (of equal ones the shortest, then first), and none that overlaps a
    paragraph, or lies in a text, that matches the template by itself.

    A run's places of bigrams lie between the template's least size and its
    largest, times the template's own repeats; it begins and ends with a line
    that shares a bigram with the template."""
    t = Fraction(str(least))
    known = []
    for name, text in sorted(templates.items()):
        words = template_words(text)
        places = [_gram(a, b) for a, b in zip(words, words[1:])]
        grams = sorted(set(places))
        if len(grams) >= LEAST_RUN:
            low, high = size_bounds(len(grams), least)
            # 2 x / (n + size) >= t and size >= x
            need = -(-len(grams) * t.numerator // (2 * t.denominator - t.numerator))
            known.append({"license": name, "grams": grams, "n": len(grams), "need": need, "low": low, "high": -(-high * len(places) // len(grams))})
    if not known:
        return docs.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("dice"), F.lit("").alias("unit"), F.lit(0).alias("place")).filter("false")
    split = lambda x: F.filter(F.split(F.trim(F.regexp_replace(F.lower(x), _NOT_WORD, " ")), " "), lambda w: w != "")
    pairs = lambda ws: F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(ws, i + 1)))
    c = F.col
    df = _bound(docs.filter(F.instr("text", "\n") > 0), c("doc_id"), c("text"), split(c("text")).alias("words"))
    df = _bound(df, c("doc_id"), c("text"), pairs(c("words")).alias("g"))
    df = _bound(df, c("doc_id"), c("text"), c("g"), F.array_distinct("g").alias("own"))
    near = F.filter(_table(known, "license string, grams array<bigint>, n int, need int, low int, high int"), lambda k: F.when(F.size("own") >= k["need"], F.size(F.array_intersect(c("own"), k["grams"])) >= k["need"]).otherwise(False))
    # few texts are left
    df = df.select("doc_id", "text", "g", "own", F.explode(near).alias("k"))
    df = df.filter(F.lit(2.0) * F.size(F.array_intersect("own", "k.grams")) / (F.size("own") + c("k.n")) < least)
    same = F.array_intersect("own", "k.grams")
    df = _bound(df, c("doc_id"), c("k"), c("g"), same.alias("same"), F.transform(F.split("text", "\n"), lambda x: F.size(split(x))).alias("sizes"),
                F.transform(F.split("text", _GAP), lambda x: split(x)).alias("parts"))
    alone = F.transform(F.transform("parts", lambda p: F.array_distinct(pairs(p))), lambda p: F.lit(2.0) * F.size(
        F.array_intersect(p, c("k.grams"))) / (F.size(p) + c("k.n")) >= least)
    df = _bound(df, c("doc_id"), c("k"), c("g"), c("sizes"), alone.alias("alone"), F.transform("parts", F.size).alias("part_sizes"),
                F.transform("g", lambda x: F.array_contains("same", x).cast("int")).alias("hit"))
    df = _summed(df, edges=c("part_sizes"), starts=c("sizes"), hits=c("hit"))
    taken = F.filter(F.transform("alone", lambda x, i: F.struct(x.alias("is"), F.get("edges", i).alias("from"), F.get("edges", i + 1).alias("to"))), lambda x: x["is"])
    df = _bound(df, c("doc_id"), c("k"), c("g"), c("starts"), taken.alias("taken"), F.size("starts").alias("n_starts"), c("hits"))
    at = lambda xs, i: F.get(c(xs), i)
    # the hits of the bigrams that begin in a line (the last word has none after it)
    upto = lambda i: at("hits", F.least(i, F.size("g")))
    shares = F.filter(F.sequence(F.lit(0), c("n_starts") - 2), lambda i: upto(at("starts", i + 1)) > upto(at("starts", i)))
    # a last line may end the run by the bigram that leads into it
    ends = F.transform(F.sequence(F.lit(0), c("n_starts") - 2), lambda i: ((at("starts", i + 1) > at("starts", i)) & (
        upto(at("starts", i + 1) - 1) > upto(F.greatest(at("starts", i) - 1, F.lit(0))))).cast("int"))
    df = _bound(df, c("doc_id"), c("k"), c("g"), c("starts"), c("taken"), c("hits"), shares.alias("firsts"), ends.alias("ends"))
    df = _summed(df, ends_before=c("ends"))
    lasts = F.filter(F.transform("ends", lambda x, i: F.when(x == 1, i)), lambda i: i.isNotNull())
    df = _bound(df, c("doc_id"), c("k"), c("g"), c("starts"), c("taken"), c("hits"), c("firsts"), c("ends_before"), lasts.alias("lasts"))

    def from_line(i):
        begin = at("starts", i)
        size = lambda j: at("starts", j + 1) - begin - 1
        # last lines after this one; each has a word, so no more than the words of the longest run
        later = F.slice("lasts", at("ends_before", i + 1) + 1, c("k.high") + 1)
        fit = F.filter(later, lambda j: (j > i) & size(j).between(c("k.low"), c("k.high")) & (
            upto(at("starts", j + 1) - 1) - upto(begin) >= c("k.need")) & ~F.exists(
                "taken", lambda x: (x["from"] < at("starts", j + 1)) & (begin < x["to"])))

        def judged(j):
            met = F.transform(F.array(F.array_distinct(F.slice(c("g"), begin + 1, size(j)))), lambda u: F.lit(2.0) * F.size(
                F.array_intersect(u, c("k.grams"))) / (F.size(u) + c("k.n")))
            return F.struct((-F.element_at(met, 1)).alias("order"), (j - i).alias("more"), i.alias("first"), j.alias("last"))
        return F.filter(F.transform(fit, judged), lambda m: m["order"] <= -least)
    df = _bound(df, c("doc_id"), c("k.license").alias("license"), F.array_sort(F.flatten(F.transform("firsts", from_line))).alias("met"))
    # from the best on, those that overlap none taken before
    best = F.aggregate("met", F.slice(c("met"), 1, 0), lambda a, m: F.when(
        F.exists(a, lambda b: (b["first"] <= m["last"]) & (m["first"] <= b["last"])), a).otherwise(F.concat(a, F.array(m))))
    df = df.select("doc_id", "license", F.explode(best).alias("m"))
    return df.select("doc_id", "license", (-c("m.order")).alias("dice"), F.lit("lines").alias("unit"), c("m.first").alias("place"))
