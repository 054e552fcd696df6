"""License scan: Dice coefficient over word bigrams against licence templates.

A document is compared in units: each line, each paragraph of several lines
(blank lines part them) and the whole text, normalised to lower-case words.  A unit's set of word
bigrams A matches template B if 2|A∩B| / (|A|+|B|) reaches ``MIN_DICE``.  That
bounds the sizes, t/(2-t)·|B| <= |A| <= (2-t)/t·|B|, and what is common: at least
t/(2-t)·|B| of B's bigrams.  So of any |B| - t/(2-t)·|B| + 1 of B's bigrams a match holds one.
Those with the rarest words are B's telling bigrams: units meet templates by a join on them, under the
size bounds, and units without any meet none, however many templates there are.

A notice that is only a part of its line or paragraph is found by word windows:
every run of at most (2-t)/t·|B| bigrams that starts at one of B's bigrams, in
documents that hold the t/(2-t)·|B| of B's bigrams that a match needs.  Units that
match the template are left out of its windows.  Every notice of a document
is a "window" row of its own: of windows that share words the best one counts (the
first, and the shortest, of equal ones); unit_no is its first word.

Defined cases: null and wordless texts match nothing; texts of one word have
no bigram and match nothing; each template that a unit or window matches gives
a row, also where their scores or texts are the same; repeated rows are judged
one by one; an empty input gives no rows.  The output has the key and the operator's own columns only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.llm._scratch import written

MIN_DICE = 0.8
#: Stands for words that a matching unit has taken; no template has it.
TAKEN = "xxtakenxx"
#: Words of any text: taken last where words that tell of a template are chosen (speed only).
COMMON = {"a", "all", "and", "any", "as", "at", "be", "by", "can", "for", "following", "general", "in", "included", "including", "is", "may", "not", "of", "on", "one", "or",
          "otherwise", "particular", "provided", "public", "shall", "source", "subject", "that", "the", "this", "to", "under", "version", "was", "with", "work", "you"}

# Parts that several of the public texts below have in common.
_MIT_END = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
            "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_BSD_TWO = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
            "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
            "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
            "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu_header(name: str) -> str:
    """The three paragraphs that the GNU licences ask for at the head of a file."""
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the {name} for more details. You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>.")


# Public licence notices, headers and short licence texts, with their class.
TEMPLATES: dict[str, tuple[str, str]] = {
    "apache-2.0-notice": ("permissive", "Licensed under the Apache License, Version 2.0."),
    "apache-2.0-header": ("permissive", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "mit-notice": ("permissive", "Released under the MIT License."),
    "mit-text": ("permissive", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc-text": ("permissive", _ISC),
    "gpl-3.0-notice": ("copyleft", "This work is licensed under the GNU General Public License, version 3."),
    "gpl-header": ("copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "mpl-2.0-notice": ("copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "cc-by-4.0-notice": ("attribution", "Licensed under CC BY 4.0."),
    "cc-by-sa-4.0-notice": ("attribution", "Licensed under CC BY-SA 4.0."),
    "cc-by-nc-4.0-notice": ("restricted", "Licensed under CC BY-NC 4.0."),
    "cc-by-4.0-line": ("attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "all-rights-reserved": ("restricted", "All rights reserved."),
    "isc-full": ("permissive", _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "bsd-2-clause": ("permissive", _BSD_TWO + _BSD_END),
    "bsd-3-clause": ("permissive", _BSD_TWO + _BSD_THIRD + _BSD_END),
    "bsd-notice": ("permissive", "Released under the BSD License."),
    "bsd-style-notice": ("permissive", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    "zlib": ("permissive", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    "bsl-1.0": ("permissive", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "unlicense": ("public-domain", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + _MIT_END + " For more information, please refer to <https://unlicense.org>"),
    "cc0-notice": ("public-domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "cc-by-sa-4.0-line": ("attribution", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc-4.0-line": ("restricted", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "gpl-header-full": ("copyleft", _gnu_header("GNU General Public License")),
    "lgpl-header-full": ("copyleft", _gnu_header("GNU Lesser General Public License")),
    "agpl-header-full": ("copyleft", _gnu_header("GNU Affero General Public License")),
    # the line for MIT has three bigrams, of which two are those of all such lines: it would match each of them
    **{f"spdx-{x.lower()}": (c, f"SPDX-License-Identifier: {x}") for c, names in {
        "permissive": ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause"),
        "copyleft": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "AGPL-3.0-only", "MPL-2.0")}.items() for x in names},
}


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i))))


def _pairs(text: str) -> list[tuple[str, str]]:
    w = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(zip(w, w[1:])))


def _telling_pairs(text: str, min_dice: float) -> list[tuple[str, str]]:
    """One bigram more than a match can miss, of the template's longest and least common words."""
    pairs = sorted(_pairs(text), key=lambda p: (sum(x in COMMON for x in p), -len(p[0]) - len(p[1]), p))
    return pairs[:len(pairs) - math.ceil(len(pairs) * min_dice / (2 - min_dice) - 1e-9) + 1]


def _templates(spark, templates: dict[str, tuple[str, str]], min_dice: float) -> DataFrame:
    """One row per telling bigram g of a template: license, class, its grams and telling bigrams, sizes of what can match.  Fixed by the parameter, not by data."""
    given = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(c).alias("license_class"), F.lit(t).alias("t"), F.lit(";".join(" ".join(p) for p in _telling_pairs(t, min_dice))).alias("tell"))
                      for n, (c, t) in templates.items()])
    one = spark.range(1).select(F.explode(given).alias("x")).select("x.license", "x.license_class", F.transform(F.array(_words(F.col("x.t"))), _bigrams)[0].alias("grams"),
                                                                    F.transform(F.split("x.tell", ";"), lambda p: F.xxhash64(F.split_part(p, F.lit(" "), F.lit(1)), F.split_part(p, F.lit(" "), F.lit(2)))).alias("tells"))
    n = F.size("grams")
    return one.withColumns({"least": F.ceil(n * F.lit(min_dice / (2 - min_dice)) - 1e-9).cast("int"), "most": F.floor(n * F.lit((2 - min_dice) / min_dice) + 1e-9).cast("int"), "g": F.explode("tells")})


def _met(rows: DataFrame, own: str, table: DataFrame, tells: list[int]) -> DataFrame:
    """Each row once with every template of which its bigrams ``own`` hold a telling one."""
    hits = F.expr(f"array_distinct(filter({own}, g -> g IN ({', '.join(f'{x}L' for x in tells)})))")
    # explode_outer, as explode would add a filter that makes the bigrams twice; a template is met at the first of its hits
    told = rows.withColumn("hits", hits).withColumn("g", F.explode_outer("hits"))
    return told.join(F.broadcast(table), "g").where(F.get(F.array_intersect("hits", "tells"), F.lit(0)) == F.col("g")).drop("g", "hits", "tells")


def _telling_words(templates: dict[str, tuple[str, str]], min_dice: float) -> list[str]:
    """Words of which a text with a window of any template has at least one: those of a template touch more bigrams than a match can miss."""
    out: set[str] = set()
    for _, t in templates.values():
        grams = {*_pairs(t)}
        touched: set = set()
        for x in sorted({x for g in grams for x in g}, key=lambda x: (x in COMMON, x not in out, -len(x), x)):
            if len(touched) > len(grams) * (1 - min_dice / (2 - min_dice)) + 1e-9:
                break
            touched |= {g for g in grams if x in g}
            out.add(x)
    return sorted(out)


def _tells(words: Column, templates: dict[str, tuple[str, str]], min_dice: float) -> Column:
    """Whether there is a telling word: without one no template can match, so no bigram need be built."""
    return F.arrays_overlap(words, F.split(F.lit(" ".join(_telling_words(templates, min_dice))), " "))


def _windows(some: DataFrame, table: DataFrame, tells: list[int], min_dice: float) -> DataFrame:
    """The windows of each (document, template) outside the units that match, none across another with a better score."""
    in_order = lambda w: F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i))))
    n = F.size("grams")
    enough = lambda grams: F.size(F.array_intersect(grams, F.col("grams"))) >= n * F.lit(min_dice / (2 - min_dice)) - 1e-9
    met = _met(some.select("key", "t", F.transform(F.array(_words(F.col("t"))), in_order)[0].alias("all")), "all", table, tells).where(enough(F.col("all")))
    # words of units that match become another word, so that all places stay what they are
    dice = lambda w: F.transform(F.array(_bigrams(w)), lambda own: F.lit(2.0) * F.size(F.array_intersect(own, F.col("grams"))) / (F.size(own) + n))[0]
    matches = lambda t: F.transform(F.array(_words(t)), lambda w: F.when(F.size(w) > 1, dice(w)).otherwise(0.0) >= F.lit(min_dice))[0]
    out_of = lambda t, found: F.when(found, F.regexp_replace(t, r"[\p{L}\p{N}]+", TAKEN)).otherwise(t)
    lines = lambda t: F.array_join(F.transform(F.split(t, "\n", -1), lambda x: out_of(x, matches(x))), "\n")
    blocks = F.array_join(F.transform(F.split("t", "(?=\n[\\x20\\t\\r]*\n)", -1), lambda x: out_of(x, F.contains(F.btrim(x, F.lit("\n \t\r")), F.lit("\n")) & matches(x))), "")
    rest = out_of(blocks, F.col("t").rlike("\n[\\x20\\t\\r]*\n") & matches(F.col("t")))
    # written, as a filter on what follows would be pushed below and make it all twice; few documents come so far
    met = written(met.select("key", "license", "license_class", "grams", F.transform(F.array(_words(lines(rest))), in_order)[0].alias("all")), "license-words").where(enough(F.col("all")))
    most = F.floor(n * F.lit((2 - min_dice) / min_dice) + 1e-9).cast("int")  # as in the table of templates

    def grown(run: Column) -> Column:
        """Greatest Dice of the windows that start with the run, and the bigrams of the shortest one that has it."""
        seen = F.transform(run, lambda g, j: F.struct((F.array_position(run, g) == j + 1).cast("int").alias("new"), F.array_contains("grams", g).cast("int").alias("hit")))

        def step(s: Column, f: Column) -> Column:
            own, common, size = s["own"] + f["new"], s["common"] + f["new"] * f["hit"], s["size"] + 1
            d = F.lit(2.0) * common / (own + n)
            better = d > s["best"]["dice"]
            best = F.when(better, F.struct(d.alias("dice"), size.alias("size"))).otherwise(s["best"])
            return F.struct(own.alias("own"), common.alias("common"), size.alias("size"), best.alias("best"))

        first = F.struct(F.lit(0).alias("own"), F.lit(0).alias("common"), F.lit(0).alias("size"), F.struct(F.lit(0.0).alias("dice"), F.lit(0).alias("size")).alias("best"))
        return F.aggregate(seen, first, step, lambda s: s["best"])

    starts = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.array_contains("grams", F.get("all", i)))
    scored = F.transform(starts, lambda i: F.transform(F.array(F.transform(F.array(F.slice("all", i + 1, most)), grown)[0]), lambda g: F.struct((-g["dice"]).alias("less"), i.alias("at"), g["size"].alias("size")))[0])
    good = F.array_sort(F.filter(scored, lambda w: w["less"] <= -F.lit(min_dice)))
    # best first, at equal scores the first; a window of k bigrams has k + 1 words
    apart = lambda w, taken: ~F.exists(taken, lambda x: (w["at"] <= x["at"] + x["size"]) & (x["at"] <= w["at"] + w["size"]))
    choose = lambda s: F.aggregate(s, F.slice(s, 1, 0), lambda taken, w: F.when(apart(w, taken), F.concat(taken, F.array(w))).otherwise(taken))
    kept = F.transform(F.array(good), choose)[0]
    return met.select("key", "license", "license_class", F.explode_outer(kept).alias("w")).where("w is not null").select("key", F.lit("window").alias("unit"), F.col("w.at").alias("unit_no"), "license", "license_class", (-F.col("w.less")).alias("dice"))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", min_dice: float = MIN_DICE, templates: dict[str, tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per matching (unit, template): key, unit (line, paragraph, document or window), unit_no, license, license_class, dice."""
    body = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    body = body.where(_tells(_words(F.col("t")), templates, min_dice))
    lines = F.transform(F.split("t", "\n", -1), lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("unit_no"), x.alias("t")))
    blocks = F.filter(F.transform(F.split("t", "\n[\\x20\\t\\r]*\n", -1), lambda x, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("unit_no"), x.alias("t"))), lambda x: F.contains(x["t"], F.lit("\n")))
    whole = F.when(F.contains("t", F.lit("\n\n")) | F.col("t").rlike("\n[\\x20\\t\\r]*\n"), F.array(F.struct(F.lit("document").alias("unit"), F.lit(0).alias("unit_no"), F.col("t").alias("t"))))
    # explode_outer, as explode would add a filter that makes the units twice
    every = F.concat(lines, blocks, F.coalesce(whole, F.array().cast("array<struct<unit:string,unit_no:int,t:string>>")))
    units = body.select("key", F.explode_outer(every).alias("u")).select("key", "u.*")
    table = _templates(docs.sparkSession, templates, min_dice)
    tells = sorted(r["g"] for r in table.select("g").distinct().collect())  # of the parameter, as the table
    # before any bigram is built: n distinct bigrams need n + 1 words and at most n + 1 distinct ones
    sizes = [len(_pairs(t)) for _, t in templates.values()]
    least, most = min(sizes) * min_dice / (2 - min_dice), max(sizes) * (2 - min_dice) / min_dice
    fits = lambda w: (F.size(w) > 1) & (F.size(w) >= F.lit(least + 1)) & (F.size(F.array_distinct(w)) - 1 <= F.lit(most))
    own = F.transform(F.array(_words(F.col("t"))), lambda w: F.when(fits(w) & _tells(w, templates, min_dice), _bigrams(w)))[0]
    counted = units.select("key", "unit", "unit_no", own.alias("own")).withColumn("size", F.size("own"))
    met = _met(counted, "own", table, tells).where(F.col("size").between(F.col("least"), F.col("most")))
    dice = F.lit(2.0) * F.size(F.array_intersect("own", "grams")) / (F.col("size") + F.size("grams"))
    found = met.withColumn("dice", dice).where(F.col("dice") >= F.lit(min_dice)).select("key", "unit", "unit_no", "license", "license_class", "dice")
    return found.unionByName(_windows(body, table, tells, min_dice)).withColumnRenamed("key", key)
