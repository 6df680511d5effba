"""Licence notices, found by the Dice coefficient over word bigrams; DataFrame functions only, one row at a time.

Every line of a text is normalised (ASCII lower case, other characters than letters and digits to one space) and compared
with each licence template. Dice is 2 * common / (a + b) over distinct bigrams, so a template of b bigrams can reach the
threshold t only for lines of b * t / (2 - t) to b * (2 - t) / t bigrams: templates outside these bounds are skipped.

A notice that is wrapped, or that shares its line with other words, is found by windows over the words of all lines. A match
has b * t / (2 - t) bigrams in common at least, and trimming a window to its first and last common bigram never lowers Dice,
so only windows between two common bigrams are compared, of the sizes that the bounds allow. Whole licence texts (TEXTS) are too
long for that: a text that has as many of one's bigrams as a match needs is cut where more than GAP bigrams in a row are not
the template's, and each passage between is compared. By the same bound, a text that has none of a few words of the templates
(``gate_words``) has no such window or passage, and is not searched.
Nothing is shuffled: the plan is one scan and one projection at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short notices of public licences (identifier, notice).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("proprietary", "All rights reserved."),
]

_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_MIT_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT '
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR '
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
    "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Whole texts of public licences, and the headers that longer ones ask for (identifier, text without names and years).
TEXTS = [
    ("MIT", f"{_MIT_GRANT} {_MIT_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD_TWO} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
    ("BSD-2-Clause", f"{_BSD_TWO} {_BSD_DISCLAIMER}"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY '
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions "
        "must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
        "License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
    ),
]
#: Bigrams in a row that a passage may have besides the template's.
GAP = 25

#: Words that any English text has; they are gate words only where no others will do.
COMMON = frozenset("a all an and any are as at be by for from if in is it its may no not of on or out so that the this to under use was with without you your".split())


def _normalised(line: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in line.lower()).split()


def template_bigrams(templates: list[tuple[str, str]] | None = None) -> list[tuple[str, list[str]]]:
    """(identifier, distinct bigrams) of each notice, or of the given templates."""
    return [(k, sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})) for k, line in (TEMPLATES if templates is None else templates) for w in [_normalised(line)]]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def gate_words(threshold_pct: int) -> list[str]:
    """Words of which every text that reaches the threshold has one: so many of a template's bigrams hold them that the others are too few."""
    chosen: list[str] = []
    for _, grams in sorted(template_bigrams([*TEMPLATES, *TEXTS]), key=lambda x: len(x[1])):
        rest = [g.split() for g in grams if not set(g.split()) & set(chosen)]
        while len(rest) >= _need(len(grams), threshold_pct):
            words = sorted({w for g in rest for w in g})
            chosen.append(max(words, key=lambda w: (w not in COMMON, sum(w in g for g in rest), len(w))))
            rest = [g for g in rest if chosen[-1] not in g]
    return chosen


def _need(size: int, t: int) -> int:
    """The bigrams that a match has in common with a template of ``size``, at least."""
    return max(1, -(-size * t // (200 - t)))


def _words(line: Column) -> Column:
    folded = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " ")), " "), "")


def _pairs(w: Column) -> Column:
    return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))


def _windows(pairs: Column, t: int) -> Column:
    """``dice, n, k, s, e``: for each template and first bigram, the best window that reaches the threshold; n are in common, s and -e count bigrams from 0."""
    made = template_bigrams()
    every = sorted({x for _, b in made for x in b})

    def of(k: int, near: Column) -> Column:
        grams, need = made[k][1], _need(len(made[k][1]), t)
        # A template's own repeats don't make it too long.
        most = len(grams) * (200 - t) // max(t, 1) + len(_normalised(TEMPLATES[k][1])) - 1 - len(grams)
        form, b = F.array(*[F.lit(x) for x in grams]), len(grams)

        def dice(s: Column, e: Column) -> Column:
            return _let(F.array_distinct(F.slice(pairs, s + 1, e - s + 1)), lambda a: _let(F.size(F.array_intersect(a, form)), lambda n: F.struct((F.lit(2.0) * n / (F.size(a) + b)).alias("dice"), n.alias("n"), F.lit(-k).alias("k"), s.alias("s"), (-e).alias("e"))))

        def from_each(at: Column) -> Column:
            def best(i: Column) -> Column:
                ends = F.filter(F.slice(at, i + need - 1, max(most - need + 1, 1)), lambda e: e - F.get(at, i - 1) < most)
                return F.array_max(F.transform(ends, lambda e: dice(F.get(at, i - 1), e)))

            found = F.transform(F.sequence(F.lit(1), F.size(at) - need + 1), best)
            return F.when(F.size(at) >= need, F.filter(found, lambda x: x["dice"] * 100 >= t))

        return F.coalesce(_let(F.filter(near, lambda i: F.array_contains(form, F.get(pairs, i))), from_each), F.array().cast("array<struct<dice:double,n:int,k:int,s:int,e:int>>"))

    near = F.when(F.size(pairs) > 0, F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.get(pairs, i).isin(every)))
    return _let(near, lambda n: F.concat(*[of(k, n) for k in range(len(made))]))


def _passages(pairs: Column, t: int) -> Column:
    """Like ``_windows``, for whole licence texts: each passage that reaches the threshold, k counting on from the notices."""
    none = F.array().cast("array<struct<dice:double,n:int,k:int,s:int,e:int>>")

    def of(k: int, grams: list[str]) -> Column:
        form, b = F.array(*[F.lit(x) for x in grams]), len(grams)

        def scored(s: Column, e: Column) -> Column:
            return _let(F.array_distinct(F.slice(pairs, s + 1, e - s + 1)), lambda a: _let(F.size(F.array_intersect(a, form)), lambda n: F.struct((F.lit(2.0) * n / (F.size(a) + b)).alias("dice"), n.alias("n"), F.lit(-k).alias("k"), s.alias("s"), (-e).alias("e"))))

        def cut(at: Column) -> Column:
            first = F.filter(at, lambda x, i: (i == 0) | (x - F.get(at, i - 1) > GAP + 1))
            last = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) - x > GAP + 1))
            return F.filter(F.zip_with(first, last, scored), lambda x: x["dice"] * 100 >= t)

        at = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(form, F.get(pairs, i)))
        return F.when((F.size(pairs) > 0) & (F.size(F.array_intersect(pairs, form)) >= _need(b, t)), _let(at, cut)).otherwise(none)

    return F.concat(*[of(len(TEMPLATES) + k, grams) for k, (_, grams) in enumerate(template_bigrams(TEXTS))])


def _chosen(windows: Column, line: Column, own: Column) -> Column:
    """The windows that say more than the lines they touch, and all passages, best first, without those that overlap a better one: one
    with more in common."""

    def says_more(x: Column) -> Column:
        first, last = F.get(line, x["s"]), F.get(line, -x["e"] + 1)
        inside = (first == last) & F.get(own, first).isNotNull()
        return (x["k"] <= -len(TEMPLATES)) | ~inside & ~F.exists(F.slice(own, first + 1, last - first + 1), lambda o: o.isNotNull() & (o["dice"] >= x["dice"]))

    most = F.transform(F.filter(windows, says_more), lambda x: F.struct(x["n"].alias("n"), x.alias("x")))
    best_first = F.transform(F.reverse(F.array_sort(most)), lambda y: y["x"])
    apart = lambda x, y: (-x["e"] + 1 < y["s"]) | (-y["e"] + 1 < x["s"])
    return F.aggregate(best_first, F.array().cast("array<struct<dice:double,n:int,k:int,s:int,e:int>>"), lambda acc, x: F.when(F.forall(acc, lambda y: apart(x, y)), F.concat(acc, F.array(x))).otherwise(acc))


def license_scan(docs: DataFrame, text: str = "text", threshold_pct: int = 80) -> DataFrame:
    """``docs`` with ``license_id`` (of the best line or window; ties: the first template), ``dice`` and ``n_license_lines``.

    Lines count that match as a whole, and those that a matching window touches. A window inside a line that matches as a
    whole is not asked, nor one that is no better than such a line it touches. Null and empty texts and texts without a
    match get null, 0.0 and 0. Texts of any length are read whole. Each row is judged by itself, so repeated rows and ties in
    ids don't matter; an empty table gives an empty one; columns that are called like the results are replaced.
    """
    t = threshold_pct
    made = template_bigrams()
    forms = F.array(*[F.struct(F.lit(-k).alias("k"), F.array(*[F.lit(x) for x in b]).alias("b")) for k, (_, b) in enumerate(made)])

    def best(a: Column) -> Column:
        fits = F.filter(forms, lambda f: (F.size(a) * (200 - t) >= F.size(f["b"]) * t) & (F.size(a) * t <= F.size(f["b"]) * (200 - t)))
        scored = F.transform(fits, lambda f: F.struct((F.lit(2.0) * F.size(F.array_intersect(a, f["b"])) / (F.size(a) + F.size(f["b"]))).alias("dice"), f["k"].alias("k")))
        return F.array_max(F.filter(scored, lambda s: s["dice"] * 100 >= t))

    names = F.array(*[F.lit(k) for k, _ in [*TEMPLATES, *TEXTS]])
    out = docs.drop("license_id", "dice", "n_license_lines").withColumn("_words", F.transform(F.split(F.col(text), "\n"), _words))
    out = out.withColumn("_own", F.transform("_words", lambda w: _let(F.array_distinct(_pairs(w)), best)))
    flat = F.flatten("_words")
    gate = F.arrays_overlap(flat, F.array(*[F.lit(x) for x in gate_words(t)]))
    line = F.flatten(F.transform("_words", lambda w, i: F.array_repeat(i, F.size(w))))
    out = out.withColumn("_at", F.when(gate, F.struct(_pairs(flat).alias("pairs"), line.alias("line")))).drop("_words")
    # The outer field access is bound once, as each use would copy the array.
    search = _let(F.col("_at"), lambda x: _let(x["pairs"], lambda p: _chosen(F.concat(_windows(p, t), _passages(p, t)), x["line"], F.col("_own"))))
    out = out.withColumn("_more", F.when(F.col("_at").isNotNull(), search))
    own = F.filter("_own", lambda s: s.isNotNull())
    alone = F.filter(F.transform("_own", lambda s, i: F.when(s.isNotNull(), i)), lambda i: i.isNotNull())
    touched = F.flatten(F.transform("_more", lambda x: F.slice(F.col("_at.line"), x["s"] + 1, -x["e"] - x["s"] + 2)))
    tops = F.concat(own, F.coalesce(F.transform("_more", lambda x: F.struct(x["dice"].alias("dice"), x["k"].alias("k"))), F.array().cast("array<struct<dice:double,k:int>>")))
    out = out.withColumns({"_found": F.array_max(tops), "_lines": F.size(F.array_distinct(F.concat(alone, F.coalesce(touched, F.array().cast("array<int>")))))})
    return out.withColumns({"license_id": F.when(F.col("_found").isNotNull(), F.get(names, -F.col("_found.k"))), "dice": F.coalesce(F.round("_found.dice", 6), F.lit(0.0)), "n_license_lines": F.coalesce(F.greatest("_lines", F.lit(0)), F.lit(0)).cast("long")}).drop("_own", "_at", "_more", "_found", "_lines")
