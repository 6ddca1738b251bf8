"""Licence scan: Dice coefficient of word bigrams against licence templates, DataFrame functions only.

Texts are normalised (runs of anything but ASCII letters and digits become one space, lower case) and units of
them become sets of word bigrams. Units are
  * each line and the whole text. A template of b bigrams can reach coefficient t with a unit of a bigrams only if
    t/(2-t) a <= b <= (2-t)/t a: these bounds pick the candidate templates before any bigrams meet. A unit keeps its
    best template (ties: the first by name);
  * windows of the running text, for notices wrapped over lines inside a longer document. A template is laid over the
    text wherever one of its anchors stands, so that the two coincide, and compared with as many words as it has.

A match shares over t/(2-t) of the template's bigrams. Telling words are chosen so that fewer of each template's
bigrams than that hold none of them: whatever matches holds a telling word, and a bigram with one in it (an anchor).
So texts and lines without a telling word are given up by one pattern, and nothing that matches is lost by it.
Templates are a parameter of bounded size, so all work is in the row: no shuffle.

Edge cases: null or empty text has no units and no licence; a unit of fewer than two words has no bigrams;
repeated rows each get their row; a null id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import let

# Notices and licence texts, as their owners word them.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'
_BSD_TWO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-2-clause": f"{_BSD_TWO} {_BSD_AS_IS}",
    "bsd-2-clause-conditions": _BSD_TWO,
    "bsd-3-clause": f"{_BSD_TWO} {_BSD_THIRD} {_BSD_AS_IS}",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "isc": f"{_ISC_GRANT} {_ISC_AS_IS}",
    "isc-grant": _ISC_GRANT,
    "mit": f"{_MIT_GRANT} {_AS_IS}",
    "mit-grant": _MIT_GRANT,
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}
#: Words preferred as telling words, as prose has few of them.
PREFERRED = ["license", "licensed", "reserved", "cc", "copyright", "warranties", "warranty", "permission", "merchantability", "liable", "mozilla", "software", "redistribution", "redistributions", "waived"]


def template_words(text: str) -> list[str]:
    return [w for w in re.sub("[^A-Za-z0-9]+", " ", text).lower().split(" ") if w]


def telling_words(templates: dict[str, str], threshold: float) -> list[str]:
    """Words such that any unit that reaches the threshold with a template shares a bigram with one of them in it."""
    chosen: list[str] = []

    def lacking(words: list[str]) -> bool:
        pairs = set(zip(words, words[1:]))
        bare = sum(not {a, b} & set(chosen) for a, b in pairs)
        return bool(pairs) and bare >= max(1, math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9))

    for text in templates.values():
        words = template_words(text)
        for w in sorted(dict.fromkeys(words), key=lambda w: (w not in PREFERRED, PREFERRED.index(w) if w in PREFERRED else 0, -len(w), w)):
            if not lacking(words):
                break
            if w not in chosen:
                chosen.append(w)
    return chosen


def bigrams(words: Column) -> Column:
    """Word bigrams in order, as 64-bit hashes."""
    return F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda k: F.xxhash64(F.get(words, k), F.get(words, k + 1)))).otherwise(F.array().cast("array<bigint>"))


def normal_words(unit: Column) -> Column:
    return F.filter(F.split(F.lower(F.regexp_replace(unit, "[^A-Za-z0-9]+", " ")), " "), lambda w: w != "")


def _templates(spark, texts: dict[str, str]) -> list[tuple[str, list[int]]]:
    """(name, bigram hashes in order), by name."""
    rows = spark.createDataFrame(sorted(texts.items()), "name string, text string").select("name", bigrams(normal_words(F.col("text"))).alias("b"))
    return sorted((r.name, list(r.b)) for r in rows.collect() if r.b)


def _longs(values: list[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<bigint>")


def scan_licences(docs: DataFrame, threshold: float = 0.8, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_matches (how many licences), licences (names, sorted, comma-joined), licence and dice (the best; ties by name)."""
    texts = templates or TEMPLATES
    known, telling = _templates(docs.sparkSession, texts), telling_words(texts, threshold)
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sets = [sorted(set(b)) for _, b in known]
    least, most = min(map(len, sets)) / high, max(map(len, sets)) / low
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(s)).alias("n"), F.lit(len(b)).alias("long"), _longs(s).alias("b")) for (name, b), s in zip(known, sets)])
    worded = [template_words(texts[name]) for name, _ in known]
    anchors = sorted({(b[p], t, p) for t, (_, b) in enumerate(known) for p in range(len(b)) if {*worded[t][p : p + 2]} & {*telling}})
    keys = _longs(sorted({g for g, _, _ in anchors}))
    places = F.array(*[F.struct(F.lit(g).cast("long").alias("g"), F.lit(t).alias("t"), F.lit(p).alias("p")) for g, t, p in anchors])
    holds = lambda unit: unit.rlike("(?i)(?<![a-z0-9])(?:" + "|".join(sorted(telling)) + ")(?![a-z0-9])")

    def against(grams: Column, t: Column) -> Column:
        dice = 2.0 * F.size(F.array_intersect(grams, t["b"])) / (F.size(grams) + t["n"])
        return F.struct(dice.alias("dice"), t["name"].alias("licence"))

    def first(found: Column) -> Column:
        """The highest coefficient, ties by name."""
        none = F.lit(None).cast("struct<dice:double,licence:string>")
        return F.aggregate(found, none, lambda a, s: F.when(a.isNull() | (s["dice"] > a["dice"]) | ((s["dice"] == a["dice"]) & (s["licence"] < a["licence"])), s).otherwise(a))

    def fitting(grams: Column) -> Column:
        a = F.size(grams)
        near = F.filter(table, lambda t: (t["n"] >= low * a - 1e-9) & (t["n"] <= high * a + 1e-9))
        return first(F.filter(F.transform(near, lambda t: against(grams, t)), lambda s: s["dice"] >= threshold))

    def unit(words: Column, grams: Column) -> Column:
        # n words make at most n - 1 bigrams, and n distinct words at least n - 1 distinct ones
        fits = (F.size(words) - 1 >= least) & (F.size(F.array_distinct(words)) - 1 <= most)
        return F.when(fits, let(F.array_distinct(grams), lambda g: F.when(F.size(g) <= most, fitting(g))))

    def windows(grams: Column) -> Column:
        """What templates laid over their anchors match."""
        at = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda k: F.array_contains(keys, F.get(grams, k)))
        laid = F.flatten(F.transform(at, lambda k: F.transform(F.filter(places, lambda x: x["g"] == F.get(grams, k)), lambda x: F.struct(x["t"].alias("t"), F.greatest(F.lit(0), k - x["p"]).alias("start")))))
        placed = lambda s: let(F.get(table, s["t"]), lambda t: against(F.array_distinct(F.slice(grams, s["start"] + 1, t["long"])), t))
        return F.filter(F.transform(F.array_distinct(laid), placed), lambda m: m["dice"] >= threshold)

    none = F.array().cast("array<struct<dice:double,licence:string>>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("ws", F.when(holds(F.col("text")), normal_words(F.col("text")))).withColumn("gs", F.when(F.col("ws").isNotNull(), bigrams(F.col("ws"))))
    near = F.coalesce(F.arrays_overlap("gs", keys), F.lit(False))
    lines = F.transform(F.filter(F.split("text", "\n", -1), holds), lambda line: let(normal_words(line), lambda ws: unit(ws, bigrams(ws))))
    found = F.concat(F.filter(F.concat(lines, F.array(unit(F.col("ws"), F.col("gs")))), lambda m: m.isNotNull()), windows(F.col("gs")))
    rows = rows.withColumn("m", F.when(near, found).otherwise(none)).withColumn("top", F.when(F.size("m") > 0, first(F.col("m"))))
    names = F.array_sort(F.array_distinct(F.transform("m", lambda m: m["licence"])))
    return rows.select("doc_id", F.size(names).cast("long").alias("n_matches"), F.array_join(names, ",").alias("licences"), F.col("top.licence").alias("licence"), F.col("top.dice").alias("dice"))


def oracle(threshold: float = 0.8) -> str:
    """The same by brute force in DuckDB: every line and text against every template, every template at every anchor."""
    quoted = lambda s: "'{}'".format(s.replace("'", "''"))
    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in TEMPLATES.items())
    telling = "[" + ", ".join(map(quoted, telling_words(TEMPLATES, threshold))) + "]"
    words = "list_filter(string_split(lower(regexp_replace({}, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
    grams = "list_transform(generate_series(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1])"
    dice = "2.0::DOUBLE * len(list_intersect({0}, b)) / (len({0}) + len(b))"
    return f"""
WITH t AS (SELECT name, ws, list_distinct({grams}) AS b FROM (SELECT name, {words.format("text")} AS ws FROM (VALUES {values}) v(name, text))),
a AS (SELECT name, p, ws[p] || ' ' || ws[p + 1] AS gram FROM (SELECT name, ws, unnest(generate_series(1, len(ws) - 1)) AS p FROM t) WHERE list_contains({telling}, ws[p]) OR list_contains({telling}, ws[p + 1])),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT r, k, unit FROM (SELECT r, unnest(range(len(string_split(text, chr(10))))) AS k, unnest(string_split(text, chr(10))) AS unit FROM d)
      UNION ALL SELECT r, -1, text FROM d),
g AS (SELECT r, k, list_distinct({grams}) AS g FROM (SELECT r, k, {words.format("unit")} AS ws FROM u) WHERE len(ws) > 1),
m AS (SELECT r, k, name, {dice.format("g")} AS dice FROM g, t WHERE len(g) <= 2 * len(b) AND list_has_any(g, b)),
best AS (SELECT r, arg_min(name, (-dice, name)) AS name, max(dice) AS dice FROM m WHERE dice >= {threshold} GROUP BY r, k),
s AS (SELECT r, ws, {grams} AS gs FROM (SELECT r, {words.format("text")} AS ws FROM d) WHERE len(ws) > 1),
e AS (SELECT DISTINCT r, a.name, greatest(k - p, 0) AS start FROM (SELECT r, unnest(gs) AS gram, generate_subscripts(gs, 1) AS k FROM s) x JOIN a USING (gram)),
l AS (SELECT r, name, {dice.format("g")} AS dice FROM (SELECT r, name, t.b, list_distinct(gs[start + 1 : start + len(t.ws) - 1]) AS g FROM e JOIN s USING (r) JOIN t USING (name))),
f AS (SELECT * FROM best UNION ALL SELECT * FROM l WHERE dice >= {threshold}),
o AS (SELECT r, count(DISTINCT name) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS licences, arg_min(name, (-dice, name)) AS licence, max(dice) AS dice FROM f GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(licences, '') AS licences, licence, dice FROM d LEFT JOIN o USING (r)
"""
