"""License scan (operator 4), DataFrame functions only.

Every line, every paragraph of several lines and the whole text are normalised
(lower case, runs of anything but letters and digits become one blank) and
compared with license templates by the Dice coefficient over sets of word
bigrams.  Sizes bound the coefficient: a part with n bigrams can only reach
``LEAST`` against a template with m if n lies between m * LEAST / (2 - LEAST)
and m * (2 - LEAST) / LEAST, so most parts are pruned by their word counts and
most templates by the number of bigrams.  A notice among other words, in the
middle of a sentence too, is found by passages: windows of the template's size
(and four fifths and five fourths of it) over the words of the text.

The same bound gives a few word stems without which nothing in a text reaches
any template (``anchors``): texts with none of them are left after one
lower-casing and a search for these.  In the others only windows are compared
that start at a bigram of the template and hold enough of its bigrams (their
positions tell).  Everything is row-local: no shuffle, one read of the texts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

LEAST = 0.85
SIZES = ((4, 5), (1, 1), (5, 4))    # passages: words of a window over words of the template

# Notices and texts of public licenses, as their publishers word them.
_BSD_OPEN = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
             "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
             "with the distribution. ")
_BSD_REST = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
             "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
             "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
             "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
             "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
             "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
             "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                  "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                  "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                  "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                  "for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                        "or (at your option) any later version.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                "conditions: The above copyright notice and this permission notice shall be included in all copies or "
                "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
                "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
                "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
                "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
                "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
                "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
                "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
                "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
                "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text": _BSD_OPEN + _BSD_REST,
    "BSD-3-Clause-text": _BSD_OPEN + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                         "endorse or promote products derived from this software without specific prior written permission. " + _BSD_REST,
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
                 "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
                 "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
                 "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
                 "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
                 "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
                 "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
                 "removed or altered from any source distribution.",
}


def _words(part: Column) -> Column:
    """Normalised words of a part; none if it has no letter or digit."""
    return F.filter(F.split(F.regexp_replace(F.lower(part), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    n = F.size(words)
    pair = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
                      lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pair)


def bounds(m: int, least: float) -> tuple[int, int]:
    """Smallest and largest number of bigrams that can reach ``least`` against ``m``."""
    return math.ceil(m * least / (2 - least) - 1e-9), math.floor(m * (2 - least) / least + 1e-9)


# Word stems of everyday text, which tell little about licenses.
ORDINARY = ("above all and any are for form from follow have includ its may more must not notice one other out provid reprod "
            "retain right sell sourc special state such sub that the their them there these they this thos und use was were wh "
            "will with work you appear claim contri condit direct event except file full list loss mad materi met name person "
            "portio produc public purpos respec restri specif substa support terms united whatso whom").split()


def anchors(known: list[tuple[str, list[str], int, int, int]]) -> list[str]:
    """Word stems, and pairs of short words, of which every text that reaches a
    template holds one: a text without them lacks more of the template's bigrams
    than a match can spare.  Greedy by the bigrams that one adds over all
    templates that still need some, everyday words last."""
    pairs = [[g.split(" ") for g in k[1]] for k in known]
    spare = [len(k[1]) - k[2] for k in known]
    stems = sorted({w[:6] for p in pairs for g in p for w in g if len(w) > 2} | {
        " ".join(g) for p in pairs for g in p if max(map(len, g)) < 3})
    held = {s: [{i for i, g in enumerate(p) if s == " ".join(g) or any(w.startswith(s) for w in g)} for p in pairs] for s in stems}
    rare = {s: not s.startswith(tuple(ORDINARY)) for s in stems}
    hit: list[set[int]] = [set() for _ in known]
    out: list[str] = []
    while any(len(h) <= n for h, n in zip(hit, spare)):
        gain = {s: sum((min(len(h | x), n + 1) - min(len(h), n + 1)) / (n + 1) for h, x, n in zip(hit, held[s], spare)) for s in stems}
        best = max(stems, key=lambda s: (gain[s] > 0, rare[s], len(s) > 3, gain[s], s))
        out.append(best)
        hit = [h | x for h, x in zip(hit, held[best])]
    for s in sorted(out, key=lambda s: (rare[s], len(s), s)):       # those that later ones made needless
        less = [x for x in out if x != s]
        if all(len(set().union(*(held[x][k] for x in less))) > n for k, n in enumerate(spare)):
            out = less
    return sorted(out)


def _at_passages(pairs: Column, places: Column, common: Column, license: str, grams: list[str], low: int, high: int, n_words: int) -> Column:
    """Best window of a text for one template as ``struct(part, part_no, license,
    dice)``, null if it holds too few of the template's bigrams anywhere."""
    t, m = F.array(*[F.lit(g) for g in grams]), len(grams)
    sizes = sorted({max(2, n_words * a // b) for a, b in SIZES})
    mine = F.transform(F.filter(places, lambda p: F.array_contains(F.array_intersect(common, t), p["g"])), lambda p: p["i"])

    def dice(at: Column, size: int) -> Column:
        return F.transform(F.array(F.array_distinct(F.slice(pairs, at + 1, F.lit(size - 1)))), lambda b: F.when(
            F.size(b).between(low, high), (2 * F.size(F.array_intersect(b, t))) / (F.size(b) + m)).otherwise(F.lit(0.0)))[0]

    # low bigrams of the template within a window from the first of them on
    close = lambda h: F.filter(h, lambda x, k: F.get(h, k + low - 1) - x <= max(sizes) - 2)     # noqa: E731
    best = F.transform(F.array(mine), lambda h: F.array_max(F.transform(close(h), lambda at: F.struct(
        F.greatest(*[dice(at, s) for s in sizes], F.lit(0.0)).alias("d"), (-at).alias("at")))))[0]
    found = F.transform(F.array(best), lambda b: F.when(b.isNotNull(), F.struct(
        F.lit("passage").alias("part"), (-b["at"]).alias("part_no"), F.lit(license).alias("license"), b["d"].alias("dice"))))[0]
    return F.when(F.size(F.array_intersect(common, t)) >= low, found)


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, part, part_no, license, dice`` for every part of every document
    that reaches ``least`` against a template (``part``: ``line``, ``paragraph``
    or ``text``, numbered from 0 in the text), and for every license that no part
    reaches the best ``passage`` that does: a window of the text's words of one of
    ``SIZES``, from a bigram of the template on (``part_no``: its first word,
    the first of equally good ones).

    Null and empty texts, and parts of fewer than two words, match nothing;
    equal parts of a text, repeated ids and null ids each give their own rows; a
    part that reaches several templates gives a row for each.  An empty table
    gives no rows; other columns are ignored."""
    spark = prepare(docs.sparkSession)
    named = templates or TEMPLATES
    # the templates, a fixed short list, go through the same normalisation
    table = spark.createDataFrame(sorted(named.items()), "license string, t string").select(
        "license", _words(F.col("t")).alias("words")).select("license", "words", _bigrams(F.col("words")).alias("bigrams")).collect()
    known = [(r["license"], r["bigrams"], *bounds(len(r["bigrams"]), least), len(r["words"])) for r in table if r["bigrams"]]
    low, high = min(k[2] for k in known), max(k[3] for k in known)

    text = F.col("text")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    holds = lambda x, w: F.rlike(x, F.lit(w.replace(" ", r"[^\p{L}\p{N}]+"))) if " " in w else F.contains(x, F.lit(w))
    stems = sorted(anchors(known), key=lambda w: " " in w)
    # lower-cased once for all searches
    docs = docs.where(F.exists(F.array(F.lower(text)), lambda x: reduce(Column.__or__, [holds(x, w) for w in stems])))
    part = lambda kind, no, x: F.struct(F.lit(kind).alias("part"), no.cast("int").alias("part_no"), _words(x).alias("words"))
    lines = F.transform(F.split(text, "\n"), lambda x, i: part("line", i, x))
    blocks = F.split(text, "\n[ \t\r]*\n")
    paragraphs = F.transform(F.filter(F.transform(blocks, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                                      lambda b: F.contains(b["x"], F.lit("\n"))), lambda b: part("paragraph", b["i"], b["x"]))
    every = F.array(*[F.lit(g) for g in sorted({g for k in known for g in k[1]})])
    n = F.size("words")
    # made once: Spark moves no filter and no projection below an explode
    once = lambda x: F.explode(F.array(x))      # noqa: E731
    rows = docs.where("text IS NOT NULL").select("doc_id", "text", once(_words(text)).alias("words"))
    rows = rows.select("*", once(F.zip_with(F.slice("words", 1, F.greatest(n - 1, F.lit(0))), F.slice("words", 2, F.greatest(
        n - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))).alias("pairs"))
    # what any part or window shares with a template, the whole text does
    rows = rows.select("*", once(F.array_intersect("pairs", every)).alias("common")).where(F.size("common") >= low)
    enough = [F.size(F.array_intersect("common", F.array(*[F.lit(g) for g in k[1]]))) >= k[2] for k in known]
    rows = rows.where(reduce(Column.__or__, enough)).select(
        "doc_id", F.concat(lines, paragraphs).alias("parts"), "words", (F.size(blocks) > 1).alias("several"), "pairs", "common")
    whole = F.when(F.col("several"), F.array(F.struct(F.lit("text").alias("part"), F.lit(0).alias("part_no"), F.col("words").alias("words"))))
    # n words have at most n - 1 bigrams, and at least one less than they have different words
    near = F.filter(F.concat("parts", F.coalesce(whole, F.filter("parts", lambda p: F.lit(False)))), lambda p: (
        F.size(p["words"]) - 1 >= low) & (F.size(F.array_distinct(p["words"])) - 1 <= high))
    rows = rows.select("doc_id", F.transform(near, lambda p: F.struct(p["part"].alias("part"), p["part_no"].alias("part_no"),
                                                                      _bigrams(p["words"]).alias("b"))).alias("near"), "pairs", "common")

    def reached(p: Column) -> Column:
        size = F.size(p["b"])
        return F.filter(F.array(*[F.when(size.between(lo, hi), F.struct(
            p["part"].alias("part"), p["part_no"].alias("part_no"), F.lit(name).alias("license"),
            ((2 * F.size(F.array_intersect(p["b"], F.array(*[F.lit(g) for g in grams])))) / (size + len(grams))).alias("dice")))
            for name, grams, lo, hi, _ in known]), lambda h: h["dice"] >= least)

    rows = rows.select("doc_id", F.flatten(F.transform("near", reached)).alias("hits"), "pairs", "common")
    places = F.filter(F.transform("pairs", lambda g, i: F.struct(g.alias("g"), i.alias("i"))), lambda p: F.array_contains("common", p["g"]))
    rows = rows.select("doc_id", "hits", "pairs", "common", places.alias("places"))
    licenses = F.transform("hits", lambda h: h["license"])
    passages = F.filter(F.array(*[F.when(~F.array_contains(licenses, k[0]), _at_passages(
        F.col("pairs"), F.col("places"), F.col("common"), *k)) for k in known]), lambda h: h["dice"] >= least)
    rows = rows.select("doc_id", F.explode(F.concat("hits", passages)).alias("h"))
    return rows.select("doc_id", "h.part", "h.part_no", "h.license", "h.dice")


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql() -> str:
    """The scan as DuckDB SQL, comparing every part with every template and, where
    none is reached, every window that starts at one of the template's bigrams."""
    rows = ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in sorted(TEMPLATES.items()))
    words = "list_filter(string_split(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '),  lambda w: w <> '')"
    pairs = "CASE WHEN len(words) < 2 THEN CAST([] AS VARCHAR[]) ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END"
    sizes = ", ".join(f"greatest(2, n_words * {a} // {b})" for a, b in SIZES)
    return f"""
WITH t AS (SELECT license, len(words) AS n_words, list_distinct({pairs}) AS g
  FROM (SELECT license, {words.format('body')} AS words FROM (VALUES {rows}) AS v(license, body))),
lines AS (SELECT doc_id, 'line' AS part, UNNEST(range(len(l))) AS i, UNNEST(l) AS x
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
blocks AS (SELECT doc_id, text, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS b FROM documents WHERE text IS NOT NULL),
paragraphs AS (SELECT doc_id, 'paragraph' AS part, UNNEST(range(len(b))) AS i, UNNEST(b) AS x FROM blocks),
parts AS (SELECT * FROM lines UNION ALL SELECT * FROM paragraphs WHERE contains(x, chr(10))
          UNION ALL SELECT doc_id, 'text', 0, text FROM blocks WHERE len(b) > 1),
p AS (SELECT doc_id, part, i, list_distinct({pairs}) AS g FROM (SELECT doc_id, part, i, {words.format('x')} AS words FROM parts) WHERE len(words) > 1),
hits AS (SELECT doc_id, part, CAST(i AS INTEGER) AS part_no, license, CAST(2 * len(list_intersect(p.g, t.g)) AS DOUBLE) / (len(p.g) + len(t.g)) AS dice
  FROM p, t WHERE CAST(2 * len(list_intersect(p.g, t.g)) AS DOUBLE) / (len(p.g) + len(t.g)) >= {LEAST}),
d AS (SELECT doc_id, {pairs} AS pairs FROM (SELECT doc_id, {words.format('text')} AS words FROM documents WHERE text IS NOT NULL)),
flat AS (SELECT doc_id, UNNEST(range(len(pairs))) AS i, UNNEST(pairs) AS pair FROM d),
tg AS (SELECT license, UNNEST(g) AS pair FROM t),
w AS (SELECT flat.doc_id, tg.license, flat.i, UNNEST([{sizes}]) AS size, t.g FROM flat JOIN tg ON tg.pair = flat.pair JOIN t ON t.license = tg.license
  WHERE NOT EXISTS (SELECT 1 FROM hits WHERE hits.doc_id = flat.doc_id AND hits.license = tg.license)),
b AS (SELECT w.doc_id, license, i, w.g, list_distinct(list_slice(d.pairs, i + 1, i + size - 1)) AS own FROM w JOIN d ON d.doc_id = w.doc_id),
s AS (SELECT doc_id, license, i, MAX(CAST(2 * len(list_intersect(own, g)) AS DOUBLE) / (len(own) + len(g))) AS dice FROM b GROUP BY 1, 2, 3)
SELECT * FROM hits
UNION ALL
SELECT doc_id, 'passage', CAST(arg_min(i, struct_pack(d := -dice, i := i)) AS INTEGER), license, MAX(dice)
FROM s WHERE dice >= {LEAST} GROUP BY doc_id, license
"""
