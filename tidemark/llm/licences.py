"""Licence scan: text compared with licence notices by the Dice coefficient of word bigrams.

Text is lower-cased, cut to words of a-z, 0-9 and inner dots, and taken as its set of
neighbouring word pairs; Dice is twice the common pairs over the sum of both set sizes.
The units compared are each line, each sentence within a line, each paragraph of more than
one line (paragraphs end at blank lines), the whole document, and notices: stretches of
several sentences or lines in whatever paragraphs, within a longer text. A template is compared with a unit only when its
size allows the threshold t: Dice can reach t only between t/(2-t) and (2-t)/t times the
unit's size. The same bound says how many of a template's pairs a unit may lack, so every
unit that reaches t has one of a few words of the template; texts and units without any
of these words are passed over before they are cut up. All of it is projections in
DataFrame functions; nothing is shuffled but an input of fewer files than cores.

Sentences end at a line's end and at one of ``.!?;:`` before a blank. A notice is looked
for under templates of at least 20 pairs. A sentence is of the template when it shares at
least half of its own pairs; a notice is a longest stretch of two or more such sentences
with at most one foreign sentence in a row per 20 pairs of the template (those without
words do not count). Its Dice is over all the words from its first to its last sentence,
line ends included, so a wrapped or much indented notice loses nothing. Only texts that
have the words without which no part of them can reach the threshold are cut up for it.
A template that stands twice in a row is one notice, for sets count a pair once.

Defined cases: a null or empty text and a unit of fewer than two words have no match. Of
templates that come equally close the first name wins; a notice gives a row for every
template it reaches the threshold with. Three-pair templates match on two common pairs
("all rights reserved" alone does). Repeated rows and ids give repeated matches; other columns are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, spread_files

THRESHOLD = 0.8
LONG = 20               # pairs from which on a template is looked for as a notice, and per foreign sentence in one

# Public notices by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
            "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the "
                         "License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
]


def bigrams_of(text: str) -> list[str]:
    """The word pairs of a text, each once, in sorted order; the same as :func:`bigrams`."""
    words = re.sub(r"\.+( |$)", " ", re.sub(r"[^a-z0-9.]+", " ", text.lower())).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), r"[^a-z0-9.]+", " ")
    return F.filter(F.split(F.regexp_replace(plain, r"\.+( |$)", " "), " +"), lambda w: w != "")


def bigrams(w: Column) -> Column:
    """The word pairs of an array of words, each once; empty below two words."""
    rest = F.greatest(F.size(w) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(w, 1, rest), F.slice(w, 2, rest), lambda a, b: F.concat_ws(" ", a, b)))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Smallest and largest set that can reach the threshold with a set of ``n``."""
    fits = [m for m in range(1, int(n * (2 - threshold) / threshold) + 2) if 2.0 * min(m, n) / (m + n) >= threshold]
    return fits[0], fits[-1]


def needed_words(pairs: list[str], threshold: float) -> set[str]:
    """Words of which any text that reaches the threshold with ``pairs`` has at least one.

    It shares at least t/(2-t) of the pairs; the words, the longest first, are in more
    pairs than it may lack.
    """
    may_lack = int(len(pairs) - threshold * len(pairs) / (2 - threshold) + 1e-9)
    taken, touched = set(), set()
    for word in sorted({w for p in pairs for w in p.split()}, key=lambda w: (-len(w), w)):
        if len(touched) > may_lack:
            break
        if more := {p for p in pairs if word in p.split()} - touched:
            taken.add(word)
            touched |= more
    return taken


def starts_with_one(needed: set[str]) -> str:
    """A pattern that finds each of the words in lower-case text, and may find longer ones.

    Only where a word starts, and by its first letter, are the alternatives tried.
    """
    heads = {w[0] for w in needed}
    tails = "|".join(re.escape(h) + "(?:" + "|".join(sorted(re.escape(w[1:]) for w in needed if w[0] == h)) + ")" for h in sorted(heads))
    return f"(?<![a-z0-9])(?=[{''.join(re.escape(h) for h in sorted(heads))}])(?:{tails})"


def least_words(pairs: list[str], threshold: float) -> int:
    """How many of the template's words a text has at least if any part of it reaches the threshold.

    The words it lacks leave out half as many pairs at least as they occur in, for a pair has two words.
    """
    may_lack = 2 * int(len(pairs) - threshold * len(pairs) / (2 - threshold) + 1e-9)
    in_pairs = sorted(sum(w in p.split() for p in pairs) for w in {w for p in pairs for w in p.split()})
    lacking = 0
    while lacking < len(in_pairs) and in_pairs[lacking] <= may_lack:
        may_lack -= in_pairs[lacking]
        lacking += 1
    return len(in_pairs) - lacking


def sentences(text: Column) -> Column:
    """The sentences of a text; those that share their line with others bear a U+0001 where it was cut."""
    return F.split(F.regexp_replace(text, "([.!?;:]) +", "$1\x01\n\x01"), "\n")


def find_notices(texts: DataFrame, sets: list[tuple[str, list[str]]], threshold: float) -> DataFrame:
    """The notices in ``texts`` (doc_id, text) under the long templates, in the columns of :func:`scan_licences`.

    Every explode of an array of one keeps that array from being computed again.
    """
    long = [(name, s) for name, s in sets if len(s) >= LONG]
    if not long:
        return texts.select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                        (("unit", "string"), ("unit_no", "long"), ("licence", "string"),
                                         ("dice", "double"), ("unit_text", "string"))]).filter(F.lit(False))
    hint = starts_with_one({w for _, s in long for w in needed_words(s, threshold)})
    literal = lambda xs: F.array(*map(F.lit, xs))
    known = F.array(*[F.struct(
        F.lit(name).alias("licence"), literal(s).alias("want"), literal(sorted({w for p in s for w in p.split()})).alias("words"),
        F.lit(least_words(s, threshold)).alias("least"), F.lit(len(s) // LONG + 1).alias("step"),
        F.lit(size_bounds(len(s), threshold)[0]).alias("lo"), F.lit(size_bounds(len(s), threshold)[1]).alias("hi")) for name, s in long])
    once = lambda c: F.explode(F.array(c))
    share = lambda pairs: F.size(F.array_intersect(pairs, F.col("t.want")))
    of_template = lambda p: (F.size(p) > 0) & (2 * share(p) >= F.size(p))
    far = lambda a, b: F.coalesce(b["k"] - a["k"] > F.col("t.step"), F.lit(True))
    run = F.slice("parts", F.col("r.a.k") + 1, F.col("r.b.k") - F.col("r.a.k") + 1)
    return (texts.filter(F.lower("text").rlike(hint))
            .select("doc_id", "text", once(F.array_distinct(words(F.col("text")))).alias("has"))
            .select("doc_id", "text", F.explode(F.filter(known, lambda t: F.size(F.array_intersect("has", t["words"])) >= t["least"])).alias("t"))
            .select("doc_id", "t", once(F.filter(F.transform(
                sentences(F.col("text")), lambda x, i: F.struct((i + 1).alias("no"), x.alias("x"), words(x).alias("w"))),
                lambda p: F.size(p["w"]) > 0)).alias("parts"))
            .select("doc_id", "t", "parts", once(F.filter(
                F.transform("parts", lambda p, i: F.when(of_template(bigrams(p["w"])), F.struct(i.alias("k"), p["no"].alias("no")))),
                lambda h: h.isNotNull())).alias("hits"))
            .select("doc_id", "t", "parts", F.explode(F.arrays_zip(
                F.filter("hits", lambda h, i: far(F.get("hits", i - 1), h)).alias("a"),
                F.filter("hits", lambda h, i: far(h, F.get("hits", i + 1))).alias("b"))).alias("r"))
            .filter("r.b.k > r.a.k")
            .select("doc_id", "t", "r", once(run).alias("run"))
            .select("doc_id", "t", "r", "run", once(bigrams(F.flatten(F.transform("run", lambda p: p["w"])))).alias("pairs"))
            .filter(F.size("pairs").between(F.col("t.lo"), F.col("t.hi")))
            .select("doc_id", F.lit("notice").alias("unit"), F.col("r.a.no").cast("long").alias("unit_no"), "t.licence",
                    (2.0 * share(F.col("pairs")) / (F.size("pairs") + F.size("t.want"))).alias("dice"),
                    F.translate(F.array_join(F.transform("run", lambda p: p["x"]), "\n"), "\x01", "").alias("unit_text"))
            .filter(F.col("dice") >= threshold))


def scan_licences(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per unit that matches: doc_id, unit, unit_no, licence, dice, unit_text.

    ``unit`` is line, sentence, paragraph, document or notice; ``unit_no`` counts from 1 within the
    document. That of a notice is the number of its first sentence.
    """
    sets = [(name, bigrams_of(text)) for name, text in templates or TEMPLATES]
    bounds = {i: size_bounds(len(s), threshold) for i, (_, s) in enumerate(sets)}
    least, most = min(lo for lo, _ in bounds.values()), max(hi for _, hi in bounds.values())
    needed = starts_with_one({w for _, s in sets for w in needed_words(s, threshold)})
    hint = lambda x: F.lower(x).rlike(needed)
    text = F.col("text")
    lines, paragraphs = F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n")
    unit = lambda kind: lambda x, i: F.struct(F.lit(kind).alias("unit"), (i + 1).alias("unit_no"), x.alias("unit_text"))
    several = lambda x: F.instr(x, "\n") > 0
    whole = F.when(several(text), F.transform(F.array(text), unit("document")))
    units = F.concat(
        F.transform(lines, unit("line")),
        F.filter(F.transform(sentences(text), unit("sentence")), lambda u: F.instr(u["unit_text"], "\x01") > 0),
        F.filter(F.transform(paragraphs, unit("paragraph")), lambda u: several(u["unit_text"]) & (F.size(paragraphs) > 1)),
        F.coalesce(whole, F.filter(F.transform(F.array(text), unit("document")), lambda _: F.lit(False))))
    # each explode also keeps its array from being computed again by what stands above it
    sized = F.filter(F.transform(F.array(words(F.col("u.unit_text"))), lambda w: F.when(F.size(w) > least, bigrams(w))),
                     lambda p: F.size(p).between(least, most))
    n = F.size("pairs")
    scores = [F.when(n.between(*bounds[i]), F.struct(
        (-2.0 * F.size(F.array_intersect("pairs", F.array(*map(F.lit, s)))) / (n + len(s))).alias("minus"),
        F.lit(name).alias("licence"))) for i, (name, s) in enumerate(sets)]
    best = F.filter(F.array(F.array_min(F.filter(F.array(*scores), lambda s: s["minus"] <= -threshold))), lambda s: s.isNotNull())
    texts = spread_files(id_text(docs, id_col, text_col))
    return (texts.filter(hint(text)).select("doc_id", F.explode(units).alias("u")).filter(hint(F.col("u.unit_text")))
            .select("doc_id", "u.unit", "u.unit_no", "u.unit_text", F.explode(sized).alias("pairs"))
            .select("doc_id", "unit", F.col("unit_no").cast("long"), "unit_text", F.explode(best).alias("best"))
            .select("doc_id", "unit", "unit_no", "best.licence", (-F.col("best.minus")).alias("dice"),
                    F.translate("unit_text", "\x01", "").alias("unit_text"))
            .unionByName(find_notices(texts, sets, threshold)))


def scan_sql(threshold: float = THRESHOLD) -> str:
    """The query ``op1`` in DuckDB SQL."""
    sets = ",\n".join(f"('{name}', [" + ", ".join(f"'{b}'" for b in bigrams_of(text)) + "])" for name, text in TEMPLATES)
    return f"""
    WITH t(licence, want) AS (VALUES {sets}),
    d AS (SELECT doc_id, text FROM documents WHERE text <> ''),
    p AS (SELECT doc_id, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS parts FROM d),
    u AS (SELECT doc_id, 'line' AS unit, unnest(string_split(text, chr(10))) AS unit_text,
                 generate_subscripts(string_split(text, chr(10)), 1) AS unit_no FROM d
          UNION ALL SELECT * FROM (SELECT doc_id, 'paragraph', unnest(parts) AS x, generate_subscripts(parts, 1)
                    FROM p WHERE len(parts) > 1) WHERE contains(x, chr(10))
          UNION ALL SELECT doc_id, 'document', text, 1 FROM d WHERE contains(text, chr(10))),
    u2 AS (SELECT doc_id, unnest(parts) AS unit_text, generate_subscripts(parts, 1) AS unit_no
           FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?;:]) +', '\\1' || chr(1) || chr(10) || chr(1), 'g'), chr(10)) AS parts FROM d)),
    units AS (SELECT * FROM u UNION ALL SELECT doc_id, 'sentence', unit_text, unit_no FROM u2 WHERE contains(unit_text, chr(1))
              UNION ALL SELECT doc_id, 'part', unit_text, unit_no FROM u2),
    w AS (SELECT doc_id, unit, unit_no, list_filter(string_split_regex(regexp_replace(regexp_replace(lower(unit_text),
            '[^a-z0-9.]+', ' ', 'g'), '\\.+( |$)', ' ', 'g'), ' +'), lambda x: x <> '') AS ws FROM units),
    b AS (SELECT doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS pairs
          FROM w WHERE len(ws) > 1 AND unit <> 'part'),
    s AS (SELECT doc_id, unit, unit_no, licence, 2.0::DOUBLE * len(list_intersect(pairs, want)) / (len(pairs) + len(want)) AS dice
          FROM b, t WHERE 2.0::DOUBLE * least(len(pairs), len(want)) / (len(pairs) + len(want)) >= {threshold}::DOUBLE),
    best AS (SELECT doc_id, unit, unit_no, licence, dice FROM s WHERE dice >= {threshold}::DOUBLE
             QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, licence) = 1),
    parts AS (SELECT doc_id, unit_no, ws, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS pairs,
                     row_number() OVER (PARTITION BY doc_id ORDER BY unit_no) AS k
              FROM w WHERE unit = 'part' AND len(ws) > 0),
    long AS (SELECT row_number() OVER () AS tpl, licence, want, len(want) // {LONG} + 1 AS step FROM t WHERE len(want) >= {LONG}),
    hits AS (SELECT doc_id, tpl, licence, want, step, k, unit_no FROM parts, long
             WHERE len(pairs) > 0 AND 2 * len(list_intersect(pairs, want)) >= len(pairs)),
    islands AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, tpl ORDER BY k) AS island FROM (
                SELECT *, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id, tpl ORDER BY k) <= step THEN 0 ELSE 1 END AS cut FROM hits)),
    runs AS (SELECT doc_id, tpl, licence, want, island, min(k) AS a, max(k) AS b, min(unit_no) AS unit_no
             FROM islands GROUP BY ALL HAVING max(k) > min(k)),
    texts AS (SELECT r.doc_id, r.tpl, r.licence, r.want, r.unit_no, flatten(list(p.ws ORDER BY p.k)) AS ws
              FROM runs r JOIN parts p ON p.doc_id = r.doc_id AND p.k BETWEEN r.a AND r.b GROUP BY ALL),
    n AS (SELECT doc_id, unit_no, licence, want, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS pairs FROM texts),
    notices AS (SELECT doc_id, 'notice' AS unit, unit_no, licence,
                       2.0::DOUBLE * len(list_intersect(pairs, want)) / (len(pairs) + len(want)) AS dice FROM n)
    SELECT * FROM best UNION ALL SELECT * FROM notices WHERE dice >= {threshold}::DOUBLE"""
