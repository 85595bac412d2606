"""Licence scans: normalised text against licence templates by the Dice
coefficient of their word bigrams.  DataFrame functions only.

*Units.*  A text is compared by its lines, its paragraphs (parted by blank
lines) and as a whole, so that a one-line notice, a wrapped header and a
licence file all meet their template.  A unit is normalised to lower-case (A-Z)
words of letters and digits; its bigrams are a set.

*Windows.*  A licence may be part of a line, or run over several paragraphs of
a longer text.  So it is also looked for in the runs of the
whole text's words, whatever its lines and paragraphs, that begin with a bigram
of a template and have at least as many bigrams as it (near the text's end: in
the last so many) and at most its upper bound; the best stands for the template.
A shorter run is none: GPL-2.0's notice has 8 of the 11 bigrams of GPL-3.0's.
From a place the runs of all sizes are one walk of at most the upper bound, so a
text of many licences takes time in proportion to its length.

*Match.*  Dice = 2 |A and B| / (|A| + |B|); at least ``THRESHOLD`` is a match.

*Pruning, none of it lossy.*  Dice >= t needs |A| between t/(2-t) |B| and
(2-t)/t |B|: templates out of these size bounds are not compared.  It also
needs t/(2-t) |B| shared bigrams, so a matching unit holds one of any
|B| - ceil(t/(2-t) |B|) + 1 of the template's.  A notice has as many of its
bigrams as probes, those of the longest words; a longer template has words that
as many of its bigrams hold.  A text or unit without a probe is passed over.
Windows are only taken in texts, and from places, that have enough of a
template's bigrams.

*Scale.*  One projection over the texts: no shuffle, no join, and the templates
are a constant of the plan.

Defined cases: a null or empty text has no licence; ties go to the licence id
that comes first; repeated lines count once; repeated rows are scanned each.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import read_table

THRESHOLD = 0.8

# Fixed values: (licence id, template text), notices first, then longer texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details. You should have received a copy of the GNU General Public License along with this program. If
not, see <https://www.gnu.org/licenses/>."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Templates of at most so many bigrams have bigrams for probes, others words.
NOTICE_BIGRAMS = 20
LONG_WORD = 6
PARAGRAPH = r"\n[ \t\r]*\n"


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template (templates are ASCII)."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can match a template of ``n``;
    the slack keeps a bound that is a whole number from being rounded past."""
    return ceil(threshold / (2 - threshold) * n - 1e-9), int((2 - threshold) / threshold * n + 1e-9)


def _enough(bigrams: list[str], threshold: float) -> int:
    """So many of the bigrams can't all be missing from a match."""
    return len(bigrams) - size_bounds(len(bigrams), threshold)[0] + 1


def probe_bigrams(bigrams: list[str], threshold: float) -> list[str]:
    """Bigrams of which any match has one, those of the longest words."""
    return sorted(bigrams, key=lambda b: (max(map(len, b.split())), b), reverse=True)[:_enough(bigrams, threshold)]


def probe_words(bigrams: list[str], threshold: float) -> list[str]:
    """Words of which any match has one: each time the word that most of the
    bigrams not yet covered hold, long words before short ones."""
    words, left = [], set(bigrams)
    need = len(bigrams) - _enough(bigrams, threshold)
    while len(left) > need:
        words.append(max(sorted({w for b in left for w in b.split()}),
                         key=lambda w: (len(w) >= LONG_WORD, sum(w in b.split() for b in left))))
        left = {b for b in left if words[-1] not in b.split()}
    return words


def has_probe(text: Column, grams: list[list[str]], threshold: float) -> Column:
    """Whether a lower-cased text has a probe of any template: long templates'
    words, or a notice's bigram; the pattern is only tried on texts that hold
    both words of one."""
    words = sorted({w for g in grams if len(g) > NOTICE_BIGRAMS for w in probe_words(g, threshold)})
    pairs = sorted({b for g in grams if len(g) <= NOTICE_BIGRAMS for b in probe_bigrams(g, threshold)})
    both = F.lit(False)
    for b in pairs:
        short, long = sorted(b.split(), key=len)
        both = both | (F.contains(text, F.lit(long)) & F.contains(text, F.lit(short)))
    pattern = "|".join(rf"{x}[^\p{{L}}\p{{N}}]+{y}" for x, y in (b.split() for b in pairs))
    found = both & F.rlike(text, F.lit(pattern)) if pairs else both
    for w in words:
        if not any(p != w and p in w for p in words):      # else its part stands for it
            found = F.contains(text, F.lit(w)) | found
    return found


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def sequence_bigrams(unit: Column) -> Column:
    """Word bigrams of a lower-cased unit in their order."""
    words = F.filter(F.split(unit, NOT_WORD), lambda w: w != "")
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b))


def unit_bigrams(unit: Column) -> Column:
    """Distinct word bigrams of a lower-cased unit."""
    return F.array_distinct(sequence_bigrams(unit))


def earlier_places(g: Column) -> Column:
    """For each bigram of a sequence the place (from 1) where it stood last
    before, 0 if nowhere: by sorting bigrams with their places."""
    placed = F.array_sort(F.transform(g, lambda b, i: F.struct(b.alias("b"), (i + 1).alias("at"))))

    def beside(s: Column) -> Column:
        before = F.concat(F.array(F.get(s, F.lit(0))), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))))
        return F.zip_with(s, before, lambda x, y: F.struct(
            x["at"].alias("at"), F.when((x["b"] == y["b"]) & (y["at"] < x["at"]), y["at"]).otherwise(0).alias("last")))

    in_order = F.array_sort(F.flatten(F.transform(F.array(placed), beside)))
    return F.when(F.size(g) > 0, F.transform(in_order, lambda x: x["last"])).otherwise(F.array().cast("array<int>"))


def best_window(g: Column, last: Column, t: Column) -> Column:
    """Best Dice of template ``t`` and its windows in the bigrams ``g``, whose
    ``earlier_places`` are ``last``; null if none can match.

    From each place that begins windows the bigrams are walked once up to the
    greatest size, counting those, and those of the template, that are new to
    the window (last seen before it began), so every size is judged on the way."""
    marked = F.zip_with(g, last, lambda b, p: F.struct(F.array_contains(t["bigrams"], b).alias("hit"), p.alias("last")))

    def over(seq: Column) -> Column:
        final, least = F.greatest(F.size(seq) - t["n"] + 1, F.lit(1)), F.least(t["n"], F.size(seq))

        def from_place(p: Column) -> Column:
            start = F.least(p, final)

            def step(acc: Column, e: Column) -> Column:
                new = e["last"] < start
                size = acc["size"] + F.when(new, 1).otherwise(0)
                shared = acc["shared"] + F.when(new & e["hit"], 1).otherwise(0)
                best = F.when(acc["walked"] + 1 >= least, F.greatest(acc["best"], 2.0 * shared / (size + t["n"]))).otherwise(acc["best"])
                return F.struct(size.alias("size"), shared.alias("shared"), (acc["walked"] + 1).alias("walked"), best.alias("best"))

            zero = F.struct(F.lit(0).alias("size"), F.lit(0).alias("shared"), F.lit(0).alias("walked"), F.lit(0.0).alias("best"))
            return F.aggregate(F.slice(seq, start, t["hi"]), zero, step, lambda acc: acc["best"])

        hits = F.filter(F.transform(seq, lambda e, i: F.when(e["hit"], i + 1)), lambda i: i.isNotNull())
        # places from which enough of the template's bigrams lie within reach
        begins = lambda h: F.filter(h, lambda p, i: F.coalesce(F.get(h, i + t["lo"] - 1) - p < t["hi"], F.lit(False)))
        return F.array_max(F.flatten(F.transform(F.array(hits), lambda h: F.transform(begins(h), from_place))))

    return F.array_max(F.transform(F.array(marked), over))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, ``matches``: the distinct (license, dice) of the document's
    units and of its best window for each template, best first, for every row."""
    grams = [(name, template_bigrams(text)) for name, text in templates]
    probed = lambda text: has_probe(text, [g for _, g in grams], threshold)
    constant = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(len(g)).alias("n"),
                                  F.lit(size_bounds(len(g), threshold)[0]).alias("lo"),
                                  F.lit(size_bounds(len(g), threshold)[1]).alias("hi"),
                                  F.split(F.lit(",".join(g)), ",").alias("bigrams")) for name, g in grams])
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.lower(docs[text_col]).alias("low"))
    text = _lower(F.col("text"))
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, PARAGRAPH), F.array(text)))
    units = F.when(probed(F.col("low")), F.filter(units, probed))

    def compared(unit_grams: Column) -> Column:
        size = F.size(unit_grams)
        fitting = F.filter(constant, lambda t: size.between(t["lo"], t["hi"]))
        return F.transform(fitting, lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(unit_grams, t["bigrams"])) / (size + t["n"])).alias("minus"),
            t["license"].alias("license")))

    scores = F.flatten(F.transform(units, lambda u: compared(unit_bigrams(u))))
    best = F.array_distinct(F.filter(scores, lambda m: -m["minus"] >= threshold))
    every = F.split(F.lit(",".join(dict.fromkeys(b for _, g in grams for b in g))), ",")

    def windowed(g: Column) -> Column:
        # templates of which the text holds enough bigrams
        held = lambda common: F.filter(constant, lambda t: F.size(F.array_intersect(common, t["bigrams"])) >= t["lo"])
        fitting = F.flatten(F.transform(F.array(F.array_intersect(g, every)), held))
        return F.flatten(F.transform(F.array(fitting), lambda ts: F.when(F.size(ts) > 0, F.flatten(F.transform(
            F.array(earlier_places(g)), lambda last: F.transform(ts, lambda t: F.struct(
                (-best_window(g, last, t)).alias("minus"), t["license"].alias("license"))))))))

    rows = rows.select("doc_id", "text", best.alias("best"))
    whole = F.when(F.col("best").isNotNull(), F.array(sequence_bigrams(text)))
    windows = F.coalesce(F.flatten(F.transform(whole, windowed)), F.array().cast("array<struct<minus:double,license:string>>"))
    ordered = F.array_sort(F.array_distinct(F.concat("best", F.filter(windows, lambda m: -m["minus"] >= threshold))))
    matches = F.transform(ordered, lambda m: F.struct(m["license"].alias("license"), (-m["minus"]).alias("dice")))
    empty = F.array().cast("array<struct<license:string,dice:double>>")
    return rows.select("doc_id", F.coalesce(matches, empty).alias("matches"))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, the best licence and its Dice, and all licences found, for every document."""
    found = scan(read_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select("doc_id", F.get("matches", F.lit(0))["license"].alias("license"),
                        F.get("matches", F.lit(0))["dice"].alias("dice"), F.array_join(names, ",").alias("licenses"))


def _op4_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n    ".join(f"({quoted(name)}, [{', '.join(map(quoted, template_bigrams(text)))}])" for name, text in TEMPLATES)
    return rf"""
WITH templates(license, bigrams) AS (VALUES
    {rows}),
lowered AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
units AS (
  SELECT row, unnest(list_distinct(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\n[ \t\r]*\n'), [text]))) AS unit
  FROM lowered),
words AS (SELECT row, list_filter(regexp_split_to_array(unit, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM units),
grams AS (
  SELECT row, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g FROM words
  WHERE len(w) >= 2),
scores AS (
  SELECT row, license, 2.0 * len(list_intersect(g, bigrams)) / (len(g) + len(bigrams)) AS dice
  FROM grams, templates WHERE len(g) BETWEEN len(bigrams) / 2 AND len(bigrams) * 2),
whole AS (SELECT row, list_filter(regexp_split_to_array(text, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM lowered),
runs AS (SELECT row, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] AS g FROM whole WHERE len(w) >= 2),
sized AS (
  SELECT license, bigrams, len(bigrams) AS n, CAST(ceil({THRESHOLD} / (2 - {THRESHOLD}) * len(bigrams) - 1e-9) AS INTEGER) AS lo,
         CAST(floor((2 - {THRESHOLD}) / {THRESHOLD} * len(bigrams) + 1e-9) AS INTEGER) AS hi FROM templates),
held AS (SELECT row, g, s.* FROM runs, sized s WHERE len(list_intersect(list_distinct(g), bigrams)) >= lo),
hits AS (SELECT *, list_filter(range(1, len(g) + 1), lambda i: list_contains(bigrams, g[i])) AS spots FROM held),
places AS (
  SELECT row, license, n, hi, g, bigrams, p, greatest(1, least(p, len(g) - n + 1)) AS begin_at
  FROM (SELECT *, unnest(spots) AS p FROM hits) h WHERE len(list_filter(spots, lambda q: q >= p AND q - p < hi)) >= lo),
windows AS (
  SELECT row, license, n, bigrams, list_distinct(g[begin_at:begin_at + size - 1]) AS u
  FROM (SELECT *, unnest(range(least(n, len(g)), hi + 1)) AS size FROM places) w),
best_windows AS (SELECT row, license, 2.0 * len(list_intersect(u, bigrams)) / (len(u) + n) AS dice FROM windows),
found AS (
  SELECT row, license, max(dice) AS dice FROM (SELECT * FROM scores UNION ALL SELECT * FROM best_windows)
  WHERE dice >= {THRESHOLD} GROUP BY row, license),
best AS (
  SELECT row, arg_min(license, (-dice, license)) AS license, max(dice) AS dice,
         string_agg(license, ',' ORDER BY license) AS licenses
  FROM found GROUP BY row)
SELECT doc_id, license, dice, coalesce(licenses, '') AS licenses FROM lowered LEFT JOIN best USING (row)
"""


OP4_SQL = _op4_sql()
