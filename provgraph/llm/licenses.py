"""License scans with DataFrame functions only.

A text's segments (its lines, paragraphs and sentences and the text as a whole,
each once) are normalised to lower-case ASCII words and compared with licence templates by the Dice
coefficient over their sets of word bigrams. A template is a candidate only
where the sizes allow the threshold: with n and m bigrams the coefficient is at
most 2 min(n, m) / (n + m). Such a match also shares at least t m / (2 - t) of the
m bigrams of its template, so that it holds one of a few telling words; texts and
segments without any of them are passed over, which loses no match. Templates are constants of the plan, so there is no
join and no shuffle.

Defined results: null text counts as empty; segments of fewer than two words
match nothing; without a match the licence is null and the coefficient 0. The
licence is that of the longest match, by bigrams in common; equal ones go to the
larger coefficient, then to the first licence id. Sentences end at `.!?` before
white space, across lines, and at U+0001. Bigrams are compared by 64-bit hashes.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import let, text_of

THRESHOLD = 0.7

#: Fixed parts of licence texts.
BSD_INTRO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_DISCLAIMER = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'
MIT_DISCLAIMER = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'

#: Fixed licence notices and texts, (id, text); `BSD` stands for what BSD-2-Clause and BSD-3-Clause share.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD", BSD_INTRO),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", f"{BSD_INTRO} {BSD_1} {BSD_2} {BSD_DISCLAIMER}"),
    ("BSD-3-Clause", BSD_3),
    ("BSD-3-Clause", f"{BSD_INTRO} {BSD_1} {BSD_2} 3. {BSD_3} {BSD_DISCLAIMER}"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", ISC_GRANT),
    ("ISC", f"{ISC_GRANT} {ISC_DISCLAIMER}"),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", MIT_GRANT),
    ("MIT", f"{MIT_GRANT} {MIT_DISCLAIMER}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
)


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def template_bigrams(text: str) -> list[tuple[str, str]]:
    words = template_words(text)
    return sorted(set(zip(words, words[1:], strict=False)))


def bigram_hash(a: str, b: str) -> int:
    """What Spark's xxhash64(a, b) gives: the hash of `a`, seeded by 42, seeds that of `b`."""
    value = 42
    for word in (a, b):
        value = xxhash.xxh64_intdigest(word.encode(), seed=value)
    return value - (1 << 64) if value >> 63 else value


#: Frequent words, which tell little.
FREQUENT = frozenset("a above all an and any are as at be been by can for from has have if in is it its may not of on one only or other out permitted that the this to under use whatever which will with work without you your".split())


def telling_words(threshold: float = THRESHOLD) -> list[str]:
    """Words of which every match of a template holds at least one.

    They cover more than 1 - t / (2 - t) of the bigrams of each template, chosen by how many they add.
    """
    chosen: set[str] = set()
    for pairs in sorted((template_bigrams(text) for _, text in TEMPLATES), key=lambda p: (len(p), p)):
        while len(open_ := [p for p in pairs if not chosen & set(p)]) >= len(pairs) * threshold / (2 - threshold):
            words = sorted({w for p in open_ for w in p})
            chosen.add(max(words, key=lambda w: (w not in FREQUENT, sum(w in p for p in open_), w)))
    return sorted(chosen)


def _any_of(words: list[str]) -> str:
    """A pattern for any of the words, which looks at a word's first letter once."""
    first = sorted({w[0] for w in words})
    return r"\b(?:" + "|".join(f"{c}(?:{'|'.join(w[1:] for w in words if w[0] == c)})" for c in first) + r")\b"


def _hashed(words: Column) -> Column:
    """Distinct bigrams of a list of words, as hashes."""
    n = F.size(words)
    return F.when(n >= 2, F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1))))).otherwise(F.array().cast("array<bigint>"))


#: Ends of sentences, and the mark that stands for them.
SENTENCE_END = r"[.!?]+[\x20\x09-\x0D]+"
MARK = "\x01"


def segments(text: Column, threshold: float = THRESHOLD) -> Column:
    """Normalised lines, paragraphs and sentences of a text and the whole of it, each once; those without a telling word are left out."""
    telling = _any_of(telling_words(threshold))

    def parts(low: Column, whole: Column) -> Column:
        lines = F.regexp_replace(low, "[^a-z0-9\n]+", " ")
        sentences = F.split(F.regexp_replace(F.regexp_replace(low, SENTENCE_END, MARK), r"[^a-z0-9\x01]+", " "), MARK, -1)
        return F.concat(F.split(lines, "\n", -1), F.transform(F.split(lines, "\n *\n", -1), lambda p: F.regexp_replace(p, " *\n *", " ")), sentences, F.array(whole))

    def told(low: Column) -> Column:
        return let(F.regexp_replace(low, "[^a-z0-9]+", " "), lambda whole: F.when(whole.rlike(telling), parts(low, whole)).otherwise(F.array().cast("array<string>")))

    return F.array_distinct(F.transform(F.filter(let(F.lower(text), told), lambda s: s.rlike(telling)), lambda s: F.trim(s)))


def _templates() -> Column:
    """All templates as one constant: licence, bigram hashes."""
    each = [F.struct(F.lit(name).alias("license"), F.lit([bigram_hash(a, b) for a, b in template_bigrams(text)]).cast("array<bigint>").alias("grams")) for name, text in TEMPLATES]
    return F.array(*each)


def _matches(grams: Column, threshold: float) -> Column:
    """(common, dice, licence) structs of one segment's bigrams with every template that the sizes allow."""

    def compared(t: Column) -> Column:
        n, m = F.size(grams), F.size(t["grams"])
        possible = (n * (2 - threshold) >= m * threshold) & (n * threshold <= m * (2 - threshold))
        common = F.when(possible, F.size(F.array_intersect(grams, t["grams"]))).otherwise(F.lit(0))
        return let(common, lambda c: F.struct(c.alias("common"), (c * F.lit(2.0) / (n + m)).alias("dice"), t["license"].alias("license")))

    return F.filter(F.transform(_templates(), compared), lambda x: x["dice"] >= threshold)


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licenses (ids found, in order, comma-joined), n_segments that match, license of the longest match and its coefficient."""

    def per_segment(s: Column) -> Column:
        return let(let(F.array_remove(F.split(s, " "), ""), _hashed), lambda g: _matches(g, threshold))

    hits = F.filter(F.transform(segments(text_of(text), threshold), per_segment), lambda x: F.size(x) > 0)

    def report(h: Column) -> Column:
        flat = F.flatten(h)
        best = F.get(F.sort_array(F.transform(flat, lambda x: F.struct((-x["common"]).alias("few"), (-x["dice"]).alias("low"), x["license"].alias("license")))), F.lit(0))
        return F.struct(
            F.array_join(F.array_sort(F.array_distinct(F.transform(flat, lambda x: x["license"]))), ",").alias("licenses"),
            F.size(h).cast("long").alias("n_segments"),
            best["license"].alias("license"),
            F.round(F.coalesce(-best["low"], F.lit(0.0)), 6).alias("dice"),
        )

    return docs.select(F.col(doc_id).alias("doc_id"), let(hits, report).alias("found")).select("doc_id", "found.*")


def oracle_sql(threshold: float = THRESHOLD) -> str:
    rows = []
    for k, (name, text) in enumerate(TEMPLATES):
        pairs = template_bigrams(text)
        rows += [f"({k}, '{name}', {len(pairs)}, '{a} {b}')" for a, b in pairs]
    return f"""
WITH tpl(k, license, m, gram) AS (VALUES {", ".join(rows)}),
d AS (SELECT *, regexp_replace(low, '[^a-z0-9\\n]+', ' ', 'g') AS t FROM (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS low FROM documents)),
s AS (SELECT DISTINCT rid, trim(seg) AS seg FROM (
  SELECT rid, unnest(string_split(t, chr(10))) AS seg FROM d
  UNION ALL SELECT rid, unnest(list_transform(regexp_split_to_array(t, '\\n *\\n'), lambda p: regexp_replace(p, ' *\\n *', ' ', 'g'))) FROM d
  UNION ALL SELECT rid, unnest(string_split(regexp_replace(regexp_replace(low, '{SENTENCE_END}', chr(1), 'g'), '[^a-z0-9\\x01]+', ' ', 'g'), chr(1))) FROM d
  UNION ALL SELECT rid, regexp_replace(low, '[^a-z0-9]+', ' ', 'g') FROM d)),
w AS (SELECT rid, seg, list_filter(string_split(seg, ' '), lambda x: x <> '') AS ws FROM s),
g AS (SELECT DISTINCT rid, seg, ws[i] || ' ' || ws[i + 1] AS gram FROM (SELECT rid, seg, ws, unnest(range(1, len(ws))) AS i FROM w)),
n AS (SELECT rid, seg, count(*) AS n FROM g GROUP BY rid, seg),
c AS (SELECT rid, seg, k, license, m, count(*) AS common FROM g JOIN tpl USING (gram) GROUP BY ALL),
h AS (SELECT rid, seg, license, common, 2.0::DOUBLE * common / (n + m) AS dice FROM c JOIN n USING (rid, seg) WHERE 2.0::DOUBLE * common / (n + m) >= {threshold}),
r AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT seg) AS n_segments,
        first(license ORDER BY common DESC, dice DESC, license) AS license, round(first(dice ORDER BY common DESC, dice DESC, license), 6) AS dice FROM h GROUP BY rid)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_segments, 0)::BIGINT AS n_segments, license, coalesce(dice, 0.0)::DOUBLE AS dice FROM d LEFT JOIN r USING (rid)
"""
