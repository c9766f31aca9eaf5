"""Licence lookup by the digest of a canonical text.

A text is put into a canonical form (lower case, copyright lines removed,
equivalent spellings made one, every run of other characters than letters and
digits made one space) and the digest of the whole of it is hash-joined to the
digests of known licences.  What stands beside other text is looked up the same
way: each line ("Released under the ..."), and each block, the largest run of
lines between rules or two blank lines, so a licence behind a readme is found.

Known texts are a table (``KNOWN``: whole texts in ``license_texts``, short
ones here, notices made from verbs and names) or the caller's.  It is counted:
up to ``MOST_KNOWN`` digests are broadcast, more are joined by a shuffle.

A null or empty text matches nothing.  Texts of any length are read whole, in
the memory of a row.  Of known texts with one digest the smallest id counts.
Repeated rows each get their row; extra columns are ignored whatever their
names; an empty table gives an empty result, an empty list of known texts
finds nothing.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch

#: Up to so many known digests are broadcast, in as many maps.
MOST_KNOWN, SLOTS = 20_000, 1024

#: (pattern, replacement) in order, over lower-case text, both in Java's regex
#: and in RE2.  ``{1}`` stands for the first group.
COPYRIGHT_LINES = (
    r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright[ \t]*(?:\(c\)|©|:|<|\[|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©)[^\n]*$",
    r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$",
)
#: Between blocks: two blank lines or more, or a line of marks.
RULES = r"\n(?:[ \t\r]*\n){2,}|\n[ \t]*[-=*_#~]{3,}[ \t\r]*\n"
OTHER_CHARACTERS = r"[^\p{L}\p{N}\n]+"
SPELLINGS = (
    (r"\blicenc(e|es|ed|ee|ing|or)\b", "licens{1}"),
    (r"\bsub licens", "sublicens"),
    (r"\b(organ|author|recogn|util|capital|categor|emphas|initial|maxim|minim|optim|real)is(e|es|ed|ing|ation|ations)\b", "{1}iz{2}"),
    (r"\b(fav|lab|hon|behavi|endeav)our", "{1}or"),
    (r"\b(judg|acknowledg)ement", "{1}ment"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\b(?:whilst|amongst)\b", "while"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZERO_HEAD, _ZERO_TAIL = _ISC.split(", provided that the above copyright notice and this permission notice appear in all copies")

#: Known texts, (id, text); the titles that some carry are variants of their own.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("Zlib", _ZLIB),
    ("0BSD", _ZERO_HEAD + _ZERO_TAIL),
    ("0BSD", "BSD Zero Clause License\n\n" + _ZERO_HEAD + _ZERO_TAIL),
    ("MIT-0", _MIT.replace(", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "")),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org/>"),
    ("BSL-1.0", _BOOST),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + _BOOST),
    ("Apache-2.0", _APACHE_NOTICE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

VERBS = ("Licensed under", "Released under", "This work is licensed under")
#: Names of licences as notices give them, by id.
NAMES = {
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MPL-1.1": ("Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "CC0-1.0": ("CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero 1.0 Universal"),
}
GNU = (("GPL", "GNU General Public License", "1 2 3"), ("LGPL", "GNU Library General Public License", "2"), ("LGPL", "GNU Lesser General Public License", "2.1 3"), ("AGPL", "GNU Affero General Public License", "3"))
CREATIVE_COMMONS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CREATIVE_COMMONS_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CREATIVE_COMMONS_VERSIONS = (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic"))


def _names() -> list[tuple[str, str]]:
    """(id, name) of the licences that a notice of one line may name."""
    out = [(i, name) for i, names in NAMES.items() for name in names]
    for short, long, versions in GNU:
        for v in versions.split():
            i = f"{short}-{v if '.' in v else v + '.0'}"
            out += [(i, name) for n in {v, i.split("-")[1]} for name in (f"{long}, version {n}", f"{long} v{n}", f"{long} {n}", f"{short} {n}", f"{short}v{n}")]
    for kind in CREATIVE_COMMONS_KINDS:
        for v, area in CREATIVE_COMMONS_VERSIONS:
            words = "-".join(CREATIVE_COMMONS[x] for x in kind.split("-"))
            forms = {words, words.replace("NoDerivatives", "NoDerivs")}
            names = {f"CC {kind} {v}", f"Creative Commons {kind} {v}"} | {f"Creative Commons {x} {v}{y}" for x in forms for y in ("", " " + area)}
            out += [(f"CC-{kind}-{v}", name) for name in sorted(names)]
    return out


def _notices() -> list[tuple[str, str]]:
    """Notices of one line: the name alone, and with an article and the word licence."""
    out = set()
    for i, name in _names():
        bare = name.removesuffix(" License")
        for x in (name, f"the {name}", f"the {bare} License", f"a {bare} License"):
            out |= {(i, f"{verb} {x}.") for verb in VERBS}
    return sorted(out)


def _whole_texts() -> list[tuple[str, str]]:
    """The whole texts with http or https in their links, with and without what follows their terms."""
    out = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = file.read_text("utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        for x in (text, terms + end, terms) if end else (text,):
            plain = x.replace("https://", "http://")
            out += [(file.stem.split("_")[0], t) for t in dict.fromkeys((x, plain, plain.replace("http://", "https://")))]
    return out


KNOWN += (*_whole_texts(), *_notices())


def _canonical(text: Column) -> Column:
    """What is left of each line of a text in lower case, trimmed."""
    for pattern in COPYRIGHT_LINES:
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(text, OTHER_CHARACTERS, " ")
    for pattern, to in SPELLINGS:
        text = F.regexp_replace(text, pattern, to.replace("{1}", "$1").replace("{2}", "$2"))
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def canonical_blocks(text: Column) -> Column:
    """The canonical lines of each block of a text."""
    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), RULES), _canonical)


def _joined(lines: Column) -> Column:
    return F.array_join(lines, " ")


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license_id) of the known texts, one row per digest; ``known`` is a list or a table (license_id, text)."""
    table = known if isinstance(known, DataFrame) else spark.createDataFrame(list(known), "license_id string, text string")
    table = table.select("license_id", _joined(F.flatten(canonical_blocks(F.col("text")))).alias("text")).filter("text <> '' AND license_id IS NOT NULL")
    return table.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def _by_maps(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``notices`` from constant maps of the known digests, at most ``MOST_KNOWN``: no row per line is made."""
    # a map is searched from its start, so each holds the few digests of one slot
    slot = lambda digest: F.pmod(F.xxhash64(digest), F.lit(SLOTS)).cast("int")
    slots: list[list[Column]] = [[] for _ in range(SLOTS)]
    for row in table.withColumn("slot", slot(F.col("digest"))).orderBy("digest").collect():
        slots[row.slot] += [F.lit(row.digest), F.lit(row.license_id)]
    maps = F.array(*[F.create_map(*x) if x else F.create_map().cast("map<string,string>") for x in slots])

    def find(unit: Column) -> Column:
        digest = F.sha2(unit, 256)
        return F.try_element_at(F.get(maps, slot(digest)), digest)

    names = F.array_sort(F.array_distinct(F.filter(F.transform("units", find), lambda x: x.isNotNull())))
    return rows.select("id", "digest", F.array_join(names, ",").alias("notices"), "some")


def _by_join(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``notices`` from a join of all lines and blocks."""
    rows = Scratch(rows.sparkSession, "licenses").save(rows.withColumn("row", F.monotonically_increasing_id()), "units")
    units = rows.select("row", F.explode("units").alias("unit")).select("row", F.sha2("unit", 256).alias("unit"))
    found = units.join(table.select(F.col("digest").alias("unit"), "license_id"), "unit").groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    return rows.join(found, "row", "left").select("id", "digest", F.coalesce("notices", F.lit("")).alias("notices"), "some")


def scan(docs: DataFrame, row_id: str = "doc_id", text: str = "text", known=KNOWN) -> DataFrame:
    """Per row: the id, ``digest`` of the whole canonical text, ``license_id``
    of the known text with that digest or null, and ``notices``: the ids of
    the lines and blocks that are known texts by themselves, distinct and in
    order, joined by commas (empty: none).
    """
    table = known_digests(docs.sparkSession, known)
    few = table.count() <= MOST_KNOWN
    blocks = docs.select(F.col(row_id).alias("id"), F.inline(F.array(F.struct(canonical_blocks(F.col(text)).alias("blocks")))))
    lines = F.flatten("blocks")
    units = F.array_distinct(F.concat(lines, F.transform("blocks", _joined)))
    rows = blocks.select("id", F.sha2(_joined(lines), 256).alias("digest"), units.alias("units"), (F.size(lines) > 0).alias("some"))
    rows = (_by_maps if few else _by_join)(rows, table)
    found = rows.join(F.broadcast(table) if few else table, "digest", "left")
    return found.select(F.col("id").alias(row_id), "digest", F.when(F.col("some"), F.col("license_id")).alias("license_id"), "notices")


def oracle(table: str = "documents") -> str:
    """The same in DuckDB's SQL."""

    def lit(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canon(t: str) -> str:
        for pattern in COPYRIGHT_LINES:
            t = f"regexp_replace({t}, {lit(pattern)}, '', 'g')"
        t = f"regexp_replace({t}, {lit(OTHER_CHARACTERS)}, ' ', 'g')"
        for pattern, to in SPELLINGS:
            t = f"regexp_replace({t}, {lit(pattern)}, {lit(to.replace('{1}', chr(92) + '1').replace('{2}', chr(92) + '2'))}, 'g')"
        return f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"

    def blocks(column: str) -> str:
        return f"list_transform(regexp_split_to_array(lower(coalesce({column}, '')), {lit(RULES)}), lambda b: {canon('b')})"

    rows = ", ".join(f"({lit(a)}, {lit(b)})" for a, b in KNOWN)
    return f"""
WITH known AS (
  SELECT sha256(array_to_string(flatten({blocks("t")}), ' ')) AS digest, min(license_id) AS license_id
  FROM (VALUES {rows}) AS k(license_id, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS rn, doc_id, {blocks("text")} AS blocks FROM {table}),
whole AS (SELECT rn, doc_id, flatten(blocks) AS lines, list_distinct(list_concat(flatten(blocks), list_transform(blocks, lambda b: array_to_string(b, ' ')))) AS units FROM docs),
found AS (
  SELECT rn, array_to_string(list_sort(list_distinct(list(license_id))), ',') AS notices
  FROM (SELECT rn, unnest(units) AS x FROM whole) l JOIN known k ON sha256(l.x) = k.digest GROUP BY rn)
SELECT w.doc_id, sha256(array_to_string(lines, ' ')) AS digest, CASE WHEN len(lines) > 0 THEN k.license_id END AS license_id, coalesce(f.notices, '') AS notices
FROM whole w LEFT JOIN known k ON sha256(array_to_string(lines, ' ')) = k.digest LEFT JOIN found f ON w.rn = f.rn"""
