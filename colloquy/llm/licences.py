"""License scans by digests of normalised texts.

A text and a known licence are equal if they differ only in case, punctuation,
white space, copyright lines and spellings that licences treat alike. Both are
normalised the same way and joined by the digest of what is left. Looked up are
the whole text and each of its lines as a text of its own, so a notice in a
document is found as well as a document that is a licence.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored

C = F.col

#: Spellings that licences treat alike, and the one taken for both.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("colour", "color"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("non commercial", "noncommercial"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
#: A line that states a copyright or reserves rights, and says nothing else of the licence.
COPYRIGHT = r"^[^\p{L}\p{N}©(]*(copyright( \(c\)| ©| [0-9]|:)|\(c\) |© ?)|^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$"
SIGNS = r"[^\p{L}\p{N}]+"
#: Names that notices give a licence, and ways to give notice.
NAMES = (
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License")),
    ("MIT", ("MIT License", "MIT licence terms")),
    ("ISC", ("ISC License",)),
    ("Zlib", ("zlib License",)),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License")),
    ("MPL-1.1", ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1")),
    ("MPL-2.0", ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0")),
    *(
        (f"{short}-{n}", tuple(f"{name}{by}{v}" for name in (full, f"GNU {short}", short) for v in dict.fromkeys((n, n.removesuffix(".0"))) for by in (", version ", " v", " ")))
        for short, full, versions in (
            ("GPL", "GNU General Public License", ("1.0", "2.0", "3.0")),
            ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
            ("LGPL", "GNU Library General Public License", ("2.0",)),
            ("AGPL", "GNU Affero General Public License", ("3.0",)),
            ("GFDL", "GNU Free Documentation License", ("1.2", "1.3")),
        )
        for n in versions
    ),
    *(
        (f"CC-{kind}-4.0", (f"CC {kind} 4.0", f"CC {kind} 4.0 license", f"Creative Commons {full} 4.0 International License"))
        for kind, full in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
    ("CC0-1.0", ("CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 license")),
    ("Unlicense", ("Unlicense",)),
)
SUBJECTS = ("", "This work is ", "This software is ", "This program is ", "This project is ")
VERBS = ("licensed under", "released under", "distributed under")


def notices() -> list[tuple[str, str]]:
    """Each way to say that something is under each licence, in one line, and the tag of each."""
    said = [(licence, f"{s}{v} {the}{name}") for licence, names in NAMES for name in names for s in SUBJECTS for v in VERBS for the in ("", "the ")]
    return said + [(licence, f"SPDX-License-Identifier: {licence}") for licence, _ in NAMES]


def whole_texts() -> list[tuple[str, str]]:
    """The licences of the folder beside this module; also without what follows the end of the terms."""
    rows = []
    for file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
        licence, text = file.stem.removesuffix(".regents"), file.read_text(encoding="utf-8")
        rows.append((licence, text))
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        if end:
            rows += [(licence, terms), (licence, terms + end)]
    return rows


#: Notices and licences, by identifier.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "MIT",
        """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    ),
    (
        "ISC",
        """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
""",
    ),
    (
        "Zlib",
        """zlib License

(C) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    ),
    *whole_texts(),
    *notices(),
)


def plain_lines(text: Column) -> Column:
    """The lines of a text, normalised; copyright lines become empty."""

    def plain(line: Column) -> Column:
        out = F.trim(F.regexp_replace(line, SIGNS, " "))
        for spelling, taken in SPELLINGS:
            out = F.replace(out, F.lit(spelling), F.lit(taken))
        return F.when(line.rlike(COPYRIGHT), F.lit("")).otherwise(out)

    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), plain)


def digest(plain: Column) -> Column:
    """Null for a text of which nothing is left."""
    return F.when(plain != "", F.sha2(plain, 256))


def whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_digests(known: DataFrame, licence: str = "licence", text: str = "text") -> DataFrame:
    """``digest, licence``; of licences with equal digests the first in order. Empty ones are left out."""
    rows = known.select(C(licence).alias("licence"), digest(whole(plain_lines(C(text)))).alias("digest"))
    return rows.where("digest IS NOT NULL AND licence IS NOT NULL").groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(spark: SparkSession, docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, licence, notices`` for each key: the licence that the whole text is, and those of single lines.

    ``notices`` are ``struct<line, licence>`` by line, counted from 0. A text that
    is no known licence has a null ``licence``; null and empty texts and lines
    match nothing. Rows of one key, or without a key, are one document with
    several texts. An empty table of known licences matches nothing. Other
    columns are not read.

    Only digests are joined, and the size of the written table of known ones
    tells Spark whether to broadcast it.
    """
    store = Stored(spark, "licences")
    digests = store.put(known_digests(known))
    lines = docs.select(C(key).alias("key"), plain_lines(C(text)).alias("lines"))
    units = F.concat(
        F.array(F.struct(F.lit(-1).alias("line"), digest(whole(C("lines"))).alias("digest"))),
        F.transform("lines", lambda x, n: F.struct(n.alias("line"), digest(x).alias("digest"))),
    )
    looked_up = lines.select("key", F.explode(F.filter(units, lambda u: u["digest"].isNotNull())).alias("unit"))
    found = looked_up.select("key", "unit.line", "unit.digest").join(digests, "digest").select("key", "line", "licence")
    every = docs.select(C(key).alias("key"), F.lit(None).cast("int").alias("line"), F.lit(None).cast("string").alias("licence"))
    notice = F.when(C("line") >= 0, F.struct("line", "licence"))
    return (
        found.unionByName(every)
        .groupBy(C("key").alias(key))
        .agg(
            F.min(F.when(C("line") == -1, C("licence"))).alias("licence"),
            F.array_sort(F.collect_list(notice)).alias("notices"),
        )
    )
