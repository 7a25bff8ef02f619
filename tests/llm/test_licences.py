from colloquy.llm import licences
from colloquy.llm.licences import KNOWN


def known(spark):
    return spark.createDataFrame(list(KNOWN), "licence string, text string")


def scanned(spark, docs, some=None):
    rows = licences.scan(spark, docs, known(spark) if some is None else some).collect()
    return {r.doc_id: (r.licence, [tuple(n) for n in r.notices]) for r in rows}


MIT = next(text for name, text in KNOWN if text.startswith("MIT License"))


def test_texts_equal_but_for_what_does_not_matter(spark, table):
    variants = [
        MIT,
        MIT.upper(),
        MIT.replace("Copyright (c) <year> <copyright holders>", "Copyright © 2021-2024 Some Body\nCopyright (c) 2020 Else\nAll rights reserved."),
        MIT.replace("sublicense", "sub-license").replace("AUTHORS", "authors").replace(",", " ,"),
        " ".join(MIT.replace("Copyright (c) <year> <copyright holders>", "").split()),
    ]
    got = scanned(spark, table(list(enumerate(variants))))
    assert [got[i][0] for i in range(5)] == ["MIT"] * 5
    other = [MIT.replace("WITHOUT WARRANTY", "WITH WARRANTY"), MIT + " more", MIT[:400]]
    assert [v for v in scanned(spark, table(list(enumerate(other)))).values()] == [(None, [])] * 3


def test_notices_in_lines(spark, table):
    text = "prose\nlicensed under the Apache Licence -- version 2.0\nmore\n  Released under the MIT license\nLicensed under CC BY-NC 4.0. not alone"
    assert scanned(spark, table([(1, text)])) == {1: (None, [(1, "Apache-2.0"), (3, "MIT")])}
    assert scanned(spark, table([(1, "Released under the MIT License.")])) == {1: ("MIT", [(0, "MIT")])}


def test_odd_rows_and_empty_tables(spark, table, odd_rows):
    got = scanned(spark, table(odd_rows))
    assert set(got) == {k for k, _ in odd_rows} and set(map(str, got.values())) == {"(None, [])"}
    assert scanned(spark, table([])) == {}
    none = spark.createDataFrame([(None, "x"), ("y", None), ("z", "...")], "licence string, text string")
    assert scanned(spark, table([(1, "x"), (2, "..."), (3, None)]), none) == {1: (None, []), 2: (None, []), 3: (None, [])}
    rows = [(1, "Released under the MIT License."), (1, "Licensed under CC BY 4.0."), (None, "Licensed under CC BY 4.0.")]
    assert scanned(spark, table(rows)) == {1: ("CC-BY-4.0", [(0, "CC-BY-4.0"), (0, "MIT")]), None: ("CC-BY-4.0", [(0, "CC-BY-4.0")])}


COMMON = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1",
    "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


def test_whole_texts_of_common_licences(spark, table):
    rows = [(i, open(f"/usr/share/common-licenses/{name}", encoding="utf-8").read().upper()) for i, name in enumerate(COMMON)]
    rows += [(100 + i, text) for i, (_, text) in enumerate(KNOWN) if "\n" in text]
    got = scanned(spark, table(rows))
    assert [got[i][0] for i in range(len(COMMON))] == list(COMMON.values())
    assert all(got[100 + i][0] == name for i, (name, text) in enumerate(KNOWN) if "\n" in text)


def test_usual_notices(spark, table):
    lines = {
        "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        "This software is released under the Mozilla Public License, v. 2.0": "MPL-2.0",
        "This program is distributed under the GNU Lesser General Public Licence, version 2.1.": "LGPL-2.1",
        "// SPDX-License-Identifier: GPL-3.0": "GPL-3.0",
    }
    got = scanned(spark, table(list(enumerate(lines))))
    assert [got[i][1] for i in range(len(lines))] == [[(0, name)] for name in lines.values()]
    by_text = {}
    for name, text in KNOWN:  # no notice stands for two licences
        assert by_text.setdefault(" ".join(text.lower().split()), name) == name
