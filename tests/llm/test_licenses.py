import math
from collections import Counter
from pathlib import Path

from docsync.llm import licenses
from docsync.llm.licenses import LEAST, TEMPLATES, best, scan, terms

FILES = [
    ("LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("a.txt", "nothing here"),
    ("src/b.txt", "code\nReleased under the MIT License.\nmore"),
    ("src/c.txt", "code of the general kind"),
    ("src/deep/er/d.txt", None),
    ("lib/COPYING.md", "This work is licensed under the GNU General Public License, version 3."),
    ("lib/x/e.txt", "public"), ("lib/x/LICENCE", "no notice"), ("lib/x/y/f.txt", ""),
    ("lib/z/LICENSE", "Licensed under CC BY-NC 4.0."), ("lib/z/NOTICE", "All rights reserved."),
    ("lib/z/g.txt", "words " * 5000),
    ("other/license-not.txt", "This sentence says that a version of the public was released"),
    (None, "All rights reserved."), (None, "no path"),
]


def by_hand(files):
    docs = [Counter(terms((t or "").lower())) for _, t in files]
    counted = {n: Counter(terms(t.lower())) for n, t in TEMPLATES.items()}
    df = {t: sum(t in d for d in docs) for c in counted.values() for t in c}
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
    vectors = {n: {t: k * idf[t] for t, k in c.items()} for n, c in counted.items()}
    own = []
    for _, text in files:
        found = [best(s, vectors, idf, math.log(1 + len(docs)) + 1)
                 for s in (text or "").lower().split("\n")]
        top = max(found, key=lambda f: f[0])
        own.append(top if top[0] >= LEAST else None)
    given = {}
    for (path, _), o in zip(files, own):
        name = (path or "").split("/")[-1].upper()
        if path and o and name.split(".")[0].split("-")[0] in ("LICENSE", "LICENCE", "COPYING", "NOTICE"):
            folder = path.rpartition("/")[0]
            given[folder] = min(given.get(folder, (0, "~")), (-round(o[0], 6), o[1]))
    out = {}
    for (path, _), o in zip(files, own):
        license, source = (o[1], None) if o else (None, None)
        folder = path.rpartition("/")[0] if path and not o else None
        while folder is not None:
            if folder in given:
                license, source = given[folder][1], folder
                break
            folder = folder.rpartition("/")[0] if folder else None
        out.setdefault((path, o and o[1], license, source), 0)
        out[path, o and o[1], license, source] += 1
    return out


def test_notices_and_inheritance(spark):
    out = scan(spark.createDataFrame(FILES, "path string, text string").repartition(3))
    found = Counter((r.path, r.own_license, r.license, r.inherited_from) for r in out.collect())
    assert found == by_hand(FILES)
    named = {r.path: (r.license, r.inherited_from) for r in out.collect()}
    assert named["src/c.txt"] == ("Apache-2.0", "")
    assert named["src/deep/er/d.txt"] == ("Apache-2.0", "")
    assert named["lib/x/y/f.txt"] == ("GPL-3.0", "lib")
    assert named["src/b.txt"] == ("MIT", None)


def test_every_template_finds_itself(spark):
    rows = [(f"{n}.txt", f"intro\n{t}.\nend") for n, t in TEMPLATES.items()]
    out = scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path[:-4]: r.own_license for r in out} == {n: n for n in TEMPLATES}


def test_odd_rows(spark):
    frame = spark.createDataFrame(FILES + FILES[:4], "path string, text string").selectExpr(
        "*", "'x' AS license_", "1 AS depth", "'y' AS giver_", "'z' AS lines")
    assert scan(frame).count() == len(FILES) + 4
    assert scan(frame.limit(0)).collect() == []


def test_extra_words_never_sink_a_notice(spark):
    notices = {"Apache-2.0": "Licensed under the Apache License, Version 2.0. See LICENSE.",
               "GPL-3.0": "This work is licensed under the GNU General Public License, version 3 or later.",
               "MIT": "We say that this project is released under the MIT License, and more so."}
    not_one = ["Licensed under the Foo License, Version 2.0", "GNU General Public License",
               "the apache foundation released version 2.0 of its license"]
    for n in (10, 3000):
        rows = [(f"{k}.txt", t) for k, t in notices.items()] + [(f"{i}", t) for i, t in enumerate(not_one)]
        frame = spark.createDataFrame(rows, "path string, text string").unionByName(spark.range(n).selectExpr(
            "concat('f', id) AS path", "concat('plain words ', id) AS text"))
        out = {r.path: r.own_license for r in scan(frame).collect()}
        assert {k: out[f"{k}.txt"] for k in notices} == {k: k for k in notices}
        assert [out[str(i)] for i in range(3)] == [None] * 3


def test_whole_licences_wrapped_headers_and_titles(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    rows = [(f"text/{p.stem}", "Copyright (c) 2020 Foo Inc.\nAll rights reserved.\n" + p.read_text())
            for p in folder.glob("*.txt")]
    rows += [(f"wrapped/{p.stem}", "code " * 300 + p.read_text().replace("\n", "\n// ") + " code" * 300)
             for p in folder.glob("*.txt")]
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms "
           "of the GNU General Public License as published by\n# the Free Software Foundation, either "
           "version {} of the License, or\n# (at your option) any later version.\nimport x\n")
    rows += [("h/GPL-2.0", gpl.format(2)), ("h/GPL-3.0", gpl.format(3)), ("t/MIT", "MIT License\n\nmore"),
             ("t/GPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n"),
             ("h/BSD-3-Clause", " * Redistribution and use in source and binary forms, with or\n * without "
              "modification, are permitted provided that the following\n * conditions are met:"),
             ("s/LGPL-2.1", "// SPDX-License-Identifier: LGPL-2.1-or-later"),
             ("i/LicenseRef-All-Rights-Reserved", "Copyright (c) 2020 Foo Inc. All rights reserved."),
             ("no/None", "we read the mit license\nand the GNU General Public License\nlicense 3")]
    out = scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path: str(r.own_license) for r in out} == {p: p.split("/")[1] for p, _ in rows}
