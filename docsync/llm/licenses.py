"""Licence scan: notices by TF-IDF cosine with templates, and inheritance through directories.

A template is compared with windows of a text's terms, across line ends, so that what stands before or
after a notice counts nothing. Inside a window a term that the template lacks weighs like an average
term of the template, however many files there are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import packed, stage

# Short notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related "
               "rights, CC0 1.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "LicenseRef-All-Rights-Reserved": "All rights reserved",
}
#: Terms without which a window is not the notice, the first (sought in all texts) a rare one.
NEEDS = {
    "Apache-2.0": "apache 2.0", "MIT": "license mit under", "BSD-3-Clause": "redistribution source binary",
    "GPL-2.0": "license general public 2", "GPL-3.0": "license general public 3",
    "LGPL-3.0": "license lesser 3", "MPL-2.0": "mozilla 2.0", "CC0-1.0": "waived copyright rights",
    "CC-BY-4.0": "cc by 4.0", "CC-BY-SA-4.0": "cc by-sa 4.0", "CC-BY-NC-4.0": "cc by-nc 4.0",
    "LicenseRef-All-Rights-Reserved": "reserved rights",
}
_GPL = ("This {what} is free software{mark} you can redistribute it and/or modify it under the terms of "
        "the GNU {kind}General Public License as published by the Free Software Foundation, either "
        "version {n} of the License, or (at your option) any later version.")
#: Standard headers of several lines: licence, text, terms needed, terms barred.
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0", "apache 2.0", ""),
    ("GPL-2.0", _GPL.format(what="program", mark=";", kind="", n="2"), "license general 2", "lesser affero"),
    ("GPL-3.0", _GPL.format(what="program", mark=":", kind="", n="3"), "license general 3", "lesser affero"),
    ("LGPL-2.1", _GPL.format(what="library", mark=";", kind="Lesser ", n="2.1"), "license lesser 2.1", ""),
    ("LGPL-3.0", _GPL.format(what="library", mark=":", kind="Lesser ", n="3"), "license lesser 3", ""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
     "a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/", "mozilla 2.0", ""),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the Software), to deal in the Software without "
     "restriction", "granted charge permission", ""),
    ("MIT", "Licensed under the MIT License", "license mit under", ""),
]
#: Titles, which count as lines of their own only: licence, text, terms needed.
TITLES = [
    ("Apache-2.0", "Apache License Version 2.0", "apache 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004", "apache 2.0"), ("MIT", "MIT License", "license mit"),
    ("MIT", "The MIT License (MIT)", "license mit"),
    ("BSD-2-Clause", "BSD 2-Clause License", "2-clause bsd"),
    ("BSD-3-Clause", "BSD 3-Clause License", "3-clause bsd"), ("ISC", "ISC License", "license isc"),
    ("MPL-2.0", "Mozilla Public License Version 2.0", "mozilla 2.0"),
    ("GPL-2.0", "GNU General Public License Version 2", "license general 2"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991", "license general 1991"),
    ("GPL-3.0", "GNU General Public License Version 3", "license general 3"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007", "license general 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1", "license lesser 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3", "license lesser 3"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007", "license lesser 2007"),
]
#: Whole texts in license_texts: terms needed, and terms that tell of a sibling licence.
TEXT_NEEDS = {
    "Apache-2.0": ("apache 2.0",), "MIT": ("granted charge permission",), "ISC": ("granted fee permission",),
    "BSD-2-Clause": ("redistribution binary", "endorse"), "BSD-3-Clause": ("redistribution binary endorse",),
    "CC0-1.0": ("cc0 affirmer",), "CC-BY-SA-4.0": ("sharealike", "noncommercial"),
    "GPL-2.0": ("license general 1991",), "GPL-3.0": ("license general 2007", "remotely"),
    "LGPL-2.1": ("license lesser 2.1",), "LGPL-3.0": ("license lesser 2007",), "MPL-2.0": ("mozilla 2.0",),
}
#: A window can have the licence of a template if their cosine is at least this.
LEAST = 0.8
GAP = "[^a-z0-9.-]+"
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"


def terms(text: str) -> list[str]:
    """Terms of a lower-case text: runs of letters, digits, points and hyphens, trimmed of both."""
    return [t for t in (x.strip(".-") for x in re.split(GAP, text)) if t]


def weights(frequency: dict[str, int], documents: int) -> dict[str, float]:
    """Inverse document frequency of each term, never 0."""
    return {t: math.log((1 + documents) / (1 + n)) + 1 for t, n in frequency.items()}


def cues(vectors: dict[str, dict[str, float]], least: float) -> set[str]:
    """Terms of which any line with a cosine of ``least`` to any template has at least one.

    Without a template's heaviest terms, the rest of its vector can be too short for the cosine.
    """
    out = set()
    for vector in vectors.values():
        whole = sum(w * w for w in vector.values())
        rest = whole
        for term, w in sorted(vector.items(), key=lambda e: (-e[1], e[0])):
            if math.sqrt(max(0.0, rest) / whole) < least - 1e-9:
                break
            out.add(term)
            rest -= w * w
    return out


def best(line: str, vectors, idf, other: float) -> tuple[float, str]:
    """(cosine, licence) of the closest template; ties go to the first name."""
    vector = {t: n * idf.get(t, other) for t, n in Counter(terms(line)).items()}
    norm = math.sqrt(sum(w * w for w in vector.values()))
    found = (0.0, "")
    for name in sorted(vectors):
        own = vectors[name]
        dot = sum(w * own[t] for t, w in vector.items() if t in own)
        value = dot / norm / math.sqrt(sum(w * w for w in own.values())) if norm else 0.0
        if value > found[0] + 1e-12:
            found = (value, name)
    return found


class Template:
    """Vector of one template, and how windows of a text compare with it."""

    def __init__(self, name: str, text: str, needs: str = "", bars: str = "", alone: bool = False):
        self.name, self.counts = name, Counter(terms(text.lower()))
        self.needs, self.bars, self.alone = needs.split(), bars.split(), alone

    def weigh(self, idf: dict[str, float], least: float) -> Template:
        self.size, self.least = sum(self.counts.values()), least
        self.squares = {t: idf[t] ** 2 for t in self.counts}
        self.whole = sum(n * n * self.squares[t] for t, n in self.counts.items())
        #: What one occurrence of a foreign term adds to the squared length of a window.
        self.foreign = sum(n * self.squares[t] for t, n in self.counts.items()) / self.size
        self.anchors = self.needs[:1] or sorted(cues(
            {"": {t: n * idf[t] for t, n in self.counts.items()}}, least))
        return self

    def lengths(self, most: int) -> list[int]:
        """Lengths of windows: all that can reach the cosine for a notice, a few for a long text."""
        if self.size <= 60:
            found = range(max(1, math.ceil(self.least ** 2 * self.size) - 1),
                          self.size + self.size // 2 + 2)
        else:
            found = [self.size * k // 10 for k in (8, 9, 10, 11, 12)]
        return sorted({min(n, most) for n in found})

    def slide(self, words: list[str], length: int) -> float:
        """Greatest cosine of windows of ``length`` that have all needed terms and no barred one."""
        seen, dot, norm, top = Counter(), 0.0, 0.0, 0.0
        for i, t in enumerate(words):
            for term, step in ((t, 1), (words[i - length] if i >= length else None, -1)):
                if term is None:
                    continue
                square = self.squares.get(term)
                if square is None:
                    norm += step * self.foreign
                else:
                    norm += (2 * step * seen[term] + 1) * square
                    dot += step * self.counts[term] * square
                seen[term] += step
            if i + 1 >= length and dot > 0:
                value = dot / math.sqrt(max(norm, 1e-9) * self.whole)
                if value > top and all(seen[x] > 0 for x in self.needs) and not any(
                        seen[x] > 0 for x in self.bars):
                    top = value
        return min(top, 1.0)

    def score(self, lines: list[list[str]], words: list[str], places: dict[str, list[int]]) -> float:
        """Greatest cosine of the file's windows; of whole lines, or two in a row, if ``alone``."""
        if any(x not in places for x in self.needs):
            return 0.0
        if self.alone:
            most = self.size + self.size // 5
            spans = [s for i, line in enumerate(lines) if len(line) <= most
                     for s in (line, line + sum(lines[i + 1:i + 2], [])) if len(s) <= most]
            return max((self.slide(s, len(s)) for s in spans if all(x in s for x in self.needs)),
                       default=0.0)
        near = sum(n * n * self.squares[t] for t, n in self.counts.items() if t in places)
        if near < self.least ** 2 * self.whole - 1e-9:
            return 0.0  # no window can reach the cosine
        rarest = min(([x] for x in self.needs), key=lambda x: len(places[x[0]]),
                     default=self.anchors)
        reach, regions = self.size + self.size // 2 + 2, []
        for p in sorted(p for x in rarest for p in places.get(x, ())):
            low, high = max(0, p - reach), min(len(words), p + reach)
            if regions and low <= regions[-1][1]:
                regions[-1][1] = high
            else:
                regions.append([low, high])
        return max((self.slide(words[a:b], n) for a, b in regions for n in self.lengths(b - a)),
                   default=0.0)


def read(text: str, templates: list[Template]) -> tuple[float | None, str | None]:
    """(cosine, licence) of the template that explains most of a lower-case text.

    Of those that reach the cosine the one with the most terms matched less terms missing counts,
    so a whole licence outranks the notices in it; ties go to the first name.
    """
    lines = [x for x in (terms(line) for line in text.split("\n")) if x]
    words = [t for line in lines for t in line]
    places: dict[str, list[int]] = {}
    for i, t in enumerate(words):
        places.setdefault(t, []).append(i)
    found = [(t.score(lines, words, places), t) for t in templates]
    good = [(-(2 * v * v - 1) * t.whole, t.name, v) for v, t in found if v >= t.least]
    return (min(good)[2], min(good)[1]) if good else (None, None)


def notices(files: DataFrame, text: str, templates: dict[str, str], least: float) -> DataFrame:
    """``files`` (every row) with ``own_license`` and ``similarity`` of its closest window."""
    used = all_templates(templates)
    vocabulary = sorted(set().union(*(t.counts for t in used)))
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    # Document frequencies over all files, of the templates' terms: one small row per term.
    present = F.array_distinct(F.filter(F.transform(
        F.split(lower, GAP), lambda t: F.btrim(t, F.lit(".-"))), lambda t: t.isin(vocabulary)))
    seen = files.select(F.explode(F.concat(present, F.array(F.lit("")))).alias("term")) \
        .groupBy("term").count().collect()
    frequency = {r["term"]: r["count"] for r in seen}
    documents = frequency.pop("", 0)  # every file has the empty term once
    idf = weights({t: frequency.get(t, 0) for t in vocabulary}, documents)
    used = [t.weigh(idf, least) for t in used]
    cue = "|".join(re.escape(x) for x in sorted({x for t in used for x in t.anchors}))
    pattern = rf"(^|[^a-z0-9])({cue})($|[^a-z0-9])"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [(None, None) if x is None else read(x, used) for x in batch["cued"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array([g[1] for g in good], pa.string()),
                 pa.array([None if g[0] is None else round(g[0], 6) for g in good], pa.float64())],
                ["row", "own_license", "similarity"])

    row = packed(files.drop(text))
    kind = files.drop(text).select(F.struct("*").alias("row")).schema["row"].dataType.simpleString()
    cued = F.when(lower.rlike(pattern), lower)  # a text without any anchor has no notice
    return files.select(row.alias("row"), cued.alias("cued")).mapInArrow(
        score, f"row {kind}, own_license string, similarity double").select(
        "row.*", "own_license", "similarity")


def all_templates(templates: dict[str, str]) -> list[Template]:
    """The notices ``templates``; for the fixed ones also the other forms of their licences."""
    out = [Template(n, t, NEEDS.get(n, "") if t == TEMPLATES.get(n) else "")
           for n, t in templates.items()]
    if templates is not TEMPLATES:
        return out
    out += [Template(n, t, needs, bars) for n, t, needs, bars in HEADERS]
    out += [Template(n, t, needs, alone=True) for n, t, needs in TITLES]
    out += [Template(n, f"SPDX-License-Identifier: {n}{end}",
                     f"spdx-license-identifier {n}{end}".lower())
            for n in {**TEMPLATES, **TEXT_NEEDS} if not n.startswith("LicenseRef")
            for end in (("", "-only", "-or-later") if "GPL" in n else ("",))]
    # Read by the driver only; the tasks get the vectors.
    folder = Path(__file__).parent / "license_texts"
    return out + [Template(n, (folder / f"{n}.txt").read_text("utf-8"), *need)
                  for n, need in TEXT_NEEDS.items()]


def inherited(files: DataFrame) -> DataFrame:
    """``files`` (path, own_license, ...) with ``license`` and ``inherited_from``.

    A licence file (by its name) gives its licence to its directory. A file without a notice of
    its own has the licence of the nearest directory above it that has one. Of several licence
    files in one directory the closest to its template counts, then the first name. Directories are
    joined, each once, with all their ancestors; files only with their own directory.
    """
    directory = F.regexp_replace("path", r"/?[^/]*$", "")
    files = files.withColumn("_dir", directory)
    given = files.filter(F.col("own_license").isNotNull() & F.regexp_extract(
        "path", r"[^/]*$", 0).rlike(FILE_NAMES)).groupBy("_dir").agg(F.min(F.struct(
            (-F.col("similarity")).alias("far"), F.col("own_license").alias("license"))).alias("best"))
    given = given.select(F.col("_dir").alias("giver"), F.col("best.license").alias("dir_license"))
    parts = F.split("_dir", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("_dir") == "", 0).otherwise(F.size(parts)))
    above = files.filter(F.col("own_license").isNull() & F.col("_dir").isNotNull()).select(
        "_dir").distinct().select("_dir", F.explode(F.transform(depths, lambda d: F.struct(
            d.alias("depth"), F.array_join(F.slice(parts, 1, d), "/").alias("giver")))).alias("a"))
    nearest = above.select("_dir", "a.*").join(given, "giver").groupBy("_dir").agg(
        F.max(F.struct("depth", "giver", "dir_license")).alias("n")).select(
        F.col("_dir").alias("of"), "n.giver", "n.dir_license")
    out = files.join(nearest, (files["_dir"] == nearest["of"]) & files["own_license"].isNull(),
                     "left")
    return out.withColumns({
        "license": F.coalesce("own_license", "dir_license"),
        "inherited_from": F.col("giver")}).drop("_dir", "of", "giver", "dir_license")


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES,
         least: float = LEAST) -> DataFrame:
    """(path, text, ...) to the same columns without text, own_license, similarity, license and
    inherited_from.

    Every text is scored, in windows across its lines. A null text has no notice; a null path has no directory and
    inherits nothing. Repeated rows are files of their own. An empty table gives no rows.
    """
    return inherited(stage(notices(files, "text", templates, least), "notices"))
