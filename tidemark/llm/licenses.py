"""License scans: MinHash bands over overlapping text windows, then exact containment.

Windows come in sizes that double.  A template belongs to the smallest size S that holds
its words; windows of that size are 2 S words long and start every S words, so any copy
of the template lies whole in one of them.  A copy that keeps four fifths of the
template's shingles then has a Jaccard similarity of about a tenth or more with its
window, and with one MinHash to a band, ``BANDS`` bands collide with a probability of
1 - (1 - similarity) ** BANDS: over 0.999.  A collision retrieves the template, and the
share of its shingles within the window decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes
from tidemark.llm.license_texts import WHOLE_TEXTS

#: Words of a shingle, bands of one MinHash each, least words of a window step.
WORDS, BANDS, LEAST_STEP = 3, 64, 8
#: Words that are scanned at once, about.
SCAN_WORDS = 1 << 17
#: Share of a template's shingles that a window must hold.
CONTAINMENT = 0.8

# Notices by which texts state their license.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
        "CC0 1.0 Universal",
        "creativecommons.org/publicdomain/zero/1.0",
    ),
    "LGPL": (
        "under the terms of the GNU Lesser General Public License",
        "licensed under the GNU Lesser General Public License",
    ),
    "LGPL-2.1": (
        "GNU Lesser General Public License, version 2.1",
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    ),
    "LGPL-3.0": (
        "GNU Lesser General Public License, version 3",
    ),
    "AGPL-3.0": (
        "under the terms of the GNU Affero General Public License",
        "licensed under the GNU Affero General Public License",
        "GNU Affero General Public License, version 3",
    ),
    "GFDL": (
        "under the terms of the GNU Free Documentation License",
        "licensed under the GNU Free Documentation License",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "EPL-1.0": (
        "under the terms of the Eclipse Public License v1.0",
        "Eclipse Public License, version 1.0",
    ),
    "EPL-2.0": (
        "under the terms of the Eclipse Public License 2.0",
        "Eclipse Public License, version 2.0",
    ),
    "Artistic-2.0": (
        "under the terms of the Artistic License 2.0",
        "Licensed under the Artistic License 2.0.",
    ),
    "ODbL-1.0": (
        "made available under the Open Database License",
        "Open Data Commons Open Database License",
    ),
    "ODC-By-1.0": (
        "Open Data Commons Attribution License",
    ),
}

#: Notices of licenses above, after those.
MORE: dict[str, tuple[str, ...]] = {
    "MIT": ("Distributed under the MIT License.",),
    "Apache-2.0": ("Apache License, Version 2.0", "Licensed under the Apache 2.0 license."),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Licensed under the Mozilla Public License 2.0."),
}

#: Creative Commons licenses by their short names, and the long ones of any version.
COMMONS: dict[str, tuple[str, ...]] = {
    "BY": ("Attribution",),
    "BY-SA": ("Attribution-ShareAlike", "Attribution-Share Alike"),
    "BY-ND": ("Attribution-NoDerivatives", "Attribution-NoDerivs", "Attribution-No Derivative Works"),
    "BY-NC": ("Attribution-NonCommercial",),
    "BY-NC-SA": ("Attribution-NonCommercial-ShareAlike", "Attribution-NonCommercial-Share Alike"),
    "BY-NC-ND": ("Attribution-NonCommercial-NoDerivatives", "Attribution-NonCommercial-NoDerivs", "Attribution-NonCommercial-No Derivative Works"),
}


def _commons(version: str) -> dict[str, tuple[str, ...]]:
    """Notices of a version, which differ in over a fifth of their shingles, except that those of 2.0 and 2.5 reach each other."""
    return {
        f"CC-{kind}-{version}": (
            f"Licensed under CC {kind} {version}.",
            f"Licensed under a CC {kind} {version} license.",
            f"under the CC {kind} {version} license",
            *[f"Creative Commons {name} {version}" for name in names],
            f"creativecommons.org/licenses/{kind.lower()}/{version}",
        )
        for kind, names in COMMONS.items()
    }


for _more in (MORE, *map(_commons, ("4.0", "3.0", "2.5", "2.0", "1.0")), {name: (text,) for name, text in WHOLE_TEXTS.items()}):
    for _name, _notices in _more.items():
        TEMPLATES[_name] = TEMPLATES.get(_name, ()) + _notices

# Letters and digits stay, A-Z in lower case; other ASCII signs part words.
_PLAIN = bytes(ord(chr(c).lower()) if chr(c).isalnum() or c > 127 else 32 for c in range(128)) + bytes(range(128, 256))


def license_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Hashes of the runs of three words, in their order; none of fewer words."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < WORDS:
        return h[:0]
    last = len(h) - WORDS + 1
    return _mixed(sum(h[i : i + last] * np.uint64(2 * i + 3) for i in range(WORDS)) * np.uint64(0xC2B2AE3D27D4EB4F))


_LAST = np.uint32(2**32 - 1)
#: Low bits of a MinHash by which most windows are ruled out at once.
LOW = np.uint32(2**14 - 1)


def _band(tokens: np.ndarray, band: int) -> np.ndarray:
    """The order of tokens (32 bits of them) in a band, as numbers to take the smallest of."""
    return (tokens ^ np.uint32(0x165667B1 * (2 * band + 1) % 2**32)) * np.uint32(0x85EBCA77 * (2 * band + 1) % 2**32 | 1)


def _short(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(32)).astype(np.uint32)


class Templates:
    """MinHashes of the templates of each window step, and their sets of shingles."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]]):
        hashes = WordHashes()
        self.sets: list[tuple[str, int, np.ndarray]] = []
        #: Of each step and band, the MinHashes, the templates that they retrieve, and which low bits they have.
        self.bands: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        found: dict[int, list[list[tuple[np.uint32, int]]]] = {}
        for name, texts in templates.items():
            for number, text in enumerate(texts):
                words = license_words(text)
                tokens = np.unique(shingles(words, hashes))
                if len(tokens):
                    step = LEAST_STEP
                    while step < len(words):
                        step *= 2
                    bands = found.setdefault(step, [[] for _ in range(BANDS)])
                    for band, members in enumerate(bands):
                        members.append((_band(_short(tokens), band).min(), len(self.sets)))
                    self.sets.append((name, number, tokens))
        for step, bands in found.items():
            self.bands[step] = []
            for members in bands:
                members.sort()
                values, low = np.array([v for v, _ in members], np.uint32), np.zeros(LOW + 1, bool)
                low[values & LOW] = True
                self.bands[step].append((values, np.array([t for _, t in members]), low))

    @classmethod
    def of(cls, sets: list, bands: dict) -> Templates:
        """Templates from what another one holds."""
        templates = cls({})
        templates.sets, templates.bands = sets, bands
        return templates

    def scan(self, texts: list[list[bytes]], hashes: WordHashes) -> Iterator[tuple[int, str, int, int, float]]:
        """(text, license, template, first word of the window, containment) of all that verify, each template where it fits best.

        Texts stand one after the other, each filled up to a whole number of the longest
        step, so windows start at the same words whatever texts are scanned together.
        """
        unit = max(self.bands)
        found = [shingles(words, hashes) for words in texts]
        sizes = np.array([len(x) for x in found])
        starts = np.append(0, np.cumsum(-(-sizes // unit) * unit))
        if not starts[-1]:
            return
        tokens, filled = np.zeros(starts[-1], np.uint64), np.zeros(starts[-1], bool)
        for x, start in zip(found, starts, strict=False):
            tokens[start : start + len(x)] = x
            filled[start : start + len(x)] = True
        empty, short = np.flatnonzero(~filled), _short(tokens)
        candidates: set[tuple[int, int, int]] = set()
        for band in range(BANDS):
            mins, step = _band(short, band), 1
            mins[empty] = _LAST
            while True:
                if step in self.bands:
                    windows = np.minimum(mins, np.append(mins[1:], _LAST))
                    values, templates, low = self.bands[step][band]
                    at = np.flatnonzero(low[windows & LOW])
                    left, right = (np.searchsorted(values, windows[at], side) for side in ("left", "right"))
                    for w, i, j in zip(at.tolist(), left.tolist(), right.tolist(), strict=True):
                        candidates.update((template, step, w) for template in templates[i:j].tolist())
                if step == unit:
                    break
                mins, step = np.minimum(mins[0::2], mins[1::2]), 2 * step
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for template, step, window in candidates:
            text = int(np.searchsorted(starts, window * step, side="right")) - 1
            first = window * step - int(starts[text])
            wanted = self.sets[template][2]
            share = float(np.isin(wanted, found[text][first : first + 2 * step]).mean())
            if share >= CONTAINMENT and (share, -first) > best.get((text, template), (0.0, 0)):
                best[text, template] = (share, -first)
        for (text, template), (share, first) in sorted(best.items()):
            yield text, *self.sets[template][:2], -first, share


def license_scan(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text and license notice found in it.

    Returns doc_id, license, template (its number), first_word (of the best window; of
    equally good ones the first) and containment (share of the notice's shingles).  Notices
    of related licenses can both reach the containment; the one that is meant has the larger.
    Whole texts are scanned.  Null, empty and short texts yield nothing; repeated rows are
    scanned each; a null id stays null; templates of under three words are not looked for.
    The templates travel to the tasks; their size does not depend on the data.
    """
    table = Templates(templates)
    if not table.sets:
        return docs.sparkSession.createDataFrame([], "doc_id long, license string, template int, first_word long, containment double")
    # Arrays travel, so that workers need nothing of this package by name.
    shared = docs.sparkSession.sparkContext.broadcast((table.sets, table.bands))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, templates = WordHashes(), Templates.of(*shared.value)
        types = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64())

        def scanned(ids: list, texts: list) -> pa.RecordBatch:
            rows = [(ids[i], *rest) for i, *rest in templates.scan(texts, hashes)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "license", "template", "first_word", "containment"])

        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids.append(doc_id)
                texts.append(license_words(text.as_py()))
                held += len(texts[-1])
                if held >= SCAN_WORDS:
                    yield scanned(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield scanned(ids, texts)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(run, "doc_id long, license string, template int, first_word long, containment double")
