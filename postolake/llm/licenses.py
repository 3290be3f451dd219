"""Licence scan: passages compared to licence templates by Dice over word bigrams.

Text is normalised to words (maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after lower-casing A-Z). A passage is any run of words; its similarity to a
template is the Dice coefficient of their bags of bigrams, 2*common / (passage
bigrams + template bigrams). A document matches a template when some passage
reaches ``threshold``; the best passage is reported, ties going to the earlier
and then the shorter one.

Pruning loses no match. With d the threshold and b the template's bigrams, a
match shares at least d*b/(2-d) bigrams and has between d*b/(2-d) and
b*(2-d)/d of them. Templates that share fewer bigrams with the whole document
are dropped; passages of the others are bounded by the number of template
bigrams they can hold before their bags are compared.

Null and empty texts match nothing. Texts are scanned whole. Repeated rows give
equal rows.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

THRESHOLD = 0.8

# Licence notices and short licence texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "BSD-notice": "Distributed under the BSD License",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"
    ),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def _bigrams(tokens: tv.Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of the bigrams of each text; a text of one word has none."""
    counts = np.maximum(np.diff(tokens.offsets) - 1, 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    first = np.repeat(tokens.offsets[:-1] - at[:-1], counts) + np.arange(at[-1])
    left = tokens.hashes[first]
    right = tokens.hashes[first + 1] if len(first) else left
    return at, tv.mix(left * np.uint64(0x9E3779B97F4A7C15) ^ right)


def _prepare(templates: dict[str, str]):
    names = sorted(templates)
    offsets, data = tv.utf8(pa.array([templates[n] for n in names], pa.string()))
    tokens = tv.tokenize(offsets, tv.FOLD[data], tv.ALNUM)
    at, h = _bigrams(tokens)
    bags = [Counter(h[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    return names, bags, np.unique(h)


def _best_passage(places: np.ndarray, grams: np.ndarray, bag: Counter, d: float):
    """(dice, first bigram, bigrams) of the best passage that starts and ends with a template bigram, or None."""
    b = sum(bag.values())
    low, high = ceil(d * b / (2 - d) - 1e-9), int(b * (2 - d) / d + 1e-9)
    best = None
    ends = np.searchsorted(places, places + high - 1, side="right")
    for i in range(len(places)):
        j = np.arange(i, ends[i])
        size = places[j] - places[i] + 1
        bound = 2 * np.minimum(j - i + 1, b) / (size + b)
        floor = d if best is None else best[0]
        open_ = np.flatnonzero((bound >= floor - 1e-12) & (size >= low))
        if not len(open_):
            continue
        common, left, marks = 0, dict(bag), []
        for g in grams[i : i + int(open_[-1]) + 1].tolist():
            if left.get(g, 0) > 0:
                left[g] -= 1
                common += 1
            marks.append(common)
        for k in open_.tolist():
            dice = 2 * marks[k] / (int(size[k]) + b)
            if dice >= d and (best is None or dice > best[0]):
                best = (dice, int(places[i]), int(size[k]))
    return best


_MATCH = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_word", pa.int32()), ("n_words", pa.int32())])


def _scan(batches, templates: dict[str, str], d: float):
    names, bags, known = _prepare(templates)
    needed = [ceil(d * sum(bag.values()) / (2 - d) - 1e-9) for bag in bags]
    for batch in tv.text_chunks(batches, "text"):
        offsets, data = tv.utf8(batch.column("text"))
        tokens = tv.tokenize(offsets, tv.FOLD[data], tv.ALNUM)
        at, h = _bigrams(tokens)
        place = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
        hits = np.flatnonzero(known[place] == h) if len(known) else np.zeros(0, dtype=np.int64)
        bounds = np.searchsorted(hits, at)
        matches: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for row in np.flatnonzero(np.diff(bounds) >= min(needed, default=1)):
            spots = hits[bounds[row] : bounds[row + 1]]
            grams = h[spots]
            present = Counter(grams.tolist())
            for name, bag, least in zip(names, bags, needed):
                if not bag or sum(min(n, present[g]) for g, n in bag.items() if g in present) < least:
                    continue
                mine = np.isin(grams, np.fromiter(bag, dtype=np.uint64))
                found = _best_passage(spots[mine] - at[row], grams[mine], bag, d)
                if found:
                    matches[row].append({"license": name, "dice": found[0], "first_word": found[1], "n_words": found[2] + 1})
            matches[row].sort(key=lambda m: (-m["dice"], m["license"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(matches, pa.list_(_MATCH))], names=["doc_id", "matches"]
        )


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, license and dice of the best match (null without one), and all matches, best first.

    Templates are (name, text) pairs held by every task, so they must be few;
    a template of one word has no bigram and never matches.
    """
    chosen = dict(TEMPLATES if templates is None else templates)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.mapInArrow(
        lambda it: _scan(it, chosen, threshold),
        "doc_id long, matches array<struct<license: string, dice: double, first_word: int, n_words: int>>",
    )
    best = F.get("matches", F.lit(0))
    return found.select("doc_id", best["license"].alias("license"), best["dice"].alias("dice"), "matches")
