"""Licence scan: MinHash bands over overlapping windows retrieve templates, containment verifies them.

Words are runs of letters and digits, A-Z lowered; shingles are runs of three. A template of n words
belongs to the class of the next power of two, c. The text's windows of that class start every c / 4
words and are 5 / 4 c long, so a copy of the template lies in one of them whole, and the two shingle
sets have a similarity of at least ``least_similarity``. With ``BANDS`` bands of one row, a window that
holds a template with that similarity, or with a share ``CONTAINMENT`` of it, misses all bands
with probability ``miss_probability`` at most (3e-4 for a template of five words, less for longer ones).
A retrieved template counts if the exact share of its shingles in the window reaches ``CONTAINMENT``, and if
of the shingles that tell it from each template of another licence with half of its shingles (version,
terms, name) the share ``DISTINCT`` is there.

Texts stay where they are; the templates are sent to every task and may have ``TEMPLATE_BYTES`` at most.

Defined results: null and empty texts have no matches; templates need five words; matches of one
licence that overlap are one match; repeated rows are scanned alike; a table without rows gives none;
only named columns are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.llm.common import small_batches
from barflow.llm.decontaminate import WORD_BYTES
from barflow.llm.wordcodes import Words, mixed, shingles, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
BANDS = 32
CONTAINMENT = 0.8
DISTINCT = 0.5
TEMPLATE_BYTES = 4 << 20

#: Published licence notices.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
}


def _gnu(work: str, name: str, version: str) -> list[str]:
    return [
        f"licensed under the GNU {name}, version {version}",
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version.",
    ]


def _creative(terms: str) -> str:
    return f"This work is licensed under a Creative Commons Attribution-{terms} 4.0 International License"


#: Further licences, many of them told from the above by a version or a term only.
VARIANTS: dict[str, list[str]] = {
    "GPL-2.0": _gnu("program", "General Public License", "2"),
    "LGPL-2.1": _gnu("library", "Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("program", "Lesser General Public License", "3"),
    "AGPL-3.0": _gnu("program", "Affero General Public License", "3"),
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", _creative("ShareAlike")],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", _creative("NoDerivatives")],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", _creative("NonCommercial-ShareAlike")],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", _creative("NonCommercial-NoDerivatives")],
    "CC0-1.0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-1.1": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
        "The contents of this file are subject to the Mozilla Public License Version 1.1",
    ],
}


def _hashed(codes: np.ndarray, band: int) -> np.ndarray:
    return mixed(codes ^ np.uint64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def window_class(n_words: int) -> int:
    return max(8, 1 << (n_words - 1).bit_length())


def least_similarity(n_words: int, containment: float = CONTAINMENT) -> float:
    """Of a template with the window that holds it, when the share ``containment`` of it is there."""
    template, window = n_words - SHINGLE + 1, window_class(n_words) * 5 // 4
    return containment * template / (window + (1 - containment) * template)


def miss_probability(n_words: int, containment: float = CONTAINMENT) -> float:
    return (1 - least_similarity(n_words, containment)) ** BANDS


@dataclass
class Templates:
    """The shingle sets, what tells each from others, and by class the band values: sorted, with the templates
    that have each."""

    names: list[str]
    sets: list[np.ndarray]
    telling: list[list[np.ndarray]]
    bands: dict[int, list[tuple[np.ndarray, list[list[int]]]]]

    @staticmethod
    def of(templates: Mapping[str, Sequence[str]]) -> Templates:
        names, sets, by_class = [], [], {}
        for name, texts in templates.items():
            for text in texts:
                words = next(word_chunks(pa.array([text], pa.string()), WORD_BYTES), None)
                if words is None or len(words.codes) < 5:
                    raise ValueError(f"a template of {name} has less than five words")
                by_class.setdefault(window_class(len(words.codes)), []).append(len(names))
                names.append(name)
                sets.append(np.unique(shingles(words, SHINGLE)[0]))
        bands: dict[int, list] = {c: [] for c in by_class}
        for c, members in by_class.items():
            for band in range(BANDS):
                held: dict[int, list[int]] = {}
                for t in members:
                    held.setdefault(int(_hashed(sets[t], band).min()), []).append(t)
                values = sorted(held)
                bands[c].append((np.array(values, dtype=np.uint64), [held[v] for v in values]))
        telling: list[list[np.ndarray]] = []
        for name, own in zip(names, sets, strict=True):
            rest = [np.setdiff1d(own, other) for n, other in zip(names, sets, strict=True) if n != name]
            telling.append([r for r in rest if 0 < len(r) <= len(own) / 2])
        return Templates(names, sets, telling, bands)


def _candidates(codes: np.ndarray, templates: Templates) -> set[tuple[int, int, int]]:
    """(first shingle, end, template) of the windows that share a band with a template."""
    found: set[tuple[int, int, int]] = set()
    n = len(codes)
    for band in range(BANDS):
        hashed = _hashed(codes, band)
        for c, by_band in templates.bands.items():
            step = c // 4
            least = np.minimum.reduceat(hashed, np.arange(0, n, step))
            tail = np.concatenate([least, np.full(4, np.iinfo(np.uint64).max, np.uint64)])
            window = least
            for k in range(1, 5):
                window = np.minimum(window, tail[k : k + len(least)])
            values, members = by_band[band]
            at = np.minimum(np.searchsorted(values, window), len(values) - 1)
            for w in np.flatnonzero(values[at] == window).tolist():
                for t in members[at[w]]:
                    found.add((w * step, min(n, w * step + 5 * step), t))
    return found


def _matches(words: Words, templates: Templates, containment: float) -> dict[int, list[dict]]:
    """By row of the chunk, the verified matches."""
    codes, bounds = shingles(words, SHINGLE)
    spans: dict[tuple[int, str], list[tuple[int, int, float]]] = {}
    if not len(codes):
        return {}
    for begin, end, t in _candidates(codes, templates):
        wanted = templates.sets[t]
        first_row = int(np.searchsorted(bounds, begin, side="right")) - 1
        last_row = int(np.searchsorted(bounds, end - 1, side="right")) - 1
        for row in range(first_row, last_row + 1):  # a window may reach into the next texts
            low, high = max(begin, int(bounds[row])), min(end, int(bounds[row + 1]))
            if low >= high:
                continue
            here = np.flatnonzero(np.isin(codes[low:high], wanted))
            present = np.unique(codes[low:high][here])
            share = len(present) / len(wanted)
            if share >= containment and all(np.isin(r, present).mean() >= DISTINCT for r in templates.telling[t]):
                start = low + int(here[0]) - int(bounds[row]) + int(words.bounds[row])
                stop = low + int(here[-1]) - int(bounds[row]) + int(words.bounds[row]) + SHINGLE
                stop = min(stop, int(words.bounds[row + 1]))
                spans.setdefault((row, templates.names[t]), []).append((start, stop, share))
    by_row = {}
    for (row, name), found in sorted(spans.items()):
        merged: list[list] = []
        for start, stop, share in sorted(found):
            if merged and start < merged[-1][1]:
                merged[-1][1], merged[-1][2] = max(stop, merged[-1][1]), max(share, merged[-1][2])
            else:
                merged.append([start, stop, share])
        for start, stop, share in merged:
            by_row.setdefault(row, []).append(
                dict(license=name, containment=share, first_word=start - int(words.bounds[row]), n_words=stop - start)
            )
    return by_row


MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()), T.StructField("containment", T.DoubleType()),
            T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
        ]
    )
)
ARROW_MATCHES = pa.list_(
    pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())])
)


def scan(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES | VARIANTS, id_column: str = "doc_id",
         text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """(id, matches) for every row: licence, share of the template, first word and words of each match."""
    size = sum(len(t.encode()) for texts in templates.values() for t in texts)
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes; scan in portions of {TEMPLATE_BYTES} at most")
    index = Templates.of(templates)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[dict]] = [[] for _ in range(len(batch))]
            for words in word_chunks(batch.column(1), WORD_BYTES):
                for row, found in _matches(words, index, containment).items():
                    rows[words.first_row + row] = found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, ARROW_MATCHES)], names=[batch.schema.names[0], "matches"]
            )

    read = small_batches(docs).select(id_column, text)
    return read.mapInArrow(find, T.StructType([read.schema[0], T.StructField("matches", MATCHES)]))
