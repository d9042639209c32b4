"""Licence scans: known licence sentences become identifiers, identifier sequences become licences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from recallspark.llm.batches import pieces, texts

#: Sentences of public licences, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "the mit license": "MITtitle",
    "mit license": "MITtitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITperm",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITliable",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCperm",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDpre",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "licensed under the apache license version 2.0": "Apache2ref",
    "licensed under the apache license version 2.0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "Apache2comply",
    "you may obtain a copy of the license at": "Apache2obtain",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2asis",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 2": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLhope",
    "see the gnu general public license for more details": "GPLdetails",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2ref",
    "licensed under cc by 4.0": "CCBY4ref",
    "licensed under cc by sa 4.0": "CCBYSA4ref",
    "licensed under cc by nc 4.0": "CCBYNC4ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4ref",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "CCBYNC4ref",
    "all rights reserved": "Reserved",
}
#: Ordered rules, the longer sequence of the same beginning first.
RULES = [
    ("MIT", ["MITtitle", "MITperm", "MITnotice", "MITwarranty", "MITliable"]),
    ("MIT", ["MITperm", "MITnotice", "MITwarranty", "MITliable"]),
    ("MIT", ["MITref"]),
    ("MIT", ["MITtitle"]),
    ("ISC", ["ISCperm"]),
    ("BSD-3-Clause", ["BSDpre", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDpre", "BSDsource", "BSDbinary"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply", "Apache2obtain", "Apache2asis"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("GPL-3.0-or-later", ["GPL3plus", "GPLhope", "GPLdetails"]),
    ("GPL-3.0-or-later", ["GPL3plus"]),
    ("GPL-2.0-or-later", ["GPL2plus", "GPLhope", "GPLdetails"]),
    ("GPL-2.0-or-later", ["GPL2plus"]),
    ("GPL-3.0-only", ["GPL3ref"]),
    ("GPL-2.0-only", ["GPL2ref"]),
    ("MPL-2.0", ["MPL2ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("CC-BY-SA-4.0", ["CCBYSA4ref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("Proprietary", ["Reserved"]),
]
#: Words of which every known sentence has one; a text without them is not taken apart.
SIGNS = ["licen", "permi", "warrant", "copyright", "rights", "software", "redistribut"]
_SENTENCE = re.compile(r"(?:[^.!?;:\n]|[.](?=\S)|[:;](?=\S))+")
_LINE_WRAP = re.compile(r"(?<=[a-z,]) *\n[ \t*#/]*(?=[a-z(])")
_PLAIN = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def normalise(sentence: str) -> str:
    """Lower-case words and version numbers, separated by one space."""
    return " ".join(_PLAIN.findall(sentence.lower()))


def sentences(text: str) -> Iterator[tuple[str, int, int]]:
    """``(normalised sentence, start, end)``: up to a closing mark, or the end of the line.

    A line that goes on in lower case with the next one (wrapped text, comment signs before it)
    does not end a sentence.
    """
    joined = _LINE_WRAP.sub(lambda m: " " * len(m[0]), text)
    for m in _SENTENCE.finditer(joined):
        plain = normalise(m[0])
        if plain:
            before = len(m[0]) - len(m[0].lstrip())
            yield plain, m.start() + before, m.start() + len(m[0].rstrip())


def scan(text: str, known: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> list[tuple[str, int, int, list[str]]]:
    """``(licence, start, end, identifiers)`` in order.

    The identifiers of the known sentences are read from left to right; at each place the first
    rule whose whole sequence follows takes it, and reading goes on behind it. An identifier that
    no rule takes is passed over.
    """
    low = text.lower()
    if known is SENTENCES and not any(sign in low for sign in SIGNS):
        return []
    found = [(known[s], a, b) for s, a, b in sentences(text) if s in known]
    ids, out, at = [f[0] for f in found], [], 0
    while at < len(ids):
        name, sequence = next(((n, s) for n, s in rules if ids[at:at + len(s)] == s), (None, [None]))
        if name:
            out.append((name, found[at][1], found[at + len(sequence) - 1][2], sequence))
        at += len(sequence)
    return out


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, licences, n_matches, matches`` of every row's whole text.

    ``licences`` are the distinct ones in alphabetical order; ``matches`` the recognised passages
    in order with their offsets in code points and the identifiers of their sentences. Null and
    empty texts have none. One row per input row, no shuffle; other columns are ignored.
    """
    item = pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sentences", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [scan(text) for text in texts(batch)]
            matches = [[{"licence": n, "start": a, "end": b, "sentences": s} for n, a, b, s in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([sorted({m[0] for m in f}) for f in found], pa.list_(pa.string())),
                 pa.array([len(f) for f in found], pa.int64()), pa.array(matches, pa.list_(item))],
                names=["doc_id", "licences", "n_matches", "matches"])

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return plain.mapInArrow(run, "doc_id long, licences array<string>, n_matches long, "
                                 "matches array<struct<licence string, start long, end long, sentences array<string>>>")
