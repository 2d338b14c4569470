"""Licence scans by sentence rules.

Lines that wrap are joined first: a line goes on in the next one unless a blank line (or one of signs alone, as in a
comment) stands between, or the line ends a sentence. The joined text is cut into
sentences (after `.`, `!`, `?` or `;` before white space), each sentence is normalised (small letters, runs of anything
but letters and digits as one space, comment words at line starts left out), and a known sentence becomes its
identifier, wherever in a longer one its words stand; where known sentences overlap, the first and then the longest
counts. A version of a GNU licence with an "or" after it that no known sentence goes on with is not a statement of that
version alone. The sequence of identifiers of a document, in order, is then matched against ordered rules: the first rule whose
identifiers stand next to each other in the sequence, at the first place where one matches, takes them; what is left on
either side is matched on. Sentences that are not known do not separate identifiers as long as no more than `GAP` of
them stand between. A place goes from the first to the last word of the known sentence, with the signs that end it.

A version number ends with a dot of its own ("Version 2.0."), so a dot between digits does not end a sentence. A null or
empty text has no licence; rows that repeat an id are scanned each on its own; an empty table gives an empty result;
only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices

# Known sentences, normalised, with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-2.0-grant",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "released under the mit license": "mit-grant",
    "licensed under the mit license": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-permission",
    "the above copyright notice and this permission notice shall be included in all copies": "mit-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0-grant",
    "licensed under the gnu general public license version 3": "gpl-3.0-grant",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0-grant",
    "licensed under the gnu general public license version 2": "gpl-2.0-grant",
    "licensed under the gnu lesser general public license version 3": "lgpl-3.0-grant",
    "licensed under the mozilla public license version 2 0": "mpl-2.0-grant",
    "either version 3 of the license or at your option any later version": "gpl-later",
    "this program is free software you can redistribute it and or modify it": "gpl-free-software",
    "licensed under the bsd 3 clause license": "bsd-3-grant",
    "licensed under the bsd 2 clause license": "bsd-2-grant",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used": "bsd-endorsement",
    "licensed under cc by 4 0": "cc-by-4.0-grant",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0-grant",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0-grant",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4.0-grant",
    "licensed under cc0 1 0": "cc0-1.0-grant",
    "all rights reserved": "all-rights-reserved",
    "the software is provided as is without warranty of any kind": "as-is",
    # The licences' own headers and texts, as their sentences go on, and what other headers say instead.
    "under the apache license version 2 0 the license": "apache-2.0-grant",
    "apache license version 2 0 january 2004": "apache-2.0-grant",
    "licensed under the apache license 2 0": "apache-2.0-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
    "to the following conditions": "mit-permission",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement": "as-is",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
    "the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission": "bsd-endorsement",
    "may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorsement",
    "this software is provided by the copyright holders and contributors as is": "bsd-as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc-permission",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted": "isc-permission",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation": "gpl-terms",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-terms",
    "under the terms of the gnu affero general public license as published by the free software foundation": "agpl-terms",
    "under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl-2.0-grant",
    "under the terms of the gnu general public license version 2 only as published by the free software foundation": "gpl-2.0-grant",
    "under the terms of the gnu general public license version 3 as published by the free software foundation": "gpl-3.0-grant",
    "under the terms of the gnu general public license version 3 only as published by the free software foundation": "gpl-3.0-grant",
    "either version 2 of the license or at your option any later version": "gpl-2-later",
    "either version 2 1 of the license or at your option any later version": "gpl-2.1-later",
    "version 2 of the license": "gpl-2-version",
    "version 3 of the license": "gpl-3-version",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0-grant",
    "licensed under the gnu affero general public license version 3": "agpl-3.0-grant",
    "licensed under the isc license": "isc-grant",
    "the mit license mit": "mit-grant",
    "gnu general public license version 3 29 june 2007": "gpl-3.0-grant",
    "gnu general public license version 2 june 1991": "gpl-2.0-grant",
    "gnu lesser general public license version 3 29 june 2007": "lgpl-3.0-grant",
    "gnu lesser general public license version 2 1 february 1999": "lgpl-2.1-grant",
    "gnu affero general public license version 3 19 november 2007": "agpl-3.0-grant",
    "mozilla public license version 2 0 1 definitions": "mpl-2.0-grant",
    "licensed under the gnu lesser general public license version 2 1": "lgpl-2.1-grant",
    "apache 2 0 license": "apache-2.0-grant",
    "apache license 2 0": "apache-2.0-grant",
    "under the agpl v3 0": "agpl-3.0-grant",
    "under agpl v3 0": "agpl-3.0-grant",
    "gnu agpl v3 0": "agpl-3.0-grant",
    "boost software license version 1 0": "bsl-1.0-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "eclipse public license version 2 0": "epl-2.0-grant",
    "eclipse public license v 2 0": "epl-2.0-grant",
    "eclipse public license version 1 0": "epl-1.0-grant",
    "eclipse public license v 1 0": "epl-1.0-grant",
    "eclipse public license v2 0": "epl-2.0-grant",
    "eclipse public license v1 0": "epl-1.0-grant",
    **{
        f"licensed under the gnu {_kind} public license version {_version.replace('.', ' ').removesuffix(' 0')} {_later}": f"{_name}-{_version}-or-later"
        for _name, _kind, _versions in (("gpl", "general", ("2.0", "3.0")), ("lgpl", "lesser general", ("2.1", "3.0")), ("agpl", "affero general", ("3.0",)))
        for _version in _versions
        for _later in ("or later", "or any later version", "or at your option any later version")
    },
    **{
        f"spdx license identifier {_said}": f"spdx-{_name}"
        for _name, *_others in (
            ("Apache-2.0",), ("MIT",), ("BSD-2-Clause",), ("BSD-3-Clause",), ("ISC",), ("MPL-2.0",),
            ("GPL-2.0-only", "gpl 2 0"), ("GPL-2.0-or-later",), ("GPL-3.0-only", "gpl 3 0"), ("GPL-3.0-or-later",),
            ("LGPL-2.1-only", "lgpl 2 1"), ("LGPL-2.1-or-later",), ("LGPL-3.0-only", "lgpl 3 0"), ("LGPL-3.0-or-later",),
            ("AGPL-3.0-only", "agpl 3 0"), ("AGPL-3.0-or-later",),
            ("CC-BY-4.0",), ("CC-BY-SA-4.0",), ("CC-BY-NC-4.0",), ("CC-BY-NC-ND-4.0",), ("CC0-1.0",),
        )
        for _said in (re.sub(r"[\W_]+", " ", _name.lower()), *_others)
    },
}
# Rules in order, longer ones of a licence first; each names the identifiers that must follow each other.
RULES = (
    ("GPL-3.0-or-later", ("gpl-3.0-grant", "gpl-later")),
    ("GPL-3.0-or-later", ("gpl-free-software", "gpl-later")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl-later")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl-2-later")),
    ("GPL-2.0-or-later", ("gpl-free-software", "gpl-2-later")),
    ("GPL-2.0-or-later", ("gpl-2.0-grant", "gpl-2-later")),
    ("LGPL-3.0-or-later", ("gpl-free-software", "lgpl-terms", "gpl-later")),
    ("LGPL-3.0-or-later", ("lgpl-terms", "gpl-later")),
    ("LGPL-2.1-or-later", ("gpl-free-software", "lgpl-terms", "gpl-2.1-later")),
    ("LGPL-2.1-or-later", ("lgpl-terms", "gpl-2.1-later")),
    ("AGPL-3.0-or-later", ("gpl-free-software", "agpl-terms", "gpl-later")),
    ("AGPL-3.0-or-later", ("agpl-terms", "gpl-later")),
    ("LGPL-3.0-or-later", ("lgpl-3.0-grant", "gpl-later")),
    ("AGPL-3.0-or-later", ("agpl-3.0-grant", "gpl-later")),
    ("GPL-3.0-only", ("gpl-free-software", "gpl-3.0-grant")),
    ("GPL-2.0-only", ("gpl-free-software", "gpl-2.0-grant")),
    ("GPL-3.0-only", ("gpl-terms", "gpl-3-version")),
    ("GPL-2.0-only", ("gpl-terms", "gpl-2-version")),
    ("LGPL-3.0-only", ("lgpl-terms", "gpl-3-version")),
    ("AGPL-3.0-only", ("agpl-terms", "gpl-3-version")),
    ("GPL-3.0-only", ("gpl-3.0-grant",)),
    ("GPL-2.0-only", ("gpl-2.0-grant",)),
    ("LGPL-3.0-only", ("lgpl-3.0-grant",)),
    ("Apache-2.0", ("apache-2.0-grant", "apache-compliance", "apache-copy")),
    ("Apache-2.0", ("apache-2.0-grant", "apache-compliance")),
    ("Apache-2.0", ("apache-2.0-grant",)),
    ("MIT", ("mit-grant", "mit-permission", "mit-notice", "as-is")),
    ("MIT", ("mit-permission", "mit-notice", "as-is")),
    ("MIT", ("mit-permission", "mit-notice")),
    ("MIT", ("mit-grant", "mit-permission")),
    ("MIT", ("mit-grant",)),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-endorsement")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-3-grant",)),
    ("ISC", ("isc-permission",)),
    ("ISC", ("isc-grant",)),
    ("AGPL-3.0-only", ("agpl-3.0-grant",)),
    ("BSD-2-Clause", ("bsd-2-grant",)),
    ("MPL-2.0", ("mpl-2.0-grant",)),
    ("CC-BY-4.0", ("cc-by-4.0-grant",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-grant",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4.0-grant",)),
    ("CC0-1.0", ("cc0-1.0-grant",)),
    ("LGPL-2.1-only", ("lgpl-2.1-grant",)),
    ("BSL-1.0", ("bsl-1.0-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("EPL-2.0", ("epl-2.0-grant",)),
    ("EPL-1.0", ("epl-1.0-grant",)),
    *((known.split("-")[0].upper() + known[known.index("-") :], (known,)) for known in dict.fromkeys(SENTENCES.values()) if known.endswith("-or-later") and not known.startswith("spdx-")),
    *((known.removeprefix("spdx-"), (known,)) for known in dict.fromkeys(SENTENCES.values()) if known.startswith("spdx-")),
    ("Proprietary", ("all-rights-reserved",)),
)
# A copyright line above a licence's own words may say this as well, which takes nothing back.
RULES = tuple(
    r for licence, rule in RULES for r in ([(licence, ("all-rights-reserved", *rule))] * (len(rule) > 1) + [(licence, rule)])
)
GAP = 3
_BY_FIRST: dict[str, list[tuple[int, str, tuple[str, ...]]]] = {}
for _rank, (_licence, _rule) in enumerate(RULES):
    _BY_FIRST.setdefault(_rule[0], []).append((_rank, _licence, _rule))
# Expressions behind an SPDX tag: names of licences, a plus for later versions, and words and brackets between them.
_SPDX_ID = "spdx-"
_SPDX = re.compile(r"SPDX-License-Identifier\s*:[ \t]*([^\n]*)", re.IGNORECASE)
_SPDX_NAME = re.compile(r"(?:(?<=\s)|(?<=[(:]))(?:(WITH)[ \t]+)?([A-Za-z][A-Za-z0-9.-]*[A-Za-z0-9])(\+?)(?=[\s);,]|\.(?:\s|\Z)|\Z)")
_SPDX_NAMES = {re.sub(r"[\W_]+", " ", v.removeprefix(_SPDX_ID).lower()): v for v in SENTENCES.values() if v.startswith(_SPDX_ID)} | {
    k.removeprefix("spdx license identifier "): v for k, v in SENTENCES.items() if v.startswith(_SPDX_ID)
}
# Words before a grant that take it back.
_NEGATIONS = frozenset("not never neither nor without".split())
# Grants of one version of a GNU licence.
_ONLY = frozenset(x for x in SENTENCES.values() if x.endswith("-grant") and x.split("-")[0] in ("gpl", "lgpl", "agpl"))

_SENTENCE = re.compile(r"(?s:.)+?(?:(?<!\bv)(?<!\bV)[.!?;]+(?=\s|\Z)|(?=\n[^\w\n]*(?:\n|\Z))|\Z)")
_WORD = re.compile(r"[^\W_]+")
_COMMENT = re.compile(r"(?<=\n)([ \t@]*)(dnl|rem)\b", re.IGNORECASE)
# Words that every known sentence holds at least one of; other sentences need no look-up.
_MARK = re.compile(r"licen|permission|copy|rights\W+reserved|redistribut|free\W+software|warranty|version|endorse|as\W+is\b|general\W+public|unencumbered|\bagpl\b", re.IGNORECASE)

# Known sentences as words, by their first two, longest first.
_KNOWN: dict[tuple[str, str], list[tuple[list[str], str]]] = {}
for _words, _name in sorted(((k.split(), v) for k, v in SENTENCES.items()), key=lambda x: -len(x[0])):
    _KNOWN.setdefault((_words[0], _words[1]), []).append((_words, _name))


def known_sentences(sentence: str) -> list[tuple[int, int, str]]:
    """Start, end and identifier of the known sentences in a sentence, in order and without overlap."""
    if not _MARK.search(sentence):
        return []
    # Comment words become signs of the same length, so that places stay.
    bare = _COMMENT.sub(lambda m: m[1] + " " * len(m[2]), sentence)
    out, at = [], 0
    for tag in _SPDX.finditer(bare):
        out += _expression(bare, tag.start(), tag.start(1), tag.end(1))
        bare = bare[: tag.start()] + " " * (tag.end() - tag.start()) + bare[tag.end() :]
    places = [(m.start(), m.end(), m.group().lower()) for m in _WORD.finditer(bare)]
    found = [p[2] for p in places]
    while at < len(found) - 1:
        for wanted, name in _KNOWN.get((found[at], found[at + 1]), ()):
            after = at + len(wanted)
            if found[at:after] == wanted and not (name in _ONLY and found[after : after + 1] == ["or"]):
                if not (name.endswith("-grant") and _taken_back(found[max(at - 4, 0) : at])):
                    out.append((places[at][0], places[after - 1][1], name))
                at = after
                break
        else:
            at += 1
    return sorted(out)


def _taken_back(before: list[str]) -> bool:
    """Whether the words before a grant say that it is none: "is not", "no longer", "isn't"."""
    shortened = any(a.endswith("n") and b == "t" for a, b in zip(before, before[1:]))
    return shortened or bool(_NEGATIONS & set(before)) or before[-2:] == ["no", "longer"]


def _expression(sentence: str, start: int, at: int, end: int) -> list[tuple[int, int, str]]:
    """Every licence of an SPDX expression, the first from its tag on; exceptions after WITH are none."""
    out = []
    for m in _SPDX_NAME.finditer(sentence, at, end):
        name = m[2]
        if name.upper() in ("OR", "AND", "WITH") or m[1]:
            continue
        if out and not re.search(r"\b(?:OR|AND)\b|[(]", sentence[out[-1][1] : m.start(2)], re.IGNORECASE):
            break  # Words behind the expression.
        words = re.sub(r"[\W_]+", " ", name.lower())
        if m[3]:
            words = words.removesuffix(" only") + " or later"
        out.append((start if not out else m.start(2), m.end(), _SPDX_NAMES.get(words, _SPDX_ID + name + m[3])))
    return out


def identify(sentence: str) -> str | None:
    """The identifier of the first known sentence in a sentence."""
    found = known_sentences(sentence)
    return found[0][2] if found else None


def identifiers(text: str | None) -> list[tuple[int, int, int, str]]:
    """Number of the sentence, start and end in code points, and identifier, of every known sentence."""
    if not text or not _MARK.search(text):
        return []
    found = []
    for number, m in enumerate(m for m in _SENTENCE.finditer(text) if _WORD.search(m.group())):
        for start, end, known in known_sentences(m.group()):
            while m.start() + end < m.end() and text[m.start() + end] in ".!?;":
                end += 1
            found.append((number, m.start() + start, m.start() + end, known))
    return found


def match_rules(found: list[tuple[int, int, int, str]], gap: int = GAP) -> list[tuple[str, int, int]]:
    """Licence with start and end, in order of place.

    The first rule that fits anywhere takes its identifiers, at the first place it does, and so on with what is left. All
    places are found in one pass, by the identifiers that rules begin with, and taken in the order of rule and place.
    """
    fits = []
    for i, (*_, known) in enumerate(found):
        for rank, licence, rule in _BY_FIRST.get(known, ()):
            run = found[i : i + len(rule)]
            if tuple(x[3] for x in run) == rule and all(b[0] - a[0] <= gap + 1 for a, b in zip(run, run[1:])):
                fits.append((rank, i, licence, len(rule)))
        if known.startswith(_SPDX_ID) and known not in _BY_FIRST:
            fits.append((len(RULES), i, known.removeprefix(_SPDX_ID), 1))
    out, taken = [], bytearray(len(found))
    for _, i, licence, n in sorted(fits):
        if not any(taken[i : i + n]):
            taken[i : i + n] = b"\1" * n
            out.append((licence, found[i][1], found[i + n - 1][2]))
    return sorted(out, key=lambda x: (x[1], x[2]))


_SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("licences", pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("identifiers", pa.list_(pa.string())),
    ]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = [identifiers(t) for t in batch["text"].to_pylist()]
        licences = [[dict(zip(("licence", "start", "end"), m)) for m in match_rules(f)] for f in found]
        columns = [batch["id"], pa.array(licences, _SCHEMA.field(1).type), pa.array([[x[3] for x in f] for f in found], _SCHEMA.field(2).type)]
        yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, licences (licence, start, end) and identifiers in order, for every row of `docs`."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, "id long, licences array<struct<licence:string,start:long,end:long>>, identifiers array<string>")
