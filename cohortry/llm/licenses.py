"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, which are normalised (lower case, everything but a-z and 0-9 one space) and mapped to the
identifiers of known licence sentences. A sentence may start and end at a line break and go on over others. The sequence of identifiers is matched against the rules in order: a rule holds
when its identifiers stand next to each other in the sequence, and what a rule has matched is not matched again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTENCE_END = r"[.!?;]*\s*\n\s*|[.!?;]+\s+"

# Normalised sentences of published licences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "this software is released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "spdx license identifier mit": "mit-ref",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
    "the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "licensed under the apache license version 2 0": "apache2-ref",
    "licensed under the apache license version 2 0 the license": "apache2-ref",
    "spdx license identifier apache 2 0": "apache2-ref",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 3": "gpl3-ref",
    "spdx license identifier gpl 3 0 only": "gpl3-ref",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "licensed under cc by nc 4 0": "ccbync4-ref",
    "this work is licensed under cc by nc 4 0": "ccbync4-ref",
    "licensed under cc by 4 0": "ccby4-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-1",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution": "bsd-2",
}
# Rules in the order they are tried: longer sequences first.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-1", "bsd-2")),
    ("Apache-2.0", ("apache2-ref", "apache2-comply", "apache2-copy")),
    ("GPL-3.0", ("gpl3-ref", "gpl-copy")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache2-ref", "apache2-comply")),
    ("MIT", ("mit-ref",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("CC-BY-NC-4.0", ("ccbync4-ref",)),
    ("CC-BY-4.0", ("ccby4-ref",)),
)


# The constants above are those of the SQL, which knows sentences on one line only. The operator also finds what follows.
_GNU = (
    ("gnu general public license", "gpl", (("2", "june 1991"), ("3", "29 june 2007"))),
    ("gnu lesser general public license", "lgpl", (("2 1", "february 1999"), ("3", "29 june 2007"))),
    ("gnu affero general public license", "agpl", (("3", "19 november 2007"),)),
)
_MORE = {
    "the mit license": "mit-title",
    "the mit license mit": "mit-title",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial "
    "portions of the software": "mit-notice",
    "this work is licensed under cc by 4 0": "ccby4-ref",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission": "bsd-3",
    "apache license version 2 0 january 2004": "apache2-title",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2-copy",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-ref",
    "mozilla public license version 2 0": "mpl2-ref",
    "this is free and unencumbered software released into the public domain": "unlicense-ref",
}
_MORE |= {
    f"permission to use copy modify and {way}distribute this software for any purpose with or without fee is hereby granted provided that "
    "the above copyright notice and this permission notice appear in all copies": "isc-grant"
    for way in ("", "or ")
}
_MORE |= {
    f"this work is licensed under {a} creative commons attribution {kind}4 0 international license": f"{i}-ref"
    for a in ("a", "the")
    for kind, i in (("", "ccby4"), ("noncommercial ", "ccbync4"), ("sharealike ", "ccbysa4"))
}
_NAMES = {
    "gpl2": "GPL-2.0", "gpl3": "GPL-3.0", "lgpl21": "LGPL-2.1", "lgpl3": "LGPL-3.0", "agpl3": "AGPL-3.0", "mpl2": "MPL-2.0", "isc": "ISC",
    "bsd2": "BSD-2-Clause", "bsd3": "BSD-3-Clause", "unlicense": "Unlicense", "ccby4": "CC-BY-4.0", "ccbync4": "CC-BY-NC-4.0", "ccbysa4": "CC-BY-SA-4.0",
}
for _i, _name in _NAMES.items():
    for _end in ("", " only", " or later") if "gpl" in _i else ("",):
        _MORE.setdefault(f"spdx license identifier {_name.lower().replace('-', ' ').replace('.', ' ')}{_end}", f"{_i}-ref")
_FIRST, _LAST = [("BSD-3-Clause", ("bsd-grant", "bsd-1", "bsd-2", "bsd-3"))], [("Apache-2.0", ("apache2-title",)), ("ISC", ("isc-grant",))]
for _gnu, _i, _versions in _GNU:
    _terms = "you can redistribute it and or modify it under the terms of the "
    _by = "as published by the free software foundation"
    _MORE[f"{_terms}{_gnu} {_by}"] = f"{_i}-terms"
    for _v, _day in _versions:
        _n = f"{_i}{_v.replace(' ', '')}"
        for _s in (f"{_gnu} version {_v} {_day}", f"{_terms}{_gnu} version {_v} {_by}", f"{_terms}{_gnu} {_by} version {_v} of the license"):
            _MORE[_s] = f"{_n}-ref"
        _MORE[f"{_terms}{_gnu} {_by} either version {_v} of the license or at your option any later version"] = f"{_n}-ref"
        _MORE[f"either version {_v} of the license or at your option any later version"] = f"later-{_v.replace(' ', '')}"
        _LAST.append((_NAMES[_n], (f"{_i}-terms", f"later-{_v.replace(' ', '')}")))
_LAST += [(name, (f"{i}-ref",)) for i, name in _NAMES.items() if f"{i}-ref" not in ("gpl3-ref", "ccby4-ref", "ccbync4-ref")]
ALL_SENTENCES = _MORE | SENTENCES
ALL_RULES = (*_FIRST, *RULES, *_LAST)

# In the plain text "|" is a sentence's end and "/" a line's end or colon, over which a sentence may go on.
HARD = r"[.!?;]+(?=\s)|(?<=\n)[\s#*/;%!-]*\(?[0-9a-zA-Z]{1,2}\)(?=\s)"
SOFT = r":(?=\s)|\n"
BSD_NAME = (
    r"(?<=[|/])neither[ /]the[ /]names?[ /]of[ /][a-z0-9 /]{1,120}?[ /]nor[ /]the[ /]names[ /]of[ /](?:its|their)[ /]contributors[ /]may"
)


def _pattern(ids: tuple[str, ...]) -> str:
    return "".join(f"<{i}>" for i in ids)


def plain(text: Column) -> Column:
    """a-z, 0-9 and single spaces, "|" and "/" between; comment marks are gone, a line without a word ends a sentence."""
    marked = F.regexp_replace(F.regexp_replace(text, HARD, "\u0001\n"), SOFT, "\u0002")
    bare = F.translate(F.regexp_replace(F.lower(marked), "[^a-z0-9\u0001\u0002]+", " "), "\u0001\u0002", "|/")
    ends = F.regexp_replace(F.regexp_replace(bare, r" ?([|/]) ?", "$1"), r"[|/]*(?:\||//)[|/]*", "|")
    return F.concat(F.lit("|"), F.trim(ends), F.lit("|"))


def sentence_ids(text: Column) -> Column:
    """The known sentences' identifiers in text order, each in angle brackets; a sentence may go on over line ends."""
    known = F.create_map(*[F.lit(x) for pair in ALL_SENTENCES.items() for x in pair])
    ways = "|".join(s.replace(" ", "[ /]") for s in sorted(ALL_SENTENCES, key=len, reverse=True))
    holder = F.lit("neither the name of the copyright holder nor the names of its contributors may")
    named = F.regexp_replace(plain(text), F.lit(BSD_NAME), holder)
    found = F.regexp_extract_all(named, F.lit(f"(?<=[|/])(?:{ways})(?=[|/])"), F.lit(0))
    ids = F.transform(found, lambda s: F.concat(F.lit("<"), F.try_element_at(known, F.translate(s, "/", " ")), F.lit(">")))
    return F.array_join(ids, "")


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with license_sentences (identifiers in order) and licenses (names in rule order, comma-joined, each once).

    Both are empty for a NULL or empty text and where no known sentence occurs. Rows come back one to one, also repeated
    ones and those with a NULL id; columns of those names are replaced. An empty frame stays empty.
    """
    base = docs.drop("license_sentences", "licenses")
    out = base.withColumn("license_sentences", sentence_ids(F.coalesce(F.col(text_col), F.lit(""))))
    out = out.withColumn("__left", F.col("license_sentences"))
    for i, (name, ids) in enumerate(ALL_RULES):
        held = F.col("__left").contains(_pattern(ids))
        out = out.withColumns({f"__rule{i}": F.when(held, F.lit(name)), "__left": F.replace("__left", F.lit(_pattern(ids)), F.lit("|"))})
    names = [f"__rule{i}" for i in range(len(ALL_RULES))]
    found = F.array_distinct(F.filter(F.array(*names), lambda n: n.isNotNull()))
    return out.withColumn("licenses", F.array_join(found, ",")).drop("__left", *names)


def oracle() -> str:
    """DuckDB SQL for doc_id, license_sentences and licenses of ``documents``."""
    known = " ".join(f"WHEN '{s}' THEN '<{i}>'" for s, i in SENTENCES.items())
    left, held = "license_sentences", []
    for name, ids in RULES:
        held.append(f"CASE WHEN contains({left}, '{_pattern(ids)}') THEN '{name}' END")
        left = f"replace({left}, '{_pattern(ids)}', '|')"
    return f"""
WITH p AS (SELECT doc_id, string_split_regex(coalesce(text, ''), '{SENTENCE_END}') AS parts FROM documents),
i AS (SELECT doc_id, list_transform(parts, lambda s: CASE trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) {known} ELSE '' END) AS ids FROM p),
s AS (SELECT doc_id, array_to_string(ids, '') AS license_sentences FROM i),
h AS (SELECT doc_id, license_sentences, list_filter([{', '.join(held)}], lambda n: n IS NOT NULL) AS names FROM s),
u AS (SELECT doc_id, license_sentences, list_filter(names, lambda n, k: list_position(names, n) = k) AS names FROM h)
SELECT doc_id, license_sentences, array_to_string(names, ',') AS licenses FROM u
"""
