"""Licences by sentence rules (DataFrame functions only).

Sentences end at closing marks and at line ends; a known sentence may be wrapped over lines wherever
it stands, and the longest that begins at a place counts. A text is normalised to lower-case letters
and digits, and a known licence sentence is mapped to its identifier, a grant or SPDX tag that names
several licences to one for each (which of AND, OR and WITH joins them is not told). A line or sentence
outside all of these that speaks of licences gets ``unknown``. The identifiers of
a text in order form a sequence, and ordered rules are matched against it: each rule names the
identifiers that must follow each other and the licence they grant. What a rule has matched is
taken out before the next rule is tried, so longer grants come before the sentences they contain.

All of this happens within the row: no shuffle, and no text leaves its task.

Defined results: a null text counts as empty and has no licence; a licence that is granted several
times is listed once; repeated rows get the same result; an empty table gives an empty result.
Columns beyond doc_id and text play no part and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Ends of sentences inside a line: closing marks and the blanks behind them.
CLOSING = r"([.;:!?])[\x20\x09-\x0D]+"
#: Normalised sentences of this kind that are not known are reported.
SPEAKS = r"\b(licen[cs]ed?|copyright|warranty|spdx)\b"
UNKNOWN = "unknown"
#: Line ends, with what a comment puts before and after them.
LINES = r"[\x20\x09*#/]*[\x0A\x0D]+[\x20\x09*#/]*"
#: Ends of sentences, also with what a comment puts at the end of the line behind them.
CLOSES = r"[.;:!?](?:[\x20\x09*#/]*\n|[\x20\x09-\x0D])"

# fixed values: normalised sentences of well-known licences and their identifiers
SENTENCES = {
    "this work is licensed under the gnu general public license version 3": "gpl3-work",
    "this work is licensed under the gnu general public license version 2": "gpl2-work",
    "licensed under the gnu general public license version 3": "gpl3-work",
    "licensed under the gnu general public license version 2": "gpl2-work",
    "licensed under the gnu lesser general public license version 3": "lgpl3-work",
    "licensed under the gnu affero general public license version 3": "agpl3-work",
    "this program is free software": "free-software",
    "you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation": "gpl-redistribute",
    "you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 3 of the license or at your option any "
    "later version": "gpl3-redistribute",
    "either version 2 of the license or at your option any later version": "version2-later",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-merchant",
    "licensed under the apache license version 2 0": "apache2-grant",
    "licensed under the apache license version 2 0 the license": "apache2-grant",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy",
    "http www apache org licenses license 2 0": "apache2-address",
    "see the license for the specific language governing permissions and limitations under the license": "apache2-see",
    "released under the mit license": "mit-grant",
    "licensed under the mit license": "mit-grant",
    "this software is released under the mit license": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to "
    "do so subject to the following conditions": "mit-permission",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd-redistribute",
    "redistributions of source code must retain the above copyright notice this list of conditions "
    "and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the "
    "distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "licensed under the bsd 3 clause license": "bsd3-grant",
    "licensed under the bsd 2 clause license": "bsd2-grant",
    "licensed under cc by 4 0": "cc-by-4",
    "licensed under cc by sa 4 0": "cc-by-sa-4",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "licensed under cc by nd 4 0": "cc-by-nd-4",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-grant",
    "all rights reserved": "all-rights",
    "spdx license identifier mit": "mit-grant",
    "spdx license identifier apache 2 0": "apache2-grant",
    "spdx license identifier gpl 3 0 only": "gpl3-work",
    "spdx license identifier gpl 2 0 only": "gpl2-work",
    "spdx license identifier bsd 3 clause": "bsd3-grant",
    "spdx license identifier bsd 2 clause": "bsd2-grant",
}

# fixed values: licences by their SPDX identifiers, and the names that are reported; a tag that names
# another gets ``unknown``
SPDX = {
    **{
        name: name
        for name in (
            "0BSD", "AFL-3.0", "Apache-1.1", "Apache-2.0", "Artistic-1.0", "Artistic-2.0", "BSD-2-Clause",
            "BSD-2-Clause-Patent", "BSD-3-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause", "BSL-1.0",
            "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-3.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0",
            "CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-3.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0",
            "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "CDDL-1.1", "CECILL-2.1", "ECL-2.0", "EPL-1.0", "EPL-2.0",
            "EUPL-1.1", "EUPL-1.2", "ISC", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "MulanPSL-2.0",
            "NCSA", "ODbL-1.0", "OFL-1.1", "OpenSSL", "OSL-3.0", "PHP-3.01", "PostgreSQL", "PSF-2.0",
            "Python-2.0", "Ruby", "Unlicense", "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "Zlib", "ZPL-2.1",
        )
    },
    **{
        f"{name}{tail}": f"{name}{'-or-later' if tail == '-or-later' else ''}"
        for name in ("AGPL-3.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")
        for tail in ("", "-only", "-or-later")
    },
}

# fixed values: names of licences in sentences that grant them, normalised
NAMES = {
    "mit license": "MIT",
    "mit open source license": "MIT",
    "expat license": "MIT",
    "isc license": "ISC",
    "apache license version 2 0": "Apache-2.0",
    "apache license 2 0": "Apache-2.0",
    "apache license v2 0": "Apache-2.0",
    "apache license version 2": "Apache-2.0",
    "apache 2 0 license": "Apache-2.0",
    "apache 2 license": "Apache-2.0",
    "apache software license version 2 0": "Apache-2.0",
    "bsd 2 clause license": "BSD-2-Clause",
    "simplified bsd license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause",
    "3 clause bsd license": "BSD-3-Clause",
    "2 clause bsd license": "BSD-2-Clause",
    "new bsd license": "BSD-3-Clause",
    "modified bsd license": "BSD-3-Clause",
    "mozilla public license version 2 0": "MPL-2.0",
    "mozilla public license 2 0": "MPL-2.0",
    "mozilla public license v 2 0": "MPL-2.0",
    "mozilla public license v2 0": "MPL-2.0",
    "eclipse public license version 2 0": "EPL-2.0",
    "eclipse public license 2 0": "EPL-2.0",
    "eclipse public license v 2 0": "EPL-2.0",
    "eclipse public license v2 0": "EPL-2.0",
    "eclipse public license v1 0": "EPL-1.0",
    "boost software license version 1 0": "BSL-1.0",
    "zlib license": "Zlib",
    "unlicense": "Unlicense",
    "creative commons zero v1 0 universal license": "CC0-1.0",
    "cc0 1 0 universal license": "CC0-1.0",
}
for _kind, _code in (
    ("attribution", "BY"), ("attribution sharealike", "BY-SA"), ("attribution share alike", "BY-SA"),
    ("attribution noncommercial", "BY-NC"), ("attribution non commercial", "BY-NC"),
    ("attribution noderivatives", "BY-ND"), ("attribution noderivs", "BY-ND"),
    ("attribution no derivatives", "BY-ND"),
    ("attribution noncommercial sharealike", "BY-NC-SA"),
    ("attribution noncommercial share alike", "BY-NC-SA"),
    ("attribution noncommercial noderivatives", "BY-NC-ND"),
    ("attribution noncommercial noderivs", "BY-NC-ND"),
):
    for _number in ("3 0", "4 0"):
        _name = f"CC-{_code}-{_number.replace(' ', '.')}"
        for _tail in ("", " international", " unported", " license", " international license", " unported license"):
            NAMES[f"creative commons {_kind} {_number}{_tail}"] = _name
        _short = f"cc {_code.lower().replace('-', ' ')} {_number}"
        NAMES |= {_short: _name, f"{_short} license": _name}
for _kind, _short, _code, _numbers in (
    ("", "gpl", "GPL", ("2", "3")),
    ("lesser ", "lgpl", "LGPL", ("2 1", "3")),
    ("library ", "", "LGPL", ("2",)),
    ("affero ", "agpl", "AGPL", ("3",)),
):
    for _number in _numbers:
        for _zero in ("", " 0") if " " not in _number else ("",):
            _name = f"{_code}-{_number.replace(' ', '.') if ' ' in _number else _number + '.0'}"
            _v = _number + _zero
            _all = [f"gnu {_kind}general public license {w}{_v}" for w in ("version ", "v", "")]
            if _short:
                _all += [f"{w}{_short}{x}{_v}" for w in ("", "gnu ") for x in ("v", " v", " ", " version ")]
                _all += [f"{x} license" for x in _all if not x.startswith("gnu ") or "general" not in x]
            for _x in _all:
                NAMES[_x] = _name
                for _tail in ("or later", "or any later version", "or at your option any later version", "or newer"):
                    NAMES[f"{_x} {_tail}"] = f"{_name}-or-later"

#: Beside SENTENCES, more sentences of the families: redistribution paragraphs, and what belongs to them.
MORE = {
    "either version 2 1 of the license or at your option any later version": "version21-later",
    "either version 3 of the license or at your option any later version": "version3-later",
    "you should have received a copy of the gnu lesser general public license along with this library": "lgpl-copy",
    "you should have received a copy of the gnu lesser general public license along with this program": "lgpl-copy",
    "you should have received a copy of the gnu affero general public license along with this program": "agpl-copy",
    "https www apache org licenses license 2 0": "apache2-address",
    "this is free and unencumbered software released into the public domain": "unlicense-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies":
        "isc-permission",
    "permission to use copy modify and distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies":
        "isc-permission",
    "gnu general public license version 3 29 june 2007": "spdx:GPL-3.0",
    "gnu general public license version 2 june 1991": "spdx:GPL-2.0",
    "gnu lesser general public license version 3 29 june 2007": "spdx:LGPL-3.0",
    "gnu lesser general public license version 2 1 february 1999": "spdx:LGPL-2.1",
    "gnu affero general public license version 3 19 november 2007": "spdx:AGPL-3.0",
    "apache license version 2 0 january 2004": "spdx:Apache-2.0",
}
#: The licence's short name, the name of its redistribution sentence, and the versions it may name.
_FAMILIES = (("gpl", "", ("2", "3")), ("lgpl", "lesser ", ("2 1", "3")), ("lgpl", "library ", ("2",)), ("agpl", "affero ", ("3",)))
for _short, _kind, _numbers in _FAMILIES:
    _base = (
        "you can redistribute it and or modify it under the terms of the gnu {}general public license{} as "
        "published by the free software foundation"
    )
    MORE.setdefault(_base.format(_kind, ""), f"{_short}-redistribute")
    for _number in _numbers:
        _v = _number.replace(" ", "")
        _later = f" either version {_number} of the license or at your option any later version"
        MORE[_base.format(_kind, "") + _later] = f"{_short}{_v}-redistribute"
        for _x in (f" version {_number}", f" version {_number} only"):
            MORE[_base.format(_kind, _x)] = f"{_short}{_v}-only"
            MORE[_base.format(_kind, "") + _x] = f"{_short}{_v}-only"
        MORE[_base.format(_kind, "") + f" version {_number} of the license"] = f"{_short}{_v}-only"
# what stands in SENTENCES keeps its identifier
MORE = {x: name for x, name in MORE.items() if x not in SENTENCES}

# fixed values: identifiers that follow each other, and the licence, in the order in which they are tried
RULES = (
    ("free-software gpl3-redistribute", "GPL-3.0-or-later"),
    ("free-software gpl-redistribute version2-later", "GPL-2.0-or-later"),
    ("gpl3-work", "GPL-3.0"),
    ("gpl2-work", "GPL-2.0"),
    ("lgpl3-work", "LGPL-3.0"),
    ("agpl3-work", "AGPL-3.0"),
    ("apache2-grant apache2-comply apache2-copy apache2-address", "Apache-2.0"),
    ("apache2-grant", "Apache-2.0"),
    ("mit-permission mit-notice", "MIT"),
    ("mit-grant", "MIT"),
    ("bsd-redistribute bsd-source bsd-binary bsd-endorse", "BSD-3-Clause"),
    ("bsd-redistribute bsd-source bsd-binary", "BSD-2-Clause"),
    ("bsd3-grant", "BSD-3-Clause"),
    ("bsd2-grant", "BSD-2-Clause"),
    ("cc-by-nc-nd-4", "CC-BY-NC-ND-4.0"),
    ("cc-by-nc-sa-4", "CC-BY-NC-SA-4.0"),
    ("cc-by-nd-4", "CC-BY-ND-4.0"),
    ("cc-by-nc-4", "CC-BY-NC-4.0"),
    ("cc-by-sa-4", "CC-BY-SA-4.0"),
    ("cc-by-4", "CC-BY-4.0"),
    ("mpl2-grant", "MPL-2.0"),
    ("all-rights", "all-rights-reserved"),
)

#: Beside RULES, and tried after them.
MORE_RULES = (
    ("free-software gpl2-redistribute", "GPL-2.0-or-later"),
    ("free-software gpl-redistribute version3-later", "GPL-3.0-or-later"),
    ("free-software gpl2-only", "GPL-2.0"),
    ("free-software gpl3-only", "GPL-3.0"),
    ("free-software lgpl2-redistribute", "LGPL-2.0-or-later"),
    ("free-software lgpl21-redistribute", "LGPL-2.1-or-later"),
    ("free-software lgpl3-redistribute", "LGPL-3.0-or-later"),
    ("free-software lgpl-redistribute version2-later", "LGPL-2.0-or-later"),
    ("free-software lgpl-redistribute version21-later", "LGPL-2.1-or-later"),
    ("free-software lgpl-redistribute version3-later", "LGPL-3.0-or-later"),
    ("free-software lgpl2-only", "LGPL-2.0"),
    ("free-software lgpl21-only", "LGPL-2.1"),
    ("free-software lgpl3-only", "LGPL-3.0"),
    ("free-software agpl3-redistribute", "AGPL-3.0-or-later"),
    ("free-software agpl-redistribute version3-later", "AGPL-3.0-or-later"),
    ("free-software agpl3-only", "AGPL-3.0"),
    ("isc-permission", "ISC"),
    ("unlicense-text", "Unlicense"),
    *((f"spdx:{name}", name) for name in sorted(set(SPDX.values()))),
)


#: What comes before and after the name in a sentence that grants a licence.
HEAD = (
    "(?:(?:(?!copyright |warranty |licen|spdx |not? |none |nothing |neither )[a-z0-9]+ ){1,8}(?:is |are ))??"
    "(?:also )?(?:dual )?"
    "(?:licensed|released|distributed|published|provided|covered|(?:made )?available) "
    "(?:to you )?under (?:either (?:of )?)?(?:the )?(?:terms of )?(?:both )?(?:an? |the )?"
)
APACHE = "(?:(?:the )?[a-z0-9]+ )?licenses this file to you under the "
TAIL = (
    "(?: the license| see (?:the )?licen[cs]e(?: [a-z0-9]+){0,5}"
    "| as (?:found|described|stated) in (?:the )?license(?: [a-z0-9]+){0,3})"
)
TAG = "spdx license identifier "
#: Between the licences of one sentence or tag.
JOIN = " (?:or|and) (?!later|newer|any|at )(?:the )?"
FREE = "(?:[a-z0-9]+ ){1,4}is free software"
ENDORSE = (
    "neither the names? of (?:[a-z0-9]+ ){1,20}nor the names of (?:its|their|the) contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission"
)


def _normal(name: str) -> str:
    return re.sub("[^a-z0-9]+", " ", name.lower())


def _table() -> dict[str, str]:
    """All known sentences, names behind ``grant``, and SPDX identifiers behind their tag."""
    granted = {f"grant {x}": f"spdx:{name}" for x, name in NAMES.items()}
    tagged = {f"{TAG}{_normal(x)}": f"spdx:{name}" for x, name in SPDX.items()}
    return granted | tagged | MORE | SENTENCES


def _worded(sentence: str) -> str:
    """A pattern of a known sentence: its words may lie on several lines."""
    # neither a tag nor the abbreviated version closes a sentence
    sentence = re.sub(r"(\bidentifier|\bv) ", r"\1[~.]", sentence)
    return sentence.replace(" ", r"\s").replace("~", r"\s")


def _alternatives(names: Iterable[str]) -> str:
    return "|".join(_worded(x) for x in sorted(names, key=len, reverse=True))


def _pattern() -> str:
    """The longest known sentence, or else a piece that speaks of licences, between two ends."""
    names = f"(?:{_alternatives(NAMES)})"
    short = f"(?:{_alternatives(map(_normal, SPDX))})"
    kinds = (
        rf"(?:{_worded(HEAD)}|{_worded(APACHE)})(?:{names}(?:{_worded(JOIN)})?)+{_worded(TAIL)}?",
        _worded(ENDORSE),
        _worded(FREE),
        # on one line, whatever the tag names
        "spdx license identifier[ .][a-z0-9 ]+",
        rf"licen[cs]e[ .]{short}",
    )
    known = _alternatives([*SENTENCES, *MORE])
    end = "(?![ a-z0-9])"
    return rf"(?<![ a-z0-9])(?:(?:{known}|{'|'.join(kinds)}){end}|[a-z0-9 ]*{SPEAKS}[a-z0-9 ]*{end})"


def _short_names() -> str:
    return f"(?:{'|'.join(map(_normal, SPDX))})"


FREE_FORM = "this program is free software"
ENDORSE_FORM = (
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission"
)


def _words(text: Column) -> Column:
    """The words of a text, with a blank, a line end or, where a sentence closes, a dot between two."""
    found = F.translate(text, UPPER + "\x00", UPPER.lower() + " ")
    # two signs of their own, so that what follows can tell them from those of the text
    found = F.regexp_replace(found, CLOSES, "\x00")
    found = F.regexp_replace(found, "[^a-z0-9\n\x00]+", " ")
    found = F.regexp_replace(found, "[ \n]*\x00[ \n\x00]*", ".")
    return F.trim(F.regexp_replace(found, " *\n[ \n]*", "\n"))


def identifiers(text: Column) -> Column:
    """The identifiers of a text's licence sentences, in order."""
    known = F.create_map(*[F.lit(x) for item in _table().items() for x in item])
    # the sign behind a version that allows later ones would be lost
    plus = F.regexp_replace(text, r"(?i)\b([AL]?GPL[ -]?v?[0-9]+(?:\.[0-9]+)*)\+", "$1-or-later")
    found = F.regexp_extract_all(_words(plus), F.lit(_pattern()), F.lit(0))

    def name(sentence: Column) -> Column:
        """One identifier, or one for each licence of a tag or grant."""
        x = F.translate(sentence, "\n.", "  ")
        field = F.regexp_replace(x, f"^licen[cs]e (?={_short_names()}$)", TAG)
        for pattern, fixed in ((f"^{FREE}$", FREE_FORM), (f"^{ENDORSE}$", ENDORSE_FORM)):
            field = F.regexp_replace(field, pattern, fixed)
        granted = F.regexp_replace(field, f"^(?:{HEAD}|{APACHE})", "grant ")
        bare = F.regexp_replace(granted, f"{TAIL}$", "")
        kind = F.when(F.startswith(bare, F.lit(TAG)), F.lit(TAG)).when(
            F.startswith(bare, F.lit("grant ")), F.lit("grant ")
        )
        # an exception that goes with a licence leaves the licence
        rest = F.regexp_replace(F.substr(bare, F.length(kind) + 1), " with [a-z0-9 ]*$", "")
        parts = F.transform(
            F.split(rest, JOIN), lambda p: F.coalesce(F.element_at(known, F.concat(kind, p)), F.lit(UNKNOWN))
        )
        single = F.array(F.coalesce(F.element_at(known, field), F.lit(UNKNOWN)))
        return F.when(kind.isNull() | F.element_at(known, field).isNotNull(), single).otherwise(parts)

    named = F.flatten(F.transform(found, name))
    # only texts with such words can hold what is known or reported: all others are passed over early
    hint = "(?i)" + HINT.replace(" ", "[^A-Za-z0-9]+")
    none = F.array().cast("array<string>")
    return F.when(F.regexp_like(text, F.lit(hint)), named).otherwise(none)


#: Every known sentence has one of these stems, as a test checks.
HINT = r"licen[cs]|copyright|warranty|spdx|free software|permission|redistribution|rights reserved|you may|version [23] of|gpl|apache|creative commons|cc by|cc0|unencumbered|names? of"


def _spaced(needed: str) -> str:
    """Each identifier with a blank of its own on both sides."""
    return f" {needed.replace(' ', '  ')} "


def licences(sequence: Column) -> Column:
    """The licences that the rules find in a sequence of identifiers (`` a  b  c ``)."""
    rules = F.array(
        *[F.struct(F.lit(_spaced(needed)).alias("needed"), F.lit(name).alias("name")) for needed, name in (*RULES, *MORE_RULES)]
    )
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("names"))

    def step(seen: Column, rule: Column) -> Column:
        hit = F.contains(seen["left"], rule["needed"])
        names = F.when(hit, F.array_append(seen["names"], rule["name"])).otherwise(seen["names"])
        # what was matched leaves a gap that no rule reaches across
        left = F.when(hit, F.replace(seen["left"], rule["needed"], F.lit(" - "))).otherwise(seen["left"])
        return F.struct(left.alias("left"), names.alias("names"))

    return F.aggregate(rules, start, step, lambda seen: F.array_distinct(seen["names"]))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, licences (comma-joined, in the order of the rules),
    n_sentences (of licences, known or not), n_unknown, identifiers (in order)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), identifiers(whole).alias("ids"))
    # two blanks between identifiers, so that neighbours do not share one
    sequence = F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" "))
    names = F.when(F.size("ids") > 0, licences(sequence)).otherwise(F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        F.array_join(names, ",").alias("licences"),
        F.size("ids").cast("long").alias("n_sentences"),
        F.size(F.filter("ids", lambda x: x == UNKNOWN)).cast("long").alias("n_unknown"),
        F.array_join("ids", " ").alias("identifiers"),
    )


def oracle_sql() -> str:
    """The same in SQL, one step per rule."""
    known = ", ".join(f"('{sentence}', '{name}')" for sentence, name in SENTENCES.items())
    sql = f"""
WITH known(sentence, name) AS (VALUES {known}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
variants AS (
  SELECT r, doc_id, 0 AS joined, text FROM texts
  UNION ALL SELECT r, doc_id, 1, regexp_replace(text, '{LINES}', ' ', 'g') FROM texts),
cut AS (
  SELECT r, doc_id, joined, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM (
    SELECT r, doc_id, joined,
      string_split(regexp_replace(text, '{CLOSING}', '\\1\n', 'g'), '\n') AS parts
    FROM variants)),
normal AS (
  SELECT r, doc_id, joined, pos,
    trim(regexp_replace(translate(part, '{UPPER}', '{UPPER.lower()}'), '[^a-z0-9]+', ' ', 'g')) AS s
  FROM cut),
named AS (
  SELECT r, doc_id, joined, pos, coalesce(name,
    CASE WHEN regexp_matches(s, '{SPEAKS}') THEN '{UNKNOWN}' END) AS name
  FROM normal LEFT JOIN known ON s = sentence),
counted AS (
  SELECT r, doc_id, joined, count(name) AS n_sentences,
    count(*) FILTER (name = '{UNKNOWN}') AS n_unknown,
    coalesce(string_agg(name, ' ' ORDER BY pos) FILTER (name IS NOT NULL), '') AS identifiers
  FROM named GROUP BY r, doc_id, joined),
listed AS (
  SELECT * FROM counted
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY n_sentences - n_unknown DESC, joined) = 1),
step0 AS (SELECT *, ' ' || identifiers || ' ' AS left_, []::VARCHAR[] AS names FROM listed)"""
    for i, (needed, name) in enumerate(RULES):
        sql += f""",
step{i + 1} AS (
  SELECT r, doc_id, n_sentences, n_unknown, identifiers,
    replace(left_, ' {needed} ', ' - ') AS left_,
    CASE WHEN contains(left_, ' {needed} ') AND NOT list_contains(names, '{name}')
      THEN list_append(names, '{name}') ELSE names END AS names
  FROM step{i})"""
    return sql + f"""
SELECT doc_id, array_to_string(names, ',') AS licences, n_sentences, n_unknown, identifiers
FROM step{len(RULES)}"""
