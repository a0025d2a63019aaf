"""Licence scans by sentence rules, in DataFrame operations only.

A text is cut into parts at line ends and after marks, and the parts are normalised (lower
case, words of letters and digits, one blank between them). A known licence sentence is
recognised where it is a whole part, or some parts in a row that are cut apart only by single
line ends (with any comment marks), colons or semicolons: so notices are found as wrapped and
commented in files. Of several that begin at the same part, the longest is taken, and it takes
its parts. What is found is
a sequence of sentence identifiers, in the text's order. Ordered licence rules, the longest
texts first, are then matched against the sequence: a rule's identifiers must follow each
other directly among the recognised sentences, and a rule takes the sentences it matches, so
that later rules don't see them.

Everything happens within a row: no shuffle, whatever the texts hold.

Defined results: null and empty texts have no sentences and no licence. A null identifier is
returned as it is; repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored. Of a licence found several times in a text, ``licenses`` has one
entry, at its first place, and ``matches`` counts all.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, in their normal form.
SENTENCES: Mapping[str, str] = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software without "
        "restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom "
        "the software is furnished to do so subject to the following conditions"
    ),
    "mit-condition": (
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software"
    ),
    "as-is": (
        "the software is provided as is without warranty of any kind express or implied including "
        "but not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement"
    ),
    "no-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of or "
        "in connection with the software or the use or other dealings in the software"
    ),
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-the": "licensed under the apache license version 2 0 the license",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": (
        "unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind "
        "either express or implied"
    ),
    "apache-see": (
        "see the license for the specific language governing permissions and limitations under "
        "the license"
    ),
    "gpl-3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"
    ),
    "gpl-2-free": (
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation either "
        "version 2 of the license or at your option any later version"
    ),
    "gpl-2-only-free": (
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license version 2 as published by the free software foundation"
    ),
    "lgpl-21-free": (
        "this library is free software you can redistribute it and or modify it under the terms of "
        "the gnu lesser general public license as published by the free software foundation either "
        "version 2 1 of the license or at your option any later version"
    ),
    "lgpl-3-free": (
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu lesser general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"
    ),
    "agpl-3-free": (
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu affero general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"
    ),
    "mpl-2-notice": (
        "this source code form is subject to the terms of the mozilla public license v"
    ),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies"
    ),
    "boost-notice": "distributed under the boost software license version 1 0",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "wtfpl": (
        "everyone is permitted to copy and distribute verbatim or modified copies of this license "
        "document and changing it is allowed as long as the name is changed"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-details": "see the gnu general public license for more details",
    "bsd-redistribution": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission"
    ),
    "cc-by-nc-4-notice": "licensed under cc by nc 4 0",
    "cc-by-sa-4-notice": "licensed under cc by sa 4 0",
    "cc-by-4-notice": "licensed under cc by 4 0",
    "cc0-notice": "licensed under cc0 1 0",
    "reserved": "all rights reserved",
}

#: Licences that a file may name on a line of its own.
SPDX = (
    "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0-only GPL-2.0-or-later GPL-3.0-only "
    "GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later "
    "AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 EPL-2.0 ISC BSL-1.0 Zlib Unlicense WTFPL CC0-1.0 "
    "CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0"
).split()
SENTENCES = dict(SENTENCES) | {
    f"spdx-{x}": "spdx license identifier " + re.sub(r"[^a-z0-9]+", " ", x.lower()) for x in SPDX
}

#: Licence and the sentence identifiers that state it, in the order in which rules apply.
RULES: Sequence[tuple[str, Sequence[str]]] = (
    ("Apache-2.0", ("apache-notice-the", "apache-compliance", "apache-copy", "apache-as-is", "apache-see")),
    ("MIT", ("mit-grant", "mit-condition", "as-is", "no-liability")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl-2-free", "gpl-hope", "gpl-details")),
    ("GPL-2.0-only", ("gpl-2-only-free", "gpl-hope", "gpl-details")),
    ("Apache-2.0", ("apache-notice-the", "apache-compliance")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("Apache-2.0", ("apache-notice-the",)),
    ("Apache-2.0", ("apache-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0-only", ("gpl-3-notice",)),
    ("GPL-2.0-only", ("gpl-2-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    ("CC-BY-4.0", ("cc-by-4-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("GPL-2.0-or-later", ("gpl-2-free",)),
    ("GPL-2.0-only", ("gpl-2-only-free",)),
    ("LGPL-2.1-or-later", ("lgpl-21-free",)),
    ("LGPL-3.0-or-later", ("lgpl-3-free",)),
    ("AGPL-3.0-or-later", ("agpl-3-free",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("ISC", ("isc-grant",)),
    ("BSL-1.0", ("boost-notice",)),
    ("Zlib", ("zlib-as-is",)),
    ("Unlicense", ("unlicense",)),
    ("WTFPL", ("wtfpl",)),
    *((x, (f"spdx-{x}",)) for x in SPDX),
    ("proprietary", ("reserved",)),
)

#: A part ends at a line's end, and after its mark before a blank.
SENTENCE_END = r"[\n\r]+|(?<=[.!?:;])[ \t\n\x0B\f\r]+"


def sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_END)


#: What stands in normal text for a cut that a known sentence may span, and for one it may not.
SOFT, HARD = "\u0001", "\u0002"
_GAP = r"[^\p{L}\p{N}]"
#: A gap between words that ends a sentence: a mark before a blank in the first line, or a blank
#: line. Both look ahead from the gap's start only, so a long gap is read a fixed number of times.
HARD_GAP = (
    rf"(?<!{_GAP})(?:(?=[^\p{{L}}\p{{N}}\r\n]*?[.!?][ \t\n\x0B\f\r])"
    rf"|(?=[^\p{{L}}\p{{N}}\r\n]*+(?>\r\n|\n|\r)[^\p{{L}}\p{{N}}\r\n]*+[\r\n])){_GAP}++"
)
_OPEN_GAP = r"[^\p{L}\p{N}\u0002]"
SOFT_GAP = rf"(?<!{_OPEN_GAP})(?={_OPEN_GAP}*?(?:[\r\n]|[:;][ \t\n\x0B\f\r])){_OPEN_GAP}++"


def normal(text: Column) -> Column:
    """Lower case; what isn't letters and digits is one blank, or the mark of a cut."""
    text = F.translate(F.lower(text), SOFT + HARD, "--")
    for gap, mark in ((HARD_GAP, HARD), (SOFT_GAP, SOFT), (r"[^\p{L}\p{N}\u0001\u0002]+", " ")):
        text = F.regexp_replace(text, gap, mark)
    return F.trim(text)


def recognised(text: Column, known: Mapping[str, str]) -> Column:
    """The identifiers of the known sentences of a text, in order, as ``<one><another>``."""
    known = {k: x for k, x in known.items() if x}
    if not known:
        return F.lit("")
    longest_first = sorted(set(known.values()), key=lambda x: (-len(x), x))
    any_known = "|".join(
        f"[ {SOFT}]".join(re.escape(w) for w in x.split(" ")) for x in longest_first
    )
    cut = f"{SOFT}{HARD}"
    found = F.regexp_extract_all(
        normal(text), F.lit(f"(?<![^{cut}])(?:{any_known})(?![^{cut}])"), F.lit(0)
    )
    texts = F.array(*[F.lit(x) for x in known.values()])
    names = F.array(*[F.lit(f"<{x}>") for x in known])
    places = F.transform(found, lambda x: F.array_position(texts, F.translate(x, SOFT, " ")))
    return F.array_join(F.transform(places, lambda p: F.get(names, (p - 1).cast("int"))), "")


def apply_rules(sequence: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The sequence with each match of a rule, in the rules' order, turned into ``#licence;``."""
    return reduce(
        lambda s, rule: F.replace(
            s, F.lit("".join(f"<{i}>" for i in rule[1])), F.lit(f"#{rule[0]};")
        ),
        rules,
        sequence,
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
) -> DataFrame:
    """A row for each row of ``docs``.

    doc_id, n_sentences (the parts with a word), recognised (the identifiers, in order, in
    angle brackets), licenses (with a comma between) and matches (of rules).
    """
    for name in (*known, *[r[0] for r in rules]):
        if set(name) & set("<>#;"):
            raise ValueError(f"{name}: a name has none of < > # ;")
    for name, steps in rules:
        unknown = set(steps) - set(known)
        if unknown or not steps:
            raise ValueError(f"rule {name}: no sentences {sorted(unknown)}")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select(
        "doc_id",
        F.size(F.filter(sentences(F.col("text")), lambda s: s.rlike(r"[\p{L}\p{N}]"))).alias("n"),
        recognised(F.col("text"), known).alias("sequence"),
    )
    rows = rows.withColumn(
        "found", F.regexp_extract_all(apply_rules(F.col("sequence"), rules), F.lit("#([^;]+);"), 1)
    )
    return rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_sentences"),
        F.col("sequence").alias("recognised"),
        F.array_join(F.array_distinct("found"), ",").alias("licenses"),
        F.size("found").cast("long").alias("matches"),
    )
