"""Licence scans by sentence rules, in DataFrame functions alone.

A text is normalised with marks where lines and sentences end. Known licence sentences are found as whole runs of lines, so one may be
wrapped anywhere, also in comments; none reaches over a blank line or the end of a sentence. The sequence of identifiers found is matched against ordered rules: a rule holds if its identifiers occur in its order, other
known sentences may stand between. Everything happens within a row, so there is no shuffle.

Cases: null and empty texts have no sentences; repeated rows are scanned each; extra columns are ignored; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised (lower case, anything but letters and digits of ASCII as one space).
SENTENCES = {
    "licensed under the apache license version 2 0": "apache20_notice",
    "licensed under the apache license version 2 0 the license": "apache20_head",
    "you may not use this file except in compliance with the license": "apache20_use",
    "you may obtain a copy of the license at": "apache20_copy",
    "released under the mit license": "mit_notice",
    "licensed under the mit license": "mit_notice",
    "this work is licensed under the gnu general public license version 3": "gpl30_notice",
    "licensed under cc by nc 4 0": "ccbync40_notice",
    "licensed under cc by 4 0": "ccby40_notice",
    "licensed under cc by sa 4 0": "ccbysa40_notice",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_keep",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_names",
}
#: Ordered rules: the identifiers must occur in this order.
RULES = {
    "Apache-2.0": (("apache20_head", "apache20_use", "apache20_copy"), ("apache20_notice",)),
    "BSD-2-Clause": (("bsd_grant", "bsd_source", "bsd_binary"),),
    "BSD-3-Clause": (("bsd_grant", "bsd_source", "bsd_binary", "bsd_names"),),
    "CC-BY-4.0": (("ccby40_notice",),),
    "CC-BY-NC-4.0": (("ccbync40_notice",),),
    "CC-BY-SA-4.0": (("ccbysa40_notice",),),
    "GPL-3.0": (("gpl30_notice",),),
    "ISC": (("isc_grant",),),
    "MIT": (("mit_grant", "mit_keep", "mit_warranty"), ("mit_notice",)),
}
#: A rule that is part of a stricter one does not count where the stricter one holds.
STRICTER = {"BSD-2-Clause": "BSD-3-Clause"}
#: Sentences and rules beyond those of the SQL, which knows the short list above and no wraps but those before a-z.
MORE_SENTENCES = {
    "this file is licensed under the apache license version 2 0": "apache20_notice",
    "this project is licensed under the apache license version 2 0": "apache20_notice",
    "this file is licensed under the mit license": "mit_notice",
    "this project is licensed under the mit license": "mit_notice",
    "apache license version 2 0 january 2004": "apache20_title",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "gnu general public license version 2 june 1991": "gpl20_title",
    "gnu general public license version 3 29 june 2007": "gpl30_title",
    "gnu lesser general public license version 2 1 february 1999": "lgpl21_title",
    "gnu lesser general public license version 3 29 june 2007": "lgpl30_title",
    "gnu affero general public license version 3 19 november 2007": "agpl30_title",
    "mozilla public license version 2 0": "mpl20_title",
    "this source code form is subject to the terms of the mozilla public license v": "mpl_head",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl20_copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl20_copy",
    "this is free and unencumbered software released into the public domain": "unlicense_head",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "zerobsd_grant",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib_liable",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib_grant",
    "the origin of this software must not be misrepresented": "zlib_origin",
    "the origin of this software must not be misrepresented you must not claim that you wrote the original software": "zlib_origin",
    "boost software license version 1 0 august 17th 2003": "bsl10_title",
    "distributed under the boost software license version 1 0": "bsl10_notice",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl10_grant",
    "cc0 1 0 universal": "cc0_title",
    "creative commons legal code cc0 1 0 universal": "cc0_title",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0_notice",
    "eclipse public license v 2 0": "epl20_title",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl20_notice",
    "the artistic license 2 0": "artistic20_title",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies": "postgresql_grant",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd_advertising",
}
MORE_RULES = {
    "AGPL-3.0": (("agpl30_title",),),
    "Apache-2.0": (("apache20_title",),),
    "GPL-2.0": (("gpl20_title",),),
    "GPL-3.0": (("gpl30_title",),),
    "LGPL-2.1": (("lgpl21_title",),),
    "LGPL-3.0": (("lgpl30_title",),),
    "MPL-2.0": (("mpl20_title",), ("mpl_head", "mpl20_copy")),
    "Unlicense": (("unlicense_head",),),
    "0BSD": (("zerobsd_grant",),),
    "Artistic-2.0": (("artistic20_title",),),
    "BSD-4-Clause": (("bsd_grant", "bsd_source", "bsd_binary", "bsd_advertising"),),
    "BSL-1.0": (("bsl10_title",), ("bsl10_notice",), ("bsl10_grant",)),
    "CC0-1.0": (("cc0_title",), ("cc0_notice",)),
    "EPL-2.0": (("epl20_title",), ("epl20_notice",)),
    "PostgreSQL": (("postgresql_grant",),),
    "Zlib": (("zlib_liable", "zlib_grant", "zlib_origin"),),
}
# the notices of the GNU licences: a comma or a semicolon stands before the version, and a semicolon ends a sentence
for _name, _title, _versions in (("GPL", "general", ("2", "3")), ("LGPL", "lesser general", ("2 1", "3")), ("AGPL", "affero general", ("3",))):
    _grant = f"you can redistribute it and or modify it under the terms of the gnu {_title} public license as published by the free software foundation"
    MORE_SENTENCES[_grant] = f"{_name.lower()}_grant"
    for _v in _versions:
        _id, _later = _v.replace(" ", "") if " " in _v else f"{_v}0", f"either version {_v} of the license or at your option any later version"
        MORE_SENTENCES[_later] = f"later{_id}"
        MORE_SENTENCES[f"{_grant} {_later}"] = f"{_name.lower()}{_id}_grant"
        _rule = f"{_name}-{_id[0]}.{_id[1]}"
        MORE_RULES[_rule] = (*MORE_RULES[_rule], (f"{_name.lower()}{_id}_grant",), (f"{_name.lower()}_grant", f"later{_id}"))
for _notice in ("licensed under the apache license 2 0", "licensed under the terms of the apache license version 2 0", "distributed under the apache license version 2 0", "distributed under the terms of the apache license version 2 0"):
    MORE_SENTENCES[_notice] = "apache20_notice"
for _notice in ("distributed under the mit license", "distributed under the terms of the mit license", "licensed under the terms of the mit license", "available under the mit license"):
    MORE_SENTENCES[_notice] = "mit_notice"
for _notice in ("licensed under the mozilla public license 2 0", "licensed under the mozilla public license version 2 0"):
    MORE_SENTENCES[_notice] = "mpl20_notice"
MORE_RULES["MPL-2.0"] = (*MORE_RULES["MPL-2.0"], ("mpl20_notice",))
# identifiers as a header line has them; the colon ends a sentence, so two known lines stand in a row
for _rule in sorted(RULES | MORE_RULES):
    _id = "spdx_" + _rule.lower().replace("-", "").replace(".", "")
    for _end in ("", " only", " or later") if "GPL" in _rule else ("",):
        MORE_SENTENCES["spdx license identifier|" + _rule.lower().replace("-", " ").replace(".", " ") + _end] = _id
    MORE_RULES[_rule] = (*MORE_RULES.get(_rule, ()), (_id,))
#: Sentences that name someone: what stands for the name, and the known sentence that each is read as. A name has up to twelve words and may hold a stop.
NAMED = {
    r"neither[ \n]the[ \n]names?[ \n]of[ \n|](?:[a-z0-9]+[ \n|]){1,12}?nor[ \n|]the[ \n]names[ \n]of[ \n](?:its[ \n]|any[ \n]|other[ \n])?contributors[ \n]may[ \n]be[ \n]used[ \n]to[ \n]endorse[ \n]or[ \n]promote[ \n]products[ \n]derived[ \n]from[ \n]this[ \n]software[ \n]without[ \n]specific[ \n]prior[ \n]written[ \n]permission":
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    r"(?:the[ \n])?names?[ \n]of[ \n|](?:[a-z0-9]+[ \n|]){1,12}?may[ \n]not[ \n]be[ \n]used[ \n]to[ \n]endorse[ \n]or[ \n]promote[ \n]products[ \n]derived[ \n]from[ \n]this[ \n]software[ \n]without[ \n]specific[ \n]prior[ \n]written[ \n]permission":
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
}
#: Pairs of a rule and a stricter one beyond the SQL's.
MORE_STRICTER = (("BSD-2-Clause", "BSD-4-Clause"), ("BSD-3-Clause", "BSD-4-Clause"))
ALL_SENTENCES = SENTENCES | MORE_SENTENCES
ALL_RULES = {name: RULES.get(name, ()) + MORE_RULES.get(name, ()) for name in RULES | MORE_RULES}
#: Each known sentence of the SQL holds one of these words.
CUES = "(?i)licen[sc]e|copyright|permission|permitted|redistribution|warranty"
#: A text with a known sentence holds one of these words.
ALL_CUES = CUES + "|spdx|public\\W+domain|redistribute|cc0|held\\W+liable|this\\W+software"
#: Any known sentence as whole lines, the longest first.
KNOWN = r"(?<=^|[\n|])(?:" + "|".join([*(k.replace("|", r"\|").replace(" ", r"[ \n]") for k in sorted(ALL_SENTENCES, key=lambda k: (-len(k), k))), *NAMED]) + r")(?=[\n|]|$)"


def marked(text: Column) -> Column:
    """Lower case, anything but letters and digits of ASCII as one space; a bar where a sentence ends or blank lines (or bare
    comment marks) stand, a line end elsewhere, but not before a line that goes on in lower case."""
    t = F.translate(F.coalesce(text, F.lit("")), "|", " ")
    t = F.regexp_replace(t, r"(?i)(spdx-license-identifier:[ \t]*[a-z0-9.+-]+)", "$1|")  # an identifier ends its line whatever follows
    t = F.regexp_replace(t, r"\n(?:[^A-Za-z0-9\n]*\n)+", "|")
    t = F.regexp_replace(t, r"[ \t]*\r?\n[ \t]*([a-z])", " $1")
    t = F.regexp_replace(t, r"[.!?;:](?:[ \t\r]+|(?=\n)|$)", "|")
    t = F.regexp_replace(F.lower(t), r"[^a-z0-9|\n]+", " ")
    return F.trim(F.regexp_replace(t, r" *([|\n]) *", "$1"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: its id, sentence_ids (those found, in order) and licenses (names of the rules that hold, sorted)."""
    known = F.create_map(*(F.lit(x) for pair in ALL_SENTENCES.items() for x in pair))
    found = F.regexp_extract_all(marked(F.col(text_col)), F.lit(KNOWN), F.lit(0))
    named = {k: F.lit(v) for k, v in NAMED.items()}

    def known_as(s: Column) -> Column:
        by_name = F.coalesce(*(F.when(s.rlike(f"^(?:{pattern})$"), of) for pattern, of in named.items()))
        return F.coalesce(F.try_element_at(known, F.translate(s, "\n", " ")), F.try_element_at(known, by_name))

    ids = F.transform(found, known_as)
    # a text without any cue needs no cutting at all
    ids = F.when(F.col(text_col).rlike(ALL_CUES), ids).otherwise(F.array().cast("array<string>"))
    found = docs.select(F.col(id_col), ids.alias("sentence_ids"))
    line = F.array_join("sentence_ids", " ")
    holds = {name: F.lit(False) for name in ALL_RULES}
    for name, ways in ALL_RULES.items():
        for way in ways:
            holds[name] = holds[name] | line.rlike(r"\b" + r"\b.*\b".join(way) + r"\b")
    strict = dict(holds)
    for name, stricter in (*STRICTER.items(), *MORE_STRICTER):
        strict[name] = strict[name] & ~holds[stricter]
    names = F.array_compact(F.array(*(F.when(strict[name], F.lit(name)) for name in sorted(ALL_RULES))))
    return found.select(id_col, "sentence_ids", names.alias("licenses"))


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in SENTENCES.items()) + "}"
    holds = {name: "(" + " OR ".join(f"regexp_matches(line, {quoted(chr(92) + 'b' + (chr(92) + 'b.*' + chr(92) + 'b').join(w) + chr(92) + 'b')})" for w in ways) + ")" for name, ways in RULES.items()}
    for name, stricter in STRICTER.items():
        holds[name] = f"({holds[name]} AND NOT {holds[stricter]})"
    names = ", ".join(f"CASE WHEN {holds[name]} THEN {quoted(name)} END" for name in sorted(RULES))
    return rf"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '[ \t]*\r?\n[ \t]*([a-z])', ' \1', 'g'), '([.!?;:])[ \t]+', '\1' || chr(10), 'g'), chr(10)) AS sentences FROM documents),
n AS (SELECT doc_id, list_filter(list_transform(list_filter(sentences, lambda x: regexp_matches(x, '{CUES}')),
  lambda x: {known}[trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))]), lambda x: x IS NOT NULL) AS ids FROM s),
l AS (SELECT doc_id, ids, array_to_string(ids, ' ') AS line FROM n)
SELECT doc_id, len(ids)::BIGINT AS n_sentences, coalesce(line, '') AS sentence_ids, array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ',') AS licenses FROM l
"""


ORACLE = _oracle()
