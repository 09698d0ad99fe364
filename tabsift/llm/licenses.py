"""License scans: sentences become identifiers, and ordered rules over the identifiers name the license.

All work is done by DataFrame functions inside the row: a text is normalised once (letters and digits in lower case,
anything else one space), with a mark where a sentence or a heading ends, and cut into sentences that are looked up; the
identifiers in the order of the text form a line, in which the rules are found, longer ones first. The readings of a
text differ only in which marks and line feeds cut. Nothing is shuffled and nothing is broadcast but the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licenses and notices, normalised, by identifier.
SENTENCES = {
    "a01": "licensed under the apache license version 2 0",
    "a02": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
           "with the license",
    "a03": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "a04": "unless required by applicable law or agreed to in writing software distributed under the license is "
           "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "a05": "see the license for the specific language governing permissions and limitations under the license",
    "m01": "released under the mit license",
    "m02": "licensed under the mit license",
    "m03": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files the software to deal in the software without restriction including "
           "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
           "of the software and to permit persons to whom the software is furnished to do so subject to the "
           "following conditions",
    "m04": "the above copyright notice and this permission notice shall be included in all copies or substantial "
           "portions of the software",
    "m05": "the software is provided as is without warranty of any kind express or implied including but not limited "
           "to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "m06": "in no event shall the authors or copyright holders be liable for any claim damages or other liability "
           "whether in an action of contract tort or otherwise arising from out of or in connection with the "
           "software or the use or other dealings in the software",
    "b01": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met",
    "b02": "redistributions of source code must retain the above copyright notice this list of conditions and the "
           "following disclaimer",
    "b03": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
           "following disclaimer in the documentation and or other materials provided with the distribution",
    "b04": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
           "promote products derived from this software without specific prior written permission",
    "g01": "this work is licensed under the gnu general public license version 3",
    "g02": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation either version 3 of the license or at your "
           "option any later version",
    "g03": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation either version 2 of the license or at your "
           "option any later version",
    "g04": "this program is distributed in the hope that it will be useful but without any warranty without even the "
           "implied warranty of merchantability or fitness for a particular purpose",
    "g05": "see the gnu general public license for more details",
    "p01": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "p02": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "c01": "licensed under cc by nc 4 0",
    "c02": "licensed under cc by 4 0",
    "c03": "licensed under cc by sa 4 0",
    "c04": "this work is licensed under a creative commons attribution 4 0 international license",
    "c05": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "c06": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "c07": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights "
           "to this software to the public domain worldwide",
    "c08": "this software is distributed without any warranty",
    "e01": "this program and the accompanying materials are made available under the terms of the eclipse public license "
           "2 0 which is available at https www eclipse org legal epl 2 0",
    "e02": "this program and the accompanying materials are made available under the terms of the eclipse public license "
           "v 2 0 which is available at https www eclipse org legal epl 2 0",
    "g06": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
           "general public license as published by the free software foundation either version 3 of the license or at "
           "your option any later version",
    "g07": "see the gnu affero general public license for more details",
    "g08": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
           "general public license as published by the free software foundation either version 2 1 of the license or at "
           "your option any later version",
    "g09": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser "
           "general public license as published by the free software foundation either version 3 of the license or at "
           "your option any later version",
    "g10": "this library is distributed in the hope that it will be useful but without any warranty without even the "
           "implied warranty of merchantability or fitness for a particular purpose",
    "g11": "see the gnu lesser general public license for more details",
    "i01": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
           "granted provided that the above copyright notice and this permission notice appear in all copies",
    "i02": "the software is provided as is and the author disclaims all warranties with regard to this software including "
           "all implied warranties of merchantability and fitness",
    "l01": "distributed under the boost software license version 1 0",
    "z01": "this software is provided as is without any express or implied warranty",
    "z02": "in no event will the authors be held liable for any damages arising from the use of this software",
    "z03": "permission is granted to anyone to use this software for any purpose including commercial applications and to "
           "alter it and redistribute it freely subject to the following restrictions",
    "u01": "this is free and unencumbered software released into the public domain",
    "s00": "spdx license identifier",
    "s01": "mit",
    "s02": "apache 2 0",
    "s03": "gpl 3 0 only",
    "s04": "gpl 3 0 or later",
    "s05": "bsd 2 clause",
    "s06": "bsd 3 clause",
    "s07": "mpl 2 0",
    "s08": "isc",
    "s09": "zlib",
    "s10": "cc0 1 0",
    "s11": "epl 2 0",
    "s12": "bsl 1 0",
    "s13": "lgpl 2 1 or later",
    "s14": "lgpl 3 0 or later",
    "s15": "agpl 3 0 or later",
    "s16": "agpl 3 0 only",
    "s17": "gpl 2 0 only",
    "s18": "gpl 2 0 or later",
    "s19": "unlicense",
}
# Identifiers that, one after the other, mean a license.
RULES = {
    "a01": "Apache-2.0", "a02": "Apache-2.0", "a02 a03": "Apache-2.0", "a02 a03 a04 a05": "Apache-2.0",
    "m01": "MIT", "m02": "MIT", "m03": "MIT", "m03 m04 m05 m06": "MIT",
    "b01 b02 b03": "BSD-2-Clause", "b01 b02 b03 b04": "BSD-3-Clause",
    "g01": "GPL-3.0-only", "g02": "GPL-3.0-or-later", "g02 g04 g05": "GPL-3.0-or-later",
    "g03": "GPL-2.0-or-later", "g03 g04 g05": "GPL-2.0-or-later",
    "p01": "MPL-2.0", "p01 p02": "MPL-2.0",
    "c01": "CC-BY-NC-4.0", "c02": "CC-BY-4.0", "c03": "CC-BY-SA-4.0", "c04": "CC-BY-4.0", "c05": "CC-BY-SA-4.0",
    "c06": "CC-BY-NC-4.0", "u01": "Unlicense",
    "s00 s01": "MIT", "s00 s02": "Apache-2.0", "s00 s03": "GPL-3.0-only", "s00 s04": "GPL-3.0-or-later", "s00 s05": "BSD-2-Clause",
    "s00 s06": "BSD-3-Clause", "s00 s07": "MPL-2.0",
    "s00 s08": "ISC", "s00 s09": "Zlib", "s00 s10": "CC0-1.0", "s00 s11": "EPL-2.0", "s00 s12": "BSL-1.0",
    "s00 s13": "LGPL-2.1-or-later", "s00 s14": "LGPL-3.0-or-later", "s00 s15": "AGPL-3.0-or-later",
    "s00 s16": "AGPL-3.0-only", "s00 s17": "GPL-2.0-only", "s00 s18": "GPL-2.0-or-later", "s00 s19": "Unlicense",
    "c07": "CC0-1.0", "c07 c08": "CC0-1.0", "e01": "EPL-2.0", "e02": "EPL-2.0",
    "g06": "AGPL-3.0-or-later", "g06 g04 g07": "AGPL-3.0-or-later",
    "g08": "LGPL-2.1-or-later", "g08 g10 g11": "LGPL-2.1-or-later",
    "g09": "LGPL-3.0-or-later", "g09 g04 g11": "LGPL-3.0-or-later",
    "i01": "ISC", "i01 i02": "ISC", "l01": "BSL-1.0", "z01 z02 z03": "Zlib", "z03": "Zlib",
}
#: The end of a sentence with the white space after it; without lookbehind, so that any engine reads it alike.
SENTENCE_END = r"([.!?:])[\t-\r ]+"
#: A line that is a heading, a copyright line or "all rights reserved". It is tried at the beginnings of lines only, and no
#: run of characters is ever given back but after "copyright" and in a name of three words, so its time is linear.
HEADING = (
    r"(?imd)^([^A-Za-z0-9\n©]*+(?:©[^\n]*+|(?<=\()c\)[^\n]*+|copyright[^A-Za-z0-9\n©<\[]*+(?:[©<\[][^\n]*+|(?<=\()c\)[^\n]*+|[0-9]{4}[^\n]*+)"
    r"|all rights reserved[^A-Za-z0-9\n]*+|(?:[A-Za-z0-9.-]++ ){1,3}license(?: \([A-Za-z0-9 .-]++\))?[^A-Za-z0-9\n]*+))\n"
)
#: What stands at the beginning of a part: after the end of a sentence, after a heading.
ENDED, HEADED = "\x01", "\x02"
#: In the paragraph reading a part ends there and at lines without letters or digits.
PARAGRAPH_END = "\n[\x01\x02]+|\n ?(?=\n)"


def _literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def rule_pattern(rules: dict[str, str]) -> str:
    """The rules as one pattern over a line like ``a02 a03 ``, longer rules first."""
    return "|".join(f"{r} " for r in sorted(rules, key=lambda r: (-len(r), r)))


def scan_licenses(
    docs: DataFrame, *, text: str = "text", sentences: dict[str, str] = SENTENCES, rules: dict[str, str] = RULES
) -> DataFrame:
    """The columns of ``docs`` but ``text``, with sentence_ids, rules and licenses, each an array of strings.

    A line feed may end a sentence or wrap it, so texts are read both ways, and a third time with lines joined only
    within a paragraph and below headings; there a known sentence may also run over three parts, as where its usual
    wording has a colon, "v. 2.0" or a paragraph of its own for an address. sentence_ids are those of the lines, then
    those found only in the other readings. Unknown sentences are skipped: a rule needs its identifiers next to
    each other among the known ones. rules are the rules found, licenses their names, each once and sorted. A carriage
    return ends a line as a line feed does. Null and empty texts have none. Repeated rows stay, an empty table stays
    empty; columns of these names give way.
    """
    known = _literal_map({sentence: key for key, sentence in sentences.items()})
    names = _literal_map({f"{rule} ": name for rule, name in rules.items()})
    pattern = rule_pattern(rules)
    words = [sentence.split(" ") for sentence in sentences.values()]
    begun = sorted({" ".join(w[:n]) for w in words for n in range(1, len(w))})
    is_known = lambda s: s.isin(list(sentences.values()))

    def marked(raw: Column) -> Column:
        # The marks are put first: where a text has them itself, they are characters like others.
        for old, new in ((ENDED, "_"), (HEADED, "_"), ("\r\n", "\n"), ("\r", "\n")):
            raw = F.replace(raw, F.lit(old), F.lit(new))
        headed = F.when(F.instr(raw, "\n") > 0, F.regexp_replace(raw, HEADING, f"$1\n{HEADED}")).otherwise(raw)
        ended = F.regexp_replace(headed, SENTENCE_END, f"$1\n{ENDED}")
        return F.lower(F.regexp_replace(ended, f"[^A-Za-z0-9\n{ENDED}{HEADED}]+", " "))

    def parts_of(joined: Column, end: str) -> Column:
        return F.transform(F.split(joined, end, -1), lambda s: F.btrim(s, F.lit(f" {ENDED}{HEADED}")))

    def rejoined(plain: Column, end: str) -> Column:
        # What cuts becomes a line feed; the other ends of lines and marks become spaces.
        cut = F.regexp_replace(plain, end, ENDED)
        return parts_of(F.regexp_replace(cut, f"[ \n{HEADED}]+", " "), ENDED)

    def identifiers(plain: Column) -> Column:
        return F.transform(F.filter(plain, is_known), lambda s: F.element_at(known, s))

    def run_identifiers(plain: Column) -> Column:
        # A sentence that is not known alone may be the first of two or three parts of one that is.
        def found_at(s: Column, i: Column) -> Column:
            runs = (F.element_at(known, F.array_join(F.slice(plain, i + 1, F.lit(n)), " ")) for n in (2, 3))
            return F.when(is_known(s), F.element_at(known, s)).when(s.isin(begun), F.coalesce(*runs))

        return F.filter(F.transform(plain, found_at), lambda k: k.isNotNull())

    def matched(keys: Column) -> Column:
        return F.regexp_extract_all(F.concat(F.array_join(keys, " "), F.lit(" ")), F.lit(pattern), F.lit(0))

    kept = [c for c in docs.columns if c not in (text, "sentence_ids", "rules", "licenses")]
    read = docs.select(*kept, marked(F.coalesce(F.col(text), F.lit(""))).alias("marked__"))
    # Where every line feed is the end of a sentence, the readings have the same parts.
    wrapped = F.col("marked__").rlike(f"\n(?!{ENDED})")
    read = read.select(*kept, "marked__", wrapped.alias("wrapped__"), parts_of(F.col("marked__"), "\n").alias("lines__"))
    other = lambda end: F.when(F.col("wrapped__"), rejoined(F.col("marked__"), end)).otherwise(F.col("lines__"))
    read = read.select(*kept, "lines__", "wrapped__", other(f"\n{ENDED}").alias("joined__"), F.filter(other(PARAGRAPH_END), lambda s: s != "").alias("parts__"))
    found = read.select(
        *kept, identifiers(F.col("lines__")).alias("lines__"), identifiers(F.col("joined__")).alias("joined__"),
        run_identifiers(F.col("parts__")).alias("runs__"))
    found = found.select(*kept, "lines__", "joined__", "runs__", F.array_distinct(F.concat(
        matched(F.col("lines__")), matched(F.col("joined__")), matched(F.col("runs__")))).alias("found__"))
    return found.select(
        *kept, F.array_union(F.array_union("lines__", "joined__"), F.col("runs__")).alias("sentence_ids"),
        F.transform("found__", lambda r: F.trim(r)).alias("rules"),
        F.array_sort(F.array_distinct(F.transform("found__", lambda r: F.element_at(names, r)))).alias("licenses"),
    )


def sentence_table(sentences: DataFrame, rules: DataFrame, most: int = 20_000) -> tuple[dict[str, str], dict[str, str]]:
    """``sentences`` (id, sentence) and ``rules`` (rule, license) as the tables of ``scan_licenses``.

    A sentence is normalised here; ids are letters and digits. Tables above ``most`` rows are refused: they travel with the plan.
    """
    plain = F.btrim(F.lower(F.regexp_replace("sentence", "[^A-Za-z0-9]+", " ")))
    read = [df.limit(most + 1).collect() for df in (sentences.select("id", plain), rules.select("rule", "license"))]
    if any(len(rows) > most for rows in read):
        raise ValueError(f"a table of more than {most} rows can't travel with the plan")
    return tuple(dict(map(tuple, rows)) for rows in read)


def oracle(sentences: dict[str, str] = SENTENCES, rules: dict[str, str] = RULES) -> str:
    """The scan of ``documents`` in DuckDB's SQL, its arrays joined to text."""

    def table(entries: dict[str, str]) -> str:
        quoted = ["[" + ", ".join(f"'{x}'" for x in column) + "]" for column in (entries, entries.values())]
        return f"map({quoted[0]}, {quoted[1]})"

    known = table({sentence: key for key, sentence in sentences.items()})
    names = table({f"{rule} ": name for rule, name in rules.items()})

    def sentences_of(source: str) -> str:
        return (
            f"list_transform(string_split(regexp_replace({source}, '{SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10)), "
            "lambda s: trim(lower(regexp_replace(s, '[^A-Za-z0-9]+', ' ', 'g'))))"
        )

    def identifiers(source: str) -> str:
        return f"list_filter(list_transform({sentences_of(source)}, lambda s: k[s]), lambda x: x is not null)"

    heading = (
        r"(?im)^([^A-Za-z0-9\n]*(?:copyright[^A-Za-z0-9\n]*(?:\(c\)|©|[0-9]{4}|[<\[])[^\n]*|\(c\)[^\n]*|©[^\n]*"
        r"|all rights reserved|(?:[A-Za-z0-9.-]+ ){1,3}license(?: \([A-Za-z0-9 .-]+\))?)[^A-Za-z0-9\n]*)\n"
    )
    ended = f"regexp_replace(regexp_replace(text, '{heading}', '\\1. ', 'g'), '\\n[^A-Za-z0-9\\n]*\\n', '. ', 'g')"
    paragraphs = f"list_filter({sentences_of(f"translate({ended}, chr(10), ' ')")}, lambda s: s <> '')"
    runs = (
        "list_filter(list_transform(parts, lambda s, i: coalesce(k[s], k[s || ' ' || parts[i + 1]], "
        "k[s || ' ' || parts[i + 1] || ' ' || parts[i + 2]])), lambda x: x is not null)"
    )

    def matched(keys: str) -> str:
        return f"regexp_extract_all(coalesce(array_to_string({keys}, ' '), '') || ' ', '{rule_pattern(rules)}')"

    return f"""
with given as (
    select doc_id, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') as text, {known} as k, {names} as n from documents
), cut as (
    select doc_id, n, k, {identifiers("text")} as lines, {identifiers("translate(text, chr(10), ' ')")} as joined,
        {paragraphs} as parts
    from given
), read as (
    select doc_id, n, lines, joined, {runs} as runs from cut
), found as (
    select doc_id, n, lines, joined, runs, {matched("lines")} || {matched("joined")} || {matched("runs")} as found from read
)
select doc_id,
    coalesce(array_to_string(list_sort(list_distinct(lines || joined || runs)), ' '), '') as sentence_ids,
    coalesce(array_to_string(list_sort(list_distinct(list_transform(found, lambda r: n[r]))), ' '), '') as licenses
from found
"""
