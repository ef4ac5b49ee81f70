"""Licence scans by sentence rules.

A text is cut into pieces at line ends and after marks followed by a blank, and normalised. A run of neighbouring pieces that
reads as a known licence sentence becomes its identifier, the longest run first, so wrapped lines, comment marks and the
colons and semicolons inside a sentence do not matter; a blank line ends a run. A licence rule is an ordered list of
identifiers; it matches where the identifiers of a text, in order and without the unknown sentences between them, hold that
list in one piece. A rule inside a longer rule that also matches is not reported.

Defined cases: null and empty texts have no sentences; repeated sentences repeat their identifier; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Public licence sentences in normal form (lower-case words with one space between), by identifier.
SENTENCES = {
    "mit-short": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "mit license", "the mit license mit", "spdx license identifier mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "no-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "apache-short": ["licensed under the apache license version 2 0", "released under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "apache license version 2 0", "spdx license identifier apache 2 0"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at"],
    "apache-disclaimer": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl3-short": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3", "gnu general public license version 3", "spdx license identifier gpl 3 0", "spdx license identifier gpl 3 0 only", "spdx license identifier gpl 3 0 or later"],
    "gpl2-short": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "released under the gnu general public license version 2", "gnu general public license version 2", "spdx license identifier gpl 2 0", "spdx license identifier gpl 2 0 only", "spdx license identifier gpl 2 0 or later"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-see": ["see the gnu general public license for more details"],
    "gpl-copy": ["you should have received a copy of the gnu general public license along with this program"],
    "lgpl-short": ["licensed under the gnu lesser general public license version 3", "this work is licensed under the gnu lesser general public license version 3", "spdx license identifier lgpl 3 0"],
    "agpl-short": ["licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3", "spdx license identifier agpl 3 0"],
    "bsd-redistribute": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd3-short": ["licensed under the bsd 3 clause license", "released under the bsd 3 clause license", "spdx license identifier bsd 3 clause"],
    "bsd2-short": ["licensed under the bsd 2 clause license", "released under the bsd 2 clause license", "spdx license identifier bsd 2 clause"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "mpl2-short": ["licensed under the mozilla public license version 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0", "spdx license identifier mpl 2 0"],
    "mpl2-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "spdx license identifier cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "spdx license identifier cc by sa 4 0"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license", "spdx license identifier cc by 4 0"],
    "cc0": ["licensed under cc0 1 0", "released under cc0 1 0", "this work is dedicated to the public domain", "spdx license identifier cc0 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "spdx license identifier unlicense"],
    "reserved": ["all rights reserved"],
}

# Rule, licence, ordered sentence identifiers.
RULES = [
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "as-is", "no-liability"]),
    ("mit-head", "MIT", ["mit-grant", "mit-notice"]),
    ("mit-short", "MIT", ["mit-short"]),
    ("apache-header", "Apache-2.0", ["apache-short", "apache-comply", "apache-copy", "apache-disclaimer", "apache-see"]),
    ("apache-head", "Apache-2.0", ["apache-short", "apache-comply"]),
    ("apache-short", "Apache-2.0", ["apache-short"]),
    ("gpl3-notice", "GPL-3.0", ["gpl-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("gpl3-head", "GPL-3.0", ["gpl-free", "gpl-hope"]),
    ("gpl3-short", "GPL-3.0", ["gpl3-short"]),
    ("gpl2-notice", "GPL-2.0", ["gpl2-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("gpl2-head", "GPL-2.0", ["gpl2-free", "gpl-hope"]),
    ("gpl2-short", "GPL-2.0", ["gpl2-short"]),
    ("lgpl-short", "LGPL-3.0", ["lgpl-short"]),
    ("agpl-short", "AGPL-3.0", ["agpl-short"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("bsd3-short", "BSD-3-Clause", ["bsd3-short"]),
    ("bsd2-short", "BSD-2-Clause", ["bsd2-short"]),
    ("isc-text", "ISC", ["isc-grant"]),
    ("mpl2-notice", "MPL-2.0", ["mpl2-short", "mpl2-copy"]),
    ("mpl2-short", "MPL-2.0", ["mpl2-short"]),
    ("cc-by-nc", "CC-BY-NC-4.0", ["cc-by-nc"]),
    ("cc-by-sa", "CC-BY-SA-4.0", ["cc-by-sa"]),
    ("cc-by", "CC-BY-4.0", ["cc-by"]),
    ("cc0", "CC0-1.0", ["cc0"]),
    ("unlicense", "Unlicense", ["unlicense"]),
    ("reserved", "Proprietary", ["reserved"]),
]

# Every known sentence holds one of these words.
HINTS = "licen|copyright|warrant|redistrib|reserved|domain|mpl|permission|liab|cc0"
BLANK = "[\\x20\\x09\\x0B-\\x0D]"
# What becomes what, in this order, on the way from a lower-case text to its pieces, one on a line.
PIECES = [
    (f"(?<!{BLANK}){BLANK}++\n", "\n"),
    ("(^|\n)([^a-z0-9\n]*+[a-z0-9]{1,3}[.)])[\\x20\\x09]+", "$1$2\n"),  # list marks
    (f"([.!?;:]){BLANK}++(?!\n)", "$1\n"),
    ("https://", "http://"),
    ("[^a-z0-9\n]+", " "),
    (" ?\n ?", "\n"),
]


def known() -> dict[str, str]:
    return {s: i for i, group in SENTENCES.items() for s in group}


def pieces(text: Column) -> Column:
    """The normalised pieces of a text, each between two newlines; a blank line is an empty piece."""
    out = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = F.concat(F.lit("\n"), out, F.lit("\n"))
    for pattern, by in PIECES:
        out = F.regexp_replace(out, pattern, by)
    return out


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    Texts that hold no hint are passed over before any cutting, as no known sentence is without one.
    """
    table = F.create_map(*[F.lit(x) for pair in known().items() for x in pair])
    any_of = "|".join(s.replace(" ", "[ \n]") for s in sorted(known(), key=len, reverse=True))
    found = F.regexp_extract_all(pieces(text), F.lit(f"(?<=\n)(?:{any_of})(?=\n)"), F.lit(0))
    ids = F.transform(found, lambda x: F.element_at(table, F.translate(x, "\n", " ")))
    return F.when(F.lower(text).rlike(HINTS), ids).otherwise(F.array().cast("array<string>"))


def matched_rules(ids: Column) -> Column:
    """Names of the rules that match and are not part of a longer one that does."""
    line = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    held = [" " + " ".join(ids_) + " " for _, _, ids_ in RULES]
    hits = []
    for (name, _, _), own in zip(RULES, held):
        hit = F.contains(line, F.lit(own))
        for longer in held:
            if own != longer and own in longer:
                hit &= ~F.contains(line, F.lit(longer))
        hits.append(F.when(hit, F.lit(name)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the identifiers found, the rules matched, and the licences of those rules in order of rules."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), sentence_ids(F.col(f"`{text_col}`").cast("string")).alias("sentence_ids"))
    rows = rows.withColumn("rules", F.when(F.size("sentence_ids") > 0, matched_rules(F.col("sentence_ids"))).otherwise(F.array().cast("array<string>")))
    licence = F.create_map(*[F.lit(x) for name, spdx, _ in RULES for x in (name, spdx)])
    return rows.withColumn("licences", F.array_distinct(F.transform("rules", lambda r: F.element_at(licence, r))))
