"""Licence scan by sentence rules, with built-in functions alone.

Sentences are normalised and mapped to identifiers of known licence sentences, which line ends may
wrap; the sequence of identifiers of a text is matched against ordered rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier and normalised form of known licence sentences.
SENTENCES: dict[str, str] = {
    "apache_ref": "licensed under the apache license version 2 0",
    "apache_grant": "licensed under the apache license version 2 0 the license",
    "apache_comply": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_ref": "released under the mit license",
    "mit_name": "the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as_is": "the software is provided as is without warranty of any kind express or implied",
    "gpl3_ref": "this work is licensed under the gnu general public license version 3",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc_by_nc_ref": "licensed under cc by nc 4 0",
    "cc_by_ref": "licensed under cc by 4 0",
    "cc_by_sa_ref": "licensed under cc by sa 4 0",
    "all_rights": "all rights reserved",
}

# Licence and the identifiers it asks for, in order; earlier rules go first and
# take their sentences, so a full notice is not reported again as a reference.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("apache-2.0", ("apache_grant", "apache_comply", "apache_copy", "apache_basis", "apache_see")),
    ("mit", ("mit_grant", "mit_notice", "as_is")),
    ("bsd-3-clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("bsd-2-clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("gpl-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_see")),
    ("apache-2.0", ("apache_grant", "apache_comply")),
    ("apache-2.0", ("apache_ref",)),
    ("apache-2.0", ("apache_grant",)),
    ("mit", ("mit_ref",)),
    ("mit", ("mit_name",)),
    ("mit", ("mit_grant",)),
    ("gpl-3.0", ("gpl3_ref",)),
    ("cc-by-nc-4.0", ("cc_by_nc_ref",)),
    ("cc-by-sa-4.0", ("cc_by_sa_ref",)),
    ("cc-by-4.0", ("cc_by_ref",)),
    ("all-rights-reserved", ("all_rights",)),
]

# Further wordings of sentences, and what only whole licence texts hold; they apply
# where the lists above are not replaced.
WORDINGS: list[tuple[str, str]] = [
    ("mit_name", "mit license"),
    ("mit_name", "the mit license mit"),
    ("mit_grant", SENTENCES["mit_grant"] + " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit_notice", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"),
    ("as_is", SENTENCES["as_is"] + " including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("gpl_free", SENTENCES["gpl_free"] + " either version 3 of the license or at your option any later version"),
    ("gpl2_free", SENTENCES["gpl_free"] + " either version 2 of the license or at your option any later version"),
    ("gpl3_only", SENTENCES["gpl_free"] + " version 3"),
    ("gpl3_only", SENTENCES["gpl_free"] + " version 3 of the license"),
    ("gpl3_name", "gnu general public license version 3"),
    ("gpl3_name", "gnu general public license version 3 29 june 2007"),
    ("gpl2_name", "gnu general public license version 2 june 1991"),
    ("bsd3_name", "bsd 3 clause license"),
    ("bsd3_name", "the 3 clause bsd license"),
    ("bsd2_name", "bsd 2 clause license"),
    ("bsd2_name", "the 2 clause bsd license"),
    ("apache_name", "apache license version 2 0"),
    ("apache_name", "apache license version 2 0 january 2004"),
    ("apache_copy", "you may obtain a copy of the license at"),
    ("apache_copy", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
]
WORDING_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("gpl-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_see")),
    ("gpl-3.0", ("gpl3_only", "gpl_hope", "gpl_see")),
    ("gpl-3.0", ("gpl3_name",)),
    ("gpl-2.0", ("gpl2_name",)),
    ("bsd-3-clause", ("bsd3_name",)),
    ("bsd-2-clause", ("bsd2_name",)),
    ("apache-2.0", ("apache_name",)),
]

# A sentence ends at a line end, or at . ! ? before white space; these are what Java and RE2 agree on.
# A known one may run over line ends, but not over . ! ? or a blank line, which leave two line ends,
# and may begin or end at ; or : as well. A ! that begins a line is a comment mark.
_REMARK = r"(^|\n)[ \t]*!+[ \t]"
_END = r"([.!?])(?:[ \t\r\f]+|(?=\n))"
_PAUSE = r"([;:])[ \t\r\f]+"
_OTHER = "[^0-9A-Za-z\u0080-\U0010ffff\n\x01]+"
_BETWEEN = r"(?:\x01?\n\x01?|[ \x01])"


def normalised(text: Column) -> Column:
    """Lower case (A-Z), runs of other ASCII characters as one space, a line end around each line.

    A sentence end is two line ends, and U+0001 stands for ``;`` or ``:`` before white space.
    """
    text = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "\x01", " "), _REMARK, "$1")
    marked = F.regexp_replace(F.regexp_replace(text, _END, "$1\n\n"), _PAUSE, "$1\x01")
    lines = F.regexp_replace(F.lower(F.regexp_replace(marked, _OTHER, " ")), " ?([\n\x01]) ?", "$1")
    return F.concat(F.lit("\n"), F.trim(lines), F.lit("\n"))


def known_sentences(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the sentences ``known``, by normal form, in a normalised text."""
    longest = sorted(known, key=lambda s: -len(s))
    pattern = "[\n\x01](" + "|".join(_BETWEEN.join(s.split(" ")) for s in longest) + ")(?=[\n\x01])"
    ids = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda s: F.element_at(ids, F.regexp_replace(s, "[ \n\x01]+", " ")))


def scan(
    df: DataFrame,
    id_col: str,
    text_col: str,
    sentences: dict[str, str] | None = None,
    rules: list[tuple[str, tuple[str, ...]]] | None = None,
) -> DataFrame:
    """``(id_col, n_sentences, sentence_ids, licenses)`` for each row of ``df``.

    ``sentence_ids`` are the known sentences in order of the text; unknown sentences between
    them are skipped. A known sentence is found whether or not it is wrapped or commented, while
    ``n_sentences`` counts each line with a word as one sentence at least. ``licenses`` are the licences of the rules that match, sorted. A null or
    empty text has none; repeated rows and null ids are kept; other columns are dropped. A row
    is handled on its own, so nothing is shuffled.
    """
    wordings = WORDINGS if sentences is None else []
    known = {s: name for name, s in [*(sentences or SENTENCES).items(), *wordings]}
    rules = [*RULES, *WORDING_RULES] if rules is None else rules
    rows = df.select(F.col(id_col).alias("_id"), normalised(F.col(text_col).cast("string")).alias("_lines"))
    n = F.regexp_count("_lines", F.lit("[^ \n\x01][^\n]*")).cast("long")
    rows = rows.select("_id", known_sentences(F.col("_lines"), known).alias("sentence_ids"), n.alias("n_sentences"))

    # Each identifier stands between commas of its own, so that a match never shares one.
    rest = F.concat(F.lit(","), F.array_join("sentence_ids", ",,"), F.lit(","))
    found = []
    rows = rows.withColumn("_rest", rest)
    for i, (name, wanted) in enumerate(rules):
        needle = F.lit("," + ",,".join(wanted) + ",")
        rows = rows.withColumn(f"_hit{i}", F.when(F.contains("_rest", needle), F.lit(name)))
        # What is taken leaves a gap, so that its neighbours do not become a sequence.
        rows = rows.withColumn("_rest", F.replace("_rest", needle, F.lit(",-,")))
        found.append(F.col(f"_hit{i}"))
    licenses = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    return rows.select(F.col("_id").alias(id_col), "n_sentences", "sentence_ids", licenses.alias("licenses"))
