"""Sentence rules: order, gaps, precedence and odd rows."""

import textwrap

from tagweave.llm import licenses
from tests.llm.odd import odd_docs, odd_texts

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction"""


def scan(spark, text):
    return licenses.scan(odd_docs(spark, [(1, text)]), "doc_id", "text").first()


def test_full_notice_is_not_reported_as_reference(spark):
    named = {k: v for k, v in licenses.SENTENCES.items()}
    text = "Intro.\n" + ". Something between. ".join(named[k] for k in ("mit_grant", "mit_notice", "as_is")) + ".\nEnd"
    got = scan(spark, text)
    assert got.sentence_ids == ["mit_grant", "mit_notice", "as_is"] and got.licenses == ["mit"]


def test_order_matters_and_taken_sentences_leave_a_gap(spark):
    rules = [("x", ("b",)), ("y", ("a", "c")), ("z", ("c", "a"))]
    known = {"aaa": "a", "bbb": "b", "ccc": "c"}
    df = odd_docs(spark, [(1, "Aaa! Bbb? ccc."), (2, "ccc\naaa"), (3, "aaa. other. CCC. aaa"), (4, "aaa")])
    got = {r.doc_id: r.licenses for r in licenses.scan(df, "doc_id", "text", {v: k for k, v in known.items()}, rules).collect()}
    assert got == {1: ["x"], 2: ["z"], 3: ["y"], 4: []}


def test_versions_with_dots(spark):
    assert scan(spark, "Licensed under the Apache License, Version 2.0. More.").licenses == ["apache-2.0"]
    assert scan(spark, "x\nLicensed under CC BY-NC 4.0.\r\nReleased under the MIT License.").licenses == ["cc-by-nc-4.0", "mit"]


def test_odd_rows(spark):
    docs = odd_docs(spark, [*odd_texts(), (None, "All rights reserved."), (5, "a b c d e")])
    got = licenses.scan(docs, "doc_id", "text")
    assert got.count() == docs.count()
    assert [r.licenses for r in got.where("doc_id is null").collect()] == [["all-rights-reserved"]]
    assert [r.n_sentences for r in got.where("doc_id < 3").collect()] == [0, 0]
    assert licenses.scan(odd_docs(spark, []), "doc_id", "text").count() == 0


OFFICIAL_MIT = """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
OFFICIAL_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
OFFICIAL_BSD3 = OFFICIAL_BSD2 + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
OFFICIAL_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
OFFICIAL_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
OFFICIAL = [
    (OFFICIAL_MIT, ["mit_name", "mit_grant", "mit_notice", "as_is"], ["mit"]),
    (OFFICIAL_BSD2, ["bsd_grant", "bsd_source", "bsd_binary"], ["bsd-2-clause"]),
    (OFFICIAL_BSD3, ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"], ["bsd-3-clause"]),
    (OFFICIAL_GPL, ["gpl_free", "gpl_hope", "gpl_see"], ["gpl-3.0-or-later"]),
    (OFFICIAL_GPL.replace("version 3", "version 2"), ["gpl2_free", "gpl_hope", "gpl_see"], ["gpl-2.0-or-later"]),
    (OFFICIAL_APACHE, ["apache_grant", "apache_comply", "apache_copy", "apache_basis", "apache_see"], ["apache-2.0"]),
    ("                                 Apache License\n                           Version 2.0, January 2004\n", ["apache_name"], ["apache-2.0"]),
    ("MIT License", ["mit_name"], ["mit"]),
]


def test_official_texts_wrapped_and_commented(spark):
    def wrapped(text, width):
        return [line for part in text.split("\n") for line in (textwrap.wrap(part.strip(), width) or [""])]

    forms = [lambda t: t, lambda t: " ".join(t.split())]
    for mark in ("", "# ", " * ", "// ", "-- ", "; ", "! ", "% "):
        for width, end in ((72, "\n"), (40, "\r\n")):
            forms.append(lambda t, m=mark, w=width, e=end: e.join((m + line).rstrip() if m != "; " else m + line for line in wrapped(t, w)))
    rows = [(f"{i} {k}", form(text), ids, names) for i, (text, ids, names) in enumerate(OFFICIAL) for k, form in enumerate(forms) if k != 1 or i in (3, 4)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.scan(docs, "doc_id", "text").collect()}
    assert got == {key: (ids, names) for key, _, ids, names in rows}


def test_what_breaks_a_sentence(spark):
    known = {"x": "one two three", "y": "one two"}
    texts = ["one\ntwo\nthree", "one two\n\nthree", "one two. three", "one two.\nthree", "a; one two: three", "one\n#\ntwo", "so one two", "one two\nthree four", "one two; three. One two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.sentence_ids, r.n_sentences) for r in licenses.scan(docs, "doc_id", "text", known, [("l", ("x",))]).collect()}
    assert got == {0: (["x"], 3), 1: (["y"], 2), 2: (["y"], 2), 3: (["y"], 2), 4: (["x"], 1), 5: ([], 2), 6: ([], 1), 7: (["y"], 2), 8: (["x", "y"], 2)}
