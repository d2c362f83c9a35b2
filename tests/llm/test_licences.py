import re

import pytest

from adjudika.llm import licences as L
from adjudika.llm.queries import QUERIES

MIT = """/*
 * Copyright (c) 2019 Jane Doe
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in
 * all copies or substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
 * IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
 * FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
 * AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
 * LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
 * OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
 * SOFTWARE.
 */"""
CASES = [
    ("Some words. Licensed under the Apache License, Version 2.0. More words", ["Apache-2.0"], []),
    ("words\nReleased under the MIT License.\nwords", ["MIT"], []),
    ("Released under the MIT Licence", ["MIT"], []),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"], []),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"], []),
    ("Licensed under CC BY-SA 3.0. Licensed under CC BY 4.0.", ["CC-BY-4.0", "CC-BY-SA-3.0"], []),
    ("# SPDX-License-Identifier: BSD-3-Clause\nimport x", ["BSD-3-Clause"], []),
    ("Copyright 2020 X. All rights reserved.", ["proprietary"], []),
    (MIT, ["MIT"], []),
    (MIT.replace("The above", "Nothing above"), [], ["mit_grant", "as_is", "no_liability"]),
    ("This License is not known. Permission is a word.", [], []),
    ("The release of the license under the MIT law was a long story.", [], []),
    ("", [], []), (None, [], []), ("license " * 20_000, [], []),
]


@pytest.mark.parametrize("text,names,rest", [c for c in CASES if c[0]])
def test_cases(text, names, rest):
    assert L.match(L.identifiers(text)) == (names, rest)


def test_table_of_sentences():
    for name, texts in L.SENTENCES.items():
        for text in texts:
            assert L.normalise(text) == text and re.search(L.TRIGGER, text), text
            assert L.identify(text) == name
    used = {x for _, rule in L.RULES for x in rule}
    assert used <= set(L.SENTENCES)


def test_longer_rules_come_first():
    for i, (_, a) in enumerate(L.RULES):
        for _, b in L.RULES[:i]:
            assert not any(a[k:k + len(b)] == b for k in range(len(a) - len(b) + 1)), (a, b)


def test_scan(spark, docs_of):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + [(None, CASES[0][0]), (1, CASES[1][0]), (1, CASES[1][0])]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.licences, r.unmatched) for r in L.scan(docs_of(rows)).collect())
    want = [(i, c[1], c[2]) for i, c in enumerate(CASES)] + [(-1, CASES[0][1], []), (1, CASES[1][1], []), (1, CASES[1][1], [])]
    assert got == sorted(want)
    assert L.scan(docs_of(rows).limit(0)).count() == 0


def test_prefilter_loses_nothing(spark, docs_of):
    known = [t for texts in L.SENTENCES.values() for t in texts] + ["released under cc by 4.0", "released under creative commons zero"]
    between = [" ", "\n", "  ", "-", "\n * ", "\r\n# ", "_", "\u00a0", " -- "]
    texts = [t.upper().replace(" ", gap) if k % 2 else t.replace(" ", gap) for k, gap in enumerate(between) for t in known]
    texts += ["This work is in the public\ndomain.", "All rights\nreserved.", "Released into the Public  Domain.", "Released into the public-domain.",
              "# All rights\n# reserved.", "// This work is in the public\n// domain.", "Released under CC BY 4.0."]
    want = {i: L.match(L.identifiers(t)) for i, t in enumerate(texts)}
    assert all(want[i][0] for i in range(len(texts) - 7, len(texts)))
    got = {r.doc_id: (r.licences, r.unmatched) for r in L.scan(docs_of(list(enumerate(texts)))).collect()}
    assert {texts[i]: x for i, x in got.items() if x != want[i]} == {}


def test_query_on_the_small_table(spark):
    path = "/root/testdata/sf0.1"
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved.": "proprietary"}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = {r.doc_id: r.licences for r in QUERIES["op1_licence_scan"](spark, path).collect()}
    assert got == {i: sorted({name for line, name in lines.items() if line in t.split("\n")}) for i, t in texts.items()}
    assert {x for names in got.values() for x in names} == set(lines.values())


GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
         "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
         "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
         "following conditions:")
CONDITION = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
         "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")


def test_a_changed_licence_is_seen():
    whole = f"The MIT License (MIT)\nCopyright (c) 2024 X\n\n{GRANT}\n\n{CONDITION}\n\n{AS_IS}"
    assert L.match(L.identifiers(whole)) == (["MIT"], [])
    more = whole.replace(CONDITION, CONDITION + " The Software shall not be used for military purposes or sold.")
    assert L.match(L.identifiers(more)) == ([], ["mit_grant", "mit_condition", "as_is"])
    less = whole.replace(CONDITION, "")
    assert L.match(L.identifiers(less)) == ([], ["mit_grant", "as_is"])
    around = "Some prose first. " + whole + " And more of it afterwards.\nReleased under the MIT License."
    assert L.match(L.identifiers(around)) == (["MIT"], [])
    assert L.match(L.identifiers("1. You may not use this file except in compliance with the License.")) == ([], ["apache2_limits"])


def test_one_name_a_licence():
    named = lambda text: L.match(L.identifiers(text))[0]
    assert named("// SPDX-License-Identifier: MIT") == ["MIT"]
    assert named("# SPDX-License-Identifier: MIT OR Apache-2.0") == ["Apache-2.0", "MIT"]
    assert named("SPDX-License-Identifier: GPL-2.0-or-later AND BSD-3-Clause") == ["BSD-3-Clause", "GPL-2.0-or-later"]
    assert named("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0") == ["GPL-2.0"]
    assert named("SPDX-License-Identifier: GPL-3.0+") == ["GPL-3.0-or-later"]
    assert named("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.") == ["LGPL-2.1-or-later"]


def plain_scan(text):
    """Notices of one line and SPDX tags, found by plain string search on lines: nothing of the module is used."""
    found = set()
    notices = {"MIT": ["mit license"], "Apache-2.0": ["apache license, version 2.0", "apache license version 2.0"],
               "BSD-3-Clause": ["bsd 3-clause license"], "BSD-2-Clause": ["bsd 2-clause license"]}
    for line in (text or "").lower().replace("licence", "license").split("\n"):
        line = line.strip().rstrip(".").strip()
        for name, ends in notices.items():
            if any(line == f"{verb} under the {end}" for verb in ("licensed", "released") for end in ends):
                found.add(name)
        if line.startswith("spdx-license-identifier: mit"):
            found.add("MIT")
    return found


def test_against_plain_search_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: set(r.licences) for r in L.scan(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts) and sum(bool(plain_scan(t)) for t in texts.values()) > 10
    for i, text in texts.items():
        assert plain_scan(text) <= got[i], i
        # What the scan finds beyond whole lines still has to be named in the text.
        words = {"MIT": "mit", "Apache": "apache", "BSD": "bsd", "GPL": "gnu", "LGPL": "gnu", "AGPL": "gnu", "CC": "cc", "proprietary": "rights",
                 "public": "domain", "MPL": "mozilla"}
        assert all(words[n.split("-")[0]] in text.lower() for n in got[i]), (i, got[i])
