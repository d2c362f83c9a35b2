"""Licence scan by sentence rules.

A text is cut into sentences, these are normalised and mapped to the identifiers of known licence sentences, and the document's sequence
of identifiers is matched against an ordered list of licence rules. Unknown sentences between two known ones leave a mark in the sequence, which
breaks a rule in two; only list numbers, titles and copyright lines do not. A rule that matches takes its identifiers out of the sequence.
Identifiers that no rule takes are reported, so a licence with a sentence more, less or changed is seen rather than guessed. An SPDX
expression names each of its licences, by the same name as the rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adjudika.llm.textarrays import slices

# Sentences of public licences and notices, normalised as `normalise` does, by identifier.
SENTENCES = {
    "mit_notice": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license",
                   "distributed under the mit license", "this software is released under the mit license", "mit license",
                   "this code is licensed under the mit license", "available under the mit license"],
    "mit_grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
                  "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
                  "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
                  "furnished to do so subject to the following conditions"],
    "mit_condition": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
                      "software"],
    "as_is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
              "merchantability fitness for a particular purpose and noninfringement"],
    "no_liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
                     "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
                     "dealings in the software"],
    "isc_grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                  "provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd_grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following "
                  "conditions are met"],
    "bsd_source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following "
                   "disclaimer"],
    "bsd_binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
                   "disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd_endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                    "derived from this software without specific prior written permission"],
    "bsd_warranty": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties "
                     "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
                     "disclaimed"],
    "bsd_no_liability": ["in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
                         "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss "
                         "of use data or profits or business interruption however caused and on any theory of liability whether in contract "
                         "strict liability or tort including negligence or otherwise arising in any way out of the use of this software even "
                         "if advised of the possibility of such damage"],
    "bsd2_notice": ["licensed under the bsd 2 clause license", "released under the bsd 2 clause license"],
    "bsd3_notice": ["licensed under the bsd 3 clause license", "released under the bsd 3 clause license"],
    "apache2_notice": ["licensed under the apache license version 2.0", "released under the apache license version 2.0",
                       "this work is licensed under the apache license version 2.0", "licensed under the apache license version 2.0 the license"],
    "apache2_limits": ["you may not use this file except in compliance with the license"],
    "apache2_copy": ["you may obtain a copy of the license at"],
    "apache2_warranty": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
                         "as is basis without warranties or conditions of any kind either express or implied"],
    "apache2_see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl2_notice": ["this work is licensed under the gnu general public license version 2",
                    "licensed under the gnu general public license version 2"],
    "gpl3_notice": ["this work is licensed under the gnu general public license version 3",
                    "licensed under the gnu general public license version 3"],
    "lgpl3_notice": ["this work is licensed under the gnu lesser general public license version 3",
                     "licensed under the gnu lesser general public license version 3"],
    "agpl3_notice": ["this work is licensed under the gnu affero general public license version 3",
                     "licensed under the gnu affero general public license version 3"],
    "gpl_free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                 "published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2_free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                  "published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl_warranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied "
                     "warranty of merchantability or fitness for a particular purpose"],
    "gpl_see": ["see the gnu general public license for more details"],
    "gpl_copy": ["you should have received a copy of the gnu general public license along with this program"],
    "lgpl21_free": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
                    "license as published by the free software foundation either version 2.1 of the license or at your option any later version"],
    "lgpl_warranty": ["this library is distributed in the hope that it will be useful but without any warranty without even the implied "
                      "warranty of merchantability or fitness for a particular purpose"],
    "lgpl_see": ["see the gnu lesser general public license for more details"],
    "lgpl_copy": ["you should have received a copy of the gnu lesser general public license along with this library"],
    "mpl2_notice": ["this source code form is subject to the terms of the mozilla public license v 2.0",
                    "licensed under the mozilla public license version 2.0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "public_domain": ["this work is in the public domain", "released into the public domain"],
    "all_rights": ["all rights reserved"],
}
#: Sentences with free parts: identifier and pattern of the whole normalised sentence. A group names the licence.
PATTERNS = [
    ("copyright", r"(?:copyright|\(c\)|©)(?: |$).*"),
    ("cc", r"(?:this work is )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons) (by(?: nc)?(?: sa| nd)?|zero)(?: license)?(?: (\d\.\d))?"),
    ("spdx", r"spdx license identifier ([a-z0-9.+ ]+)"),
]

#: Licence rules in order, the more special ones first: name and identifiers in a row.
RULES = [
    ("MIT", ("mit_grant", "mit_condition", "as_is", "no_liability")),
    ("MIT", ("mit_grant", "mit_condition", "as_is")),
    ("ISC", ("isc_grant", "as_is")),
    ("ISC", ("isc_grant",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_warranty", "bsd_no_liability")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_warranty")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty", "bsd_no_liability")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty")),
    ("Apache-2.0", ("apache2_notice", "apache2_limits", "apache2_copy", "apache2_warranty", "apache2_see")),
    ("Apache-2.0", ("apache2_notice", "apache2_limits", "apache2_copy")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_warranty", "gpl_see", "gpl_copy")),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_warranty", "gpl_see", "gpl_copy")),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("LGPL-2.1-or-later", ("lgpl21_free", "lgpl_warranty", "lgpl_see", "lgpl_copy")),
    ("LGPL-2.1-or-later", ("lgpl21_free",)),
    ("MIT", ("mit_notice",)),
    ("BSD-2-Clause", ("bsd2_notice",)),
    ("BSD-3-Clause", ("bsd3_notice",)),
    ("Apache-2.0", ("apache2_notice",)),
    ("GPL-2.0", ("gpl2_notice",)),
    ("GPL-3.0", ("gpl3_notice",)),
    ("LGPL-3.0", ("lgpl3_notice",)),
    ("AGPL-3.0", ("agpl3_notice",)),
    ("MPL-2.0", ("mpl2_notice",)),
    ("Unlicense", ("unlicense",)),
    ("public-domain", ("public_domain",)),
    ("proprietary", ("all_rights",)),
]
#: Identifiers that stand for themselves and never break a sequence.
_ASIDE = {"copyright"}
#: Stands for unknown sentences between two known ones.
UNKNOWN = "?"
# Unknown sentences that change nothing: list numbers, and titles such as "The MIT License (MIT)".
_HARMLESS = re.compile(r"(?:\(?[a-z0-9ivx.]{1,4}\)?|(?:the )?(?:[a-z0-9.]+ ){0,4}license(?: \(?[a-z0-9.]+\)?){0,3}|(?:disclaimer|disclaimer of warranty))")
#: Licence names by their SPDX form in lower case; the forms without a suffix and with "only" are one.
_NAMES = {name.lower(): name for name, _ in RULES}
_BY_TEXT = {text: name for name, texts in SENTENCES.items() for text in texts}
_BY_PATTERN = [(name, re.compile(p)) for name, p in PATTERNS]
LONGEST = max(len(t.split()) for t in _BY_TEXT)
#: Every known sentence has one of these; texts without any are passed over. It is matched on the raw text, so whatever normalising takes
#: out (line ends, comment leaders, hyphens) may stand between words.
TRIGGER = (r"(?i)licen[sc]|copyright|\(c\)|©|permission|warrant|redistribut|rights[\W_]+reserved|public[\W_]+domain|"
           r"shall[\W_]+the[\W_]+authors|released[\W_]+under")

_LEADER = re.compile(r"^[ \t]*(?://+|/?\*+/?|#+|--|;+|%+|<!--)?[ \t]*", re.M)
_ENDS = re.compile(r"(?<=[.!?:;])(?<!dentifier:)[ \t\r]+|[ \t\r]*\n[ \t\r\n]*")
_NOT_WORD = re.compile(r"[^\w.+©()]+|\((?!c\))|(?<!\(c)\)|\.(?!\d)|(?<!\d)\.|_")


def normalise(sentence: str) -> str:
    """Lower case, American spelling of license, words and version numbers only, one space between."""
    text = re.sub("licence", "license", sentence.lower())
    text = re.sub(r"\(c\)", " (c) ", text)
    return " ".join(_NOT_WORD.sub(" ", text).split())


def identify(sentence: str) -> str | None:
    """The identifier of a normalised sentence; one with a free part carries it after a colon."""
    if name := _BY_TEXT.get(sentence):
        return name
    for name, pattern in _BY_PATTERN:
        if found := pattern.fullmatch(sentence):
            free = " ".join(g for g in found.groups() if g)
            return f"{name}:{free}" if free else name
    return None


def identifiers(text: str) -> list[str]:
    """The identifiers of a text's known sentences, in order.

    A sentence ends at a full stop or the like before white space, or at a line end. A known sentence may run over several lines; the longest
    run of lines that is one is taken. ``UNKNOWN`` stands once for all unknown sentences between two known ones.
    """
    pieces = [p for p in (normalise(x) for x in _ENDS.split(_LEADER.sub("", text))) if p]
    out, i, unknown = [], 0, False
    while i < len(pieces):
        words, best = 0, None
        for j in range(i, len(pieces)):
            words += len(pieces[j].split())
            if words > LONGEST and j > i:
                break
            name = identify(" ".join(pieces[i:j + 1])) if j == i or not pieces[i].startswith(("copyright", "(c)", "©", "spdx")) else None
            if name:
                best = (j, name)
        if best:
            out += [UNKNOWN, best[1]] if unknown and out else [best[1]]
            i, unknown = best[0], False
        elif not _HARMLESS.fullmatch(pieces[i]):
            unknown = True
        i += 1
    return out


def spdx_names(expression: str) -> list[str]:
    """The licences of a normalised SPDX expression: the operands of "or" and "and", without exceptions."""
    names = []
    for operand in re.split(r" (?:or(?! later)|and) ", expression):
        name = operand.split(" with ")[0].strip().replace(" ", "-")
        plain = re.sub(r"-only$", "", re.sub(r"\+$", "-or-later", name))
        if name:
            names.append(_NAMES.get(plain, plain))
    return names


def match(found: list[str]) -> tuple[list[str], list[str]]:
    """The licences of a sequence of identifiers, and the identifiers that no rule takes; ``UNKNOWN`` keeps its neighbours apart."""
    licences, left = set(), [x for x in found if x.split(":")[0] not in _ASIDE]
    for name, rule in RULES:
        i = 0
        while i + len(rule) <= len(left):
            if tuple(left[i:i + len(rule)]) == rule:
                licences.add(name)
                left[i:i + len(rule)] = ["|"]  # a taken rule keeps its neighbours apart
            i += 1
    rest = []
    for x in left:
        kind, _, free = x.partition(":")
        if kind == "cc":
            licences.add("CC-" + free.upper().replace("ZERO", "0").replace(" ", "-"))
        elif kind == "spdx":
            licences.update(spdx_names(free))
        elif x not in ("|", UNKNOWN):
            rest.append(x)
    return sorted(licences), rest


_RESULT = "doc_id bigint, sentence_ids array<string>, licences array<string>, unmatched array<string>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences and unmatched of every row of ``docs``; its other columns are ignored.

    A null or empty text, and a text without a known sentence, has empty lists; an empty table gives an empty one; very long texts are read
    whole. Repeated rows are judged alike; a licence found twice is named once; licences are sorted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text")
            near = pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(texts, TRIGGER), False)).to_pylist()
            made = {name: [[] for _ in range(batch.num_rows)] for name in ("sentence_ids", "licences", "unmatched")}
            for i in near:
                found = identifiers(texts[i].as_py())
                made["sentence_ids"][i] = [x for x in found if x != UNKNOWN]
                made["licences"][i], made["unmatched"][i] = match(found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, pa.list_(pa.string())) for x in made.values()]],
                                             names=["doc_id", *made])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _RESULT)
