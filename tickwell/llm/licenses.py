"""Licence notices by sentence rules, in DataFrame functions only.

A text is cut into sentences, each is normalised and looked up among known
licence sentences; the ids found, in order, are matched against ordered rules.
Sentences of the standard notices may run over wrapped lines; short phrases are
looked up line by line.  Everything happens inside one row, so there is no
shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised phrases that fill a line or a sentence of one line, and their ids.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-basis",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies": "mit-notice-kept",
    "the software is provided as is without warranty of any kind": "as-is",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this work is licensed under the gnu general public license version 2": "gpl2-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-terms",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-grant",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "all rights reserved": "all-rights",
}
# Grants whose copyright line usually says that all rights are reserved.
GRANTS = ["mit-grant", "bsd-grant", "bsd-terms", "isc-grant", "zlib-grant"]
# Licence, the ids that must follow each other, other ids in between allowed, and ids that must not occur.
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-compliance", "apache-copy", "apache-basis"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant", "mit-notice-kept"]),
    ("MIT", ["mit-grant", "as-is"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL", ["gpl-terms"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("Proprietary", ["all-rights"], GRANTS),
]
# Complete sentences of the standard notices and their ids.  Each group stands in the order of
# its notice; a colon or an address does not end a sentence, so neighbours may also come as one.
NOTICES = [
    [
        ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License", "apache-notice"),
    ],
    [
        ("You may obtain a copy of the License at", ""),
        ("http://www.apache.org/licenses/LICENSE-2.0", "apache-copy"),
        ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied", "apache-basis"),
    ],
    [
        ("You may obtain a copy of the License at", ""),
        ("https://www.apache.org/licenses/LICENSE-2.0", "apache-copy"),
        ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied", "apache-basis"),
    ],
    [
        ("See the License for the specific language governing permissions and limitations under the License", "apache-limits"),
    ],
    [
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
         "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
         "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
         "subject to the following conditions", "mit-grant"),
        ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "mit-notice-kept"),
    ],
    [
        ("The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial "
         "portions of the Software", "mit-notice-kept"),
    ],
    [
        ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
         "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT", "as-is"),
    ],
    [
        ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
         "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE", "mit-liability"),
    ],
    [
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd-terms"),
        ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "bsd-keep-source"),
    ],
    [
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1", "bsd-terms"),
    ],
    [
        ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
         "documentation and/or other materials provided with the distribution", "bsd-keep-binary"),
    ],
    [  # whose name it is differs
        ("may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-endorsement"),
    ],
    [
        ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
         "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED", "bsd-as-is"),
    ],
    *[[(f"is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License {tail}", f"gpl{v}-notice")]
      for v in (2, 3) for tail in (
          f"as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version",
          f"as published by the Free Software Foundation, version {v} of the License",
          f"as published by the Free Software Foundation, version {v}",
          f"version {v} as published by the Free Software Foundation")],
    [
        ("is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
         "FITNESS FOR A PARTICULAR PURPOSE", "gpl-warranty"),
    ],
    [
        ("See the GNU General Public License for more details", "gpl-details"),
    ],
    *[[(f"is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License {tail}", f"lgpl{v}-notice")]
      for v in ("2.1", "3") for tail in (
          f"as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version",
          f"as published by the Free Software Foundation, version {v} of the License")],
    *[[(f"is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License {tail}", "agpl3-notice")]
      for tail in ("as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
                   "as published by the Free Software Foundation, version 3 of the License")],
    [  # the version follows "v.", which ends a sentence here
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v", "mpl2-notice"),
    ],
    [
        ("If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", "mpl2-copy"),
    ],
    [
        ("If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/", "mpl2-copy"),
    ],
    *[[(f"Permission to use, copy, modify, {conjunction} distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies", "isc-grant")] for conjunction in ("and/or", "and")],
    [
        ("This is free and unencumbered software released into the public domain", "unlicense-grant"),
    ],
    [  # whose name it is differs
        ("has waived all copyright and related or neighboring rights to this work", "cc0-waiver"),
    ],
    *[[(f"This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        f"{scheme}://www.eclipse.org/legal/epl-2.0/", "epl2-notice")] for scheme in ("https", "http")],
    *[[("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
        f"freely, subject to the following restrictions{first}", "zlib-grant")] for first in ("", ": 1")],
    [
        ("Distributed under the Boost Software License, Version 1.0", "bsl1-notice"),
    ],
]
# Rules over these sentences: licence, ids in order, and ids that must not occur.
NOTICE_RULES = [
    ("BSD-3-Clause", ["bsd-terms", "bsd-keep-source", "bsd-keep-binary", "bsd-endorsement"]),
    ("BSD-2-Clause", ["bsd-terms", "bsd-keep-source", "bsd-keep-binary"], ["bsd-endorsement"]),
    ("LGPL-2.1", ["lgpl2.1-notice"]),
    ("LGPL-3.0", ["lgpl3-notice"]),
    ("AGPL-3.0", ["agpl3-notice"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-grant"]),
    ("CC0-1.0", ["cc0-waiver"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["bsl1-notice"]),
]
SENTENCE_END = r"[.!?]+[ \t\r]+|[.!?]*\n[ \t\r]*|[.!?]+$"
NOT_WORD = "[^a-z0-9]+"
# Ends of sentences that may run over lines: punctuation, a line without letters and digits, a numbered item.
# Each is also an end by SENTENCE_END.
WRAPPED_END = r"[.!?]+[ \t\r]+|[.!?]+\n|[.!?]+$|\n[^a-z0-9\n]*\n|\n[^a-z0-9\n]*(?=[0-9a-c][.)][ \t])"
TAIL_WORDS = 4  # of a notice's sentence, looked up before the whole of it


def notice_sentences() -> dict[str, list[str]]:
    """Normalised sentences of the notices, and neighbours as one, with their ids; the longest first."""
    found = {}
    for group in NOTICES:
        plain = [(re.sub(NOT_WORD, " ", sentence.lower()).strip(), id_) for sentence, id_ in group]
        for lo in range(len(plain)):
            for hi in range(lo + 1, len(plain) + 1):
                ids = [id_ for _, id_ in plain[lo:hi] if id_]
                if ids:
                    found[" ".join(sentence for sentence, _ in plain[lo:hi])] = ids
    return dict(sorted(found.items(), key=lambda f: -len(f[0])))


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, NOT_WORD, " "))


def _line_ids(text: Column, known: dict[str, str]) -> Column:
    plain = F.transform(F.split(text, SENTENCE_END), _plain)
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.transform(F.filter(plain, lambda s: s.isin(*known)), lambda s: F.element_at(lookup, s))


def sentence_ids(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """Array of the licence-sentence ids of a text, in order, with repeats.

    ``sentences`` replaces the phrases and leaves the standard notices out.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    if sentences:
        return _line_ids(lowered, sentences)
    notices = notice_sentences()
    tails = {" ".join(n.split()[-TAIL_WORDS:]) for n in notices}
    none = F.array().cast("array<string>")

    def ids(p: Column) -> Column:
        # A notice's sentence may follow other words, such as a program's name or a copyright line; these are still looked up.
        plain = p["plain"]
        hits = F.coalesce(*[F.when(plain.endswith(n) & ((plain == n) | plain.endswith(" " + n)), F.array(*map(F.lit, i))) for n, i in notices.items()], none)
        lines = F.when(plain.isin(*notices), none).otherwise(_line_ids(p["raw"], SENTENCES))
        return F.concat(lines, F.when(F.substring_index(plain, " ", -TAIL_WORDS).isin(*tails), hits).otherwise(none))

    cut = F.transform(F.split(lowered, WRAPPED_END), lambda s: F.struct(s.alias("raw"), _plain(s).alias("plain")))
    return F.flatten(F.transform(cut, ids))


def rule_pattern(ids: list[str]) -> str:
    """Regular expression over ``,id,id,`` that finds the ids in this order."""
    return "," + ",(.*,)?".join(map(re.escape, ids)) + ","


def any_pattern(ids: list[str]) -> str:
    """Regular expression over ``,id,id,`` that finds any of the ids."""
    return ",(" + "|".join(map(re.escape, ids)) + "),"


def _matches(ids: Column, sequence: list[str], without: list[str] | tuple = ()) -> Column:
    found = ids.rlike(rule_pattern(sequence))
    return found & ~ids.rlike(any_pattern(without)) if without else found


def license_scan(documents: DataFrame, sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """One row per document: (doc_id, n_license_sentences, sentence_ids, licenses).

    ``sentence_ids`` and ``licenses`` are comma-joined; licences stand in rule
    order, each once.  Null and empty texts have none; repeated rows are each
    scanned; texts of any length are scanned whole, an empty table gives no
    rows; other columns are not read.
    """
    found = documents.select("doc_id", sentence_ids(F.col("text"), sentences).alias("_ids"))
    listed = found.select("doc_id", F.size("_ids").cast("long").alias("n_license_sentences"), F.array_join("_ids", ",").alias("sentence_ids"))
    ids = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    hits = [F.when(_matches(ids, *rule), F.lit(name)) for name, *rule in rules or RULES + NOTICE_RULES]
    names = F.array_distinct(F.array_compact(F.array(*hits)))
    return listed.withColumn("licenses", F.array_join(names, ","))


def oracle_sql() -> str:
    """The same scan over ``documents`` in the checker's SQL, for the phrases; the standard notices have none."""
    known = ", ".join(f"'{s}'" for s in SENTENCES)
    lookup = "MAP {" + ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items()) + "}"
    cut = f"regexp_split_to_array(lower(coalesce(text, '')), '{SENTENCE_END}')"
    hits = ", ".join(f"CASE WHEN regexp_matches(l, '{rule_pattern(rule[0])}')" + "".join(f" AND NOT regexp_matches(l, '{any_pattern(w)}')" for w in rule[1:])
                     + f" THEN '{name}' END" for name, *rule in RULES)
    order = ", ".join(f"'{n}'" for n in dict.fromkeys(name for name, *_ in RULES))
    return f"""
WITH cut AS (
  SELECT doc_id, list_transform(list_filter(list_transform({cut}, lambda s: trim(regexp_replace(s, '{NOT_WORD}', ' ', 'g'))),
         lambda s: s IN ({known})), lambda s: {lookup}[s]) AS ids FROM documents),
listed AS (SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_license_sentences, array_to_string(ids, ',') AS sentence_ids,
                  ',' || array_to_string(ids, ',') || ',' AS l FROM cut)
SELECT doc_id, n_license_sentences, sentence_ids,
       array_to_string(list_filter([{order}], lambda n: list_contains([{hits}], n)), ',') AS licenses
FROM listed"""
