"""Licence scan by digests of canonical text, with DataFrame functions only.

A text is brought to a canonical form (lower case, copyright lines out, one of several spellings, punctuation and white
space as single blanks) and its SHA-256 is looked up among those of known licences: the whole text by a hash join,
and each of its lines, for one-line notices, in the same table.
"""

from __future__ import annotations

import hashlib
import re
import textwrap

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence and notice texts by SPDX identifier.
KNOWN = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0."],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:\n\n1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.\n\nTHIS "
        'SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR "
        "A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:\n\n1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.\n\n3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS "
        'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions "
        "that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under "
        'copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to "
        "<https://unlicense.org>",
    ],
}

# Digests of whole published texts, titles included.
WHOLE = {
    "ebc600199db9838b4fc2d5288a12598c2702142177a89b3443f5cc87b137d94b": "Apache-2.0",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0-only",
    "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1": "GPL-2.0-only",
    "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f": "GPL-3.0-only",
    "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3": "LGPL-2.0-only",
    "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345": "LGPL-2.1-only",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0-only",
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6": "MPL-1.1",
    "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56": "MPL-2.0",
    "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304": "Artistic-1.0-Perl",
    "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f": "GFDL-1.2-only",
    "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480": "GFDL-1.3-only",
}

# What files put above a text; a line of copyright between goes in the canonical form.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "All rights reserved.", "BSD 2-Clause License\nAll rights reserved."],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "All rights reserved.", "BSD 3-Clause License\nAll rights reserved."],
    "Unlicense": ["The Unlicense"],
}

# Spellings that count as the same, longest first.
SPELLINGS = [
    ("copyright owner", "copyright holder"),
    ("acknowledgement", "acknowledgment"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("favour", "favor"),
    ("licence", "license"),
    ("whilst", "while"),
    ("https", "http"),
]

_STEPS = [
    (r"(?m)^[ \t/*#;-]*(copyright|\(c\)|©)[^\n]*$", " "),
    (r"[^0-9a-z\x{80}-\x{10FFFF}]+", " "),
    *SPELLINGS,
]


def canonical(text: Column) -> Column:
    """The canonical form of a text; null stays null."""
    out = F.lower(text)
    for pattern, to in _STEPS:
        out = F.regexp_replace(out, pattern, to)
    return F.trim(out)


def _digest(text: str) -> str:
    out = text.lower()
    for pattern, to in _STEPS:
        out = re.sub(pattern.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff"), to, out)
    return hashlib.sha256(out.strip(" ").encode()).hexdigest()


def digests(known: dict[str, list[str]]) -> dict[str, str]:
    """Of each text as it is, and of whole texts under their usual titles and with lines of usual widths, as a line
    that begins with the word copyright goes in the canonical form wherever it stands."""
    out = {_digest(text): name for name, texts in known.items() for text in texts}
    for name, texts in known.items():
        for text in texts:
            if len(text) < 200:
                continue
            paragraphs = text.split("\n\n")
            widths = ["\n\n".join(textwrap.fill(p, width) for p in paragraphs) for width in range(60, 101)]
            for title in ["", *TITLES.get(name, [])]:
                out |= {_digest(f"{title}\n\n{body}"): name for body in {text, *widths}}
    return out | (WHOLE if known is KNOWN else {})


def scanned(docs: DataFrame, known: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document: doc_id, digest, license, notices.

    ``license`` is the licence that the whole text is; null where it is none or the text is null, as is the digest
    then. ``notices`` lists, sorted and once each, the licences that a whole line of the text names; null for
    a null text. The table of known texts is a parameter of the caller and is broadcast.
    """
    spark = docs.sparkSession
    table = digests(known or KNOWN)
    rows = spark.createDataFrame(list(table.items()), "digest string, license string")
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
    found = F.filter(
        F.transform(lines, lambda x: F.element_at(lookup, F.sha2(canonical(x), 256))), lambda x: x.isNotNull()
    )
    whole = docs.select(
        "doc_id",
        F.sha2(canonical(F.col("text")), 256).alias("digest"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notices"),
    )
    return whole.join(F.broadcast(rows), "digest", "left").select("doc_id", "digest", "license", "notices")


def sql() -> str:
    """The same over the table ``documents`` in DuckDB."""

    def form(column: str) -> str:
        out = f"lower({column})"
        for pattern, to in _STEPS:
            out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
        return f"trim({out}, ' ')"

    values = ", ".join(f"('{digest}', '{name}')" for digest, name in digests(KNOWN).items())
    pairs = ", ".join(f"'{digest}': '{name}'" for digest, name in digests(KNOWN).items())
    line = f"(MAP {{{pairs}}})[sha256({form('x')})]"
    return f"""
    WITH known(digest, license) AS (VALUES {values}),
    scanned AS (
        SELECT doc_id, sha256({form('text')}) AS digest,
            list_aggregate(list_sort(list_distinct(list_filter(list_transform(
                list_filter(string_split(text, chr(10)), lambda x: length(x) > 0), lambda x: {line}), lambda x: x IS NOT NULL))),
                'string_agg', ',') AS notices
        FROM documents)
    SELECT doc_id, digest, license, CASE WHEN digest IS NOT NULL THEN coalesce(notices, '') END AS notices
    FROM scanned LEFT JOIN known USING (digest)
    """
