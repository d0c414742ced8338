"""Licence scan by canonical digests.

A text is reduced to a canonical form (case, copyright notices, links, equivalent spellings,
punctuation and white space), and the digest of the form is joined with the digests of known
licence texts and statements. Units of the scan are whole texts and, where a text has
several, its lines; a unit is compared as a whole, never in part. A whole text with copyright notices has a second
form, in which lines are joined before the notices go, so that texts with notices inside are found however they are wrapped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calipers.llm.common import text_of
from calipers.llm.licence_texts import FULL

# Equivalent spellings, in lower-cased text.
SPELLINGS = (
    ("licence", "license"), ("sub-licens", "sublicens"), ("sub licens", "sublicens"), ("non-commercial", "noncommercial"),
    ("non commercial", "noncommercial"), ("share-alike", "sharealike"), ("share alike", "sharealike"), ("isation", "ization"),
    ("favour", "favor"), ("&", " and "),
)
# Words after "copyright" or "(c)" at the beginning of a line that make it a piece of a text, not a notice.
_NO_NAMES = (
    r"(?:holders?|owners?|notices?|laws?|license[sd]?|licensors?|and|or|is|are|in|on|to|for|of|as|interests?|statements?|disclaimers?|"
    r"protections?|treat(?:y|ies)|permissions?|acts?|claims?|rights?|status|infringements?|materials?|terms|works?|registrations?|lines?|"
    r"the (?:software|work|program|library)|you|under|the licensor|if|any|an?|all|each|it|with|no|use|such|this|that|not|where|when|similar)\b"
)
_YEAR = r"[\[<{]?(?:(?:19|20)[0-9][0-9]|yyyy|year)\b"
# A notice ends with its reservation of rights or its sentence, where a licence begins, or with the line.
_NOTICE_END = (
    r"[^\n]*?(?:all rights reserved[.\s]*|(?<=[a-z0-9]{3})(?<!\binc)(?<!\bltd)(?<!\bcorp)\.\s+(?:all rights reserved[.\s]*)?|"
    r"(?=\b(?:permission is (?:hereby )?granted|permission to use|this software|this work|this file|this project|this program|this source|"
    r"the software is|redistribution and use|licensed under|released under|distributed under|available under|everyone is permitted|"
    r"license:|spdx-license))|$)"
)
_NOTICE = (
    r"(?:(?:copyright|©|\(c\))[\s:,]*(?:(?:\(c\)|©)[\s:,]*)?" + _YEAR  # anywhere
    + r"|^[!-/:-@\[-`{-~\t-\r\x20\u00a0]*(?:copyright[\s:]*(?:\(c\)|©)|copyright:?\s+(?!" + _NO_NAMES + r")(?=[a-z<\[{\u0080-\uffff])"
    + r"|©|\(c\)\s*(?!" + _NO_NAMES + r")(?!the\b)(?=[a-z<\[{][^\n]{0,60}$)))"
    + _NOTICE_END
)
# Patterns, what takes their place, and texts of which one is in every line that has a match.
PATTERNS = (
    (_NOTICE, " ", ("copyright", "(c)", "©")),
    (r"https?://\S+|www\.\S+", " ", ("http", "www.")),
    (r"\b(?:version|ver\.?|v\.?) ?(?=[0-9])", "version ", ("v0", "v1", "v2", "v3", "v4", "v5", "v6", "v7", "v8", "v9", "v.", "v ", "ver", "version")),
    (r"(?<=[0-9])\.0\b", "", (".0",)),
)
_GAPS = r"[!-/:-@\[-`{-~\t-\r\x20\u00a0«»“”‘’–—…©®™·¶§•]+"


# Licences by identifier, with the names that statements use.
NAMES = {
    "MIT": ("MIT License", "MIT", "Expat License"), "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"), "EPL-2.0": ("Eclipse Public License, Version 2.0", "EPL-2.0"),
    "Unlicense": ("Unlicense",), "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"), "zlib": ("zlib License",),
} | {
    f"CC-BY{kind.upper()}-{version}": (f"CC BY{kind} {version}", f"Creative Commons Attribution{words} {version}",
                                       f"Creative Commons Attribution{words} {version} International License")
    for kind, words in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"),
                        ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))
    for version in ("3.0", "4.0")
}
STATEMENTS = (
    "{}", "{}.", "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
    "Distributed under the {}", "Available under the {}", "This work is licensed under {}", "This work is licensed under the {}",
    "This work is licensed under a {}", "This file is licensed under the {}", "This software is released under the {}",
    "This project is licensed under the {}", "License: {}", "SPDX-License-Identifier: {}",
)

# Short licences and notices in full; the long ones follow below.
TEXTS = {
    "all-rights-reserved": ("All rights reserved.",),
    "MIT": ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",),
    "ISC": ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",),
    "Apache-2.0": ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",),
    "MPL-2.0": ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",),
    "zlib": ("""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",),
}
# Title lines that stand above texts which do not bring their own.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"),
    "zlib": ("zlib License", "The zlib License"), "Unlicense": ("The Unlicense", "Unlicense"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"),
}
TEXTS |= {licence: (*TEXTS.get(licence, ()), text) for licence, text in FULL.items()}
TEXTS |= {
    licence: (*TEXTS[licence], *(
        "\n\n".join([*above, TEXTS[licence][0]]) for title in titles
        for above in ((title,), (title, "All rights reserved."), ("All rights reserved.",))
    )) for licence, titles in TITLES.items()
}


def _spelled(line: Column) -> Column:
    form = F.lower(line)
    for spelling, same in SPELLINGS:
        form = F.replace(form, F.lit(spelling), F.lit(same))
    return form


def _hinted(form: Column, hints: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (form.contains(h) for h in hints))


def forms(text: Column) -> Column:
    """The canonical forms of the lines of a text; the whole text's form is that of its lines, joined by spaces.

    Each step is a pass of its own over the array of lines, so that no step is evaluated
    twice. Patterns are tried only where one of their texts occurs.
    """
    lines = F.transform(F.split(text, "\n"), _spelled)
    for pattern, instead, hints in PATTERNS:
        lines = F.transform(lines, lambda x: F.when(
            _hinted(x, hints), F.regexp_replace(x, pattern, instead)  # noqa: B023
        ).otherwise(x))
    return F.transform(lines, lambda x: F.trim(F.regexp_replace(x, _GAPS, " ")))


def _whole(lines: Column) -> Column:
    """The form of the whole text; what equivalent spellings say of two words holds over the end of a line, too."""
    form = F.array_join(F.filter(lines, lambda x: x != ""), " ")
    for spelling, same in SPELLINGS:
        if " " in spelling:
            form = F.replace(form, F.lit(spelling), F.lit(same))
    return F.regexp_replace(form, r"\b(?:ver|v) (?=[0-9])", "version ")


def _joined(text: Column) -> Column:
    """The form of the whole text with its lines joined before notices are taken out, so that it does not depend on line ends."""
    return _whole(forms(F.regexp_replace(text, r"[\t-\r\x20]+", " ")))


def _noticed(text: Column) -> Column:
    """Whether a notice may stand in the text; without one, both forms of the whole text say the same."""
    return _hinted(F.lower(text), PATTERNS[0][2])


def known_digests(spark: SparkSession) -> DataFrame:
    """digest, licence: one row per canonical form of the fixed texts and statements, taken line by line and with lines joined."""
    rows = [(licence, text) for licence, texts in TEXTS.items() for text in texts]
    rows += [(licence, form.format(name)) for licence, names in NAMES.items() for name in names for form in STATEMENTS]
    texts = spark.createDataFrame(rows, "licence string, text string")
    both = F.explode(F.array(_whole(forms(F.col("text"))), _joined(F.col("text")))).alias("form")
    digests = texts.select("licence", both).where("form <> ''").select("licence", F.sha2("form", 256).alias("digest"))
    return digests.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, unit, line, licence, digest: every unit of docs whose canonical form is a known one.

    unit is `text` for a whole text (line 0) and `line` for a line of a text of several
    (counted from 1). `known` may bring digests of its own (digest, licence; one row per
    digest). Units without letters or digits, null and empty texts match nothing. Repeated
    rows are reported each. No rows: no rows.
    """
    own = known is None
    known = known_digests(docs.sparkSession) if own else known.select("digest", "licence")
    text = text_of(F.col("text"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), forms(text).alias("lines"),
        F.when(_noticed(text), F.sha2(_joined(text), 256)).alias("joined"),
    )
    unit = lambda line, digest, joined: F.struct(
        line.cast("int").alias("line"), digest.alias("digest"), joined.cast("string").alias("joined")
    )
    none = F.lit(None)
    several = F.when(F.size("lines") > 1, F.transform("lines", lambda x, i: F.when(x != "", unit(i + 1, F.sha2(x, 256), none))))
    units = F.concat(F.array(unit(F.lit(0), F.sha2(_whole(F.col("lines")), 256), F.col("joined"))), F.coalesce(several, F.array()))
    digests = texts.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.*")
    # the built-in table is fixed and has under 1,000 rows; a caller's is left to the optimiser
    table = F.broadcast(known) if own else known
    other = table.select(F.col("digest").alias("joined"), F.col("licence").alias("joined_licence"))
    return digests.join(table, "digest", "left").join(other, "joined", "left").select(
        "doc_id", F.when(F.col("line") == 0, "text").otherwise("line").alias("unit"), "line",
        F.coalesce("licence", "joined_licence").alias("licence"),
        F.when(F.col("licence").isNotNull(), F.col("digest")).otherwise(F.col("joined")).alias("digest"),
    ).where("licence is not null")
