"""Licence texts and notices, found by the digest of their canonical form.

Canonical form: lower case; lines that state a copyright are dropped; everything but
letters and digits is a space; spellings that mean the same become one; spaces are
single. Two texts with equal forms are the same licence. A document is looked up as
a whole and line by line, and only equal digests of entire texts or lines match.
"""

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that mean the same (the second one is kept).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful", "https": "http",
}
# Licence texts.
_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
          "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
          "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
          "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
          "included in all copies or substantial portions of the Software.\n\n")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
          "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
          "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
          "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies.\n\n"
_ISC_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
              "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
              "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
              "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
              "from this software without specific prior written permission.\n\n")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
              "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
              "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
              "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
              "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
              "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
         "damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including "
         "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this "
         "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
         "an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly "
         "marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from "
         "any source distribution.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, "
              "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
              "non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate "
              "any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
              "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
              "perpetuity of all present and future rights to this software under copyright law.\n\n"
              + _AS_IS.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS") + "\n\nFor more information, please refer to <https://unlicense.org>")
FILES = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0")  # long texts, in licenses/
LICENSES = {
    "MIT": _GRANT + _AS_IS,
    "ISC": _ISC + _ISC_NOTICE + _ISC_AS_IS,
    "0BSD": _ISC + ".\n\n" + _ISC_AS_IS,
    "BSD-2-Clause": _BSD + _BSD_AS_IS,
    "BSD-3-Clause": _BSD + _BSD_NAMES + _BSD_AS_IS,
    "Zlib": _ZLIB,
    "Unlicense": _UNLICENSE,
    **{i: (files(__package__) / "licenses" / f"{i}.txt").read_text("utf-8") for i in FILES},
}
# Titles that may stand over a text, and the line after which an appendix may be left out.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"), "Zlib": ("zlib License", "The zlib License"), "Unlicense": ("The Unlicense",),
}
RIGHTS = "All rights reserved."
RIGHTS_ID = "LicenseRef-All-Rights-Reserved"
END = "END OF TERMS AND CONDITIONS"
# Names of licences as they stand in one-line notices.
NAMES = {
    "MIT": ("MIT License",), "ISC": ("ISC License",), "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2",), "GPL-3.0": ("GNU General Public License, version 3",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",), "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "MPL-2.0": ("Mozilla Public License, version 2.0",), "BSD-2-Clause": ("BSD 2-Clause License",), "BSD-3-Clause": ("BSD 3-Clause License",),
    "CC0-1.0": ("CC0 1.0",), "CC-BY-4.0": ("CC BY 4.0",), "CC-BY-SA-4.0": ("CC BY-SA 4.0",), "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",),
}
LEADS = ("Released under", "Licensed under", "Distributed under", "This work is licensed under", "This software is released under")
# Every known text has one of these words, before and after spellings are made equal. No more than one, as a line that is dropped
# or any blanks may stand between two words; texts without them need no canonical form.
MARK = "(?i)licen[cs]|permission|redistribut|released|distributed|reserved"
COPYRIGHT = r"(?im)^[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|<|\[|by )|\(c\)[ \t]*[0-9]{4}|©)[^\n]*$"
SMALL = 100_000  # known digests that are sent to every task; more are joined by shuffling


def _variants(ident: str, text: str) -> list[str]:
    """The text as it is passed on: without its appendix, or under a title, with the rights notice, with clauses not numbered."""
    if ident in FILES:
        return [text, text.split(END)[0] + END] if END in text else [text]
    bare = re.sub(r"(?m)^[0-9]\. ", "", text)
    return [head + rights + body for head in ("", *(f"{t}\n\n" for t in TITLES[ident])) for rights in ("", f"{RIGHTS}\n\n")
            for body in dict.fromkeys((text, bare))]


def known_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the licences and notices above."""
    notices = [(i, f"{lead} {the}{name}") for i, names in NAMES.items() for name in names for lead in LEADS for the in ("", "the ")]
    return [*((i, v) for i, t in LICENSES.items() for v in _variants(i, t)), *notices, (RIGHTS_ID, RIGHTS)]


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def canonical(text: Column) -> Column:
    """Canonical form of a text; null stays null."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT, "")), r"[^\p{L}\p{N}]+", " ")
    same = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    words = F.filter(F.split(bare, " "), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.coalesce(same[w], w)), " ")


def scan(docs: DataFrame, known: DataFrame, text: str = "text", ident: str = "doc_id", *, mark: str | None = None, small: int = SMALL) -> DataFrame:
    """(ident, license_id, whole, lines) for documents that are a known text, or have lines that are one.

    `known` has license_id and text; texts that come to nothing in canonical form are ignored, and of several ids with one
    form the least counts. whole: the entire document is that text. lines: how many of its lines are. `mark` is a pattern
    that every known text and its variants contain, and saves work: MARK is one for the texts of this module. Without
    it every line is looked up.

    Null and empty texts match nothing. Repeated rows with one id add up to one row: whole if any is, lines summed. A null
    id is an id. Empty tables: no rows. Texts of any length are taken whole. Other columns are not looked at.
    """
    digests = (known.select("license_id", canonical(F.col("text")).alias("form")).where("form <> '' and license_id is not null")
               .groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license_id")))
    if digests.count() <= small:
        digests = F.broadcast(digests)
    has = lambda c: c.rlike(mark) if mark else c.isNotNull()
    marked = docs.select(F.col(ident).alias("i"), F.col(text).alias("t")).where(has(F.col("t")))
    lines = F.filter(F.split("t", "\n"), has)
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("t").alias("u"))),
                     F.transform(lines, lambda s: F.struct(F.lit(False).alias("whole"), s.alias("u"))))
    each = marked.select("i", F.explode(units).alias("x")).select("i", "x.whole", F.sha2(canonical(F.col("x.u")), 256).alias("digest"))
    return (each.join(digests, "digest").groupBy("i", "license_id")
            .agg(F.max("whole").alias("whole"), F.sum(F.when(F.col("whole"), 0).otherwise(1)).cast("long").alias("lines"))
            .select(F.col("i").alias(ident), "license_id", "whole", "lines"))


def op8_query(spark, sf_dir: str) -> DataFrame:
    """Licences of every document of the table."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), known_licenses(spark), mark=MARK)


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_form(column: str) -> str:
    pairs = ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items())
    bare = f"regexp_replace(lower(regexp_replace({column}, {_sql_text(COPYRIGHT)}, '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
    return (f"array_to_string(list_transform(list_filter(string_split({bare}, ' '), lambda w: w <> ''), "
            f"lambda w: coalesce(MAP {{{pairs}}}[w], w)), ' ')")


OP8_SQL = f"""
WITH l_known(license_id, text) AS (VALUES {", ".join(f"({_sql_text(i)}, {_sql_text(t)})" for i, t in known_texts())}),
l_digests AS (SELECT sha256(form) AS digest, min(license_id) AS license_id
              FROM (SELECT license_id, {_sql_form("text")} AS form FROM l_known) GROUP BY 1),
l_marked AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '{MARK}')),
l_units AS (SELECT doc_id, true AS whole, text AS u FROM l_marked
            UNION ALL SELECT doc_id, false, unnest(string_split(text, chr(10))) FROM l_marked),
l_each AS (SELECT doc_id, whole, sha256({_sql_form("u")}) AS digest FROM l_units WHERE regexp_matches(u, '{MARK}'))
SELECT doc_id, license_id, bool_or(whole) AS whole, sum(CASE WHEN whole THEN 0 ELSE 1 END)::BIGINT AS lines
FROM l_each JOIN l_digests USING (digest) GROUP BY doc_id, license_id"""
