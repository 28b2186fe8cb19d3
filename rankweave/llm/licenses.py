"""License scans: whole texts and whole lines are brought to a canonical form and looked up among known digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that count as the same, applied in this order to lower-case text.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("https:", "http:"),
    ("&", " and "),
]

# The wordings of licenses and of the notices that name one.
TEXTS = [
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
        SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
]

#: Every wording of TEXTS has one of these words; a text or line without them is not compared with TEXTS.
MENTIONS = "licen[cs]e|permission"
_OWNER_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©)"
_RIGHTS_LINE = r"^[^a-z0-9]*all rights reserved[^a-z0-9]*$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, with one spelling of each word and single spaces."""
    lines = F.filter(F.split(F.translate(text, _UPPER, _LOWER), "\n"), lambda line: ~line.rlike(_OWNER_LINE) & ~line.rlike(_RIGHTS_LINE))
    out = F.array_join(lines, "\n")
    for spelling, usual in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(usual))
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def _may_match(text: Column, default: bool) -> Column:
    return F.translate(text, _UPPER, _LOWER).rlike(MENTIONS) if default else text.isNotNull()


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document that is, and each line that is, a known wording: `id`, line (from 1; 0 for the whole
    text), license. A wording of several licenses gives a row for each.

    `known` has the columns license and text and is broadcast, so it must be a list of wordings, not a corpus; the
    default is TEXTS. All work is one pass without a shuffle: entries are brought to canonical form, for TEXTS only those
    that mention a license, and their sha256 is hash-joined with the known ones. Null and empty texts match nothing; equal rows each give
    their rows; other columns are not read.
    """
    default = known is None
    if default:
        known = docs.sparkSession.createDataFrame(TEXTS, "license string, text string")
    digests = known.where(canonical(F.col("text")) != "").select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()
    body = F.col(text)
    whole = F.struct(F.lit(0).alias("line"), body.alias("entry"))
    lines = F.transform(F.split(body, "\n"), lambda line, k: F.struct((k + 1).alias("line"), line.alias("entry")))
    mentions = docs.where(_may_match(body, default)).select(F.col(id).alias("id"), F.explode(F.concat(F.array(whole), lines)).alias("e"))
    entries = mentions.where(_may_match(F.col("e.entry"), default)).select("id", "e.line", F.sha2(canonical(F.col("e.entry")), 256).alias("digest"))
    return entries.join(F.broadcast(digests), "digest").select(F.col("id").alias(id), "line", "license")
