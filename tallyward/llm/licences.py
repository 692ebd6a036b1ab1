"""Licence scan by the digest of a canonical text.

A text becomes canonical by lower case, without copyright lines, with equivalent
spellings made one, and with every run of ASCII punctuation and white space as one
space. Whole texts, and single lines for short notices inside other texts, are
joined on the SHA-256 digest of that form to the digests of known licences; a match
is a match of the entire text or line. Known licences are a list in this module or
the caller's, whose digests are broadcast; a list of more than MAX_KNOWN is an error.

NULL counts as empty. An empty canonical text matches nothing. Repeated rows have a
row each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_KNOWN = 10_000

# Names and texts of licences and of the notices that stand for them.
KNOWN = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "Released under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "mit",
        """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
)
# Spellings that count as one, as pattern and replacement.
SPELLINGS = (
    ("licenc(e|ed|es|ing)\\b", "licens\\1"),
    ("\\bsub[ -]licens", "sublicens"),
    ("\\bnon[ -]commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("\\bcopyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("\\bfavour", "favor"),
    ("\\bper cent\\b", "percent"),
)
VARIANTS = "licenc|sub[ -]licens|non[ -]commercial|acknowledgement|merchantib|right owner|organis|favour|per cent"
COPYRIGHT = (
    "^[^a-z0-9\\n]*(?:©|\\(c\\)[^a-z0-9\\n]*[0-9]|copyright[^a-z0-9\\n]*(?:\\(c\\)|©|[0-9]{4}|by\\b))[^\\n]*$"
)
BREAKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def canonical_lines(text: Column) -> Column:
    """The text's lines in canonical form, without those that come out empty."""
    bare = F.regexp_replace(F.lower(text), "(?md)" + COPYRIGHT, "")

    def spelled(line: Column) -> Column:
        one = line
        for pattern, put in SPELLINGS:
            one = F.regexp_replace(one, pattern, put.replace("\\1", "$1"))
        return F.when(line.rlike(VARIANTS), one).otherwise(line)

    lines = F.transform(
        F.split(bare, "\n"), lambda x: F.trim(F.regexp_replace(spelled(x), BREAKS, " "))
    )
    return F.filter(lines, lambda x: x != "")


def known_digests(spark, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """_digest, _length and licence of the known texts."""
    if len(known) > MAX_KNOWN:
        raise ValueError(f"at most {MAX_KNOWN} known texts")
    rows = spark.createDataFrame(list(known), "licence string, text string")
    rows = rows.withColumn("_lines", canonical_lines(F.col("text"))).where(F.size("_lines") > 0)
    whole = F.array_join("_lines", " ")
    return rows.select(
        "licence",
        F.sha2(whole, 256).alias("_digest"),
        F.char_length(whole).alias("_length"),
    ).groupBy("_digest", "_length").agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """doc_id, digest, licence of the whole text or NULL, licences of its lines, their number."""
    spark = docs.sparkSession
    listed = known_digests(spark, known)
    # A text whose length no known text has is none of them.
    lengths = [r[0] for r in listed.select("_length").distinct().collect()] or [-1]
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("_row"),
        canonical_lines(F.coalesce("text", F.lit(""))).alias("_lines"),
    )
    short = F.filter("_lines", lambda x: F.char_length(x).isin(lengths))
    rows = rows.select(
        "doc_id",
        "_row",
        F.sha2(F.array_join("_lines", " "), 256).alias("digest"),
        F.transform(short, lambda x: F.sha2(x, 256)).alias("_short"),
    )
    units = rows.select(
        "doc_id",
        "_row",
        "digest",
        F.posexplode(F.concat(F.array("digest"), "_short")).alias("_place", "_digest"),
    )
    # At most MAX_KNOWN digests.
    found = units.join(F.broadcast(listed), "_digest", "left")
    return (
        found.groupBy("_row", "doc_id", "digest")
        .agg(
            F.min(F.when(F.col("_place") == 0, F.col("licence"))).alias("licence"),
            F.array_join(
                F.sort_array(F.collect_set(F.when(F.col("_place") > 0, F.col("licence")))), ","
            ).alias("line_licences"),
            F.count(F.when(F.col("_place") > 0, F.col("licence"))).alias("n_licence_lines"),
        )
        .drop("_row")
    )


def scan_sql(known: Sequence[tuple[str, str]] = KNOWN) -> str:
    """The same in SQL."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def lines(text: str) -> str:
        line = "l"
        for pattern, put in SPELLINGS:
            line = f"regexp_replace({line}, {quoted(pattern)}, {quoted(put)}, 'g')"
        bare = f"regexp_replace(lower({text}), {quoted('(?m)' + COPYRIGHT)}, '', 'g')"
        split = f"string_split({bare}, chr(10))"
        clean = f"trim(regexp_replace({line}, {quoted(BREAKS)}, ' ', 'g'))"
        return f"list_filter(list_transform({split}, lambda l: {clean}), lambda l: l <> '')"

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known)
    return f"""
WITH known AS (
  SELECT sha256(array_to_string(lines, ' ')) AS digest, min(licence) AS licence
  FROM (SELECT licence, {lines("text")} AS lines FROM (VALUES {values}) AS v(licence, text))
  WHERE len(lines) > 0 GROUP BY 1
), rows AS (
  SELECT row_number() OVER () AS r, doc_id, {lines("coalesce(text, '')")} AS lines FROM documents
), digests AS (
  SELECT r, doc_id, lines, sha256(array_to_string(lines, ' ')) AS digest FROM rows
), held AS (
  SELECT r, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS line_licences, count(*) AS n
  FROM (SELECT r, unnest(lines) AS line FROM digests) u JOIN known k ON sha256(u.line) = k.digest
  GROUP BY r
)
SELECT d.doc_id, d.digest, k.licence, coalesce(h.line_licences, '') AS line_licences,
       coalesce(h.n, 0) AS n_licence_lines
FROM digests d LEFT JOIN known k ON d.digest = k.digest LEFT JOIN held h ON d.r = h.r
"""
