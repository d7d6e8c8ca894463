"""License scans by canonical digest lookup, in DataFrame functions alone.

A text is brought to a canonical form: the lines before a license go (a known title, copyright lines with or without a year,
"All rights reserved"), as do copyright lines with a year further on and the marks of lists; letters become lower case, every run of
characters that are neither letters nor digits becomes one space, equivalent spellings and the names that a BSD license protects become
one, and directions for use after the end of the terms go where they are no longer than 3,000 characters.
The SHA-256 digest of the canonical text is looked up in a table of known digests by a hash join. `scan` looks up
entire texts, and, by the same digests, lines that are statements of their own in a longer text.

Defined cases: null texts, and texts whose canonical form is empty, match nothing; repeated rows match each;
a license given in several spellings under one name counts once; where one canonical text has several names, the
first in alphabetical order counts. Every line is looked up, of whatever length and words, and texts
of any length are read whole. Other columns are not read. An empty table of licenses matches nothing.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Statements and short texts of well-known licenses.
LICENSES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache Licence, Version 2.0 (the \"License\")"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("All-Rights-Reserved", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
]

BLANK = r"[ \t\r\f]"
#: What stands before the words of a line in comments.
COMMENT = r"(?:[/*#;!-]+[ \t]*)?"
#: A line that names a holder or year of copyright and nothing else.
COPYRIGHT_LINE = rf"(?mid)^{BLANK}*{COMMENT}(?:copyright\b[^\n]*[0-9]{{4}}|copyright[ \t]*(?:\(c\)|©|\[yyyy\]|<year>)|\(c\)|©)[^\n]*$"
#: The number or letter of a list entry or section.
LIST_MARK = rf"(?mid)^{BLANK}*{COMMENT}(?:[0-9]{{1,2}}|[a-z])[.)][ \t]+"
# Titles of licenses whose files carry one or none.
TITLE = (
    r"(?:the )?(?:mit|expat|isc|zlib|zlib/libpng|(?:(?:new|simplified|revised|modified) )?bsd(?:[ -](?:[0-9]|zero)[ -]clause)?"
    r"(?: \"?(?:simplified|new|revised)\"?(?: or \"?revised\"?)?)?) licen[cs]e(?: \([^\n]*\))?|(?:the )?unlicense"
)
#: The lines before a license: its title, holders of copyright with or without year, and the reservation of rights.
HEAD = rf"(?i)\A[\s/*#;!=-]*(?:(?:{TITLE}|copyright\b[^\n]*|\(c\)[^\n]*|©[^\n]*|all rights reserved\.?){BLANK}*\n[\s/*#;!=-]*){{1,40}}"
NOT_WORD = r"[^\p{L}\p{N}]+"
# Spellings that count as one.
SPELLINGS = [
    (r"\blicence(s?)\b", "license$1"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon infring", "noninfring"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bwhilst\b", "while"),
    (r"\bneither the names? of (?:[^ ]+ ){1,12}nor\b", "neither the name of the copyright holder nor"),
]
#: Where the terms of some licenses end, and how the directions for use begin that may follow.
END_OF_TERMS = " end of terms and conditions"
DIRECTIONS = rf"^{END_OF_TERMS}( (?:appendix )?how to apply .*)?$"
#: Directions for use have at most so many characters; what is longer is a text of its own.
LONGEST_DIRECTIONS = 3000


def without_head(text: Column) -> Column:
    """The text without the lines that stand before a license; a text of nothing else keeps them."""
    rest = F.regexp_replace(text, HEAD, " ")
    return F.when(rest.rlike(r"[\p{L}\p{N}]"), rest).otherwise(text)


def _once(value: Column, body) -> Column:
    """body of value, with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(without_head(text), COPYRIGHT_LINE, " "), LIST_MARK, " ")
    plain = F.trim(F.regexp_replace(F.lower(plain), NOT_WORD, " "))

    def respelled(x: Column) -> Column:
        out = x
        for pattern, to in SPELLINGS:
            out = F.regexp_replace(out, pattern, to)
        return F.when(x.rlike("|".join(pattern for pattern, _ in SPELLINGS)), out).otherwise(x)

    def terms(x: Column) -> Column:
        own = F.substring_index(x, END_OF_TERMS, 1)
        rest = F.substring(x, F.length(own) + 1, F.length(x))
        short = F.length(x) - F.length(own) <= LONGEST_DIRECTIONS
        return F.when(x.contains(END_OF_TERMS), F.when(short & rest.rlike(DIRECTIONS), own).otherwise(x)).otherwise(x)

    return _once(_once(plain, respelled), terms)


def full_texts() -> list[tuple[str, str]]:
    """License and text of each file in the folder of full texts; read on the driver."""
    return [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]


def known(spark: SparkSession, licenses: list[tuple[str, str]] | None = None) -> DataFrame:
    """digest, license of known texts."""
    table = spark.createDataFrame(LICENSES + full_texts() if licenses is None else licenses, "license string, text string")
    # on one line, a text keeps what in lines of its own counts as a holder of copyright
    one_line = lambda t: F.regexp_replace(t, r"\s+", " ")
    body = without_head(F.col("text"))
    forms = table.select("license", F.explode(F.array(F.col("text"), one_line(F.col("text")), one_line(body))).alias("text"))
    return (
        forms.select("license", canonical(F.col("text")).alias("form"))
        .where("form <> ''")
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("license").alias("license"))
    )


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """doc_id, place, digest, license: a row of place 0 for every entire text (license is null unless it is known), and a row for
    each line (from 1) that is a known text by itself."""
    text = F.col("text").cast("string")
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: F.struct((i + 1).alias("place"), x.alias("unit")))
    units = F.concat(F.array(F.struct(F.lit(0).alias("place"), text.alias("unit"))), lines)
    form = F.col("form")
    return (
        docs.select("doc_id", F.explode(units).alias("u"))
        .select("doc_id", "u.place", canonical(F.col("u.unit")).alias("form"))
        .select("doc_id", "place", F.when(form != "", F.sha2(form, 256)).alias("digest"))
        # every line takes part: the known texts go to the lines, not the lines through a shuffle
        .join(F.broadcast(licenses.select("digest", "license")), "digest", "left")
        .where("place = 0 or license is not null")
        .select("doc_id", "place", "digest", "license")
    )
