"""Licence scan: a canonical digest of every whole text, hash-joined to digests of known licences.

Canonical form: A-Z lower-cased, copyright lines removed, everything but letters and digits read
as a space, equivalent spellings replaced. Two texts with the same form have the same digest.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldquarry.llm.url_filter import LOWER, UPPER

# Lines that name an owner, not the terms.
COPYRIGHT_LINE = (
    r"(?m)^[^a-z0-9\n]*(?:copyright\b[^\n]*(?:[0-9]{4}|\(c\)|©)|\(c\)[^\n]*[0-9]{4}|©|all rights reserved)[^\n]*$"
)
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"

# Equivalent spellings in licence texts.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("colour", "color"),
    ("emphasise", "emphasize"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("merchantibility", "merchantability"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("owner", "holder"),
    ("owners", "holders"),
    ("practise", "practice"),
    ("programme", "program"),
    ("recognised", "recognized"),
    ("utilise", "utilize"),
    ("wilful", "willful"),
]

# Known licences and licence notices.
KNOWN = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT-notice", "Released under the MIT License."),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution.""",
    ),
]


def canonical(text: Column) -> Column:
    """The canonical words of a text, each with a space on either side."""
    lowered = F.translate(text, UPPER, LOWER)
    terms = F.regexp_replace(lowered, COPYRIGHT_LINE, "")
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(terms, NOT_WORD, "  ")), F.lit(" "))
    for other, common in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {other} "), F.lit(f" {common} "))
    return spaced


def digest(text: Column) -> Column:
    """Digest of the canonical words; null for a null text and for a text without words."""
    words = canonical(text)
    return F.when(F.trim(words) != "", F.sha2(words, 256))


def known_licenses(spark: SparkSession, known=None) -> DataFrame:
    """One row per digest of the known licences (license_id, digest): as many rows as the list has texts at most."""
    table = spark.createDataFrame(KNOWN if known is None else known, "license_id string, text string")
    keyed = table.select("license_id", digest(F.col("text")).alias("digest"))
    return keyed.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, doc="doc_id", text="text") -> DataFrame:
    """doc_id, digest and license_id of every document; license_id is null where no known text is the same.

    Null texts and texts without words have no digest. Repeated rows each get a row. The known
    side defaults to the list above, whose size is fixed; it is broadcast only then.
    """
    fixed = known is None
    known = known_licenses(docs.sparkSession) if fixed else known
    keyed = docs.select(F.col(doc).alias("doc_id"), digest(F.col(text)).alias("digest"))
    return keyed.join(F.broadcast(known) if fixed else known, "digest", "left").select("doc_id", "digest", "license_id")
