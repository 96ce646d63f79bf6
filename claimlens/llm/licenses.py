"""Licence scan by canonical digest.

A text is brought into a canonical form (case, punctuation, copyright lines,
equivalent spellings) and the digest of all of it is looked up among the digests
of known licences by a hash join. Each line of a document, and each paragraph (the
lines between two blank ones, joined), is looked up likewise, as a text of its own, so
a notice that is wrapped inside a longer document is found. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known notices (fixed values): licence id, text.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "The MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    *((name, " ".join(("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
      "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
      "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
      *third,
      "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")))
      for name, third in (("BSD-2-Clause", ()), ("BSD-3-Clause", ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",)))),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *((name, f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
      for name, kind in (("GPL-3.0", "General Public License"), ("LGPL-3.0", "Lesser General Public License"), ("AGPL-3.0", "Affero General Public License"))),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
)
#: Equivalent spellings, one word each (fixed values).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("behaviour", "behavior"), ("cancelled", "canceled"), ("favour", "favor"), ("fulfil", "fulfill"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelled", "labeled"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("neighbouring", "neighboring"), ("noninfringment", "noninfringement"), ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)
#: A line that begins with a copyright mark or claim (and a year, mark or name after the word, so that
#: a wrapped sentence whose line begins with it stays), after marks that no word holds.
COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright *(\(c\)|©|[0-9]{4}|by |<|\[|:)|\(c\)|©|all rights reserved)[^\n]*$"
#: What separates words in a line: all ASCII but letters and digits.
BETWEEN = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"
#: One blank line or more in a canonical text.
BLANK = r"\n *\n[ \n]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_lines(text):
    """Canonical form of a text column, line by line: words in lower case, two
    blanks between, one before and after, lines still apart."""
    c = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    c = F.regexp_replace(c, COPYRIGHT, "")
    c = F.regexp_replace(c, BETWEEN, "  ")
    c = F.concat(F.lit(" "), F.replace(c, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for own, usual in SPELLINGS:
        c = F.replace(c, F.lit(f" {own} "), F.lit(f" {usual} "))
    return c


def digest(lines):
    """Digest of a whole canonical text, whose line ends are as good as blanks."""
    return F.sha2(F.trim(F.regexp_replace(lines, "[ \n]+", "  ")).cast("binary"), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(canonical_digest, license_id) of the known texts, of equal ones the first id by name."""
    rows = spark.createDataFrame([(a, b) for a, b in known], "license_id string, text string")
    return rows.groupBy(digest(canonical_lines(F.col("text"))).alias("canonical_digest")).agg(F.min("license_id").alias("license_id"))


def known_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Licence texts from a folder of text files, each named by its id: full licences that are too
    long to stand in code. As many texts as files reach the driver."""
    own = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*?)(\.txt)?$", 1).alias("id"), "value")
    return [(r["id"], r["value"]) for r in own.collect()]


def scan(docs: DataFrame, known=KNOWN) -> DataFrame:
    """(doc_id, canonical_digest, license_id, line_licenses, block_licenses), one row per row of ``docs``.

    ``license_id``: the licence whose canonical digest the entire text has, else
    null; ``line_licenses`` and ``block_licenses``: ids, in order and comma-joined, of the licences
    that a whole line or a whole paragraph has. A null text is empty; texts without a word
    match nothing. ``known``: (id, text) pairs, ``KNOWN`` and ``known_files`` for instance."""
    table = known_digests(docs.sparkSession, known)  # as many rows as ``known`` at most
    by_digest = F.create_map(*[F.lit(x) for r in table.collect() for x in r])
    own = docs.select("doc_id", canonical_lines(F.col("text")).alias("_lines"))
    found = lambda x: F.try_element_at(by_digest, x)
    lines = F.transform(F.split("_lines", "\n"), lambda x: found(F.sha2(F.trim(x).cast("binary"), 256)))
    # only text with more than one line has paragraphs that are neither lines nor all of it
    blocks = F.transform(F.filter(F.split("_lines", BLANK), lambda x: F.contains(x, F.lit("\n"))), lambda x: found(digest(x)))
    ids = lambda x: F.array_join(F.array_sort(F.array_distinct(F.filter(x, lambda y: y.isNotNull()))), ",")
    rows = own.select("doc_id", digest(F.col("_lines")).alias("canonical_digest"), ids(lines).alias("line_licenses"), ids(blocks).alias("block_licenses"))
    return rows.join(F.broadcast(table), "canonical_digest", "left").select("doc_id", "canonical_digest", "license_id", "line_licenses", "block_licenses")
