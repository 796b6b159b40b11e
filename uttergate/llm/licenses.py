"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

A text is cut into words and these into five-word shingles. For each class of template lengths the words are covered by
windows of twice that length at half-window steps, so any span up to the class length lies within one. A window's set
for a license has those of its shingles that the license's template has too, since others can't add to a containment;
what stands beside a notice therefore doesn't hide it, and the Jaccard similarity of such a set and the template's is the
containment. MinHash samples of the sets make ``BANDS`` bands of ``ROWS``; a window that shares a band with a template is
a candidate, and those are compared on their full sets. A window of containment c is missed with a chance of
``(1 - c ** ROWS) ** BANDS``: 1e-11 at 0.8, none at 1.

Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
CLASSES = tuple(1 << k for k in range(3, 31))  # no text has more words
STRETCH = 1.25  # room for words put in
BANDS, ROWS = 25, 2
BROADCAST_SHINGLES = 1 << 20  # more shingles of templates than this are joined by a shuffle

# Wordings of public licenses and license notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions",
    "Apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
    "express or implied.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
    "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
    "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
    "the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
    "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
    "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
    "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
    "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
    "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
    "original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
    "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
    "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
    "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
    "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative "
    "works are solely in the form of machine-executable object code generated by a source language processor.",
}


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, length: Column) -> Column:
    """Place and hash of every ``length`` words on end."""
    n = F.size(words)
    places = F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(words, i + 1, length)).alias("h")))


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """``license``, ``class`` and the distinct shingle hashes ``own`` of each template; one of under five words is one shingle."""
    listed = spark.createDataFrame(sorted((templates or TEMPLATES).items()), "license string, wording string")
    cut = listed.withColumn("words", tokens(F.col("wording"))).where(F.size("words") > 0)
    fits = F.array_min(F.filter(F.array(*map(F.lit, CLASSES)), lambda c: c >= F.size("words") * STRETCH))
    own = F.array_distinct(F.transform(_shingles(F.col("words"), F.least(F.lit(SHINGLE), F.size("words"))), lambda s: s["h"]))
    return cut.select("license", fits.alias("class"), own.alias("own"), "words")


def _samples(h: Column) -> list[Column]:
    """MinHash samples of the hashes of a group."""
    return [F.min(F.xxhash64(h, F.lit(k))).alias(f"m{k}") for k in range(BANDS * ROWS)]


def _bands() -> Column:
    """Bucket keys of the samples; a key holds the number of its band."""
    return F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{ROWS * b + r}") for r in range(ROWS)]) for b in range(BANDS)])


def license_matches(df: DataFrame, templates: dict[str, str] | None = None, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``license``, ``containment`` (0.8 to 1, of the fullest window) and ``windows`` (how many match).

    A row for each license of which a document's window holds at least 80 percent of the shingles. Null and empty
    texts match nothing; rows equal in id and text are reported once; a null id stays null. An empty table gives
    none. Other columns are left aside.
    """
    wanted = template_table(df.sparkSession, templates)
    known = wanted.select("license", "class", F.size("own").alias("total"), F.explode("own").alias("h"))
    signed = known.groupBy("license").agg(*_samples(F.col("h")))
    buckets = signed.select("license", F.explode(_bands()).alias("key"))
    shape = wanted.agg(F.collect_set(F.least(F.lit(SHINGLE), F.size("words"))), F.sum(F.size("own"))).first()
    few = (shape[1] or 0) <= BROADCAST_SHINGLES
    small = F.broadcast if few else (lambda x: x)

    cut = df.select(F.col(row_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("body"), tokens(F.col(text).cast("string")).alias("words"))
    places = F.concat(*[_shingles(F.col("words"), F.lit(n)) for n in sorted(shape[0] or [SHINGLE])])
    hits = cut.select("doc_id", "body", F.explode(places).alias("s")).select("doc_id", "body", "s.at", "s.h")
    met = hits.join(small(known), "h")
    steps = F.array(*[F.floor(F.col("at") / F.col("class")) - back for back in (0, 1)])
    of = ["doc_id", "body", "license", "total", "window"]
    windows = met.withColumn("window", F.explode(steps)).groupBy(*of).agg(F.collect_set("h").alias("found"), *_samples(F.col("h")))
    asked = windows.select(*of, "found", F.explode(_bands()).alias("key"))
    candidates = asked.join(small(buckets), ["license", "key"]).groupBy(*of).agg(F.first("found").alias("found"))
    scored = candidates.withColumn("containment", F.size("found") / F.col("total")).where(F.col("containment") >= CONTAINED)
    return scored.groupBy("doc_id", "body", "license").agg(F.max("containment").alias("containment"), F.count_distinct("window").alias("windows")).drop("body")
