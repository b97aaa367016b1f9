"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

Candidates are all lines of a file that speak of licensing, the blocks of several lines between lines
without a letter or digit that do, so that a wrapped notice is judged whole, and for licence files
the whole text as well.  Document frequencies come from all candidates.  A candidate's vector meets the
templates' in a join by term; only the templates, whose number is fixed, are broadcast.

A file without a licence of its own takes that of the nearest ancestor directory, its own
directory first, that holds a recognised licence file.  Ancestors are resolved once per
directory by joins on paths, so a directory with very many files is resolved once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

LEAST_COSINE = 0.6
CUE = r"(?i)licen[cs]|copyright|spdx|warrant|redistribut|permission is hereby"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][A-Za-z0-9.-]*)?$"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Between blocks; possessive, since Java recurses for every repetition of a group otherwise.
BETWEEN_BLOCKS = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
CANDIDATE = ["path", "digest", "line"]

# Names of licences and the customary notices.
BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_THIRD = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_DISCLAIMER = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_DISCLAIMER = ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
MIT_REST = ' The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
APACHE_NOTICE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", BSD_CONDITIONS + BSD_THIRD),
    ("BSD-3-Clause", BSD_CONDITIONS + BSD_THIRD + BSD_DISCLAIMER),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", BSD_CONDITIONS),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("ISC", "Released under the ISC License."),
    ("ISC", ISC_GRANT),
    ("ISC", ISC_GRANT + ISC_DISCLAIMER),
    ("MIT", MIT_GRANT),
    ("MIT", MIT_GRANT + MIT_REST),
    ("Apache-2.0", APACHE_NOTICE),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def candidates(files: DataFrame) -> DataFrame:
    """path, digest, line, text: lines and blocks with a cue, and the whole text of licence files.

    A block, which has two lines at least, counts as line -2, -3, ..., a whole text as line -1.

    The digest of the whole text tells rows apart that share a path; rows equal in both count
    their terms together, which turns no vector.
    """
    whole = F.when(
        F.col("path").rlike(LICENSE_FILE), F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("text")))
    ).otherwise(F.from_json(F.lit("[]"), "array<struct<line:int,text:string>>"))
    lines = F.transform(
        F.split("text", "\n", -1), lambda t, k: F.struct(k.alias("line"), t.alias("text"))
    )
    cued = F.filter(lines, lambda s: s["text"].rlike(CUE))
    blocks = F.transform(
        F.split("text", BETWEEN_BLOCKS, -1), lambda t, k: F.struct((-2 - k).alias("line"), t.alias("text"))
    )
    wrapped = F.filter(blocks, lambda s: s["text"].contains("\n") & s["text"].rlike(CUE))
    return files.where(F.col("text").rlike(CUE)).select(
        "path", F.xxhash64("text").alias("digest"), F.explode(F.concat(whole, cued, wrapped)).alias("c")
    ).select("path", "digest", "c.line", "c.text")


def _weighted(terms: DataFrame, frequency: DataFrame, n: int) -> DataFrame:
    """Adds the TF-IDF weight; terms that no candidate has count as seen in none."""
    idf = F.log((1 + F.lit(n)) / (1 + F.coalesce(F.col("df"), F.lit(0)))) + 1
    return terms.join(frequency, "term", "left").withColumn("weight", F.col("tf") * idf)


def own_licenses(files: DataFrame) -> DataFrame:
    """path, license, similarity of the files that resemble a template."""
    spark = files.sparkSession
    found = pin(candidates(files), "candidates")
    n = found.count()
    counted = (
        found.select(*CANDIDATE, F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy(*CANDIDATE, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    counted = pin(counted, "terms")
    # The key is made anew, so both sides of the join are shuffled and a hot term can be split.
    frequency = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        F.concat("term", F.lit("")).alias("term"), "df"
    )
    templates = spark.createDataFrame(
        [(k, name, text) for k, (name, text) in enumerate(TEMPLATES)], "template int, license string, notice string"
    )
    notice = (
        templates.select("template", "license", F.explode(_terms(F.col("notice"))).alias("term"))
        .groupBy("template", "license", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    notice = _weighted(notice, frequency, n)
    norms = notice.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    notice = notice.join(norms, "template").select(
        "template", "license", F.col("term").alias("key"), (F.col("weight") / F.col("norm")).alias("unit")
    )
    notice = F.broadcast(notice)  # as many rows as the templates have terms

    weighted = _weighted(counted, frequency, n)
    sizes = weighted.groupBy(*CANDIDATE).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("size"))
    dots = (
        weighted.join(notice, F.col("term") == F.col("key"))
        .groupBy(*CANDIDATE, "template", "license")
        .agg(F.sum(F.col("weight") * F.col("unit")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("size"), 6)
    return (
        dots.join(sizes, CANDIDATE)
        .withColumn("similarity", cosine)
        .where(F.col("similarity") >= LEAST_COSINE)
        .groupBy("path")
        .agg(F.min(F.struct(-F.col("similarity"), "license")).alias("best"))
        .select("path", F.col("best.license").alias("license"), (-F.col("best.col1")).alias("similarity"))
    )


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def _ancestors(folder: Column) -> Column:
    """The directory itself, its parents, and the root as the empty path, with depths."""
    parts = F.split(folder, "/")
    deep = F.when(folder == "", 0).otherwise(F.size(parts))
    return F.transform(
        F.sequence(F.lit(0), deep),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("folder")),
    )


def scan_licenses(files: DataFrame) -> DataFrame:
    """path, license, how, similarity, inherited_from for each row of (path, text).

    ``how`` is own, inherited or none.  Paths are compared as they are; rows that repeat a path
    are judged one by one and share its best licence.  Texts of any length are read whole.  Null and empty texts have no licence of their own.  A null path
    can neither have nor inherit one.  Ties go to the licence first in the alphabet.
    """
    rows = files.select(F.col("path").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = pin(own_licenses(rows.where(F.col("path").isNotNull())), "licenses")
    held = (
        own.where(F.col("path").rlike(LICENSE_FILE))
        .groupBy(directory(F.col("path")).alias("folder"))
        .agg(F.min(F.struct(-F.col("similarity"), "license")).alias("best"))
        .select(F.concat("folder", F.lit("")).alias("folder"), F.col("best.license").alias("license"))
    )
    folders = rows.where(F.col("path").isNotNull()).select(directory(F.col("path")).alias("below")).distinct()
    near = (
        folders.select("below", F.explode(_ancestors(F.col("below"))).alias("a"))
        .select("below", "a.depth", "a.folder")
        .join(held, "folder")
        .groupBy("below")
        .agg(F.max(F.struct("depth", "folder", "license")).alias("near"))
        .select(
            F.concat("below", F.lit("")).alias("below"),
            F.col("near.folder").alias("near_folder"),
            F.col("near.license").alias("near_license"),
        )
    )
    own = own.select(F.col("path").alias("own_path"), F.col("license").alias("own_license"), "similarity")
    paths = rows.select("path", directory(F.col("path")).alias("within"))
    joined = paths.join(own, F.col("path") == F.col("own_path"), "left").join(
        near, F.col("within") == F.col("below"), "left"
    )
    inherits = F.col("own_license").isNull() & F.col("near_license").isNotNull()
    return joined.select(
        "path",
        F.coalesce("own_license", "near_license").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("how"),
        "similarity",
        F.when(inherits, F.col("near_folder")).alias("inherited_from"),
    )
