"""License scans: headers and license files against templates, inherited by directories.

Templates and texts are sparse TF-IDF vectors; the weights of terms come from the templates,
and a term that no template has weighs most. A header is a window of lines (``WINDOWS``, from any
line with a telling term on) whose cosine with a usual notice, a standard header or a short license
reaches ``SIMILAR``. A text that reaches it as a whole, with these or the full license texts, is a
license file of any length, and gives its license to its directory. A document without a
header of its own takes the license of the nearest directory above it that has one: its path is
joined with all its ancestors.

An SPDX identifier is one term, known or not, and no license file. Names of copyright holders are
left out. If several versions of a license are equally similar, the name without version is given.
"Proprietary" counts only where no license does.

Only windows that begin with a line with a *telling* term are scored. Telling terms are chosen so that
the others alone cannot bring any template to the threshold. Whole texts are scored if they have
terms enough for that (``strong_and_weak``), which loses no file.
Templates are a fixed short list and are broadcast; directories with a license are joined by name
and broadcast only after a count.

Null texts have no lines. Of several headers in a document the most similar counts, then the
first name; of several license files in a directory the license of most files, then the first
name. Null paths are in no directory. Repeated rows get a row each. Documents without any license
have null. Built-in expressions only; other columns are not read.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storytide.llm.runtime import stored
from storytide.workspace import broadcast_if_small

SIMILAR = 0.6
WINDOWS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)  # lines of a header
SPDX = "spdx-license-identifier:"
WEAK = 8  # terms of small weight that do not make a license file yet
SPDX_WEIGHT = 4  # an identifier says more than the words beside it

# The usual notices of well-known licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright, CC0 1.0 public domain dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)

_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as
published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details.
You should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""

# Standard headers, and notices without a version (named by their family).
STANDARD = (
    ("Apache-2.0", _APACHE),
    ("GPL-2.0", _GNU.format("General Public License", 2)),
    ("GPL-3.0", _GNU.format("General Public License", 3)),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", 2.1)),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", 3)),
    ("AGPL-3.0", _GNU.format("Affero General Public License", 3)),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL", "Licensed under the GNU General Public License."),
    ("LGPL", "Licensed under the GNU Lesser General Public License."),
    ("AGPL", "Licensed under the GNU Affero General Public License."),
    ("GPL", "Licensed under the GPL."),
    ("GPL-2.0", "Licensed under the GPL version 2, GPLv2."),
    ("GPL-3.0", "Licensed under the GPL version 3, GPLv3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for license information."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("proprietary", "Copyright. All rights reserved."),
)

_EXACT = "0BSD Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 ISC MIT MPL-2.0 Unlicense Zlib"
_GNU_NAMES = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
IDENTIFIERS = tuple(
    [(x, f"{SPDX} {x}") for x in _EXACT.split()] + [(x, f"{SPDX} {x}{end}") for x in _GNU_NAMES for end in ("", "+", "-only", "-or-later")]
)

# Full texts; the short ones are also used as headers.
FULL = tuple((p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))
SHORT_LICENSE = 2000  # characters of a license that is put into the head of a source file
HEADERS = (*TEMPLATES, *STANDARD, *((n, t) for n, t in FULL if len(t) <= SHORT_LICENSE), *IDENTIFIERS)
FILES = (*TEMPLATES, *STANDARD, *FULL)

# Words that say nothing about a license; they have no weight in any text.
STOP_WORDS = ("a", "all", "and", "are", "as", "at", "be", "by", "for", "has", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "use", "with")

_WORD = SPDX + r" [a-z0-9]+(?:[.+-][a-z0-9]+)*\+?|[a-z0-9]+(?:\.[0-9]+)*"
# a copyright line up to the holder's name
_HOLDER = r"(?:copyright\s*)?(?:\(c\)|©|copyright)\s*(?:19|20)\d\d[^\n]{0,80}?(?=all rights reserved|licensed|released|permission|redistribution|spdx-|\n|$)"


def terms_of(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(f"({_WORD})"), F.lit(1))
    return F.filter(found, lambda t: ~t.isin(*STOP_WORDS))


class Weights:
    """Term weights and unit vectors of the templates."""

    def __init__(self, templates=HEADERS):
        bags = [(name, [t for t in re.findall(_WORD, text.lower()) if t not in STOP_WORDS]) for name, text in templates]
        frequency: dict[str, int] = {}
        for _, bag in bags:
            for term in set(bag):
                frequency[term] = frequency.get(term, 0) + 1
        # identifiers are no sample of the words of licenses
        texts = 1 + sum(not text.lower().startswith(SPDX) for _, text in templates)
        self.unknown = math.log(texts) + 1
        self.idf = {t: SPDX_WEIGHT * self.unknown if t.startswith(SPDX) else math.log(texts / (1 + n)) + 1 for t, n in frequency.items()}
        self.vectors = []
        for number, (name, bag) in enumerate(bags):
            raw = {t: bag.count(t) * self.idf[t] for t in set(bag)}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            self.vectors += [(f"{name}#{number}", t, v / norm) for t, v in sorted(raw.items())]

    def telling(self, threshold: float) -> list[str]:
        """Terms of each template, until its others cannot reach the threshold. Long terms are
        taken first, as they are rare in other texts. What an earlier template has chosen is used again."""
        out: set[str] = set()
        for name in sorted({n for n, _, _ in self.vectors}):
            rest = 1.0
            mine = [(t not in out, len(t) < 5, -v * v, -len(t), t) for n, t, v in self.vectors if n == name]
            for _, _, weight, _, term in sorted(mine):
                if rest < threshold**2 * 0.999:
                    break
                out.add(term)
                rest += weight
        return sorted(out)


    def strong_and_weak(self, threshold: float) -> tuple[set[str], set[str]]:
        """A text that reaches the threshold has a strong term, or more than ``WEAK`` weak ones: by
        Cauchy-Schwarz its terms hold threshold squared of the template's squared weight."""
        largest: dict[str, float] = {}
        for _, t, v in self.vectors:
            largest[t] = max(largest.get(t, 0.0), v * v)
        strong = {t for t, v in largest.items() if v > threshold**2 * 0.999 / WEAK}
        return strong, set(largest) - strong


def similarities(pieces: DataFrame, keys: list[str], weights: Weights) -> DataFrame:
    """``keys, license, score``: the most similar license of each piece (``keys``, ``terms``).

    The name without a version if several versions are equally similar.
    Each term is a row with its count in the piece; rows are narrow and keyed by piece.
    """
    spark = pieces.sparkSession
    idf = F.broadcast(spark.createDataFrame(sorted(weights.idf.items()), "term string, idf double"))
    vectors = F.broadcast(spark.createDataFrame(weights.vectors, "license string, term string, w double"))
    counted = pieces.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(idf, "term", "left").withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(weights.unknown)))
    norms = Window.partitionBy(*keys)
    weighed = weighed.withColumn("norm", F.sqrt(F.sum(F.col("v") * F.col("v")).over(norms)))
    scored = weighed.join(vectors, "term").groupBy(*keys, "norm", "license").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    scored = scored.withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= SIMILAR)
    name = F.substring_index("license", "#", 1)
    family = F.regexp_replace(name, "-[0-9].*$", "")
    ties = scored.groupBy(*keys, "score").agg(F.min(name).alias("first"), F.max(name).alias("last"), F.min(family).alias("f"), F.max(family).alias("g"))
    named = F.when((F.col("first") != F.col("last")) & (F.col("f") == F.col("g")), F.col("f")).otherwise(F.col("first"))
    best = F.min(F.struct((-F.col("score")).alias("minus"), named.alias("license"))).alias("best")
    return ties.groupBy(*keys).agg(best).select(*keys, "best.license", (-F.col("best.minus")).alias("score"))


def _words(terms) -> Column:
    return F.array(*map(F.lit, sorted(terms)))


def scan(docs: DataFrame, path: Column, weights: Weights | None = None) -> DataFrame:
    """``doc_id, path, license, score, found``: found in a ``header``, a ``file`` or ``inherited``.

    ``weights`` replace the templates of headers and of files. Pieces are keyed by a hash of the
    window (or of the text) and scored once for each distinct one, so a notice in a third of all
    documents is one small group.
    """
    kinds = {"header": weights or Weights(HEADERS), "file": weights or Weights(FILES)}
    telling = _words(kinds["header"].telling(SIMILAR))
    strong, weak = map(_words, kinds["file"].strong_and_weak(SIMILAR))
    clean = F.regexp_replace(F.regexp_replace(F.lower("text"), SPDX + r"[ \t]*\(?", SPDX + " "), _HOLDER, "copyright ")
    own_key = F.xxhash64("doc_id", path, "text")  # rows of one id and path may differ in their text
    rows = docs.select(own_key.alias("_doc"), clean.alias("whole"))
    rows = rows.withColumn("terms", F.array_distinct(terms_of(F.col("whole"))))
    may_be_file = F.arrays_overlap("terms", strong) | (F.size(F.array_intersect("terms", weak)) > WEAK)
    rows = rows.select("_doc", "whole", F.arrays_overlap("terms", telling).alias("heads"), may_be_file.alias("may_be_file"))
    rows = rows.where("heads or may_be_file")
    rows = rows.withColumn("lines", F.when(F.col("heads"), F.split("whole", "\n")).otherwise(F.array().cast("array<string>")))
    starts = F.filter(F.transform("lines", lambda x, i: F.when(F.arrays_overlap(terms_of(x), telling), i + 1)), lambda i: i.isNotNull())

    def windows(i: Column) -> Column:
        return F.array(*(F.array_join(F.slice("lines", i, F.lit(n)), "\n") for n in WINDOWS))

    headers = F.array_distinct(F.flatten(F.transform(starts, windows)))
    plain = F.regexp_replace("whole", SPDX + r" \S+", " ")
    none = F.array().cast("array<struct<found:string,piece:string>>")
    tagged = rows.select(
        "_doc",
        F.explode(
            F.concat(
                F.transform(headers, lambda x: F.struct(F.lit("header").alias("found"), x.alias("piece"))),
                F.when(F.col("may_be_file"), F.array(F.struct(F.lit("file").alias("found"), plain.alias("piece")))).otherwise(none),
            )
        ).alias("p"),
    ).select("_doc", "p.found", "p.piece")
    tagged = stored(tagged.withColumn("_piece", F.xxhash64("piece")), "pieces")
    known = []
    for kind, of_kind in kinds.items():
        distinct = tagged.where(F.col("found") == kind).groupBy("_piece").agg(F.first("piece").alias("piece"))
        distinct = distinct.select("_piece", terms_of(F.col("piece")).alias("terms"))
        known.append(similarities(distinct, ["_piece"], of_kind).withColumn("found", F.lit(kind)))
    known = stored(known[0].unionByName(known[1]), "known")
    hits = tagged.join(broadcast_if_small(known), ["_piece", "found"]).select("_doc", "found", "license", "score")
    order = F.struct((F.col("license") == "proprietary").alias("last"), (-F.col("score")).alias("minus"), "license")
    own = hits.groupBy("_doc").agg(
        F.min(F.when(F.col("found") == "header", order)).alias("header"),
        F.min(F.when(F.col("found") == "file", order)).alias("file"),
    )
    named = docs.select("doc_id", path.alias("path"), own_key.alias("_doc"))
    full = named.join(own, "_doc", "left")

    steps = F.split("path", "/")
    depth = F.size(steps) - 1
    files = full.where("file is not null and path is not null").select(F.array_join(F.slice(steps, 1, depth), "/").alias("dir"), "file.license")
    votes = files.groupBy("dir", "license").agg(F.count("*").alias("n"))
    chosen = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("minus"), "license")).alias("best"))
    given = chosen.select("dir", F.col("best.license").alias("dir_license"))
    # directories are few beside documents: the ancestors of each directory are joined, not of each document
    places = full.where("path is not null").select(F.array_join(F.slice(steps, 1, depth), "/").alias("place")).distinct()
    above = places.withColumn("level", F.explode(F.sequence(F.lit(0), F.size(F.split("place", "/")))))
    above = above.withColumn("dir", F.array_join(F.slice(F.split("place", "/"), F.lit(1), F.col("level")), "/"))
    nearest = above.join(broadcast_if_small(given), "dir").groupBy("place").agg(F.max_by("dir_license", "level").alias("dir_license"))
    out = full.withColumn("place", F.array_join(F.slice(steps, 1, depth), "/")).join(broadcast_if_small(nearest), "place", "left")
    found = (
        F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header").when(F.col("dir_license").isNotNull(), "inherited")
    )
    return out.select(
        "doc_id",
        "path",
        F.coalesce("file.license", "header.license", "dir_license").alias("license"),
        (-F.coalesce("file.minus", "header.minus")).alias("score"),
        found.alias("found"),
    )


def document_path() -> Column:
    """Documents as files of a tree: a directory for each source, in it one for each language, in it one for
    each hundred ids, in it one for each ten. Ids that end in 00 lie in the language's directory, others
    that end in 0 in that of their hundred, the rest at the bottom."""
    unknown = F.lit("unknown")
    number = F.col("doc_id").cast("long")
    hundred = F.concat(F.lit("h"), F.floor(number / 100).cast("string"))
    ten = F.concat(F.lit("t"), F.floor(number / 10).cast("string"))
    inner = F.when(number.isNull() | (number % 100 == 0), F.lit(None)).when(number % 10 == 0, hundred).otherwise(F.concat_ws("/", hundred, ten))
    # concat_ws leaves out a directory that is null
    return F.concat_ws("/", F.coalesce("source", unknown), F.coalesce("lang", unknown), inner, F.coalesce(F.col("doc_id").cast("string"), unknown))


def report(docs: DataFrame) -> DataFrame:
    return scan(docs, document_path())
