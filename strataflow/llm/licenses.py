"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Units of comparison are, for each file whose text has a licence cue: every line with a cue, every paragraph with a cue (a header
of several lines, without its comment marks), and the whole text. A unit is a sparse vector of its terms weighted by
``tf * idf``; document frequencies count all units of all files and the templates, which are notices, standard headers and
whole licence texts. A unit takes the template with the highest cosine (ties: the first template) if that reaches
``THRESHOLD``; a file takes its best unit (ties: by name). Equal units are compared once, however many files hold them.

A licence file is one that its name or place marks as such, or one whose whole text reaches the threshold, however long it is.
A directory has the licence that most of its licence files have (ties: by name). A file without one of its own inherits from
the nearest directory above it that has one: each distinct directory is joined with its ancestors' paths and keeps the
deepest hit.

DataFrame operations only. Per row: ``license``, ``origin`` (own, inherited or none), ``similarity`` of the own unit, rounded to six
places. Defined cases: a null or empty text has no unit; a null path has no directory and inherits nothing; rows with equal id and
text, null ids included, share their result; columns named like an output are replaced, other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import stored

# Notices of common licences, their standard headers, and whole licence texts without the copyright line.
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_TWO_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_THIRD_CLAUSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: "
)
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
    "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
)
_APACHE_REST = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License."
)
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("AGPL-3.0", _GNU.format(name="Affero General Public License", version="3")),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + _APACHE_REST),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", _TWO_CLAUSES + _AS_IS),
    ("BSD-3-Clause", _TWO_CLAUSES + _THIRD_CLAUSE + _AS_IS),
    ("GPL-2.0", _GNU.format(name="General Public License", version="2")),
    ("GPL-3.0", _GNU.format(name="General Public License", version="3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", _ISC),
    ("LGPL-3.0", _GNU.format(name="Lesser General Public License", version="3")),
    ("MIT", _GRANT),
    ("MIT", "MIT License " + _GRANT + _MIT_REST),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
# Comment marks at the start of a line.
MARKS = "(?m)^[ \\t]*(?://+|/?[*]+/?|#+|;+|--+|%+|<!--)[ \\t]?"
PARAGRAPH = "\\n[ \\t]*\\n"
CUE = "(?i)licen[cs]e|copyright|spdx|public domain|permission is hereby granted|all rights reserved"
TERM = "[a-z]+|[0-9]+(?:[.][0-9]+)?"
THRESHOLD = 0.7
BROADCAST_BYTES = 16 << 20


def terms_of(col: Column) -> Column:
    return F.regexp_extract_all(F.lower(col), F.lit(f"({TERM})"))


def _units(files: DataFrame) -> DataFrame:
    """(id, text_key, unit, text, whole): lines and paragraphs with a cue, and the whole text, of every file with a cue.

    ``unit`` names a unit by the hash of its text, so that no step after the terms carries long texts.
    """
    noticed = files.where(F.col("text").rlike(CUE))
    plain = F.regexp_replace(F.replace("text", F.lit("\r"), F.lit("")), MARKS, "")
    parts = noticed.select("id", "text_key", plain.alias("plain")).select(
        "id", "text_key", "plain", F.concat(F.split("plain", "\n", -1), F.split("plain", PARAGRAPH, -1)).alias("parts")
    )
    cued = F.filter("parts", lambda part: part.rlike(CUE))
    units = F.array_distinct(F.concat(F.array("plain"), cued))
    return parts.select("id", "text_key", F.posexplode(units).alias("place", "text")).select(
        "id", "text_key", F.md5("text").alias("unit"), "text", (F.col("place") == 0).alias("whole")
    )


def _weighted(vectors: DataFrame, idf: DataFrame, key: list[str]) -> DataFrame:
    weighted = vectors.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy(*key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.join(norms, key)


def similarities(units: DataFrame) -> DataFrame:
    """(unit, license, similarity) of the best template for each distinct unit that reaches the threshold."""
    spark = units.sparkSession
    distinct = units.groupBy("unit").agg(F.count("*").alias("files"))
    texts = units.groupBy("unit").agg(F.count("*").alias("files"), F.first("text").alias("text"))
    tf = (
        texts.select("unit", "files", F.explode(terms_of(F.col("text"))).alias("term"))
        .groupBy("unit", "term").agg(F.count("*").alias("tf"), F.first("files").alias("files"))
    )
    templates = spark.createDataFrame([(i, *t) for i, t in enumerate(TEMPLATES)], "template int, license string, words string")
    own = templates.select("template", "license", F.explode(terms_of(F.col("words"))).alias("term")).groupBy(
        "template", "license", "term"
    ).agg(F.count("*").alias("tf"))
    total = distinct.agg((F.coalesce(F.sum("files"), F.lit(0)) + len(TEMPLATES)).alias("total")).scalar()
    frequency = tf.select("term", "files").unionByName(own.select("term", F.lit(1).cast("long").alias("files")))
    idf = frequency.groupBy("term").agg(F.sum("files").alias("df")).select(
        "term", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf")
    )
    left = _weighted(tf.select("unit", "term", "tf"), idf, ["unit"])
    right = _weighted(own, idf, ["template", "license"]).select(
        "template", "license", "term", F.col("weight").alias("other"), F.col("norm").alias("other_norm")
    )
    cosine = left.join(F.broadcast(right), "term").groupBy("unit", "template", "license").agg(
        F.round(F.sum(F.col("weight") * F.col("other")) / F.first("norm") / F.first("other_norm"), 6).alias("similarity")
    )
    return cosine.where(F.col("similarity") >= THRESHOLD).groupBy("unit").agg(
        F.min(F.struct((-F.col("similarity")).alias("less"), "template", "license")).alias("best")
    ).select("unit", "best.license", (-F.col("best.less")).alias("similarity"))


def _directory(path: Column) -> Column:
    """The path without its last part; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """A directory and all above it, the empty one last."""
    parts = F.split(directory, "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(directory == "", F.array(F.lit(""))).otherwise(F.concat(above, F.array(F.lit(""))))


def scan(
    df: DataFrame, path: Column, is_license_file: Column, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Append license, origin and similarity. ``path`` has parts joined by "/"; both columns are expressions on ``df``, and
    ``is_license_file`` marks files that are licence files by name."""
    # Given columns travel as one, so that none can clash with a name used here.
    rows = df.select(
        F.struct(*df.columns).alias("given"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"),
        _directory(path).alias("directory"), F.coalesce(is_license_file, F.lit(False)).alias("named"), F.col(text_col).alias("text"),
    )
    units = stored(_units(rows), "units")
    best = units.drop("text").join(similarities(units), "unit").groupBy("id", "text_key").agg(
        F.min(F.struct((-F.col("similarity")).alias("less"), "license")).alias("best"), F.max("whole").alias("whole")
    )
    own = stored(best.select(
        F.col("id").alias("own_id"), F.col("text_key").alias("own_key"), F.col("best.license").alias("license"),
        (-F.col("best.less")).alias("similarity"), "whole",
    ), "licensed")
    key = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    licensed = rows.drop("given", "text").join(own, key).where(F.col("named") | F.col("whole"))
    counted = licensed.where("directory IS NOT NULL").groupBy("directory", "license").agg(F.count("*").alias("n"))
    first = Window.partitionBy("directory").orderBy(F.col("n").desc(), "license")
    by_directory = counted.withColumn("place", F.row_number().over(first)).where("place = 1").select(
        F.col("directory").alias("ancestor"), F.col("license").alias("inherited")
    )
    inherited = (
        rows.select("directory").where("directory IS NOT NULL").distinct()
        .select("directory", F.explode(_ancestors(F.col("directory"))).alias("ancestor")).join(by_directory, "ancestor")
        .groupBy("directory").agg(F.max_by("inherited", F.length("ancestor")).alias("inherited"))
    )
    # Written, so that it is joined for its size: sent to all tasks if small, else shuffled, where a hot directory can be split.
    inherited = stored(inherited, "inherited")
    size = inherited.agg(F.sum(F.length("directory") + F.length("inherited") + 32)).first()[0] or 0
    inherited = F.broadcast(inherited) if size <= BROADCAST_BYTES else inherited
    joined = rows.drop("text").join(own, key, "left").join(inherited, "directory", "left")
    kept = [F.col(f"given.`{c}`") for c in df.columns if c.lower() not in ("license", "origin", "similarity")]
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return joined.select(*kept, F.coalesce("license", "inherited").alias("license"), origin.alias("origin"), "similarity")


def documents_path() -> Column:
    """Documents as files at three depths: below their source, their language, or a folder of a hundred ids."""
    depth = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3))
    return F.concat_ws(
        "/", F.coalesce("source", F.lit("")), F.when(depth >= 1, F.coalesce("lang", F.lit(""))),
        F.when(depth == 2, F.expr("doc_id div 100").cast("string")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def documents_sql() -> str:
    """The scan of documents in DuckDB's SQL."""
    values = ", ".join(f"({i}, {_sql_text(a)}, {_sql_text(b)})" for i, (a, b) in enumerate(TEMPLATES))
    return f"""
    WITH files AS (
        SELECT doc_id, text, coalesce(source, '') AS top,
               CASE WHEN doc_id % 3 >= 1 THEN coalesce(source, '') || '/' || coalesce(lang, '') END AS middle,
               CASE WHEN doc_id % 3 = 2 THEN coalesce(source, '') || '/' || coalesce(lang, '') || '/' || (doc_id // 100) END AS bottom
        FROM documents
    ), plain AS (
        SELECT doc_id, regexp_replace(replace(text, chr(13), ''), '{MARKS}', '', 'g') AS plain FROM files WHERE regexp_matches(text, '{CUE}')
    ), units AS (
        SELECT DISTINCT doc_id, unit FROM (
            SELECT doc_id, unnest(string_split(plain, chr(10))) AS unit FROM plain
            UNION ALL SELECT doc_id, unnest(regexp_split_to_array(plain, '{PARAGRAPH}')) FROM plain
        ) WHERE regexp_matches(unit, '{CUE}')
        UNION SELECT doc_id, plain FROM plain
    ), distinct_units AS (
        SELECT unit, count(*) AS files FROM units GROUP BY unit
    ), tf AS (
        SELECT unit, files, term, count(*) AS tf
        FROM (SELECT unit, files, unnest(regexp_extract_all(lower(unit), '{TERM}')) AS term FROM distinct_units)
        GROUP BY ALL
    ), templates(template, license, words) AS (VALUES {values}),
    own_tf AS (
        SELECT template, license, term, count(*) AS tf
        FROM (SELECT template, license, unnest(regexp_extract_all(lower(words), '{TERM}')) AS term FROM templates) GROUP BY ALL
    ), idf AS (
        SELECT term, ln(((SELECT coalesce(sum(files), 0) FROM distinct_units) + {len(TEMPLATES)} + 1) / (sum(files) + 1)) + 1 AS idf
        FROM (SELECT term, files FROM tf UNION ALL SELECT term, 1 FROM own_tf) GROUP BY term
    ), lw AS (SELECT unit, term, tf * idf AS w FROM tf JOIN idf USING (term)),
    rw AS (SELECT template, license, term, tf * idf AS w FROM own_tf JOIN idf USING (term)),
    ln AS (SELECT unit, sqrt(sum(w * w)) AS norm FROM lw GROUP BY unit),
    rn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM rw GROUP BY template),
    cosine AS (
        SELECT unit, template, license, round(sum(lw.w * rw.w) / any_value(ln.norm) / any_value(rn.norm), 6) AS similarity
        FROM lw JOIN rw USING (term) JOIN ln USING (unit) JOIN rn USING (template) GROUP BY unit, template, license
    ), best AS (
        SELECT unit, license, similarity FROM cosine WHERE similarity >= {THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY unit ORDER BY similarity DESC, template) = 1
    ), own AS (
        SELECT doc_id, license, similarity FROM units JOIN best USING (unit) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, license) = 1
    ), by_directory AS (
        SELECT directory, license FROM (
            SELECT coalesce(bottom, middle, top) AS directory, license, count(*) AS n FROM files JOIN own USING (doc_id) GROUP BY ALL
        ) QUALIFY row_number() OVER (PARTITION BY directory ORDER BY n DESC, license) = 1
    ), above AS (
        SELECT f.doc_id, coalesce(b.license, m.license, t.license) AS license FROM files f LEFT JOIN by_directory b ON b.directory = f.bottom
        LEFT JOIN by_directory m ON m.directory = f.middle LEFT JOIN by_directory t ON t.directory = f.top
    )
    SELECT f.doc_id, coalesce(o.license, a.license) AS license,
           CASE WHEN o.license IS NOT NULL THEN 'own' WHEN a.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
           o.similarity
    FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN above a USING (doc_id)
    """
