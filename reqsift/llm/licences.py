"""Licence scans: sparse TF-IDF cosine of lines, header blocks and licence files to templates, then inheritance down the tree.

Built-in functions only. Distinct lines, blocks and files are scored once, however many files repeat them; the templates
are a fixed small table. A file without a licence of its own takes that of the nearest directory above it that has a
licence file.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored, text_or_empty

#: (licence, notice): short notices as they stand in headers and at the top of licence files.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: (licence, text): titles, notices of more than a line and SPDX forms, for blocks and files.
FORMS = (
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *(
        (
            licence,
            f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published "
            f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        )
        for licence, what, name, version in (
            ("GPL-2.0", "program", "General Public License", "2"),
            ("GPL-3.0", "program", "General Public License", "3"),
            ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
            ("LGPL-3.0", "library", "Lesser General Public License", "3"),
            ("AGPL-3.0", "program", "Affero General Public License", "3"),
        )
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD", "BSD 2-Clause License"),
    ("BSD", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("MIT", "Apache-2.0", "MPL-2.0", "CC0-1.0", "Unlicense")),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")),
    *(("BSD", f"SPDX-License-Identifier: {name}") for name in ("BSD-2-Clause", "BSD-3-Clause")),
    *(
        (name, f"SPDX-License-Identifier: {name}{end}")
        for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
        for end in ("", "-only", "-or-later")
    ),
)
#: Whole licence texts, a file each; only the driver reads them.
TEXTS = Path(__file__).parent / "licence_texts"
#: A line that may name a licence. Every template has one of these words.
TRIGGER = r"(?i)licen[sc]e|permission is hereby|redistribution|public domain|cc by|cc0|copyright|spdx"
#: A block that may name one: the same words, also with line breaks and comment marks between them.
HIT = TRIGGER.replace(" ", "[^a-z0-9]+")
#: The mark a comment line opens with.
COMMENT = r"^\s*(?:#|//|/?\*|--|;|%|<!--|(?i:rem|dnl)\s)"
#: Least cosine of a line that names a licence.
THRESHOLD = 0.75
#: Base names of licence files.
LICENCE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"

_TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def _tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(_TOKEN), F.lit(0))


def licence_lines(lines: DataFrame, templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``line, licence, cosine`` for the rows of ``line, rows`` (distinct lines and how often they occur) that name a licence."""
    texts = lines.select(F.col("line").alias("key"), F.col("line").alias("text"), "rows")
    return named(texts, templates, threshold).withColumnRenamed("key", "line")


def named(texts: DataFrame, templates: tuple, threshold: float = THRESHOLD) -> DataFrame:
    """``key, licence, cosine`` for the rows of ``key, text, rows`` (distinct texts and how often they occur) that name a licence.

    Weights are the count of a token in the text times ``ln(1 + N / n)``: N texts in the corpus and the templates
    together, n of them with the token. Of equally similar templates the first counts. Cosines are rounded to 6 places.
    """
    spark = texts.sparkSession
    known = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "t int, licence string, text string")
    bags = texts.select("key", "rows", F.explode(_tokens(F.col("text"))).alias("token"))
    counts = stored(bags.groupBy("key", "rows", "token").agg(F.count("*").alias("n")), "licence-tokens")
    template_counts = known.select("t", F.explode(_tokens(F.col("text"))).alias("token")).groupBy("t", "token").agg(F.count("*").alias("n"))
    total = texts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total")).select((F.col("total") + len(templates)).alias("total"))
    seen = counts.groupBy("token").agg(F.sum("rows").alias("rows"))
    seen = seen.unionByName(template_counts.groupBy("token").agg(F.count("*").alias("rows")))
    seen = seen.groupBy("token").agg(F.sum("rows").alias("rows"))
    # One row on the right.
    idf = seen.crossJoin(F.broadcast(total)).select("token", F.log(1 + F.col("total") / F.col("rows")).alias("idf"))
    idf = stored(idf, "idf")
    vector = counts.join(idf, "token").withColumn("w", F.col("n") * F.col("idf"))
    norms = vector.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    template = template_counts.join(idf, "token").withColumn("tw", F.col("n") * F.col("idf"))
    template_norms = template.groupBy("t").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("t_norm"))
    # The templates are a fixed table of some hundred tokens.
    dots = vector.join(F.broadcast(template.select("t", "token", "tw")), "token").groupBy("key", "t")
    dots = dots.agg(F.sum(F.col("w") * F.col("tw")).alias("dot")).join(norms, "key").join(F.broadcast(template_norms), "t")
    scored = dots.withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6))
    best = scored.groupBy("key").agg(F.min(F.struct(-F.col("cosine"), F.col("t"))).alias("best"))
    best = best.select("key", F.col("best.t").alias("t"), (-F.col("best.col1")).alias("cosine"))
    return best.filter(F.col("cosine") >= threshold).join(F.broadcast(known.select("t", "licence")), "t").select("key", "licence", "cosine")


def whole_texts() -> tuple:
    """``(licence, text)`` of the whole licence texts, by name."""
    return tuple((p.stem, p.read_text("utf-8")) for p in sorted(TEXTS.glob("*.txt")))


def _cut(lines: Column, kind) -> Column:
    """Runs of adjacent ``lines`` of one ``kind``, joined by spaces."""
    before = F.slice(F.concat(F.array(F.lit("")), lines), 1, F.size(lines))
    parts = F.zip_with(lines, before, lambda x, y: F.concat(F.when(kind(x) == kind(y), " ").otherwise("\x01"), x))
    return F.split(F.array_join(parts, ""), "\x01")


def licence_units(rows: DataFrame, templates: tuple = TEMPLATES + FORMS) -> DataFrame:
    """``id, path, scope, text`` of everything larger than a line that is compared, from ``id, path, text``.

    Scope 1 is the whole text of a licence file. Scope 2 is a block: adjacent lines that are all comment or all not, up to
    a line without letters and digits; those with a hit, and the first of a leading comment whether it has one or not.
    Scope 3 is a run of lines with a hit that share at least half of their tokens with the ``templates``, so that a
    notice is found in a block of other text, however many lines it takes.
    """
    words = sorted({w for _, text in templates for w in re.findall(_TOKEN, text.lower())})
    base = F.coalesce(F.substring_index("path", "/", -1), F.lit(""))
    is_file, some = base.rlike(LICENCE_FILE), r"[A-Za-z0-9]"
    lines = F.split(F.translate("text", "\x01", " "), "\n")
    comment = lambda x: x.rlike(COMMENT)
    known = lambda x: F.size(F.array_intersect(_tokens(x), F.array(*map(F.lit, words)))) * 2
    alike = lambda x: known(x) >= F.greatest(F.size(F.array_distinct(_tokens(x))), F.lit(1))
    blocks = F.filter(_cut(lines, lambda x: F.when(~x.rlike(some), 0).when(comment(x), 1).otherwise(2)), lambda x: x.rlike(some))
    hit = lambda x: x.rlike(HIT)
    kept = F.filter(blocks, lambda x, i: hit(x) | ((i == 0) & comment(x)))
    units = lambda scope, texts: F.transform(texts, lambda x: F.struct(F.lit(scope).alias("scope"), x.alias("text")))
    whole = F.when(is_file, F.array("text")).otherwise(F.array().cast("array<string>"))
    found = F.concat(units(1, whole), units(2, kept), units(3, F.filter(_cut(lines, alike), hit)))
    wanted = hit(F.col("text")) | is_file | F.ltrim("text").rlike(COMMENT)
    return rows.filter(wanted).select("id", "path", F.explode(F.array_distinct(found)).alias("u")).select("id", "path", "u.scope", "u.text")


def scan_licences(
    files: DataFrame,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    templates: tuple = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col, path, own_licence, cosine, licence, inherited_from`` for every row of ``files``.

    ``own_licence`` is that of the most similar line, block or licence file: every line is compared with ``templates``, and
    what ``licence_units`` finds with those, ``FORMS`` and the whole licence texts, each kind with weights of its own (of
    equal ones, lines come first, then files, blocks and runs, then the first licence by name).
    ``licence`` is the own one, or else that of the nearest licence file in the row's directory or one above it, whose
    path is ``inherited_from`` (of several in one directory, the smallest path). A licence file is a row with an own
    licence whose base name matches ``LICENCE_FILE``. Null and empty texts have no own licence; a null path has no
    directory and inherits nothing. Repeated rows get equal answers.
    """
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), text_or_empty(text_col).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(TRIGGER))
    found = rows.filter(F.col("text").rlike(TRIGGER)).select("id", "path", F.explode(F.array_distinct(lines)).alias("line"))
    found = stored(found.withColumn("line", F.trim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " "))), "licence-lines")
    by_line = licence_lines(found.groupBy("line").agg(F.count("*").alias("rows")), templates, threshold)
    units = stored(licence_units(rows, templates + FORMS).withColumn("key", F.sha2("text", 256)), "licence-units")
    # A text that is a file, a block and a run at once counts once.
    texts = units.groupBy("key").agg(F.any_value("text").alias("text"), F.count_distinct(F.struct("id", "path")).alias("rows"))
    by_unit = named(texts, templates + FORMS + whole_texts(), threshold)
    own = found.join(by_line, "line").select("id", "path", F.lit(0).alias("scope"), "licence", "cosine")
    own = own.unionByName(units.drop("text").join(by_unit, "key").select("id", "path", "scope", "licence", "cosine"))
    own = own.groupBy("id", "path").agg(F.min(F.struct(-F.col("cosine"), F.col("scope"), F.col("licence"))).alias("best"))
    own = own.select("id", "path", F.col("best.licence").alias("own_licence"), (-F.col("best.col1")).alias("cosine"))
    own = stored(own, "own-licences")
    base, folder = F.substring_index("path", "/", -1), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    sources = own.filter(base.rlike(LICENCE_FILE)).groupBy(folder.alias("folder"))
    sources = sources.agg(F.min(F.struct("path", "own_licence")).alias("source"))
    # Every directory of the corpus once, with all directories above it; the deepest that has a licence file wins.
    folders = rows.filter("path IS NOT NULL").select(folder.alias("folder")).distinct()
    steps = F.split("folder", "/")
    above = folders.select("folder", F.posexplode(F.transform(steps, lambda _, i: F.array_join(F.slice(steps, 1, i + 1), "/"))).alias("depth", "a"))
    above = above.union(folders.select("folder", F.lit(-1), F.lit(""))).distinct()
    nearest = above.join(sources.withColumnRenamed("folder", "a"), "a").groupBy("folder")
    nearest = nearest.agg(F.max(F.struct("depth", "source")).alias("n")).select("folder", "n.source")
    out = rows.select("id", "path", folder.alias("folder"))
    same = out["id"].eqNullSafe(own["id"]) & out["path"].eqNullSafe(own["path"])
    out = out.join(own, same, "left").select(out["id"], out["path"], "folder", "own_licence", "cosine")
    out = out.join(nearest, "folder", "left")
    inherited = F.when(F.col("own_licence").isNull(), F.col("source.path"))
    return out.select(
        F.col("id").alias(id_col),
        "path",
        "own_licence",
        "cosine",
        F.coalesce("own_licence", "source.own_licence").alias("licence"),
        inherited.alias("inherited_from"),
    )


def _sql(templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> str:
    known = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    trigger = TRIGGER.replace("'", "''")
    return rf"""
WITH known(t, licence, line) AS (VALUES {known}),
files AS (
    SELECT doc_id, text, doc_id // 100 AS shard, concat_ws('/', source, lang) AS top, source, coalesce(text, '') AS body,
        regexp_matches(coalesce(text, ''), '{trigger}') AND doc_id % 2 = 0 AS head FROM documents
),
folders AS (
    SELECT *, CASE
        WHEN head THEN CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN top ELSE concat_ws('/', top, shard) END
        WHEN doc_id % 5 = 0 THEN top WHEN doc_id % 5 < 3 THEN concat_ws('/', top, shard)
        ELSE concat_ws('/', top, shard, 'part' || doc_id % 7) END AS folder FROM files
),
paths AS (SELECT *, concat_ws('/', folder, CASE WHEN head THEN 'LICENSE.' ELSE '' END || doc_id) AS path FROM folders),
found AS (
    SELECT DISTINCT doc_id, path, l AS raw, trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')) AS line
    FROM (SELECT doc_id, path, unnest(string_split(body, chr(10))) AS l FROM paths) WHERE regexp_matches(l, '{trigger}')
),
lines AS (SELECT line, count(*) AS rows FROM found GROUP BY line),
bags AS (SELECT line, rows, unnest(regexp_extract_all(lower(line), '{_TOKEN}')) AS token FROM lines),
counts AS (SELECT line, rows, token, count(*) AS n FROM bags GROUP BY ALL),
tcounts AS (SELECT t, token, count(*) AS n FROM (
    SELECT t, unnest(regexp_extract_all(lower(line), '{_TOKEN}')) AS token FROM known) GROUP BY ALL),
total AS (SELECT coalesce(sum(rows), 0) + {len(templates)} AS total FROM lines),
seen AS (SELECT token, sum(rows) AS rows FROM (
    SELECT token, rows FROM counts UNION ALL SELECT token, 1 FROM tcounts) GROUP BY token),
idf AS (SELECT token, ln(1 + total / rows) AS idf FROM seen, total),
vec AS (SELECT line, token, n * idf AS w FROM counts JOIN idf USING (token)),
tvec AS (SELECT t, token, n * idf AS w FROM tcounts JOIN idf USING (token)),
norms AS (SELECT line, sqrt(sum(w * w)) AS norm FROM vec GROUP BY line),
tnorms AS (SELECT t, sqrt(sum(w * w)) AS norm FROM tvec GROUP BY t),
dots AS (SELECT line, t, sum(v.w * x.w) AS dot FROM vec v JOIN tvec x USING (token) GROUP BY ALL),
scored AS (SELECT line, t, round(dot / (n.norm * m.norm), 6) AS cosine FROM dots JOIN norms n USING (line) JOIN tnorms m USING (t)),
named AS (SELECT scored.line, licence, cosine FROM scored JOIN known k USING (t) WHERE cosine >= {threshold}
    QUALIFY row_number() OVER (PARTITION BY scored.line ORDER BY cosine DESC, t) = 1),
own AS (SELECT doc_id, path, licence AS own_licence, cosine FROM found JOIN named USING (line)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1),
sources AS (SELECT folder AS above, path AS from_path, own_licence AS from_licence FROM own JOIN paths p USING (doc_id, path)
    WHERE head QUALIFY row_number() OVER (PARTITION BY folder ORDER BY path) = 1),
nearest AS (SELECT f.folder, from_path, from_licence FROM (SELECT DISTINCT folder FROM paths) f
    JOIN sources ON starts_with(f.folder || '/', above || '/')
    QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(above) DESC) = 1)
SELECT doc_id, p.path, o.own_licence, o.cosine, coalesce(o.own_licence, s.from_licence) AS licence,
    CASE WHEN o.own_licence IS NULL THEN s.from_path END AS inherited_from
FROM paths p LEFT JOIN own o USING (doc_id) LEFT JOIN nearest s USING (folder)
"""


#: DuckDB SQL of the query over ``documents`` (see ``queries.op7_licence_scan`` for the paths).
SQL = _sql()
