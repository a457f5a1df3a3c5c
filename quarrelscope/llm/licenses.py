"""License scan (operator 2): TF-IDF cosine of notices and license files to templates, then inheritance along paths.

DataFrame functions only.  Texts that have a cue word are scored in units: the whole
text, and every run of one to WINDOW lines that has a cue, so that headers wrapped over
lines are met.  Templates are whole license texts (the files in ``templates``), headers and
one-line notices.  Distinct units and the templates are the collection: a term weighs
(1 + ln tf) * idf, idf being ln((1 + N) / (1 + df)) + 1.  A unit gets the license of the
template of highest cosine (ties: the lesser license name) at MIN_COSINE or more.  A file
whose whole text gets a license so is a license file and speaks for its directory; a
directory's best such file decides (score, then lesser id).  Any other file's own license
is that of its best notice.  Files without a license of their own take that of the
nearest ancestor directory.

The work is on distinct units and distinct directories, so copies and hot sources are
aggregated before they are joined; texts are read once, and what has a cue is written.
Edge cases: null text has no notice; null path parts count as "unknown"; rows that share an
id and a directory, repeated ones among them, share their notices; texts of any length are
scored whole; other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_COSINE, WINDOW = 0.5, 3
CUES = r"(?i)licen[cs]e|copyright|all\s+rights\s+reserved|public\s+domain|permission\s+is\s+hereby\s+granted|redistribution\s+and\s+use"
TERM = "[a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Usual notices and headers of common licenses.
NOTICES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and dedicated this work to the public domain."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Proprietary", "All rights reserved."),
)


@cache
def default_templates() -> tuple[tuple[str, str], ...]:
    """(license, text): the notices, and the license texts beside this module, each named by its license."""
    files = sorted((Path(__file__).parent / "templates").glob("*.txt"))
    return (*NOTICES, *((f.name.removesuffix(".txt"), f.read_text()) for f in files))


def _terms(units: DataFrame, key: str, text: str) -> DataFrame:
    terms = F.explode(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"({TERM})"), 1))
    return units.select(key, terms.alias("term")).groupBy(key, "term").agg((F.log(F.count("*").cast("double")) + 1).alias("tf"))


def template_terms(spark: SparkSession, templates) -> DataFrame:
    """(template, license, term, tf), written once: the texts stay out of later plans."""
    rows = F.array(*(F.struct(F.lit(k).alias("template"), F.lit(n).alias("license"), F.lit(t).alias("text")) for k, (n, t) in enumerate(templates)))
    texts = spark.range(1).select(F.explode(rows).alias("x")).select("x.*")
    return common.written(_terms(texts.withColumn("key", F.struct("template", "license")), "key", "text").select("key.*", "term", "tf"), "license-templates")


def units(files: DataFrame, cues: str = CUES) -> DataFrame:
    """(doc_id, directory, whole, unit): the texts with a cue, and their runs of lines with a cue."""
    lines = files.where(F.col("text").rlike(cues)).select("doc_id", "directory", "text", F.split("text", "\n", -1).alias("lines"))
    run = lambda at, n: F.array_join(F.slice("lines", at, n), "\n")
    near = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda at: run(at, F.lit(WINDOW)).rlike(cues))
    sizes = F.array(*map(F.lit, range(1, WINDOW + 1)))
    runs = F.flatten(F.transform(near, lambda at: F.transform(F.filter(sizes, lambda n: at + n - 1 <= F.size("lines")), lambda n: run(at, n))))
    parts = F.filter(runs, lambda u: u.rlike(cues))
    both = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("unit"))), F.transform(parts, lambda u: F.struct(F.lit(False).alias("whole"), u.alias("unit"))))
    return lines.select("doc_id", "directory", F.explode(both).alias("u")).select("doc_id", "directory", "u.*")


def scored(distinct: DataFrame, templates: DataFrame, n_templates: int, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(mark, license, score) of each distinct unit (mark, unit) that a template fits."""
    of_units = common.written(_terms(distinct, "mark", "unit"), "license-terms")
    n = distinct.agg((F.count("*") + n_templates).alias("n"))
    df = of_units.select("term").unionByName(templates.select("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = common.written(df.crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")), "license-idf")  # n is one row
    weigh = lambda terms: terms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = lambda t, key: t.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias(f"norm_{key}"))
    a, b = weigh(of_units), weigh(templates)
    b = b.join(F.broadcast(norm(b, "template")), "template").select("template", "license", "term", (F.col("w") / F.col("norm_template")).alias("v"))
    dots = a.join(F.broadcast(b), "term").groupBy("mark", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))  # the templates are a constant
    cosine = dots.join(norm(a, "mark"), "mark").select("mark", "license", F.round(F.col("dot") / F.col("norm_mark"), 6).alias("score"))
    best = cosine.where(F.col("score") >= min_cosine).groupBy("mark").agg(F.min(F.struct((-F.col("score")).alias("order"), "license")).alias("best"))
    return best.select("mark", "best.license", (-F.col("best.order")).alias("score"))


def ancestors(directory: Column) -> Column:
    """The directory and those above it, the root ('') last."""
    parts = F.split(directory, "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, F.size(parts) - k), "/"))
    return F.array_distinct(up)


def scan(files: DataFrame, templates=None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """files (doc_id, directory, text) -> (doc_id, directory, license, score, origin, from_directory)."""
    templates = default_templates() if templates is None else templates
    files = files.select("doc_id", "directory", F.coalesce("text", F.lit("")).alias("text"))
    found = common.written(units(files).withColumn("mark", F.md5("unit")), "license-units")
    distinct = found.groupBy("mark").agg(F.min("unit").alias("unit"))
    fits = scored(distinct, template_terms(files.sparkSession, templates), len(templates), min_cosine)
    matched = found.select("doc_id", "directory", "whole", "mark").join(fits, "mark")
    own = matched.groupBy("doc_id", "directory").agg(F.min(F.struct((~F.col("whole")).alias("part"), (-F.col("score")).alias("order"), "license")).alias("best"))
    own = common.written(own.select("doc_id", "directory", F.col("best.license").alias("own"), (-F.col("best.order")).alias("own_score"), (~F.col("best.part")).alias("is_file")), "license-own")
    speaks = own.where("is_file").groupBy("directory").agg(F.min(F.struct((-F.col("own_score")).alias("order"), "doc_id", F.col("own").alias("license"))).alias("best"))
    speaks = speaks.select(F.col("directory").alias("from_directory"), F.col("best.license").alias("given"), (-F.col("best.order")).alias("given_score"))
    directories = common.written(files.groupBy("directory").agg(F.count("*").alias("n")), "license-directories")
    up = directories.select("directory", "n", F.posexplode(ancestors(F.col("directory"))).alias("distance", "from_directory"))
    near = up.join(speaks, "from_directory").groupBy("directory", "n").agg(F.min_by(F.struct("from_directory", "given", "given_score"), "distance").alias("near")).select("directory", "n", "near.*")
    near = common.written(near, "license-near")
    total = directories.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = common.joined(files.select("doc_id", "directory"), near, "directory", "n", total, "left").alias("f").join(own.alias("o"), F.col("f.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("f.directory") == F.col("o.directory")), "left")
    origin = F.when(F.col("is_file"), "license file").when(F.col("own").isNotNull(), "notice").when(F.col("given").isNotNull(), "inherited").otherwise("none")
    return out.select("f.doc_id", "f.directory", F.coalesce("own", "given").alias("license"), F.coalesce("own_score", "given_score").alias("score"), origin.alias("origin"), F.when(F.col("own").isNull(), F.col("from_directory")).alias("from_directory"))


def document_files(docs: DataFrame) -> DataFrame:
    """documents as files: directory source/language."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.concat_ws("/", part("source"), part("lang")).alias("directory"), F.col("text").cast("string").alias("text"))


def oracle_sql(templates=None, min_cosine: float = MIN_COSINE) -> str:
    templates = default_templates() if templates is None else templates
    quoted = lambda t: t.replace("'", "''")
    values = ", ".join(f"({k}, '{n}', '{quoted(t)}')" for k, (n, t) in enumerate(templates))
    terms = lambda c: f"unnest(regexp_extract_all(translate({c}, '{_UPPER}', '{_LOWER}'), '{TERM}'))"
    return f"""
WITH files AS (SELECT doc_id, coalesce(source, 'unknown') || '/' || coalesce(lang, 'unknown') AS directory, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, directory, text, string_split(text, chr(10)) AS l FROM files WHERE regexp_matches(text, '{CUES}')),
places AS (SELECT doc_id, directory, l, unnest(range(1, len(l) + 1)) AS i FROM lines),
units AS (SELECT doc_id, directory, TRUE AS whole, text AS unit FROM lines
  UNION ALL SELECT * FROM (SELECT doc_id, directory, FALSE, array_to_string(l[i:i + n - 1], chr(10)) AS unit FROM places, (SELECT unnest(range(1, {WINDOW + 1})) AS n) WHERE i + n - 1 <= len(l)) WHERE regexp_matches(unit, '{CUES}')),
kinds AS (SELECT DISTINCT unit FROM units),
templates(template, license, text) AS (VALUES {values}),
unit_terms AS (SELECT unit, term, 1 + ln(count(*)) AS tf FROM (SELECT unit, {terms('unit')} AS term FROM kinds) GROUP BY unit, term),
template_terms AS (SELECT template, license, term, 1 + ln(count(*)) AS tf FROM (SELECT template, license, {terms('text')} AS term FROM templates) GROUP BY ALL),
n AS (SELECT count(*) + {len(templates)} AS n FROM kinds),
idf AS (SELECT term, ln((1.0 + (SELECT n FROM n)) / (1.0 + count(*))) + 1 AS idf FROM (SELECT term FROM unit_terms UNION ALL SELECT term FROM template_terms) GROUP BY term),
a AS (SELECT unit, term, tf * idf AS w FROM unit_terms JOIN idf USING (term)),
b AS (SELECT template, license, term, tf * idf AS w FROM template_terms JOIN idf USING (term)),
na AS (SELECT unit, sqrt(sum(w * w)) AS norm FROM a GROUP BY unit),
nb AS (SELECT template, sqrt(sum(w * w)) AS norm FROM b GROUP BY template),
cosine AS (SELECT unit, license, round(dot / na.norm / nb.norm, 6) AS score FROM (SELECT a.unit, b.template, b.license, sum(a.w * b.w) AS dot FROM a JOIN b USING (term) GROUP BY ALL) JOIN na USING (unit) JOIN nb USING (template)),
scored AS (SELECT unit, license, score FROM cosine WHERE score >= {min_cosine} QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, license) = 1),
matched AS (SELECT * FROM units JOIN scored USING (unit)),
own AS (SELECT doc_id, directory, license AS own, score AS own_score, whole AS is_file FROM matched QUALIFY row_number() OVER (PARTITION BY doc_id, directory ORDER BY whole DESC, score DESC, license) = 1),
speaks AS (SELECT directory AS from_directory, own AS given, own_score AS given_score FROM own WHERE is_file QUALIFY row_number() OVER (PARTITION BY directory ORDER BY own_score DESC, doc_id) = 1),
up AS (SELECT directory, directory AS from_directory, 0 AS distance FROM (SELECT DISTINCT directory FROM files) UNION ALL SELECT directory, string_split(directory, '/')[1], 1 FROM (SELECT DISTINCT directory FROM files) UNION ALL SELECT directory, '', 2 FROM (SELECT DISTINCT directory FROM files)),
near AS (SELECT directory, from_directory, given, given_score FROM up JOIN speaks USING (from_directory) QUALIFY row_number() OVER (PARTITION BY directory ORDER BY distance) = 1)
SELECT f.doc_id, f.directory, coalesce(own, given) AS license, coalesce(own_score, given_score) AS score,
  CASE WHEN is_file THEN 'license file' WHEN own IS NOT NULL THEN 'notice' WHEN given IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN own IS NULL THEN from_directory END AS from_directory
FROM files f LEFT JOIN near USING (directory) LEFT JOIN own o ON f.doc_id IS NOT DISTINCT FROM o.doc_id AND f.directory = o.directory"""
