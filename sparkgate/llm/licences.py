"""Licence scans: TF-IDF cosine to templates, notices and whole licence texts, then inheritance from
the nearest directory above.

All of it is DataFrame expressions, groupings and joins.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from sparkgate.llm.notices import NOTICES, WHOLE
from sparkgate.llm.tables import narrow_enough, stage

# Licence notices, as their licences or custom word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("proprietary", "All rights reserved."),
)
# Least cosine of a line, and of a whole text, which then is a licence file.
LINE_COSINE, FILE_COSINE = 0.8, 0.6
# Least cosine of a run of terms to a whole notice.
NOTICE_COSINE = 0.75
# Templates of so many terms are also looked for in runs of terms, as they may be wrapped. Runs are as
# long as their template and start this share of it apart.
WRAPPED_TERMS, STEPS = 14, 16
DIGITS = 6

_TERM = "[a-z0-9]+"


def terms_of(text: str) -> list[str]:
    return re.findall(_TERM, text.lower())


VOCABULARY = sorted({term for _, text in TEMPLATES for term in terms_of(text)})
# What whole texts and runs of terms are compared with besides: licence, text, and the least cosine of
# a run of terms, or None if it is for whole texts only.
LONG = (
    *[(licence, text, None) for licence, text in WHOLE],
    *[(licence, text, NOTICE_COSINE) for licence, text in NOTICES],
    *[(licence, text, LINE_COSINE) for licence, text in TEMPLATES if len(terms_of(text)) >= WRAPPED_TERMS],
)
LONG_VOCABULARY = sorted({*VOCABULARY, *[term for _, text, _ in LONG for term in terms_of(text)]})


def _idf(n_texts: int, n_with: int) -> float:
    return math.log((1 + n_texts) / (1 + n_with)) + 1


def _vectors(idf: dict[str, float], templates: tuple = TEMPLATES) -> list[dict[str, float]]:
    """Unit vectors of the templates."""
    out = []
    for _, text, *_ in templates:
        raw = {term: (1 + math.log(n)) * idf[term] for term, n in Counter(terms_of(text)).items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.append({term: w / norm for term, w in raw.items()})
    return out


def _telling(vectors: list[dict[str, float]], least: float) -> list[str]:
    """Terms one of which every passage has that comes near enough to a template.

    Of each template the heaviest terms, until the rest weighs too little for that cosine.
    """
    telling: set[str] = set()
    for vector in vectors:
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < least * least * 0.999:
                break
            telling.add(term)
            rest -= weight * weight
    return sorted(telling)


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), 0)


def _present(texts: DataFrame) -> DataFrame:
    """doc_id, h and the terms of LONG_VOCABULARY a text has, of every text, stored."""
    vocabulary = F.split(F.lit(" ".join(LONG_VOCABULARY)), " ")
    present = F.array_intersect(vocabulary, _terms(F.col("text")))
    return stage(texts.select("doc_id", "h", present.alias("present")), "terms")


def _corpus_idf(present: DataFrame) -> tuple[dict[str, float], float]:
    """Inverse frequencies of the templates' terms over all texts, and that of any other term.

    Other terms count as if one text had them. What reaches the driver is bounded by the templates.
    """
    with_marker = present.select(F.explode(F.array_append("present", F.lit("*"))).alias("term"))
    counted = {row["term"]: row["count"] for row in with_marker.groupBy("term").count().collect()}
    n = counted.pop("*", 0)
    return {term: _idf(n, counted.get(term, 0)) for term in LONG_VOCABULARY}, _idf(n, 1)


def _scores(passages: DataFrame, templates: tuple, idf: dict[str, float], other: float) -> DataFrame:
    """passages (doc_id, h, line, aim, terms) with template, licence and cosine, for each template above 0.

    A passage with an aim is compared with that template only.
    """
    spark = passages.sparkSession
    rows = [
        (term, templates[n][0], n, weight)
        for n, vector in enumerate(_vectors(idf, templates))
        for term, weight in vector.items()
    ]
    vectors = spark.createDataFrame(rows, "term string, licence string, template int, share double")
    known = spark.createDataFrame(list(idf.items()), "term string, idf double")
    key = ["doc_id", "h", "line", "aim"]
    counted = (
        passages.select(*key, F.explode("terms").alias("term"))
        .groupBy(*key, "term")
        .count()
        .join(F.broadcast(known), "term", "left")
        .withColumn("weight", (1 + F.log("count")) * F.coalesce("idf", F.lit(other)))
    )
    norms = counted.groupBy(*key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = (
        counted.join(F.broadcast(vectors), "term")
        .filter("aim IS NULL OR aim = template")
        .groupBy(*key, "template", "licence")
        .agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    )
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key]
    cosine = F.round(F.col("dot") / F.col("norm"), DIGITS)
    return (
        dots.alias("d")
        .join(norms.alias("n"), same[0] & same[1] & same[2] & same[3])
        .select("d.doc_id", "d.h", "d.line", "d.aim", "template", "licence", cosine.alias("cosine"))
    )


def _most_terms(vector: dict[str, float], least: float) -> int:
    """So many of a template's terms at least any passage has that comes as near as least."""
    mass, n = 0.0, 0
    for weight in sorted(vector.values(), reverse=True):
        if mass >= least * least * 0.999:
            break
        mass, n = mass + weight * weight, n + 1
    return n


def _maybe_long(present: DataFrame, idf: dict[str, float]) -> DataFrame:
    """doc_id, h and template of LONG: texts whose terms weigh enough for the least cosine.

    A cosine is at most the root of the squared weights of the template's terms a passage has. Light
    terms, which most texts have, are left out and count as present.
    """
    rows = []
    for n, vector in enumerate(_vectors(idf, LONG)):
        need = (LINE_COSINE if LONG[n][2] == LINE_COSINE else FILE_COSINE) ** 2 * 0.999
        light, heavier = 0.0, sorted(vector.items(), key=lambda x: (-x[1], x[0]))
        while light + heavier[-1][1] ** 2 <= need / 3:
            light += heavier.pop()[1] ** 2
        rows += [(term, n, weight * weight, need - light) for term, weight in heavier]
    heavy = present.sparkSession.createDataFrame(rows, "term string, template int, mass double, need double")
    return (
        present.select("doc_id", "h", F.explode("present").alias("term"))
        .join(F.broadcast(heavy), "term")
        .groupBy("doc_id", "h", "template", "need")
        .agg(F.sum("mass").alias("mass"))
        .filter("mass >= need")
        .select("doc_id", "h", "template")
    )


def _long_matches(texts: DataFrame, present: DataFrame, idf: dict[str, float], other: float) -> DataFrame | None:
    """doc_id, h, rank, licence, cosine and found_in, of texts near to one of LONG as a whole or in a run
    of terms; None if no text can be. Rank 0 is a notice or a licence text, 1 a wrapped sentence.
    """
    maybe = stage(_maybe_long(present, idf).distinct(), "maybe_long")
    if maybe.isEmpty():
        return None
    aims = maybe.groupBy(F.col("doc_id").alias("aim_id"), F.col("h").alias("aim_h")).agg(
        F.collect_set("template").alias("aims")
    )
    same = F.col("doc_id").eqNullSafe(F.col("aim_id")) & (F.col("h") == F.col("aim_h"))
    hits = stage(
        texts.join(narrow_enough(stage(aims, "aims"), 128), same)
        .select("doc_id", "h", "aims", _terms(F.col("text")).alias("terms"))
        .dropDuplicates(["doc_id", "h"]),
        "long_texts",
    )
    least = []
    for n, vector in enumerate(_vectors(idf, LONG)):
        _, text, cosine = LONG[n]
        if cosine is not None:
            width = len(terms_of(text))
            least.append((n, sorted(vector), width, max(1, width // STEPS), _most_terms(vector, cosine)))
    runs = texts.sparkSession.createDataFrame(
        least, "aim int, of_template array<string>, width int, step int, most int"
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("terms") - F.col("width"), F.lit(0)), F.col("step"))
    windows = F.filter(
        F.transform(starts, lambda at: F.slice("terms", at + 1, F.col("width"))),
        lambda run: F.size(F.array_intersect(F.col("of_template"), run)) >= F.col("most"),
    )
    aimed = hits.select("doc_id", "h", "terms", F.explode("aims").alias("aim")).join(F.broadcast(runs), "aim")
    passages = aimed.select("doc_id", "h", F.posexplode(windows).alias("line", "terms"), "aim")
    whole = hits.select("doc_id", "h", F.lit(-1).alias("line"), "terms", F.lit(None).cast("int").alias("aim"))
    scored = _scores(passages.unionByName(whole), LONG, idf, other)
    limits = texts.sparkSession.createDataFrame([(n, x[2]) for n, x in enumerate(LONG)], "template int, run double")
    is_file = F.col("line") < 0
    sentence = F.coalesce(F.col("run") == LINE_COSINE, F.lit(False))
    enough = F.when(is_file & ~sentence, F.lit(FILE_COSINE)).when(~is_file, F.col("run"))
    return (
        scored.join(F.broadcast(limits), "template")
        .filter(F.col("cosine") >= enough)
        .select(
            "doc_id", "h", sentence.cast("int").alias("rank"), "licence", "cosine",
            F.when(is_file, "file").otherwise("block").alias("found_in"),
        )
    )


def directory(path: Column) -> Column:
    """The folder a path lies in; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The folder and all above it, down to the empty one at the top, nearest first."""
    parts = F.split(folder, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.concat_ws("/", F.slice(parts, 1, n))
    )


def licences(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: Column | None = None,
) -> DataFrame:
    """Per row: doc_id, licence, found_in (line, block, file or folder) and cosine.

    Every line of every text, and every text as a whole, is scored against the templates, and whole
    texts against notices and licence texts besides. Notices and long templates are also looked for
    in runs of terms as long as they are, however their lines are wrapped or commented: blocks. A
    filter on terms only spares passages that cannot reach the least cosine. A notice or licence text
    counts before single sentences, as some of these stand in it. A text near enough to a template
    as a whole is a licence file. A document without a licence of its own has that of the
    nearest folder above it that holds a licence file; its cosine is the file's. path names the
    documents' places; without it nothing is inherited. The best cosine counts, of equal ones the
    first licence by name.

    Null and empty texts have no licence of their own; null paths inherit nothing. Ids may be null
    or repeat. Other columns are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        (F.lit(None).cast("string") if path is None else path).alias("path"),
    ).withColumn("h", F.xxhash64("text"))
    present = _present(texts)
    long_idf, other = _corpus_idf(present)
    idf = {term: long_idf[term] for term in VOCABULARY}
    telling = _telling(_vectors(idf), min(LINE_COSINE, FILE_COSINE))
    maybe = f"(?i)(?<![a-z0-9])(?:{'|'.join(telling)})(?![a-z0-9])"
    hits = texts.filter(F.rlike("text", F.lit(maybe))).select("doc_id", "h", "text")
    lines = hits.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("line", "passage"))
    lines = lines.filter(F.rlike("passage", F.lit(maybe)))
    whole = hits.select("doc_id", "h", F.lit(-1).alias("line"), F.col("text").alias("passage"))
    passages = lines.union(whole).distinct()
    scored = _scores(
        passages.select("doc_id", "h", "line", F.lit(None).cast("int").alias("aim"), _terms(F.col("passage")).alias("terms")),
        TEMPLATES, idf, other,
    )
    is_file = F.col("line") < 0
    near = scored.filter(
        F.col("cosine") >= F.when(is_file, F.lit(FILE_COSINE)).otherwise(F.lit(LINE_COSINE))
    ).select(
        "doc_id", "h", F.lit(1).alias("rank"), "licence", "cosine",
        F.when(is_file, "file").otherwise("line").alias("found_in"),
    )
    longer = _long_matches(texts, present, long_idf, other)
    near = near if longer is None else near.unionByName(longer)
    best = F.min(F.struct("rank", (-F.col("cosine")).alias("less"), "licence", F.col("found_in").alias("place")))
    own = stage(
        near.groupBy("doc_id", "h").agg(best.alias("best"), F.max(F.col("found_in") == "file").alias("is_file")).select(
            F.col("doc_id").alias("own_id"),
            F.col("h").alias("own_h"),
            F.col("best.licence").alias("own_licence"),
            (-F.col("best.less")).alias("own_cosine"),
            F.col("best.place").alias("own_place"),
            "is_file",
        ),
        "own_licences",
    )
    placed = texts.select("doc_id", "h", directory(F.col("path")).alias("folder")).join(
        narrow_enough(own, 96), F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h")), "left"
    )
    inherited = stage(_nearest_above(placed), "folder_licences")
    given = placed.join(narrow_enough(inherited, 128), "folder", "left")
    return given.select(
        "doc_id",
        F.coalesce("own_licence", "folder_licence").alias("licence"),
        F.when(F.col("own_licence").isNotNull(), F.when(F.col("is_file"), "file").otherwise(F.col("own_place")))
        .when(F.col("folder_licence").isNotNull(), "folder")
        .alias("found_in"),
        F.coalesce("own_cosine", "folder_cosine").alias("cosine"),
    )


def _nearest_above(placed: DataFrame) -> DataFrame:
    """folder, folder_licence, folder_cosine: of each folder the licence of the nearest one above.

    Folders are distinct before they meet their ancestors, so that a large folder is one row.
    """
    files = placed.filter("is_file AND folder IS NOT NULL")
    given = files.groupBy(F.col("folder").alias("above")).agg(
        F.min(F.struct(-F.col("own_cosine"), "own_licence")).alias("best")
    )
    folders = placed.select("folder").filter("folder IS NOT NULL").distinct()
    chain = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("steps", "above"))
    found = chain.join(given, "above").groupBy("folder").agg(F.min(F.struct("steps", "best")).alias("near"))
    return found.select(
        "folder",
        F.col("near.best.own_licence").alias("folder_licence"),
        (-F.col("near.best.col1")).alias("folder_cosine"),
    )


def _oracle_sql(place: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n    ".join(f"({n}, {quote(licence)}, {quote(text)})" for n, (licence, text) in enumerate(TEMPLATES))
    return f"""
WITH t(template, licence, body) AS (VALUES
    {values}
), tt AS (
  SELECT template, licence, term, count(*) AS n
  FROM (SELECT template, licence, unnest(regexp_extract_all(lower(body), '{_TERM}')) AS term FROM t)
  GROUP BY ALL
), d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_replace({place}, '/?[^/]*$', '') AS folder
  FROM documents
), total AS (SELECT count(*) AS n FROM d),
df AS (
  SELECT term, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{_TERM}')) AS term FROM d)
  GROUP BY term
), idf AS (
  SELECT DISTINCT tt.term, ln((1 + total.n) / (1 + coalesce(df.n, 0))) + 1 AS idf
  FROM tt CROSS JOIN total LEFT JOIN df USING (term)
), tw AS (SELECT template, licence, term, (1 + ln(tt.n)) * idf AS w FROM tt JOIN idf USING (term)),
tn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM tw GROUP BY template),
p AS (
  SELECT doc_id, -1 AS line, text AS passage FROM d
  UNION ALL
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) FROM d
), pt AS (
  SELECT doc_id, line, term, count(*) AS n
  FROM (SELECT doc_id, line, unnest(regexp_extract_all(lower(passage), '{_TERM}')) AS term FROM p) GROUP BY ALL
), pw AS (
  SELECT doc_id, line, pt.term, (1 + ln(pt.n)) * coalesce(idf, ln((1 + total.n) / 2) + 1) AS w
  FROM pt CROSS JOIN total LEFT JOIN idf USING (term)
), pn AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM pw GROUP BY ALL),
s AS (
  SELECT pw.doc_id, pw.line, tw.licence, tw.template, sum(pw.w * tw.w) AS dot
  FROM pw JOIN tw USING (term) GROUP BY ALL
), near AS (
  SELECT s.doc_id, s.line, s.licence, round(dot / (pn.norm * tn.norm), {DIGITS}) AS cosine
  FROM s JOIN pn USING (doc_id, line) JOIN tn USING (template)
), own AS (
  SELECT doc_id, first(licence ORDER BY cosine DESC, licence) AS licence, max(cosine) AS cosine, bool_or(line < 0) AS is_file
  FROM near WHERE cosine >= CASE WHEN line < 0 THEN {FILE_COSINE} ELSE {LINE_COSINE} END
  GROUP BY doc_id
), given AS (
  SELECT folder, first(licence ORDER BY cosine DESC, licence) AS licence, max(cosine) AS cosine
  FROM own JOIN d USING (doc_id) WHERE is_file GROUP BY folder
), chain AS (
  SELECT folder, unnest(range(len(string_split(folder, '/')) + 1)) AS steps FROM (SELECT DISTINCT folder FROM d)
), inherited AS (
  SELECT c.folder, first(g.licence ORDER BY steps) AS licence, first(g.cosine ORDER BY steps) AS cosine
  FROM chain c JOIN given g
    ON g.folder = array_to_string(list_slice(string_split(c.folder, '/'), 1, len(string_split(c.folder, '/')) - steps), '/')
  GROUP BY c.folder
)
SELECT d.doc_id, coalesce(own.licence, i.licence) AS licence,
  CASE WHEN own.licence IS NOT NULL THEN CASE WHEN is_file THEN 'file' ELSE 'line' END
    WHEN i.licence IS NOT NULL THEN 'folder' END AS found_in,
  coalesce(own.cosine, i.cosine) AS cosine
FROM d LEFT JOIN own USING (doc_id) LEFT JOIN inherited i ON i.folder = d.folder
"""


def document_path() -> Column:
    """The given documents at three depths, as in repositories: of three, one lies in its source,
    one in a folder of a thousand, and one in a folder of a hundred below that.
    """
    depth, outer, inner = (F.expr(e) for e in ("doc_id % 3", "doc_id div 1000", "doc_id div 100"))
    return F.concat_ws("/", "source", F.when(depth > 0, outer), F.when(depth > 1, inner), "doc_id")


# The same in SQL.
ORACLE_PATH = (
    "concat_ws('/', source, CASE WHEN doc_id % 3 > 0 THEN doc_id // 1000 END, "
    "CASE WHEN doc_id % 3 > 1 THEN doc_id // 100 END, doc_id)"
)
ORACLE_SQL = _oracle_sql(ORACLE_PATH)
