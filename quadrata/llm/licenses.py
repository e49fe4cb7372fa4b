"""License scans, by DataFrame operations only: TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a file (its headers), every run of as many terms as a template has within a longer line, and every file as a
whole is compared with every template as a sparse vector. A line or run can reach the threshold only if it holds one of a
template's heaviest terms, and a run only if the template's terms in it weigh enough; only such lines and runs are spelled
out. Both bounds are exact. Files without a header of their own take the license of the nearest directory above them that has a licence file.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.session import cut_lineage

THRESHOLD, WHOLE = 0.6, 0.9
LICENSE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
# Short notices by which licenses are named.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_TERM = r"[a-z0-9]+(?:\.[0-9]+)*"


def terms(text: str) -> Counter:
    return Counter(re.findall(_TERM, text.lower()))


def _all_terms(text: str):
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), F.lit(1))


def _spelled(df: DataFrame) -> DataFrame:
    """Rows by term: ``term`` and how often it occurs in ``words`` (other column names of df stay)."""
    keys = [c for c in df.columns if c != "words"]
    return df.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def _runs(lines: DataFrame, sizes: Mapping[str, int], weights: list[tuple[str, str, float]], heavy: Mapping[str, set[str]], threshold: float) -> DataFrame:
    """(file_id, tag, line, start, size, words): runs of ``size`` terms within longer lines that may reach the threshold.

    Only the terms around a heavy term are looked at, and of a run only how much of its template's norm it holds, which by
    Cauchy and Schwarz bounds the cosine. The template table is a literal.
    """
    most = max(sizes.values())
    shape = "array<struct<size:int,heavy:array<string>,share:map<string,double>>>"
    known = [(sizes[name], sorted(heavy[name]), {t: w * w for m, t, w in weights if m == name}) for name in sorted(sizes)]
    known = F.from_json(F.lit(json.dumps([{"size": n, "heavy": h, "share": m} for n, h, m in known])), shape)
    every = sorted(set().union(*heavy.values()))
    hits = F.filter(F.transform("words", lambda t, i: F.when(t.isin(every), i + 1)), lambda p: p.isNotNull())
    at = lines.select("file_id", "tag", "line", "words", F.size("words").alias("n")).where(F.col("n") > min(sizes.values()))
    around = F.transform(hits, lambda p: F.struct(p.alias("p"), F.greatest(p - (most - 1), F.lit(1)).alias("low")))
    around = F.transform(around, lambda x: F.struct(x["p"].alias("p"), x["low"].alias("low"), F.slice("words", x["low"], F.lit(2 * most - 1)).alias("near")))
    near = at.select("file_id", "tag", "line", "n", F.inline(around))
    each = near.select("*", F.inline(known)).where((F.col("n") > F.col("size")) & F.array_contains("heavy", F.get("near", F.col("p") - F.col("low"))))
    first, last = F.greatest(F.col("p") - F.col("size") + 1, F.lit(1)), F.least(F.col("p"), F.col("n") - F.col("size") + 1)
    cut = each.select("*", F.explode(F.sequence(first, last)).alias("start")).withColumn("words", F.slice("near", F.col("start") - F.col("low") + 1, F.col("size")))
    held = F.aggregate(F.array_distinct("words"), F.lit(0.0), lambda total, t: total + F.coalesce(F.try_element_at("share", t), F.lit(0.0)))
    cut = cut.where(held >= (threshold - 1e-9) ** 2)
    return cut.select("file_id", "tag", "line", "start", "size", "words").dropDuplicates(["file_id", "tag", "line", "start", "size"])


def document_frequencies(files: DataFrame) -> DataFrame:
    """(term, df): in how many files each term occurs."""
    return files.select(F.explode(F.array_distinct(_all_terms("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def scan(files: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(file_id, path, license, similarity, origin, license_path), one row per row of ``files`` (file_id, path, text; more is ignored).

    origin: ``header`` for the most similar line or run of terms in a line, ``file`` for a licence file (by its name, or because its whole text is
    similar by WHOLE or more), ``inherited`` from the licence file in the nearest directory at or above the file's own; null if there is none. Ties go to
    the first license by name, then the first line, then the first path. Weights are tf times ln((1+N)/(1+df))+1 over
    all files, for the terms of the files as for those of the templates. Null or empty texts have no header; a null path has no directory.
    Rows that repeat file_id, path and text get equal results.
    """
    spark = files.sparkSession
    files = files.select("file_id", "path", "text", F.xxhash64("path", "text").alias("tag"))
    counted = {name: terms(text) for name, text in templates.items()}
    vocabulary = sorted(set().union(*counted.values()))
    n, held = files.count(), cut_lineage(document_frequencies(files))
    df = {r["term"]: r["df"] for r in held.where(F.col("term").isin(vocabulary)).collect()}
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    idfs = held.select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"))
    weights, heavy = [], {name: set() for name in counted}
    for name, tf in counted.items():
        own = {t: c * idf[t] for t, c in tf.items()}
        norm = math.sqrt(sum(w * w for w in own.values()))
        weights += [(name, t, w / norm) for t, w in own.items()]
        rest = 1.0
        for t, w in sorted(own.items(), key=lambda x: (-x[1], x[0])):
            if rest < (threshold - 1e-9) ** 2:
                break
            heavy[name].add(t)
            rest -= (w / norm) ** 2
    # The terms of the templates are the only thing joined by broadcast: a parameter, and a few dozen rows.
    template = F.broadcast(spark.createDataFrame(weights, "license string, term string, weight double"))
    telling = r"(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(t) for t in sorted(set().union(*heavy.values()))) + r")(?![a-z0-9])"
    holding = files.where(F.col("text").rlike(telling))
    lines = holding.select("file_id", "tag", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line", "text")).where(F.col("text").rlike(telling))
    whole = holding.select("file_id", "tag", F.lit(-1).alias("line"), "text")
    key = ["file_id", "tag", "line", "start", "size"]  # start and size are zero but for runs
    uncut = lambda df: df.select("file_id", "tag", "line", F.lit(0).alias("start"), F.lit(0).alias("size"), _all_terms("text").alias("words"))
    lines = uncut(lines)
    runs = _runs(lines, {name: sum(tf.values()) for name, tf in counted.items()}, weights, heavy, threshold)
    vectors = cut_lineage(_spelled(lines.unionByName(uncut(whole)).unionByName(runs)).join(idfs, "term"))
    size = vectors.groupBy(*key).agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm"))
    dots = vectors.join(template, "term").groupBy(*key, "license").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    same = [F.col("d.file_id").eqNullSafe(F.col("s.file_id")), *(F.col(f"d.{k}") == F.col(f"s.{k}") for k in key[1:])]
    similar = dots.alias("d").join(size.alias("s"), same).select("d.*", (F.col("dot") / F.col("norm")).alias("similarity"))
    similar = similar.where(F.col("similarity") >= threshold)
    rank = F.struct(F.round(-F.col("similarity"), 9), "license", "line")
    best = lambda which: F.min_by(F.struct("license", "similarity"), F.when(which, rank))
    own = cut_lineage(similar.groupBy("file_id", "tag").agg(best(F.col("line") >= 0).alias("header"), best(F.col("line") < 0).alias("whole")))
    rows = files.select("file_id", "path", "tag").alias("f")
    match = F.col("f.file_id").eqNullSafe(F.col("o.file_id")) & (F.col("f.tag") == F.col("o.tag"))
    named = rows.join(own.alias("o"), match, "left").select("f.*", "header", "whole", F.regexp_replace("path", r"/?[^/]*$", "").alias("folder"))
    is_file = F.coalesce(F.col("path").rlike(LICENSE_NAMES), F.lit(False)) | (F.coalesce("whole.similarity", F.lit(0.0)) >= WHOLE)
    as_file = F.when(is_file, F.coalesce("whole", "header"))
    named = named.withColumn("as_file", as_file)
    given = (
        named.where(F.col("as_file").isNotNull() & F.col("folder").isNotNull())
        .groupBy("folder")
        .agg(F.min(F.struct("path", "as_file")).alias("from"))
        .select(F.col("folder").alias("above"), "from")
    )
    parts = F.split("folder", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    near = (
        named.select("folder").dropna().distinct()
        .select("folder", F.explode(F.array_distinct(ups)).alias("above"))
        .join(given, "above")
        .groupBy("folder")
        .agg(F.max_by("from", F.length("above")).alias("from"))
    )
    final = named.join(near, "folder", "left")
    found = F.coalesce("as_file", "header", "from.as_file")
    origin = F.when(F.col("as_file").isNotNull(), "file").when(F.col("header").isNotNull(), "header").when(F.col("from").isNotNull(), "inherited")
    source = F.when(F.coalesce("as_file", "header").isNotNull(), F.col("path")).otherwise(F.col("from.path"))
    return final.select(
        "file_id", "path", found["license"].alias("license"), F.round(found["similarity"], 6).alias("similarity"),
        origin.alias("origin"), source.alias("license_path"),
    )
