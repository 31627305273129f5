"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance by path.

Headers are the runs of lines with licence words, wherever they stand in a text; the text of a
file named like a licence is one header too.  Document frequencies are counted over all headers.
Equal headers have one digest and are scored once; what is shuffled is (digest, term, count), never a
text.  Terms of the templates, a fixed short list, are the only table that is broadcast.

A licence file holds for its directory; a file without a licence of its own takes the one of its
nearest ancestor directory.  Directories are made distinct first, so their ancestors are listed
once per directory and not per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

LEAST = 0.5
_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
        "License as published by the Free Software Foundation, either version {} of the License, or any later version")
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the " \
       "following conditions are met"
_THIRD = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
#: (licence, terms that a header must hold, terms that it must not hold, text)
TEMPLATES = (
    ("Apache-2.0", "apache", "", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache", "", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                                 "in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "mit", "", "Released under the MIT License."),
    ("MIT", "permission", "", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                              "associated documentation files, to deal in the Software without restriction"),
    ("ISC", "permission", "", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                              "is hereby granted"),
    *[(f"{short}-{version}.0" if version != "2.1" else f"{short}-2.1", f"{version} {need}".strip(), bar, text.format(name, version))
      for short, name, need, bar, versions in (
          ("GPL", "", "", "lesser affero library", "23"), ("AGPL", "Affero ", "affero", "lesser", "3"),
          ("LGPL", "Lesser ", "lesser", "affero", ("2.1", "3")))
      for version in versions for text in (_GNU, _GPL)],
    ("BSD-2-Clause", "redistribution", "neither endorse", _BSD),
    ("BSD-3-Clause", "redistribution neither", "", _BSD + _THIRD),
    ("MPL-2.0", "mozilla", "", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "unencumbered", "", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "cc0", "", "Licensed under CC0 1.0 Universal."),
    *[(f"CC-{kind}-4.0", kind.lower(), "", f"Licensed under CC {kind} 4.0.")
      for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")],
    ("proprietary", "reserved", "", "All rights reserved."),
)
_CUE = r"(?i)licen[sc]e|copyright|rights reserved|spdx|permission is hereby|redistribution and use|free software"
_FILE = r"(?i)^(licen[sc]e|copying|notice)([.-][^/]*)?$"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.-]+|[.](?=\s|$)"), lambda t: t != "")


def _headers(text: Column) -> Column:
    """Runs of neighbouring lines with a licence word; the split drops lines without one."""
    marked = F.transform(F.split(text, "\n", -1), lambda l: F.when(l.rlike(_CUE), l).otherwise(F.lit("")))
    return F.filter(F.split(F.array_join(marked, "\n"), "\n{2,}"), lambda h: F.trim(h) != "")


def header_scores(headers: DataFrame) -> DataFrame:
    """hid, license, cosine: the nearest template of each distinct header (hid, header), ties to the first name.

    Headers are told apart by a digest, `hid`, so a text is split into its terms where it is and never
    shuffled.  A template counts only with all the terms it needs, a version or a variant, and none that it bars.
    """
    spark = headers.sparkSession
    templates = spark.createDataFrame(
        [(k, *row) for k, row in enumerate(TEMPLATES)], "template int, license string, needs string, bars string, t_text string")
    sizes = headers.groupBy("hid").agg(F.count("*").alias("n"))
    # equal headers add up to n times their counts
    counted = headers.select("hid", F.explode(_terms(F.col("header"))).alias("term")).groupBy("hid", "term").agg(F.count("*").alias("m"))
    own = stored(counted.join(sizes, "hid").select("hid", "n", "term", (F.col("m") / F.col("n")).alias("tf")))
    n = headers.count()
    frequency = own.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log((F.lit(n) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    weighted = stored(own.join(frequency, "term").select("hid", "term", (F.col("tf") * idf).alias("w")))
    norms = weighted.groupBy("hid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))

    shared = templates.select("template", "license", F.explode(_terms(F.col("t_text"))).alias("term")).groupBy(
        "template", "license", "term").agg(F.count("*").alias("tf"))
    marks = [
        templates.select("template", "license", F.explode(F.filter(F.split(column, " "), lambda t: t != "")).alias("term"),
                         F.lit(0.0).alias("tw"), F.lit(need).alias("need"), F.lit(bar).alias("bar"))
        for column, need, bar in (("needs", 1, 0), ("bars", 0, 1))]
    t_weights = shared.join(frequency, "term", "left").select(
        "template", "license", "term", (F.col("tf") * idf).alias("tw"), F.lit(0).alias("need"), F.lit(0).alias("bar"))
    t_norms = t_weights.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("t_norm"))
    t_needs = templates.select("template", F.size(F.filter(F.split("needs", " "), lambda t: t != "")).alias("t_needs"))
    # the terms of a fixed short list
    t_all = F.broadcast(t_weights.unionByName(marks[0]).unionByName(marks[1]).join(F.broadcast(t_norms), "template").join(
        F.broadcast(t_needs), "template"))
    dots = weighted.join(t_all, "term").groupBy("hid", "template", "license", "t_norm", "t_needs").agg(
        F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sum("need").alias("need"), F.sum("bar").alias("bar"),
    ).where("need = t_needs and bar = 0")
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 9)
    best = dots.join(norms, "hid").withColumn("cosine", cosine).groupBy("hid").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")
    )
    return best.select("hid", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
                  least: float = LEAST) -> DataFrame:
    """doc_id, path, license, cosine, found: `header`, `file` or `inherited`; and from_dir of an inherited one.

    Null and empty texts have no header.  Texts of any length are read whole.  A null path has no directory: such a file inherits nothing
    and gives nothing.  Of several licences in a text or of several licence files of a directory the
    nearest to its template counts, ties by name.  Files without any licence keep nulls.  Repeated rows
    come out repeated; an empty table gives no rows.
    """
    path = F.col(f"`{path_col}`")
    name = F.element_at(F.split(path, "/"), -1)
    is_file = F.coalesce(name.rlike(_FILE), F.lit(False))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = stored(df.select(
        F.col(f"`{id_col}`").alias("doc_id"), path.alias("path"),
        F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit("")).alias("dir"),
        is_file.alias("is_file"),
        F.array_union(_headers(text), F.when(is_file & (F.trim(text) != ""), F.array(text)).otherwise(F.array().cast("array<string>"))).alias("headers"),
    ).withColumn("row", F.expr("uuid()")))
    exploded = rows.select("row", F.explode("headers").alias("header")).select(
        "row", "header", F.unhex(F.sha2("header", 256)).alias("hid"))
    scored = stored(header_scores(exploded.select("hid", "header")).where(F.col("cosine") >= least))
    own = (
        exploded.select("row", "hid").join(scored, "hid").groupBy("row")
        .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("own"))
    )
    known = stored(rows.drop("headers").join(own, "row", "left"))
    declared = known.where("is_file and own is not null and dir is not null").groupBy("dir").agg(F.min("own").alias("given"))
    parts = F.split("dir", "/")
    ancestors = known.where("own is null and dir is not null").select("dir").distinct().select(
        F.col("dir").alias("at"),
        F.explode(F.array_distinct(F.concat(
            F.array(F.lit("")),
            F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")),
        ))).alias("dir"),
    )
    inherited = ancestors.join(declared, "dir").groupBy("at").agg(
        F.max(F.struct(F.length("dir").alias("deep"), "dir", "given")).alias("up")
    )
    joined = known.join(inherited, F.expr("own is null and dir = at"), "left")
    return joined.select(
        "doc_id", "path", F.coalesce("own.license", "up.given.license").alias("license"),
        (-F.coalesce("own.c", "up.given.c")).alias("cosine"),
        F.when(F.col("own").isNotNull(), F.when(F.col("is_file"), "file").otherwise("header"))
        .when(F.col("up").isNotNull(), "inherited").alias("found"),
        F.when(F.col("own").isNull(), F.col("up.dir")).alias("from_dir"),
    )
