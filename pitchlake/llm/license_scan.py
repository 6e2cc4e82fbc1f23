"""License scan: MinHash bands over overlapping windows of text retrieve license
templates, exact shingle containment confirms them. Built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from math import ceil, log

from pyspark.sql import Column, DataFrame, functions as F

# License notices as they are published.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except"
        " in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        " writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met: Redistributions of source code must retain the"
        " above copyright notice, this list of conditions and the following disclaimer."
    ),
    "CC-BY-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the"
        " GNU General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the Software), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so."
    ),
}


@dataclass(frozen=True)
class Scan:
    """shingle: words of one. containment: share of a template's shingles that a
    window must hold. rows: hashes of one band. miss: chance at most that the
    bands miss a window that holds just that share."""

    shingle: int = 5
    containment: float = 0.8
    rows: int = 2
    miss: float = 1e-6

    def stride(self, size: int) -> int:
        """Step from window to window for templates of so many shingles."""
        return max(1, size // 4)

    def window(self, size: int) -> int:
        """Shingles of a window: a copy at any place lies within one."""
        return size + self.stride(size) - 1

    def bands(self) -> int:
        """Bands that reach the chance of a miss at the least resemblance that
        such a window has: its share of shingles against the union."""
        least = self.containment / (1.25 + (1 - self.containment))
        return ceil(log(self.miss) / log(1 - least**self.rows))


def words(text: Column) -> Column:
    """Words of ASCII letters and digits in lower case; everything else divides."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.regexp_replace(
        F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), "[^a-z0-9]+", " "
    )
    return F.split(F.trim(plain), " ")


def _computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose value is computed once per row: what is used in a
    lambda would otherwise be computed again for every element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _with_bands(df: DataFrame, shingles: str, name: str, scan: Scan) -> DataFrame:
    """Add the band hashes of the MinHash signature of a set of shingles."""
    hashes = F.array(*[F.lit(s) for s in range(scan.rows * scan.bands())])
    held = _computed(df, "_hashed", F.transform(shingles, lambda x: F.xxhash64(x)))
    signed = _computed(
        held,
        "_signature",
        F.transform(hashes, lambda s: F.array_min(F.transform("_hashed", lambda x: F.xxhash64(x, s)))),
    )
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(scan.bands() - 1)),
        lambda b: F.xxhash64(b, F.slice("_signature", b * scan.rows + 1, scan.rows)),
    )
    return _computed(signed, name, bands).drop("_hashed", "_signature")


def _shingles(tokens: Column, n: int) -> Column:
    """Distinct shingles of an array of words, as text."""
    whole = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
        lambda i: F.array_join(F.slice(tokens, i, n), " "),
    )
    return F.when(F.size(tokens) >= n, F.array_distinct(whole)).otherwise(
        F.array().cast("array<string>")
    )


def template_table(spark, templates: Mapping[str, str], scan: Scan = Scan()) -> DataFrame:
    """license, shingles, size and bands of each template of at least one shingle."""
    given = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    cut = _computed(given, "w", words(F.col("text")))
    cut = _computed(cut, "shingles", _shingles(F.col("w"), scan.shingle)).select("license", "shingles")
    return _with_bands(cut.withColumn("size", F.size("shingles")).where("size > 0"), "shingles", "bands", scan)


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    doc_id: str = "doc_id",
    text: str = "text",
    scan: Scan = Scan(),
) -> DataFrame:
    """Licenses in documents: doc_id, license, containment (best of its windows),
    first_word (start of its first window, in words from 0) and windows (how many).

    Null and empty texts, and those of fewer words than a shingle, have none.
    Rows of the same id, null too, count as parts of one document. Every text is
    read whole. A window without any shingle of a template cannot contain 80 %
    of one, so only windows around such shingles get a signature. The templates
    are a short list that belongs to the program: their shingles are sent with
    the plan.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates, scan).collect()  # the short list above
    if not table:
        return docs.sparkSession.createDataFrame(
            [], f"{doc_id} {docs.schema[doc_id].dataType.simpleString()}, license string,"
            " containment double, first_word int, windows long"
        )
    n = scan.shingle

    def hashed(tokens: Column, at: Column) -> Column:
        return F.xxhash64(*[tokens[at + i] for i in range(n)])

    distinct = sorted({s for t in table for s in t["shingles"]})
    shingle_words = spark.createDataFrame([(s.split(" "),) for s in distinct], "w array<string>")
    known = [r[0] for r in shingle_words.select(hashed(F.col("w"), F.lit(0))).collect()]
    given = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    split = _computed(given, "w", words(F.col("_text"))).where(F.size("w") >= n)
    hits = F.filter(
        F.sequence(F.lit(0), F.size("w") - n), lambda i: hashed(F.col("w"), i).isin(known)
    )
    found = _computed(split, "hits", hits).where(F.size("hits") > 0).select("_id", "w", "hits")

    sizes = sorted({t["size"] for t in table})
    shapes = F.array(
        *[
            F.struct(
                F.lit(m).alias("size"),
                F.lit(scan.stride(m)).alias("stride"),
                F.lit(scan.window(m)).alias("window"),
            )
            for m in sizes
        ]
    )

    def windows(shape: Column) -> Column:
        """Windows of one shape that hold a hit, each with its words."""
        numbers = F.array_distinct(
            F.flatten(
                F.transform(
                    F.col("hits"),
                    lambda h: F.sequence(
                        F.greatest(F.lit(0), F.ceil((h - shape["window"] + 1) / shape["stride"]).cast("int")),
                        F.floor(h / shape["stride"]).cast("int"),
                    ),
                )
            )
        )
        return F.transform(
            numbers,
            lambda k: F.struct(
                shape["size"].alias("size"),
                (k * shape["stride"]).alias("start"),
                F.slice(F.col("w"), k * shape["stride"] + 1, shape["window"] + n - 1).alias("words"),
            ),
        )

    cut = found.select("_id", F.explode(F.flatten(F.transform(shapes, windows))).alias("x"))
    cut = _computed(cut, "held", _shingles(F.col("x.words"), n)).select("_id", "x.size", "x.start", "held")
    # One row for each template size, however many documents there are.
    by_size = (
        template_table(spark, templates, scan)
        .groupBy("size")
        .agg(F.collect_list(F.struct("license", "shingles", "bands")).alias("templates"))
    )
    retrieved = (
        _with_bands(cut, "held", "own", scan)
        .join(F.broadcast(by_size), "size")
        .select(
            "_id",
            "size",
            "start",
            "held",
            F.explode(F.filter("templates", lambda t: F.arrays_overlap(t["bands"], F.col("own")))).alias("t"),
        )
    )
    confirmed = retrieved.select(
        "_id",
        "start",
        F.col("t.license").alias("license"),
        (F.size(F.array_intersect("held", "t.shingles")) / F.col("size")).alias("containment"),
    ).where(F.col("containment") >= scan.containment)
    return confirmed.groupBy(F.col("_id").alias(doc_id), "license").agg(
        F.max("containment").alias("containment"),
        F.min("start").cast("int").alias("first_word"),
        F.count("*").alias("windows"),
    )
