"""Licence scan by sentence rules: sentences to identifiers, identifier sequences to licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised (lower case, runs of anything but letters and digits as one space), by identifier.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "mit-licensed": "licensed under the mit license",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-title": "apache license version 2 0",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl3-title": "gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "ccbync-notice": "licensed under cc by nc 4 0",
    "ccbync-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "ccby-notice": "licensed under cc by 4 0",
    "ccby-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa-notice": "licensed under cc by sa 4 0",
    "cc0-notice": "this work is dedicated to the public domain under cc0 1 0",
    "bsd-title": "bsd 3 clause license",
    "bsd-redistribute": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "rights": "all rights reserved",
}
# Ordered rules: a licence is found where its identifiers follow one another. Of rules that end in one licence any may hold.
RULES = (
    ("Apache-2.0", "permissive", ("apache-notice", "apache-comply", "apache-copy")),
    ("Apache-2.0", "permissive", ("apache-title", "apache-copy")),
    ("Apache-2.0", "permissive", ("apache-notice",)),
    ("Apache-2.0", "permissive", ("apache-title",)),
    ("MIT", "permissive", ("mit-title", "rights")),
    ("MIT", "permissive", ("mit-notice",)),
    ("MIT", "permissive", ("mit-licensed",)),
    ("MIT", "permissive", ("mit-title",)),
    ("MIT", "permissive", ("mit-title-short",)),
    ("BSD-3-Clause", "permissive", ("bsd-title", "bsd-redistribute")),
    ("BSD-3-Clause", "permissive", ("bsd-title",)),
    ("GPL-3.0", "copyleft", ("gpl3-notice", "gpl-free", "gpl-warranty")),
    ("GPL-3.0", "copyleft", ("gpl3-notice",)),
    ("GPL-3.0", "copyleft", ("gpl3-title",)),
    ("GPL", "copyleft", ("gpl-free", "gpl-warranty")),
    ("MPL-2.0", "copyleft", ("mpl-notice",)),
    ("CC-BY-NC-4.0", "noncommercial", ("ccbync-notice",)),
    ("CC-BY-NC-4.0", "noncommercial", ("ccbync-long",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccbysa-notice",)),
    ("CC-BY-4.0", "permissive", ("ccby-notice",)),
    ("CC-BY-4.0", "permissive", ("ccby-long",)),
    ("CC0-1.0", "permissive", ("cc0-notice",)),
    ("proprietary", "reserved", ("rights",)),
)
# Sentences end at line feeds and at . ! ? before a gap.
BREAK = r"\n|(?<=[.!?])[\x20\x09-\x0D]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def license_scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_sentences, sentence_ids, licenses, category) for every row, computed inside the row: nothing is shuffled.

    Each sentence of the whole text is normalised and looked up in the table of known sentences (a fixed table of this
    module). Identifiers keep their order, an unknown sentence is a break. The licences of all rules whose sequence occurs
    are listed once each in rule order; the category is that of the strictest licence (reserved, noncommercial, copyleft,
    permissive, none). Null and empty texts have no sentence and category none; repeated rows are each answered;
    an empty table gives no rows; other columns are ignored.
    """
    known = F.create_map(*[F.lit(x) for name, s in SENTENCES.items() for x in (s, name)])
    rows = docs.select(F.col(key).alias(key), F.split(F.coalesce(F.col(text), F.lit("")), BREAK).alias("_raw"))
    found = F.transform("_raw", lambda s: normalised(s))
    rows = rows.select(key, F.filter(found, lambda s: s != "").alias("_sentences"))
    rows = rows.select(
        key, F.size("_sentences").cast("long").alias("n_sentences"),
        F.transform("_sentences", lambda s: F.coalesce(F.try_element_at(known, s), F.lit("_"))).alias("_ids"),
    )
    rows = rows.withColumn("_line", F.concat(F.lit(" "), F.array_join("_ids", " "), F.lit(" ")))
    hits = [F.when(F.contains(F.col("_line"), F.lit(f" {' '.join(ids)} ")), F.lit(name)) for name, _, ids in RULES]
    kinds = {k: sorted({n for n, kind, _ in RULES if kind == k}) for k in ("reserved", "noncommercial", "copyleft", "permissive")}
    rows = rows.withColumn("_names", F.array_distinct(F.array_compact(F.array(*hits))))
    category = F.lit("none")
    for kind in ("permissive", "copyleft", "noncommercial", "reserved"):
        category = F.when(F.arrays_overlap("_names", F.array(*[F.lit(n) for n in kinds[kind]])), F.lit(kind)).otherwise(category)
    return rows.select(
        key, "n_sentences", F.array_join(F.filter("_ids", lambda i: i != "_"), " ").alias("sentence_ids"),
        F.array_join("_names", " ").alias("licenses"), category.alias("category"),
    )
