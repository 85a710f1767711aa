"""License scans by an exact set-similarity join, in DataFrame functions only.

Words are runs of ASCII letters (lower-cased) and digits and of all non-ASCII characters. Base labels are phrases whose
words stand consecutively. The join finds every text block that holds at least THRESHOLD of a template's distinct words; a
block is as many consecutive words as twice the template has, LEAST at least, and starts at any word of the template (a
block that starts elsewhere holds no more than the one from its first template word on). Template words are ordered by
their frequency over the whole corpus, rarest first, and a template is indexed under its prefix (size - needed + 1 words):
only blocks around a prefix word are looked at (prefix), if the template's words from the block's first common one onwards
suffice (position) and the block has enough words (length); what is left is counted exactly. Templates are a fixed list, so
the index travels inside the plan as literals, and no row is shuffled but the counts of template words.

Defined results: a null text is empty; a text of any length is scanned whole; equal scores need no order, as only the
highest is told; repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, THRESHOLD = 64, 0.8

#: Base phrases, and notices and texts as their licences word them.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = {
    "apache-2": "licensed under the apache license version 2 0",
    "apache-notice": "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "isc-notice": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-release": "released under the mit license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "apache-2-header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "bsd-2": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "gpl-3-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "public-domain": "this is free and unencumbered software released into the public domain",
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), GAP), lambda w: w != "")


def ordered(documents: DataFrame, templates: dict[str, str]) -> list[str]:
    """The templates' distinct words, rarest in the corpus first."""
    vocabulary = sorted({w for t in templates.values() for w in t.split()})
    every = documents.select(F.explode(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), GAP)).alias("w"))
    counts = {r.w: r.n for r in every.where(F.col("w").isin(vocabulary)).groupBy("w").agg(F.count("*").alias("n")).collect()}  # a row for each template word at most
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the highest containment; 1 with a base
    label, as its phrase is there whole), blocks array<struct<block, label, overlap>>."""
    vocabulary = ordered(documents, templates)
    rank = {w: i + 1 for i, w in enumerate(vocabulary)}
    rows, rare = [], set()
    for label, text in sorted(templates.items()):
        ranks = sorted({rank[w] for w in text.split()})
        need = math.ceil(threshold * len(ranks) - 1e-9)
        prefix = ranks[: len(ranks) - need + 1]
        rare |= {vocabulary[r - 1] for r in prefix}
        own = lambda ranks: F.array(*(F.lit(vocabulary[r - 1]) for r in ranks))
        length = max(LEAST, 2 * len(text.split()))
        numbers = {"label": label, "need": need, "size": len(ranks), "length": length}
        rows.append(F.struct(*(F.lit(v).alias(k) for k, v in numbers.items()), own(prefix).alias("prefix"), own(ranks).alias("words")))
    all_templates = F.array(*rows)

    text = F.coalesce("text", F.lit(""))
    own = documents.select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), words(text).alias("words"))
    own = own.withColumn("padded", F.when(F.arrays_overlap("words", F.array(*(F.lit(p.split()[-1]) for p in PHRASES))), F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))))

    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    count, first, last, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        size = len(phrase.split())
        inner = " " + "  ".join(phrase.split()) + " "
        n = (F.length("padded") - F.length(F.replace("padded", F.lit(inner), F.lit("")))) / len(inner)
        there = F.coalesce(F.contains(F.col("padded"), F.lit(inner)), F.lit(False))
        count.append(F.when(there, n.cast("long")).otherwise(0))
        first.append(F.when(there, (spaces(F.substring_index("padded", inner, 1)) / 2).cast("long")))
        last.append(F.when(there, F.col("n_words") - size - (spaces(F.substring_index("padded", inner, -1)) / 2).cast("long")))
        labels.append(F.when(there, F.lit(label)))

    words_at = lambda i: F.get("words", i)
    rare_places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: words_at(i).isin(sorted(rare)))

    def blocks_of(t: Column, places: Column) -> Column:
        """Starts, label and containment of the blocks around the template's prefix words that hold enough of it."""
        around = lambda i: F.filter(F.sequence(F.greatest(F.lit(0), i - t["length"] + 1), i), lambda s: F.array_contains(t["words"], words_at(s)))
        starts = F.array_distinct(F.flatten(F.transform(F.filter(places, lambda i: F.array_contains(t["prefix"], words_at(i))), around)))

        def common(s: Column) -> Column:
            block = F.slice("words", s + 1, t["length"])
            met = F.array_intersect(t["words"], block)  # in the order of rarity
            placed = t["size"] - F.array_position(t["words"], F.element_at(met, 1)) + 1 >= t["need"]
            return F.when((F.size(block) >= t["need"]) & placed, F.size(met)).otherwise(0)

        counted = F.filter(F.transform(starts, lambda s: F.struct(s.cast("long").alias("block"), common(s).alias("n"))), lambda m: m["n"] >= t["need"])
        return F.transform(counted, lambda m: F.struct(m["block"].alias("block"), t["label"].alias("label"), (m["n"] / t["size"]).alias("overlap")))

    # places are found once for all templates: they are an array of their own, and each template looks at its own among them
    blocks = F.flatten(F.flatten(F.transform(F.array(rare_places), lambda places: F.transform(all_templates, lambda t: blocks_of(t, places)))))
    none = F.expr("cast(array() as array<struct<block: bigint, label: string, overlap: double>>)")
    base = F.array_compact(F.array(*labels))
    found = own.select(
        "doc_id",
        "n_words",
        sum(count[1:], count[0]).alias("n_base"),
        F.least(*first).alias("first_word"),
        F.greatest(*last).alias("last_word"),
        base.alias("base"),
        F.when(F.arrays_overlap("words", F.array(*map(F.lit, sorted(rare)))), blocks).otherwise(none).alias("blocks"),
    )
    both = F.array_distinct(F.concat("base", F.transform("blocks", lambda b: b["label"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.sort_array(both), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("blocks", lambda b: b["overlap"])), F.lit(0.0))).alias("score"),
        "blocks",
    )
