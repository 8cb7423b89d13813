"""License scan: exact phrases, and an exact set-similarity join with license templates.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. Text
blocks are the lines, and windows of the words of the whole text that no line break ends:
with L the words of the longest template, window k holds the 2 L words from word k L on, so
that every run of L + 1 words lies in a window however it is wrapped. A block matches a
template when it holds at least ``threshold`` of the template's distinct words. The join is
exact: template words are ordered by how many
documents of the corpus hold them, rarest first; a block that matches must hold one of the
first |T| - need + 1 words of the template (prefix filter), at least ``need`` template words
at all (length filter), and enough words must follow on both sides of the shared one
(positional filter). What is left is verified by counting the words in common.
Of templates of one family (each notice of Creative Commons holds the words of the plainest) the fullest that stands in a block wins
there. Containment is of words, in any order: a window that holds a notice's words in other sentences matches too.

Only words of templates can add to an overlap, so blocks keep those alone; the template
list is a parameter of bounded size, as is everything that is broadcast or collected.

Odd rows: a null or empty text has no words: counts 0, first and last word null, labels
empty strings, score 0. Repeated rows each get the same result; rows that share a
``doc_id`` but not a text are told apart. Texts of any length are scanned whole: a text is an
array of words in its task. Other columns pass through whatever their names; columns named
like a result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, ascii_lower, whole_text

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: (phrase, label)
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: (label, notice): the opening words of well-known public license notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "You can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike International License"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
)
#: (label, notice): later parts of the same notices, for texts that hold only those.
LATER_PARTS = (
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "you may not use this file except in compliance with the License"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
)
THRESHOLD = 0.9


def license_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda x: x != "")


def split_words(text: str) -> list[str]:
    """The words of ``text``, as ``license_words`` splits them."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keep = lambda c: c if c.isascii() and (c.isdigit() or c.islower()) or not c.isascii() else " "
    return [w for w in "".join(map(keep, text.translate(fold))).split(" ") if w]


def template_sets(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    """(label, distinct words) of each template, split as texts are."""
    return [(label, list(dict.fromkeys(split_words(text)))) for label, text in templates]


def families(sets: list[tuple[str, list[str]]]) -> list[tuple[list[str], list[int]]]:
    """(words that tell it apart, fuller templates) of each template.

    A template whose words all stand in a fuller one with another label is of its family. The fuller one matches only where all words
    stand that the other lacks, and then it wins: the other does not match there.
    """
    wider = lambda a, b: a[0] != b[0] and set(a[1]) < set(b[1])
    own = [sorted({w for t in sets if wider(t, s) for w in set(s[1]) - set(t[1])}) for s in sets]
    return [(words, [k for k, t in enumerate(sets) if wider(s, t)]) for s, words in zip(sets, own)]


def need(size: int, threshold: float) -> int:
    return ceil(threshold * size - 1e-9)


def places(word_col: str, phrase: str) -> Column:
    """Start indexes of the phrase in the word array; looked for only where its rarest-looking word occurs."""
    steps = phrase.split(" ")
    n = F.size(word_col)
    fits = lambda i: F.forall(
        F.array(*[F.get(F.col(word_col), i + k) == F.lit(s) for k, s in enumerate(steps)]), lambda x: x
    )
    key = min(steps, key=lambda s: (s in ("under", "the", "by", "of", "version"), len(s)))
    maybe = (n >= len(steps)) & F.array_contains(word_col, key)
    return F.when(maybe, F.filter(F.sequence(F.lit(0), n - len(steps)), fits)).otherwise(F.array().cast("array<int>"))


def phrase_columns(df: DataFrame, p: str, text_col: str = "text", phrases=PHRASES) -> DataFrame:
    """Add n_words, n_base, first_word, last_word and an array of labels, all under names with the prefix ``p``."""
    df = df.withColumn(f"{p}w", license_words(whole_text(text_col)))
    df = df.withColumns({f"{p}{k}": places(f"{p}w", phrase) for k, (phrase, _) in enumerate(phrases)})
    cols = [F.col(f"{p}{k}") for k in range(len(phrases))]
    found = F.concat(*cols)
    labels = F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, (_, label) in zip(cols, phrases)])
    return df.withColumns(
        {
            f"{p}n_words": F.size(f"{p}w").cast("long"),
            f"{p}n_base": F.size(found).cast("long"),
            f"{p}first_word": F.array_min(found).cast("long"),
            f"{p}last_word": F.array_max(found).cast("long"),
            f"{p}base": F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isNotNull()))),
        }
    ).drop(f"{p}w", *[f"{p}{k}" for k in range(len(phrases))])


def word_order(df: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """The vocabulary, rarest first, by the number of documents that hold each word."""
    held = F.array_intersect(F.lit(vocabulary), license_words(whole_text(text_col)))
    counts = df.select(F.explode(held).alias("w")).groupBy("w").count().collect()
    seen = {r["w"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def blocks(text: str, words: str, order: list[str], longest: int) -> Column:
    """Words of ``order`` in each line, then in each window, of a text with at least one word."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.array_intersect(F.lit(order), license_words(line)))
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(longest))
    windows = F.transform(starts, lambda k: F.array_intersect(F.lit(order), F.slice(words, k + 1, 2 * longest)))
    return F.concat(lines, windows)


def template_matches(df: DataFrame, text_col: str = "text", templates=TEMPLATES + LATER_PARTS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, _text_key, block, label, template, containment) of every block and template that match."""
    spark = df.sparkSession
    sets = template_sets(templates)
    order = word_order(df, sorted({w for _, ws in sets for w in ws}), text_col)
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for k, ((label, ws), (apart_by, wider)) in enumerate(zip(sets, families(sets))):
        ws = sorted(ws, key=rank.__getitem__)
        least = need(len(ws), threshold)
        rows += [(w, k, label, i, len(ws), least, ws, apart_by, wider) for i, w in enumerate(ws[: len(ws) - least + 1])]
    index = spark.createDataFrame(
        rows,
        "word string, template int, label string, i int, t_size int, least int, t_words array<string>, apart array<string>, wider array<int>",
    )
    firsts = sorted({r[0] for r in rows})
    longest = max(len(split_words(text)) for _, text in templates)
    # A block that matches holds a prefix word, so its text does.
    texts = df.select(
        "doc_id",
        F.xxhash64(whole_text(text_col)).alias("_text_key"),
        whole_text(text_col).alias("_text"),
        license_words(whole_text(text_col)).alias("_words"),
    ).filter(F.arrays_overlap("_words", F.lit(firsts)))
    held = texts.select(
        "doc_id", "_text_key", F.posexplode(blocks("_text", "_words", order, longest)).alias("block", "_held")
    )
    held = held.filter(F.size("_held") >= min(r[5] for r in rows))
    probes = held.select(
        "doc_id",
        "_text_key",
        "block",
        "_held",
        F.explode(
            F.filter(F.transform("_held", lambda w, j: F.struct(w.alias("w"), j.alias("j"))), lambda x: x["w"].isin(firsts))
        ).alias("_probe"),
    ).select("*", F.col("_probe.w").alias("word"), F.col("_probe.j").alias("j"))
    size = F.size("_held")
    most = F.least("i", "j") + 1 + F.least(F.col("t_size") - F.col("i") - 1, size - F.col("j") - 1)
    overlap = F.size(F.array_intersect("t_words", "_held"))
    # The index has a row for each prefix word of the (bounded) template list.
    hits = (
        probes.join(F.broadcast(index), "word")
        .filter((size >= F.col("least")) & (most >= F.col("least")))
        .filter((overlap >= F.col("least")) & (F.size(F.array_except("apart", "_held")) == 0))
        .select("doc_id", "_text_key", "block", F.struct("template", "label", (overlap / F.col("t_size")).alias("containment"), "wider").alias("m"))
    )
    # A block has at most as many matches as there are templates.
    met = hits.groupBy("doc_id", "_text_key", "block").agg(F.collect_set("m").alias("m"))
    there = F.transform("m", lambda x: x["template"])
    won = F.filter("m", lambda x: ~F.arrays_overlap(x["wider"], there))
    return met.select("doc_id", "_text_key", "block", F.inline(won)).drop("wider")


def license_scan(df: DataFrame, text_col: str = "text", phrases=PHRASES, templates=TEMPLATES + LATER_PARTS, threshold=THRESHOLD) -> DataFrame:
    """All rows and columns of ``df`` with counts, places, ``base_labels``, ``labels`` and ``score``.

    ``score`` is 1 where a phrase stands, else the best containment of a template that matched, else 0.
    """
    made = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept, p = [c for c in df.columns if c.lower() not in made], apart(df.columns)
    matched = (
        template_matches(df, text_col, templates, threshold)
        .groupBy(F.col("doc_id").alias(f"{p}id"), F.col("_text_key").alias(f"{p}key"))
        .agg(F.collect_set("label").alias(f"{p}more"), F.max("containment").alias(f"{p}best"))
    )
    based = phrase_columns(df, p, text_col, phrases).withColumn(f"{p}text_key", F.xxhash64(whole_text(text_col)))
    joined = based.join(
        matched, F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}text_key") == F.col(f"{p}key")), "left"
    )
    every = F.array_sort(F.array_union(f"{p}base", F.coalesce(f"{p}more", F.array().cast("array<string>"))))
    return joined.select(
        *kept,
        *[F.col(f"{p}{c}").alias(c) for c in made[:4]],
        F.array_join(f"{p}base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col(f"{p}n_base") > 0, 1.0).otherwise(F.coalesce(f"{p}best", F.lit(0.0))).alias("score"),
    )
