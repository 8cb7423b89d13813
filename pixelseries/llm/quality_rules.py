"""Rule-based quality filter: a threshold table compiled into one projection.

Every measure is a built-in expression over the whole text. Results for odd rows:
a null or empty text has no words, so it fails the base rule and all measures are
zero; ratios over zero words or lines count as zero; texts of any length are measured
whole, each in its task; kept columns pass through unread, those named like a result are replaced, and a
repeated row gets the same verdict each time. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, let, unused, whole_text, words

#: Common function words of the languages that the corpus holds (English, German, French, Spanish).
STOP_WORDS = (
    "the of and to in that is was for on with as it by at from this are be or an "
    "der die das und ist in von mit den zu auf für im dem nicht ein eine als auch sich des "
    "le la les de des et en un une du que est pour dans par sur au qui pas plus "
    "el los las y del se por con para su al lo como es no una"
).split()

#: (measure, least, most); None leaves that side open. A text is kept if every measure is within its bounds.
THRESHOLDS = (
    ("mean_word_length", 2.0, 14.0),
    ("symbols_per_word", None, 0.20),
    ("marks_per_word", None, 0.25),
    ("pipe_word_ratio", None, 0.20),
    ("capital_ratio", None, 0.40),
    ("stop_word_ratio", 0.04, None),
    ("dup_line_ratio", None, 0.50),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count(pattern: str, text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def repeat_words(w: Column) -> Column:
    """Number of words of the array ``w`` that lie in a 3-word window found twice or more in it.

    Windows are compared by their 64-bit hash. Start positions of repeated windows, in order,
    each cover three words less the overlap with the next one.
    """
    hashes = F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def starts(ranked: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ranked, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(
            F.transform(F.filter(ranked, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])
        )

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def count(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        some = let(ranked, lambda r: let(starts(r), covered))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), some).otherwise(F.lit(0).cast("long"))

    return let(hashes, count)


def counts(t: Column, w: Column, lines: Column) -> Column:
    stop = F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, WS_CLASS + "+", "")).cast("long").alias("word_chars"),
        _count(r"[#*$%&|<>]+", t).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        _count(r"[!?]+", t).alias("marks"),
        _count(r"\p{Lu}+", t).alias("capitals"),
        F.size(stop).cast("long").alias("stops"),
        F.size(F.filter(w, lambda x: x == "|")).cast("long").alias("pipes"),
    )


def ratios(c: Column) -> dict[str, Column]:
    n = c["n_words"]
    return {
        "mean_word_length": _ratio(c["word_chars"], n),
        "symbols_per_word": _ratio(c["n_symbols"], n),
        "marks_per_word": _ratio(c["marks"], n),
        "pipe_word_ratio": _ratio(c["pipes"], n),
        "capital_ratio": _ratio(c["capitals"], c["word_chars"]),
        "stop_word_ratio": _ratio(c["stops"], n),
        "dup_line_ratio": _ratio(c["n_dup_lines"], c["n_lines"]),
    }


def broken(rule: tuple, r: Column) -> Column:
    name, least, most = rule
    low = F.lit(False) if least is None else r[name] < least
    high = F.lit(False) if most is None else r[name] > most
    return F.when(low | high, F.lit(name))


def verdict(text: Column, thresholds=THRESHOLDS, min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """One struct of counts, ratios, ``base_failed``, ``broken_rules`` (names, in table order) and ``kept``.

    It is a single expression whose parts are bound by ``let``, so a filter on a field of it
    that is pushed below other projections still measures each text once.
    """

    def judged(c: Column, r: Column) -> Column:
        n = c["n_words"]
        base = (n < min_words) | (100 * c["n_repeat_words"] > max_repeat_percent * n)
        rules = F.filter(F.array(*[broken(x, r) for x in thresholds]), lambda x: x.isNotNull())
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return let(
            F.struct(base.alias("b"), rules.alias("r")),
            lambda v: F.struct(
                *[c[x].alias(x) for x in names],
                *[r[x].alias(x) for x, _, _ in THRESHOLDS],
                v["b"].alias("base_failed"),
                v["r"].alias("broken_rules"),
                (~v["b"] & (F.size(v["r"]) == 0)).alias("kept"),
            ),
        )

    def of_counts(c: Column) -> Column:
        return let(F.struct(*[x.alias(k) for k, x in ratios(c).items()]), lambda r: judged(c, r))

    def of_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(words(t), lambda w: let(lines, lambda ls: let(counts(t, w, ls), of_counts)))

    return let(text, of_text)


def quality_rules(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), **limits) -> DataFrame:
    """The columns ``keep`` of ``df`` with the fields of ``verdict``; kept columns named like a field are replaced by it."""
    judged = unused("_judged", keep)
    rows = df.select(*keep, verdict(whole_text(text_col), **limits).alias(judged))
    fields = rows.schema[judged].dataType.names
    taken = {f.lower() for f in fields}
    return rows.select(*[c for c in keep if c.lower() not in taken], *[F.col(judged)[f].alias(f) for f in fields])


def kept_documents(df: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``df``, all columns, that no rule rejects."""
    return df.filter(verdict(whole_text(text_col), **limits)["kept"])
