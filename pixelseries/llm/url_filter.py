"""URL filter: a rule list first, gradient-boosted trees on lexical features for the rest.

A rule (host, path) fits its host and all subdomains when the URL's path starts with the
rule's path; the longest rule wins. URLs that a rule decides are the labelled ones: the
trees learn from a bounded number of distinct ones and judge every URL that no rule fits.

All features are built-in expressions: lengths, depth, digit ratios, character entropy,
parameter counts, and statistics of the host's last labels, among them the share of blocked
URLs among labelled ones with the same last label. Hosts fall into folds by a hash; that
share never counts URLs of the row's own fold, so no label enters its own features. The
hosts of fold 0 train nothing, and ``held_out_accuracy`` tells how the trees do on them.

Odd rows: a null URL or one without "://" has an empty host and path, so no rule fits, and
the trees judge its (zero) features; URLs of any length are measured whole; repeated rows get
equal verdicts, and a repeated URL trains once. Other columns pass through whatever their
names; columns named like a result are replaced. An empty table gives no rows. With fewer
than two classes among the labelled URLs there is nothing to learn: every other URL then gets
that class, or ``allow``.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, staged

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: A rule list of up to so many is compiled into one expression; a longer one is joined.
MAX_RULES = 500
#: At most so many distinct labelled URLs (about) train the trees; which ones depends on a hash of the URL.
MAX_TRAINING_URLS = 20_000
#: Folds of hosts; those of fold 0 are held out.
FOLDS = 5
#: The share of blocked URLs of a last label is drawn to the mean as by so many rows of it.
PRIOR_ROWS = 20.0

FEATURES = (
    "url_chars host_chars path_chars query_chars depth host_labels digit_ratio host_digit_ratio path_digits hyphens entropy "
    "params fragment secure extension suffix_chars second_chars suffix_vowel_ratio first_label_chars first_step_chars"
).split()
INPUTS = (*FEATURES, "suffix_block_rate")
#: Above so many rows of (last label, fold) their table is joined by a shuffle instead of a broadcast.
MAX_BROADCAST_SUFFIXES = 50_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no "://"."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.when(has, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")
    path = F.when(has, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls; for lists of up to ``MAX_RULES``."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for on, under, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == on) | F.endswith(host, F.lit("." + on))) & F.startswith(path, F.lit(under))
        name, verdict = F.when(fits, F.lit(on + under)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def judged_by_join(urls: DataFrame, rules) -> DataFrame:
    """``urls`` (with host and path) with ``rule`` and ``ruled`` by a list of any length.

    Each distinct host and path asks for the rules of the host and its parent domains, at every length of path that a rule
    has: an equality join, of as many keys as the host has labels times such lengths.
    """
    spark = urls.sparkSession
    listed = spark.createDataFrame([(h, p, v) for h, p, v in rules], "_on string, _under string, _verdict string")
    lengths = F.lit(sorted({len(p) for _, p, _ in rules}))
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    heads = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), 1, n))
    asked = urls.select("host", "path").distinct().select("host", "path", F.explode(domains).alias("_on"), heads.alias("_heads"))
    asked = asked.select("host", "path", "_on", F.explode("_heads").alias("_under"))
    met = asked.join(bounded(listed, MAX_BROADCAST_SUFFIXES), ["_on", "_under"])
    longest = F.max(F.struct((F.length("_on") + F.length("_under")).alias("n"), "_on", "_under", "_verdict")).alias("_r")
    best = met.groupBy(F.col("host").alias("_host"), F.col("path").alias("_path")).agg(longest)
    joined = urls.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return joined.withColumns({"rule": F.concat("_r._on", "_r._under"), "ruled": F.col("_r._verdict")}).drop("_host", "_path", "_r")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _found(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.element_at(F.split(host, r"\."), -1)


def features(url: Column, host: Column, path: Column) -> Column:
    """One struct of the lexical features of a URL."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    last, second = suffix(host), F.coalesce(F.get(labels, F.size(labels) - 2), F.lit(""))
    n = F.length(url)
    p = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    letters = F.filter(F.array_distinct(F.split(url, "")), lambda c: c != "")
    made = {
        "url_chars": n,
        "host_chars": F.length(host),
        "path_chars": F.length(path),
        "query_chars": F.length(query),
        "depth": _found("/[^/]", path),
        "host_labels": F.when(host == "", F.lit(0)).otherwise(F.size(labels)),
        "digit_ratio": _share(_found("[0-9]", url), n),
        "host_digit_ratio": _share(_found("[0-9]", host), F.length(host)),
        "path_digits": _found("[0-9]", path),
        "hyphens": _found("-", url),
        "entropy": F.aggregate(letters, F.lit(0.0), lambda a, c: a - p(c) * F.log2(p(c))),
        "params": _found("[^&]+", query),
        "fragment": F.contains(url, F.lit("#")),
        "secure": F.startswith(url, F.lit("https:")),
        "extension": F.rlike(path, F.lit(r"\.[a-z0-9]{1,5}$")),
        "suffix_chars": F.length(last),
        "second_chars": F.length(second),
        "suffix_vowel_ratio": _share(_found("[aeiou]", last), F.length(last)),
        "first_label_chars": F.length(F.get(labels, F.lit(0))),
        "first_step_chars": F.length(F.regexp_extract(path, "^/([^/]*)", 1)),
    }
    return F.struct(*[made[name].cast("double").alias(name) for name in FEATURES])


def fold(host: Column) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS)).cast("int")


def label_counts(labelled: DataFrame) -> DataFrame:
    """(_suffix, _fold, _bad, _all, _urls): labelled rows of each last label, outside of each fold and (fold -1) in all; staged.

    ``_urls``, for fold -1, is the number of distinct URLs that may train.
    """
    own = labelled.groupBy(suffix(F.col("host")).alias("_suffix"), fold(F.col("host")).alias("_fold")).agg(
        F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("_bad"),
        F.count("*").alias("_all"),
        F.approx_count_distinct("url").alias("_urls"),
    )
    # A URL has one suffix and one fold, so numbers of distinct ones add up; those of fold 0 do not train.
    urls = F.sum(F.when(F.col("_fold") == 0, 0).otherwise(F.col("_urls"))).alias("_urls")
    whole = own.groupBy("_suffix").agg(F.sum("_bad").alias("_bad"), F.sum("_all").alias("_all"), urls)
    own = own.drop("_urls")
    rest = own.withColumnsRenamed({"_bad": "_b", "_all": "_a"}).join(whole, "_suffix")
    rest = rest.select("_suffix", "_fold", (F.col("_bad") - F.col("_b")).alias("_bad"), (F.col("_all") - F.col("_a")).alias("_all"))
    return staged(rest.unionByName(whole.withColumn("_fold", F.lit(-1)), allowMissingColumns=True), "url-suffixes")


def with_inputs(urls: DataFrame, counts: DataFrame, mean: float) -> DataFrame:
    """Add the vector ``_x`` of all inputs to rows with ``url``, ``host``, ``path`` and ``ruled``.

    A labelled row takes the counts outside of its fold, any other those of all labelled rows.
    """
    at = F.when(F.col("ruled").isNotNull(), fold(F.col("host"))).otherwise(-1)
    rows = urls.withColumns({"_suffix": suffix(F.col("host")), "_fold": at, "_f": features(F.col("url"), F.col("host"), F.col("path"))})
    rows = rows.join(bounded(counts, MAX_BROADCAST_SUFFIXES), ["_suffix", "_fold"], "left")
    bad, seen = F.coalesce("_bad", F.lit(0)), F.coalesce("_all", F.lit(0))
    rate = (bad + mean * PRIOR_ROWS) / (seen + PRIOR_ROWS)
    vector = array_to_vector(F.array(*[F.col(f"_f.{name}") for name in FEATURES], rate.cast("double")))
    return rows.withColumn("_x", vector).drop("_suffix", "_fold", "_f", "_bad", "_all", "_urls")


def train(labelled: DataFrame, counts: DataFrame, rounds: int = 20, depth: int = 4, max_rows: int = MAX_TRAINING_URLS):
    """(the one class there is, if there is no second; the share of blocked rows; boosted trees).

    Distinct labelled URLs of the hosts that are not held out train, as a hash of the URL draws them, so reruns agree.
    """
    whole = counts.filter("_fold = -1").agg(F.sum("_bad").alias("bad"), F.sum("_all").alias("all"), F.sum("_urls").alias("urls")).first()
    bad, seen = whole["bad"] or 0, whole["all"] or 0
    if bad in (0, seen):
        return int(seen > 0 and bad == seen), bad / seen if seen else 0.0, None
    share = min(1.0, max_rows / max(1, whole["urls"]))
    drawn = labelled.filter((fold(F.col("host")) != 0) & (F.pmod(F.xxhash64("url"), F.lit(1_000_003)) < F.lit(share * 1_000_003)))
    rows = with_inputs(drawn.distinct(), counts, bad / seen)
    rows = staged(rows.select("_x", (F.col("ruled") == "block").cast("double").alias("label")), "url-training")
    kinds = [r["label"] for r in rows.select("label").distinct().collect()]  # at most two
    if len(kinds) < 2:
        return int(kinds[0]) if kinds else int(2 * bad > seen), bad / seen, None
    trees = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=rounds, maxDepth=depth, seed=7, maxBins=32)
    return None, bad / seen, trees.fit(rows.repartition(4))


def scored(df: DataFrame, url_col: str = "url", rules=RULES, **training) -> DataFrame:
    """(row, url, host, path, rule, ruled, block_score) of each row of ``df``, with the row as a struct."""
    host, path = parts(F.col(url_col))
    urls = df.select(F.struct(*df.columns).alias("row"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    if len(rules) > MAX_RULES:
        urls = judged_by_join(urls, rules)
    else:
        name, verdict = ruled(F.col("host"), F.col("path"), rules)
        urls = urls.withColumns({"rule": name, "ruled": verdict})
    labelled = urls.select("url", "host", "path", "ruled").filter(F.col("ruled").isNotNull())
    counts = label_counts(labelled)
    only, mean, model = train(labelled, counts, **training)
    if model is None:
        return urls.withColumn("block_score", F.lit(float(only)))
    model = model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    told = model.transform(with_inputs(urls, counts, mean))
    return told.withColumn("block_score", F.get(vector_to_array("_p"), F.lit(1))).drop("_x", "_p")


def url_filter(df: DataFrame, url_col: str = "url", rules=RULES, **training) -> DataFrame:
    """Add host, path, rule, verdict and ``block_score`` (the trees' probability, for every URL)."""
    made = ("host", "path", "rule", "verdict", "block_score")
    told = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    out = scored(df, url_col, rules, **training).withColumn("verdict", F.coalesce("ruled", told))
    kept = [c for c in df.columns if c.lower() not in made]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *made)


def held_out_accuracy(df: DataFrame, url_col: str = "url", rules=RULES, **training) -> float | None:
    """The share of rows on labelled hosts of fold 0 whose verdict by the trees alone is that of the rule."""
    rows = scored(df, url_col, rules, **training).filter(F.col("ruled").isNotNull() & (fold(F.col("host")) == 0))
    right = (F.col("block_score") >= 0.5) == (F.col("ruled") == "block")
    return rows.agg(F.avg(right.cast("int"))).first()[0]
