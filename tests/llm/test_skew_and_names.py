"""Hot keys, long lists and clashing names of the corpus operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pixelseries.llm import exact_dedup, quality_rules, source_mix, url_filter, warc
from pixelseries.llm import license_scan as ls
from pixelseries.llm import common
from pixelseries.llm.common import ROW, set_aside

CREATIVE_COMMONS = {
    "cc-by": "Attribution", "cc-by-sa": "Attribution-ShareAlike", "cc-by-nd": "Attribution-NoDerivatives", "cc-by-nc": "Attribution-NonCommercial",
    "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike", "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}


def test_equal_rows_spread_over_window_partitions(spark, monkeypatch):
    """Half of the rows without an id and of one size: no window partition holds one row in a hundred."""
    n = 40_000
    rows = spark.range(n).select(F.when(F.col("id") % 2 == 1, F.col("id")).alias("doc_id"), F.lit("s").alias("source"), F.lit(3).cast("long").alias("size"))
    order = source_mix.parted(rows.withColumn("_order", F.coalesce("doc_id", F.lit(-1))), F.monotonically_increasing_id(), per_part=100)
    most = order.groupBy("_part", "_sub").count().filter("_sub > 0 OR _part = 1").agg(F.max("count")).first()[0]
    assert most < n // 100
    mixed = source_mix.mix(rows).cache()
    again = source_mix.mix(rows.repartition(7))
    key = ["doc_id", "taken", "positions"]
    assert mixed.select(*key).exceptAll(again.select(*key)).isEmpty() and mixed.count() == n
    # Words are laid end to end: every start of the first pass is met once, in spite of ties.
    starts = mixed.filter("taken > 0").select(F.get("positions", F.lit(0)).alias("p"))
    assert starts.distinct().count() == starts.count() and mixed.agg(F.sum("taken")).first()[0] == int(1.5 * 3 * n)


def test_carried_columns_may_bear_any_name(spark):
    frame = spark.createDataFrame([(1, "a b", "s"), (2, "c", None)], "doc_id long, text string, source string")
    names = ("target", "_order", "_place", "_c0", "TAKEN", "_start", "size")
    odd = frame.withColumns({c: F.lit("kept") for c in names})
    out = source_mix.source_mix(odd, carry=names)
    assert sorted(out.columns) == sorted(["doc_id", "source", "size", "source_size", "target", "taken", "positions", "_order", "_place", "_c0", "_start"])
    assert {r["_order"] for r in out.collect()} == {"kept"} and {r["size"] for r in out.collect()} == {2, 1}
    kept = quality_rules.quality_rules(odd.withColumns({"_m": F.lit(1), "n_words": F.lit(-5), "_judged": F.lit(2)}), keep=("doc_id", "_m", "n_words", "_judged"))
    assert {(r["_m"], r["_judged"], r["n_words"]) for r in kept.collect()} == {(1, 2, 2), (1, 2, 1)} and len(set(kept.columns)) == len(kept.columns)
    mine = frame.withColumn("_Row_Key", F.col("doc_id") * 10)
    out = exact_dedup.exact_dedup(mine)
    assert {(r["doc_id"], r["_Row_Key"]) for r in out.collect()} == {(1, 10), (2, 20)}
    assert {r["_Row_Key"] for r in exact_dedup.one_per_text(mine.unionByName(mine)).collect()} == {10, 20}
    renamed, back = set_aside(mine.withColumn("_aside", F.lit(1)), ROW)
    assert renamed.columns[-2:] == ["_aside_", "_aside"] and renamed.withColumnsRenamed(back).columns == mine.columns + ["_aside"]


def test_creative_commons_notices_are_told_apart(spark):
    texts = {f"{label}{k}": t for label, name in CREATIVE_COMMONS.items() for k, t in enumerate((
        f"This work is licensed under a Creative Commons {name} 4.0 International License.",
        f"words before\nThis work is licensed under a\nCreative Commons {name} 4.0\nInternational License. To view a copy of this license, visit",
    ))}
    texts["both0"] = "This work is licensed under a Creative Commons Attribution 4.0 International License.\n" + "other words here " * 40
    texts["both0"] += "\nThis work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    frame = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in ls.license_scan(frame).collect()}
    want = {k: {"both": "cc-by,cc-by-nc"}.get(label[:-1], label[:-1]) for k, label in enumerate(texts)}
    assert got == want


def test_every_distinct_url_may_train(spark, monkeypatch):
    """Repeated URLs count once, so the share that is drawn is that of distinct ones."""
    urls = [f"http://h{k}.example.{'org' if k % 2 else 'com'}/{'fr' if k % 2 else 'de'}/{k}" for k in range(400)]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("x", F.explode(F.array_repeat(F.lit(1), 500)))
    host, path = url_filter.parts(F.col("url"))
    rows = pages.select("url", host.alias("host"), path.alias("path"))
    name, verdict = url_filter.ruled(F.col("host"), F.col("path"))
    labelled = rows.withColumn("ruled", verdict).filter("ruled IS NOT NULL").cache()
    counts = url_filter.label_counts(labelled)
    seen = []
    monkeypatch.setattr(url_filter, "staged", lambda df, name: seen.append(df.count()) or df)
    url_filter.train(labelled, counts, rounds=1, max_rows=20_000)
    train = labelled.filter(url_filter.fold(F.col("host")) != 0).select("url").distinct().count()
    assert seen == [train]


def test_long_rule_lists_are_joined(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/", "block"), ("a.com", "/f", "block")]
    urls = [
        "http://x.example.org/es/1", "http://example.org/es", "http://org/", "http://a.com/fr/2", "http://b.a.com/f", "http://com", "nothing", None, "http://example.org/es/1?q",
        "http://xorg/", "http://.org/a", "http://a.com/fr/2",
    ]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_filter.parts(F.col("url"))
    rows = frame.select("url", host.alias("host"), path.alias("path"))
    name, verdict = url_filter.ruled(F.col("host"), F.col("path"), rules)
    want = sorted(map(tuple, rows.withColumns({"rule": name, "ruled": verdict}).collect()), key=repr)
    filler = [(f"h{k}.net", f"/p{k}", "block") for k in range(url_filter.MAX_RULES)]
    for more in ([], filler):
        got = url_filter.judged_by_join(rows, rules + more).select("url", "host", "path", "rule", "ruled")
        assert sorted(map(tuple, got.collect()), key=repr) == want
    out = url_filter.url_filter(frame.withColumn("page_id", F.lit(1)), rules=tuple(rules + filler))
    assert {(r["url"], r["rule"]) for r in out.collect()} == {(r[0], r[3]) for r in want}


def test_archives_refuse_ids_that_are_no_integers(spark):
    pages = spark.createDataFrame([("p1", "http://x", "html")], "page_id string, url string, html string")
    with pytest.raises(TypeError):
        warc.round_trip(pages)


def test_training_order_holds_beyond_five_digits(spark):
    paths = ["s/part-00002.parquet", "s/part-100000.parquet", "s/part-99999.parquet"]
    rows = spark.createDataFrame([((p, k),) for p in paths for k in (1, 0)], f"{ROW} struct<file_path string, row_index long>")
    got = [tuple(r[ROW]) for r in rows.orderBy(*corpus_pipeline.in_file_order(rows)).collect()]
    assert got == [(p, k) for p in (paths[0], paths[2], paths[1]) for k in (0, 1)]


@pytest.mark.parametrize("bitmaps", [8192, 0])
def test_losers_leave_by_bitmaps_or_by_a_join(spark, monkeypatch, bitmaps):
    """Several files, bitmaps of more rows than one holds, rows at their edges, and the join beyond the bound."""
    monkeypatch.setattr(common, "MAX_BITMAPS", bitmaps)
    path = common.new_path(spark, "many-rows")
    spark.range(150_000).repartition(2).withColumn("_xbits", F.lit(1)).write.parquet(path)
    for df in (spark.read.parquet(path), spark.range(100_000).sort("id")):  # a scan, and a table that is written first
        rows = common.keyed(df, "rows")
        place = F.col(f"{ROW}.row_index")
        lose = place.isin(0, 7, 8, 32767, 32768, 65535, 65536) | (F.col("id") % 11 == 3)
        kept = common.dropped(rows, rows.filter(lose).select(ROW))
        assert kept.columns == rows.columns
        assert kept.select("id").exceptAll(rows.filter(~lose).select("id")).isEmpty() and kept.count() == rows.filter(~lose).count()
    assert common.is_scan(spark.read.parquet(path).filter("id > 1")) and not common.is_scan(spark.range(3)) and not common.is_scan(spark.read.parquet(path).limit(2))
    assert common.dropped(rows, rows.limit(0).select(ROW)).count() == rows.count()
