"""Quality rules, exact dedup, source mix, license scan and URL filter on small tables, against plain Python."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from pixelseries.llm import exact_dedup as xd
from pixelseries.llm import license_scan as ls
from pixelseries.llm import quality_rules as qr
from pixelseries.llm import queries as q
from pixelseries.llm import source_mix as sm
from pixelseries.llm import url_filter as uf

from ..conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"
LONG = "word " * 30_000


def docs(spark, rows):
    """Rows of (doc_id, text[, source]); two columns clash with results."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (4, "a b c"), (None, "a  b c"), (5, LONG), (6, "a b c a b c\na b c a b c\n\nx"), (7, "é ß 漢字 😀")]


@pytest.mark.parametrize("name", ["op2_source_mix", "op5_quality_rules", "op6_license_scan", "op8_exact_dedup", "op10_warc"])
def test_against_sql(spark, same, name):
    same(q.queries()[name](spark, SF), q.oracle_sql()[name])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_counts(spark):
    got = {(r["doc_id"], r["n_words"]): r for r in qr.quality_rules(docs(spark, ODD)).collect()}
    for doc_id, text in ODD:
        w = words(text)
        r = got[doc_id, len(w)]
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        seen = {}
        for t in tri:
            seen[t] = seen.get(t, 0) + 1
        covered = {i + k for i, t in enumerate(tri) if seen[t] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert r["word_chars"] == sum(map(len, w)) and r["n_repeat_words"] == len(covered)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert qr.quality_rules(docs(spark, [])).count() == 0


def test_quality_verdict(spark):
    clean = "The cat sat on the mat and the dog was in the house for a while with it. "
    varied = " ".join(f"{w}{k}" if i % 3 else w for k in range(9) for i, w in enumerate(clean.split()))
    shout = " ".join(f"{w.upper()}!!" for w in varied.split())
    rows = [(1, varied), (2, shout), (3, " | ".join(varied.split())), (4, " ".join(f"{w}###" for w in varied.split()))]
    kept = {r["doc_id"] for r in qr.kept_documents(docs(spark, rows)).collect()}
    assert kept == {1}
    assert qr.kept_documents(docs(spark, rows)).columns == [c.split(" ")[0] for c in DOCS.split(", ")]


@pytest.mark.parametrize("support", [0.5, 0.005])
def test_exact_dedup(spark, support):
    rows = [*ODD, *[(100 + k, "hot  text" if k == 7 else "hot text") for k in range(50)], (99, "hottext")]
    got = xd.exact_dedup(docs(spark, rows), support=support).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    want = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[3], len(v)) for k, v in groups.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]] and (not r["kept"] or r["doc_id"] == r["keep_id"])
    assert sorted(r["text_sha256"] for r in got if r["kept"]) == sorted(want)
    assert want[hashlib.sha256(b"hottext").hexdigest()] == (107, 51)
    assert xd.exact_dedup(docs(spark, [])).count() == 0


@pytest.mark.parametrize("support", [0.5, 0.005])
@pytest.mark.parametrize("wide", [True, False])
def test_exact_dedup_keeps_one_row_of_each_group(spark, support, wide):
    """Repeated rows, a shorter text under the winner's id, null ids: one row stays, and it is the longest."""
    rows = [(4, "a b c"), (4, "a b c"), (4, "a bc"), (None, "x"), (None, "x"), (9, " x"), (None, "y"), (None, "y"), (None, " y")] * 3
    table = docs(spark, rows).withColumnsRenamed({"n_chars": "points", "lang": "keep_row"})
    got = xd.exact_dedup(table if wide else table.select("doc_id", "text"), support=support)
    assert len(got.columns) == (10 if wide else 5)
    got = got.collect()
    groups = [("abc", 4), ("x", 9), ("y", None)]
    assert sorted(((r["text_sha256"], r["doc_id"]) for r in got if r["kept"]), key=repr) == sorted(((hashlib.sha256(t.encode()).hexdigest(), i) for t, i in groups), key=repr)
    assert len(got) == len(rows) and {r["group_size"] for r in got} == {9}
    if wide:
        assert sorted(r["text"] for r in got if r["kept"]) == [" x", " y", "a b c"]
    assert sorted(r["text"] for r in xd.one_per_text(table, support=support).collect()) == [" x", " y", "a b c"]


def test_exact_dedup_aggregates_by_hash(spark):
    plan = q.op8_exact_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def resharing(sizes, weights, budget=1.5, most=2.0):
    """Targets by rounds: share out, cap, share the excess again."""
    names = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    w = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), budget * sum(sizes.values())
    while left > 1e-9 and free:
        total, share, left = sum(w[n] for n in free), left, 0.0
        for n in sorted(free, key=str):
            target[n] += share * w[n] / total
            if target[n] >= most * sizes[n]:
                left += target[n] - most * sizes[n]
                target[n] = most * sizes[n]
                free.discard(n)
    return target


def test_source_mix(spark):
    rows = [(k, "w " * (k * 37 % 91), f"s{k % 3}" if k % 2 else "hot") for k in range(400)]
    rows += [(900, "a b c", None), (901, None, None), (901, None, None), (None, "x y", "s1"), (902, "", "empty")]
    got = sm.source_mix(docs(spark, rows)).collect()
    again = sm.source_mix(docs(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr) and len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = resharing(sizes, (5, 2, 1))
    for source, size in sizes.items():
        own = [r for r in got if r["source"] == source]
        assert all(r["target"] == pytest.approx(want[source]) and r["source_size"] == size for r in own)
        assert abs(sum(r["taken"] for r in own) - want[source]) <= 1
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert all(0 <= p <= 1 for r in own for p in r["positions"])
    assert sm.source_mix(docs(spark, [])).count() == 0


def test_positions_meet_the_demand(spark):
    """By time t a source has placed the share of its target that its integrated schedule asks for."""
    for turn, schedule in enumerate(sm.SCHEDULES):
        shares = spark.range(101).select((F.col("id") / 100).alias("s"))
        for r in shares.select("s", sm.position(F.col("s"), F.lit(turn), sm.SCHEDULES).alias("t")).collect():
            knots = [k / (len(schedule) - 1) for k in range(len(schedule))]
            done = 0.0
            for a, b, x, y in zip(knots, knots[1:], schedule, schedule[1:]):
                upto = min(max(r["t"] - a, 0), b - a)
                done += upto * (x + x + (y - x) * upto / (b - a)) / 2
            assert done / sm.integrals(schedule)[-1] == pytest.approx(r["s"], abs=1e-9)


def test_license_scan(spark):
    rows = [
        *ODD,
        (20, "x UNDER the-MIT_License! under the mit license"),
        (21, "Apache License, Version 2.0 cc by nc cc by nc"),
        (22, "This work is licensed under the GNU General Public License, version 3."),
        (23, "this work is licensed under the general public"),
        (24, "under the\nmit license"),
        (20, "nothing here"),
    ]
    got = {(r["doc_id"], r["n_words"]): r for r in ls.license_scan(docs(spark, rows)).collect()}
    for doc_id, text in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
        at, labels = [], set()
        for phrase, label in ls.PHRASES:
            p = phrase.split(" ")
            hits = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
            at += hits
            labels |= {label} if hits else set()
        base = set(labels)
        for line in folded.split("\n"):
            held = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line))
            labels |= {lb for lb, ws in ls.template_sets() if len(held & set(ws)) >= ls.need(len(ws), ls.THRESHOLD)}
        r = got[doc_id, len(w)]
        assert (r["n_base"], r["first_word"], r["last_word"]) == (len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(labels))
    assert got[22, 12]["labels"] == "gpl" and got[23, 8]["labels"] == "" and got[20, 2]["labels"] == ""
    assert ls.license_scan(docs(spark, [])).count() == 0


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published"


def test_license_notices_in_any_wrapping(spark):
    """Notices are found wherever their lines break, wherever they stand, and by their later parts."""
    lay = lambda text, n: "\n * ".join(" ".join(text.split()[k : k + n]) for k in range(0, len(text.split()), n))
    rows, want = [], {}
    for label, notice in (("mit", MIT), ("bsd", BSD), ("gpl", GPL), ("apache-2", APACHE), ("mpl", MPL)):
        for n in (1, 3, 5, 8, 10):
            for ahead in (0, 7, 23, 40):
                want[len(rows)] = label
                rows.append((len(rows), "zzz " * ahead + "\n" + lay(notice, n) + "\n" + "yyy " * 30))
    for label, text in ls.LATER_PARTS:
        want[len(rows)] = label
        rows.append((len(rows), "Our notes.\n" + lay(text, 6)))
    rows += [(k, lay("zzz " * 60 + GPL[:30] + "yyy " * 60 + GPL[45:75], 9)) for k in (500, None)]
    got = {r["doc_id"]: r for r in ls.license_scan(docs(spark, rows)).collect()}
    assert {k: got[k]["labels"] for k in want} == want
    assert got[500]["labels"] == got[None]["labels"] == "" and got[500]["score"] == 0
    assert all((got[k]["base_labels"] == "" or want[k] == "apache-2") and got[k]["score"] >= ls.THRESHOLD for k in want)
    found = ls.template_matches(docs(spark, rows)).groupBy("doc_id", "template").count().collect()
    longest = max(len(ls.split_words(t)) for _, t in ls.TEMPLATES + ls.LATER_PARTS)
    sets, plain = ls.template_sets(ls.TEMPLATES + ls.LATER_PARTS), {}
    for doc_id, text in rows:
        w = ls.split_words(text.replace("\n", " "))
        held = [set(ls.split_words(x)) for x in text.split("\n")] + [set(w[k : k + 2 * longest]) for k in range(0, len(w), longest)]
        for k, (_, ws) in enumerate(sets):
            n = sum(len(h & set(ws)) >= ls.need(len(ws), ls.THRESHOLD) for h in held)
            plain |= {(doc_id, k): n} if n else {}
    # A block is found once for each prefix word it holds.
    assert {(r["doc_id"], r["template"]) for r in found} == set(plain)


def test_license_scan_passes_clashing_columns(spark):
    more = "_id _key _more _best _w _base _text_key _p0 _xw _X_id".split()
    rows = [(1, GPL, *more), (2, None, *more), (2, None, *more)]
    got = ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in more))).collect()
    assert len(got) == 3 and all(r[c] == c for r in got for c in more)
    assert sorted((r["doc_id"], r["labels"]) for r in got) == [(1, "gpl"), (2, ""), (2, "")]


URLS = [None, "", "no scheme", "http://", "http://Org/x", "https://a.Example.ORG/en/17?x=1#f", "http://example.org", "http://x.com/fr/a?b#c", "http://x.com/de/1", "http://notorg/", "a://b?c/d", "a://b#c://d", "x://h\n/p", "http://com/fr/"]


def test_url_filter(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(50 + k, f"http://s{k}.com/{'fr' if k % 2 else 'de'}/{k}") for k in range(60)]
    more = "verdict depth entropy params ruled _suffix _x _p _bad row _fold label".split()
    table = spark.createDataFrame([(*r, *more) for r in rows], "page_id long, url string, " + ", ".join(f"{c} string" for c in more))
    got = uf.url_filter(table, rounds=3, depth=2)
    assert sorted(got.columns) == sorted(["page_id", "url", "host", "path", "rule", "block_score", *more])
    got = {r["page_id"]: r for r in got.collect()}
    assert len(got) == len(rows) and all(r[c] == c for r in got.values() for c in more if c != "verdict")
    for page_id, url in rows:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(h + p, v) for h, p, v in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        r = got[page_id]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
        assert 0 <= r["block_score"] <= 1


def plain_features(url, host, path):
    url = url or ""
    query = re.search(r"\?([^#]*)", url)
    query, labels = query[1] if query else "", host.split(".")
    digits = lambda x: len(re.findall("[0-9]", x))
    return {
        "url_chars": len(url), "host_chars": len(host), "path_chars": len(path), "query_chars": len(query),
        "depth": len(re.findall("/[^/]", path)), "host_labels": len(labels) if host else 0,
        "digit_ratio": digits(url) / len(url) if url else 0, "host_digit_ratio": digits(host) / len(host) if host else 0,
        "path_digits": digits(path), "hyphens": url.count("-"),
        "entropy": -sum(url.count(c) / len(url) * math.log2(url.count(c) / len(url)) for c in set(url)),
        "params": len([x for x in query.split("&") if x]), "fragment": "#" in url, "secure": url.startswith("https:"),
        "extension": bool(re.search(r"\.[a-z0-9]{1,5}$", path)), "suffix_chars": len(labels[-1]),
        "second_chars": len(labels[-2]) if len(labels) > 1 else 0,
        "suffix_vowel_ratio": len(re.findall("[aeiou]", labels[-1])) / len(labels[-1]) if labels[-1] else 0,
        "first_label_chars": len(labels[0]), "first_step_chars": len(path.split("/")[1]) if path.startswith("/") else 0,
    }


def test_url_features(spark):
    """Every input of the trees against plain Python, on odd and on very long URLs; the rate of a last label leaves out its fold."""
    urls = [*URLS, "https://a-b.c3.example.co.uk/x/y-z/p.html?a=1&&b=2#t?u=3", "http://q.de/" + "ab1/" * 50_000, "http://ü.org/é?ü=é"]
    urls += [f"http://h{k}.{'com' if k % 3 else 'org'}/{'de' if k % 2 else 'fr'}/{k}" for k in range(40)]
    table = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    host, path = uf.parts(F.col("url"))
    name, verdict = uf.ruled(F.col("host"), F.col("path"))
    table = table.withColumns({"host": host, "path": path}).withColumns({"rule": name, "ruled": verdict}).withColumn("fold", uf.fold(F.col("host")))
    counts = uf.label_counts(table.filter("ruled IS NOT NULL"))
    rows = uf.with_inputs(table, counts, 0.25).select("*", uf.vector_to_array("_x").alias("x")).collect()
    labelled = [r for r in rows if r["ruled"]]
    last = lambda r: r["host"].split(".")[-1]
    for r in rows:
        want = plain_features(r["url"], r["host"], r["path"])
        assert list(want) and {n: v for n, v in zip(uf.FEATURES, r["x"])} == pytest.approx({k: float(v) for k, v in want.items()})
        others = [x for x in labelled if last(x) == last(r) and not (r["ruled"] and x["fold"] == r["fold"])]
        bad = sum(x["ruled"] == "block" for x in others)
        assert r["x"][-1] == pytest.approx((bad + 0.25 * 20) / (len(others) + 20))


def test_url_trees_learn_what_features_tell(spark):
    """Where features tell the classes apart, held-out hosts are told right; one URL with a third of the rows trains once."""
    rows = [(k, f"http://h{k % 60}.com/{'de/a/b/c' if k % 2 else 'fr/x'}{k}") for k in range(600)] + [(900 + k, "http://h1.com/de/a/b/c1") for k in range(300)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    assert uf.held_out_accuracy(table, rounds=3, depth=2) > 0.95


def test_url_filter_with_nothing_to_learn(spark):
    one = spark.createDataFrame([(1, "http://x.net/a"), (2, "http://y.com/fr/b")], "page_id long, url string")
    assert {r["verdict"] for r in uf.url_filter(one).collect()} == {"allow"}
    assert uf.url_filter(one.limit(0)).count() == 0
