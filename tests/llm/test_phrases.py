"""Phrase mining and its counting quotient filters against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pixelseries.llm import phrase_mining as pm
from pixelseries.llm import quotient_filter as qf

from ..conftest import SF

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, top, longest=5, absorb=100):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        known = {g: a for g, a in f[lang].items() if a >= least and len(g) > 1}
        drop = set()
        for g, a in known.items():
            inner = {g[i : i + k] for k in range(2, len(g)) for i in range(len(g) - k + 1)}
            drop |= {x for x in inner if 100 * a >= absorb * f[lang][x]}
        scored = []
        for g, a in known.items():
            if g not in drop:
                cuts = [(1000 * a * n[lang] // (f[lang][g[:k]] * f[lang][g[k:]]), k) for k in range(1, len(g))]
                s, k = min(cuts)
                scored.append((-s, -a, " ".join(g).encode(), f[lang][g[:k]], f[lang][g[k:]]))
        for rank, (s, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("k, bits", [(2, 1), (2, 15), (3, 20), (5, 15), (4, 31), (5, 31)])
def test_filters_lose_nothing(k, bits):
    rng = np.random.default_rng(k * bits)
    ids = rng.integers(0, 1 << min(bits, 3), 4000) + rng.integers(0, 2, 4000) * ((1 << bits) - (1 << min(bits, 3)))
    layout = qf.Layout(k, bits, 6)
    lanes = layout.pack(ids)
    mixed = layout.permute(lanes)
    assert all((x == y).all() for x, y in zip(lanes, layout.restore(mixed)))
    once, often = qf.summed(mixed), qf.summed(mixed, rng.integers(1, 10**12, len(mixed[0])))
    want = Counter(zip(*[x.tolist() for x in mixed]))
    assert dict(zip(zip(*[x.tolist() for x in once[0]]), once[1].tolist())) == want
    # Two shards of different content, range by range.
    shards = [dict(qf.filters(layout, x)) for x in (once, often)]
    total = Counter(want)
    total.update(dict(zip(zip(*[x.tolist() for x in often[0]]), often[1].tolist())))
    found = {}
    for at in set(shards[0]) | set(shards[1]):
        keys, counts = qf.merged(layout, at, [s[at] for s in shards if at in s])
        found |= dict(zip(zip(*[x.tolist() for x in keys]), counts.tolist()))
        grams = layout.unpack(layout.restore(keys))
        assert grams.shape == (len(counts), k) and (grams < 1 << bits).all()
    assert found == total
    assert qf.filters(layout, ([x[:0] for x in mixed], np.empty(0, np.int64))) == []


@pytest.mark.parametrize("block_bytes", [200, 12 << 20])
def test_phrases_equal_plain_python(spark, block_bytes):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    if block_bytes == 200:
        rows = rows[:60]
        docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(pm.phrases(docs, min_count=6, top=300, block_bytes=block_bytes)) == plain(rows, 6, 300)


def test_phrases_of_odd_rows(spark):
    """Nulls, empty, long and repeated texts, no language, ties, clashing columns, a language of one word."""
    rows = [(None, "New York, new york; NEW YORK\tcity"), ("und", "new york"), ("en", None), ("en", ""), (None, ".,;"), ("de", "ja"), ("fr", "a a a a É É é é")]
    rows += [("en", "x y z w v u " * 4000)] + [("es", "uno dos tres. cuatro cinco")] * 5 + [("en", " \t\n\x0b the end\x1cof it  the end\x1cof it")]
    frame = spark.createDataFrame([(*r, 1, "k", None) for r in rows], "lang string, text string, _m int, id string, f string")
    for least, top in ((1, 1000), (2, 3)):
        assert got(pm.phrases(frame, min_count=least, top=top)) == plain(rows, least, top)
    assert got(pm.phrases(frame.limit(0))) == [] and got(pm.phrases(frame.filter("text is null"))) == []
    # A looser bound absorbs phrases that stand mostly, not always, within a longer one.
    assert got(pm.phrases(frame, min_count=2, absorb=60)) == plain(rows, 2, 2000, absorb=60)


def test_crowded_bitmaps_cost_candidates_only(spark, monkeypatch):
    """With a bitmap far too small nearly every bit is set, and results stay the same."""
    monkeypatch.setattr(pm, "MAX_MARK_BITS", 4)
    rows = [("en", f"a{k % 7} b{k % 5} c{k % 3} d e f. g{k % 11} h") for k in range(300)]
    assert got(pm.phrases(spark.createDataFrame(rows, "lang string, text string"), min_count=9)) == plain(rows, 9, 2000)


def test_scores_are_exact_beyond_64_bits(spark):
    grams = spark.createDataFrame([([1], 7 * 10**11 + 1), ([2], 9 * 10**11 + 7), ([1, 2], 6 * 10**11 + 3)], "ids array<int>, f long")
    firsts = spark.createDataFrame([(1, "en", 10**15 + 3)], "first int, lang string, n long")
    row = pm.scored(grams, firsts).first()
    assert row["score"] == 1000 * (6 * 10**11 + 3) * (10**15 + 3) // ((7 * 10**11 + 1) * (9 * 10**11 + 7))
