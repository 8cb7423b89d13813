"""The Merkle manifest and the search for personal data against plain Python."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from math import log2

import pytest
from pyspark.sql import functions as F

from pixelseries.llm import disclosure as dc
from pixelseries.llm import merkle as mk
from pixelseries.llm import queries as q

from ..conftest import SF

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Row by row, with whole trees in memory."""
    leaf = lambda r: digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
        return out

    def path(tree, at):
        for level in tree[:-1]:
            run = at - at % 3
            yield "".join(level[run:at]), "".join(level[at + 1 : run + 3])
            at //= 3

    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted((r for r in rows if r[1] == s), key=order) for s in sources}
    trees = {s: levels([leaf(r) for r in held[s]]) for s in sources}
    upper = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for at, r in enumerate(held[s]):
            steps = [*path(trees[s], at), *path(upper, k)]
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else leaf(r)
            for left, right in steps:
                node = digest(left, node, right)
            root = upper[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, digest(*[x for p in steps for x in p]), node, node == root))
    return sorted(out, key=repr)


def told(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def rows_of(n, sources, gap=1):
    return [(gap * k, sources[k * k % len(sources)], "en", k, f"text {k}\nof {k % 5}") for k in range(n)]


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, height):
    """With blocks of 3, 9 and 729 leaves, so that trees have one layer of blocks to five."""
    rows = rows_of(130, ["a", "b", None, "é", "a "]) + [(1000 + k, f"only {k}", None, None, "x\n") for k in range(11)]
    rows += [(None, "a", "en", 3, "no id\n"), (7, "a", "en", 3, "again\n"), (7, "a", "en", 3, "again\n"), (8, "b", None, None, None), (9, "", "en", 0, "")]
    frame = spark.createDataFrame(rows, DOCS).withColumns({"tree": F.lit(1), "pos": F.lit("x"), "hash": F.lit(None).cast("int"), "_m": F.lit(1)})
    assert told(mk.manifest(frame, height=height)) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 4, 28])
def test_manifest_of_small_tables(spark, n):
    rows = rows_of(n, ["a"])
    assert told(mk.manifest(spark.createDataFrame(rows, DOCS))) == plain_manifest(rows)


def test_manifest_of_a_large_source_and_long_texts(spark):
    rows = rows_of(2000, ["hot"], 3) + [(1, "s", "en", 1, "long\n" * 300_000), (5, "s", "en", 1, "long" * 300_000)]
    assert told(mk.manifest(spark.createDataFrame(rows, DOCS).repartition(5))) == plain_manifest(rows)


def test_versions_copy_ancestors_only(spark):
    rows = rows_of(50, ["a", "b"])
    out = mk.manifest(spark.createDataFrame(rows, DOCS), detail=True)
    for r in out.withColumn("again", mk.folded(F.col("leaf"), F.col("path"))).collect():
        even = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        assert r["again"] == r["root"] and r["verified"] is not even and (r["copied"] is not None) is even
        if even:  # one new node for each level of the path, none of them the old one
            assert len(r["copied"]) == len(r["path"]) // 2 and r["copied"][-1] == r["folded_root"] and r["root"] not in r["copied"]


def test_manifest_query(spark, same):
    from pixelseries.llm import sql

    same(q.op11_merkle_manifest(spark, SF), sql.op11())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub(r"\D", "", m[0], flags=re.A)
            total = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d)))
            fits = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and total % 10 == 0, "phone": 10 <= len(d) <= 15}
            if fits[name]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def plain_found(texts, reach, support, general, removed):
    """The spans of each text: base ones, and terms by the corpus counts, with plain dictionaries."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df_t, df_e, df_et, near = Counter(), Counter(), Counter(), []
    for text in texts:
        spans, low = plain_spans(text), text.translate(lower)
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
        df_t.update({low[a:b] for a, b in words})
        free = [w for w in words if not any(a < w[1] and w[0] < b for a, _, b in spans)]
        at = defaultdict(set)
        for a, kind, b in spans:
            value = text[a:b].lower() if kind == 0 else text[a:b] if kind == 1 else re.sub("[^0-9]", "", text[a:b])
            e = (kind, value)
            at[e, None].add(None)
            for w in [w for w in free if w[0] < a][-reach:] + [w for w in free if w[0] >= b][:reach]:
                at[e, low[w[0] : w[1]]].add(w)
        near.append(at)
        df_e.update(e for e, t in at if t is None)
        df_et.update((e, t) for e, t in at if t is not None)
    out = []
    for text, at in zip(texts, near):
        score, places = defaultdict(float), defaultdict(set)
        for (e, t), where in at.items():
            if t is None or df_et[e, t] < support or df_e[e] == len(texts):
                continue
            d = log2(len(texts) * df_et[e, t] / (df_e[e] * df_t[t])) / log2(len(texts) / df_e[e])
            if d >= general:
                score[t] = max(score[t], d)
                places[t] |= where
        added = {(a, 4 if score[t] >= removed else 5, b) for t in places for a, b in places[t]}
        out.append(sorted([*plain_spans(text), *added]))
    return out


TRICKY = [
    "a@b.c, x.y@z-.w.q@r.s @@ a@b a@.c é@ä.de .@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.255 256.1.1.1 1.2.3 00000000000000000000.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111114111111111111111 4 4 4  4", "+1 (555) 010-9999 +12 +1-2-3-4-5-6-7-8-9 +1 5550100000 +1+15550100000 +1 555 0100 000 ).",
    "@" * 50 + "x@y.z", "", "1" * 5000 + "." + "2" * 5000, "٣٤@x.y ４１１１ +１", "x@y.z@a.b@c.d e_f%g+h-i@j.k.l.m.", "+1.1.1.1 +12.34.56.78 4242424242424242.1.2.3",
]


def test_base_spans_equal_the_patterns():
    for text in TRICKY:
        assert dc.base_spans(text) == plain_spans(text), text
    import random

    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789..@@-- ++()aZé_%") for _ in range(rng.randrange(60)))
        assert dc.base_spans(text) == plain_spans(text), text


def test_long_texts_are_searched_in_linear_time():
    import time

    began = time.time()
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1 " * 150_000, "a.b@c-" * 60_000, "1-" * 200_000):
        dc.base_spans(text)
    assert time.time() - began < 20


def spoken(spark):
    mail, card = "Jo.Doe@example.com", "4111 1111 1111 1111"
    texts = [f"The mayor Ximenes wrote from {mail} on day {k} about work number {k}." for k in range(5)]
    texts += [f"pay the baker with {card} or 4111-1111-1111-1111 at Quux street, thanks {k}" for k in range(3)] + ["the baker paid at noon"] * 3
    texts += [f"the quick dog {k} and work of the day" for k in range(40)] + ["one " + mail, "", "+1 555 010 99999 Zed"] + TRICKY
    return texts


def test_found_equals_plain_counts(spark):
    texts = spoken(spark)
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(-1, None)], "doc_id long, text string")
    for reach, support, general, removed in ((8, 3, 0.9, 0.97), (2, 2, 0.5, 0.8), (8, 1, 0.0, 2.0)):
        want = plain_found([*texts, ""], reach, support, general, removed)
        got = dc.found(frame.repartition(3), reach=reach, support=support, generalise_at=general, remove_at=removed)
        found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got.collect()}
        assert found == {**{k: want[k] for k in range(len(texts))}, -1: []}
    assert any(k >= 4 for spans in plain_found([*texts, ""], 8, 3, 0.9, 0.97) for _, k, _ in spans)


def test_found_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in rows], plain_found([r["text"] for r in rows], 8, 3, 0.9, 0.97)))
    names = ("email", "ip", "card", "phone", "removed", "general")
    for r in q.op12_disclosure(spark, SF).collect():
        text = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        spans = want[r["doc_id"]]
        base = [s for s in spans if s[1] < 4]
        assert r["spans"] == text(spans) and r["base_sha256"] == digest(text(base))
        assert [r[f"n_{k}"] for k in names[:4]] == [sum(s[1] == i for s in base) for i in range(4)]


def test_sanitised_texts(spark):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(spoken(spark))], "doc_id long, text string")
    odd = frame.withColumns({"spans": F.lit(1), "row": F.lit(2), "near": F.lit(3), "_spans": F.lit(4), "k0": F.lit(5)})
    out = {r["doc_id"]: r for r in dc.sanitised(odd).collect()}
    assert "Ximenes" not in out[0]["sanitised"] and "[email]" in out[0]["sanitised"] and "day 0" in out[0]["sanitised"]
    assert "[card]" in out[5]["sanitised"] and "Quux" not in out[5]["sanitised"] and "baker" in out[8]["sanitised"]
    assert out[11]["sanitised"] == frame.filter("doc_id = 11").first()["text"]
    assert set(out[0].asDict()) == {*odd.columns, "sanitised"} and out[0]["_spans"] == 4 and out[0]["k0"] == 5
    assert dc.sanitised(frame.limit(0)).count() == 0
    assert dc.rewritten("Ab 12 cd", [(0, 5, 2), (1, 4, 4), (3, 5, 5), (6, 5, 8)]) == "[name] [number] [term]"
