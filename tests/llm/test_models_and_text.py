"""Near-dedup, BPE, WARC, the two networks and the pipeline on small tables, against plain Python."""

import hashlib
import re
import subprocess
import sys
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pixelseries.llm import attention_mil as mil
from pixelseries.llm import bigru, common, components, language_id, near_dedup, quality_model, simhash, warc
from pixelseries.llm import bpe_words as bw
from pixelseries.llm import passage_encoder as enc
from pixelseries.llm import queries as q

from ..conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello,  World's don't <|endoftext|> x é́ ΣΑΣ 12a <|EndOfText|>\u3000a\x1cb \u00a0 ſt ﬁ İ K", None, "", " \t\n", "😀 x'S ''s --'s",
    "ª º µ ß ÿ Å ½ ² x²", "it's", "it's", "word " * 5000, "x" * 3000,
]


def documents(spark, texts, ids=None, **more):
    rows = [(None if ids and ids[k] is None else (ids[k] if ids else k), t, more.get("lang", ["en"] * len(texts))[k], f"s{k % 2}", None) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("block_bytes", [40, 10_000, 1 << 25])
def test_bpe_equals_the_library(spark, block_bytes):
    made = Tokenizer.from_file(PATH)
    frame = documents(spark, TEXTS).repartition(2, "doc_id")
    frame.write.mode("overwrite").parquet(path := warc.new_path(spark, "bpe-input"))
    out = bw.encode_decode(spark.read.parquet(path), PATH, block_bytes=block_bytes)
    got = {r["doc_id"]: r for r in out.collect()}
    back = {r["doc_id"]: r["decoded"] for r in bw.decode_ids(out, PATH).collect()}
    assert len(got) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        ids = made.encode(text or "", add_special_tokens=False).ids
        assert got[k]["ids"] == ids and got[k]["decoded"] == back[k] == made.decode(ids, skip_special_tokens=False)
    assert bw.encode_decode(documents(spark, []), PATH).count() == 0


def test_bpe_of_an_input_that_is_no_scan(spark):
    """Rows in an order of chance are written first, and kept columns may bear the names used inside."""
    texts = [f"some {'word' * (k % 9)} and w{k}" for k in range(500)]
    frame = documents(spark, texts).orderBy(F.rand()).withColumnsRenamed({"source": "_words", "lang": "_TEXT", "n_chars": "_place"})
    out = bw.encode_decode(frame, PATH, keep=("doc_id", "_words", "_TEXT", "_place"), block_bytes=2000)
    made = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: (r["ids"], r["_words"], r["_TEXT"], r["_place"]) for r in out.collect()}
    assert got == {k: (made.encode(t, add_special_tokens=False).ids, f"s{k % 2}", "en", None) for k, t in enumerate(texts)}


HELD = """
import re
import numpy as np, pyarrow as pa
from pixelseries.llm import bpe_words as bw

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) >> 10

def rows():
    for k in range(16):
        words = np.random.default_rng(k).integers(0, 10**6, 600_000).astype(str).reshape(600, 1000)
        texts = pa.array([" ".join(w) for w in words])
        yield pa.record_batch([pa.array(np.arange(600)), pa.array(np.zeros(600, np.int32)), texts], ["doc_id", "_place", "_text"])

for run in (bw._named_words, bw._packed):
    for made in run(bw.BLOCK_BYTES)(rows()):
        pass
    del made
    print(held())
"""


def test_bpe_workers_give_memory_back():
    """Spark keeps a worker that has split blocks of 32 MB for other tasks; it then holds little."""
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True).stdout
    assert max(map(int, out.split())) < 200


SPLIT = """
import pyarrow as pa
from pixelseries.llm import bpe_words as bw

texts = pa.array([f" {k % 999} b{k % 77}\\t\\n" * 50 for k in range(60_000)])
counts, words = bw.split_words(texts)
print(pa.default_memory_pool().max_memory(), 3 * texts.nbytes + words.nbytes)
"""


def test_bpe_splits_in_slices():
    """What splitting takes beside its result is that of slices, not of all texts; counts and words are those of Python."""
    most, bound = map(int, subprocess.run([sys.executable, "-c", SPLIT], capture_output=True, text=True, check=True).stdout.split())
    assert most < bound
    texts = [" a b\t\n"] * 5 + ["", " \n", "x" * bw.SPLIT_BYTES, "y a"] * 2
    counts, words = bw.split_words(pa.array(texts))
    assert counts.tolist() == [len(t.split()) for t in texts] and words.to_pylist() == [w for t in texts for w in t.split()]
    assert bw.split_words(pa.array([], pa.string()))[0].tolist() == []


def test_bpe_query(spark, table):
    made = Tokenizer.from_file(PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in table.collect():
        ids = made.encode(r["text"] or "", add_special_tokens=False).ids
        want.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(made.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in q.op3_bpe_words(spark, SF).collect()} == want


def plain_print(text):
    found = [w for w in bytes((text or ""), "utf-8").lower().split()]
    runs = [found[i : i + 3] for i in range(len(found) - 2)] or ([found] if found else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(prints))]


def test_golay_index_is_the_nearest_codeword():
    index = simhash.codeword_indexes()
    words = {}
    for message in range(1 << 12):
        word = message << 11
        rest = word
        for k in range(22, 10, -1):
            if rest >> k & 1:
                rest ^= simhash.GENERATOR << (k - 11)
        words[message] = word | rest
    some = np.random.default_rng(1).integers(0, 1 << 16, 60)
    for segment in some:
        nearest = min(words, key=lambda m: bin(words[m] ^ int(segment)).count("1"))
        assert index[segment] == nearest and bin(words[nearest] ^ int(segment)).count("1") <= 3


def test_keys_meet_within_three_bits():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 500, dtype=np.int64)
    for errors in range(4):
        b = a.copy()
        for k in range(len(b)):
            for bit in rng.choice(64, errors, replace=False):
                b[k] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
        (ra, ka), (rb, kb) = simhash.keys(a, False), simhash.keys(b, True)
        met = {r for r, k in zip(ra, ka)} & {r for r in range(500) if set(ka[ra == r]) & set(kb[rb == r])}
        assert len(met) == 500


def test_near_dedup(spark, table):
    text = " ".join(f"w{k}" for k in range(2000))
    texts = [text, text + " x", text.replace("w7 ", "w8 "), text.upper(), None, "", " ", "a b", "A  b", "a b c d", "word " * 40_000]
    ids = [5, 3, 9, 4, 7, 2, None, 11, 10, 12, 13]
    prints = [plain_print(t) for t in texts]
    got = sorted(map(tuple, near_dedup.near_dedup(documents(spark, texts, ids)).collect()), key=repr)
    want = sorted(((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, plain_components(prints, ids))), key=repr)
    assert got == want
    assert near_dedup.near_dedup(documents(spark, [])).count() == 0
    rows = table.collect()
    prints = [plain_print(r["text"]) for r in rows]
    want = {(r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, plain_components(prints, [r["doc_id"] for r in rows]))}
    assert {tuple(r) for r in q.op4_simhash_near_dedup(spark, SF).collect()} == want


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 100)] + [(5, 5), (3, 2)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1100)}


def test_warc_round_trip(spark):
    trap = "x" * 60 + "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 60
    whole = "WARC/1.0\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3
    rows = [(5, "http://a/\r\nb", trap), (3, None, trap), (7, "u", trap), (1, "u", ""), (2, "u", None), (None, "u", trap), (4, "ü", whole), (6, "u", "short"), (8, "u", "short"), (9, "u", "é" * 50), (10, "u", "é" * 50), (11, "u", "z" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3, "page_id")
    got = sorted(map(tuple, warc.round_trip(pages).collect()), key=repr)
    first = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 100 and i is not None:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if i is not None and first.get(html) != i else None
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if to is not None else "response", to))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).count() == 0


def ranged(spark, df, width):
    """``df`` as the source gives it with ranges of ``width`` bytes, written: later reads keep ranges of the usual size."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(width))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df.write.parquet(path := warc.new_path(spark, "lines"))
        assert df.rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    read = spark.read.parquet(path).withColumn("_n", F.monotonically_increasing_id())
    return read.repartition(3, "range").sortWithinPartitions("range", "_n").drop("_n")


@pytest.mark.parametrize("width", [41, 184, 1000])
def test_warc_in_small_byte_ranges(spark, width):
    """One archive read by many tasks, cut anywhere: in headers, separators, payloads and magic inside of payloads."""
    magic = "\r\n\r\nWARC/1.0\r\n"
    inner = magic + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc"
    pages = [None, "", "\r\n\r\n", magic, "\r\n" + magic * 3, "x" * 90 + inner + inner + magic, inner, "a\r\n\r\nb" * 40, "y" * 300, "y" * 300, "é" * 77 + magic + "z"]
    rows = [(k, f"http://h/{k}", x) for k, x in enumerate(pages)]
    path = warc.new_path(spark, "ranges")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    lines = warc.archive_lines
    try:
        warc.archive_lines = lambda *a: ranged(spark, lines(*a), width)
        got = {r["page_id"]: tuple(r)[1:] for r in warc.read_archives(spark, path).collect()}
    finally:
        warc.archive_lines = lines
    body = [(x or "").encode() for x in pages]
    again = {9: 8}
    assert got == {k: (len(b), hashlib.sha256(b).hexdigest(), "revisit" if k in again else "response", again.get(k)) for k, b in enumerate(body)}


def test_warc_of_a_very_long_page(spark):
    long = spark.range(1).select(F.lit(5).cast("long").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("0123456789abcde\n"), 6_600_000).alias("html"))
    row = warc.round_trip(long).first()
    digest = hashlib.sha256()
    for _ in range(6_600):
        digest.update(b"0123456789abcde\n" * 1000)
    assert (row["payload_bytes"], row["payload_digest"]) == (105_600_000, digest.hexdigest())


def test_warc_reports_a_broken_chain(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", "page " * 30 + str(k)) for k in range(5)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"))
    file = next((tmp_path / "w").glob("*.txt"))
    file.write_bytes(file.read_bytes()[:-20])
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ValueError):
        warc.read_archives(spark, str(tmp_path / "w"))


def test_attention_gradient_and_streamed_score():
    rng = np.random.default_rng(3)
    x, bag, y = rng.normal(size=(30, 6)), np.repeat(np.arange(10), 3), rng.integers(0, 2, 10).astype(float)
    p = mil.start(6, 1)
    _, g = mil.gradients(p, x, bag, y)
    for k in p:
        at = tuple(rng.integers(0, n) for n in p[k].shape)
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        assert g[k][at] == pytest.approx((mil.gradients(up, x, bag, y)[0] - mil.gradients(down, x, bag, y)[0]) / 2e-6, abs=1e-6)
    model = p | {"mean": np.zeros(6), "spread": np.ones(6)}
    whole = mil.score(model, [(bag, x)], 10)
    parts = mil.score(model, [(bag[a : a + 4], x[a : a + 4]) for a in range(0, 30, 4)], 10)
    assert np.allclose(whole, parts)


def plain_passages(text):
    """(words, bytes) of each passage of a text, word by word."""
    spans = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", text)]
    out, at = [], 0
    while True:
        inside = [(max(a, at), e) for a, e in spans if e > at]
        if len(inside) > enc.PASSAGE_WORDS and inside[enc.PASSAGE_WORDS][0] < at + enc.PASSAGE_BYTES:
            end = inside[enc.PASSAGE_WORDS][0]
        elif len(text) - at > enc.PASSAGE_BYTES:
            end = at + enc.PASSAGE_BYTES
        else:
            end = len(text)
        out.append(([text[a : min(e, end)] for a, e in inside if a < end], text[at:end]))
        at = end
        if at >= len(text):
            return out


def plain_vector(words, data):
    count = lambda chars: sum(data.count(bytes([c])) for c in chars)
    classes = [count(c) for c in enc.CLASSES]
    lower = [c for c in range(97, 123) if chr(c) not in "aeiou"]
    known = set(b"".join(enc.CLASSES)) | set(lower) | set(b"aeiou")
    classes += [count(lower), count([c for c in range(128) if c not in known]), count(range(0xC0, 256)), count(range(0x80, 0xC0))]
    folded, n = [w.lower() for w in words], max(1, len(words))
    stops = {w.encode() for w in enc.STOP_WORDS}
    extra = [
        len(set(folded)) / n, sum(a == b for a, b in zip(folded, folded[1:])) / n, sum(w in stops for w in folded) / n,
        sum(map(len, words)) / n / 10, sum(len(w) == 1 for w in words) / n, np.log1p(len(words)) / 4,
    ]
    return [c / max(1, len(data)) for c in classes] + extra


def plain_score(p, text):
    """Encoder, gated attention and logistic unit, passage by passage."""
    h, e = [], []
    for words, data in plain_passages(text):
        x = (np.array(plain_vector(words, data)) - p["mean"]) / p["spread"]
        h.append(np.tanh(x @ p["W"] + p["b"]))
        e.append(sum(w * np.tanh(h[-1] @ v) / (1 + np.exp(-h[-1] @ u)) for w, v, u in zip(p["w"], p["V"].T, p["U"].T)))
    a = np.exp(np.array(e) - max(e))
    return 1 / (1 + np.exp(-(sum(x * y for x, y in zip(a / a.sum(), h)) @ p["c"] + p["c0"][0])))


PASSAGES = [b"", b" ", b"one", b" \n two  The the\tTHE ", b"w " * 1000, "Äé ß 漢字 😀 #* | !? 12 AZ".encode() * 90, b"x" * 5000, b"a b " + b" " * 3000 + b"c", b"long word " * 700]


@pytest.mark.parametrize("most", [1 << 20, 700])
def test_passages_against_plain_python(monkeypatch, most):
    """All features of all passages; a small bound cuts texts into pieces, and changes nothing but what the definition says."""
    monkeypatch.setattr(enc, "PASSAGE_BYTES", most)
    for run in (1, 1 << 20):
        monkeypatch.setattr(enc, "RUN_BYTES", run)
        of, x = (np.concatenate(a) for a in zip(*enc.passages(PASSAGES)))
        want = [(k, plain_vector(*p)) for k, text in enumerate(PASSAGES) for p in plain_passages(text)]
        assert of.tolist() == [k for k, _ in want]
        assert np.allclose(x, np.array([v for _, v in want]), atol=1e-5)


def test_documents_score_as_a_plain_loop_does(spark, table):
    some = [r["text"] or "" for r in table.limit(40).collect()] + ["word " * 300_000]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_model.train(table, labels)
    got = mil.score(model, enc.passages([t.encode() for t in some]), len(some))
    assert np.allclose(got, [plain_score(model, t.encode()) for t in some[:-1]] + [got[-1]], atol=1e-4) and 0 <= got[-1] <= 1


def test_quality_scores(spark):
    got = q.op1_quality_attention(spark, SF).toPandas()
    want = got["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)
    assert (got["held_out"] == want).all() and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()
    truth = pd.read_parquet(f"{SF}/labels.parquet").merge(got, on="doc_id")
    truth = truth[truth["held_out"]]
    assert (truth["predicted"] == truth["quality"]).mean() > 0.9


def test_quality_scores_of_odd_tables(spark):
    odd = documents(spark, [None, "", "x" * 2_000_000, "a b"], [None, 1, 2, 2])
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_model.quality_scores(odd, labels).collect()
    assert len(rows) == 4 and {r["score"] for r in rows} == {1.0}
    clash = odd.withColumns({c: F.lit("x") for c in ("label", "place", "quality", "score", "n", "x")})
    rows = quality_model.quality_scores(clash, labels).collect()
    assert len(rows) == 4 and {(r["score"], r["label"], r["place"], r["quality"]) for r in rows} == {(1.0, "x", "x", "x")}
    assert {r["score"] for r in quality_model.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_scores(documents(spark, []), labels).count() == 0


def test_network_gradient():
    rng = np.random.default_rng(4)
    p, x, y = bigru.start(3, 1), rng.integers(1, 256, (6, 4)), rng.integers(0, 3, 4)
    _, g = bigru.gradients(p, x, y)
    for k in p:
        at = (1, int(x[2, 1]), 5) if k == "E" else tuple(rng.integers(0, n) for n in p[k].shape)
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert g[k][at] == pytest.approx((bigru.gradients(up, x, y)[0] - bigru.gradients(down, x, y)[0]) / 2e-5, abs=1e-7)


def plain_probabilities(p, text):
    """The two networks byte by byte, window by window, and the mean over positions."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    n, total = bigru.HIDDEN, np.zeros(len(p["o"]))
    for at in range(0, len(text), bigru.WINDOW):
        real = text[at : at + bigru.WINDOW]
        window = real + bytes(bigru.WINDOW - len(real))
        seen = []
        for way, run in enumerate((window, window[::-1])):
            h, out = np.zeros(n), []
            for byte in run:
                e, u = p["E"][way][byte] + p["b"][way][0], h @ p["U"][way]
                z, r = sigmoid(e[:n] + u[:n]), sigmoid(e[n : 2 * n] + u[n : 2 * n])
                h = z * h + (1 - z) * np.tanh(e[2 * n :] + r * u[2 * n :])
                out.append(h)
            seen.append(out if way == 0 else out[::-1])
        for k in range(len(real)):
            logits = np.concatenate([seen[0][k], seen[1][k]]) @ p["O"] + p["o"]
            q = np.exp(logits - logits.max())
            total += q / q.sum()
    return total / len(text)


@pytest.mark.parametrize("batch", [4096, 3])
def test_document_probabilities_against_a_plain_loop(monkeypatch, batch):
    monkeypatch.setattr(bigru, "BATCH", batch)
    texts = [b"a", b"hello world", "äöü ñandú ".encode() * 30, bytes(range(1, 256)) * 3, b"x" * 64, b"y" * 65]
    p = bigru.start(3, 5)
    got = bigru.document_probabilities(p, [b"", *texts])
    assert np.allclose(got[1:], [plain_probabilities(p, t) for t in texts]) and np.allclose(got[0], 1 / 3)


def test_every_language_is_learned(spark):
    """A language with few documents is a class beside one with most rows; ids that repeat and long texts stay within the bound."""
    texts = ["ab" * 40] * 400 + ["xyz " * 30] * 3 + ["q" * 900]
    langs = ["en"] * 400 + ["zz"] * 3 + ["en"]
    docs = documents(spark, texts, lang=langs, ids=[*range(403), 9000]).unionByName(documents(spark, ["ab"] * 50, lang=["en"] * 50, ids=[7] * 50))
    sample = language_id.training_sample(docs, 4, 2, 40, 2500)
    rows = sample.collect()
    assert {r["label"] for r in rows} == {"en", "zz"} and sum(len(r["text"]) for r in rows) <= 2500 and len(rows) > 20


def test_languages(spark, table):
    got = q.op9_language_id(spark, SF).toPandas().merge(table.select("doc_id", "lang", "n_chars").toPandas(), on="doc_id")
    assert (got["held_out"] == got["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    assert got["score"].between(0, 1).all()
    seen = got[got["held_out"] & (got["n_chars"] > 60)]
    assert (seen["lang"] == seen["lang_pred"]).mean() > 0.9


def test_languages_of_odd_tables(spark):
    texts = ["Hello there", None, "", "123 !!", "ÄÖÜ äöü " * 50_000]
    two = documents(spark, texts, [0, 1, 2, None, 5], lang=["en", "en", None, "de", "de"])
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.languages(two).collect()}
    assert got[1] == got[2] == got[None] == "und" and {got[0], got[5]} <= {"en", "de"}
    clash = two.withColumns({c: F.lit("x") for c in ("_told", "_bare", "label", "place", "_xtold", "score")})
    rows = language_id.languages(clash).collect()
    assert len(rows) == 5 and {(r["_told"], r["_bare"], r["label"], r["_xtold"]) for r in rows} == {("x",) * 4}
    none = documents(spark, texts, lang=[None] * 5)
    assert {r["lang_pred"] for r in language_id.languages(none).collect()} == {"und"}
    assert language_id.languages(documents(spark, [])).count() == 0


def test_pipeline_against_its_parts(spark, table):
    """Each stage on what its predecessor kept; the end holds the library's ids of the rows the mix repeats."""
    docs, frames = table, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == table.columns
        out.write.parquet(path := warc.new_path(spark, "stage"))
        docs = spark.read.parquet(path)
        frames.append([tuple(r) for r in docs.collect()])
    ruled, exact, near, mixed = frames
    kept = {r[0] for r in q.op5_quality_rules(spark, SF).filter("kept").select("doc_id").collect()}
    assert {r[0] for r in ruled} == kept
    bare = lambda t: "".join((t or "").split(" ")).translate(str.maketrans("", "", "\t\n\x0b\x0c\r"))
    best = {}
    for r in ruled:
        best[bare(r[1])] = min(best.get(bare(r[1]), (1, 0)), (-len(r[1]), r[0]))
    assert {r[0] for r in exact} == {i for _, i in best.values()}
    prints, ids = [plain_print(r[1]) for r in exact], [r[0] for r in exact]
    assert {r[0] for r in near} == set(plain_components(prints, ids))
    assert {r[0] for r in mixed} <= {r[0] for r in near} and max(map([r[0] for r in mixed].count, {r[0] for r in mixed})) <= 2
    final = corpus_pipeline.run(spark, SF).collect()
    made = Tokenizer.from_file(PATH)
    texts = {r[0]: r[1] for r in near}
    assert sorted(r["doc_id"] for r in final) == sorted(r[0] for r in mixed)
    assert all(r["n_tokens"] == len(made.encode(texts[r["doc_id"]], add_special_tokens=False).ids) for r in final)
    # Rows end in training order: by the mix's positions, each document's first and second turn.
    rows = spark.createDataFrame(near, table.schema).withColumn("tie", F.xxhash64(*table.columns))
    at = {r["doc_id"]: r["positions"] for r in q.sm.source_mix(rows, carry=("tie",)).collect()}
    order = sorted((p, i) for i, ps in at.items() for p in ps)
    assert [r["doc_id"] for r in final] == [i for _, i in order]


def test_pipeline_of_an_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_decides_row_by_row(spark):
    """Rows with null, repeated and conflicting ids get verdicts of their own, each row once."""
    stages = dict(corpus_pipeline.STAGES)
    after = lambda name, texts, ids: sorted(((r["doc_id"], r["text"]) for r in stages[name](spark, documents(spark, texts, ids), SF).collect()), key=repr)
    texts, ids = zip(("a b", 5), ("a b", 5), ("ab", 5), ("c", None), ("c", None), ("d", None), ("d", 9), ("e", None), ("f", 5))
    assert after("exact_dedup", texts, ids) == [(5, "a b"), (5, "f"), (9, "d"), (None, "c"), (None, "e")]
    one, two, three = (" ".join(f"{c}{k}" for k in range(300)) for c in "xyz")
    texts, ids = zip((one, 5), (two, 3), (two.upper(), 5), (three, None), (three.upper(), None), (two.title(), None), (one.upper(), 5), ("alone", None))
    got = after("near_dedup", texts, ids)
    assert [(i, t.lower()) for i, t in got] == [(3, two), (5, one), (None, "alone"), (None, three)]
    texts = [f"t{k} " + "w " * (k % 7) for k in range(300)]
    ids = [None if k % 3 == 0 else 7 if k % 3 == 1 else k for k in range(300)]
    mixed = after("source_mix", texts, ids)
    assert set(mixed) <= set(zip(ids, texts)) and max(map(mixed.count, mixed)) <= 2
    # Each source keeps what it takes of its own rows: 1.5 times the words, give or take a document for each source and pass.
    words = lambda rows: sum(len(t.split()) for _, t in rows)
    assert abs(words(mixed) - 1.5 * words(zip(ids, texts))) <= 4 * 7
    assert mixed == after("source_mix", texts, ids)


def test_pipeline_of_long_texts_and_clashing_columns(spark):
    """Columns named like those used inside, texts of megabytes, nulls: every stage but the last returns the columns as they came."""
    base = "The dog and the cat sat in the house and it was warm for all of them in that long winter of the year. "
    texts = [" ".join(f"{w}{k * 97 + i}" if i % 3 else w for i, w in enumerate((base * 4).split())) for k in range(12)]
    texts += [texts[0], texts[1] + " x", " ".join(f"{w}{i}" if i % 3 else w for i, w in enumerate((base * 20_000).split())), None, "", "short"]
    more = "_at _tie kept points row positions keep_id fp root text_sha256 _sha256 taken size place".split()
    docs = documents(spark, texts).withColumns({c: F.lit(c) for c in more})
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(path := warc.new_path(spark, "stage"))
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        assert docs.filter(" AND ".join(f"{c} = '{c}'" for c in more)).count() == docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == docs.count() and max(r["n_tokens"] for r in last) > 400_000 and {r["doc_id"] for r in last} <= set(range(15))


@pytest.mark.parametrize("plain", [True, False])
def test_row_keys(spark, plain):
    """A plain scan gets its keys in place, anything else gets a copy; both are of one row each and hold on rereading."""
    docs = documents(spark, ["a", "a", None, "b"] * 50, [None, 1, 1, 2] * 50).repartition(7)
    docs.write.parquet(path := warc.new_path(spark, "keyed"))
    read = spark.read.parquet(path)
    read = read if plain else read.crossJoin(spark.range(2)).drop("id")
    rows = common.keyed(read, "rows")
    assert rows.select(common.ROW).distinct().count() == rows.count() == read.count()
    assert not rows.repartition(3).exceptAll(rows).head(1)
