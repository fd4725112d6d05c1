"""Each operator against a brute-force version on a small table, and on awkward
rows: nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns whose names the operators use themselves."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tablepipe.llm import html, imatch, kmtree, licenses, minhash, mixing, packing, quality, suffixes, warc
from tablepipe.llm.common import table
from tablepipe.session import checkpoint_root

SF = "/root/testdata/sf0.001"
VOCAB = "/opt/tokenizers/word_bpe_49k.json"
LONG = " ".join(f"word{k % 997} é{k}" for k in range(30_000))
PASSAGE = " ".join(f"passage{k}" for k in range(60))
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, target string, key string, ids string, label string, digest string, spans string, keep string, hash string, score string, kept string, id string, doc string, g string"


@pytest.fixture(scope="module")
def awkward(spark):
    texts = [None, "", "   \n", "one", LONG, PASSAGE + " tail a", "head b " + PASSAGE, "same text of six words here", "same text of six words here", "MIT  License, MIT license", "\U0001f600 ünï <|endoftext|> a\x1cb"]
    rows = [(k, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", 1, *["x" if c else 5 for c in range(14)]) for k, t in enumerate(texts)]
    rows += [rows[7], rows[0], (None, "null id", "en", "s1", 1, *["x" if c else 5 for c in range(14)])]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2) for k in range(11)] + [(None, 1), (3, None)], "doc_id long, quality int")


def test_packing(spark, awkward, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCAB)
    docs = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    pieces = packing.digest(packing.pack(docs, VOCAB, sequence=64)).collect()
    want = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    got = collections.defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
        ids = want[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes()) and p.doc_tokens == len(want[p.doc_id])
    for k, ids in want.items():
        ps = sorted(got[k], key=lambda p: p.start)
        assert [p.start for p in ps] == list(np.cumsum([0, *[p.length for p in ps]])[:-1]) and sum(p.length for p in ps) == len(ids)
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    fill = []
    for s in sorted(sequences):
        at = 0
        for offset, length in sorted(sequences[s]):
            assert offset == at
            at += length
        fill.append(at)
    assert all(f == 64 for f in fill[:-1]) and sorted(sequences) == list(range(len(fill)))
    assert packing.pack(awkward, VOCAB).count() >= awkward.count()
    assert packing.pack(empty, VOCAB).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_a_whole_table_are_the_tokenizers(spark, name):
    """Every document of sf0.01, by a vocabulary that splits at white space and by one that does not."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    odd = ["a<|endoftext|>b <|endoftext|> c", "e\u0301 \u0301x", "\u03a3\u03a3 \u03a3", "can't we'LL 12 3.5", "a\u00a0b\u2003c\u200bd\x1ce\x85f", "\U0001f600\u200d", "\x00 \ufeff", "<|ENDOFTEXT|> x<|end|>y 'S 'Tis a.'s 5's '5 1\u20e3 =\u0338 a=\u0338b I\u0307 A\u0301b don't.stop/12.5-3", "|<a|b>|"]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.tokenized(docs, "doc_id", "text", path).collect()}
    rows = docs.collect()
    want = Tokenizer.from_file(path).encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    assert len(got) == len(rows)
    for r, e in zip(rows, want):
        assert got[r.doc_id] == [*e.ids, 1], r.doc_id


def test_which_vocabularies_go_word_by_word():
    import json

    import public_tokenizers

    files = {n: json.load(open(public_tokenizers.path(n), encoding="utf-8")) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
    assert packing.word_by_word(files["word_bpe_49k.json"]) and not packing.word_by_word(files["byte_bpe_50k.json"])
    config = dict(files["word_bpe_49k.json"])
    assert not packing.word_by_word(config | {"normalizer": {"type": "Replace", "pattern": {"String": "b a"}, "content": "c"}})
    assert not packing.word_by_word(config | {"pre_tokenizer": {"type": "Split", "pattern": {"Regex": "[a-z ]+"}, "behavior": "Removed", "invert": True}})
    assert not packing.word_by_word(config | {"pre_tokenizer": None})


def test_licenses(spark, awkward, empty):
    import re

    found = {(r.doc_id, r.text): g for r, g in zip(awkward.collect(), [None] * 99)}
    assert found
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(awkward.where("doc_id is not null").dropDuplicates(["doc_id"]).select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    for r in docs.collect():
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        places, base = [], set()
        for phrase, label in licenses.BASE:
            parts = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
            places += at
            base |= {label} if at else set()
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.base_labels) == (len(words), len(places), ",".join(sorted(base)))
        assert (g.first_word, g.last_word) == ((min(places), max(places)) if places else (None, None))
        assert base <= set(g.labels.split(",")) if base else True
        assert 0 <= g.score <= 1
    assert licenses.scan_licenses(empty).count() == 0


def test_license_rules():
    rules = licenses.rules()
    assert len(rules) > 200
    scan = licenses.Scanner().scan
    assert scan("SPDX-License-Identifier: BSD-3-Clause")["labels"] == "bsd-3-clause"
    # The name lies inside the longer detection of higher priority and is suppressed.
    found = scan("Licensed under the Apache License, Version 2.0 (the License); see http://www.apache.org/licenses/LICENSE-2.0")
    assert {s["kind"] for s in found["spans"]} == {"under", "url"} and found["labels"] == "apache"
    assert scan("no law here, permitted use")["labels"] == ""


def test_mixing(spark, awkward, empty):
    taken, schedule = mixing.mix(awkward, block=16)
    rows = taken.collect()
    assert len(rows) == awkward.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = collections.defaultdict(lambda: [0, 0, 0])
    for r in rows:
        by[r.source][0] += r.size
        by[r.source][1] += r.taken
        by[r.source][2] = r.target
        assert r.source_size == sum(x.size for x in rows if x.source == r.source)
    for size, got, target in by.values():
        assert abs(got - round(target)) <= 1 and target <= 3 * size + 1e-9
    # Slots of a source are spread: any prefix holds its share but for a few.
    slots = [r.source for r in schedule.orderBy("slot").collect()]
    share = collections.Counter(slots)
    for cut in (len(slots) // 4, len(slots) // 2):
        seen = collections.Counter(slots[:cut])
        assert all(abs(seen[s] - cut * n / len(slots)) <= 4 for s, n in share.items())
    again, _ = mixing.mix(awkward.repartition(5), block=16)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert mixing.mix(empty)[0].count() == 0
    docs = mixing.mixed_documents(awkward, taken)
    words = lambda t: len((t or "").encode().split())
    assert docs.columns == awkward.columns
    assert sum(words(r.text) for r in docs.select("text").collect()) == sum(r.taken for r in rows if r.doc_id is not None) + sum(r.taken for r in rows if r.doc_id is None)


def test_html(spark):
    body = "<html><head><title>t</title></head><body><nav><a href=x>Menu</a></nav><div class='ad'>Buy</div><article><h1>Head &amp; line</h1><p>First  text<br>with <b>bold</b> &eacute;.<p>Second one, <a href=y>linked</a> a little, and rather long to read.<div class=comments><p>Nice</div></article><aside>x</aside><footer>f</footer><script>var a='</p>'</script></body>"
    assert html.main_text(body) == "Head & line\n\nFirst text with bold é.\n\nSecond one, linked a little, and rather long to read."
    loose = "<body><div id=top><a href=1>Home</a> <a href=2>News</a></div><div id=content><h2>Title here</h2><p>" + "Long sentence of the story. " * 20 + "</p><p>" + "More of it follows here. " * 20 + "</p></div><div id=more><ul><li><a href=3>Other</a></ul></div>"
    got = html.main_text(loose)
    assert got.startswith("Title here\n\nLong sentence") and "Other" not in got and "Home" not in got
    for page in (None, "", "<p", "<", "<!-- open", "<script>x", "plain text", "a < b & c", "<table><tr><td>1<td>2", "</div></p>", "<b>" * 3000 + "x"):
        assert isinstance(html.main_text(page), str)
    assert html.main_text("plain  text") == "plain text" and html.main_text(None) == ""
    rows = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, body, "y")], "page_id long, url string, html string, text string")
    out = html.extract_text(rows).collect()
    assert len(out) == 3 and all(r.n_chars == len(r.text) for r in out)
    assert html.extract_text(rows.limit(0)).count() == 0


def test_kmeans_tree(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(900, 8)), np.tile(rng.normal(size=8), (300, 1)) + 1e-3 * rng.normal(size=(300, 8))]).astype(np.float32)
    rows = [(k, v.tolist(), "e") for k, v in enumerate(x)]
    bad = [(5000, None, "e"), (5020, [0.0] * 8, "e"), (5040, [float("nan")] * 8, "e"), (5060, [1.0, 2.0], "e"), (5080, [None, *[1.0] * 7], "e"), (None, [1.0] * 8, "e")]
    vectors = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, leaf string")
    got = collections.defaultdict(list)
    for r in kmtree.nearest(vectors, F.col("vec_id") % 20 == 0, sample=512).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    d, hits = x.astype(float), 0
    assert sorted(got) == list(range(0, 1200, 20))
    for q, rs in got.items():
        s = d @ d[q]
        s[q] = -np.inf
        hits += len({r.vec_id for r in rs} & set(np.lexsort((np.arange(len(s)), -s))[:20].tolist()))
        assert [r.rank for r in rs] == list(range(1, 21)) and all(abs(r.score - s[r.vec_id]) < 1e-9 for r in rs)
    assert hits / (20 * len(got)) >= 0.9
    few = kmtree.nearest(vectors.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert kmtree.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_quality(spark, awkward, empty, labels):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labelled = table(spark, "/root/testdata/sf0.01", "labels")
    train, held = labelled.where("doc_id % 2 = 0"), labelled.where("doc_id % 2 = 1")
    found = quality.classified(docs, train).select("doc.doc_id", "keep", "score").join(held, "doc_id").toPandas()
    assert (found["keep"] == (found["quality"] == 1)).mean() > 0.95
    assert quality.classified(awkward, labels).count() == awkward.count()
    assert quality.classified(awkward, labels.limit(0)).where("keep").count() == awkward.count()
    assert quality.filtered(empty, labels).count() == 0 and quality.filtered(awkward, labels).columns == awkward.columns


def brute_spans(texts: list[bytes], length: int, first_stays: bool) -> list[np.ndarray]:
    at = collections.defaultdict(list)
    for d, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            at[t[s : s + length]].append((d, s))
    masks = [np.zeros(len(t), bool) for t in texts]
    for places in at.values():
        for d, s in sorted(places)[1:] if first_stays else places if len(places) > 1 else ():
            masks[d][s : s + length] = True
    return masks


@pytest.mark.parametrize("keep,group", [("none", 1024), ("none", 1), ("first", 1024), ("first", 1)])
def test_suffixes(spark, keep, group):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcé"), 6))
    shared = [" ".join(word() for _ in range(12)) for _ in range(4)]
    texts = ["x" * 150, "xy" * 90, "", "short", shared[0], shared[0] + "!"]
    texts += [" ".join([word(), shared[rng.integers(4)][rng.integers(10) :], word(), shared[rng.integers(4)], word()]) for _ in range(60)]
    docs = spark.createDataFrame([(k, t, "e") for k, t in enumerate(texts)] + [(999, None, "e")], "doc_id long, text string, key string").repartition(4)
    got = {r.doc_id: r for r in suffixes.digest(suffixes.removed(docs, length=40, gram=16, keep=keep, group=group)).collect()}
    raw = [t.encode() for t in texts]
    for k, mask in enumerate(brute_spans(raw, 40, keep == "first")):
        left = np.frombuffer(raw[k], np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        assert (got[k].n_bytes, got[k].n_removed, got[k].n_spans, got[k].kept_sha256) == (len(raw[k]), int(mask.sum()), runs, hashlib.sha256(left).hexdigest()), k
    assert (got[999].n_bytes, got[999].n_removed) == (0, 0)


def test_suffixes_awkward(awkward, empty):
    out = suffixes.digest(suffixes.removed(awkward)).collect()
    assert len(out) == awkward.count() and {r.n_removed > 0 for r in out if r.doc_id in (5, 6)} == {True}
    assert suffixes.removed(empty).count() == 0
    kept = suffixes.kept_text(suffixes.removed(awkward, keep="first"), awkward.columns)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_warc(spark):
    rows = [(k, f"http://h/{k % 3}", t, "x") for k, t in enumerate(["<p>a</p>", "<p>a</p>", "", None, "é" * 70_000, "<p>b\r\n\r\nc</p>"])]
    pages = spark.createDataFrame(rows + [(1, "http://h/1", "<p>a</p>", "x"), (None, None, "<p>a</p>", "x")], "page_id long, url string, html string, payload string").repartition(3)
    out = warc.archive_round_trip(pages, checkpoint_root(spark))
    got = sorted(out.collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    assert [(r.page_id, r.record_type, r.refers_to) for r in got] == [(0, "response", None), (1, "revisit", 0), (1, "revisit", 0), (2, "response", None), (3, "revisit", 2), (4, "response", None), (5, "response", None), (None, "revisit", 0)]
    whole = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        if r.page_id is not None:
            assert r.payload_bytes == len(whole[r.page_id]) and r.payload_digest == warc.sha1_base32(whole[r.page_id])
            assert r.record_type == "revisit" or bytes(r.payload) == whole[r.page_id]
    assert warc.archive_round_trip(pages.limit(0), checkpoint_root(spark)).count() == 0


def test_warc_on_rows_whose_places_change(spark, monkeypatch):
    """A source whose rows come in another order each time it is read: every
    payload still has one response, and repeated rows keep their number."""
    monkeypatch.setattr(warc, "COPIES", 7)
    rows = [(k, f"u{k}", f"<p>{k % 40}</p>") for k in range(300)] + [(3, "u3", "<p>3</p>")] * 50 + [(None, None, "<p>n</p>"), (None, "", "<p>n</p>")]

    def disorder(batches):
        import pandas as pd

        yield pd.concat(list(batches)).sample(frac=1.0)

    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).mapInPandas(disorder, "page_id long, url string, html string").repartition(3)
    found = warc.archive_round_trip(pages, checkpoint_root(spark)).collect()
    assert collections.Counter((r.page_id, r.payload_digest) for r in found) == collections.Counter((k, warc.sha1_base32(h.encode())) for k, _, h in rows)
    responses = [r for r in found if r.record_type == "response"]
    assert sorted(r.page_id if r.page_id is not None else -1 for r in responses) == [-1, *range(40)]
    assert all(r.refers_to == (r.page_id or 0) % 40 for r in found if r.record_type == "revisit" and r.page_id is not None)
    small = warc.archive_round_trip(pages, checkpoint_root(spark), min_payload=9)      # only the two-digit ones are long enough
    assert collections.Counter(r.record_type for r in small.collect() if r.page_id is not None and r.page_id % 40 < 10) == collections.Counter(response=130)


def test_warc_files_are_plain_zstd(spark):
    import zstandard

    pages = table(spark, SF, "pages")
    path = warc.write_archives(pages, f"{checkpoint_root(spark)}/warc-plain")
    data = bytes(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).first()["content"])
    (magic, start, end), *rest = list(warc.frames(data))
    assert magic == warc.DICT_MAGIC
    whole = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[start + 8 : end])).stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == sum(m & 0xFFFFFFF0 != 0x184D2A50 for m, *_ in rest)


def test_imatch(spark, awkward, empty):
    docs = awkward.select("doc_id", "text", "hash").unionByName(table(spark, SF, "documents").select((F.col("doc_id") + 100).alias("doc_id"), "text", F.lit("z").alias("hash")))
    rows = imatch.edited_likeness(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, key=lambda k: (k is not None, k))
    follow = {k: order[(j + 1) % len(order)] for j, k in enumerate(order)}
    by_text = {}
    for r in rows:
        t, nxt = texts[r.doc_id], texts[follow[r.doc_id]]
        q = len(t) // 4
        assert r.n_chars == len(t) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - q] + nxt[:q]).encode()).hexdigest(), r.doc_id
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    usual = [r for r in rows if r.n_chars > 400 and r.fingerprint != by_text[texts[follow[r.doc_id]]]]
    assert np.mean([r.near_edited for r in usual]) > np.mean([r.near_next for r in usual]) + 0.3
    assert imatch.edited_likeness(empty).count() == 0
    alone = imatch.edited_likeness(awkward.where("doc_id = 3")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def brute_components(texts: dict, similar=(85, 100)) -> dict:
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    label = {k: k for k in texts}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and similar[1] * both >= similar[0] * (len(sets[a]) + len(sets[b]) - both):
                label[max(root(a), root(b))] = min(root(a), root(b))
    return {k: (root(k), len(sets[k])) for k in texts}


def test_minhash(spark, awkward, empty):
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in rng.integers(0, 500, 300)]
    texts = {}
    for k in range(120):  # a group of near copies, many of them just about the threshold
        w = list(base)
        for at in rng.integers(0, 300, rng.integers(0, 8)):
            w[at] = f"edit{k}_{at}"
        texts[k + 20] = " ".join(w)
    docs = spark.createDataFrame([(k, t, "z") for k, t in texts.items()], "doc_id long, text string, label string")
    some = awkward.where("doc_id is not null").select("doc_id", "text", "label")
    docs = docs.unionByName(some)
    got = minhash.near_duplicates(docs, chunk=16, bucket_chunk=16).collect()
    assert len(got) == docs.count()
    want = brute_components(texts | {r.doc_id: r.text for r in some.collect()})
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.near_duplicates(awkward).count() == awkward.count()


def test_components(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 200)], "a long, b long")
    got = {r.id: r.label for r in minhash.components(chain).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 200: 100}


def test_bayes_bound():
    least = minhash.least_matches(36, 252, 0.85, 1e-6)
    assert len(least) == 7 and least == sorted(least) and all(m < 36 * (j + 1) for j, m in enumerate(least))
    tail = lambda n, m: sum(math.comb(n + 1, i) * 0.85**i * 0.15 ** (n + 1 - i) for i in range(m + 1))
    assert tail(36, least[0]) >= 1e-6 > tail(36, least[0] - 1)


def test_pipeline(spark, awkward, labels, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mix", "pack"]
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != "pack":
            assert docs.columns == before.columns
            assert [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
        if name == "near_duplicates":
            want = brute_components({r.doc_id: r.text for r in before.collect()}, corpus_pipeline.SIMILAR)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(k for k, (c, _) in want.items() if c == k)
        if name == "repeated_passages":
            rows = sorted(before.collect(), key=lambda r: r.doc_id)
            raw = [r.text.encode() for r in rows]
            left = {r.doc_id: np.frombuffer(t, np.uint8)[~m].tobytes().decode("utf-8", "ignore") for r, t, m in zip(rows, raw, brute_spans(raw, 200, True), strict=True)}
            got = {r.doc_id: r.text for r in docs.collect()}
            assert got == {k: t for k, t in left.items() if t.strip()}
    assert docs.count() > 0
    odd = awkward
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SF)
    assert odd.count() > 0


def test_near_duplicate_stage_keeps_other_texts_of_an_id(spark):
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "de", "s", 1), (1, "quite another text than that one", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (3, None, "en", "s", 1), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id or 0, r.text, r.lang) for r in got), key=str) == sorted([(1, "a b c d e f", "de"), (1, "quite another text than that one", "en"), (3, None, "en"), (0, "x", "en"), (0, "x", "en")], key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_oracle_of_mixing(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(E.oracle_sql()["op3_mixing"]).df().sort_values("doc_id").reset_index(drop=True)
    got = E.queries()["op3_mixing"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == len(want)
    for c in want.columns:
        assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9), c


def test_every_operator_is_registered():
    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
