"""Cases in which an operator once did less than its whole job."""

import itertools
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline

from tablepipe.llm import html, imatch, kmtree, licenses
from tablepipe.llm.common import table
from test_operators import SF, brute_components


def samples(pattern: str) -> list[str]:
    """Texts the expression matches, one for each of its alternatives at least."""

    def several(tokens) -> list[str]:
        return ["".join(x) for x in itertools.islice(itertools.product(*[one(op, arg) for op, arg in tokens]), 64)]

    def one(op, arg) -> list[str]:
        name = str(op)
        if name == "LITERAL":
            return [chr(arg)]
        if name == "IN":
            first, value = arg[0]
            return [chr(value) if str(first) == "LITERAL" else chr(value[0]) if str(first) == "RANGE" else " "]
        if name == "BRANCH":
            return [t for branch in arg[1] for t in several(branch)]
        if name == "SUBPATTERN":
            return several(arg[3])
        if name == "MAX_REPEAT":
            return [t * arg[0] for t in several(arg[2])][: None if arg[0] else 1]
        assert name in ("ASSERT", "ASSERT_NOT"), name
        return [""]

    return several(re._parser.parse(pattern))


def test_every_license_rule_fires_alone():
    scan, seen = licenses.Scanner().scan, 0
    for label, kind, _, conf, rx, _ in licenses.rules():
        for text in samples(rx):
            assert re.fullmatch(rx, text), (rx, text)
            got = scan(text)
            assert label in got["labels"].split(","), (label, kind, text, got)
            assert got["score"] >= 0.7
            seen += 1
    assert seen > 400
    assert scan("this project uses cddl 1.0")["labels"] == "cddl"
    assert scan("altered source versions must be plainly marked as such")["labels"] == "zlib"
    assert scan("see mariadb.com/bsl")["labels"] == "busl"


def test_license_rules_match_wrapped_text():
    scan = licenses.Scanner().scan
    for label, kind, _, _, rx, _ in licenses.rules():
        for text in samples(rx):
            for between in ("\n", "  ", "\r\n * ", "\n# ", "\n    // ", " */\n/* ", "\n-- ", "\n\n", "\ndnl ", '\n" ', " "):
                got = scan(text.replace(" ", between))
                assert label in got["labels"].split(","), (kind, text, between, got)
    mit = """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software.
 *
 * The above copyright notice and this permission notice shall be included in all
 * copies or substantial portions of the Software.
 */"""
    for text in (mit, mit.replace("\n * ", "\n")):
        got = scan(text)
        assert got["labels"] == "mit" and [s["kind"] for s in got["spans"]] == ["body"] * 3
    assert "lgpl" in scan("GNU Lesser General\nPublic License")["labels"].split(",")
    assert scan("expat - license, expat / license")["labels"] == ""


def test_license_score_does_not_fall_with_evidence():
    scan = licenses.Scanner().scan
    score = [scan("cddl 1.0 and odbl 1.0\n" + "eupl 1.2\n" * n)["score"] for n in (0, 1, 47, 48, 49, 200)]
    assert score == sorted(score) and abs(score[0] - 0.91) < 1e-12 and abs(score[-1] - 0.973) < 1e-12


def test_html_drops_only_boilerplate():
    text = "A long sentence of the story that one may read. " * 12
    page = lambda inner: f"<body><nav><a href=x>Menu</a></nav>{inner}<footer>Imprint</footer></body>"
    want = " ".join(text.split())
    # Attributes count by their names, not by what stands in a value.
    for attribute in ('style="overflow:hidden"', 'href="/wiki/Hidden_Markov_model"', 'href="/p?id=search"', 'data-x="role=navigation"', "title='a hidden place'", "data-hidden", "data-id=comments"):
        for tag in ("div", "a", "span", "p"):
            got = html.main_text(page(f"<article><h1>Head</h1><p>{text}</p><{tag} {attribute}>And this</{tag}></article>"))
            assert "And this" in got and want in got, (tag, attribute)
    # Class names count whole.
    for name in ("site no-sidebar", "ad-free", "has-header", "page-with-menu", "search-results", "menu-open"):
        assert html.main_text(page(f'<div class="{name}"><h1>Head</h1><p>{text}</p></div>')) == f"Head\n\n{want}", name
    for part in ('<div class="entry-header"><h1>Head</h1></div>', '<section id="discussion"><p>Head</p></section>', '<section id="comments">Head</section>', '<h2 id=navigation>Head</h2>'):
        assert html.main_text(page(f"<article><p>{text}</p>{part}</article>")) == f"{want}\n\nHead", part
    # What holds the article, the main element or most of the text stays.
    for around in ('div class="widget"', "form id=aspnetForm", 'div class="modal"', "div hidden", "aside", "div role=dialog"):
        for inner in ("article", "main", "div"):
            got = html.main_text(page(f"<{around}><{inner}><h1>Head</h1><p>{text}</p></{inner}></{around.split()[0]}>"))
            assert got == f"Head\n\n{want}", (around, inner)
    # The list still takes out what it names.
    for junk in ('<div class="ad">Buy</div>', "<div class='box sidebar'>Buy</div>", "<div id=comments>Buy</div>", "<div hidden>Buy</div>", "<p aria-hidden=true>Buy</p>", '<div role="navigation">Buy</div>', "<aside><article>Buy</article></aside>"):
        assert html.main_text(page(f"<article><h1>Head</h1><p>{text}</p>{junk}</article>")) == f"Head\n\n{want}", junk
    # A footer longer than a short article is none of it.
    assert html.main_text("<body><article><p>Short one.</p></article><footer>" + text + "</footer></body>") == "Short one."


def test_pipeline_links_pairs_from_four_fifths(spark):
    rng = np.random.default_rng(4)
    texts, want = {}, set()
    for k in range(60):  # pairs that differ in two to five words: similarity 0.77 to 0.91
        w = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
        v = list(w)
        for at in rng.choice(np.arange(10, 190, 9), 2 + k % 4, replace=False):
            v[at] = "edit"
        texts[2 * k], texts[2 * k + 1] = " ".join(w), " ".join(v)
        a, b = ({tuple(x[i : i + 5]) for i in range(196)} for x in (w, v))
        want |= {2 * k} | ({2 * k + 1} if 5 * len(a & b) < 4 * len(a | b) else set())
    assert 60 < len(want) < 90
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == want
    assert (1 - 0.8**corpus_pipeline.ROWS) ** corpus_pipeline.BANDS < 1e-6


def test_imatch_of_large_groups(spark):
    rng = np.random.default_rng(8)
    word = lambda n, of: [f"{of}{x}" for x in rng.integers(0, 400, n)]
    texts = [" ".join(word(200, "w")) for _ in range(200)]
    for g in ("g", "h"):  # two groups of near copies and one of copies, a tenth to a quarter of all each
        base = word(200, g)
        for k in range(60):
            texts.append(" ".join(base[:7] + [f"{g}new{k}"] + base[8:]))
    texts += [" ".join(word(200, "c"))] * 40
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in imatch.edited_likeness(docs).collect()}
    kind = lambda k: texts[k % len(texts)][0]
    for g in "wghc":
        assert np.mean([r.near_edited for k, r in rows.items() if kind(k) == g]) > 0.4, g
    for r in rows.values():
        assert not set(r.fingerprint.split(":")[1]) <= set("-,")
    apart = [r.near_next for k, r in rows.items() if {kind(k), kind(k + 1)} == {"g", "h"}]
    same = [r.near_next for k, r in rows.items() if kind(k) == kind(k + 1) and kind(k) in "ghc"]
    assert apart and max(apart) < 0.1 and min(same) > 0.5


def test_kmeans_tree_repeated_query_ids(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8))
    x[0] *= 9  # its own copies beat all others
    ids = [*range(600), *[0] * 35, *[20] * 7, *[33] * 400]
    x = np.concatenate([x, np.tile(x[0], (35, 1)), np.tile(x[20], (7, 1)), np.tile(x[33], (400, 1))])
    for scale in (1.0, 1e9):
        d = x * scale
        vectors = spark.createDataFrame([(k, v.tolist()) for k, v in zip(ids, d, strict=True)], "vec_id long, embedding array<double>")
        rows = kmtree.nearest(vectors, F.col("vec_id") % 20 == 0, target=1.0).collect()
        for q in range(0, 600, 20):
            s = (d @ d[q])[np.asarray(ids) != q]
            got = sorted((r.score for r in rows if r.query_id == q), reverse=True)
            assert len(got) == 20 and np.allclose(got, np.sort(s)[::-1][:20], rtol=1e-9), (scale, q, len(got))


def test_pipeline_near_duplicates_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    want = brute_components({r.doc_id: r.text for r in docs.collect()}, (80, 100))
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(k for k, (c, _) in want.items() if c == k)


def test_tokens_are_made_in_small_pieces():
    """What a task holds beside its text stays small, whatever a batch holds."""
    import tracemalloc

    import pyarrow as pa

    from tablepipe.llm import packing
    from tablepipe.llm.queries import VOCABULARY
    from tablepipe.llm.texts import pieces

    texts = [f"word{i % 50} and some more, {i} " * 250 for i in range(1200)]
    coder = packing.Coder(VOCABULARY, packing.END_ID)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    whole = coder.ids(batch.column(1))
    tracemalloc.start()
    found = [coder.ids(some.column(1)) for some in pieces(iter([batch]), 1, packing.PIECE)]
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - kept < 80e6
    assert all((a == b).all() for a, b in zip(whole, (np.concatenate([f[k] for f in found]) for k in (0, 1)), strict=True))
