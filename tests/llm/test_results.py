"""Operators against plain versions on the smallest tables."""

import collections
import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_bpe_is_the_tokenizers_library(spark, texts):
    from tokenizers import Tokenizer
    from vigil.llm.bpe import default_tokenizer, op1_bpe
    library = Tokenizer.from_file(default_tokenizer())
    for r in op1_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_mix_meets_its_targets(spark, texts):
    from vigil.llm.mixing import op2_mixing
    rows = op2_mixing(spark, SF).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len((t or "").encode().split()) for i, t in texts.items()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    total = sum(r.size for r in rows)
    assert sum(r[0].target for r in by.values()) == pytest.approx(total)
    for source in by.values():
        assert source[0].source_size == sum(r.size for r in source)
        assert sum(r.taken for r in source) == pytest.approx(source[0].target, rel=0.02)
    again = {r.doc_id: r.taken for r in op2_mixing(spark, SF).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_targets_stop_at_three_times_a_source(spark):
    from vigil.llm.mixing import mix
    words = {"a": 10, "b": 1000, "c": 5}
    df = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(words.items())], "doc_id long, text string, source string")
    got = {r.source: r for r in mix(df).collect()}
    assert got["a"].target == 30 and got["c"].target == 15 and got["b"].target == pytest.approx(970)


def test_embeddings_against_all_pairs(spark):
    from vigil.llm.hnsw import near_duplicates
    dice = np.random.default_rng(3)
    base = dice.normal(size=(40, 16))
    x = np.concatenate([base, base[:10] + dice.normal(size=(10, 16)) * 0.02, np.repeat(base[:1], 60, 0) + dice.normal(size=(60, 16)) * 0.05, base[5:7]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    links = [(i, j) for i in range(len(x)) for j in range(i) if near[i, j]]
    root = roots(range(len(x)), links)
    got = {r.vec_id: r for r in near_duplicates(df).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: int(near[i].sum()) - 1 for i in range(len(x))}
    assert {i: r.component_id for i, r in got.items()} == root
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def searched(graph, x, at):
    from vigil.llm.hnsw import THRESHOLD, Search
    task = Search(np.arange(len(x)), x, np.ones(len(x), int), graph, THRESHOLD)
    return task, *task.run(at, x[at])


def test_graph_search_finds_what_brute_force_finds():
    from vigil.llm.hnsw import Hnsw
    dice = np.random.default_rng(5)
    x = dice.normal(size=(3000, 32))
    x[1000:1400] = x[0] + dice.normal(size=(400, 32)) * 0.08  # wider than the first beam
    _, counts, _ = searched(Hnsw.load(Hnsw(x).dump()), x, np.arange(900, 1500))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = (unit[900:1500] @ unit.T >= 0.95).sum(1) - 1
    assert (counts == truth).all() and truth.max() > 300


def test_a_large_group_is_read_to_its_end(spark):
    from vigil.llm.hnsw import near_duplicates
    dice = np.random.default_rng(8)
    x = dice.normal(size=(6000, 24))
    x[:5000] = x[0] + dice.normal(size=(5000, 24)) * 0.1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    x = x.astype(np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    got = {r.vec_id: r for r in near_duplicates(df).collect()}
    assert [got[i].n_links for i in range(6000)] == (near.sum(1) - 1).tolist()
    root = roots(range(6000), [(i, int(j)) for i in range(6000) for j in (near[i].argmax(), near[:, i].argmax())] + [(i, int(j)) for i in range(0, 6000, 50) for j in np.flatnonzero(near[i])])
    assert {i: r.component_id for i, r in got.items()} == root


@pytest.mark.parametrize("dense, sparse", [(21, 43), (2000, 60)])
def test_audit_weighs_every_query_alike(dense, sparse):
    dice = np.random.default_rng(6)
    x = dice.normal(size=(3000 + sparse, 32))
    x[:3000] = x[0] + dice.normal(size=(3000, 32)) * 0.02
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)

    class Narrow:  # finds the dense group with any beam, single nodes with a wide one
        def near(self, q, width, low):
            found = [np.flatnonzero(row >= low) for row in q @ x.T]
            return [f if len(f) > 100 or width >= 256 else f[:0] for f in found]
    graph = Narrow()
    graph.x = x
    task, counts, _ = searched(graph, x, np.concatenate([np.arange(dense), np.arange(3000, 3000 + sparse)]))
    assert task.beam >= 256 and (counts[:dense] == 2999).all() and not counts[dense:].any()


def test_languages(spark):
    from vigil.llm.language import op4_language_id
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = op4_language_id(spark, SF).collect()
    docs = [r for r in rows if r.doc_id is not None]
    assert len(docs) == len(truth)
    assert sum(r.lang == truth[r.doc_id] for r in docs) >= 0.97 * len(docs)
    pages = [r for r in rows if r.page_id is not None]
    assert pages and sum(r.lang == r.declared for r in pages) >= 0.9 * len(pages)


def test_copies_and_common_languages_leave_room_in_the_samples(spark, monkeypatch):
    from vigil.llm import extract, language
    texts = [(f"the house number {i} of the long street", "en") for i in range(300)] + [(f"das haus nummer {i} an der langen gasse", "de") for i in range(3)]
    texts += [(t, lang) for t, lang in texts for _ in range(60)]  # whichever text has the lowest hash, its copies would fill the sample
    langs, logs = language.train(spark.createDataFrame(texts, "text string, lang string"), most=40)
    assert langs == ["de", "en"] and logs.shape == (2, language.CELLS)
    counts = np.bincount(language.trigrams("das haus nummer 1 an der langen gasse"), minlength=language.CELLS)
    seen = np.exp(logs[0].astype(float)) > np.exp(logs[0].min()) * 1.5
    assert seen[counts > 0].all()
    taken = []
    monkeypatch.setattr(extract, "train", lambda pages: taken.extend(pages))
    pages = [(i, f"<article><p>page {i % 12}</p></article>") for i in range(12 * 50)]
    extract.extract(spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string"), train_pages=8)
    assert len(taken) == len(set(taken)) == 8


def test_declared_language_is_found_anywhere_in_the_page(spark):
    import time
    from vigil.llm.language import CELLS, declared_language, identify
    page = lambda before: f'<!doctype html>{before}<HTML class="x" LANG="de"><body></body></html>'
    pages = [page(b) for b in ("", "<!--" + "licence " * 2000 + "-->", " " * 100000, "<script>" + "x=1;" * 3000 + "</script>", '<!-- <html lang="en"> -->', "<html>", "<!-->")]
    rows = [("p", i, None, h, None, None) for i, h in enumerate(pages)]
    df = spark.createDataFrame(rows, "key string, id long, text string, html string, url string, host string")
    got = identify(df, ["de", "en"], np.full((2, CELLS), -11, np.float32)).collect()
    assert [r.declared for r in got] == ["de"] * len(pages)
    assert declared_language("<p>lang=en</p>") is None
    began = time.perf_counter()
    for hostile in ("<!--", "<html ", "<", "<html lang", "<!-- -"):
        declared_language(hostile * 300000)
    assert time.perf_counter() - began < 10


def test_evidence_decides_where_the_text_is_silent(spark):
    from vigil.llm.language import CELLS, identify, trigrams
    text = {"en": "the quick and the dead of the house that was here with them and others", "de": "der hund und die katze sind nicht immer in dem haus gewesen aber doch"}
    logs = np.stack([np.log((np.bincount(trigrams(t), minlength=CELLS) + 0.5) / (len(trigrams(t)) + CELLS / 2)) for t in (text["de"], text["en"])]).astype(np.float32)
    page = lambda lang, body: f'<html lang="{lang}"><body><p>{body}</p></body></html>'
    rows = [(f"x{i}", i, page("de", text["de"]), "http://a.de/1") for i in range(20)] + [(f"y{i}", 100 + i, page("en", text["en"]), "http://b.com/1") for i in range(20)]
    rows += [("quiet", 1000, page("de", ""), "http://a.de/2"), ("nothing", 1001, None, None), ("host", 1002, "<p></p>", "http://b.com/9")]
    df = spark.createDataFrame([(k, i, None, h, u, None) for k, i, h, u in rows], "key string, id long, text string, html string, url string, host string")
    got = {r.key: r for r in identify(df, ["de", "en"], logs).collect()}
    assert got["quiet"].lang == "de" and got["quiet"].posterior > 0.9 and got["host"].lang == "en"
    assert got["nothing"].lang in ("de", "en") and got["nothing"].text_lang is None


def test_licence_lines_are_found_and_prose_is_left(spark):
    from vigil.llm.licences import scan
    prose = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()
    plain = [t for (t,) in prose if "icense" not in t and "rights reserved" not in t][:60]
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "All rights reserved.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3."]
    rows = [(i, t) for i, t in enumerate(plain)] + [(100 + i, plain[0] + "\n" + x) for i, x in enumerate(lines)] + [(200, None), (201, "")]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.family) for r in got if r.confirmed} == {(100, "MIT"), (101, "Apache"), (102, "Proprietary"), (103, "CC"), (104, "GPL")}
    assert not [r for r in got if r.doc_id < 100]


def repeated(words, k=8):
    seen = collections.Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    hit = {j for i in range(len(words) - k + 1) if seen[tuple(words[i:i + k])] > 1 for j in range(i, i + k)}
    return len(hit)


def test_quality_counts(spark, texts):
    from vigil.llm.quality import op6_quality_rules
    for r in op6_quality_rules(spark, SF).collect():
        raw = (texts[r.doc_id] or "").encode()
        words = raw.split()
        lines = [x for x in raw.split(b"\n") if x.split()]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(len(w.decode()) for w in words), sum(c in b"#*$%&|<>" for c in raw))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == repeated(words)
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert not (r.base_failed and r.kept)


def test_bands_reject_noise_and_repetition_and_keep_prose(texts):
    import os
    import base64
    import zstandard
    from vigil.llm.quality import measure, repeat_words
    packer = zstandard.ZstdCompressor(level=3)
    verdict = lambda raw: measure(raw, packer)[-1]
    prose = max(texts.values(), key=lambda t: len(set(t.split()))).encode()
    assert verdict(prose)
    noise = base64.b64encode(os.urandom(30000))
    assert not verdict(b" ".join(noise[i:i + 7] for i in range(0, len(noise), 7)))
    assert not verdict(b" ".join(b"item %d of the list" % (i % 40) for i in range(4000)))
    words = b"a a a a a a a a a b c".split()
    assert repeat_words(words) == repeated(words) == 9


def test_main_text_of_given_and_other_templates(spark):
    import html as entities
    import re
    from vigil.llm.extract import main_texts, op7_html_extraction, train
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    wrong = 0
    gold = {}
    for i, h in pages:
        body = re.split("</?(?:p|h1)>", h.split("<article>", 1)[1].split("</article>")[0].split("<footer>")[0])
        gold[i] = "\n".join(x for x in (" ".join(entities.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in body) if x)
    for r in op7_html_extraction(spark, SF).collect():
        wrong += r.text != gold[r.page_id]
        assert r.n_chars == len(r.text)
    assert wrong <= 0.02 * len(pages)
    model = train([h for _, h in pages])
    other = ('<html><body><header><h2>Site</h2></header><div class="cookie-notice"><p>We use cookies.</p></div><div id="menu"><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></div>'
             '<div class="post"><h1>A title of the page</h1><p>The first paragraph is long enough, with <b>bold</b> words &amp; an entity.</p><p>The second one follows it, and is\n long as well.</p></div>'
             '<div class="comments"><p>I liked it very much.</p></div><footer><p>Copyright</p></footer></body></html>')
    assert main_texts([other], model) == ["A title of the page\nThe first paragraph is long enough, with bold words & an entity.\nThe second one follows it, and is long as well."]


def test_jaccard_components_against_all_pairs(spark, texts):
    from vigil.llm.jaccard import op8_ngram_join
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = [(i, j) for i in sets for j in sets if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = roots(sets, links)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op8_ngram_join(spark, SF).collect()} == {i: (len(s), root[i]) for i, s in sets.items()}
    assert links


def test_a_chain_of_variants_is_one_component(spark):
    from vigil.llm.jaccard import join
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[4 * k:4 * k + 200])) for k in range(12)] + [(100 + k, " ".join(words[:150] + [f"x{k}"] + words[151:200])) for k in range(40)]
    got = {r.doc_id: r.component_id for r in join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_groups_against_edit_distance_alone(spark, texts):
    from pyspark.sql import functions as F
    from vigil.llm.lines import op9_line_dedup, text_lines
    lines = sorted((i, n, x.decode()) for i, t in texts.items() for n, x, _ in text_lines(t))
    distinct = sorted({x for *_, x in lines})
    table = spark.createDataFrame(list(enumerate(distinct)), "i long, x string").repartition(8)
    most = "greatest(length(a.x), length(b.x)) div 10"
    both = table.alias("a").join(F.broadcast(table).alias("b"), F.expr(f"a.i < b.i AND abs(length(a.x) - length(b.x)) <= {most}"))
    links = [tuple(r) for r in both.where(f"levenshtein(a.x, b.x, cast({most} AS int)) >= 0").select("a.i", "b.i").collect()]
    root, at = roots(range(len(distinct)), links), {x: i for i, x in enumerate(distinct)}
    first = {}
    for i, n, x in lines:
        first.setdefault(root[at[x]], (i, n))
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no, r.kept) for r in op9_line_dedup(spark, SF).collect()}
    assert links and got == {(i, n): (*first[root[at[x]]], (i, n) == first[root[at[x]]]) for i, n, x in lines}


def edited(line, n, dice):
    chars = list(line)
    for _ in range(n):
        at, kind = int(dice.integers(len(chars))), dice.integers(3)
        chars[at:at + (kind != 1)] = [] if kind == 0 else ["qxyz"[dice.integers(4)]]
    return "".join(chars)


def test_line_recall_against_edit_distance_alone(spark, texts):
    from pyspark.sql import functions as F
    from vigil.llm.lines import duplicates, text_lines
    dice = np.random.default_rng(4)
    plain = sorted({x.decode() for t in texts.values() for _, x, _ in text_lines(t)})
    lines = []
    for i in range(360):
        n = (18, 30, 45, 70, 100, 200)[i % 6]
        base = dice.choice([x for x in plain if len(x) >= n][:400])[:n]
        share = (i // 6) % 3
        lines += [base, edited(base, (1, max(1, n // 20), n // 10)[share], dice)]
    lines = [" ".join(x.split()) for x in lines]
    same = "one two three " * 20
    lines += [same.strip(), "x" + same.strip()]  # repeats one run of characters over and over
    lines = sorted({x for x in lines if text_lines(x)})
    table = spark.createDataFrame(list(enumerate(lines)), "i long, x string")
    both = table.alias("a").join(table.alias("b"), F.expr("a.i < b.i AND abs(length(a.x) - length(b.x)) * 10 <= greatest(length(a.x), length(b.x))"))
    truth = both.selectExpr("a.i AS a", "b.i AS b", "a.x AS x", "b.x AS y").where("levenshtein(x, y) * 10 <= greatest(length(x), length(y))").select("a", "b").collect()
    root = roots(range(len(lines)), [tuple(r) for r in truth])
    got = {r.doc_id: r.group_id for r in duplicates(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    found = [got[a] == got[b] for a, b in truth]
    exact = [got[a] == got[b] for a, b in truth if max(len(lines[a]), len(lines[b])) < 60]
    assert len(exact) > 100 and all(exact) and len(found) > 250 and sum(found) >= 0.98 * len(found)
    assert len({(root[i], got[i]) for i in got}) == len(set(got.values()))  # nothing else is joined


def test_lines_without_spaces_are_deduplicated(spark):
    from vigil.llm.lines import duplicates
    chinese = "".join(chr(0x4e00 + 37 * i % 9000) for i in range(40))
    url = "https://example.org/" + "a_long_path" * 6
    lines = [chinese, url, "Privacy policy", "ok"]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, chinese[:20] + "x" + chinese[21:])]
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no, r.kept) for r in duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{(d, n): (1, n, d == 1) for d in (1, 2) for n in range(3)}, (3, 0): (1, 0, False)}


def test_scores(spark, texts):
    from vigil.llm.scoring import learn_weights, op10_lm_scores
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i in texts if not held[i] for w in tokens[i])
    n, v = sum(count.values()), len(count)
    base = model = 0
    for r in op10_lm_scores(spark, SF).collect():
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
        assert r.score < 0
        if r.held_out:
            base, model = base + r.base_score, model + r.score
    assert model > base  # better than the base on documents it hasn't seen
    import pandas as pd
    weights = learn_weights(pd.DataFrame({"bucket": [5, 5], "p0": [-200, -250], "p1": [-50, 1], "n": [90, 10]}), 2, 1000)
    assert weights.sum(1) == pytest.approx(1) and weights[5, 2] > 0.5 and weights[0, 2] == 0
