"""Rows that share an id, hostile pages, lists and tables in articles, totals beyond 32 bits, tables that are deleted."""

import glob
import time
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

TRAIN = "/root/testdata/sf0.01"

ONE = "The first paragraph of this story tells of a long road that runs along the river to the sea."
TWO = "In the second part the road turns inland, climbs the hills and ends at an old stone house."
KINDS = {
    "<ul><li>One thing that is told here.</li><li>Another thing that is told.</li></ul>": ["One thing that is told here.", "Another thing that is told."],
    "<ol><li><p>First step of the way.</p></li><li><p>Second step of the way.</p></li></ol>": ["First step of the way.", "Second step of the way."],
    "<table><tr><th>Year</th><th>Length</th></tr><tr><td>1999</td><td>twelve miles</td></tr></table>": ["Year", "Length", "1999", "twelve miles"],
    "<pre>walk  until\n the end</pre>": ["walk until the end"],
    "<pre><code>go = north + west</code></pre>": ["go = north + west"],
    "<blockquote>He who walks sees more than he who rides.</blockquote>": ["He who walks sees more than he who rides."],
    "<blockquote><p>He who walks sees more.</p><p>He who rides sees less.</p></blockquote>": ["He who walks sees more.", "He who rides sees less."],
    '<figure><img src="a.png"><figcaption>The stone house in the evening.</figcaption></figure>': ["The stone house in the evening."],
    "<section><h2>On the hills</h2><p>The hills are green in spring and brown in autumn.</p></section>": ["On the hills", "The hills are green in spring and brown in autumn."],
    "<dl><dt>Road</dt><dd>A way between two places.</dd></dl>": ["Road", "A way between two places."],
    '<div data-y="1.5"><p data-y="">A paragraph in a box with odd attributes.</p></div>': ["A paragraph in a box with odd attributes."],
    '<p data-y="0">A paragraph with a zero.</p><p data-y="top">And one with a word.</p>': ["A paragraph with a zero.", "And one with a word."],
}


@pytest.fixture(scope="module")
def model():
    from vigil.llm.extract import train
    return train([r[0] for r in duckdb.sql(f"SELECT html FROM '{TRAIN}/pages.parquet' WHERE html <> '' ORDER BY md5(html) LIMIT 200").fetchall()])


@pytest.mark.parametrize("html", KINDS)
def test_articles_keep_what_is_not_a_paragraph(model, html):
    from vigil.llm.extract import main_texts
    page = ('<html><body><nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li></ul></nav>'
            f'<article><h1>A road to the sea</h1><p>{ONE}</p>{html}<p>{TWO}</p></article>'
            '<div class="comments"><p>Nice text, thanks.</p></div><footer><p>Copyright 2024 the site.</p></footer></body></html>')
    assert main_texts([page], model) == ["\n".join(["A road to the sea", ONE, *KINDS[html], TWO])]


def test_labels_are_read_from_rewritten_pages_only():
    from vigil.llm.extract import Page
    html = '<div data-y="1"><p data-y="0">x</p></div>'
    assert set(Page(html).mark) == {None} and Page(html, marked=True).mark[-1] == 0


@pytest.mark.parametrize("html", ["<script>" * 60000, "<" * 400000, "<!--" * 100000 + ">", "<nav " * 80000 + ">", "<style>" * 60000 + "</style>"])
def test_visible_text_takes_linear_time(html):
    from vigil.llm.language import visible
    start = time.time()
    visible(html)
    assert time.time() - start < 2


def test_visible_text():
    from vigil.llm.language import visible
    cases = {"a<b>b</b>c": "a b c", "x<script>var a = '<p>';</SCRIPT >y": "x y", "x<!-- <p> -->y": "x y", "x<script>y": "x y", "x<!-- y <p>z": "x z", "a < b &amp; c": "a < b & c",
             "<nav>n<nav>m</nav>o</nav>p": "o p", "<scripted>q</scripted>": "q", "1 <2> 3 > 4": "1 3 > 4"}
    assert {h: visible(h).split() for h in cases} == {h: t.split() for h, t in cases.items()}


def test_rows_of_one_id_are_scanned_apart(spark):
    from vigil.llm.licences import scan
    licence, prose = "Released under the MIT License.", "This is prose that stands alone here."
    rows = [(1, licence), (1, prose), (1, licence), (None, prose), (None, f"{prose}\n{licence}"), (2, None), (3, "")]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS paragraph", "'x' AS family")).collect()
    assert sorted(((r.doc_id or 0, r.paragraph, r.family, r.text) for r in got)) == [(0, 1, "MIT", licence), (1, 0, "MIT", licence), (1, 0, "MIT", licence)]


@pytest.mark.parametrize("text, family", [("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.", "BSD"),
                                         ("She walked along the river to the old stone house.", None)])
def test_licences_by_their_sentences(spark, text, family):
    from vigil.llm.licences import scan
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = scan(docs.unionByName(spark.createDataFrame([(-1, text)], "doc_id long, text string"))).where("doc_id = -1").collect()
    assert [(r.family, r.confirmed) for r in got] == ([(family, True)] if family else [])


def test_totals_beyond_32_bits(spark):
    from vigil.llm import packed as P
    keys = np.array([5, 7 << 60, 9 << 60], np.uint64)
    counts = [np.array([3_000_000_000, 1, 0], np.uint32), np.array([3_000_000_000, 2, 0], np.uint32)]

    def ask(batches):
        for batch in batches:
            for b in batch.column("id").to_pylist():
                yield P.requests(b, 1, keys, counts[b], counts[b][::-1].copy(), 4)
    asked = spark.range(2).mapInArrow(ask, P.REQUEST)
    told = P.totals(asked, (np.add, np.uint32), (np.add, np.uint32)).toPandas()
    for b in (0, 1):
        first, second = P.answers(told[told["batch"] == b], 1, (np.uint32, np.uint32))
        assert first.tolist() == [6_000_000_000, 3, 0] and second.tolist() == [0, 3, 6_000_000_000]


def test_staged_tables_are_deleted(spark):
    from vigil.llm.common import components, stage, unstage
    kept, gone = stage(spark.range(3), "kept"), stage(spark.range(5), "gone")
    folder = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    unstage(gone)
    assert not glob.glob(folder) and kept.count() == 3
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.component for r in components(links).collect()} == {0}


def test_edit_distance_on_bits():
    from vigil.llm.lines import within

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    dice = np.random.default_rng(8)
    word = lambda: "".join(dice.choice(list("abcé"), int(dice.integers(0, 90))))
    for _ in range(150):
        x = word()
        y = word() if dice.random() < 0.3 else x[:7] + x[9:40] + "z" + x[40:]
        edits = distance(x, y)
        assert all(within(x, y, most) == (edits <= most) for most in (0, max(0, edits - 1), edits, edits + 1))


def test_split_keys_lose_no_pair():
    from vigil.llm.lines import IN_KEY, SEVERAL, allowed, split_keys
    dice = np.random.default_rng(9)
    for _ in range(400):
        n = int(dice.integers(54, 3000))
        edits = allowed(n)
        m, p = n - int(dice.integers(0, edits + 1)), int(dice.integers(0, n - 12))
        q = int(np.clip(p + dice.integers(-edits, edits + 1), 0, m))
        for places in ((p, q), (SEVERAL, q), (p, SEVERAL), (IN_KEY, IN_KEY)):
            tokens, source = split_keys(np.full(2, 77, np.uint64), np.array([n, m]), np.array(places))
            assert set(tokens[source == 0].tolist()) & set(tokens[source == 1].tolist())
    far, source = split_keys(np.full(2, 77, np.uint64), np.array([100, 400]), np.array([5, 5]))
    assert not set(far[source == 0].tolist()) & set(far[source == 1].tolist())


def test_lines_that_share_a_passage_elsewhere_are_apart(spark):
    from vigil.llm.lines import duplicates
    dice = np.random.default_rng(10)
    text = lambda n: " ".join("".join(dice.choice(list("abcdefghij"), 6)) for _ in range(n))
    passage, line = text(60), text(40)
    rows = [(1, f"{passage} {text(20)}"), (2, f"{text(20)} {passage}"), (3, f"{text(10)} {passage} {text(10)}"), (4, f"{line} {text(2)}"), (5, line)]
    got = {r.doc_id: r.kept_doc_id for r in duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4}


def test_licence_model_learns_from_every_ordinary_paragraph(spark, monkeypatch):
    from vigil.llm import licences as L
    seen, stage = [], L.stage

    def noting(df, name):
        out = stage(df, name)
        if name == "ordinary":
            seen.extend(out.groupBy("held").sum("n").collect())
        return out
    monkeypatch.setattr(L, "stage", noting)
    rows = spark.range(5000).selectExpr("id AS doc_id", "concat('the ', id, 'th use of this file is free', '\nthe ', id, 'th use of this file is free') AS text")
    more = spark.createDataFrame([(-1, "Released under the MIT License.")], "doc_id long, text string")
    got = L.scan(rows.unionByName(more)).collect()
    assert [(r.doc_id, r.family, r.confirmed) for r in got] == [(-1, "MIT", True)]
    assert sum(r[1] for r in seen) == 5000 and {r[0]: 800 < r[1] for r in seen} == {True: True, False: True}


def test_a_reused_worker_drops_the_coder_of_a_finished_stage(spark):
    from vigil.llm import bpe, common
    docs = spark.createDataFrame([(i, f"one line of text with number {i}") for i in range(8)], "doc_id long, text string").coalesce(1)

    def held(batches):
        for batch in batches:
            yield batch.slice(0, 1).set_column(0, "doc_id", pa.array([len(common._KEPT)], pa.int64()))
    bpe.digests(docs).collect()
    common.map_batches(docs, lambda part: part, docs.schema).count()
    assert [r.doc_id for r in docs.mapInArrow(held, docs.schema).collect()] == [0]
    made = []
    for owner in (1, 1, 2, 1):
        common.kept(owner, lambda: made.append(owner) or owner)
    common.release()
    assert made == [1, 2, 1]


def test_a_coder_holds_a_portion_as_numbers():
    from vigil.llm.bpe import Bpe, default_tokenizer
    with open(default_tokenizer(), encoding="utf-8") as f:
        coder = Bpe(f.read())
    texts = [" ".join(f"word{(i * 7919 + j) % 500}" for j in range(300)) for i in range(1500)]
    want = coder.encode(texts[:500])  # learns all words
    tracemalloc.start()
    got = coder.encode(texts)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[:500] == want and coder.decode(got[-1]) == texts[-1]
    assert held < 40 * sum(len(t.split()) for t in texts)
