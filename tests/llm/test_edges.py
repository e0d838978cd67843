"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import numpy as np
import pytest

LONG = " ".join(f"word{i % 5000}" for i in range(60000))
TEXT = "One line of some words that stands here alone.\nAnother line of other words follows the first one."
ROWS = [(1, TEXT, "en", "a"), (1, TEXT, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, "   \n\t ", "en", None), (None, TEXT, "de", "b"),
        (5, LONG, "en", "b"), (6, "é" * 3000 + " <|endoftext|>  x", "fr", "b"), (7, "hi", "en", "a")]
#: Extra columns whose names the operators use inside.
EXTRA = "node long, component long, key string, row long, batch long, size int, ids string, h int, part int"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *[f"cast(NULL AS {t}) AS {n}" for n, t in (c.split() for c in EXTRA.split(", "))])


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_bpe(docs):
    from vigil.llm.bpe import decode, digests, encode
    rows = by_id(digests(docs))
    assert [r[0] for r in rows] == [1, 1, 2, 3, 4, 5, 6, 7, None] and rows[2][1] == rows[3][1] == 0 and rows[2][2:] == rows[3][2:]
    back = {r[0]: r[1] for r in by_id(decode(encode(docs)))}
    assert back[5] == LONG and back[6] == ROWS[7][1] and back[2] == ""


def test_mixing(spark, docs):
    from vigil.llm.mixing import mix, mixed_documents
    rows = mix(docs).collect()
    assert len(rows) == len(ROWS) and {r.source for r in rows} == {None, "a", "b"}
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 3 * r.size for r in rows)
    assert mixed_documents(docs).columns == docs.columns


def test_quality(docs):
    from vigil.llm.quality import keep_good, quality
    rows = {r[0]: r for r in quality(docs).collect()}
    assert rows[2].n_words == 0 and rows[2].base_failed and rows[2].ratio is None and not rows[3].kept and rows[4].n_dup_lines == 0
    assert rows[5].n_words == 60000
    kept = keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality(docs).collect())


def test_join(docs):
    from vigil.llm.jaccard import join, one_of_each
    rows = by_id(join(docs))
    assert [r[0] for r in rows] == [1, 1, 2, 3, 4, 5, 6, 7, None]
    assert {r[0]: r[2] for r in rows} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, None: None} and rows[2][1] == 0 and rows[7][1] == 1
    left = one_of_each(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]


def test_lines(docs):
    from vigil.llm.lines import drop_lines, duplicates
    rows = duplicates(docs).collect()
    assert sum(r.kept for r in rows if r.doc_id in (1, None)) == 2 and all(r.kept_doc_id == 1 for r in rows if r.doc_id is None)
    left = drop_lines(docs)
    texts = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    assert left.columns == docs.columns and [i for i, _ in texts] == [1, 2, 3, 4, 5, 6, 7] and texts[0] == (1, TEXT)


def test_scoring(docs):
    from vigil.llm.scoring import score
    rows = by_id(score(docs))
    assert len(rows) == len(ROWS) and rows[2][2] == 1 and rows[5][2] == 60001 and all(np.isfinite(r[6]) for r in rows)


def test_licences_and_language(spark, docs):
    from vigil.llm.language import identify, train
    from vigil.llm.licences import scan
    more = docs.unionByName(docs.limit(1).selectExpr("cast(NULL AS long) AS doc_id", "'Released under the MIT License.' AS text", *docs.columns[2:]))
    found = scan(more).where("confirmed").collect()
    assert [(r.doc_id, r.family) for r in found] == [(None, "MIT")]
    records = docs.selectExpr("'d' AS key", "doc_id AS id", "text", "cast(NULL AS string) AS html", "cast(NULL AS string) AS url", "source AS host")
    rows = identify(records, *train(docs)).collect()
    assert len(rows) == len(ROWS) and all(r.lang in ("de", "en", "fr") for r in rows)


def test_pages(spark):
    from vigil.llm.extract import extract
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>unclosed <b>paragraph of the text"), (3, "u", "<!-- never ends <p>x"), (3, "u", "a < b & c &lt; d <a <a"), (4, "u", "<p>" + "x " * 100000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = [(r.page_id, r.text, r.n_chars) for r in extract(df).collect()]
    assert len(got) == 6 and (1, "", 0) in got and (2, "", 0) in got and all(n == len(t) for _, t, n in got)


def test_vectors(spark):
    from vigil.llm.hnsw import near_duplicates
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (9, [0.0, float("inf")])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS valid", "3 AS label")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(0, 0, None, False), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]], key=str)


def test_empty_tables(spark, docs):
    from vigil.llm import bpe, extract, hnsw, jaccard, language, licences, lines, mixing, quality, scoring
    none = docs.limit(0)
    for made in (bpe.digests(none), mixing.mix(none), mixing.mixed_documents(none), quality.quality(none), quality.keep_good(none), jaccard.join(none), jaccard.one_of_each(none),
                 lines.duplicates(none), lines.drop_lines(none), scoring.score(none), licences.scan(none),
                 extract.extract(spark.createDataFrame([], "page_id long, url string, html string")), hnsw.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
                 language.identify(none.selectExpr("'d' AS key", "doc_id AS id", "text", "text AS html", "text AS url", "source AS host"), *language.train(none))):
        assert made.count() == 0


def test_pipeline_keeps_columns_and_decides(spark, tmp_path):
    import corpus_pipeline as pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "line dedup", "n-gram join", "mixing", "encoding"]
    counts = []
    for name, step in pipeline.STAGES:
        out = step(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "encoding":
            assert docs.columns == before.columns
        counts.append(docs.count())
    assert counts[0] < 200 and counts[3] == counts[4]
    assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} == set(docs.columns)
    assert docs.where("n_tokens <> size(ids) OR n_tokens = 0").count() == 0
