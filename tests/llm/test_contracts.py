"""Inputs that tables of the driver don't have: scripts without training, wrappers with telling names, empty and unlabelled
tables through every registered query, clashing names, keys of other types."""

import pytest

from areapanel.llm import exact_dedup, fingerprints, html_content, language_id, pii, queries, toxicity
from pyspark.sql import functions as F

WORDS = "plain words of a paragraph that is long enough to be the content of its page"


@pytest.mark.parametrize("html", [
    f'<div class="layout has-sidebar"><article><p>{WORDS}</p></article></div>',
    f'<div class="page with-sidebar"><article><p>{WORDS}</p></article></div>',
    f'<div id="post-no-comments"><p>{WORDS}</p></div>', f'<div class="article-share-enabled"><p>{WORDS}</p></div>',
    f'<div class="banner-free"><p>{WORDS}</p></div>', f'<div class="sidebar page"><main><p>{WORDS}</p></main></div>',
    f'<section id="footer"><p>{WORDS}</p><div class="comments">nice one</div></section>',
    f'<article><p>{WORDS}</p></article><div class="comments"><article>so nice</article><article>is it</article></div>'])
def test_wrappers_keep_their_article(html):
    assert html_content.main_text(f"<html><body><nav>a b c</nav>{html}</body></html>", html_content.Weights()) == WORDS


def test_references_end_at_tags():
    assert html_content.main_text("<p>x &am<b>p</b>; y &amp; z</p>", html_content.Weights()) == "x &amp; y & z"


@pytest.fixture(scope="module")
def model(spark):
    base = {"en": "the quick brown fox jumps over the lazy dog near the river bank", "de": "der schnelle braune fuchs springt über"
            " den faulen hund am fluss", "fr": "le renard brun rapide saute par dessus le chien paresseux"}
    rows = [(i, " ".join(base[x].split()[(i + k) % 9] for k in range(9)) + f" {base[x]}", x) for i in range(60) for x in base]
    rows += [(i, "the same copy of all", "en") for i in range(500)] + [(1, None, "en"), (2, "x", None), (3, "½", "en")]
    return language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def test_no_letters_and_unknown_scripts(spark, model):
    rows = [(i, t) for i, t in enumerate(["½ ²", "③ ④", "Ⅷ", "12 !", "", None])]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id int, text string"), model).collect()
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in got)
    strange = ["これは日本語の文章です。とても長い文章を書きます。", "это русский текст о погоде и людях", "这是一个中文句子"]
    got = language_id.identify(spark.createDataFrame(enumerate(strange), "doc_id int, text string"), model).collect()
    assert all(r.rejected for r in got)
    known = language_id.identify(spark.createDataFrame([(1, "the quick brown fox jumps over the river"), (2, "der schnelle braune fuchs springt am fluss")],
                                                       "doc_id int, text string"), model).collect()
    assert [(r.lang_pred, r.rejected) for r in known] == [("en", False), ("de", False)]


def test_training_sample_is_bounded(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(language_id, "ROWS_PER_LANGUAGE", 30)
    monkeypatch.setattr(language_id, "_fit", lambda x, y, n: sizes.append(len(y)) or (language_id.np.zeros(
        (language_id.BUCKETS, n)), language_id.np.zeros(n)))
    rows = [(i, f"some words {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} {i}", "en") for i in range(400)]
    rows += [(1000 + i, "one copy", "en") for i in range(400)]
    language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert 10 < sizes[0] <= 30
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 20)
    monkeypatch.setattr(toxicity, "_fit", lambda x, e, y, s: sizes.append(len(y)) or toxicity.np.zeros(
        toxicity.BUCKETS + 1 + e.shape[1]))
    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 50, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    toxicity.train(docs, labels)
    assert max(sizes[1:]) == 20


def test_digits_only_have_no_category(spark):
    chain = toxicity.Chain(["toxic"], toxicity.np.zeros((1, toxicity.BUCKETS + 2)), [0.4])
    rows = [(1, "1" * 100), (2, "1" * 300), (3, "word"), (4, None)]
    got = toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id int, text string"), chain).collect()
    assert [(r.p_toxic, r.toxic) for r in got] == [(0.5, False), (0.5, False), (0.5, True), (0.5, False)]


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "mail a@b.example", "x", "y", [3])], "doc_id int, text string, _m string, _row string, _spans0 array<int>")
    assert tuple(pii.redact(df, "text").first()) == (1, "mail [EMAIL]", "x", "y", [3])
    got = pii.with_spans(df, "text", "_t").first()
    assert got._m == "x" and got._row == "y" and got._spans0 == [3] and len(got._t) == 1
    df = spark.createDataFrame([(1, "a", "x", "y"), (2, "a", "u", "v")], "doc_id int, text string, _sha256 string, `_Name` string")
    assert [tuple(r) for r in exact_dedup.keep_first(df).collect()] == [(1, "a", "x", "y")]


@pytest.mark.parametrize("prefix", ["", "doc-0000"])
def test_fingerprints_by_string_keys(spark, prefix):
    rows = [(f"{prefix}{i:03d}é{i}", f"words of text {i} and {i * 7}") for i in range(200)] + [(None, "no key")]
    got = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id string, text string").repartition(5)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode()))
    after = {a[0]: b for a, b in zip(order, order[1:] + order[:1])}
    import hashlib
    for r in got:
        text = dict(rows)[r.doc_id]
        assert r.edited_sha256 == hashlib.sha256(fingerprints.edited(text, after[r.doc_id][1]).encode()).hexdigest()
    assert len(got) == 201


TABLES = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "pages": "page_id long, url string, html string",
          "labels": "doc_id long, quality int, toxic int"}


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_queries_on_empty_tables(spark, empty_dir, name):
    assert queries.REGISTRY[name](spark, empty_dir).count() == 0


def test_pipeline_on_empty_tables(spark, empty_dir):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_unlabelled_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words", None, None, 10), (2, None, None, None, 0)], TABLES["documents"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], TABLES["labels"]).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.REGISTRY["op4_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == 2 and not any(r.toxic or r.low_quality for r in got)
    got = queries.REGISTRY["op7_language_id"](spark, str(tmp_path)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert queries.REGISTRY["op13_quality_rules"](spark, str(tmp_path)).count() == 2
