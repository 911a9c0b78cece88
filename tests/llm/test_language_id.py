import re

from pyspark.sql import types as T

from quillgrid.llm.language_id import identify

FOLDER = "/root/testdata/sf0.1"
SCHEMA = T.StructType([T.StructField(n, T.LongType() if n == "page_id" else T.StringType()) for n in ("page_id", "url", "html", "lang", "host", "prior")])


def test_pages_of_known_language(spark, documents):
    """The path of an address names the language of its page; it is no input."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    truth = {r.page_id: m.group(1) for r in pages.collect() if (m := re.search(r"//[^/]+/(en|de|fr|es)/", r.url))}
    result = identify(pages, documents).collect()
    assert len(result) == pages.count()
    right = [r.language == truth[r.id] for r in result if r.id in truth]
    assert len(right) > 2000 and sum(right) / len(right) > 0.97, sum(right) / len(right)
    assert all(0 < r.probability <= 1 for r in result)


def test_host_and_markup_decide_without_text(spark, documents):
    texts = {r.lang: r.text for r in documents.where("length(text) > 2000").collect()}
    rows = [(i, f"http://www.seite.de/{i}", f'<html lang="de"><article><p>{texts["de"][:600]}</p></article>') for i in range(30)]
    rows += [(50 + i, f"http://site.com/{i}", f'<html lang="en"><article><p>{texts["en"][:600]}</p></article>') for i in range(30)]
    rows += [(100, "http://www.seite.de/x", "<p>1 2 3</p>"), (101, "http://site.com/x", "<p></p>"), (102, "http://new.org/", '<html lang="de"><p>7</p>')]
    pages = spark.createDataFrame([(i, u, h, "xx", "h", "p") for i, u, h in rows], SCHEMA)
    result = {r.id: r for r in identify(pages, documents).collect()}
    assert (result[100].language, result[101].language, result[102].language) == ("de", "en", "de")
    assert result[0].text_language == "de" and result[0].probability > 0.99


def test_one_wrong_declaration_does_not_win(spark, documents):
    texts = {r.lang: r.text for r in documents.where("length(text) > 2000").collect()}
    rows = [(i, f"http://a{i % 5}.com/{i}", f'<html lang="en"><article><p>{texts["en"][i:500 + i]}</p></article>') for i in range(40)]
    rows.append((99, "http://a0.com/99", f'<html lang="en"><article><p>{texts["fr"][:500]}</p></article>'))
    pages = spark.createDataFrame([(i, u, h, "xx", "h", "p") for i, u, h in rows], SCHEMA)
    assert {r.id: r.language for r in identify(pages, documents).collect()}[99] == "fr"


def test_odd_rows(spark, documents):
    rows = [(1, None, None), (None, "x", ""), (2, "http:///", "<p>"), (3, "http://localhost:80/a", "<html lang=x>"), (3, "http://localhost:80/a", "<html lang=x>")]
    pages = spark.createDataFrame([(i, u, h, None, "h", "p") for i, u, h in rows], SCHEMA)
    assert identify(pages, documents).count() == 5
    assert identify(pages.where("false"), documents).collect() == []
    unlabelled = identify(pages, documents.where("false")).collect()
    assert len(unlabelled) == 5 and all(r.language is None for r in unlabelled)
