import duckdb
from pyspark.sql import functions as F

import __spark_entry__
from loomtext.operators import gates

ROW = "id string, source string, text string, metadata struct<language:string, year:string>"


def test_debate_rules_in_order(spark):
    good = ("lords-2005-03-02a", "uk-hansard-lords-debates", "Text", ("en", "2005"))
    rows = [good, good[:3] + (("fr", "2005"),), ("x", "other", "t", ("en", "2005")), ("nodate",) + good[1:], ("d2005-02-30",) + good[1:], good[:3] + (("en", "2006"),), ("d2015-01-01", good[1], "t", ("en", "2015")), good[:2] + (" ", ("en", "2005"))]
    got = [r[0] for r in spark.createDataFrame(rows, ROW).select(gates.debate_reason(2010)).collect()]
    assert got == [None, "language_not_explicitly_english", "source_requires_translation_provenance_review", "missing_document_date", "invalid_date_or_year", "date_year_disagreement", "publication_after_cutoff", "empty_text"]


def test_news_gate(spark):
    schema = "text string, url string, domain string, source string, date string, created string, metadata struct<url:string, license:string>"
    body = "word " * 12
    by = ("https://creativecommons.org/licenses/by/4.0/")
    rows = [
        (body, None, None, "s", None, "May 5, 2020", ("https://a.org/x", by)),
        ("short", None, None, "s", None, "May 5, 2020", ("https://a.org/x", by)),
        (body, None, None, "s", None, "May 5, 2020", ("https://b.org/x", by)),
        (body, None, None, "s", None, "May 5, 2020", ("https://a.org/x", "none")),
        (body, None, None, "s", None, "May 5, 2020 updated May 4, 2020", ("https://a.org/x", by)),
        (body, None, None, "s", None, "May 5, 2020 updated: March 4, 2023", ("https://a.org/x", by)),
        (body, None, None, "s", None, "May 5, 2020", ("https://a.org/2020/05/06/x", by)),
        (body + "This article was machine translated", None, None, "s", None, "May 5, 2020", ("https://a.org/x", by)),
        (body, None, None, "s", None, "May 5, 2020", ("https://a.org/", by)),
    ]
    policy = gates.NewsPolicy(minimum_words=10, source_hosts={"s": "a.org"}, dated_url_sources=("s",))
    got = [r["reason"] for r in gates.news_gate(spark.createDataFrame(rows, schema), policy, F.lit(True)).collect()]
    assert got == [None, "document_too_short_in_words", "source_host_mismatch_or_unreviewed_source", "unexpected_or_missing_declared_license", "update_precedes_publication", "explicit_update_after_cutoff", "publication_date_url_conflict", "explicit_machine_translation_notice_requires_review", "homepage_not_article"]
    other = [(body, "https://p.org/x", "www.p.org", None, "2020-01-01", None, None), (body, "https://p.org/x", "q.org", None, "2020-01-01", None, None), (body, "https://z.org/x", "z.org", None, "2020-01-01", None, None), (body, "https://p.org/x", "p.org", None, "bad", None, None)]
    policy = gates.NewsPolicy(minimum_words=10, publishers=("p.org",))
    got = [r["reason"] for r in gates.news_gate(spark.createDataFrame(other, schema), policy, F.lit(False)).collect()]
    assert got == [None, "domain_url_mismatch", "publisher_requires_review", "missing_or_invalid_publication_date"]


def test_story_and_component(spark):
    rows = [("AFP_ENG_20050102.0001", "story", True, "t"), ("AFP_ENG_20050102.0001", "other", True, "t"), ("x", "story", True, "t"), ("AFP_ENG_20059902.0001", "story", True, "t"), ("AFP_ENG_20250102.0001", "story", True, "t"), ("AFP_ENG_20050102.0001", "story", False, ""), ("AFP_ENG_20050102.0001", "story", True, " ")]
    got = [r[0] for r in spark.createDataFrame(rows, "id string, type string, has_body boolean, text string").select(gates.story_reason("2010-12-31")).collect()]
    assert got == [None, "non_story", "invalid_story_id", "invalid_story_date", "publication_after_cutoff", "missing_story_text", "empty_story_text"]
    rows = [("t", ("FreeLaw",)), ("t", ("Books3",)), (" ", ("ArXiv",)), ("t", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "text string, meta struct<pile_set_name:string>").select(gates.component_reason("2020-01-01", "2021-01-01")).collect()]
    assert got == [None, "pile_component_not_allowlisted", "empty_text", "pile_component_not_allowlisted"]


def test_question_and_answer(spark):
    yes = "Lord A: asked what?\nBaroness B: It is so."
    no = "Lord A: It is.\nBaroness B: asked why?"
    df = spark.createDataFrame([(yes,), (no,), ("nothing",)], "text string")
    assert [r[0] for r in df.select(gates.asked_and_answered(F.col("text"))).collect()] == [True, False, False]
    assert df.select(gates.participants(F.col("text"))).first()[0] == ["Baroness B", "Lord A"]


def test_admit_keeps_both_sides(spark):
    kept, rejected = gates.admit(spark.range(5), gates.first_reason([("small", F.col("id") < 2)]))
    assert kept.count() == 3 and [r["reason"] for r in rejected.collect()] == ["small"] * 2


def _with_documents(tmp_path, spark, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    return str(tmp_path), con


def test_recurring_days_and_natural_bylines_equal_the_sql(spark, tmp_path):
    """Days come again in large tables, and documents have bylines of their own."""
    texts = ["some words here", "By Anna Maria Blake\nsaid so", "x Reporting by Jane Doe; y", "one. Writing by Jane Doe", "By one Two Three", "z\nBy Big Ben | more"]
    sf, con = _with_documents(tmp_path, spark, [(i, f"{texts[i % 6]} {i}", "en", "s") for i in range(1, 30_000, 7)])
    for name in ("debate_release", "diverse_news_gate"):
        got, want = __spark_entry__.queries()[name](spark, sf).toArrow(), con.execute(__spark_entry__.oracle_sql()[name]).to_arrow_table()
        key = lambda rows: sorted((tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows))
        assert key(got.to_pylist()) == key(want.to_pylist()) and got.num_rows > 300
