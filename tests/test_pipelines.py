import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import budget, gates, verify
from loomtext.plans import pipelines
from loomtext.sources import readers

NEWS = "id string, dataset string, text string, url string, domain string, source string, date string, created string, metadata struct<url:string, license:string>"


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join(draw.choices(["the", "of", "and", "to", "river", "mountain", "walked", "stone", "house", "garden", "window", "letter"], k=n)) + f" ending {seed}."


def news(i, text, url=None):
    url = url or f"https://p.org/story/{i}"
    return (f"d/{i}", "cc_news", text, url, "p.org", None, "2020-01-02", None, None)


def test_curate_and_clean(spark):
    base = prose(1, 120)
    near = base.replace("ending 1", "ending one")
    rows = [news(1, base), news(2, base.upper()), news(3, prose(2), "https://www.p.org/same?utm_source=x"), news(4, prose(3), "https://p.org/same"), news(5, near), news(6, "short"), news(7, "zzz " * 80)]
    policy = gates.NewsPolicy(minimum_words=40, publishers=("p.org",), english_confidence_minimum=0.2)
    made = pipelines.curate(spark.createDataFrame(rows, NEWS), policy, F.lit(False), 100)
    assert {r["id"]: r["reason"] for r in made["rejected"].collect()} == {"d/6": "document_too_short_in_words", "d/7": "english_language_check_requires_review"}
    assert sorted(r["id"] for r in made["documents"].collect()) == ["d/1", "d/3", "d/5"]
    assert sorted((r["id"], r["retained_id"]) for r in made["duplicates"].collect()) == [("d/2", "d/1"), ("d/4", "d/3")]
    scanned = spark.createDataFrame(rows, NEWS)
    verify.verify_curated(scanned, made["documents"], made["rejected"], made["duplicates"], made["spans"], 40, 100)
    cleaned = pipelines.clean(made["documents"], pipelines.QualityPolicy(minimum_words=40, maximum_span_words=100))
    assert [(r["removed_id"], r["retained_id"]) for r in cleaned["removed"].collect()] == [("d/5", "d/1")]
    assert sorted(r["id"] for r in cleaned["documents"].collect()) == ["d/1", "d/3"]
    verify.verify_near_duplicates(cleaned["ranked"], cleaned["documents"], cleaned["removed"])
    with pytest.raises(ValueError, match="certificate"):
        verify.verify_near_duplicates(cleaned["ranked"], cleaned["documents"], cleaned["removed"].limit(0))
    words = pipelines.assemble_words(cleaned["spans"], 100)
    verify.verify_selection(words["selected"], 100)


def test_select_tokens(spark):
    rows = [("a", 1, "x1", "one two three"), ("a", 2, "x2", "One  two three"), ("a", 3, "x3", "four five six seven"), ("a", 4, "x4", "eight"), ("b", 1, "x5", "nine ten eleven")]
    got = pipelines.select_tokens(spark.createDataFrame(rows, "source string, position long, id string, text string"), {"a": 9, "b": 3}, 2).collect()
    assert sorted((r["id"], r["token_count"]) for r in got) == [("x1", 4), ("x3", 5)]


def test_pilot_and_literary(spark):
    books = {f"w{i}_fr": {"source_paras": [f"source {i} {k}" for k in range(2)], "gt_paras": [f"machine words {i} {k}" for k in range(2)], "translator_data": {"t": {"translator_paras": [f"human words {i} {k}" for k in range(2)]}}} for i in range(5)}
    records = readers.aligned_paragraphs(spark.createDataFrame([(k, v["source_paras"], v["gt_paras"], {n: x["translator_paras"] for n, x in v["translator_data"].items()}) for k, v in books.items()], readers.BOOKS), 2, 20)
    made = pipelines.literary(records)
    assert {r["split"] for r in made["records"].collect()} == {"train", "validation", "test"} and made["binary"].count() == 20
    assert pipelines.pilot(records)["summary"].first()["records"] == 20


def test_posts(spark, tmp_path):
    (tmp_path / "p.csv").write_text("screen_name;text;account.type;class_type\n" + "".join(f"u{i};text {i};human;human\n" for i in range(8)) + "u1;text 0;human;human\nbot;text 2;bot;gpt2\nodd;what;bot;others\n")
    made = pipelines.posts(readers.account_posts(spark, str(tmp_path / "p.csv"), "train"))
    reasons = {r["text"]: r["exclusion_reason"] for r in made["quarantine"].collect()}
    assert reasons == {"text 2": "conflicting_labels_for_identical_normalized_text", "what": "unknown_bot_method"}
    assert made["binary"].count() == 7


def test_diverse(spark):
    rows = [(f"{g}{i}", g, f"p{i}", f"a{i}", f"d{g}{i}", 60, prose(f"{g}{i}" if i else "same", 60), f"g{g}{i}", "train" if g == "fiction" else "test") for g in ("fiction", "reference") for i in range(4)]
    df = spark.createDataFrame(rows, "id string, genre string, publisher string, author string, parent_document_id string, whitespace_words int, text string, split_group string, split string")
    made = pipelines.diverse(df, budget.BalancePolicy({"fiction": 0.5, "reference": 0.5}, author_share=1.0, document_share=1.0))
    assert 0 < made["selected"].count() <= 8 and made["summary"].count() > 0
    verify.verify_isolation(made["selected"], ["split_group"])


def test_strict_core(spark):
    text = "Lord A: asked what is so.\nBaroness B: It is so, and more words follow here to fill the passage."
    meta = ("en", "2005")
    row = ("s1", "p1", text, [0, len(text)], "g", "train", "hansard", "uk-hansard-lords-written-answers", "UK Parliament", "en", meta, "2005-03-02", "lordswrans2005-03-02a", None, None, gates.PARLIAMENT_LICENSE, None, "human_candidate", None, None)
    names = "id string, parent_document_id string, text string, character_range array<int>, split_group string, split string, dataset string, source string, publisher string, language string, metadata struct<language:string, year:string>, publication_date string, original_id string, last_known_update_date string, text_version_date string, license string, license_review_status string, authorship string, binary_target int, engine string"
    span = spark.createDataFrame([row], names)
    span = span.withColumns({"text_sha256": F.sha2("text", 256), "whitespace_words": F.lit(len(text.split()))})
    parent = span.withColumn("id", F.lit("p1"))
    policy = gates.CorePolicy(minimum_words=5)
    kept, excluded = pipelines.strict_core(span, parent, policy)
    assert kept.count() == 1 and excluded.count() == 0
    assert pipelines.strict_core(span, parent, gates.CorePolicy(minimum_words=500))[1].first()["reason"] == "outside_word_bounds"
    with pytest.raises(Exception, match="differs from parent"):
        pipelines.strict_core(span, parent.withColumn("split", F.lit("test")), policy)[0].collect()
    with pytest.raises(Exception, match="source policy disagree"):
        pipelines.strict_core(span, parent.withColumn("publisher", F.lit("x")), policy)[0].collect()
    for broken in (span.withColumn("text_sha256", F.lit("0")), span.withColumn("whitespace_words", F.lit(3))):
        with pytest.raises(Exception, match="integrity differs"):
            pipelines.strict_core(broken, parent, policy)[0].collect()
    with pytest.raises(Exception, match="missing parent"):
        pipelines.strict_core(span, parent.withColumn("id", F.lit("other")), policy)[0].collect()
