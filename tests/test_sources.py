import gzip
import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from loomtext.operators import gates
from loomtext.sources import readers, sinks
from loomtext.streaming import ingest


def test_sgml_stories(spark, tmp_path):
    body = """<DOC id="AFP_ENG_20050102.0001" type="story">
<TEXT>
<P>
One &amp; two
</P>
<P>
Three
</P>
</TEXT>
</DOC>
<DOC id="AFP_ENG_20050102.0002" type="story">
<TEXT>
Bare body
</TEXT>
</DOC>
<DOC id="AFP_ENG_20050102.0003" type="advis">
<TEXT>
x
</TEXT>
</DOC>
"""
    with gzip.open(tmp_path / "a.gz", "wt") as f:
        f.write(body)
    kept, rejected = readers.stories(spark, str(tmp_path), "2010-12-31")
    assert sorted(r["text"] for r in kept.collect()) == ["Bare body", "One & two\n\nThree"]
    assert [(r["line"], r["reason"]) for r in rejected.collect()] == [(16, "non_story")]
    (tmp_path / "b.sgm").write_text('<DOC id="x" type="story">\n<TEXT>\n')
    with pytest.raises(Exception, match="open document"):
        readers.sgml_documents(spark, str(tmp_path / "b.sgm")).collect()


def test_debates_keep_the_first_of_repeated_ids(spark, tmp_path):
    row = {"id": "lords2005-03-02a", "source": "uk-hansard-lords-debates", "text": "T", "metadata": {"language": "en", "year": "2005"}}
    (tmp_path / "d.jsonl").write_text("\n".join(map(json.dumps, [row, row, {**row, "id": "none"}])) + "\n\n")
    kept, rejected = readers.debates(spark, str(tmp_path), 2010)
    assert [(r["input_line"], r["publication_date"]) for r in kept.collect()] == [(1, "2005-03-02")]
    assert sorted((r["line"], r["reason"]) for r in rejected.collect()) == [(2, "duplicate_document_id"), (3, "missing_document_date")]


def test_annotated_translations(spark, tmp_path):
    lines = ["system\tdoc\tseg_id\tsource\ttarget", "ref.A\td\t1\ts\tA <v>b</v>", "ref.A\td\t1\ts\tA b", "hyp.X\td\t1\ts\tone", "hyp.X\td\t1\ts\ttwo"]
    (tmp_path / "a.tsv").write_text("\n".join(lines) + "\n")
    kept, rejected = readers.annotated_translations(spark, str(tmp_path / "a.tsv"))
    assert [(r["id"], r["text"], r["annotation_rows"], r["authorship"]) for r in kept.collect()] == [("wmt21_zhen/d/1/ref.A", "A b", 2, "human_translation")]
    assert [r["reason"] for r in rejected.collect()] == ["conflicting_annotation_text"]


def test_aligned_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("src", "s1\ns2\n")
        z.writestr("meta", "news\td1\nnews\td2\n")
        z.writestr("refA", "t1\nt2\n")
    got = readers.aligned_translations(readers.zip_lines(spark, str(tmp_path / "z.zip")), "src", "meta", {"refA": "refA"}).collect()
    assert sorted((r["source_text"], r["text"], r["domain"], r["document_group"], r["workflow"]) for r in got) == [("s1", "t1", "news", "collaborative_zhen/d1", "OrigHumanRef"), ("s2", "t2", "news", "collaborative_zhen/d2", "OrigHumanRef")]


def test_idiom_sheets(spark):
    rows = spark.createDataFrame([("S", 2, "fuente", "a", "1", "b", None, "c", "0")], "sheet string, row int, Source string, DEEPL string, Result string, GT string, `Result 2` string, CHATGPT string, `Result 3` string")
    got = {r["engine"]: (r["text"], r["idiom_correct"]) for r in readers.idiom_sheets(rows).collect()}
    assert got == {"DeepL Classic/NMT": ("a", 1), "Google Translate": ("b", None), "GPT-4o": ("c", 0)}


def test_posts(spark, tmp_path):
    (tmp_path / "p.csv").write_text('screen_name;text;account.type;class_type\na;"x;\ny";human;human\nb;z;bot;others\nc;w;bot;gpt2\n')
    got = sorted((r["account"], r["text"], r["binary_target"]) for r in readers.account_posts(spark, str(tmp_path / "p.csv"), "train").collect())
    assert got == [("a", "x;\ny", 0), ("b", "z", None), ("c", "w", 1)]
    (tmp_path / "q.json").write_text('{"text":"h","label":0}\n{"text":"g","label":1}\n')
    got = readers.paired_posts(spark, str(tmp_path / "q.json"), "m", "test").collect()
    assert len({r["partition_unit"] for r in got}) == 1 and sorted(r["binary_target"] for r in got) == [0, 1]
    (tmp_path / "r.json").write_text('{"text":"h","label":1}\n{"text":"g","label":0}\n')
    with pytest.raises(ValueError, match="alternation"):
        readers.paired_posts(spark, str(tmp_path / "r.json"), "m", "test")


def test_conversations_and_hydration(spark):
    def post(i, reply=None, assistant=True, lang="en", media=False):
        return (str(i), reply, lang, media, "t", (assistant,))

    rows = [("1", [("10", [post(100, None, False), post(101, "100")])]), ("2", [("20", [post(101, "100"), post(102, "1", lang="fr")])]), ("3", [("30", [post(103, "9")])]), ("4", [("40", [post(103, "8")])])]
    index = readers.conversation_index(spark.createDataFrame(rows, readers.CONVERSATIONS))
    groups = {r["conversation_id"]: r["split_group"] for r in index["groups"].collect()}
    assert groups["1"] == groups["2"] != groups["3"] == groups["4"]
    assert {r["id"]: r["conflict"] for r in index["posts"].collect()}["103"] is True
    assert [r["id"] for r in index["candidates"].collect()] == ["101"]
    hydrated = spark.createDataFrame([("101", "Hello", None), ("100", "x", None), ("102", "x", None), ("103", "x", None), ("7", "x", None)], "id string, original_text string, lang string")
    kept, canonical, rejected = readers.hydrated_posts(hydrated, index)
    assert [r["id"] for r in kept.collect()] == ["grok:101"] == [r["id"] for r in canonical.collect()]
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {"100": "participant_authorship_unresolved", "102": "not_english_or_language_conflict", "103": "conflicting_release_metadata", "7": "id_not_in_pinned_release"}


def test_books(spark, tmp_path):
    data = {"work_1_fr": {"source_paras": ["s", "s2"], "gt_paras": ["machine text here", "short"], "translator_data": {"t1": {"translator_paras": ["human text here", "human text here"]}, "t2": {"translator_paras": [None, "x"]}}}}
    rows = [{"book": k, "source_paras": v["source_paras"], "gt_paras": v["gt_paras"], "translators": {n: x["translator_paras"] for n, x in v["translator_data"].items()}} for k, v in data.items()]
    (tmp_path / "books.jsonl").write_text("\n".join(map(json.dumps, rows)))
    got = readers.aligned_paragraphs(readers.read_books(spark, str(tmp_path / "books.jsonl")), 2, 10, {r"work_\d_fr": "work"}).collect()
    assert sorted((r["id"], r["engine"], r["work_group"], r["source_language"]) for r in got) == [("par3/work_1_fr/0/google_translate", "Google Translate", "work", "fr"), ("par3/work_1_fr/0/t1", "Par3 human t1", "work", "fr")]
    (tmp_path / "short.jsonl").write_text(json.dumps({**rows[0], "gt_paras": ["one"]}))
    with pytest.raises(Exception, match="not aligned"):
        readers.read_books(spark, str(tmp_path / "short.jsonl")).collect()


def test_stitched_articles(spark):
    lines = ["", " = First = \n", " \n", "body\n", " = = Part = = \n", "", " = Second = \n", " ", " = x = \n", "tail"]
    df = spark.createDataFrame(list(enumerate(lines)), "position int, text string")
    got = sorted((r["title"], r["begin"], r["end"]) for r in readers.stitch_articles(df).collect())
    assert got == [("First", 1, 6), ("Second", 6, 10)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1, "train"), ("a", None, "test")], "id string, n int, split string")
    sinks.write_jsonl(rows, str(tmp_path / "out"), ["split"])
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    with pytest.raises(Exception):
        sinks.write_jsonl(rows, str(tmp_path / "out"))
    assert sinks.content_identity(rows).first() == sinks.content_identity(rows.orderBy("id").repartition(3)).first()
    assert sinks.content_identity(rows).first() != sinks.content_identity(rows.unionByName(rows)).first()
    assert sinks.selection_identity(rows, ["id", "split"]) == sinks.selection_identity(rows.orderBy("n"), ["id", "split"])
    listed = [{"id": "a", "n": None, "split": "test"}, {"id": "b", "n": 1, "split": "train"}]
    for keys in (["id", "split"], ["n", "id"]):
        plain = json.dumps([{k: r[k] for k in keys} for r in listed], sort_keys=True, separators=(",", ":"))
        assert sinks.selection_identity(rows, keys) == hashlib.sha256(plain.encode()).hexdigest()
    many = spark.range(20_000).selectExpr("id", "id % 7 AS split").repartition(5)
    plain = "[" + ",".join(f'{{"id":{i},"split":{i % 7}}}' for i in range(20_000)) + "]"
    assert sinks.selection_identity(many, ["id", "split"]) == hashlib.sha256(plain.encode()).hexdigest()
    assert sinks.selection_identity(rows.limit(0), ["id"]) == hashlib.sha256(b"[]").hexdigest()
    made = sinks.manifest(spark, str(tmp_path / "manifest.json"), {"rows": rows.agg(F.count("*").alias("n"))}, name="x")
    assert json.loads((tmp_path / "manifest.json").read_text())["counts"]["rows"]["n"] == 2 == made["counts"]["rows"]["n"]

    def build(path):
        rows.write.parquet(path)

    sinks.publish(spark, str(tmp_path / "pub"), build, lambda p: None)
    assert spark.read.parquet(str(tmp_path / "pub")).count() == 2
    with pytest.raises(FileExistsError):
        sinks.publish(spark, str(tmp_path / "pub"), build)

    def broken(path):
        raise ValueError("does not verify")

    with pytest.raises(ValueError):
        sinks.publish(spark, str(tmp_path / "pub2"), build, broken)
    assert not (tmp_path / "pub2").exists()


def test_inventory_and_files(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("{}\n")
    (tmp_path / "y.txt").write_text("no")
    assert readers.files_for(spark, str(tmp_path)).count() == 1
    assert readers.file_inventory(spark, str(tmp_path)).count() == 2
    with pytest.raises(ValueError):
        readers.require_columns(spark.range(1), ["a"])


def test_stream_deduplicates(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"id": str(i), "text": "Same text" if i < 2 else f"text {i}", "publisher": "p", "at": f"2024-01-01T00:00:0{i}Z"} for i in range(4)]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = ingest.first_of_each_text(ingest.document_stream(spark, str(tmp_path / "in")))
    query = ingest.start(stream, str(tmp_path / "out"), str(tmp_path / "check"), gates.first_reason([("short", F.col("whitespace_words") < 1)]))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
