"""Records that aren't lines, read in ranges, against plain parsers; ranges are few bytes, so they cut everywhere."""

import gzip
import io
import json
import random
import zipfile

import pytest

from loomtext.sources import ranges, readers


@pytest.fixture(params=[None, "150"], ids=["whole", "150 bytes"])
def split(request, spark):
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": request.param, "spark.sql.files.minPartitionNum": "1"}
    for key, value in keys.items():
        if request.param:
            spark.conf.set(key, value)
    yield request.param
    for key in keys:
        spark.conf.unset(key)


def elements(draw):
    text = lambda: "".join(draw.choices(['"', "\\", "{", "}", "[", "]", ",", ":", " ", "\n", "a", "é", "😀", "}, {"], k=draw.randint(0, 12)))
    value = lambda depth: draw.choice([text, lambda: draw.randint(-9, 9), lambda: None, lambda: [value(depth + 1) for _ in range(draw.randint(0, 3))], lambda: {text(): value(depth + 1) for _ in range(draw.randint(0, 2))}])() if depth < 3 else text()
    return [{text(): value(0) for _ in range(draw.randint(0, 4))} for _ in range(draw.randint(0, 12))]


def test_arrays_are_cut_into_their_elements(spark, tmp_path, split):
    draw = random.Random(4)
    want = []
    for i in range(3):
        own = elements(draw)
        want += own
        (tmp_path / f"{i}.json").write_text(draw.choice(["", " \n"]) + json.dumps(own, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 1]), separators=draw.choice([(",", ":"), (" , ", ": ")])) + draw.choice(["", "\n", "  "]), "utf-8")
    (tmp_path / "empty.json").write_text("[]")
    got = [json.loads(r["body"]) for r in ranges.json_array(spark, str(tmp_path)).collect()]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want)) and want


@pytest.mark.parametrize("body", ['[{"a": 1}, {"b": 2', '[{"a": 1}, 7]', '[[1], {"a": 2}]', '["a"]'])
def test_broken_arrays_fail(spark, tmp_path, body):
    (tmp_path / "x.json").write_text(body)
    with pytest.raises(Exception, match="array"):
        ranges.json_array(spark, str(tmp_path)).collect()


def test_conversations_of_an_array(spark, tmp_path, split):
    rows = [{"conversationId": str(i), "threads": [{"threadId": f"{i}0", "tweets": [{"id": str(100 + i), "inReplyToId": None, "lang": "en", "isMediaOnly": False, "createdAt": "t", "author": {"isAssistant": True}, "other": "}]"}]}]} for i in range(20)]
    (tmp_path / "all.json").write_text(json.dumps(rows))
    got = readers.read_conversations(spark, str(tmp_path)).collect()
    assert sorted(r["conversationId"] for r in got) == sorted(str(i) for i in range(20)) and all(r["threads"][0]["tweets"][0]["author"]["isAssistant"] for r in got)


def document(draw, i):
    body = "".join(draw.choices(["<P>\nOne &amp; two\n</P>\n", "<P>\nline\nline\n</P>\n"], k=draw.randint(1, 4)))
    return f'<DOC id="D{i}" type="story">\n<TEXT>\n{body}</TEXT>\n</DOC>\n'


def test_documents_in_ranges(spark, tmp_path, split):
    draw = random.Random(5)
    want = {}
    for name in ("a.sgm", "b.sgm", "c.gz"):
        text, line = draw.choice(["", "noise\n\n"]), 0
        for i in range(12):
            line = text.count("\n") + 1
            want[f"D{name}{i}"] = line
            text += document(draw, f"{name}{i}") + draw.choice(["", "\n", "between\n"])
        (gzip.open(tmp_path / name, "wt") if name.endswith("gz") else open(tmp_path / name, "w")).write(text)
    got = readers.sgml_documents(spark, str(tmp_path)).collect()
    assert {r["id"]: r["line"] for r in got} == want and len(got) == len(want)
    assert {p for r in got for p in r["text"].split("\n\n")} == {"One & two", "line\nline"}


@pytest.mark.parametrize("body", ['<DOC id="1">\n<TEXT>\nx\n', '<DOC id="1">\n<TEXT>\n<DOC id="2">\n</DOC>\n'], ids=["open", "nested"])
def test_open_and_nested_documents_fail(spark, tmp_path, split, body):
    (tmp_path / "x.sgm").write_text(document(random.Random(1), 0) + body)
    with pytest.raises(Exception, match="(open|nested) document"):
        readers.sgml_documents(spark, str(tmp_path)).collect()


def plain_articles(lines):
    out, blank = [], lambda i: i < 0 or i >= len(lines) or not lines[i].split()
    for i, line in enumerate(lines):
        found = ranges._TITLE.match(line)
        if found and blank(i - 1) and blank(i + 1):
            out.append([found[1].strip(), i, i, ""])
        if out:
            out[-1][2:] = [i + 1, out[-1][3] + line]
    return sorted(map(tuple, out))


@pytest.mark.parametrize("partitions", ["1", "4", "17"])
def test_articles_in_ranges(spark, partitions):
    draw = random.Random(int(partitions))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        streams = {}
        for part in (None, "a", "b"):
            lines = [" = T0 = \n", ""] + draw.choices(["", " \n", " = Title = \n", " = = Part = = \n", "body\n", " = x\n"], k=draw.randint(0, 80))
            streams[part] = lines
        rows = [(p, i, x) for p, lines in streams.items() for i, x in enumerate(lines)]
        draw.shuffle(rows)
        got = ranges.stitched_articles(spark.createDataFrame(rows, "part string, position int, text string"), part=["part"]).collect()
        for p, lines in streams.items():
            assert sorted((r["title"], r["begin"], r["end"], r["text"]) for r in got if r["part"] == p) == plain_articles(lines)
        with pytest.raises(ValueError, match="before the first"):
            ranges.stitched_articles(spark.createDataFrame([(i, "body") for i in range(9)], "position int, text string"))
        assert ranges.stitched_articles(spark.createDataFrame([], "position int, text string")).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def workbook(sheets, shared=True):
    """A small workbook: {name: rows of values}; None leaves the cell out."""
    main, strings, parts = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", [], {}
    quote = lambda x: x.replace("&", "&amp;").replace("<", "&lt;")
    for k, rows in enumerate(sheets.values(), 1):
        body = ""
        for r, values in enumerate(rows, 1):
            cells = ""
            for c, v in enumerate(values):
                ref = f"{chr(65 + c)}{r}"
                if isinstance(v, str) and shared:
                    strings.append(v)
                    cells += f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'
                elif isinstance(v, str):
                    cells += f'<c r="{ref}" t="inlineStr"><is><t>{quote(v)}</t></is></c>'
                elif v is not None:
                    cells += f'<c r="{ref}"><v>{v}</v></c>'
            body += f'<row r="{r}">{cells}</row>'
        parts[f"xl/worksheets/sheet{k}.xml"] = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts["xl/workbook.xml"] = f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets></workbook>"
    parts["xl/_rels/workbook.xml.rels"] = '<Relationships xmlns="x">' + "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>"
    if shared:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{main}">' + "".join(f"<si><r><t>{quote(s[:1])}</t></r><r><t>{quote(s[1:])}</t></r></si>" for s in strings) + "</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


@pytest.mark.parametrize("shared", [True, False])
def test_workbooks(spark, tmp_path, shared):
    header = list(readers.IDIOM_HEADER)
    rows = [header, *[["fuente & <x>", f"d{i}", 1, f"g{i}", None, f"c{i}", 0] for i in range(100)], [None] * 7, ["Total", None, 50]]
    (tmp_path / "m.xlsx").write_bytes(workbook({"One": rows, "Analysis": [["x"]], "Two": rows[:3]}, shared))
    got = readers.read_idioms(spark, str(tmp_path)).select("id", "text", "source_text", "engine", "idiom_correct").collect()
    assert len(got) == 3 * (100 + 2) and {r["source_text"] for r in got} == {"fuente & <x>"}
    assert {(r["engine"], r["idiom_correct"]) for r in got} == {("DeepL Classic/NMT", 1), ("Google Translate", None), ("GPT-4o", 0)}
    assert {r["text"] for r in got if r["id"] == "mwe_es_en/Two/3/GPT-4o"} == {"c1"}
    (tmp_path / "bad.xlsx").write_bytes(workbook({"One": [["Source", "x"]]}, shared))
    with pytest.raises(Exception, match="unexpected columns"):
        readers.read_idioms(spark, str(tmp_path)).collect()
