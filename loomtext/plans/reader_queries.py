"""Queries of readers and verifiers: releases written from the driver's tables in their own formats and read back, with their DuckDB SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import similarity, verify
from ..session import materialise, table
from ..sources import readers, sinks
from .gate_queries import _DAY, _day, _folder, _nth
from .queries import _N, _SHINGLES, ORACLES, _docs, _sets, query

#: Conversations whose turns of equal number are one post, in `conversation_array`.
_APART = 50


@query(f"""WITH f AS (SELECT conv_id, turn, coalesce(role, '') = 'assistant' AS assistant, ((conv_id % {_APART}) * 1000 + turn)::VARCHAR AS id FROM conversations),
  g AS (SELECT (conv_id % {_APART}) AS k, min(conv_id::VARCHAR) AS least FROM f GROUP BY 1)
  SELECT id, count(DISTINCT conv_id) AS n_conversations, count(DISTINCT assistant) > 1 AS conflict, CASE WHEN count(DISTINCT assistant) = 1 THEN any_value(assistant)::INT END AS is_assistant, sha256('grok-conversation:' || any_value(least)) AS split_group
  FROM f JOIN g ON g.k = f.conv_id % {_APART} GROUP BY id""")
def conversation_array(spark, sf):
    """Conversations as JSON arrays of one line each, a file for each task, read back by ranges and indexed; every fiftieth shares its posts."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    ident = lambda turn: (F.pmod("conv_id", F.lit(_APART)) * 1000 + turn).cast("string")
    before = F.when(F.col("turn") > 0, ident(F.col("turn") - 1))
    author = F.struct((F.coalesce("role", F.lit("")) == "assistant").alias("isAssistant"))
    tweet = F.struct(ident(F.col("turn")).alias("id"), before.alias("inReplyToId"), F.lit("en").alias("lang"), F.lit(False).alias("isMediaOnly"), F.lit("2024").alias("createdAt"), author.alias("author"), F.col("text").alias("text"))
    # a conversation is one element of the array, in this format
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", tweet.alias("tweet")))).alias("tweets"))
    thread = F.struct(F.concat(F.col("conv_id").cast("string"), F.lit("0")).alias("threadId"), F.transform("tweets", lambda x: x["tweet"]).alias("tweets"))
    body = F.to_json(F.struct(F.col("conv_id").cast("string").alias("conversationId"), F.array(thread).alias("threads")), {"ignoreNullFields": "false"})

    def arrays(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in found:
            values = batch.column("value").to_pylist()
            if values:
                yield pa.RecordBatch.from_arrays([pa.array([mark + values[0], *["," + v for v in values[1:]]])], ["value"])
                mark = ","
        if mark == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    path = _folder(spark, "array")
    grouped.select(body.alias("value")).mapInArrow(arrays, "value string").write.option("lineSep", " ").text(path)
    index = readers.conversation_index(readers.read_conversations(spark, path))
    members = index["memberships"].join(index["groups"], "conversation_id").groupBy(F.col("post_id").alias("id")).agg(F.count_distinct("conversation_id").alias("n_conversations"), F.min("split_group").alias("split_group"))
    return index["posts"].join(members, "id").select("id", "n_conversations", "conflict", F.when(~F.col("conflict"), F.col("is_assistant")).cast("int").alias("is_assistant"), "split_group")


_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
_LINES = f"replace(replace(regexp_replace(coalesce(text, ''), '{_CONTROL}', '', 'g'), chr(13) || chr(10), chr(10)), chr(13), chr(10))"


@query(f"""WITH f AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'advis' ELSE 'story' END AS type, CASE WHEN doc_id % 11 = 0 THEN 'x' WHEN doc_id % 13 = 0 THEN 'AFP_ENG_20051302.0001' ELSE 'AFP_ENG_' || strftime({_DAY}, '%Y%m%d') || '.' || doc_id END AS id,
    doc_id % 7 <> 0 AS body, regexp_replace({_LINES}, '^[{t.SPACE}]+|[{t.SPACE}]+$', '', 'g') AS text FROM documents),
  g AS (SELECT *, regexp_extract(id, '^[A-Z]+_ENG_([0-9]{{8}})\\.[0-9]+$', 1) AS d FROM f), h AS (SELECT *, TRY_CAST(substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) AS DATE) AS day FROM g),
  r AS (SELECT *, CASE WHEN type <> 'story' THEN 'non_story' WHEN d = '' THEN 'invalid_story_id' WHEN day IS NULL THEN 'invalid_story_date' WHEN day > DATE '2010-12-31' THEN 'publication_after_cutoff' WHEN NOT body THEN 'missing_story_text' WHEN text = '' THEN 'empty_story_text' END AS reason FROM h)
  SELECT CASE WHEN reason IS NULL THEN 'gigaword/' || id ELSE id END AS id, reason, CASE WHEN reason IS NULL THEN sha256(text) END AS text_sha256 FROM r""")
def story_release(spark, sf):
    """Documents written as SGML stories and read back in ranges: the gate and the records."""
    id = F.when(_nth(11), F.lit("x")).when(_nth(13), F.lit("AFP_ENG_20051302.0001")).otherwise(F.concat(F.lit("AFP_ENG_"), F.date_format(_day(), "yyyyMMdd"), F.lit("."), F.col("doc_id").cast("string")))
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), _CONTROL, "")
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        clean = F.replace(clean, F.lit(mark), F.lit(name))
    kind = F.when(_nth(5), "advis").otherwise("story")
    body = F.when(_nth(7), F.lit("")).otherwise(F.concat(F.lit("<TEXT>\n"), clean, F.lit("\n</TEXT>\n")))
    path = _folder(spark, "stories")
    _docs(spark, sf).select(F.concat(F.lit('<DOC id="'), id, F.lit('" type="'), kind, F.lit('">\n'), body, F.lit("</DOC>"))).write.text(path)
    made, rejected = readers.stories(spark, path, "2010-12-31")
    none = F.lit(None).cast("string")
    return made.select("id", none.alias("reason"), "text_sha256").unionByName(rejected.select("id", "reason", none.alias("text_sha256")))


def _workbook(sheets: dict[str, list[list[str | None]]]) -> bytes:
    """A small workbook of inline strings, to have something to read."""
    main, link = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out, names = io.BytesIO(), list(sheets)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for k, name in enumerate(names, 1):
            cell = lambda r, c, v: f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
            rows = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(values) if v is not None)}</row>' for r, values in enumerate(sheets[name], 1))
            book.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
        listed = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{''.join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))}</Relationships>")
    return out.getvalue()


_SCORES = {"DeepL Classic/NMT": ("'d' || doc_id", "doc_id % 2"), "Google Translate": ("'g' || text", "CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 - 1 END"), "GPT-4o": ("'c' || lang", "1")}


@query(f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, regexp_replace(left(coalesce(source, ''), 200), '{_CONTROL}', '', 'g') AS source, left(sha256(coalesce(text, '')), 9) AS text, doc_id // 100 AS book FROM documents WHERE doc_id IS NOT NULL),
  n AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY doc_id) AS place FROM d)
  {" UNION ALL ".join(f"SELECT 'mwe_es_en/B' || book || '/' || (place + 1) || '/{engine}' AS id, {text} AS text, source AS source_text, '{engine}' AS engine, ({score})::INT AS idiom_correct FROM n WHERE place <= 100" for engine, (text, score) in _SCORES.items())}""")
def idiom_workbook(spark, sf):
    """Hundreds of documents as workbooks with a sheet of observations and one of analyses, read back by their XML parts."""
    rows = _docs(spark, sf).where("doc_id IS NOT NULL").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.regexp_replace(F.left(F.coalesce("source", F.lit("")), F.lit(200)), _CONTROL, "").alias("source"), F.left(F.sha2(F.coalesce("text", F.lit("")), 256), F.lit(9)).alias("text"), F.floor(F.col("doc_id") / 100).alias("book"))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id")
        cells = [[r.source, f"d{r.doc_id}", str(r.doc_id % 2), f"g{r.text}", str(r.doc_id % 3 - 1) if r.doc_id % 3 else None, f"c{r.lang}", "1"] for r in frame.itertuples()]
        book = int(frame["book"].iloc[0])
        return pd.DataFrame({"path": [str(book)], "content": [_workbook({f"B{book}": [list(readers.IDIOM_HEADER), *cells], "Analysis": [["not", "observations"]]})]})

    books = rows.groupBy("book").applyInPandas(build, "path string, content binary")  # a hundred ids at most
    return readers.idiom_sheets(readers.workbook_rows(books, readers.IDIOM_HEADER, readers.IDIOM_ROWS, ("Analysis",))).select("id", "text", "source_text", "engine", "idiom_correct")


@query("""SELECT 'Doc ' || doc_id AS title, doc_id * 1000000 AS begin, doc_id * 1000000 + len(string_split(coalesce(text, ''), chr(10))) + 3 AS end,
  sha256(' = Doc ' || doc_id || ' = ' || replace(coalesce(text, ''), chr(10), '')) AS text_sha256 FROM documents""")
def article_stitching(spark, sf):
    """All documents as one stream of lines, each behind a title between blank lines, cut into ranges and stitched again."""
    lines = F.concat(F.array(F.concat(F.lit(" = Doc "), F.col("doc_id").cast("string"), F.lit(" = ")), F.lit("")), F.split(F.coalesce("text", F.lit("")), "\n", -1), F.array(F.lit("")))
    stream = _docs(spark, sf, "doc_id", "text").select("doc_id", F.posexplode(lines).alias("n", "line")).select((F.col("doc_id") * 1_000_000 + F.col("n")).alias("position"), F.col("line").alias("text"))
    return readers.stitch_articles(stream).select("title", "begin", "end", F.sha2("text", 256).alias("text_sha256"))


@query("""SELECT doc_id, doc_id // 1000 AS bucket, row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) AS input_row, row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) <= 700 AS among_first FROM documents""")
def row_numbers(spark, sf):
    """Rows by file and line: files of a thousand ids in order, so a row's line is its rank."""
    path = _folder(spark, "numbered")
    rows = _docs(spark, sf, "doc_id").withColumn("bucket", F.floor(F.col("doc_id") / 1000).cast("long"))
    sinks.write_jsonl(rows.withColumn("in_bucket", F.col("bucket")).repartition("bucket").sortWithinPartitions("bucket", "doc_id"), path, ["bucket"])
    read = readers.read_any(spark, path, "doc_id long, in_bucket long")
    first = readers.first_rows(read, 700).select("doc_id", F.lit(True).alias("_first"))
    return read.join(first, "doc_id", "left").select("doc_id", F.col("in_bucket").alias("bucket"), "input_row", F.coalesce("_first", F.lit(False)).alias("among_first"))


_KEPT = ORACLES["near_dup_keep"].rpartition("SELECT id AS removed_id")


@query(f"""{_KEPT[0].rstrip()}, gone AS (SELECT id AS removed_id, keeper AS retained_id FROM g WHERE keeper IS NOT NULL),
  t AS (SELECT removed_id, CASE WHEN removed_id % 3 = 1 THEN retained_id + 1 ELSE retained_id END AS retained_id FROM gone WHERE removed_id % 3 <> 0),
  u AS (SELECT t.*, o.removed_id IS NULL AND y.doc_id IS NOT NULL AS kept, coalesce(y.w > x.w OR (y.w = x.w AND y.doc_id < x.doc_id), false) AS before, least(x.w, y.w) / greatest(x.w, y.w) AS ratio FROM t LEFT JOIN t o ON o.removed_id = t.retained_id
    JOIN (SELECT doc_id, {_N} AS w FROM documents) x ON x.doc_id = t.removed_id LEFT JOIN (SELECT doc_id, {_N} AS w FROM documents) y ON y.doc_id = t.retained_id),
  v AS (SELECT u.removed_id, u.retained_id, (SELECT count(*) FROM s a JOIN s b ON a.s = b.s WHERE a.doc_id = u.removed_id AND b.doc_id = u.retained_id) AS c, (SELECT count(*) FROM s WHERE doc_id = u.removed_id) AS n, (SELECT count(*) FROM s WHERE doc_id = u.retained_id) AS m FROM u),
  z AS (SELECT CASE WHEN NOT kept THEN 'retained row is not kept' WHEN NOT before THEN 'retained row ranks behind' WHEN c < 0.92 * (n + m - c) OR ratio < 0.85 OR n + m = c THEN 'not a near copy' END AS violation, u.removed_id AS id, u.retained_id AS other_id FROM u JOIN v USING (removed_id))
  SELECT * FROM z WHERE violation IS NOT NULL UNION ALL SELECT 'kept rows are near copies', removed_id, retained_id FROM gone WHERE removed_id % 3 = 0
  UNION ALL SELECT 'not accounted for once', doc_id, NULL FROM documents WHERE doc_id % 101 = 0 AND doc_id NOT IN (SELECT removed_id FROM gone)""")
def near_dup_violations(spark, sf):
    """What the certificate of a near-duplicate release finds, after a third of the removals are undone, a third name another row, and some kept rows are listed twice."""
    rows = _docs(spark, sf, "doc_id", "text").select(F.col("doc_id").alias("id"), "text", F.struct((-t.word_count(F.coalesce("text", F.lit("")))).alias("w"), F.col("doc_id").alias("id")).alias("rank"))
    sets = materialise(_sets(spark, sf), "shingles")
    gone = materialise(similarity.keep_distinct(rows.select("id", "rank"), sets, similarity.similar_pairs(sets, 0.8))[1], "gone")
    third = F.pmod("removed_id", F.lit(3))
    removed = gone.where(third != 0).select("removed_id", F.when(third == 1, F.col("retained_id") + 1).otherwise(F.col("retained_id")).alias("retained_id"))
    kept = rows.select("id").join(removed.select(F.col("removed_id").alias("id")), "id", "left_anti")
    twice = rows.select("id").where(F.pmod("id", F.lit(101)) == 0).join(gone.select(F.col("removed_id").alias("id")), "id", "left_anti")
    return verify.near_duplicate_violations(rows, kept, removed, twice, sets=sets)
