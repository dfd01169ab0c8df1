import datetime as dt
import random
import re
import time
import unicodedata

from pyspark.sql import functions as F

from loomtext.functions import text as t
from loomtext.functions import urls as u


def one(spark, column, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first()["r"]


def test_normalized_folds_and_collapses(spark):
    assert one(spark, t.normalized, "Straße ﬁ \t X") == "strasse fi x"
    assert one(spark, t.normalized, None) is None


def test_word_count_matches_python_split(spark):
    for text in ("", "  ", "a b", "a b c\x1cd", "　x\n\ty "):
        assert one(spark, t.word_count, text) == len(text.split())


def test_lines_and_tail(spark):
    text = "a\r\nb\x0bc\n" + "\n".join(f"line {i}" for i in range(20)) + "\n"
    assert one(spark, t.lines_of, text) == text.splitlines()
    found = one(spark, t.tail_lines, text)
    assert found == [f"line {i}" for i in range(6, 20)]


def test_explicit_dates(spark):
    text = "2020-02-30, May 5th, 2019 and 1 Jan 2018; 2021-07-01. 31 June 2020"
    assert one(spark, t.explicit_dates, text) == [dt.date(2019, 5, 5), dt.date(2018, 1, 1), dt.date(2021, 7, 1)]
    assert one(spark, t.explicit_dates, None) == []


def test_language_samples(spark):
    assert one(spark, t.language_samples, "x" * 1800) == ["x" * 1800]
    text = "".join(chr(97 + i % 26) for i in range(4001))
    middle = len(text) // 2 - 900
    assert one(spark, t.language_samples, text) == [text[:1800], text[middle : middle + 1800], text[-1800:]]


def test_prose_metrics(spark):
    m = one(spark, t.prose_metrics, "one 2 three\n4 5 x\n\n\t\ttable")
    assert round(m["digit_token_fraction"], 6) == round(3 / 7, 6)
    assert round(m["numeric_line_fraction"], 6) == round(1 / 3, 6)
    assert round(m["tabular_line_fraction"], 6) == round(1 / 3, 6)


def test_restore_punctuation(spark):
    assert one(spark, t.restore_punctuation, "well @-@ known , 1 @,@ 000 ( a ) it 's") == "well-known, 1,000 (a) it's"


def test_named_person_and_byline(spark):
    assert one(spark, t.named_person, "Jane Q Doe") is True
    for name in ("News Team", "Jane", "jane doe", "Jane Doe 2", None):
        assert one(spark, t.named_person, name) is False
    got = one(spark, t.byline, "Opening. By nobody.\nBody\nReporting by Ann Lee; editing", "Reuters Staff")
    assert (got["author"], got["basis"][:8]) == ("Ann Lee", "Explicit")
    assert one(spark, t.byline, "By JANE DOE today", "Jane Doe")["author"] == "Jane Doe"


def test_slices_are_code_points(spark):
    df = spark.createDataFrame([("a😀bc", 1, 3), ("abc", 2, 9)], "s string, a int, b int")
    assert [r[0] for r in df.select(t.text_slice(F.col("s"), F.col("a"), F.col("b"))).collect()] == ["😀b", None]


def test_book_body(spark):
    text = "x\n*** START OF THE PROJECT GUTENBERG EBOOK A ***\nbody\n*** END OF THE PROJECT GUTENBERG EBOOK A ***\n"
    got = one(spark, t.book_body, text)
    assert text[got["start"] : got["end"]] == "body\n"
    assert one(spark, t.book_body, "no markers") is None


def test_wilson(spark):
    df = spark.createDataFrame([(0, 0), (5, 10)], "s long, n long").select(t.wilson(F.col("s"), F.col("n")).alias("w"))
    none, half = [r["w"] for r in df.collect()]
    assert none is None
    assert abs(half["low"] - 0.236593) < 1e-5 and abs(half["high"] - 0.763407) < 1e-5


def test_small_functions(spark):
    assert one(spark, t.strip_markers, "a <v>b</v>") == "a b"
    assert one(spark, t.last_suffix, "some_book_fr") == "fr"
    assert one(spark, lambda c: t.mapped_group(c, {r"les_mis_\d": "les_mis"}), "les_mis_2") == "les_mis"
    assert one(spark, t.quoted_title, "A b/c é") == "A_b/c_%C3%A9"
    assert one(spark, t.is_decimal_id, "12a") is False
    assert round(t.lsh_probability(0.8, 8, 16), 3) == 0.947


def test_urls(spark):
    assert one(spark, u.canonical_url, "HTTP://User@WWW.Example.com:80/a//?b=2&utm_x=1&a=%20+&fbclid=9&c#f") == "https://example.com/a?a=++&b=2&c="
    assert one(spark, u.canonical_url, "https://x.org") == "https://x.org/"
    assert one(spark, u.host, "ftp://x.org/") is None
    assert one(spark, lambda c: u.first_matching_host(u.host(c), ["b.org", "a.org"]), "https://n.a.org/x") == "a.org"
    assert one(spark, lambda c: u.first_matching_host(u.host(c), ["a.org"]), "https://aa.org/x") is None
    got = one(spark, u.dated_path, "https://a.org/2020/02/30/x")
    assert got["found"] and got["date"] is None


def test_prose_counts_equal_regular_expressions():
    """Random texts over all kinds of white space, line ends, digits and letters, counted token by token and line by line."""
    draw = random.Random(4)
    alphabet = "ab1é\u0663²₄-\t\t \n\r\x0b\x1c\x1f\x85\xa0\u2003\u2028\u3000\u0301\U0001d7d8\U0001f600\U00010400"
    texts = ["", "\n", "\t\tx", "x\t\ty", " \t \t5 6\r\n7"] + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(400)]
    digit = lambda w: any(unicodedata.category(c) == "Nd" or c in "²₄" for c in w)
    want = []
    for body in texts:
        tokens = re.findall(f"[^{t.SPACE}]+", body)
        lines = [(x, re.findall(f"[^{t.SPACE}]+", x)) for x in re.split(t.LINE_END, body)]
        lines = [(x, w) for x, w in lines if w]
        want.append([
            len(tokens), len(lines), sum(map(digit, tokens)), sum(sum(map(digit, w)) / len(w) >= 0.4 for _, w in lines),
            sum(bool(re.match(rf"[{t.SPACE}]*\t[{t.SPACE}]*\t", x)) for x, _ in lines), sum(any(unicodedata.category(c)[0] == "L" for c in w) for w in tokens),
        ])
    assert t._prose_counts(texts).tolist() == want


def test_prose_metrics_of_many_texts_are_quick():
    """Two million words, which regular expressions took minutes for; in one process."""
    begin = time.process_time()
    t._prose_counts(["word 12 other-word\tx 3.5 yz " * 400] * 800)
    assert time.process_time() - begin < 8
