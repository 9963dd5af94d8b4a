"""Scalar functions against plain Python written for the test, and golden examples."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quern.functions import people as P
from quern.functions import text as T


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], f"k int, x {kind}").select("k", expression(F.col("x")).alias("y"))
    return [r.y for r in df.orderBy("k").collect()]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("Juan Valdez, Ben Kinsley, and Joe Hammer", ["Juan Valdez", "Ben Kinsley", "Joe Hammer"]),
        ("Ash Bennington and Raoul Pal", ["Ash Bennington", "Raoul Pal"]),
        ("A & B", ["A", "B"]),
        ("[A, B]", ["A", "B"]),
        ("", [""]),
        (None, []),
        ("Tom Day, Jr., Ann Lee", ["Tom Day Jr.", "Ann Lee"]),
        ("Ann Lee, Tom Day, Jr.", ["Ann Lee", "Tom Day Jr.", ""]),
    ],
)
def test_split_people(spark, text, names):
    assert values(spark, [text], P.split_people) == [names]


def test_name_tokens(spark):
    got = values(spark, [["Lyn Gates Jones"], ["Ash Bennington", "Ed Harrison"], [], [" "]], P.name_tokens, "array<string>")
    assert [set(x) for x in got] == [{"lyn", "jones", "lyn gates", "lyn gates jones"}, {"ash", "bennington", "ash bennington", "ed", "harrison", "ed harrison"}, set(), set()]


def test_strip_prefix(spark):
    rows = ["Dr. Who", "professor X", "Lordson", "Brig. General (Ret) Y", " Mayor Z ", "Ann", None]
    assert values(spark, rows, P.strip_prefix) == ["Who", "X", "son", "Y", "Z", "Ann", None]


def test_clean_term(spark):
    rows = ["down town", "1999", "2101", "12.5", "a", "www.x.com", "x's", "good idea", "it's 're", "1_000", "nan", "plain"]
    want = ["dtown", "1999", "", "", "", "", "x", "idea", "it's", "", "", "plain"]
    assert values(spark, rows, T.clean_term) == want


def test_number_and_year(spark):
    rows = ["1", "+1.5e3", "1_000", "1d", "", " 7 ", "inf", "NaN", ".5", "5.", "1__0", "1700", "2100", "2101", "1700.0", "17_99"]

    def number(x):
        try:
            float(x)
            return True
        except ValueError:
            return False

    def year(x):
        try:
            return "." not in x and 1700 <= int(x) <= 2100
        except ValueError:
            return False

    assert values(spark, rows, T.is_number) == [number(x) for x in rows]
    assert values(spark, rows, T.might_be_year) == [year(x) for x in rows]


def test_snippets(spark):
    def plain(text, phrase, margin):
        text, out, at = text.lower(), [], 0
        while (k := text.find(phrase, at)) >= 0:
            out.append(text[max(at, k - margin) : k] + phrase + text[k + len(phrase) : k + len(phrase) + margin])
            at = k + len(phrase)
        return out

    rows = ["The cat, the hat. THE", "", "none", "thethe the", "x" * 24 + "the" + "y" * 30]
    assert values(spark, rows, lambda c: T.snippets(c, "the", 5)) == [plain(x, "the", 5) for x in rows]
    assert values(spark, ["a.c abc"], lambda c: T.snippets(c, "a.c", 5)) == [["a.c abc"]]


def test_small_ones(spark):
    assert values(spark, ["http://a/b/c", "c", "a/"], T.url_tail) == ["c", "c", ""]
    assert values(spark, [0, 86_400_000], T.day_of_ms, "long") == ["1970-01-01", "1970-01-02"]
    text = "héllo wörld"
    assert values(spark, [text], T.sorted_char_hash) == [hashlib.sha256("".join(sorted(text)).encode()).hexdigest()]
    assert values(spark, [" a \n\t b "], T.normal_space) == ["a b"]
    assert values(spark, ["short", "long " * 10], lambda c: T.fit_or_short(c, F.lit("p"), 20)) == ["short", "p"]


def test_word_stream(spark):
    words = [(20616, "I"), (19980, "MATT ROWE:"), (20732, " am "), (20800, " "), (20906, "Matt")]
    df = spark.createDataFrame([(words,)], "w array<struct<offset int, word string>>")
    assert df.select(T.word_stream(F.col("w"))).first()[0] == "MATT ROWE: I am Matt"
