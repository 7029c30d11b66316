import os.path
import random
from urllib.parse import urlparse

from pyspark.sql import functions as F

from lodestone.functions import urls as U
from lodestone.functions.text import category_slug, normalise_unicode, quoted, words


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


FIXED = [
    "//x", "http:///p", "mailto:a@b", "http://[::1", "  http://a.b", "http://a b", "http://a", "HTTP://A", "1http://a",
    "ht tp://a", "http:/a", "http//a", "", "http://", "http://?q", "http://#f", "a:b://c", "x+y-z.1://h", "http://u:p@h:99x/",
    "\thttp://a", "ht\ntp://a", "http:/\r/a", "\x00\x1fhttp://a", "http://[::1]", "http://[1.2.3.4]", "http://[v1.a]", "http://[vz.a]",
    "http://[fe80::1%eth0]:80/x", "http://[fe80::1%]", "http://[1:2:3:4:5:6:7:8]", "http://[1:2:3:4:5:6:7::]", "http://[1:2:3:4:5:6:7:8:9]",
    "http://[::1.2.3.4]", "http://[::1.2.3.400]", "http://[::01.2.3.4]", "http://a]b[c", "http://]", "http://x[::1]y", "http://[:::1]",
    "http://[1::2::3]", "http://[12345::]", "http://[::ffff:1.2.3.4]", "http://[1:2:3:4:5:6:1.2.3.4]", "http://[1:2:3:4:5:6:7:1.2.3.4]",
    "http://ex\u2100mple", "http://b\u00fccher.de", "http://a\uff0fb", "http://\u2488com", "http://a/\u2100", "http://a?\u2100", "é://a",
    "http://a\u2047b", "http://[::]", "http://[::1]]", "http://@", "http://:80", "http://a\nb", "javascript:alert(1)", "http://\u3000",
    "http://[1:2:3:4:5:6:7]", "http://[]", "ftp://x;y", "http://a[b]c", "http://[v1F.x:y]",
]


def test_validity_matches_urlparse(spark):
    random.seed(7)
    parts = ["http", "https", "ftp", ":", "/", "//", "://", "a", "b.c", "[", "]", "::", "1", "%", "@", "?", "#", " ", "\t", "\n", "é", "\u2100", "1.2.3.4", "ffff", "v1.", "+"]
    made = ["".join(random.choice(parts) for _ in range(random.randint(1, 9))) for _ in range(3000)]
    bracketed = ["http://[" + "".join(random.choice(["1", "ab", ":", "::", ".", "12.0.0.1", "g", "%e"]) for _ in range(random.randint(1, 10))) + "]/" for _ in range(3000)]
    values = FIXED + made + bracketed
    expected = []
    for v in values:
        try:
            expected.append(all(urlparse(v)[:2]))
        except ValueError:
            expected.append(False)
    got = column(spark, values, U.is_valid_url)
    assert [(v, g) for v, g, e in zip(values, got, expected) if g != e] == []
    assert any(expected[len(FIXED) + 3000 :]) and not all(expected)


def test_null_url_is_invalid(spark):
    assert column(spark, [None, "http://a"], U.is_valid_url) == [False, True]


def test_safe_names(spark):
    values = ["https://a.b/c?d=1&e:2", "http://", "", "x" * 150, "é" * 150, "hthttps://tp://a", "http://http://a/b", "a\U0001F600" * 80]
    assert column(spark, values, U.safe_url_name) == [
        "a_b_c_d_1_e_2", "content", "content", "x" * 100, "é" * 100, "a", "a_b", "a\U0001F600" * 50,
    ]


def test_without_extension(spark):
    values = ["a/b.json", "a.b.json", "a.d/b", ".json", "a/.json", "a/..json", "a/.x.json", "b.", "a/b.c.d/e.f"]
    assert column(spark, values, U.without_extension) == [os.path.splitext(v)[0] for v in values]


def test_content_path_is_relative_to_the_root(spark):
    rows = spark.createDataFrame([("/in/x/a.json", "http://h/a/b"), ("/in/x/a.json", "http://h/a_b")], "f string, u string")
    got = rows.select(U.content_path(F.col("f"), F.col("u"), "/in").alias("p")).collect()
    assert [r.p for r in got] == ["x/a/h_a_b.md", "x/a/h_a_b.md"]


def test_host_parts(spark):
    values = ["http://u:p@A.b.example.com:80/x.HTML?y=1", "https://h/x.tar.gz#f", "http://h/a.b/c", "http://h.com"]
    assert column(spark, values, U.host) == ["a.b.example.com", "h", "h", "h.com"]
    assert column(spark, values, U.path_extension) == ["html", "gz", "", ""]
    assert column(spark, ["a.b.c"], U.host_suffixes) == [["a.b.c", "b.c", "c"]]


def test_category_slugs(spark):
    expected = {
        "Pipes & Drains (old - and new)": "pipes__drains_old___and_new.json",
        "-x": "_x.json",
        "": ".json",
        " lead": "_lead.json",
        "trail ! ": "trail.json",
        "Ünï-Cødé 9²": "ünï_cødé_9².json",
        "a\tb": "ab.json",
        "日本 語": "日本_語.json",
        "a&b": "ab.json",
        "ß İ": "ß_i\u0307.json",
    }
    assert column(spark, list(expected), category_slug) == list(expected.values())


def test_quoted_is_python_literal(spark):
    values = ["plain", "it's", 'say "x"', "it's \"x\"", "back\\slash", "new\nline", "é", "\x07", "\u200b", ""]
    assert column(spark, values, quoted) == [repr(v) for v in values]


def test_unicode_and_words(spark):
    assert column(spark, ["e\u0301", "é", "abc", None], normalise_unicode) == ["é", "é", "abc", None]
    assert column(spark, ["Ab c-d, É1 ab"], words) == [["ab", "c", "d", "é1", "ab"]]
