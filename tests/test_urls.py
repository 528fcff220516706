"""URL normal forms with fixed expectations, and properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from crawlweave.functions import urls as U

CASES = {
    "HTTP://User:Pw@EXAMPLE.com:80": "http://User:Pw@example.com/",
    "https://example.com:443/a": "https://example.com/a",
    "https://example.com:/a": "https://example.com/a",
    "http://example.com:443/a": "http://example.com:443/a",
    "http://h/a/./b/../c": "http://h/a/c",
    "http://h/../../x": "http://h/x",
    "http://h/a/..": "http://h/",
    "http://h/a/b/.": "http://h/a/b/",
    "http://h/a/...": "http://h/a/...",
    "http://h/%7Euser/%41%2f%c3%a9": "http://h/~user/A%2F%C3%A9",
    "http://h/%2e%2E/x": "http://h/x",
    "http://h/100%": "http://h/100%25",
    "http://h/%zz%1": "http://h/%25zz%251",
    "http://h/a b\"é中\U0001f600": "http://h/a%20b%22%C3%A9%E4%B8%AD%F0%9F%98%80",
    "http://h?q=a b&r=%c3%A9#frag": "http://h/?q=a%20b&r=%C3%A9",
    "http://h/p?a/../b": "http://h/p?a/../b",
    "http://Bücher.Example/": "http://xn--bcher-kva.example/",
    "http://例え。テスト/": "http://xn--r8jz45g.xn--zckzah/",
    "http://Bücher.example": "http://xn--bcher-kva.example/",
    "  http://h/a\tb\n ": "http://h/ab",
    "http://[::1]:80/x": "http://[::1]/x",
    "http://h/?": "http://h/?",
    "mailto:A@B": "mailto:A@B", "": "", "no url": "no url", "http:///path": "http:///path",
}


def forms(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    return [r.n for r in df.select("i", U.normal_form("u").alias("n")).orderBy("i").collect()]


def test_fixed_cases(spark):
    got = dict(zip(CASES, forms(spark, list(CASES)), strict=True))
    assert got == CASES
    assert forms(spark, [None]) == [None]


def test_forms_are_their_own_forms(spark):
    once = forms(spark, list(CASES))
    assert forms(spark, once) == once


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aéüßzñ中国テ", min_size=1, max_size=12))
def test_bootstring_round_trip(label):
    out = U.ascii_label(label)
    assert out.isascii()
    if out.startswith("xn--"):
        import unicodedata
        assert out[4:].encode().decode("punycode") == unicodedata.normalize("NFKC", label).lower()
