import pytest
from pyspark.sql import functions as F

from noticeboard.functions import ids, text

def t_():
    return F.col("t")


def test_strip_keeps_tab_newline_and_block_ends(values):
    got = values(["a\x00\x08\tb\n\r\x0b\x1fc﷐﷑﷮﷯￾￿d"], text.strip_nonchar(t_()))
    assert got == ["a\tb\n\rc﷐﷯d"]


def test_drop_replacement(values):
    assert values(["a�b"], text.drop_replacement(t_())) == ["ab"]


def test_substitution(values):
    assert values(["总部/a"], text.regex_sub(t_(), "s#/#,#g")) == ["总部,a"]
    assert values(["a/b"], text.regex_sub(t_(), r"s/([a-z])\/([a-z])/$2\/$1/g")) == ["b/a"]
    assert values(["room 12, floor 3"], text.regex_sub(t_(), r"s/(\w+) (\d+)/$2. $1/g")) == ["12. room, 3. floor"]


@pytest.mark.parametrize("spec", ["s/a/b/", "s/a/$1/g", "s/a/b", "s/a/b/gq", "", "s/(/x/g"])
def test_wrong_substitutions_fail_early(spark, spec):
    with pytest.raises(ValueError):
        text.substitution(spec)


def test_patterns_are_those_of_the_engine(values):
    assert values(["Größe-7"], text.regex_sub(t_(), r"s/\p{L}++/x/g")) == ["x-7"]


def test_match_nth(values):
    inputs = ["上海市-静安区", "德州市-乐陵市", "贵州-贵阳市", "none", None]
    assert values(inputs, text.match_nth(t_(), "/([^-]*)市/", 1, 1)) == ["上海", "德州", "贵阳", "", None]
    assert values(inputs[1:2], text.match_nth(t_(), "/([^-]*)市/", 0, 1)) == ["德州,乐陵"]
    assert values(inputs[1:2], text.match_nth(t_(), "/([^-]*)市/", -1, 1)) == ["乐陵"]
    assert values(inputs[1:2], text.match_nth(t_(), "/([^-]*)市/", 3, 1)) == [""]


def test_html_to_text(values):
    html = (
        "<style>p{}</style><!-- x --><h1>A &amp; B</h1><p>one<br>two &lt;3</p><ul><li>x</li><li>y</li></ul>"
        '<a class="k" href="https://e.org/?a=1&amp;b=2"><b>go</b></a> <a href="/rel">no</a>&#8364;&#65;<script>x()</script>'
    )
    assert values([html], text.html_to_text(t_())) == [
        "\nA & B\n\none\ntwo <3\n\n * x\n * ygo <https://e.org/?a=1&b=2> no <>€A"
    ]
    assert values([None], text.html_to_text(t_())) == [None]
    odd = ["&#128512;|&#x20AC;|&#xd83d;|&#0;|&#999999999;|&#xFFFFFFFF;|&#;|&amp;lt;|R&amp D|&copy 2"]
    assert values(odd, text.html_to_text(t_())) == ["😀|€|�|�|�|�|&#;|&lt;|R& D|© 2"]


def test_ids(values):
    import hashlib

    url = "https://e.org/j?x=1#top"
    expected = hashlib.md5(b"https://e.org/j?x=1").hexdigest()
    assert values([url], ids.posting_id(t_(), F.lit("t"), "regex_on_url", "s/#[a-z]+$//g")) == [expected]
    none = F.lit(None).cast("string")
    assert values([url], ids.posting_id(t_(), none, "url_plus_title")) == [hashlib.md5(url.encode()).hexdigest()]
    assert values(["https://e.org:80/x", "http://b.c?x", "x"], ids.host(t_())) == ["e.org:80", "b.c", ""]
