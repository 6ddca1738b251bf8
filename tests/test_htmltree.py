"""The tree's quick reading of plain tags, and extraction of the parts that are asked for."""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from docketry.config import Settings
from docketry.operators import htmltree
from docketry.operators.extract import extract_block

ROWS = "<tr><td>a</td><td><b>1</b><td>x</tr>" * 1000


def test_plain_tags_do_not_take_the_general_way(monkeypatch):
    general = []
    for name in ("parse_starttag", "parse_endtag"):
        plain = getattr(HTMLParser, name)
        monkeypatch.setattr(HTMLParser, name, lambda self, i, plain=plain: (general.append(i), plain(self, i))[1])
    nodes = htmltree.parse(f"<p>Title of it</p><table border=1>{ROWS}</table><style>p</style>")
    assert sum(n.tag == "td" for n in nodes) == 3000
    assert len(general) == 3  # border=1, <style>, </style>


class General(htmltree._Builder):
    parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos


PIECES = ("<p>", "</p>", "<TD>", "</td>", "<td colspan=2>", "<tr>", "</tr>", "<table>", "</table>", "<b>", "</b >", "<br>", "<br/>", "<script>", "</script>", "<title>", "</Title>", "<style>", "</style>", "<!-- > -->", "<!--", "-->", "<", ">", "</>", "< p>", "<x-y>", '<a b ="u>v">', "&amp", "&quot;", " ", "text", "\n")


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_plain_tags_give_the_same_tree(html):
    shape = lambda nodes: [(n.tag, n.attrs, n.text, n.order, n.at, n.parent.order, n.last()) for n in nodes]
    general = General()
    general.feed(html)
    general.close()
    assert shape(htmltree.parse(html)) == shape(general.nodes)


def test_only_the_parts_asked_for_are_extracted():
    html = f"<h1>Head</h1><p>Body</p><table>{ROWS}</table>\n----  ----\na  b\nc  d\n\n\nEnd."
    whole = extract_block(html, "UNKNOWN", Settings())
    assert whole["html_tables"] and whole["text_tables"] and whole["sections"]
    for part in ("html_tables", "text_tables", "sections"):
        assert extract_block(html, "UNKNOWN", Settings(), (part,)) == {**{k: [] for k in whole}, part: whole[part], "error": None}
