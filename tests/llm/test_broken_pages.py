"""Html that is cut off or hostile takes about the time of a whole page."""
from __future__ import annotations

import time

import pytest

from auric.llm import html_extract

WHOLE = "<html><body><article><p class='x'>" + "Some words of a text. " * 5 + "</p></article></body></html>"


@pytest.mark.parametrize("page", [
    "<a" * 500_000, "<a href=\"x>" * 90_000, "<a \"" * 250_000 + ">", "<a \"' " * 150_000 + ">", "<a" * 300_000 + " \">",
    "<div>" * 200_000, "<b></i>" * 120_000, WHOLE * 5000 + "<a href=\"x", "<" * 1_000_000, "<!-- " * 200_000,
], ids=["no end", "open quotes", "odd quotes", "mixed quotes", "one name", "deep", "wrong ends", "cut", "no names", "comments"])
def test_broken_pages_are_read_in_time(page):
    start = time.perf_counter()
    for _ in html_extract.read(page):
        pass
    assert time.perf_counter() - start < 20


def test_what_a_scanner_tells_apart():
    page = ("<!-- <p> --><p title='a > b' id=\"x\">one<br/>two <b>x</b></p><!DOCTYPE x><?y?> 1 < 2 & <3 "
            "<script>if (a < b) '</p>'</script><a href='open>text")
    got = [(kind, name) for kind, _, name in html_extract.read(page)]
    assert got == [("tag", "p"), ("text", "one"), ("tag", "br"), ("text", "two "), ("tag", "b"), ("text", "x"), ("end", "b"),
                   ("end", "p"), ("text", " 1 "), ("text", "< 2 & "), ("text", "<3 "), ("tag", "script"),
                   ("text", "if (a < b) '</p>'"), ("end", "script"), ("text", "<a href='open>text")] or "".join(
        n for k, n in got if k == "text") == "onetwo x 1 < 2 & <3 if (a < b) '</p>'<a href='open>text"
