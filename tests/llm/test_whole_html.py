"""Articles that begin or end with the tags that menus are made of, with learned weights."""

import pytest

from areapanel.llm import html_content

MENU = "<ul>" + "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(12)) + "</ul>"
WORDS = "plain words of a paragraph that is long enough to be the content of its page "
ENDS = [(f"<p>{WORDS}</p><ul><li>first</li><li>second</li><li>third</li></ul>", WORDS + "first second third"),
        (f"<p>{WORDS}see <a href='/x'>this page</a> for more.</p>", WORDS + "see this page for more."),
        (f"<ul><li><a href='/y'>one</a></li><li>two</li></ul><p>{WORDS}</p>", "one two " + WORDS.strip())]


def page(body, tag):
    return (f"<html><body><header>Site name</header><nav>{MENU}</nav><div class='links'>{MENU}</div><{tag}>{body}</{tag}>"
            f"<footer>{MENU}imprint</footer></body></html>")


@pytest.fixture(scope="module")
def weights(spark):
    rows = [(page(f"<h1>Head {i}</h1><p>{WORDS * (1 + i % 3)}</p>", "article"),) for i in range(60)]
    return html_content.learn_weights(spark.createDataFrame(rows, "html string"))


@pytest.mark.parametrize(("body", "text"), ENDS)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_lists_and_links_at_the_ends(weights, body, text, tag):
    assert html_content.main_text(page(body, tag), weights) == text
