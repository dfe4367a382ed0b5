"""Layouts and names that the training pages do not have."""

import time

import pytest

from riskloom.llm import pages

SENTENCES = [
    "The river had been rising since Monday, and by evening the lower fields were under water.",
    "Farmers moved their cattle to the hill while volunteers filled sandbags along the old mill road.",
    "Nobody could remember a flood this early in the year, although the records mention one in 1954.",
    "The mayor asked residents to stay calm; she promised that the bridge would be checked by engineers.",
    "Later that night, the rain eased and the first families returned to see what was left of their homes.",
]
PARAGRAPHS = [" ".join(SENTENCES[(k + j) % 5] for j in range(2 + k % 3)) + f" Report {k}." for k in range(10)]
TITLE = "Water reaches the old mill"
INNER = f"<h1>{TITLE}</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
WANT = "\n\n".join([TITLE, *PARAGRAPHS])
NAV = '<nav><ul>' + "".join(f'<li><a href="/{w}">{w.title()}</a></li>' for w in ("home", "news", "sport", "contact")) + "</ul></nav>"
FOOTER = '<footer><p>&copy; 2024 The Valley Courier. All rights reserved.</p></footer>'
CONTAINERS = {
    "story": "<div class='story-body'>{}</div>", "main-content": "<div id='main-content'>{}</div>",
    "unknown": "<div class='x17'>{}</div>", "main": "<div id='main'>{}</div>", "section": "<section>{}</section>",
    "grid": "<div class='container'><div class='row'>{}</div></div>", "none": "{}",
    "table": "<table width='100%'><tr><td>{}</td></tr></table>",
    "deep": "<div id='qq7'><div class='zorp'><div><div class='w-full px-4'>{}</div></div></div></div>",
}


@pytest.fixture(scope="module")
def model():
    return pages.trained()


@pytest.mark.parametrize("name", CONTAINERS)
def test_articles_in_containers_of_any_name(model, name):
    page = f"<html><head><title>x</title></head><body>{NAV}{CONTAINERS[name].format(INNER)}{FOOTER}</body></html>"
    assert next(pages.texts(model, [page])) == WANT


@pytest.mark.parametrize("name", ["unknown", "section", "grid"])
def test_comments_and_sidebars_beside_unknown_containers(model, name):
    more = (f"<aside class='sidebar'><h3>Related</h3><ul>" + "".join(f"<li><a href='/{k}'>Another story {k}</a></li>" for k in range(5))
            + "</ul></aside><div class='comments'>" + "".join(f"<div class='comment'><p>{s}</p></div>" for s in SENTENCES) + "</div>")
    page = f"<html><body>{NAV}{CONTAINERS[name].format(INNER)}{more}{FOOTER}</body></html>"
    assert next(pages.texts(model, [page])) == WANT


def test_time_of_deep_nesting_is_near_its_depth():
    start = time.process_time()
    tree = pages.Tree("<div>" * 100_000 + "text")
    assert time.process_time() - start < 5 and len(tree.parent) > 100_000
