"""The model of pages against enumeration, its reading of names, and its parser on unclosed tags."""

import itertools
import math
import random
import re
import time

import pytest

from dwellmart.llm import pages

STORY = "".join(f"<p>Paragraph {i} tells a long story about the town and the river that runs through it.</p>" for i in range(4))
COUNTS = {
    ("article", 1, 0): 50, ("nav", 0, 0): 50, ("div", 0, 0): 30, ("div", 1, 0): 20, ("body", 0, 0): 50,
    ("text-short-linked", 0, 0): 80, ("text-medium-plain", 1, 0): 90, ("text-medium-plain", 0, 0): 20, ("p", 1, 0): 90,
    ("|element", 0, 0): 90, ("|element", 0, 1): 9, ("|element", 1, 1): 90, ("|text", 0, 0): 90, ("|text", 1, 1): 90,
}


def texts(source):
    page = pages.Page(source)
    return [t for t, p in zip(page.texts, pages.Model(COUNTS).content(page), strict=True) if t and p >= 0.5]


def test_marginals_are_those_of_enumeration():
    model = pages.Model(COUNTS)
    page = pages.Page("<body><nav><a href=x>Home</a></nav><div class='has-ad'>a b c</div><p>some longer words stand here</p></body>")
    n, total, yes = len(page.symbols), 0.0, [0.0] * len(page.symbols)
    for states in itertools.product((0, 1), repeat=n):
        if states[0]:
            continue
        weight = sum(model.symbol.get(page.symbols[i], (0.0, 0.0))[states[i]] for i in range(1, n))
        for i in range(1, n):
            edge = model.edge["|text" if page.texts[i] is not None else "|element"]
            weight += edge[2 * states[page.parents[i]] + states[i]]
        weight = math.exp(weight)
        total += weight
        for i in range(n):
            yes[i] += weight * states[i]
    assert model.content(page)[1:] == pytest.approx([x / total for x in yes[1:]], abs=1e-12)


@pytest.mark.parametrize("page", [
    '<body><div class="content has-sidebar">%s</div></body>', '<body><article class="tags-food post">%s</article></body>',
    '<body><div id="banner-story">%s</div></body>', '<body><article><div class="share">%s</div></article></body>',
    '<body><article><div class="entry-header"><p>The headline</p></div>%s</article></body>',
])
def test_a_word_in_a_name_does_not_drop_an_article(page):
    found = texts(page % STORY)
    assert [t for t in found if t.startswith("Paragraph")] == [t for t in re.findall("<p>(.*?)</p>", STORY)]
    assert ("The headline" in found) == ("headline" in page)


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "cookie-notice", "comment-list", "ad-slot", "big menu"])
def test_elements_named_as_a_whole_are_left_out(name):
    assert texts(f'<body><article>{STORY}<div class="{name}">{STORY.replace("Paragraph", "Other")}</div></article></body>') == [
        t for t in re.findall("<p>(.*?)</p>", STORY)
    ]


def test_ends_of_tags():
    plain = re.compile(r"((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>")
    draw = random.Random(5)
    for _ in range(3000):
        source = "".join(draw.choice("<a \"'>") for _ in range(draw.randrange(1, 30)))
        tags = pages._Tags(source)
        for at in sorted(draw.sample(range(len(source) + 1), min(len(source), 6))):
            found = plain.match(source, at)
            assert tags.end(at) == (found.end() if found else -1)


@pytest.mark.parametrize("part", ['<a href="x ', "<a href='x ", "<a ", "<a<", "<a href=\"x '"])
def test_unclosed_tags_take_linear_time(part):
    begun = time.process_time()
    pages.Page(part * 20_000 + ">")
    assert time.process_time() - begun < 2
