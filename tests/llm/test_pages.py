"""Main text of pages: against a plain version of the tag-path ratios, and on pages whose layout speaks of boilerplate."""

import random
import re
from html.parser import HTMLParser

import pytest

from feedloom.llm import tagpaths

PARTS = ["A first long paragraph of the text, with commas, and more words in it.", "A second paragraph, as long as the first, that says more, and ends."]
BODY = "".join(f"<p>{p}</p>" for p in PARTS)
REPLY = "<article class=\"comment\"><p>Great, great, great text, thank you all so much for this, really.</p></article>"


@pytest.mark.parametrize("page", [
    f'<div class="site no-sidebar"><article>{BODY}</article></div>',
    f'<main class="content with-sidebar">{BODY}</main>',
    f'<article class="post comment-open">{BODY}</article>',
    f'<article class="legal document">{BODY}</article>',
    f'<main><article class="post comment-open">{BODY}</article></main>',
    f'<div class="site no-sidebar"><article class="post comment-open">{BODY}</article></div>',
    f'<form><nav>Home News</nav><div>{BODY}</div><label>Name</label><input><select><option>x</select></form>',
    f'<div id="text">{BODY}</div><section class="comments">{REPLY}</section>',
    f'<article>{BODY}<section class="comments">{REPLY}{REPLY}</section></article>',
    f'<div class="page has-sidebar"><div id="c">{BODY}</div><div class="sidebar"><p>Related, things, and other things, here.</p></div></div>',
    f'<header class="site-header"><p>Title of the site, here.</p></header><div class="wrapper legal">{BODY}</div><footer>All rights, reserved.</footer>',
])
def test_layout_names_do_not_hide_the_article(page):
    assert tagpaths.content(page) == "\n\n".join(PARTS)


def test_formulas_stand_in_their_sentence():
    page = "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be, so that it holds, in all cases.</p>"
    assert tagpaths.content(page) == "Let x=2 be, so that it holds, in all cases."


# ------------------------------------------------- the method, written plainly


class Element:
    def __init__(self, tag, said, up):
        self.tag, self.said, self.up, self.parts = tag, said, up, []

    def above(self):
        """This element and those around it, from the inside out."""
        return [self, *(self.up.above() if self.up else [])]


class Parser(HTMLParser):
    def __init__(self):
        super().__init__()
        self.here = self.top = Element("", "", None)
        self.nodes = []

    def handle_starttag(self, tag, attrs):
        child = Element(tag, " ".join(v for _, v in attrs).lower(), self.here)
        self.here.parts.append(child)
        self.here = child

    def handle_endtag(self, tag):
        self.here = self.here.up

    def handle_data(self, data):
        if data.strip():
            self.here.parts.append(data)
            self.nodes.append((" ".join(data.split()), self.here))


def plain_content(page):
    """The same rules over a tree of well-formed elements without inline ones, loop by loop."""
    parser = Parser()
    parser.feed(page)
    nodes = parser.nodes
    content = lambda e: e.tag in ("article", "main")
    speaks = lambda e: bool(e.said and tagpaths._BOILERPLATE.search(e.said)) or e.tag == "form"
    rich = lambda e: any(content(x) for x in e.above())
    tagged = lambda e: e.tag in tagpaths.BOILERPLATE_TAGS and not (e.tag == "header" and e.up and rich(e.up))

    def article(e):
        return content(e) and not (speaks(e) and any(content(x) or named(x) or tagged(x) for x in e.up.above()))

    def named(e):
        return speaks(e) and not article(e)

    def holds(e):
        return any(article(y) and y is not e and e in y.above() for _, x in nodes for y in x.above())

    anywhere = holds(parser.top)
    total = sum(len(t) for t, _ in nodes)

    def most(e):
        return not anywhere and 2 * sum(len(t) for t, x in nodes if e in x.above()) >= total

    out = lambda e: any(tagged(x) and not holds(x) for x in e.above() if x.up)
    poor = lambda e: out(e) or any(named(x) and not holds(x) and not most(x) for x in e.above() if x.up)
    path = lambda e: tuple((x.tag, x.said) for x in e.above())
    ratio = {}
    for text, e in nodes:
        ratio.setdefault(path(e), []).append((len(text), len(re.findall(r"[.,;:!?\u2026\u3002\uff0c\uff01\uff1f\uff1b\uff1a]", text))))
    fused = []
    for i, (_, e) in enumerate(nodes):
        near = [nodes[min(max(j, 0), len(nodes) - 1)][1] for j in (i - 1, i, i + 1)]
        length, marks = (sum(sum(x[k] for x in ratio[path(n)]) / len(ratio[path(n)]) for n in near) / 3 for k in (0, 1))
        fused.append(length * (1 + marks) * (0.01 if poor(e) else 1) * (4 if rich(e) else 1))
    chosen = [f >= 0.3 * sum(fused) / len(fused) and not out(e) for f, (_, e) in zip(fused, nodes, strict=True)]
    if not any(chosen):
        return ""
    trails = [e.above()[::-1] for (_, e), c in zip(nodes, chosen, strict=True) if c]
    root = [x for x in trails[0] if all(x in t for t in trails)][-1]
    if rich(root):
        root = [x for x in root.above() if rich(x)][-1]
    return "\n\n".join(t for (t, e), c in zip(nodes, chosen, strict=True) if c or rich(root) and not poor(e) and root in e.above())


def grown(rng, depth=0):
    tag = rng.choice(["div", "div", "section", "p", "p", "ul", "nav", "aside", "article", "main", "header", "form", "footer"])
    if depth > 3 or tag == "p":
        words = [rng.choice(["word", "text,", "long;", "of", "ends."]) for _ in range(rng.choice([1, 4, 30]))]
        return f"<h2>{' '.join(words)}</h2>"
    name = rng.choice(["", "", "", "content", "post comment-open", "sidebar", "comments", "no-sidebar", "related"])
    inner = "".join(grown(rng, depth + 1) for _ in range(rng.randrange(1, 4)))
    return f"<{tag}{f' class=\"{name}\"' if name else ''}>{inner}</{tag}>"


def test_content_equals_the_plain_ratios():
    rng = random.Random(4)
    some = 0
    for _ in range(400):
        page = "".join(grown(rng) for _ in range(rng.randrange(1, 4)))
        want = plain_content(page)
        assert tagpaths.content(page) == want, page
        some += bool(want)
    assert some > 250
