"""HTML rendering against an independent layout of generated trees, misnested tags, style rules, and bounds at any depth."""

import random
import time

import pytest

from gustloom.llm import html_render
from gustloom.llm.html_render import render

SPACED = {"p", "h2", "blockquote", "pre"}


def tree(rnd, depth, inside_list=False, phrasing=False):
    """Children: words, ("br",), or (name, attributes, children)."""
    out = []
    for _ in range(rnd.randrange(1, 5)):
        kind = rnd.random()
        if kind < 0.45 or depth == 0:
            out.append(rnd.choice(["", " "]) + " ".join(rnd.choice(["one", "two", "a&b", "<x>", "ü", "long-word"]) for _ in range(rnd.randrange(1, 4))) + rnd.choice(["", " ", "\n"]))
        elif kind < 0.65 or phrasing:
            attributes = rnd.choice(["", "", "class=q", "hidden", "style='display:none'", "class=off", "style='visibility: hidden'"])
            out.append((rnd.choice(["b", "span", "font", "em", "label"]), attributes, tree(rnd, depth - 1, phrasing=True)))
        elif kind < 0.8:
            out.append((rnd.choice(["ul", "ol"]), "", [("li", "", tree(rnd, depth - 1, True)) for _ in range(rnd.randrange(1, 4))]))
        else:
            name = rnd.choice(["div", "p", "h2", "blockquote", "section", "pre"])
            attributes = rnd.choice(["", "", "hidden", "id=gone", "class='x off'"]) if name != "pre" else ""
            out.append((name, attributes, ["a\n  b\n\nc"] if name == "pre" else tree(rnd, depth - 1, phrasing=name in ("p", "h2"))))
    return out


def serial(nodes, rnd, parent=""):
    """HTML of a tree; end tags that may be left out are left out now and then."""
    out = ""
    for k, node in enumerate(nodes):
        if isinstance(node, str):
            out += node.replace("&", "&amp;").replace("<", "&lt;")
            continue
        name, attributes, children = node
        out += f"<{name}{' ' + attributes if attributes else ''}>" + serial(children, rnd, name)
        follows = nodes[k + 1] if k + 1 < len(nodes) else None
        optional = name == "li" or name == "p" and (follows is None and parent in ("", "div", "li", "section", "blockquote") or isinstance(follows, tuple) and follows[0] in ("p", "div", "ul", "ol", "h2", "section", "blockquote", "pre"))
        if not (optional and rnd.random() < 0.5):
            out += f"</{name}>"
    return out


def boxes(nodes, lists=0, seen=True):
    """[gap before, lines, gap after] of each box. Inline runs become boxes of their own."""
    out, run = [], []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append([0, [text], 0])
        run.clear()

    def inline(children):
        for c in children:
            if isinstance(c, str):
                run.append(c)
            elif not ("hidden" in c[1] or "none" in c[1] or "off" in c[1]):
                inline(c[2])

    for node in nodes:
        if isinstance(node, str):
            run.append(node)
            continue
        name, attributes, children = node
        if "hidden" in attributes or "none" in attributes or "off" in attributes or "gone" in attributes:
            continue
        if name in ("b", "span", "font", "em", "label"):
            inline(children)
            continue
        flush()
        if name == "pre":
            out.append([1, children[0].split("\n"), 1])
        elif name in ("ul", "ol"):
            gap = 0 if lists else 1
            out.append([gap, [], 0])
            for i, (_, _, inner) in enumerate(children, 1):
                mark = f"{i}. " if name == "ol" else "- "
                held = boxes(inner, lists + 1)
                lines = stacked(held)
                out.append([0, [(mark + lines[0].lstrip(" ")).rstrip()] + [(" " * len(mark) + x).rstrip() if x else "" for x in lines[1:]] if lines else [mark.rstrip()], trailing(held) if lines else 0])
            out.append([gap, [], gap])
        else:
            gap = int(name in SPACED)
            held = boxes(children, lists)
            lines = stacked(held)
            indent = "  " if name == "blockquote" else ""
            lead = max([gap, *(b[0] for b in held[:1]), *(max(b[0], b[2]) for b in leading(held))])
            out.append([lead, [(indent + x).rstrip() if x else "" for x in lines], max(gap, trailing(held))])
    flush()
    return out


def leading(held):
    for b in held:
        yield [b[0], [], b[0]]
        if b[1]:
            return
        yield b


def trailing(held):
    gap = 0
    for b in reversed(held):
        gap = max(gap, b[2])
        if b[1]:
            return gap
        gap = max(gap, b[0])
    return gap


def stacked(held):
    """Boxes above each other; gaps that meet collapse into the largest."""
    lines, gap = [], 0
    for before, inner, after in held:
        gap = max(gap, before)
        if inner:
            lines += [""] * (gap if lines else 0) + inner
            gap = 0
        gap = max(gap, after)
    return lines


@pytest.mark.parametrize("seed", range(400))
def test_lines_against_an_independent_layout(seed):
    rnd = random.Random(seed)
    nodes = tree(rnd, 4)
    page = "<style>.off, #gone { display: none } @media print { .q {display:none} }</style>" + serial(nodes, rnd)
    assert render(page).split("\n") == (stacked(boxes(nodes)) or [""]), page


def test_inline_end_tags_leave_blocks_open():
    cases = {
        "<font><p>He</font>llo</p>": "Hello", "<b><p>x</b>y<p>z": "xy\n\nz", "<a href=x><div>one</a> two</div>three": "one two\nthree",
        "<span style='display:none'><div>x</span>y</div>z": "",  # a block stops the span's end tag: all of it is in the span
        "<b style='display:none'><p>x</b>y</p>z": "y\n\nz", "<i hidden>a<b>b</i>c</b>d": "cd", "a<b hidden><p>x</p></b>c": "ac",
        "<div><b hidden>x</div>y</b>z": "z", "<table><tr><td><b hidden>x<td>y</table>": "   y".strip(), "<b>x<b>y</b>z</b>w": "xyzw",
        "<b style='visibility:hidden'>a<i style='visibility:visible'>b</b>c</i>d": "bcd", "<p><b hidden>a</p><p>b</b>c": "c", "</b>x</i>": "x",
        "<a hidden>x<a>y</a>z": "yz", "<svg><a>in</a><text>t</text></svg>": "in t",
    }
    assert {k: render(k) for k in cases} == cases


def test_style_rules():
    sheet = "<style>/* .a{display:none} */ .h,p.k,#i,em{display:none} .v{visibility:hidden} div.h{display:block} b{display:block} @media print{.x{display:none}} @media screen{.y{display:none}} @font-face{src:none} u{display:none!important} .blk{display:block} .pre{white-space:pre}</style>"
    cases = {
        "<p class=h>a<p>b": "b", "<div class=h>a</div>b": "a\nb", "<p class=k>a<i class=k>b</i><p>c": "c", "<i class=k>b</i>": "b", "<p id=i>x<p>y": "y", "<em>x</em>y": "y",
        "<p class=v>x<i style='visibility:visible'>y</i>": "y", "<p class=x>a<p class=y>b": "a", "<p class='a b h'>x": "", "<p class=h style='display:block'>x": "x", "<u style='display:inline'>x</u>y": "y",
        "a<span class=blk>b</span>c": "a\nb\nc", "<p class=pre>a  b\n c": "a  b\n c", "<P CLASS=h>x": "", "<p class=H>x": "x",
    }
    assert {k: render(sheet + k) for k in cases} == cases
    assert render("<style media=print>p{display:none}</style><p>x") == "x" and render("<style>}}{{p{display:none</style><p>x") == "x"


def test_lists_and_white_space():
    cases = {
        "<ol><li value=7>a<li>b<li value=-2>c": "7. a\n8. b\n-2. c", "<ol reversed><li>a<li>b": "2. a\n1. b", "<ol reversed start=9><li>a<li>b": "9. a\n8. b", "<ol start=-1><li>a<li>b": "-1. a\n0. b",
        "<pre>\n a\n  b</pre>": " a\n  b", "<pre>\r\n\n a</pre>": "\n a", "<p style='white-space:pre-line'>a  b\nc": "a b\nc", "<pre style='white-space:normal'>a  b\nc": "a b c",
        "<div style='display:inline'>a</div>b": "ab", "a<span style='display:block'>b</span>c": "a\nb\nc", "<li>a<section><li>b</section>": "- a\n  - b", "<textarea>\nx</textarea>": "x",
    }
    assert {k: render(k) for k in cases} == cases


def test_cells_beyond_the_aligned_ones():
    wide = "w" * 300
    assert render(f"<table><tr><td>{wide}<td>x<tr><td>a<td>b</table>").split("\n") == [wide + "  x", "a" + " " * 101 + "b"]
    row = render("<table><tr>" + "<td>ab" * 500 + "<tr>" + "<td>c" * 500 + "</table>").split("\n")
    assert [len(r.split()) for r in row] == [500, 500]
    nested = render("<table><tr><td>x" * 30 + "</table>" * 30)
    assert nested.split() == ["x"] * 30


DEEP = {
    "lists": "<ul><li>x", "ordered": "<ol><li value=99999999>x", "quotes": "<blockquote>x", "dd": "<dl><dd>x", "buttons": "<p><button>" + "<div>" * 50, "tables": "<table><tr><td>x<td>y", "formats": "<b hidden>", "fonts": "<font color=1><p>x",
    "ends": "<div><span></div></p>", "svg": "<svg><a>", "cells": "<td rowspan=60000>x", "spans": "<tr><td colspan=1000>x<td>y", "rows": "<table><td colspan=1000></td><td>x<tr>", "styles": "<style>.a{display:none}</style><i class=a>x</i>", "pre": "<pre>\nx\n", "details": "<details><summary>x", "veiled": "<div hidden><p>", "reversed": "<ol reversed><li>a<li>b",
}


@pytest.mark.parametrize("name", DEEP)
def test_time_and_text_are_linear(name):
    """Pages of some 100,000 levels: no more than a fixed multiple of their length, and time that follows it."""
    took = {}
    for n in (25_000, 100_000):
        page = DEEP[name] * (n // (50 if name == "buttons" else 1))
        began = time.process_time()
        text = render(page)
        took[n] = time.process_time() - began
        assert len(text) <= 60 * len(page) + 100, name
    assert took[100_000] < 8 * took[25_000] + 0.5 and took[100_000] < 40, took
