import random

import pytest

from webfacts.llm import pagediff as pd


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(400):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randrange(14))] for _ in range(2))
        one, two = pd.common_lines(a, b)
        assert [a[i] for i in sorted(one)] == [b[j] for j in sorted(two)]
        assert len(one) == longest(a, b)


@pytest.mark.parametrize("page, lines", [
    ("<p>a<p>b</p>", ["b:a", "b:b"]),
    ("<article><h1>T</h1><p>one<br>two &amp; <b>three</p></article><p>x", ["a:T", "a:one two & three", "b:x"]),
    ("<nav><ul><li>m</ul></nav><main>text<aside>side</aside> more</main>", ["o:m", "a:text", "o:side", "a:more"]),
    ("<div class='post-ad top'>buy</div><div id=comments><article class=comment>c</article></div>t", ["o:buy", "o:c", "b:t"]),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><title>t</title>x<!-- <p>no --> y", ["b:x y"]),
    ("<div role='navigation'>n</div><form>f<input value='v>w'></form><footer>&copy; z", ["o:n", "o:f", "o:© z"]),
    ("plain   text\n here", ["b:plain text here"]), ("", []), ("<p title=\"open>text", ["b:text"]), ("<", ["b:<"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["b:a b", "b:c"]), ("a < b <> c", ["b:a < b <> c"]),
])
def test_page_lines(page, lines):
    assert [f"{zone}:{line}" for zone, line in pd.page_lines(page)] == lines


def test_hostile_pages():
    import time

    begin = time.perf_counter()
    for page in ("<p>w<i>" * 30_000, "<a b='" * 30_000, "<!--" * 30_000, "<p " + "a='>' " * 100_000 + ">x", "</p>" * 50_000):
        pd.page_lines(page)
    assert time.perf_counter() - begin < 20


def extracted(spark, rows, ranges=None):
    pages = spark.createDataFrame([(*r, 1, "t") for r in rows], "page_id long, url string, html string, _part int, Text string")
    found = pd.extract(pages, ranges=ranges).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return sorted(((r["page_id"], r["text"]) for r in found), key=repr)


def test_template_lines_go_where_no_article_is_marked(spark):
    page = lambda i: f"<div>Menu<p>Home<p>Body of page {i}<p>All rights reserved</div>"
    rows = [(i, f"http://h.example/a/{i:03}", page(i)) for i in range(40)]
    rows += [(100, "http://alone.example/", page(100)), (101, "http://h.example/zz", "<article>Menu<p>Home</article>")]
    wanted = sorted([(i, f"Body of page {i}") for i in range(40)] + [
        (100, "Menu\nHome\nBody of page 100\nAll rights reserved"), (101, "Menu\nHome")], key=repr)
    for ranges in (1, 3, 30):
        assert extracted(spark, rows, ranges) == wanted


def test_odd_rows(spark):
    rows = [(1, None, "<p>no url"), (2, "not a url", "<p>none"), (None, "http://h/x", None), (3, "http://h/x", ""),
            (4, "http://h/y", "<article>" + "<p>long words" * 40_000), (4, "http://h/y", "<article><p>twin"),
            (5, "http://h/y?q=1", "<article><p>twin")]
    found = extracted(spark, rows, 4)
    assert found == sorted([
        (1, "no url"), (2, "none"), (None, ""), (3, ""), (4, "\n".join(["long words"] * 40_000)), (4, "twin"), (5, "twin")],
        key=repr)
    assert extracted(spark, []) == []


def test_copies_are_no_template(spark):
    body = lambda i: " ".join(f"word{i}x{j}" for j in range(60))
    page = lambda i, more="": f"<div>Menu<p>Home<p>{body(i)}<p>{body(i)[::-1]}{more}<p>All rights reserved</div>"
    text = lambda i, more="": f"{body(i)}\n{body(i)[::-1]}{more}"
    rows, wanted = [], []
    for i in range(6):
        for j in range(7):
            more = f" seen {j}" if i % 2 and j % 3 else ""
            rows.append((10 * i + j, f"http://h.example/{i}?a={j}" if i % 3 else f"http://h.example/{i}/{j}", page(i, more)))
            wanted.append((10 * i + j, text(i, more)))
    # One run of copies over many ranges, with another page at its end alone.
    rows += [(1000 + j, f"http://run.example/a/{j:03}", page(7, f" at {j % 3}")) for j in range(90)]
    wanted += [(1000 + j, text(7, f" at {j % 3}")) for j in range(90)]
    rows += [(2000, "http://run.example/b", page(8, " " + body(9)))]
    wanted += [(2000, text(8, " " + body(9)))]
    # Copies alone: nothing is known to be template.
    rows += [(3000 + j, "http://same.example/", "<p>Head<p>The text") for j in range(5)]
    wanted += [(3000 + j, "Head\nThe text") for j in range(5)]
    for ranges in (1, 4, 40):
        assert extracted(spark, rows, ranges) == sorted(wanted, key=repr)


@pytest.mark.parametrize("page, lines", [
    ("<div class='layout has-sidebar'>x<article>t</article><div class=sidebar>s</div></div>", ["b:x", "a:t", "o:s"]),
    ("<div class='page with-nav'><p>t</div><div class=no-sidebar>u</div>", ["b:t", "b:u"]),
    ("<div id='social-wrapper'><main>t<div class=share>s</div>u</main></div>", ["a:t", "o:s", "a:u"]),
    ("<form action=x>f<article>t</article></form>", ["o:f", "a:t"]),
    ("<div class=widget>w<article>t<form>f</form></article></div>", ["o:w", "a:t", "o:f"]),
    ("<article class='post comments-open'>t</article><article class='comment-body'>c</article>", ["a:t", "o:c"]),
    ("<article>t</article><div class=related><article>r</article></div>", ["a:t", "o:r"]),
    ("<div class=sidebar><article>t</article><div class=related><article>r</article></div></div>", ["a:t", "o:r"]),
    ("<nav><article>n</article></nav><div class='site-footer'>z</div>", ["o:n", "o:z"]),
])
def test_article_inside_named_parts(page, lines):
    assert [f"{zone}:{line}" for zone, line in pd.page_lines(page)] == lines
