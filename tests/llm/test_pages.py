import os
import random
import re

from lodestrata.llm import pages as P

MENU, FOOT = "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<footer>&copy; all</footer>"


def text_of(page):
    lines = P.lines_of(page)
    return P.main_lines([x for x, _ in lines], [z for _, z in lines], list(range(len(lines))), [])


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <header>Site</header><nav>menu</nav><!-- c --><div class="ad">Buy</div><div class='cookie-banner'>ok?</div>
      <article><h1>Head&amp;line</h1><p>One <b>two</b><br>three &eacute;&#x41;<p>Four<aside>side</aside>
      <form><input name=x>go</form><ul><li>a<li>b</ul><div class="comments">bah</div><p style="display: none">no</p></article>
      <section id="comments"><p>troll</p></section><footer>end</footer></body></html>"""
    assert text_of(page) == ["Head&line", "One two three éA", "Four", "a", "b"]


def test_names_of_elements():
    keep = "<article><header class='entry-header'><h1>Title</h1></header><p class='commentary lead'>x</p>{}</article>"
    assert text_of(keep.format("")) == ["Title", "x"]
    for name in ("ad", "ads1", "ad_0", "adBox", "advertBlock", "comments-area", "sidebarLeft", "site-footer", "cookieNotice", "newsletter2"):
        assert text_of(keep.format(f"<div class='{name}'>no</div><div id={name}>no</div>")) == ["Title", "x"], name
    assert text_of("<header class='h'>Site</header><div class='site-header'>Site</div><main><p>y</p></main>") == ["y"]
    assert text_of("<article><div class='badge address adage'>y</div></article>") == ["y"]


def test_broken_markup():
    assert text_of("<article><p><b>One.<br><p>Two</b> x</article><footer>f") == ["One.", "Two x"]
    assert text_of("<article><p>a &am") == ["a &am"]
    assert text_of("<article><p>a</p><p cla") == ["a"]
    assert text_of("<article>1 < 2 <p>x <!-- open") == ["1 < 2", "x"]
    assert text_of("<article><script>if (a</b>) x") == []
    assert text_of('<article><p title="a > b">q</p></div></article>') == ["q"]
    assert text_of("<article>a<b>b</b>c <span class=ad>x</span>d</article>") == ["abc", "d"]
    assert text_of("") == [] and text_of("plain") == ["plain"]
    assert text_of("<p>" * 3000 + "x") == ["x"]


def plain_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(15))] for _ in range(2))
        marks = P.shared(a, b)
        chosen = [x for x, m in zip(a, marks, strict=True) if m]
        assert len(chosen) == plain_lcs(a, b)
        rest = iter(b)
        assert all(x in rest for x in chosen)


def extract(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, lines string, path int")
    return sorted(((r.page_id, r.url, r.text) for r in P.extract(df, **options).collect()), key=str)


def test_differencing_without_main_element(spark):
    page = lambda *own: "<div>Top of site</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Bottom</div>"
    rows = [
        (1, "http://h.net/a/1", page("one", "uno"), "x", 1),
        (2, "http://h.net/a/2", page("two"), "x", 1),
        (3, "http://h.net/b/1", page("three"), "x", 1),
        (4, "http://other.net/a/1", page("four"), "x", 1),
        (5, "http://h.net/a/2", page("two"), "x", 1),
    ]
    got = {i: t for i, _, t in extract(spark, rows)}
    assert got == {1: "one uno", 2: "two", 5: "two", 3: "Top of site three Bottom", 4: "Top of site four Bottom"}


def plain_extract(rows):
    """The whole operator over a list: sort each host, find the nearest page that differs, delete what is shared."""
    hosts: dict = {}
    for k, (i, url, page, *_) in enumerate(rows):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        lines = P.lines_of(page or "")
        hosts.setdefault(m[1].lower() if m else "", []).append((m[2] if m else "", url or "", i, [x for x, _ in lines], [z for _, z in lines], k))
    out = {}
    for pages in hosts.values():
        for path, url, i, lines, zones, k in pages:
            near = []
            for step in (-1, 1):
                mine = (path, url, i)
                side = [p for p in pages if p[3] and ((p[0], p[1], p[2]) < mine if step < 0 else (p[0], p[1], p[2]) > mine)]
                side.sort(key=lambda p: p[:3], reverse=step < 0)
                # Pages with the same text as the one before them, back to this page, are one run with it.
                other = next((p for p in side if p[3] != lines), None)
                if other:
                    near.append(other)
            best = max(near, key=lambda p: len(os.path.commonprefix([path, p[0]])), default=None)
            names = {x: j for j, x in enumerate({*lines, *(best[3] if best else ())})}
            gone = P.shared([names[x] for x in lines], [names[x] for x in best[3]]) if best else [False] * len(lines)
            has_main = P.MAIN in zones
            out[k] = " ".join(x for x, z, g in zip(lines, zones, gone, strict=True) if z == P.MAIN or not has_main and z == P.OTHER and not g)
    return sorted(((i, u, out[k]) for k, (i, u, *_) in enumerate(rows)), key=str)


def site(seed):
    rng = random.Random(seed)
    line = lambda k: f"<div>{rng.choice('abcdefgh') * k}</div>"
    rows = []
    for i in range(90):
        host = rng.choice(["big.net"] * 6 + ["Small.org", "one.com"])
        path = rng.choice(["/", "/a/", "/a/b/", "/en/"]) + rng.choice(["", str(rng.randrange(40)), f"{rng.randrange(9)}/"])
        body = "<div>Top</div>" + "".join(line(rng.choice((1, 1, 9))) for _ in range(rng.randrange(4))) + rng.choice(["", "<div>End</div>", "<nav>menu</nav>"])
        if rng.random() < 0.2:
            body = f"<article><p>story {i % 5}</p></article>" + body
        rows.append((i, f"http://{host}{path}?x={i}", rng.choice([body, body, "", None]) if i % 9 == 0 else body, "x", 1))
    rows += [(1000 + i, f"http://big.net/a/c{i}", "<div>Top</div><p>copied</p>", "x", 1) for i in range(30)]
    return rows


def test_whole_operator_against_a_plain_version(spark):
    for seed in (1, 2):
        rows = site(seed)
        want = plain_extract(rows)
        for group in (1, 7, 1000):
            assert extract(spark, rows, group=group, within="host") == want
    # Without the pages around it, a page keeps the lines that it shared with them.
    alone = [r for r in rows if r[0] == 3]
    assert extract(spark, alone, within="host") == plain_extract(alone)


def test_neighbours_over_a_host(spark):
    page = lambda *own: "<div>Top of site</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Bottom</div>"
    rows = [(1, "http://h.net/a/", page("one"), "x", 1), (2, "http://h.net/b/", page("two"), "x", 1), (3, "http://h.net/about", page("three"), "x", 1), (4, "http://other.net/", page("four"), "x", 1)]
    assert [t for *_, t in extract(spark, rows, within="host")] == ["one", "two", "three", "Top of site four Bottom"]
    assert extract(spark, rows[1:2], within="host") == [(2, "http://h.net/b/", "Top of site two Bottom")]


def test_main_element_is_kept_though_shared(spark):
    page = MENU + "<article><p>Same story</p></article>" + FOOT
    rows = [(i, f"http://h.net/{i}", page, "x", 1) for i in range(4)]
    assert [t for *_, t in extract(spark, rows)] == ["Same story"] * 4
    assert [t for *_, t in extract(spark, rows, group=1)] == ["Same story"] * 4


def test_nulls_and_empty(spark):
    rows = [(1, None, None, None, None), (None, "http://a/", "", "x", 1), (2, None, "<p>x", "x", 1), (2, None, "<p>x", "x", 1)]
    assert extract(spark, rows) == sorted([(1, None, ""), (None, "http://a/", ""), (2, None, "x"), (2, None, "x")], key=str)
    assert extract(spark, []) == []
    long = "<article>" + "<p>word</p>" * 20_000
    assert len(extract(spark, [(1, "http://a/b", long, "x", 1), (2, "http://a/c", long + "<p>z", "x", 1)])[0][2]) == 5 * 20_000 - 1
