"""Main text: reading of pages, alignment, differencing of neighbours, against plain versions."""

import random

import pytest
from pyspark.sql import types as T

from emberline.llm import page_text as pt

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()), ("host", T.StringType()), ("key", T.StringType()), ("id", T.LongType()))])


def frame(spark, rows, n=3):
    return spark.createDataFrame([(i, u, h, "h", "k", 1) for i, u, h in rows], SCHEMA).repartition(n)


def got(df):
    return sorted(((r.page_id, r.text) for r in df.collect()), key=str)


def texts(page, kinds=(pt.OPEN, pt.ARTICLE)):
    return [x for x, k in pt.read_lines(page) if k in kinds]


@pytest.mark.parametrize(
    "page,want",
    [
        ("", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a\n\t b</p><p>c<br>d&nbsp;e", ["a b", "c d e"]), ("a &#233;&eacute&hellip; &am", ["a éé… &am"]),
        ("<script>var t='</p><p>x'</script><style>p{}</style>y<title>t</title>", ["y"]), ("<p>one<p>two<div>three</div>four", ["one", "two", "three", "four"]),
        ("<nav><ul><li>m<li>n</ul></nav>text<footer>f</footer>", ["text"]), ("<header>h</header><article><header><h1>t</h1></header>b<footer>f</footer><aside>s</aside></article>", ["t", "b"]),
        ("<div class='ad-box'>x<div>y</div></div>z", ["z"]), ("<div id=cookieNotice>x</div><div class=lead>z</div>", ["z"]), ("<article>a<div class=\"comments\">c</div></article>", ["a"]),
        ("<p>x <b>y</b><i class='share'>s</i> z</p>", ["x y", "z"]), ("<p hidden>x</p><div style='display: none'>y</div>z", ["z"]), ("<span class=ad>x<span>y</span>z</span>t", ["t"]), ("<form>f<input></form><!-- c <p>d</p> -->e<!-- open", ["e"]),
        ("<article><p>whole</p><p>brok <b", ["whole", "brok"]), ("a < b and <3 <p>c", ["a < b and <3", "c"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a b", "c"]),
        ("<a href=\"x>y\">l</a> m <a href=\"open>n</a>", ["l m n"]), ("<p class='description'>no part of a name</p>", ["no part of a name"]), ("<div>" * 3000 + "deep", ["deep"]),
    ],
)
def test_reading(page, want):
    assert texts(page) == want


def test_hosts_and_paths():
    assert pt.host_and_path("HTTP://u:p@Ex.org:80/a?b#c") == ("ex.org", "/a?b")
    assert pt.host_and_path("//ex.org") == ("ex.org", "/")
    assert pt.host_and_path(None) == pt.host_and_path("no url") == pt.host_and_path("http:///x") == (None, "")


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old, row = row, [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("cells", [1 << 24, 40, 4])
def test_alignment_is_longest(monkeypatch, cells):
    monkeypatch.setattr(pt, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(300):
        a, b = ([rng.randrange(rng.choice((2, 6, 30))) for _ in range(rng.randrange(25))] for _ in range(2))
        pair = pt.aligned(a, b)
        assert len(pair) == length(a, b) and all(a[i] == b[j] for i, j in pair)
        assert all(p < q and r < s for (p, r), (q, s) in zip(pair, pair[1:]))


SHOP = "<div>Shop menu</div><div>All offers</div>{}<div>Imprint of the shop</div><div>Never miss a thing</div>"


def test_shared_lines_of_neighbours_go(spark):
    rows = [(k, f"http://shop.example/{name}", SHOP.format("".join(f"<p>Text {k} line {j}</p>" for j in range(5)))) for k, name in enumerate(("a/1", "a/2", "b/1"))]
    rows += [(9, "http://other.example/x", SHOP.format("<p>alone</p>")), (10, None, SHOP.format("<p>nowhere</p>")), (11, "http://shop.example/c", None), (12, "http://shop.example/d", "")]
    want = [(k, "\n\n".join(f"Text {k} line {j}" for j in range(5))) for k in range(3)]
    want += [(n, f"Shop menu\n\nAll offers\n\n{t}\n\nImprint of the shop\n\nNever miss a thing") for n, t in ((9, "alone"), (10, "nowhere"))] + [(11, ""), (12, "")]
    found = pt.main_text(frame(spark, rows))
    assert got(found) == sorted(want, key=str) and found.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.n_chars for r in found.collect()} == {i: len(t) for i, t in want}


def test_articles_keep_what_they_share_and_copies_keep_all(spark):
    page = "<nav>{0}</nav><article><h1>Title {0}</h1><p>Licensed to all.</p></article><div>below</div>"
    rows = [(k, f"https://a.example/{k}", page.format(k)) for k in range(4)]
    copies = [(10 + k, f"https://c.example/{k:03}", "<div>one</div><div>and all the same</div>") for k in range(40)] + [(99, "https://c.example/x", "<div>one</div><div>other</div><div>text</div>")]
    near = [(200, "https://n.example/1", "<div>" + "</div><div>".join(f"line {j}" for j in range(30)) + "</div>"), (201, "https://n.example/2", "<div>" + "</div><div>".join(f"line {j}" for j in range(31)) + "</div>")]
    found = dict(got(pt.main_text(frame(spark, rows + copies + near))))
    assert [found[k] for k in range(4)] == [f"Title {k}\n\nLicensed to all." for k in range(4)]
    assert {found[10 + k] for k in range(40)} == {"and all the same"} and found[99] == "other\n\ntext"
    assert found[200].count("line") == 30 and found[201].count("line") == 31


def test_repeated_rows_and_empty_tables(spark):
    row = (1, "http://a.example/1", "<p>x</p>")
    assert got(pt.main_text(frame(spark, [row, row, (1, "http://a.example/1", "<p>y</p>"), (None, "http://a.example/2", "<p>w</p><p>z</p>")]))) == sorted([(1, "x"), (1, "x"), (1, "y"), (None, "w\n\nz")], key=str)
    assert pt.main_text(frame(spark, [row]).limit(0)).count() == 0


def plain(rows):
    """Neighbours by a sort in one place, lines compared in full."""
    read = {}
    for i, u, h in rows:
        host, path = pt.host_and_path(u)
        lines = pt.read_lines(h or "")
        if host:
            at = (host, tuple(lines))
            read[at] = min(read.get(at, (path,)), (path,))
    order = sorted(((host, path, pt._key(list(lines)), lines) for (host, lines), (path,) in read.items()))
    gone = {}
    for a, b in zip(order, order[1:]):
        if a[0] == b[0]:
            pair = pt.aligned([hash(x) for x, _ in a[3]], [hash(x) for x, _ in b[3]])
            sides = ((a, [i for i, _ in pair]), (b, [j for _, j in pair]))
            if any(100 * sum(len(s[3][i][0]) for i in at) < pt.COPY_PERCENT * sum(len(x) for x, _ in s[3]) for s, at in sides):
                for s, at in sides:
                    gone.setdefault((s[0], s[3]), set()).update(at)
    out = []
    for i, u, h in rows:
        lines = pt.read_lines(h or "")
        own, drop = any(k == pt.ARTICLE for _, k in lines), gone.get((pt.host_and_path(u)[0], tuple(lines)), ())
        out.append((i, "\n\n".join(x for n, (x, k) in enumerate(lines) if k == pt.ARTICLE or k == pt.OPEN and not own and n not in drop)))
    return sorted(out, key=str)


def test_equals_plain_version(spark):
    rng = random.Random(5)
    lines = [f"line {k}" for k in range(12)]
    rows = []
    for k in range(150):
        body = "".join(f"<{t}>{rng.choice(lines)}</{t}>" for t in rng.choices(["p", "div", "nav", "h2"], k=rng.randrange(12)))
        rows.append((k, rng.choice([None, f"http://h{rng.randrange(3)}.example/{rng.choice('abc')}/{rng.randrange(40)}"]), rng.choice([body, body, f"<article>{body}</article><p>x</p>"])))
    assert got(pt.main_text(frame(spark, rows, 7))) == plain(rows)


def test_query_equals_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert got(pt.op11_page_text(spark, folder)) == plain(rows)
