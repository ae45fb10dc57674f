"""Main text of pages and WARC archives."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from emberlog.llm import warc
from emberlog.llm.html_text import html_text, main_text

ARTICLE = "<p>First paragraph, with enough words, to count.</p><p>Second &amp; last\n  paragraph.</p>"
PLAIN = "First paragraph, with enough words, to count.\nSecond & last paragraph."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a>x</a></nav><article>{ARTICLE}</article><footer>f</footer></body></html>",
        f"<body><div class='menu'><a>m</a></div><div id=main-content>{ARTICLE}<div class='ad'>buy</div></div></body>",
        f"<body><header><h1>Site</h1></header><div>{ARTICLE}</div><aside>side, side, side</aside><form>f</form>",
        f"<script>var a='<p>no</p>';</script><style>p{{}}</style><main>{ARTICLE}</main><!-- <p>no</p> -->",
        f"<article>{ARTICLE}<section class='comments'><p>Great, really, great, I think, indeed.</p></section></article>",
        f"<article>{ARTICLE}<div class='cookie-notice'>We use cookies</div><div hidden>x</div></article>",
        f"<article>{ARTICLE.replace('</p>', '')}</article>",
        f"<article>{ARTICLE}<ul><li><a>one more story</a><li><a>other story</a><li><a>third story</a></ul></article>",
    ],
)
def test_main_text(page):
    assert main_text(page) == PLAIN


def test_pages_without_text():
    assert [main_text(x) for x in (None, "", "<p></p>", "<script>x", "<!-- open")] == [""] * 5
    assert main_text("plain &lt; text") == "plain < text"
    assert main_text("<div>" * 20000 + "deep") == "deep"


def test_nothing_is_cut():
    body = "".join(f"<p>Paragraph {k}, with a comma.</p>" for k in range(3000))
    assert main_text(f"<nav>n</nav><div>{body}</div>").count("\n") == 2999


@pytest.mark.parametrize("outer", ["main", "div", "body"])
def test_sections_without_an_article_stay(outer):
    short = "".join(f"<section><h2>Part {k}</h2><p>{'short words ' * 12}</p><p>{'other words ' * 12}</p></section>" for k in range(3))
    long = "<section>" + "".join(f"<p>{'Long, long, long words, ' * 20}{k}</p>" for k in range(30)) + "</section>"
    found = main_text(f"<nav>n</nav><{outer}>{short}{long}{short}</{outer}><footer>f</footer>").split("\n")
    assert len(found) == 2 * 9 + 30 and found[0] == "Part 0" and found[-3] == "Part 2"


def test_link_lists_inside_the_text_stay():
    links = "<ul><li><a>one source</a><li><a>other source</a><li><a>third source</a></ul>"
    kept = "one source\nother source\nthird source"
    page = f"<article>{links}{ARTICLE}{links}<table><tr><td><a>a</a><td><a>b</a><td><a>c</a></table>{ARTICLE}{links}</article>"
    assert main_text(page) == f"{PLAIN}\n{kept}\na\nb\nc\n{PLAIN}"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><body>{ARTICLE}",
        f"<head><meta charset=x><script>x</script>{ARTICLE}",
        f"<html><head><title>t</title><body><form id=aspnetForm><input><select><option>o</select>{ARTICLE}</form></body>",
        f"<form><div>few words in front of it</div><article>{ARTICLE}</article></form>",
        f"<form id=f1><form><label>Search</label><input></form>{ARTICLE}</form>",
    ],
)
def test_open_heads_and_forms_around_the_page(page):
    assert main_text(page) == PLAIN
    assert main_text("<head><title>t</title>bare text") == "bare text"


LONG = "".join(f"<p>Sentence {k} of the text, which goes on, as texts do, for a good while and then ends.</p>" for k in range(6))
READ = "\n".join(f"Sentence {k} of the text, which goes on, as texts do, for a good while and then ends." for k in range(6))


def test_scores_decide_without_an_article():
    junk = "<div>Call 555-1234 today!</div>", "<div>Copyright 2020 Foo Inc.</div><div>Follow us</div>"
    assert main_text(f"<body>{junk[0]}<div id=c>{LONG}</div>{junk[1]}</body>") == READ
    assert main_text(f"<body>{junk[0]}{LONG}{junk[1]}</body>") == READ
    assert main_text(f"<body><h1>Title</h1><div>{LONG}</div><div>{'<a>link, link</a> ' * 30}</div></body>") == f"Title\n{READ}"


def test_a_long_advert_beside_a_short_article():
    assert main_text(f"<body><div class=ad>{LONG}</div><article><h1>Title</h1><p>Short.</article></body>") == "Title\nShort."


def test_parts_of_one_kind_stay():
    assert main_text(f"<main><article>{LONG}</article><article>{LONG}</article></main>") == f"{READ}\n{READ}"
    assert main_text(f"<main><article>{LONG * 9}</article><article><p>Short part.</p></article></main>").endswith("Short part.")


@pytest.mark.parametrize("named", ["class=discussion", "id=related-work", "class='notice-text content'", "class='comment post-body'"])
def test_words_only_lower_points(named):
    assert main_text(f"<article>{LONG}<section {named}>{LONG}</section></article>") == f"{READ}\n{READ}"
    assert main_text(f"<body><div {named}>{LONG}</div></body>") == READ


@pytest.mark.parametrize("named", ["class=discussion", "id=related-posts", "class=notice", "class=comments", "class=ad"])
def test_poor_foreign_parts_go(named):
    assert main_text(f"<article>{LONG}<div {named}><p>Nice.</p><p>Buy now, it is cheap</p></div>{LONG}</article>") == f"{READ}\n{READ}"
    assert main_text(f"<article>{LONG}<div class=comments>{LONG}</div></article>") == READ


@pytest.mark.parametrize("unit", ["<a '", '<a "', '<a ="', "<a =\"'>", "<a", "<b></p>", "</x>", "<div><b></i>", "<li><p></b>", "<!-", "<a b", "</",
                                  "<div class='", "<script>", "<textarea></", "&amp", "<p><a>x", "<table><tr><td><ul><li>"])
def test_hostile_pages_take_linear_time(unit):
    import time

    half = 500_000 // len(unit)
    for page in (unit * 2 * half, "<b>" * 100_000 + "</p>" * 100_000 if unit == "<b></p>" else "<div><i>" * 50_000 + unit * half):
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 8


def test_rule_against_a_plain_version():
    """Random trees of block elements: every number anew from the tree, by recursion."""
    import random
    from xml.etree import ElementTree

    def blocks(e):
        return ([e] if e.text else []) + [x for c in e for x in blocks(c)]

    def value(e):
        return (len(e.text) >= 25) + e.text.count(",") + min(len(e.text) / 100, 3)

    def named(e):
        return {"related": 0.3, "ad": 1e-6}.get(e.get("class"), 1.0)

    def plain_version(page):
        root = ElementTree.fromstring(page)
        above = {c: e for e in root.iter() for c in e}

        def up(e):
            return [e, *up(above[e])] if e in above else [e]

        def weight(e):
            w = 1.0
            for x in reversed(up(e)):
                w *= named(x)
            return w

        def worth(e):
            return sum(value(x) * weight(x) for x in blocks(e))

        def rate(e):
            return worth(e) / max(1, len(blocks(e)))

        order = list(root.iter())
        points = dict.fromkeys(order, 0.0)
        for e in blocks(root):
            for level, x in enumerate(up(above[e] if e.tag in ("p", "h2") else e)[:5]):
                points[x] += value(e) * weight(e) / (1, 2, 6, 9, 12)[level]
        best = max(order, key=lambda e: (round(points[e], 9), -order.index(e)))
        while best in above and worth(best) < 0.75 * worth(root) - 1e-9:
            best = above[best]
        kept, path = {best}, up(best)
        for below, e in zip(path, path[1:], strict=False):
            follows = False
            for c in [c for c in reversed(list(e)) if blocks(c) or c is below]:
                if c is below:
                    follows = True
                    continue
                alike = c.tag == below.tag and (c.tag in ("section", "article") or c.get("class") and c.get("class") == below.get("class"))
                good = named(c) == 1 and (alike or rate(c) >= 0.5 * rate(best))
                follows = good or follows and all(x.tag == "h2" for x in blocks(c)) and named(c) == 1
                if follows:
                    kept.add(c)
            if below.tag == "article":
                break
        chosen = [e for e in blocks(root) if kept & set(up(e))]
        usual = [value(e) for e in chosen if weight(e) == weight(best)]
        usual = sum(usual) / len(usual) if usual else 0.0
        cut = {e for e in order if named(e) < 1 and best not in e.iter() and blocks(e) and rate(e) / weight(best) < 0.2 * usual}
        boxes = {c for c in best if c.tag in ("div", "section") and "article" not in {x.tag for x in up(c)}
                 and sum(map(value, blocks(c))) < 1 and not any(x.tag == "h2" for x in blocks(c))}
        held = [e for e in chosen if not cut & set(up(e))]
        solid = [k for k, e in enumerate(held) if not boxes & set(up(e))]
        held = held[solid[0] : solid[-1] + 1] if solid else held
        return "\n".join(e.text for e in held)

    draw = random.Random(5)

    def grown(depth):
        if depth == 0 or draw.random() < 0.3:
            tag = draw.choice(["p", "p", "p", "h2", "div"])
            text = " ".join(draw.choice(["word", "longer,", "text"]) for _ in range(draw.choice([1, 2, 4, 30, 90])))
            return f"<{tag}>{text}</{tag}>"
        tag = draw.choice(["div", "div", "section", "article"])
        kind = draw.choice(["", "", "", ' class="x"', ' class="related"', ' class="ad"'])
        return f"<{tag}{kind}>" + "".join(grown(depth - 1) for _ in range(draw.randint(1, 5))) + f"</{tag}>"

    for _ in range(600):
        page = "<body>" + "".join(grown(4) for _ in range(draw.randint(1, 4))) + "</body>"
        assert main_text(page) == plain_version(page), page


def test_page_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é x</p>", 5), (1, "u", None, 6), (None, None, "", 7)],
                               "page_id bigint, url string, html string, text int")
    got = [tuple(r) for r in html_text(df).collect()]
    assert got == [(1, "u", "é x", 3), (1, "u", "", 0), (None, None, "", 0)]
    assert html_text(df.limit(0)).columns == ["page_id", "url", "text", "n_chars"]


@pytest.fixture
def pages(spark):
    long = "<p>" + "ä long payload, repeated. " * 20 + "</p>"
    rows = [(k, f"http://x/{k}\r\nEvil: 1", long if k % 3 else f"{k}" * 60, "clash") for k in range(1, 40)]
    rows += [(50, None, None, "c"), (51, "u", "", "c"), (52, "u", "short", "c"), (53, "u", "short", "c"),
             (None, "u", long, "c"), (54, "u", "WARC/1.1\r\n\r\n" * 30000, "c")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string").repartition(3)


def test_archives_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}"
    marked = warc.with_revisits(pages, "page_id", "html")
    warc.write_archives(marked, f"{folder}/streams", "page_id", "url")
    index = warc.normalise(spark, f"{folder}/streams", f"{folder}/members")
    got = {warc_id(r.record_id): r for r in warc.read_records(index).collect()}
    want = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert got.keys() == want.keys()
    first = {}
    for key in sorted(k for k in want if k is not None):
        first.setdefault(want[key], key)
    for key, payload in want.items():
        revisit = key is not None and len(payload) >= 100 and first[payload] != key
        record = got[key]
        assert record.record_type == ("revisit" if revisit else "response")
        assert (record.payload_bytes, record.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert record.payload == (b"" if revisit else payload)
        assert record.refers_to == (f"<urn:page:{first[payload]}>" if revisit else None)
    # Members stand alone, and the sidecar index says where.
    for path in Path(tmp_path, "members").glob("*.warc.gz"):
        data, entries = path.read_bytes(), path.with_name(path.name.replace(".warc.gz", ".index")).read_text().splitlines()
        assert sum(int(line.split(" ")[1]) for line in entries) == len(data)
        for line in entries:
            offset, length, _ = line.split(" ", 2)
            assert gzip.decompress(data[int(offset) : int(offset) + int(length)]).startswith(b"WARC/1.1\r\n")


def warc_id(record_id: str):
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def test_archives_of_no_pages(spark, pages, tmp_path):
    folder = f"file://{tmp_path}"
    marked = warc.with_revisits(pages.filter(F.lit(False)), "page_id", "html")
    warc.write_archives(marked, f"{folder}/streams", "page_id", "url")
    assert warc.read_records(warc.normalise(spark, f"{folder}/streams", f"{folder}/members")).count() == 0


def test_streams_of_many_members_and_damage(spark, tmp_path):
    import io

    parts = [b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"]
    stream = warc.Inflated(io.BytesIO(b"".join(map(gzip.compress, parts))))
    heads = []
    while (head := stream.head()) is not None:
        heads.append((head.strip(), b"".join(stream.pieces(int(warc.fields(head)["content-length"]) + 4))))
    assert [body for _, body in heads] == [b"abc\r\n\r\n", b"\r\n\r\n"]
    with pytest.raises(ValueError, match="within a record"):
        cut = warc.Inflated(io.BytesIO(gzip.compress(parts[0][:-6])))
        cut.head()
        list(cut.pieces(7))


def test_streams_cut_between_records(spark):
    import io

    data = gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    for cut in (data[:-8], data[:-1], data + data[:12]):
        stream = warc.Inflated(io.BytesIO(cut))
        with pytest.raises(ValueError, match="within a gzip member"):
            while (head := stream.head()) is not None:
                list(stream.pieces(int(warc.fields(head)["content-length"]) + 4))
    assert warc.Inflated(io.BytesIO(b"")).head() is None
    padded = warc.Inflated(io.BytesIO(data + b"\0" * 100))
    assert padded.head() and list(padded.pieces(7)) and padded.head() is None


def test_public_archives(spark, tmp_path):
    import base64

    def record(kind, block, **more):
        lines = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{kind}>", **{k.replace("_", "-"): v for k, v in more.items()}}
        head = "".join(f"{k}: {v}\r\n" for k, v in lines.items())
        return f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    html = b"<p>page</p>"
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(html).digest()).decode()
    http = {"Content_Type": "application/http; msgtype=response", "WARC_Payload_Digest": sha1}
    parts = [
        record("warcinfo", b"software: x\r\n", Content_Type="application/warc-fields"),
        record("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", Content_Type="application/http; msgtype=request"),
        record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + html, **http),
        record("revisit", b"", **http, WARC_Refers_To="<urn:uuid:response>"),
        record("metadata", b"fetchTimeMs: 5"),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    index = warc.normalise(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    got = {r.record_type: r for r in warc.read_records(index).collect()}
    assert got.keys() == {"warcinfo", "request", "response", "revisit", "metadata"}
    assert (got["response"].payload, got["response"].payload_digest) == (html, hashlib.sha256(html).hexdigest())
    assert (got["revisit"].payload_digest, got["revisit"].payload_bytes, got["revisit"].refers_to) == (sha1, None, "<urn:uuid:response>")
    assert (got["request"].payload, got["metadata"].payload) == (b"", b"fetchTimeMs: 5")
    with pytest.raises(ValueError, match="damaged"):
        warc.read_member(record("response", b"HTTP/1.1 200 OK\r\n\r\nother", **http))


def test_short_payloads_stay_out_of_the_join(spark):
    pages = spark.range(4000).selectExpr("id AS page_id", "IF(id % 2 = 0, NULL, repeat('x', 200)) AS html")
    rows = warc.with_revisits(pages, "page_id", "html")
    assert rows.filter("refers_to = 1").count() == 1999 and rows.filter("html IS NULL AND refers_to IS NULL").count() == 2000
