import hashlib
import zlib

import pytest

from lakestrata.llm import html_text, warc

PAGES = "page_id long, url string, html string, digest string, text string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "t") for i, u, h in rows], PAGES).repartition(3)


ARTICLE = "<p>One sentence, with a comma. And another one; longer than the first.</p><p>More of it, to be sure.</p>"


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain  text", "plain text"), ("<br>", ""),
    (f"<body><nav><ul><li>A</li></ul></nav><article><h1>T &amp; U</h1>{ARTICLE}</article><footer>(c)</footer></body>",
     "T & U\nOne sentence, with a comma. And another one; longer than the first.\nMore of it, to be sure."),
    (f'<script>var t="</p>";</script><style>p{{}}</style><main>{ARTICLE}<div class="comments"><p>No, no.</p></div></main>',
     "One sentence, with a comma. And another one; longer than the first.\nMore of it, to be sure."),
    ("<article><p><b>bold<br><p>next&nbsp;one\n two<!-- no --></article>", "bold\nnext one two"),
    (f'<div class="sidebar"><p>Links, and more, and so on.</p></div><div id=c>{ARTICLE}<form><p>Mail, please.</p></form></div>',
     "One sentence, with a comma. And another one; longer than the first.\nMore of it, to be sure."),
    (f"<article>{ARTICLE}<p>&lt;b&gt; &#233;&#x4e;", "One sentence, with a comma. And another one; longer than the first.\n"
     "More of it, to be sure.\n<b> éN"),
    ("<p>a <span class='ad'>BUY</span> b, c.</p></div></p>", "a b, c."),
    ("<table><tr><td>x, y.<td>z, w.<tr><td>v, u.</table>", "x, y.\nz, w.\nv, u."),
    ("<p title=\"a>b\">quoted, attribute.</p>", "quoted, attribute."),
    ("<script>never closed <p>x", ""),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = "A long sentence of the first part, with commas, and with more of them, so it goes on and on. " * 6
REST = "The shorter rest, with a comma. It belongs to the text, too, as nothing tells otherwise."


@pytest.mark.parametrize(("page", "texts"), [
    (f"<body><div><section><p>{LONG}</p><p>{LONG}</p></section><section><h2>Rest</h2><p>{REST}</p><ul><li>one</ul></section></div>"
     "<footer><p>(c), all rights.</p></footer></body>", [LONG, LONG, "Rest", REST, "one"]),
    (f"<body><div><p>{REST}</p><div class=body><p>{LONG}</p><p>{LONG}</p></div></div></body>", [REST, LONG, LONG]),
    (f"<body><div><p>{LONG}</p><p>{LONG}</p></div><h2>Rest</h2><div><p>{REST}</p><blockquote>said</blockquote></div>"
     f"<div class=sidebar><p>{REST}</p></div></body>", [LONG, LONG, "Rest", REST, "said"]),
])
def test_sibling_parts_without_an_article_stay(page, texts):
    assert html_text.main_text(page).split("\n") == [" ".join(t.split()) for t in texts]


def test_extraction_row_by_row(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>"), (1, "u", None), (None, None, ""), (2, "v", "<p>" + "w, " * 50000)]
    out = html_text.with_main_text(pages(spark, rows)).collect()
    assert sorted(len(r["__main"]) for r in out) == [0, 0, 91, 149999]
    assert {r.digest for r in out} == {"d"} and html_text.with_main_text(pages(spark, [])).count() == 0


def test_archives_come_back_whole(spark, tmp_path):
    long = "<p>" + "é" * 60
    rows = [(5, "http://x/ü\n", long), (3, None, long), (None, "n", long), (3, "again", long), (9, "s", "short"), (7, "s", "short"),
            (1, "e", None), (2, "e", ""), (11, "big", "x" * 300_000)] + [(100 + i, f"u{i}", f"<p>page {i} of many</p>" * 40)
                                                                     for i in range(60)]
    manifest = warc.write(pages(spark, rows), str(tmp_path), archive_bytes=20_000)
    assert manifest.count() > 3
    got = warc.read(manifest, str(tmp_path), payloads=True).collect()
    assert len(got) == len(rows)
    want = sorted(((i, hashlib.sha256((h or "").encode()).hexdigest(), len((h or "").encode())) for i, _, h in rows), key=str)
    assert sorted(((r.page_id, r.payload_digest, r.payload_bytes) for r in got), key=str) == want
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got if r.payload_digest == hashlib.sha256(long.encode()).hexdigest()}
    assert kinds == {(3, "response", None), (5, "revisit", 3), (None, "revisit", 3)}
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)
    texts = {i: (h or "") for i, _, h in rows}
    assert all(r.payload.decode() == texts[r.page_id] for r in got if r.record_type == "response")


def test_an_archive_starts_with_its_dictionary():
    records = [warc.record(i, "u", (f"<html><body><p>{i}</p>" + "shared words " * 30).encode(), "d" * 64, None) for i in range(200)]
    archive = warc.pack(records)
    assert int.from_bytes(archive[:4], "little") == warc.SKIPPABLE
    blocks = [b for _, b in warc.unpack(archive)]
    assert len(blocks) == 200 and blocks[7].endswith(b"shared words ")
    assert len(archive) < len(zlib.compress(b"".join(records))) * 20
    assert [b for _, b in warc.unpack(warc.pack(records[:1]))] == blocks[:1] and warc.pack([]) == b""


def test_small_archives_have_a_dictionary_too(spark, tmp_path):
    small = [warc.record(i, "u", b"<p>few</p>", "d" * 64, None) for i in range(3)]
    archive = warc.pack(small)
    assert int.from_bytes(archive[:4], "little") == warc.SKIPPABLE
    assert [b[-10:] for _, b in warc.unpack(archive)] == [b"<p>few</p>"] * 3
    manifest = warc.write(pages(spark, [(i, "u", f"<p>{i}</p>") for i in range(6)]), str(tmp_path))
    assert {r.trained for r in manifest.collect()} == {False} and warc.read(manifest, str(tmp_path)).count() == 6


def test_damage_is_seen(spark):
    record = warc.record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    (head, block), = warc.unpack(warc.pack([record]))
    with pytest.raises(ValueError, match="damaged"):
        warc._row(head, block, "a", False)


def test_an_empty_table_gives_no_archive(spark, tmp_path):
    manifest = warc.write(pages(spark, []), str(tmp_path))
    assert manifest.count() == 0 and warc.read(manifest, str(tmp_path)).count() == 0
