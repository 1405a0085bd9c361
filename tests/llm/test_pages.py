"""Web archives, shards and main text."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections import Counter
from pathlib import Path

import pytest

from laborlake.llm import html_extract, sharding, warc
from laborlake.llm.queries import op3_warc, op5_sharding, op6_html_extraction


def test_every_payload_comes_back(spark, odd, tmp_path):
    pages = spark.read.parquet(f"{odd}/pages.parquet")
    records = warc.archive_pages(pages, str(tmp_path)).collect()
    rows = pages.collect()
    payloads = [(r.html or "").encode() for r in rows]
    largest = {}
    for r, p in zip(rows, payloads, strict=True):
        if len(p) >= warc.REVISIT_BYTES and r.page_id is not None:
            largest[p] = max(largest.get(p, r.page_id), r.page_id)
    want, repeated = Counter(), Counter(payloads)
    for r, p in zip(rows, payloads, strict=True):
        revisit = repeated[p] > 1 and p in largest and largest[p] != r.page_id
        want[(r.page_id, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", largest[p] if revisit else None, None if revisit else p)] += 1
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in records)
    assert got == want

    raw = sorted(Path(tmp_path, "raw").glob("*.warc.gz"))
    assert raw and all(x.name.count(".") == 2 for x in raw)
    for path in raw:  # one member before, one for each record after; the same bytes
        assert _members(path.read_bytes()) == 1
        again = Path(tmp_path, "members", path.name).read_bytes()
        assert gzip.decompress(again) == gzip.decompress(path.read_bytes())
        places = [line for line in Path(tmp_path, "index", f"{path.name}.jsonl").read_text().splitlines() if line]
        assert len(places) == (_members(again) if again else 0)


def _members(data: bytes) -> int:
    n = 0
    while data:
        unzip = zlib.decompressobj(warc.GZIP)
        unzip.decompress(data)
        data, n = unzip.unused_data, n + 1
    return n


def test_damaged_records_are_refused():
    record = warc.encode_record(1, "http://h/", "<p>x</p>", hashlib.sha1(b"<p>x</p>").hexdigest(), None)
    assert warc.decode_record(record)[:5] == (1, "http://h/", 8, hashlib.sha1(b"<p>x</p>").hexdigest(), "response")
    with pytest.raises(ValueError, match="digest"):
        warc.decode_record(record.replace(b"<p>x", b"<p>y"))
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.split_records(iter([record[:-9]])))
    assert list(warc.split_records(iter([(record * 3)[i : i + 7] for i in range(0, 3 * len(record), 7)]))) == [record] * 3


def test_cut_off_streams_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(gzip.compress(b"a" * 10_000)[:-12])
    with open(tmp_path / "x", "rb") as source, pytest.raises(ValueError, match="cut off"):
        list(warc.inflate(source))


def test_members_one_after_the_other_inflate(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 11)
    (tmp_path / "x").write_bytes(gzip.compress(b"abc" * 50) + gzip.compress(b"") + gzip.compress(b"def"))
    with open(tmp_path / "x", "rb") as source:
        assert b"".join(warc.inflate(source)) == b"abc" * 50 + b"def"


def test_digest_columns(spark, odd):
    assert op3_warc(spark, odd).columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_shards_of_odd_documents(spark, odd):
    rows = op5_sharding(spark, odd).collect()
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    check_shards(rows, 40)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def check_shards(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    ids, total, largest = [], sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for shard in sorted(by):
        inside = sorted(by[shard], key=lambda r: r.slot)
        assert [r.slot for r in inside] == list(range(len(inside)))
        ids += [-1 if r.doc_id is None else r.doc_id for r in inside]
        assert abs(sum(r["size"] for r in inside) - total / shards) <= largest
    assert ids == sorted(ids)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_one_id_with_a_third_of_all_rows(spark, shards):
    rows = [(7 if i % 3 == 0 else i, "x" * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_shards(sharding.shard_by_bytes(docs, shards).collect(), shards)


def test_shards_are_written(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{odd}/documents.parquet").drop("shard")
    sharding.write_shards(docs, 4, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").drop("shard").select(*[f"`{c}`" for c in docs.columns])
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, docs.collect()))


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu entry</a></li></ul></nav><!-- ad 1 --><div class="ad">buy this</div>
<article><h1>The head of it</h1><p><b>A first line, that is bold.<br><p>Some   text &amp; more,
which goes on for quite a while; so it is plainly what the page is about.</p><p>Another one, as long as the one before it, with
commas, and a caf&eacute; &#8212; and so on.</p></article><footer>&copy; nobody</footer></body></html>"""


def test_main_text(spark, save):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()
    folder = save(pages=[tuple(r) for r in given] + [(9000, "u", PAGE), (9001, "u", None), (9002, "u", "plain &lt; text\n only")])
    rows = {r.page_id: r for r in op6_html_extraction(spark, folder).collect()}
    assert rows[9000].text == (
        "The head of it\nA first line, that is bold.\nSome text & more, which goes on for quite a while; so it is plainly"
        " what the page is about.\nAnother one, as long as the one before it, with commas, and a café — and so on."
    )
    assert (rows[9001].text, rows[9001].n_chars, rows[9002].text) == ("", 0, "plain < text only")
    same = 0
    for r in given:
        article = html_extract.Node("root")
        inside = r.html[r.html.index("<article>") : (r.html + "</article>").index("</article>")]
        nodes = html_extract._with_text_nodes(html_extract.parse(inside))
        article = "\n".join(b for n in nodes if html_extract._is_leaf(n) and (b := html_extract._block(n)))
        same += rows[r.page_id].text == article
        assert rows[r.page_id].n_chars == len(rows[r.page_id].text)
    assert same >= 0.95 * len(given)


def test_odd_pages_have_a_text(spark, odd):
    rows = op6_html_extraction(spark, odd).collect()
    assert len(rows) == spark.read.parquet(f"{odd}/pages.parquet").count() and all(r.text is not None for r in rows)


def test_choices_never_contradict():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(30):
        nodes = html_extract._with_text_nodes(html_extract.parse("<div><p>a</p><div><p>b</p><p>c</p></div></div><ul><li>d<li>e</ul>"))
        margins, weights = rng.normal(0, 3, len(nodes)), html_extract._sizes(nodes)
        chosen = html_extract.decode(nodes, margins, weights)
        place = {id(n): i for i, n in enumerate(nodes)}
        for i, node in enumerate(nodes[1:], 1):
            assert not chosen[place[id(node.parent)]] or chosen[i]


CARDS = "<html><body><main><article><p>one card</p></article><article><p>another card</p></article></main><p>foot</p></body></html>"


def test_pages_mark_their_article_in_many_ways():
    nodes = lambda page: html_extract._with_text_nodes(html_extract.parse(page))
    assert html_extract.marked(nodes("<main><h1>x</h1><article><p>y</p><article>note</article></article></main>")).tag == "article"
    assert html_extract.marked(nodes(CARDS)).tag == "main"
    assert html_extract.marked(nodes("<div><p>x</p></div>")) is None
    named = html_extract.marked(nodes("<div class='box'>a</div><div class='big content'><p>x</p></div>"), 1)
    assert named.attributes.strip() == "class='big content'"
    for page in ("<main><article><p>a text</p></article></main>", CARDS):
        assert set(html_extract.labelled_nodes(page, 1)[1].tolist()) == {0, 1}


def test_sample_is_drawn_among_pages_that_pass(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "TRAINING_PAGES", 4)
    cards = CARDS.replace("main>", "div>")
    rows = [(i, cards) for i in range(300)] + [(1000 + i, "<main><article><p>text</p></article></main>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = [r.html for r in html_extract.sampled(pages).collect()]
    assert got == [rows[-1][1]] * 4
    assert html_extract.sampled(spark.createDataFrame(rows[:300], pages.schema)).count() == 0


@pytest.mark.parametrize("name", ["button", "select", "object", "svg", "template"])
def test_unclosed_elements_end_at_the_next_block(name):
    def text(page):
        return [b for n in html_extract._with_text_nodes(html_extract.parse(page)) if html_extract._is_leaf(n) and (b := html_extract._block(n))]

    assert text(f"<div><p>before</p><{name}>label</div><p>after</p>") == ["before", "after"]
    assert text(f"<p>a <{name}>label</{name}> b</p><p>c</p>") == ["a b", "c"]
    if name in ("button", "select"):
        assert text(f"<div><{name}>x</div><p>after</p><{name}>y</{name}><p>end</p>") == ["after", "end"]
    assert text("<p>sum <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> here</p>") == ["sum x=1 here"]
