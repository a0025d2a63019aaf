import base64
import gzip
import hashlib
import random
import time
from html.parser import HTMLParser

import pytest
from llm_data import documents
from tokenizers import Tokenizer

from monthtide.llm.frames import table
from monthtide.llm.token_counts import (
    PATTERN,
    VOCABULARY,
    encoded_length,
    encoded_lengths,
    encoding,
    length_histogram,
    length_quantiles,
    truncated_totals,
)
from monthtide.llm.warc import (
    BLOCKS,
    derivatives,
    derivatives_of,
    derived_id,
    plain_text,
    responses,
    write_warc,
)

ROWS = [(1, "Hello world"), (2, None), (3, ""), (4, "Hello world"), (None, "<|endoftext|> x"),
        (5, "é" * 3000), (6, "a" * 200_000), (7, "naïve 12345\n\n  text"), (8, " ")]


def lengths_by_hand(texts):
    other = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    other.encode_special_tokens = True
    return [len(e.ids) for e in other.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_lengths_equal_another_library(spark):
    got = encoded_lengths(documents(spark, ROWS)).select("_c0", "length").collect()
    want = lengths_by_hand([t for _, t in ROWS])
    assert sorted(map(tuple, got), key=str) == sorted(zip([i for i, _ in ROWS], want), key=str)


def test_histogram_against_every_document(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    lengths = lengths_by_hand([r.text for r in docs.select("text").collect()])
    histogram = length_histogram(docs)
    rows = histogram.collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths))
    for r in rows:
        assert r.documents == lengths.count(r.length) and r.total == sum(lengths)
        assert r.longer == sum(x > r.length for x in lengths)
        assert r.share == pytest.approx(1 - r.longer / len(lengths))
        assert r.truncated_total == sum(min(x, r.length) for x in lengths)
    limits = [0, 1, 77, 512, 10**6]
    got = {r.limit: (r.tokens, r.cut) for r in truncated_totals(histogram, limits).collect()}
    assert got == {k: (sum(min(x, k) for x in lengths), sum(x > k for x in lengths)) for k in limits}
    ordered = sorted(lengths)
    for q, length in map(tuple, length_quantiles(histogram, [0.1, 0.5, 1.0]).collect()):
        assert length == next(x for x in ordered if sum(y <= x for y in ordered) >= q * len(ordered) - 1e-9)


def test_histogram_by_group_and_of_nothing(spark):
    docs = documents(spark, [(*r, "en", ("a", None)[i % 2]) for i, r in enumerate(ROWS)])
    got = length_histogram(docs, by=["source", "keep_id"])
    assert got.columns[:3] == ["source", "keep_id", "length"]
    assert {r.source: r.total for r in got.collect()}.keys() == {"a", None}
    assert length_histogram(docs.where("false")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "x") for r in rows], "page_id long, url string, html string, record_id string"
    )


PAGES = [
    (1, "http://a.org/?q=1", '<html lang="fr"><head><title>A &amp; B\n</title><script>x("<p>")</script></head>'
     "<body><p>Été&nbsp;1<br>two <b>bo</b>ld<!-- no --><a href='/x'>link</a></body></html>"),
    (2, None, None), (3, "http://b.org/", ""), (3, "http://b.org/", ""), (None, "u", "<p>unclosed <script>all"),
    (4, "http://c.org/\r\nX: y", "text " * 50_000),
]


def test_text():
    assert plain_text(PAGES[0][2]) == "A & B\nÉté 1\ntwo boldlink"
    assert plain_text("<p>unclosed <script>all") == "unclosed"
    assert plain_text("a <!-- x") == "a" and plain_text("1 < 2 <3") == "1 < 2 <3"


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives(spark):
    source = responses(pages(spark, PAGES))
    got = derivatives(source).collect()
    assert len(got) == 2 * len(PAGES)
    of = {r.record_id: r for r in source.collect()}
    for r in got:
        head = dict(line.split(": ", 1) for line in r.headers.strip().split("\r\n"))
        assert r.refers_to in of and head["WARC-Refers-To"] == f"<{r.refers_to}>"
        assert head["WARC-Type"] == r.type and head["WARC-Record-ID"] == f"<{r.record_id}>"
        assert head["WARC-Block-Digest"] == r.block_digest == sha(r.block.encode())
        assert int(head["Content-Length"]) == len(r.block.encode())
        assert r.source_payload_digest == sha((of[r.refers_to].payload or "").encode())
        other = next(x for x in got if f"<{x.record_id}>" == head["WARC-Concurrent-To"])
        assert other.refers_to == r.refers_to and other.type != r.type
    first = next(r for r in got if r.target_uri == PAGES[0][1] and r.type == "metadata")
    for line in ("title: A & B", "language: fr", "outlink: /x", "http-status: HTTP/1.1 200 OK",
                 f"source-payload-digest: {sha(PAGES[0][2].encode())}"):
        assert line in first.block.split("\r\n")
    assert derivatives(responses(pages(spark, PAGES).where("false"))).count() == 0
    assert sorted(map(str, derivatives(source.repartition(3)).collect())) == sorted(map(str, got))


def test_files_round_trip(spark, tmp_path):
    records = derivatives(responses(pages(spark, PAGES)))
    write_warc(records, str(tmp_path / "warc"))
    found = []
    for path in (tmp_path / "warc").glob("part-*.gz"):
        data = gzip.decompress(path.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            n = int(fields["Content-Length"])
            found.append((fields["WARC-Record-ID"].strip("<>"), rest[:n].decode()))
            assert rest[n : n + 4] == b"\r\n\r\n"
            data = rest[n + 4 :]
    assert sorted(found) == sorted((r.record_id, r.block) for r in records.collect())


def test_long_runs_of_blanks_are_cut_where_the_pattern_cuts():
    coder = encoding(VOCABULARY, PATTERN)
    rng = random.Random(2)
    parts = [" "] * 6 + ["\n", "\t", "\xa0", "　", "\r", "\x1c", "a", "bc", "1", "!", "é"]
    for _ in range(5_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert encoded_length(coder, text, rng.randrange(2, 5)) == len(coder.encode_ordinary(text))
    for text in (" " * 5_000_000 + "a", "a" + " \n" * 2_500_000, " " * 5_000_000):
        assert encoded_length(coder, text) > 0


def test_long_blanks_in_a_table(spark):
    docs = documents(spark, [(1, " " * 5_000_000 + "word"), (2, "word")])
    got = {r["_c0"]: r.length for r in encoded_lengths(docs).collect()}
    assert got[2] == 1 and got[1] > 10


def test_targets_and_headers_stay_as_they_are():
    url = "http://a.com/?a=1&copy=2&reg=3  x&#65;"
    http = "HTTP/1.1 200 OK\r\nLocation: /?x=1&lt=5&amp;y\r\nX:  two  blanks\t&quot;"
    made = list(derivatives_of({
        "record_id": "urn:x", "target_uri": url + "\r\nInjected: yes", "date": None, "http_headers": http,
        "payload": "<title>A &amp; B</title><a href='/?q=1&amp;copy=2'>x</a>", "block_digest": "b", "payload_digest": "p",
    }))
    for r in made:
        assert f"WARC-Target-URI: {url}Injected: yes\r\n" in r["headers"]
        assert "\r\nInjected" not in r["headers"]
    lines = made[0]["block"].split("\r\n")
    for line in http.split("\r\n")[1:]:
        assert f"http-header: {line}" in lines
    assert "http-status: HTTP/1.1 200 OK" in lines
    assert "title: A & B" in lines and "outlink: /?q=1&copy=2" in lines


@pytest.mark.parametrize("mark", ["<a ", "<script ", "<script>", "<!--", "<title>", "<html ", "<", "<a href=\"", "</title ", "<style "])
def test_pages_of_nothing_but_open_tags(mark):
    """A megabyte; time in proportion to the page."""
    page = mark * (1_000_000 // len(mark))
    start = time.perf_counter()
    made = list(derivatives_of({
        "record_id": "urn:x", "target_uri": "", "date": None, "http_headers": "", "payload": page,
        "block_digest": "", "payload_digest": "",
    }))
    assert time.perf_counter() - start < 2 and len(made) == 2


def test_derivatives_by_another_parser(spark):
    """Texts and links of the given pages as Python's own HTML parser reads them."""

    class Reader(HTMLParser):
        def __init__(self, page):
            super().__init__(convert_charrefs=True)
            self.parts, self.links, self.skipped, self.title, self.in_title = [], [], 0, "", False
            self.feed(page)
            self.close()

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style", "template", "noscript"):
                self.skipped += 1
            elif tag in BLOCKS:
                self.parts.append("\n")
            self.in_title = tag == "title" or self.in_title
            if tag == "a" and dict(attrs).get("href"):
                self.links.append(" ".join(dict(attrs)["href"].split()))

        def handle_endtag(self, tag):
            if tag in ("script", "style", "template", "noscript"):
                self.skipped = max(0, self.skipped - 1)
            elif tag in BLOCKS:
                self.parts.append("\n")
            self.in_title = tag != "title" and self.in_title

        def handle_data(self, data):
            if not self.skipped:
                self.parts.append(data)
                self.title += data if self.in_title else ""

    source = table(spark, "/root/testdata/sf0.001", "pages")
    whole = {derived_id(r.url or "", f"response {r.page_id}"): r.html or "" for r in source.collect()}
    records = derivatives(responses(source)).collect()
    assert len(records) == 2 * source.count() >= 100
    for r in records:
        read = Reader(whole[r.refers_to])
        if r.type == "conversion":
            text = "".join(read.parts).replace("\r", "\n").replace("\xa0", " ")
            lines = [" ".join(x.split()) for x in text.split("\n")]
            assert r.block.split() == "\n".join(x for x in lines if x).split()
        else:
            fields = [x.split(": ", 1) for x in r.block.strip().split("\r\n")]
            assert [v for k, v in fields if k == "outlink"] == list(dict.fromkeys(x for x in read.links if x))
            assert [v for k, v in fields if k == "title"] == [x for x in [" ".join(read.title.split())] if x]
