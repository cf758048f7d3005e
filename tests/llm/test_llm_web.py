"""WARC archives, page text and mixing."""

import base64
import hashlib
import io
import re
import struct
from fractions import Fraction

import pyarrow.fs
import pytest
import zstandard

from greenledger.llm import common, html_extract, mixing, warc

PAGES = [(1, "http://a/x y\r\nz", "<p>" + "same " * 400), (2, None, "<p>" + "same " * 400), (3, "u", None), (4, "u", ""),
         (5, "u", "é" * 500), (6, "v", "é" * 500), (7, "u", "small"), (8, "u", "small"), (9, "u", "<p>" + "same " * 400),
         (9, "u", "<p>" + "same " * 400), (None, "u", "<p>" + "same " * 400), (10, "u", "x" * 200000), (None, "n", "y" * 999)]


@pytest.fixture(scope="module")
def pages(spark):
    from pyspark.sql import functions as F

    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("payload", "size", "same", "kept", "refers_to")})


def test_archive_pages(pages):
    got = warc.archive_pages(pages(PAGES), payloads=True).collect()
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        top = max((j for j, _, h in PAGES if (h or "").encode() == raw and j is not None), default=None)
        revisit = len(raw) >= 1000 and i != top
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                     top if revisit else None))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert {r.url for r in got if r.page_id == 1} == {"http://a/x%20y%0D%0Az"} and {r.url for r in got if r.page_id == 2} == {None}
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
    assert warc.archive_pages(pages([])).collect() == []


def test_records_are_frames_of_their_own(spark, pages):
    folder = common.scratch(spark, "warc-test")
    rows = [(i, f"http://h/{i}", f"<html><body><p>page {i} " + "lorem ipsum dolor " * 30) for i in range(300)]
    manifest = warc.write_archives(warc.revisits(pages(rows)), folder).collect()
    assert sum(r.records for r in manifest) == 300
    fs, at = warc.place(folder)
    seen = 0
    for r in manifest:
        raw = fs.open_input_stream(f"{at}/{r.archive}", compression=None).read()
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D
        known = zstandard.ZstdCompressionDict(raw[8:8 + size])
        rest = raw[8 + size:]
        while rest:
            one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            rec = one.decompress(rest)
            assert rec.startswith(b"WARC/1.1\r\n") and rec.endswith(b"\r\n\r\n")
            rest = one.unused_data
            seen += 1
        assert len(raw) < 300 * 600
    assert seen == 300


def test_a_cut_archive_is_found(spark, pages):
    folder = common.scratch(spark, "warc-cut")
    manifest = warc.write_archives(warc.revisits(pages([(1, "u", "payload " * 99)])), folder)
    fs, at = warc.place(folder)
    name = manifest.first().archive
    raw = fs.open_input_stream(f"{at}/{name}", compression=None).read()
    with fs.open_output_stream(f"{at}/{name}", compression=None) as out:
        out.write(raw[:-3])
    with pytest.raises(Exception, match="has 0 whole records of 1"):
        warc.read_archives(manifest, folder).collect()


def test_damage_is_found():
    out = io.BytesIO()
    out.close = lambda: None
    writer = warc.ArchiveWriter(out)
    writer.add(warc.record(1, "u", b"payload", None))
    writer.close()
    raw = out.getvalue()
    (head, http, payload), = warc.read_archive(io.BytesIO(raw))
    assert payload == b"payload" and http["content-length"] == "7"
    assert base64.b32decode(head["warc-payload-digest"][5:]) == hashlib.sha1(b"payload").digest()
    assert len(list(warc.read_archive(io.BytesIO(raw[:-3])))) == 0  # found by the count in the manifest
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(b"\0" * 40)))
    assert isinstance(warc.place("file:///tmp")[0], pyarrow.fs.LocalFileSystem)


# --- page text --------------------------------------------------------------

def test_article_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>x";</script></head>
    <body class="post"><header><p>Site name</p></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><!-- <p>no</p> -->
    <div class="cookie-notice"><p>We use cookies on this site, please accept them all to go on.</p></div>
    <article><h1>Head &amp; line</h1><p>First   para<b>graph</b>,&nbsp;with <a href="x>y">a link</a>.<br>Same block
    <p>Short.</p><div class="ad">Buy now</div><ul><li>one</li><li>two</li></ul>
    <aside>Beside</aside><form>Name <input></form><div id="comments"><p>A reader says something quite long here.</p></div>
    <p hidden>unseen</p></article><aside><p>Related things</p></aside><footer>&copy; me</footer></body></html>"""
    assert html_extract.main_text(page, html_extract.train()) == \
        "Head & line\nFirst paragraph, with a link. Same block\nShort.\none\ntwo"


def test_pages_without_marks_go_by_words_and_links():
    long = "This is running text of an article that goes on for a good number of words and has no links in it at all, " * 2
    page = f"<body><div><a href=1>One</a></div><div><a href=2>Two</a></div><p>{long}</p><p>{long}</p>" \
           "<div><a href=3>Three</a></div><div><a href=4>Four</a></div>"
    text = " ".join(long.split())
    assert html_extract.main_text(page, html_extract.train()) == f"{text}\n{text}"


def test_odd_pages():
    tree = html_extract.train()
    for page in ("", "<", "<p", "<article><p>x &am", "</p></article>", "<article><p a='>x", "<!--", "<script>", "a < b"):
        html_extract.main_text(page, tree)
    assert html_extract.main_text("<article><p>x &am", tree) == "x &am"
    assert html_extract.main_text("<article>one<p>two<a href=", tree) == "one\ntwo"
    assert html_extract.main_text("<article><p>" + "w " * 100000 + "</p></article>", tree) == " ".join(["w"] * 100000)
    deep = "<article>" + "<div>" * 5000 + "<p>x</p>"
    assert html_extract.main_text(deep, tree) == "x"


@pytest.mark.parametrize("tag", ['<p class=lead">', "<p title=it's>", '<p "x>', "<p class='a' '>", '<p class="a>b" id=c>',
                                 "<p title=a='b>", "<p title = 'a > b'>", '<p class="lead>'])
def test_a_stray_quote_ends_with_its_tag(tag):
    page = f"<article>{tag}Text one</p><p>don't stop</p><p>Last</p></article><footer>me</footer>"
    assert html_extract.main_text(page, html_extract.train()) == "Text one\ndon't stop\nLast"


LONG = " ".join(["This is running text of an article that goes on for a good number of words and has no links in it."] * 2)


@pytest.mark.parametrize("tag", ['div class="overflow-hidden"', 'div style="overflow:hidden"', 'div class="md:hidden x"',
                                 'div title="hidden gems"', 'div class="post has-sidebar"', 'main class="with-sidebar"',
                                 'div data-x="display:none"', 'div class="has-sidebar"', 'body class="overflow-hidden"'])
def test_a_word_in_an_attribute_does_not_empty_the_page(tag):
    page = f"<html><{tag}><p>{LONG}</p><p>{LONG}</p></{tag.split()[0]}><nav><a href=1>One</a></nav></html>"
    assert html_extract.main_text(page, html_extract.train()) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("tag", ["div hidden", 'div hidden=""', 'div style="color:red; display: none"', 'div aria-hidden="true"',
                                 'div class="sidebar"', 'div class="x cookie-notice"', "div id=comments", 'div role="navigation"'])
def test_marked_and_hidden_parts_are_not_the_article(tag):
    page = f"<article><p>{LONG}</p><{tag}><p>{LONG} Not this.</p></div></article>"
    assert html_extract.main_text(page, html_extract.train()) == LONG


def test_the_labelled_table_is_learned():
    tree = html_extract.train()
    for *row, label in html_extract.LABELLED:
        x = [float(v) / (100 if i in (1, 3, 5) else 1) for i, v in enumerate(row)]
        assert html_extract.is_article(tree, x) == bool(label)


def test_extract_text(spark, pages, small):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article>t</article>"), (3, "u", "<nav>n</nav>"), (3, "u", "<nav>n</nav>")]
    got = html_extract.extract_text(pages(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "u", "t", 1), (3, "u", "", 0), (3, "u", "", 0)], key=repr)
    assert html_extract.extract_text(pages([])).collect() == []
    table = small("pages")
    found = {r.page_id: r.text for r in html_extract.extract_text(table).collect()}
    for r in table.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[a-z/][^>]*\Z", "", inner.replace("<br>", " ").replace("<b>", "")))
        import html
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert found[r.page_id] == "\n".join(p for p in want if p)


# --- mixing -----------------------------------------------------------------

@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 1.5, "d": 0.01}, {str(i): i + 1 for i in range(40)},
                                     {"a": 0, "b": 2}])
def test_the_schedule_stays_within_a_block(weights):
    shares = mixing.whole_shares(weights, 100)
    order = mixing.schedule(shares)
    assert sum(shares.values()) == len(order) == max(100, len(weights)) and min(shares.values()) >= 1
    done = dict.fromkeys(shares, 0)
    for t, s in enumerate(order * 2, 1):
        done[s] += 1
        assert all(abs(done[k] - Fraction(t * shares[k], len(order))) < 1 for k in shares)


def test_weights_must_make_sense():
    with pytest.raises(ValueError):
        mixing.whole_shares({"a": -1, "b": 2}, 10)
    with pytest.raises(ValueError):
        mixing.whole_shares({"a": 0}, 10)


def mix_brute(rows, shares, block):
    """Places by asking in every slot which source's next block is due and due first."""
    left = {s: [i for i, t in rows if t == s] for s in shares}
    cycle, places, slot = sum(shares.values()), {}, 0
    taken = dict.fromkeys(shares, 0)  # blocks
    while any(taken[s] * block < len(left[s]) for s in shares):
        due = [(-(-(taken[s] + 1) * cycle // shares[s]), s) for s in shares
               if taken[s] * block < len(left[s]) and taken[s] * cycle // shares[s] <= slot]
        if due:
            s = min(due)[1]
            for k in range(taken[s] * block, min((taken[s] + 1) * block, len(left[s]))):
                places[s, k] = slot * block + k - taken[s] * block
            taken[s] += 1
        slot += 1
    return places


def test_a_source_that_runs_out_moves_no_other_off_its_target():
    shares = {"a": 500, "b": 300, "c": 1, "d": 199}
    blocks = {"a": 3, "b": 40, "c": 5, "d": 100}
    slots = {}
    for slot, s, i in mixing.walk(shares, blocks):
        slots.setdefault(s, []).append(slot)
        assert i * 1000 // shares[s] <= slot < -(-(i + 1) * 1000 // shares[s])  # from its release to its deadline
    assert {s: len(x) for s, x in slots.items()} == blocks
    assert len({x for xs in slots.values() for x in xs}) == sum(blocks.values())
    assert max(slots["c"]) >= 4000  # far more empty slots than blocks, and no allowance for them
    assert next(mixing.walk({"a": 10**12, "b": 1}, {"a": 0, "b": 2})) == (0, "b", 0)


def test_mix_sources(spark, documents):
    rows = [(i, "t", "big" if i % 3 else "mid") for i in range(300)] + [(400, "t", None), (401, "t", ""), (400, "t", None)]
    rows += [(None, "t", "big"), (1, "t", "big")]
    got = mixing.mix_sources(documents(rows), block=4, cycle=10).collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(i or -1 for i, _, _ in rows)
    shares = {("=" + r.source if r.source is not None else ""): r.share for r in got}
    want = mix_brute([(i, "=" + s if s is not None else "") for i, _, s in rows], shares, 4)
    by = {}
    for r in got:
        by.setdefault("=" + r.source if r.source is not None else "", []).append(r.place)
    for s, places in by.items():
        assert sorted(places) == sorted(p for (t, _), p in want.items() if t == s)
    assert len({r.place for r in got}) == len(got)
    assert mixing.mix_sources(documents([])).collect() == []


def test_weights_are_met_until_a_source_runs_out(documents):
    rows = [(i, "t", "a" if i < 500 else "b") for i in range(1000)]
    got = sorted(mixing.mix_sources(documents(rows), {"a": 3, "b": 1}, block=5, cycle=8).collect(), key=lambda r: r.place)
    first = [r.source for r in got[:400]]
    assert 295 <= first.count("a") <= 305
    assert [r.doc_id for r in got] != sorted(r.doc_id for r in got)


def test_in_order(documents):
    df = documents([(i, str(i), "a" if i % 4 else "b") for i in range(100)])
    place = {r.doc_id: r.place for r in mixing.mix_sources(df).collect()}
    got = mixing.in_order(df)
    assert got.columns == df.columns
    assert [place[r.doc_id] for r in got.collect()] == sorted(place.values())


@pytest.mark.parametrize("weights", [{"hot": 0.5} | {f"s{i}": 0.5 / 999 for i in range(999)}, {"a": 0.33, "b": 0.67},
                                     {"hot": 0.5} | {f"s{i}": 0.5 / 99 for i in range(99)}, {"a": 1, "b": 1e-6}])
def test_targets_are_met_over_the_whole_run(weights):
    blocks = {s: max(1, int(3000 * w)) for s, w in weights.items()}
    shares = mixing.run_shares(weights, blocks, mixing.CYCLE)
    total, done, filled = sum(map(Fraction, weights.values())), dict.fromkeys(weights, 0), []
    for slot, s, i in mixing.walk(shares, blocks):
        assert i == done[s]
        due = slot * Fraction(weights[s]) / total
        assert i - due < 1 + 2 / mixing.FINE and due - i < 1 + 2 / mixing.FINE, s
        done[s] += 1
        filled.append(slot)
    assert done == blocks and filled == sorted(set(filled))


def test_a_hot_source_among_many_has_its_weight(documents):
    rows = [(i, "t", "hot" if i < 1500 else f"s{i % 1500}") for i in range(3000)]
    got = mixing.mix_sources(documents(rows), {"hot": 0.5} | {f"s{i}": 0.5 / 1500 for i in range(1500)}, block=1).collect()
    first = sorted(got, key=lambda r: r.place)[:1000]
    assert 490 <= sum(r.source == "hot" for r in first) <= 510
