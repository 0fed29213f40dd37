"""Operators by themselves: indexes, filters, decoding, templates, bins, schedules, components."""

from __future__ import annotations

import base64
import bz2
import gzip
import itertools
import lzma
import random
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from weftmill.llm import dedup, html, langid, lm, mixing, packing, quality, secrets, simhash, texts
from weftmill.llm.components import connected_components

SECRET = "token = abcdefgh12345678"


def key(i):
    import hashlib

    return hashlib.sha256(str(i).encode()).digest()


def test_cuckoo_index_against_a_dict():
    """Insertions, deletions and hits at random; it starts with two buckets, so it overflows often."""
    rng, index, known = random.Random(5), dedup.CuckooIndex(2), {}
    for _ in range(20_000):
        k = key(rng.randrange(3000))
        if rng.random() < 0.4:
            assert index.delete(k) == (known.pop(k, None) is not None)
        elif k not in known:
            known[k] = rng.random()
            index.insert(k, known[k])
        assert index.get(k) == known.get(k)
    assert dict(index.items()) == known and index.size == len(known)


def test_update_index_deletes_and_inserts(spark):
    rows = lambda ids: spark.createDataFrame([(i, key(i % 10)) for i in ids], "doc_id long, digest binary")
    first = dedup.update_index(None, rows(range(30)), shards=3)
    gone = spark.createDataFrame([(key(0),), (key(77),)], "digest binary")
    second = dedup.update_index(first, rows([100, 101]), gone, shards=3)
    found = {bytes(r["digest"]): (r["keep_id"], r["group_size"]) for r in second.collect()}
    expected = {key(k): (20 + k, 3) for k in range(2, 10)} | {key(0): (100, 1), key(1): (101, 4)}
    assert found == expected


def test_drop_duplicates_keeps_one_whole_row(spark, odd_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    kept = dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    texts_kept = [r["text"] or "" for r in kept.collect()]
    assert len(texts_kept) == len(set(texts_kept)) == len({r["text"] or "" for r in docs.collect()})


@pytest.mark.parametrize("segment_bytes", [1 << 30, 2000])
def test_language_model_in_segments(spark, sf_dir, monkeypatch, segment_bytes):
    """Scores don't depend on how the filter is cut."""
    monkeypatch.setattr(lm, "SHARD_BYTES", 60_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = lm.train(docs, order=3, segment_bytes=segment_bytes)
    assert (len(model.segments) > 1) == (segment_bytes == 2000)
    found = lm.score(docs.filter("doc_id < 30"), model, carry=[F.col("doc_id")]).orderBy("doc_id").toPandas()
    whole = lm.score(docs.filter("doc_id < 30"), lm.train(docs, order=3), carry=[F.col("doc_id")]).orderBy("doc_id").toPandas()
    for column in ("n_tokens", "n_known", "base_score", "score"):
        assert np.allclose(found[column], whole[column])


def test_filter_levels_never_fall_short():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    counts = rng.zipf(1.5, len(keys)).clip(max=10**9)
    rows = pa.table({
        "shard": pa.array([0], pa.int32()), "is_word": [False],
        "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([counts.astype("<u4").tobytes()], pa.binary()),
    })
    built = lm._build_shard(rows).to_pylist()
    segment = lm.Segment(built, 0, 1, 0)
    levels = segment.levels(keys)
    true = np.searchsorted(lm.LEVELS, counts, "right")
    assert (levels >= true).all() and (levels == true).mean() > 0.95
    other = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    assert (segment.levels(other) > 0).mean() < 0.05


def test_probabilities_sum_to_at_most_one():
    """Exact levels of a small corpus: over all words after a context."""
    texts_ = pa.array(["a b a c", "a b", "b c c a b"])
    tokens, first = lm._tokens(texts_)
    keys = lm._ngrams(tokens, first, 2)
    words = np.unique(tokens)
    level_of = [dict(zip(k.tolist(), np.searchsorted(lm.LEVELS, n, "right"))) for k, n in (np.unique(k, return_counts=True) for k in keys)]
    total = 0.0
    for w in words:
        pair = np.array([tokens[0], w], np.uint64)
        ks = lm._ngrams(pair, np.array([0, 2]), 2)
        levels = [np.array([level_of[n].get(k, 0) for k in ks[n].tolist()]) for n in range(2)]
        total += 10 ** lm.log_probabilities(levels, np.array([0, 2]), 3, len(tokens), len(words))[1]
    assert total <= 1


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: quote(s, safe=""),
        lambda s: "".join(f"%{b:02X}" for b in s.encode()),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: "".join(f"\\x{b:02x}" for b in s.encode()),
        lambda s: "".join(f"&#{ord(c)};" for c in s),
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
        lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
        lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
        lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
        lambda s: base64.b64encode(zstandard.compress(s.encode())).decode(),
        lambda s: quote(base64.b64encode(base64.b64encode(s.encode())).decode(), safe=""),
        lambda s: base64.b64encode(gzip.compress(quote(s, safe="").encode())).decode(),
    ],
)
def test_secret_behind_layers(wrap):
    packed = wrap(SECRET)
    text = f"é some words <{packed}> and more"
    spans, complete = secrets.find(text)
    assert complete
    inner = [(a, b) for a, kind, b, depth in spans if depth > 0 and kind == 0]
    begin, end = text.index(packed), text.index(packed) + len(packed)
    assert any(begin <= a and b <= end and b - a >= 0.8 * len(packed) for a, b in inner)


def test_spans_of_a_part_of_a_layer():
    """Only the part of the base64 data that holds the secret is marked, to within a group."""
    inner = "some plain words before it " + SECRET + " and after it"
    packed = base64.b64encode(inner.encode()).decode()
    (a, kind, b, depth), = secrets.find("x " + packed)[0]
    at = 2 + inner.index(SECRET) * 4 // 3
    assert (kind, depth) == (0, 1) and abs(a - at) <= 3 and abs(b - (at + len(SECRET) * 4 // 3)) <= 4


def test_decoding_ends_on_cycles_and_bombs(monkeypatch):
    assert secrets.find("%2525252525252525%25" * 50)[1]
    bomb = base64.b64encode(zlib.compress(b"z" * 1_000_000)).decode()
    assert secrets.find(bomb + " " + SECRET)[1]
    monkeypatch.setattr(secrets, "MAX_SCANNED", 10_000)
    spans, complete = secrets.find(bomb + " " + SECRET)
    assert not complete and [s[3] for s in spans] == [0]


def test_data_that_inflates_to_itself(monkeypatch):
    """A stream whose content is the stream again."""

    class Same(secrets.Inflated):
        def parts(self):
            yield bytes(self.data)

    monkeypatch.setattr(secrets, "Inflated", Same)
    assert secrets.find(base64.b64encode(gzip.compress(b"x" * 100)).decode())[1]


def test_deep_nesting():
    """1,200 compressed layers of one another in a text of some 40,000 characters."""
    data = SECRET.encode()
    for _ in range(1200):
        data = gzip.compress(data, mtime=0)
    spans, complete = secrets.find("x " + base64.b64encode(data).decode())
    assert complete and [(s[1], s[3] > 1200) for s in spans] == [(0, True)]


@pytest.mark.parametrize("window", [4096, 1 << 20])
def test_windows_of_inflated_data(monkeypatch, window):
    """Secrets at any place of a stream that is longer than a window, plain and encoded once more."""
    monkeypatch.setattr(secrets, "WINDOW", window)
    monkeypatch.setattr(secrets, "OVERLAP", window // 4)
    for at in (0, 100, 4000, 4090, 5100, 9000, 99_000):
        for inner in (SECRET, base64.b64encode(gzip.compress(SECRET.encode())).decode()):
            text = ("words and words " * 10_000)[:at] + " " + inner + " " + "wörter " * 15_000
            for pack in (gzip.compress, bz2.compress, lzma.compress, zstandard.compress):
                spans, complete = secrets.find(base64.b64encode(pack(text.encode())).decode())
                assert complete and 0 in {s[1] for s in spans}, (at, inner, pack)


MEASURE = """
import base64, resource, sys
sys.path.insert(0, {root!r})
from weftmill.llm import secrets
import zstandard
{make}
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
spans, complete = secrets.find(text)
assert complete, "not complete"
assert {n} <= len(spans), spans[:3]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
ZSTD = """
tool = zstandard.ZstdCompressor(write_content_size=False).compressobj()
block = b"a" * (1 << 20)
data = b"".join(tool.compress(block) for _ in range(400)) + tool.compress(b" password = abcdefgh1234 ") + tool.flush()
text = "x " + base64.b64encode(data).decode()
"""
LONG_TEXT = """text = "some words %41 and &#39; more, of which there are many " * 100_000 + "password = abcdefgh1234 " + "ordinary words " * 1_800_000"""


@pytest.mark.parametrize("make, megabytes", [(ZSTD, 600), (LONG_TEXT, 400)], ids=["zstd", "text"])
def test_memory_is_bounded(make, megabytes):
    """400 MB out of some kilobytes, and a text of 32 MB with 200,000 escapes."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = MEASURE.format(root=root, make=make, n=1)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout) < megabytes


def test_prose_is_no_secret():
    prose = "An ordinary sentence with a_rather_long_identifier_name_in_it and https://example.org/some/very/long/path/segment"
    assert secrets.find(prose) == ([], True)


PAGE = """<!doctype html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<div class="box"><p>Site wide box</p></div><div class="sidebar">side</div><div id="text"><h2>Head {i}</h2>
<p>Para &lt;{i}&gt; one<br>more <b>bold</p><p>Second</div><div class="comments"><p>Nice!</p></div>
<div><p>Footer links</p></div><footer>x</footer></body></html>"""


def test_site_template_without_article(spark):
    rows = [(i, f"https://Site.org:80/{i}", PAGE.replace("{i}", str(i))) for i in range(8)]
    rows += [(100 + i, f"https://other{i}.org/", PAGE.replace("{i}", "0")) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html.main_text(pages).collect()}
    # "Second" is a subtree of its own on every page of the host: without an article it counts as template.
    assert found[3] == "Head 3\nPara <3> one more bold"
    # Seen on too few pages of its host: nothing to compare with.
    assert found[101] == "Site wide box\nHead 0\nPara <0> one more bold\nSecond\nFooter links"


def test_prose_in_an_article_stays(spark):
    page = "<article><div>Buy now</div><p>A passage that all quote</p><p>Own {i}</p></article>"
    rows = [(i, "http://h.org/", page.replace("{i}", str(i))) for i in range(10)]
    found = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {f"A passage that all quote\nOwn {i}" for i in range(10)}


def test_header_of_an_article_stays():
    page = """<body class="has-sidebar"><header><h1>Site</h1></header><main><article class="post"><header class="entry-header">
    <h1>Title</h1></header><p>Text<aside>x</aside><ul><li>One<li>Two</ul><table><tr><td>A<td>B</table>
    <section id="comments"><article><p>Nice</p></article></section></article></main></body>"""
    assert html.extract(page, set()) == "Title\nText\nOne\nTwo\nA\nB"


def test_broken_html_never_fails():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["<p>", "</p>", "<", ">", "<!--", "a", "\"", "<a href='", "&#x41;", "<table><td>", "</div>", "<script>"]) for _ in range(40))
        assert isinstance(html.extract(text, set()), str)


@pytest.mark.parametrize("seed", range(20))
def test_fullest_combination(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
    lengths, room = sorted(counts, reverse=True), rng.randint(5, 80)
    used = packing.fullest(lengths, counts, room)
    total = sum(k * n for k, n in used.items())
    best = max(
        s for combo in itertools.product(*(range(counts[x] + 1) for x in lengths)) if (s := sum(n * x for n, x in zip(combo, lengths))) <= room
    )
    assert total == best and all(n <= counts[x] for x, n in used.items())


def test_bins_use_every_piece_once():
    rng = random.Random(9)
    histogram = {rng.randint(1, 100): rng.randint(1, 500) for _ in range(60)}
    left = dict(histogram)
    found = packing.bins(histogram, 100)
    for used, times in found:
        assert sum(k * n for k, n in used.items()) <= 100
        for length, n in used.items():
            left[length] -= n * times
    assert not any(left.values())
    # Pieces over 100 - e can't share a bin with one of e or more: a certain lower bound for each e.
    least = max(
        sum(100 * n for k, n in histogram.items() if k > 100 - e) + sum(k * n for k, n in histogram.items() if e <= k <= 100 - e)
        for e in range(1, 51)
    )
    assert sum(t for _, t in found) <= 1.01 * least / 100 + 1


WEIRD = [
    "İstanbul İ, ΣΑΣ. Σ", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "don't DON'T it's, 's.", "é, e ́x. …, a…, 3.14, x1. ½. ﬁ, Ǆ.",
    "a b　c\x1cd\x85e", "don't.'s", "#a# b&&& c***. 'll,'ve", "日本語。テスト, ไทย.", "", "\n\t ", "ß, ẞ. ŉ.", "É, İ. á!",
]


def test_token_ids_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(4)
    mixed = ["".join(rng.choice("aB .,'!é世1#|<́İ") for _ in range(60)) for _ in range(300)]
    for text, ids in zip(WEIRD + mixed, packing.encoder(path).ids(pa.array(WEIRD + mixed))):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_position_inverts_the_schedule(spark):
    for at, knots in enumerate(mixing.SCHEDULES):
        x = np.linspace(0, 0.999, 50)
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        t = np.array([r[0] for r in df.select(mixing.position(F.col("x"), F.lit(at))).collect()])
        grid = np.linspace(0, 1, 100_001)
        weight = np.interp(grid, [k[0] for k in knots], [k[1] for k in knots])
        area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
        assert np.allclose(np.interp(t, grid, area / area[-1]), x, atol=1e-4)


def test_curriculum_is_in_order(spark, sf_dir):
    plan = mixing.plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), [3, 1, 2], 1.5, 2)
    found = [r["position"] for r in mixing.curriculum(plan).collect()]
    assert found == sorted(found) and len(found) == plan.agg(F.sum("copies")).first()[0]


def test_the_schedule_decides_what_is_taken(spark, sf_dir):
    """A schedule whose inverse ends early takes less: the documents are taken by position, not beside it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = mixing.plan_mix(docs, [3, 1, 2], 1.5, 2).agg(F.sum("copies")).first()[0]
    cut_off, plain = 0.5, mixing.position
    try:
        mixing.position = lambda d, place, schedules: F.when(plain(d, place, schedules) < cut_off, plain(d, place, schedules))
        half = mixing.plan_mix(docs, [3, 1, 2], 1.5, 2).agg(F.sum("copies"), F.max(F.array_max("positions"))).first()
    finally:
        mixing.position = plain
    assert 0 < half[0] < whole and half[1] < cut_off


def test_targets_are_shared_out(spark):
    sizes = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), (None, 0, 1), ("c", 500, 1)], "source string, source_size long, n_docs long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(sizes, [3, 1, 2], 1.5, 2).collect()}
    assert found["a"] == 20 and found[None] == 0
    assert abs(sum(found.values()) - 1.5 * 1510) < 1e-9 and found["c"] == 1000 and abs(found["b"] - 1245) < 1e-9


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(6)
    edges = {"chain": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 300)]}.get(shape) or [
        (rng.randrange(400), rng.randrange(400)) for _ in range(250)
    ]
    root = list(range(401))

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        root[top(a)] = top(b)
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found) == {v for a, b in edges if a != b for v in (a, b)}
    assert len({(top(v), r) for v, r in found.items()}) == len(set(found.values())) == len({top(v) for v in found})


def test_meeting_masks_lose_no_pair():
    rng = np.random.default_rng(8)
    for n in (100, 10**5, 10**7, 10**9, 10**12):
        masks = np.array(simhash.meeting_masks(n), np.uint64)
        x = rng.integers(0, 2**64, 200, dtype=np.uint64)
        y = x.copy()
        for i in range(len(y)):
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        assert (((x ^ y)[:, None] & masks) == 0).any(axis=1).all()


def test_long_texts_have_exact_vectors():
    """Slices by trigram and by text give the same sums as one text at a time."""
    rng = random.Random(3)
    some = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9000)), "abc abc", "", "x" * 5000]
    together, has = langid.text_vectors(some)
    assert has.tolist() == [True, True, False, True]
    for i, t in enumerate(some):
        assert np.array_equal(langid.text_vectors([t])[0][0], together[i])


def test_words_and_hashes():
    words = texts.Words(pa.array(["The the\tcat\x0b", None, "", " x"]).slice(0))
    assert words.counts().tolist() == [3, 0, 0, 1]
    h = words.hashes()
    assert h[0] == h[1] and len(set(h.tolist())) == 3
    again = texts.Words(pa.array(["zz cat", "x"]))
    assert again.hashes()[1] == h[2] and again.hashes()[2] == h[3]
    assert texts.Words(pa.array(["pre", "The cat", None]).slice(1)).counts().tolist() == [2, 0]


def test_host_prior_shrinks_small_hosts(spark):
    good = "every word of this text is a different one so that no rule can fail it at all and it has enough of them %d"
    rows = [(i, good % i if i % 10 else "bad", "big") for i in range(200)] + [(300, "bad", "small")] + [
        (400 + i, "bad", "junk") for i in range(100)
    ] + [(600 + i, good % i, f"h{i % 5}") for i in range(200)] + [(900, good % 1, "junk")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in quality.judge(docs, F.col("source")).collect()}
    assert found[400]["host_rate"] > 0.8 > found[300]["host_rate"] > found[1]["host_rate"]
    assert found[1]["kept"] and not found[10]["kept"] and not found[900]["base_failed"] and not found[900]["kept"]


def test_packed_counts_lose_nothing():
    rng = np.random.default_rng(7)
    for n in (1, 2, 50_000):
        keys = np.unique(np.concatenate([rng.integers(0, 2**64, n, dtype=np.uint64), np.array([2**64 - 1], np.uint64)]))
        counts = rng.zipf(1.5, len(keys)).clip(max=2**32 - 1)
        k, c = lm._unpacked(*lm._packed(keys, counts))
        assert np.array_equal(np.frombuffer(k, "<u8"), keys) and np.array_equal(np.frombuffer(c, "<u4"), counts)


def test_segments_change_no_score(spark, sf_dir, tmp_path, monkeypatch):
    """Many passes give what one pass gives, and leave one written pass besides the shards."""
    from weftmill import lineage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).persist()
    monkeypatch.setattr(lineage, "checkpoint_root", lambda _: str(tmp_path))
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    scores = []
    for size in (1 << 30, 20_000):
        before = len(list(tmp_path.iterdir()))
        model = lm.train(docs, segment_bytes=size)
        found = lm.score(docs, model, carry=[F.col("doc_id")]).collect()
        scores.append({r["doc_id"]: r["score"] for r in found})
        left = len(list(tmp_path.iterdir())) - before
    assert model.order == 3 and len(model.segments) > 2 and left == 2
    assert scores[0] == pytest.approx(scores[1])


LONGEST = "<p>The text of the page, which is most of it and so must never be lost</p>"


@pytest.mark.parametrize(
    "open_, close",
    [
        ('<div class="content has-sidebar">', "</div>"),
        ('<div id="page" class="no-sidebar">', "</div>"),
        ('<div class="nav-fixed">', "</div>"),
        ('<div class="widget">', "</div>"),
        ('<form action="x.aspx">', "</form>"),
        ('<section role="form" id="aspnet">', "</section>"),
    ],
)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrapper_of_the_text_stays(open_, close, tag):
    page = f'<body>{open_}<nav>menu</nav><{tag}>{LONGEST}</{tag}><div class="sidebar">side</div>{close}<footer>f</footer></body>'
    assert html.extract(page, set()) == html.extract(f"<p>{LONGEST}", set()) != ""


def test_words_inside_a_name_are_no_name():
    page = """<article><h2 id="social-policy">A</h2><h3 id="related">B</h3><section id="related-work"><p>C</p></section>
    <div class="social-history">D</div><div class="social">x</div><form><p>x</p></form></article>"""
    assert html.extract(page, set()) == "A\nB\nC\nD"


def test_comments_are_never_the_text():
    page = f'<div><p>Own</p></div><section id="comments"><article>{LONGEST}</article></section>'
    assert html.extract(page, set()) == "Own"
    assert html.extract("<article><p>Own</p></article>" + page, set()) == "Own"


def wrapped_at(width, indent=""):
    """Base64 of text that crosses every line, of which only the first line starts with a magic number."""
    data = base64.b64encode(gzip.compress((" ".join(str(i * i) for i in range(400)) + " " + SECRET).encode())).decode()
    return ("\n" + indent).join(data[i : i + width] for i in range(0, len(data), width))


@pytest.mark.parametrize(
    "packed",
    [
        base64.b64encode(gzip.compress(gzip.compress(SECRET.encode()))).decode(),
        base64.b64encode(bz2.compress(zlib.compress(SECRET.encode()))).decode(),
        base64.b64encode(gzip.compress(b"nothing here") + gzip.compress(SECRET.encode())).decode(),
        base64.b64encode(bz2.compress(b"nothing here") + bz2.compress(SECRET.encode())).decode(),
        base64.b64encode(b"\x00\x01head" + gzip.compress(SECRET.encode())).decode(),
        "".join(f"%{b:02X}" for b in gzip.compress(SECRET.encode())),
        quote(gzip.compress(SECRET.encode()), safe=""),
        "".join(f"\\x{b:02x}" for b in zlib.compress(SECRET.encode())),
        repr(gzip.compress(SECRET.encode()))[2:-1],
        *(wrapped_at(w, i) for w in (48, 64, 80, 100) for i in ("", "    ")),
    ],
)
def test_compressed_layers_to_a_fixpoint(packed):
    spans, complete = secrets.find(f"some words <{packed}> and more")
    assert complete and any(kind == 0 and depth > 0 for _, kind, _, depth in spans)


def test_a_stream_cut_short_is_not_complete():
    data = gzip.compress((SECRET + " " + " ".join(str(i * i) for i in range(900))).encode())
    spans, complete = secrets.find(base64.b64encode(data[: len(data) // 2]).decode())
    assert not complete and spans


def test_text_before_compressed_data_is_read():
    packed = base64.b64encode(SECRET.encode() + b" then " + gzip.compress(b"nothing here")).decode()
    assert any(kind == 0 for _, kind, _, _ in secrets.find(packed)[0])


@pytest.mark.parametrize("end", ["\u0085", "\u2028", "\u2029"])
def test_words_before_line_separators(spark, end):
    """These characters are words, also at the end of a text."""
    df = spark.createDataFrame([(1, f"a b {end}", "s"), (2, end, "s"), (3, f" a{end} ", "s")], "doc_id long, text string, source string")
    plan = {r["doc_id"]: r["size"] for r in mixing.plan_mix(df, [3, 1, 2], 1.5, 2).collect()}
    assert plan == {1: 3, 2: 1, 3: 1}
    rules = {r["doc_id"]: r["n_words"] for r in quality.judge(df, F.col("source")).collect()}
    assert rules == plan


@pytest.mark.parametrize("drop", [dedup.drop_duplicates, simhash.drop_near_duplicates])
def test_tied_rows_have_one_survivor(spark, drop):
    """Rows of equal id and text that differ elsewhere: the same one stays however the rows are dealt out."""
    rows = [(1, "the same text in every one of these rows", f"s{i}", i) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = {tuple(drop(df.orderBy(F.desc("n_chars") if n % 2 else F.asc("n_chars")).repartition(n)).collect()[0]) for n in (1, 2, 5, 8)}
    assert found == {(1, "the same text in every one of these rows", "s0", 0)}


def bundled(text):
    """The vector of a text, trigram by trigram and element by element."""
    letters, out = " ", np.zeros(langid.DIMENSIONS, np.int64)
    for c in text.lower() + " ":
        if c.isalpha() or letters[-1] != " ":
            letters += c if c.isalpha() else " "
    if not any(c != " " for c in letters):
        return out
    codes = [langid.BOUNDARY if c == " " else ord(c) for c in letters]
    base = {c: langid._letter_vectors(np.array([c]))[0].astype(np.int64) for c in set(codes)}
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        out += np.array([base[a][i - 2] * base[b][i - 1] * base[c][i] for i in range(langid.DIMENSIONS)])
    return out


def test_languages_equal_naive_bundling(spark):
    """Prototypes and choices of a small corpus, bound and added up one by one."""
    rows = [
        (1, "The cat sat on the mat, and the dog did not.", "en"), (2, "there is nothing that they think", "en"),
        (3, "Der Hund und die Katze schliefen; das Haus war still!", "de"), (4, "ich weiss nicht, was es ist", "de"),
        (5, "le chat était sur la table et le chien dormait", "fr"), (6, "the other thing", None), (7, "die andere Sache", None),
        (8, "la première chose", None), (9, "123 !!", None), (10, None, "de"), (11, "", "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    naive = {i: bundled(t or "") for i, t, _ in rows}
    expected = {}
    for i, _, lang in rows:
        if lang:
            expected[lang] = expected.get(lang, 0) + naive[i]
    found = langid.prototypes(docs)
    assert list(found) == sorted(expected)
    assert all(np.array_equal(found[k], expected[k]) for k in expected)
    predicted = {r["doc_id"]: r for r in langid.predict(docs, found, carry=[F.col("doc_id")]).collect()}
    names = sorted(expected)
    for i, _, _ in rows:
        if not naive[i].any():
            assert (predicted[i]["lang_pred"], predicted[i]["score"]) == ("und", 0.0)
            continue
        cosines = np.array([naive[i] @ expected[k] / np.linalg.norm(naive[i]) / np.linalg.norm(expected[k]) for k in names])
        assert predicted[i]["lang_pred"] == names[int(cosines.argmax())]
        odds = np.exp((cosines - cosines.max()) / langid.TEMPERATURE)
        assert abs(predicted[i]["score"] - 1 / odds.sum()) < 1e-4


def test_host_that_fails_by_half_is_dropped(spark):
    """Thirty hosts fail in 1 of 20 documents, one in 11 of 20: its sound documents go too, no others do."""
    sound = " ".join(f"word{i}" for i in range(30))
    rows = [(h * 100 + i, f"h{h}", "short" if i < (11 if h == 7 else 1) else sound) for h in range(30) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = quality.judge(docs, F.col("source")).collect()
    assert {r["doc_id"] // 100 for r in found if not r["base_failed"] and not r["kept"]} == {7}
    assert all(0.3 <= r["bar"] < 0.55 for r in found)
    # Hosts that are alike are all kept: the bar doesn't fall below its least value.
    alike = docs.filter("source <> 'h7'")
    assert all(r["kept"] != r["base_failed"] for r in quality.judge(alike, F.col("source")).collect())


def test_words_of_one_hash_keep_their_own_ids():
    """The letters a and b by bit parity, and the other way round: their hashes are equal at 1,024 letters."""
    import public_tokenizers
    from tokenizers import Tokenizer

    parity = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = "".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity)
    both = texts.Words(pa.array([f"x {one} {other}"]))
    assert both.hashes()[1] == both.hashes()[2] and both.distinct()[1].tolist() == [0, 1, 2]
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [one, f"{one} {other} {one}", other, None, ""]
    found = packing.Encoder(path).ids(pa.array(rows))
    again = [packing.Encoder(path).ids(pa.array([r]))[0] for r in rows[:3]]
    plain = [np.array(Tokenizer.from_file(path).encode(r or "", add_special_tokens=False).ids, "<u4").tobytes() for r in rows]
    assert found == plain and again == plain[:3]


def test_templates_against_brute_force(spark):
    """A host with four layouts, copies of a page, an article on several pages and a passage many quote."""
    rows = []
    for i in range(60):
        layout = f"<div><p>Layout {i % 4}</p><ul><li>Links</li></ul></div>"
        own = f"<div class='t'><h2>Head {i}</h2><p>Own text {i}</p>" + ("<p>A passage that six quote</p>" if i < 6 else "") + "</div>"
        rows.append((i, "http://four.org/", f"<body>{layout}{own}<div>Rare {i // 4}</div></body>"))
    same = "<body><div>Menu</div><div><div>Box in a story</div><p>Story</p></div></body>"
    rows += [(100 + i, "http://copies.org/a", same) for i in range(40)]
    rows += [(200 + i, "http://story.org/a", f"<body><p>{i}</p>" + same[6:]) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html.main_text(pages, by_name=False).collect()}
    around, different, kinds = {}, {}, {}
    for _, url, page in rows:
        nodes = html.parse(page)
        html.hash_subtrees(nodes)
        different.setdefault(url[:12], set()).add(page)
        for h, parent in html.page_hashes(page).items():
            around.setdefault((url[:12], h), set()).add(parent)
        kinds.update((n.hash, n.tag) for n in nodes)
    for i, url, page in rows:
        need = lambda h: max(5, len(different[url[:12]]) ** 0.5 if kinds[h] in html.TEXTUAL else 0)  # noqa: E731, B023
        template = {h for h in html.page_hashes(page) if len(around[url[:12], h]) >= need(h)}
        assert found[i] == html.extract(page, template, by_name=False)
    # Layouts on a quarter of the pages go; what six pages of sixty quote stays, as do copies of one page.
    assert found[3] == "Head 3\nOwn text 3\nA passage that six quote\nRare 0"
    assert found[100] == "Menu\nBox in a story\nStory"
    assert found[203] == "3"


def test_templates_beyond_the_broadcast_bound(spark, monkeypatch):
    """Hot pages, rare pages and pages without a template, through joins that don't broadcast."""
    rows = [(i, "http://h.org/", f"<div>Box {i % 3}</div><p>Own {i % 30}</p>") for i in range(120)]
    rows += [(500, "http://h.org/", None), (501, None, "<p>x</p>"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = sorted(map(str, html.main_text(pages).collect()))
    monkeypatch.setattr(html, "fits", lambda *a, **k: False)
    monkeypatch.setattr(html, "HOT_SHARE", 0.02)
    assert sorted(map(str, html.main_text(pages).collect())) == expected
    assert "Row(page_id=7, url='http://h.org/', text='Own 7', n_chars=5)" in expected


def test_counts_alone_find_templates_of_given_pages(spark, sf_dir):
    """With tag, class and role rules off, what goes is no article text."""
    import os

    from weftmill.llm.texts import table

    pages = table(spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.1"), "pages")
    alone = {r["page_id"]: r["text"] for r in html.main_text(pages, by_name=False).collect()}
    plain = {r["page_id"]: (html.extract(r["html"] or "", set(), False), html.extract(r["html"] or "", set())) for r in pages.collect()}
    raw, text = (sum(len(p[k]) for p in plain.values()) for k in (0, 1))
    kept = sum(map(len, alone.values()))
    lost = sum(len(line) for i, p in plain.items() for line in p[1].split("\n") if line not in alone[i])
    assert (raw - kept) / (raw - text) > 0.1 and lost < 0.001 * text


@pytest.mark.parametrize("page", ["<center>" * 60_000, "<b>" * 60_000 + "</i>" * 60_000, "<i><div>" + "<b>" * 40_000 + "</i>" * 40_000])
def test_deep_nesting_takes_time_in_proportion(page):
    import time

    start = time.time()
    assert html.extract(page + "x", set()) == "x" and len(html.page_hashes(page + "x")) >= 0
    assert time.time() - start < 20


def test_language_bar_is_the_same_for_any_number_of_languages(spark):
    """Thirty languages of their own letters: short sound texts stay, letters in no language's order go."""
    rng = random.Random(4)
    alphabets = ["".join(chr(0x4E00 + 40 * n + j) for j in range(12)) for n in range(30)]
    rows = []
    for n, alphabet in enumerate(alphabets):
        words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 6))) for _ in range(10)]
        rows += [(100 * n + i, " ".join(rng.choice(words) for _ in range(6)), f"l{n}") for i in range(20)]
    rows += [(9000 + i, "".join(chr(0xAC00 + rng.randrange(9000)) for _ in range(400)), None) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    assert kept >= {r[0] for r in rows if r[2]} and len([i for i in kept if i >= 9000]) <= 1


def test_more_segments_need_no_more_passes(spark, sf_dir, monkeypatch):
    """Texts are written once, however many segments the filter has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).persist()
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    written, scores = [], []
    cut = lm.cut
    for size in (1 << 30, 20_000):
        model = lm.train(docs, segment_bytes=size)
        tables = []
        monkeypatch.setattr(lm, "cut", lambda df, tables=tables, **options: tables.append(df.columns) or cut(df, **options))
        found = lm.score(docs, model, carry=[F.col("doc_id")]).collect()
        monkeypatch.setattr(lm, "cut", cut)
        scores.append({r["doc_id"]: r["score"] for r in found})
        written.append(tables)
    assert len(model.segments) > 4 and len(written[1]) <= len(written[0]) + lm.ROUNDS
    assert [sum("_text" in columns for columns in tables) for tables in written] == [1, 1]
    assert scores[0] == pytest.approx(scores[1])


def test_scores_do_not_depend_on_pieces(monkeypatch):
    """Pieces end anywhere: at blocks, at tasks that read parts of a block, and when they are full."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    texts_ = [" ".join(rng.choice(words, rng.integers(0, 30))) if i % 9 else None for i in range(90)]
    bits, segments = 2, [(0, 1), (1, 4)]
    counted = pa.Table.from_batches(list(lm._count_texts(3, bits)(iter([pa.record_batch([pa.array(texts_[:50])], ["text"])]))))
    shards = [lm._build_packed(counted.filter(pa.array(counted["shard"].to_numpy() == s))).to_pylist()[0] for s in range(4)]
    shards = [{**r, "segment": int(r["shard"] > 0), "piece": None, "n": None, "n_keys": None, "keys": None} for r in shards]
    results = []
    for piece_tokens, tasks in ((1 << 30, [0, 90]), (60, [0, 13, 40, 41, 90])):
        monkeypatch.setattr(lm, "PIECE_TOKENS", piece_tokens)
        monkeypatch.setattr(lm, "slices", lambda batch, column: (batch.slice(i, 1) for i in range(batch.num_rows)))
        probe, probes = lm._probe_texts(3, bits, np.array([0, 1]), 5), []
        for lo, hi in zip(tasks, tasks[1:]):
            rows = pa.record_batch([pa.array(range(lo, hi), pa.int64()), pa.array(texts_[lo:hi], pa.string())], ["id", "text"])
            probes += [r for out in probe(iter([rows])) for r in out.to_pylist()]
        none = dict.fromkeys(("shard", "blocks", "words", "word_counts"))
        met = shards + [{**none, **r} for r in probes]
        met = pa.Table.from_pylist(sorted(met, key=lambda r: (r["segment"], r["piece"] is not None)))
        back = [r for out in lm._answer_probes(segments, bits)(iter(met.to_batches(max_chunksize=7))) for r in out.to_pylist()]
        back = [{"_block": r["piece"] >> 5, "_id": r["piece"], "_text": None, **{f"_{k}": v for k, v in r.items()}} for r in back]
        docs = [{"_block": i >> 5, "_id": i, "_text": t} | dict.fromkeys(("_piece", "_n", "_segment", "_levels", "_exact")) for i, t in enumerate(texts_)]
        rows = sorted(back + docs, key=lambda r: (r["_block"], r["_piece"] is None, r["_id"], r["_n"] or 0, r["_segment"] or 0))
        scored = lm._score_blocks(3, 50, 700, 41, ["_id"])(iter(pa.Table.from_pylist(rows).to_batches(max_chunksize=11)))
        results.append((len({r["piece"] for r in probes}), [r for out in scored for r in out.to_pylist()]))
    assert results[0][0] == 3 and results[1][0] > 10
    assert [r["_id"] for r in results[1][1]] == list(range(90))
    for name in ("n_tokens", "n_known", "base_score", "score"):
        assert [r[name] for r in results[0][1]] == pytest.approx([r[name] for r in results[1][1]])
    assert max(r["n_known"] for r in results[0][1]) > 10
