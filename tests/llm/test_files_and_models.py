"""Tokens, files, fingerprints, page text and language model beside brute-force versions."""
import gzip
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import documents, edges, no_documents  # noqa: F401

from barloom.llm import html_text, packing, ppm, syncmers, token_files, tokens, warc
from barloom.sources.tables import scratch_dir


def encoded(text, end):
    from tokenizers import Tokenizer

    encoded.codec = getattr(encoded, "codec", None) or Tokenizer.from_file(tokens.tokenizer_path())
    return encoded.codec.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library(edges, monkeypatch):
    odd = ["", "  ", "a\x1cb", "Straße ÀÉ İstanbul ŉ", "don't we'll X'S,.", "<|endoftext|>foo", "é́ é", "½ ǅ a\xa0b c\x85d", "日本 語", "ΑΣ ΣΑ", "word''s x---y"]
    texts = [r.text or "" for r in edges.collect()] + odd
    codec = tokens.Encoder(tokens.tokenizer_path())
    for kept in (300_000, 3):
        monkeypatch.setattr(tokens, "KEPT_PIECES", kept)
        monkeypatch.setattr(tokens, "KEPT_WORDS", kept)
        for _ in range(2):
            got = codec.encode(texts)
            assert [np.frombuffer(g, codec.dtype).tolist() for g in got] == [encoded(t, 0)[:-1] for t in texts]


def test_encoder_meets_the_library_once_a_piece(monkeypatch):
    """Forms of one word that differ in case or in trailing punctuation are one word for the library."""
    codec, met = tokens.Encoder(tokens.tokenizer_path()), []

    class Library:
        def encode_batch_fast(self, groups, **how):
            met.extend(w for g in groups for w in g)
            return inner.encode_batch_fast(groups, **how)

    inner, codec.words = codec.words, Library()
    texts = ["Zorble zorble, ZORBLE! zorble;", "", " \t", "zorble (zorble) É.", "é zorble\x85x\xa0zorble"]
    got = codec.encode(texts) + codec.encode(texts)
    assert [np.frombuffer(g, codec.dtype).tolist() for g in got] == [encoded(t, 0)[:-1] for t in texts] * 2
    assert sorted(met) == ["x", "zorble", "é"] and codec.encode([]) == []


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_token_files_round_trip(request, spark, name, monkeypatch):
    docs = request.getfixturevalue(name).select("doc_id", "text")
    got = token_files.token_files(docs).collect()
    want = sorted(((d.doc_id, encoded(d.text, 1)) for d in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    starts = dict()
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids), crc(ids)) for d, ids in want)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [d for d, _ in want], starts


def test_token_files_empty(no_documents):
    assert token_files.token_files(no_documents).count() == 0


def test_coder_round_trip_and_damage():
    draw = np.random.default_rng(3)
    ids = np.minimum(draw.zipf(1.3, 20_000), 5_000).astype(np.uint32)
    counts = np.bincount(ids, minlength=5_001)
    coder = token_files.Coder(counts, 64)
    assert coder.freq.sum() == 1 << token_files.SCALE_BITS
    for n in (1, 63, 64, 65, 20_000):
        block = coder.encode(ids[:n])
        assert (coder.decode(block) == ids[:n]).all()
    with pytest.raises(ValueError):
        coder.decode(block[:-1] + bytes([block[-1] ^ 1]))
    entropy = -(counts[counts > 0] / len(ids) * np.log2(counts[counts > 0] / len(ids))).sum() * len(ids) / 8
    assert len(block) < 1.02 * entropy + 64 * 8 + 100


@pytest.mark.parametrize("name", ["edges", "documents"])
def test_packing(request, name):
    docs = request.getfixturevalue(name)
    got = packing.pack(docs).collect()
    want = defaultdict(list)
    for d in docs.collect():
        want[d.doc_id].append(encoded(d.text, 2))
    sequences = defaultdict(list)
    for p in got:
        sequences[p.sequence_id].append(p)
        assert any(p.doc_tokens == len(ids) and crc(ids[p.start:p.start + p.length]) == p.ids_crc32 for ids in want[p.doc_id])
    assert sum(p.length for p in got) == sum(len(i) for w in want.values() for i in w)
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= packing.CAPACITY and at & (at - 1) == 0
    covered = defaultdict(list)
    for p in got:
        covered[p.doc_id].append((p.start, p.length))
    for doc_id, spans in covered.items():
        assert Counter(x for s, n in spans for x in range(s, s + n)) == Counter(x for ids in want[doc_id] for x in range(len(ids)))


def test_packing_balances_cost_and_empty(no_documents):
    draw = random.Random(5)
    lengths = [draw.randint(1, 2_000) for _ in range(300)]
    room = [4_096] * (sum(lengths) // 4_096)
    placed, left = packing.assign(lengths, list(room))
    used, spent = Counter(), Counter()
    for _, _, n, s in placed:
        used[s] += n
        spent[s] += packing.cost(n)
    assert set(used.values()) == {4_096}
    assert max(spent.values()) < 1.35 * min(spent.values())
    assert packing.pack(no_documents).count() == 0


def brute_ppm(texts, held):
    counts, split = Counter(), [(t or "").encode().lower().split() + [b""] for t in texts]
    for words, h in zip(split, held):
        if not h:
            counts.update(words)
    trie, short, events = defaultdict(Counter), defaultdict(Counter), {}
    for w, c in counts.items():
        for i in range(len(w) + 1):
            s = w[i] if i < len(w) else ppm.END
            if i < ppm.MAX_CONTEXT:
                trie[w[:i]][s] += c
            for o in range(min(2, i) + 1):
                short[w[i - o:i]][s] += c
    for prefix, seen in trie.items():
        ppm.add_escapes(len(prefix), list(seen.values()), events)

    def logp(w):
        total = 0.0
        for i in range(len(w) + 1):
            s, ruled = w[i] if i < len(w) else ppm.END, set()
            seen = trie.get(w[:i]) if i < ppm.MAX_CONTEXT else None
            if seen:
                n, k = sum(seen.values()), len(seen)
                e = events.get(ppm.escape_class(i, n, k))
                e = (e[0] + 0.5) / (e[1] + 1) if e else k / (n + k)
                if s in seen:
                    total += math.log10((1 - e) * seen[s] / n)
                    continue
                total, ruled = total + math.log10(e), set(seen)
            for o in range(min(2, i), -1, -1):
                left = {x: c for x, c in short.get(w[i - o:i], {}).items() if x not in ruled}
                if not left:
                    continue
                n, k = sum(left.values()), len(left)
                if s in left:
                    total += math.log10(left[s] / (n + k))
                    break
                total, ruled = total + math.log10(k / (n + k)), ruled | set(left)
            else:
                total -= math.log10(ppm.ALPHABET - len(ruled))
        return total

    n, v, out = sum(counts.values()), len(counts), []
    for words in split:
        seen, score = Counter(), 0.0
        for t, w in enumerate(words):
            p = logp(w)
            score += (math.log10(seen[w] + ppm.ADAPT * 10 ** p) if seen[w] else p + math.log10(ppm.ADAPT)) - math.log10(t + ppm.ADAPT)
            seen[w] += 1
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((len(words), sum(counts[w] > 0 for w in words), n, base, score))
    return out


@pytest.mark.parametrize("name,range_words", [("edges", 50_000), ("edges", 4), ("documents", 200)])
def test_ppm(request, name, range_words):
    docs = request.getfixturevalue(name)
    local = docs.collect()
    held = [zlib.crc32(("" if d.doc_id is None else str(d.doc_id)).encode()) % 10 == 0 for d in local]
    want = brute_ppm([d.text for d in local], held)
    got = sorted(ppm.ppm_scores(docs, range_words).collect(), key=lambda r: (repr(r.doc_id), r.score))
    pairs = sorted(((d.doc_id, h, *w) for d, h, w in zip(local, held, want)), key=lambda r: (repr(r[0]), r[-1]))
    assert len(got) == len(pairs)
    for g, w in zip(got, pairs):
        assert tuple(g)[:5] == w[:5] and g.base_score == pytest.approx(w[5], rel=1e-9) and g.score == pytest.approx(w[6], rel=1e-9)


def test_ppm_without_training(spark, no_documents):
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    got = ppm.ppm_scores(spark.createDataFrame([(one, "ab c")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)] and got[0].score < 0
    assert ppm.ppm_scores(no_documents).count() == 0


def brute_anchors(text, k=syncmers.K, s=syncmers.S):
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)

    def value(i, n):
        v = 0
        for x in points[i:i + n].tolist():
            v = (v * int(syncmers._BASE) + x) % 2**64
        return int(syncmers._mix(np.array([v], np.uint64))[0])

    out = []
    for i in range(len(points) - k + 1):
        inner = [value(j, s) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((value(i, k), i))
    return out


def test_anchors_and_likeness(documents):
    text = documents.first().text[:300]
    hashes, positions = syncmers.anchors(text)
    with np.errstate(over="ignore"):
        assert list(zip(hashes.tolist(), positions.tolist())) == brute_anchors(text)
    own, shifted = syncmers.Fingerprint(text), syncmers.Fingerprint("zz " + text)
    assert syncmers.likeness(own, own) == 1 and syncmers.aligned(own, shifted) > 0.9
    a, b = syncmers.Fingerprint(text[:150]), syncmers.Fingerprint(text[:75] + "q" * 75)
    x, y = set(a.hashes.tolist()), set(b.hashes.tolist())
    assert syncmers.likeness(a, b) == pytest.approx(len(x & y) / len(x | y))
    assert syncmers.likeness(syncmers.Fingerprint(""), syncmers.Fingerprint("")) == 1 and syncmers.likeness(own, syncmers.Fingerprint("")) == 0


@pytest.mark.parametrize("name,range_rows", [("edges", 4), ("edges", 2_048), ("documents", 9)])
def test_fingerprints(request, name, range_rows):
    docs = request.getfixturevalue(name)
    ordered = sorted(docs.collect(), key=lambda d: (d.doc_id is None, -(d.doc_id or 0), d.text or ""))
    want = Counter()
    for d, following in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = d.text or "", following.text or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        prints = [syncmers.Fingerprint(t) for t in (text, changed, after)]
        want[(d.doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), str(prints[0]), str(prints[1]),
              syncmers.likeness(prints[0], prints[1]), syncmers.likeness(prints[0], prints[2]))] += 1
    got = syncmers.fingerprints(docs, range_rows).drop("aligned_edited").collect()
    assert Counter(map(tuple, got)) == want


def test_long_texts_keep_anchors_everywhere():
    """Likeness of long texts beside their whole anchor sets, and a passage of some 50 words found at its place."""
    draw = random.Random(21)

    def text(n):
        return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(n))

    passage, worst, lost = text(55), 0.0, 0
    for words, share in ((15_000, 0.5), (15_000, 0.1), (2_000, 0.8), (300, 0.5)):
        for _ in range(3):
            common, a, b = text(int(words * share)), text(int(words * (1 - share))), text(int(words * (1 - share)))
            x, y = (set(syncmers.anchors(common + " " + t)[0].tolist()) for t in (a, b))
            found = syncmers.likeness(syncmers.Fingerprint(common + " " + a), syncmers.Fingerprint(common + " " + b))
            worst = max(worst, abs(found - len(x & y) / len(x | y)))
    assert worst < 0.15
    for at_a, at_b in ((0, 14_000), (7_000, 100), (3_000, 3_000)):
        one, two = text(at_a) + " " + passage + " " + text(14_000 - at_a), text(at_b) + " " + passage + " " + text(14_000 - at_b)
        a, b = syncmers.Fingerprint(one), syncmers.Fingerprint(two)
        assert len(a.hashes) > len(one) / 80
        shared, i, j = np.intersect1d(a.hashes, b.hashes, return_indices=True)
        lost += not len(shared)
        if len(shared):
            assert set((a.positions[i] - b.positions[j]).tolist()) == {one.index(passage) - two.index(passage)}
            assert syncmers.aligned(a, b) == 1 and 0 < syncmers.likeness(a, b) < 0.02
    assert lost == 0


def test_fingerprints_keep_every_anchor():
    """A change of three words in a long text, and anchors beyond the 64 of least hash, count in full."""
    words = [f"w{i * 7_919 % 10_007}q{i}" for i in range(1_500)]
    one, two = " ".join(words), " ".join([*words[:700], "x", "y", "z", *words[703:]])
    a, b = syncmers.Fingerprint(one), syncmers.Fingerprint(two)
    x, y = (set((syncmers.anchors(t)[0] >> np.uint64(64 - syncmers.HASH_BITS)).tolist()) for t in (one, two))
    assert set(a.hashes.tolist()) == x and len(x) > len(one) / 8 and len(str(a).split()) == len(x)
    assert 0 < len(x & y) / len(x | y) < 1 and syncmers.likeness(a, b) == len(x & y) / len(x | y)


def test_fingerprints_empty(no_documents):
    assert syncmers.fingerprints(no_documents).count() == 0


PAGES = "page_id long, url string, html string, digest string, text string"


@pytest.fixture(scope="module")
def edge_pages(spark):
    long = "<p>" + "word " * 60 + "</p>"
    rows = [
        (5, "http://a/1", long), (2, "http://a/ 2\n", long), (9, None, long), (1, "", "short"), (3, "u", "short"), (4, None, None),
        (6, "v", ""), (7, "w", "<p>é" + "é" * 80), (2, "http://again", long), (None, "x", long), (8, "y", "<p>a\r\n\r\nb" * 9000),
    ]
    return spark.createDataFrame([(*r, "d", "t") for r in rows], PAGES).repartition(3)


def test_warc(spark, edge_pages):
    folder = scratch_dir(spark, "warc-test")
    manifest = warc.write_warc(edge_pages, folder, roll_bytes=300).collect()
    got = warc.read_warc(spark, folder, payloads=True).collect()
    first = {}
    for p in edge_pages.collect():
        data = (p.html or "").encode()
        if len(data) >= 100 and p.page_id is not None:
            first[data] = min(p.page_id, first.get(data, p.page_id))
    want = Counter()
    for p in edge_pages.collect():
        data = (p.html or "").encode()
        refers = first[data] if data in first and p.page_id is not None and p.page_id > first[data] else None
        want[(p.page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers, data if refers is None else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) if r.payload
                   else (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, b"" if r.record_type == "response" else None)
                   for r in got) == want
    assert len(manifest) > 3 and sum(m.records for m in manifest) == len(got)
    again = warc.write_warc(edge_pages.repartition(2), scratch_dir(spark, "warc-test"), roll_bytes=300).collect()
    assert sorted(m.sha256 for m in again) == sorted(m.sha256 for m in manifest)
    for m in manifest:
        content = open(f"{folder}/{m.file}", "rb").read()
        assert hashlib.sha256(content).hexdigest() == m.sha256 and gzip.decompress(content).startswith(b"WARC/1.1\r\n")


def test_warc_layouts_and_runs_agree(spark):
    """Enough pages for sampled ranges to differ: cuts come from exact ranks."""
    pages = spark.range(3_000).select(
        (F.col("id") * 7_919 % 3_001).alias("page_id"), F.concat(F.lit("http://p/"), "id").alias("url"),
        F.repeat(F.concat(F.lit("<p>"), F.col("id") % 97), (F.col("id") % 300).cast("int")).alias("html"))
    runs = [sorted(map(tuple, warc.write_warc(pages.repartition(n), scratch_dir(spark, "warc-test")).collect())) for n in (3, 3, 7)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == -(-3_000 // warc.LEAST_IDS) and sum(r[3] for r in runs[0]) == 3_000
    sizes = Counter()
    for part, _, _, records, *_ in runs[0]:
        sizes[part] += records
    assert dict(sizes) == {p: min(256, 3_000 - 256 * p) for p in range(12)}


def test_warc_empty_and_damage(spark, edge_pages):
    assert warc.archive(edge_pages.limit(0)).count() == 0
    record = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), 3, None)
    damaged = gzip.compress(record.replace(b"abc", b"abd"))

    class Stream:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            out, self.data = self.data[:n], self.data[n:]
            return out

    with pytest.raises(ValueError):
        list(warc.records_of(Stream(damaged)))
    with pytest.raises(ValueError):
        list(warc.records_of(Stream(gzip.compress(record)[:-9])))


def test_marginals_equal_enumeration():
    model = html_text.trained()
    tree = html_text.parse('<div class=menu><a href=x>one</a></div><article><p>Some words. More.</p><div class=ad>Buy</div></article>')
    elements = tree.elements
    n, weights = len(elements), defaultdict(float)
    for labels in itertools.product((0, 1), repeat=n):
        w = 1.0
        for e in elements[1:]:
            w *= math.exp(sum(model.odds.get(f, 0.0) for f in html_text.features(e)) * labels[e.index])
            w *= model.pairs[model._kind(e)][labels[e.parent.index]][labels[e.index]]
        for i in range(n):
            weights[i, labels[i]] += w
    want = [weights[i, 1] / (weights[i, 0] + weights[i, 1]) for i in range(n)]
    assert model.marginals(elements) == pytest.approx(want)


def test_held_out_pages():
    model, right, total = html_text.trained(), 0, 0
    for page in html_text.labelled_pages(60, seed=77):
        tree = html_text.parse(page)
        for e, p in zip(tree.elements[1:], model.marginals(tree.elements)[1:]):
            if e.label is not None and e.tag not in html_text.UNREAD:
                total += 1
                right += (p >= 0.5) == (e.label == 1)
    assert right / total > 0.98


# Openings that no training page has.
OTHER_OPENINGS = {
    "content": ("div class=prose", "section class=reader", "article class=longform", "div id=stuff", "main class=core", "article"),
    "links": ("div class=crumbs", "ul class=quicklinks", "nav class=rail", "div id=jump", "aside class=siblings"),
    "short": ("div class=colophon", "footer class=baseplate", "div class=gdpr", "aside class=pitch", "div class=strip"),
    "forms": ("form class=finder", "form id=enroll", "div class=lookup"), "inside": ("aside class=siblings", "div class=tease", "aside"),
    "comments": ("div class=talkback", "section class=visitors", "ol class=voices"),
}


def test_layouts_of_other_words():
    model, right, total = html_text.trained(), 0, 0
    for page in html_text.labelled_pages(60, seed=78, openings=OTHER_OPENINGS):
        tree = html_text.parse(page)
        for e, p in zip(tree.elements[1:], model.marginals(tree.elements)[1:]):
            if e.label is not None and e.tag not in html_text.UNREAD:
                total += 1
                right += (p >= 0.5) == (e.label == 1)
    assert right / total > 0.9


FIRST, SECOND = "<p>First words are here, and more.</p>", "<p>Second words, and more of them.</p>"
LINKED = '<p>Words with <a href="/x">a link</a> inside of it.</p><p><a href="/y">Only a link</a></p><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul>'


@pytest.mark.parametrize("inside,text", [
    (FIRST + "<select><option>One</option><option>Two</option></select>" + SECOND, None),
    (FIRST + "<button>Share</button><label>Name</label><textarea>fill</textarea>" + SECOND, None),
    (FIRST + "<form><label>Mail</label><input><button>Send</button></form>" + SECOND, None),
    (FIRST + "<aside>Read also: ten more things.</aside>" + SECOND, None),
    (FIRST + '<aside><h3>Related</h3><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></aside>' + SECOND, None),
    (f"<div><div>{FIRST}</div><div>{SECOND}</div></div>", None),
    (LINKED, "Words with a link inside of it.\nOnly a link\nOne\nTwo"),
])
@pytest.mark.parametrize("around", ["{}", '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>{}<footer>&copy; Me 2024</footer>'])
def test_controls_links_and_asides_inside_an_article(inside, text, around):
    got = html_text.main_text(around.format(f"<article>{inside}</article>"), html_text.trained())
    assert got == (text or "First words are here, and more.\nSecond words, and more of them.")


def test_page_tables(spark):
    """No rows, repeated rows, null ids, urls and pages, extra columns with the result's names."""
    schema = "page_id long, url string, html string, text string, n_chars string"
    page = f"<article>{FIRST}</article>"
    rows = [(1, "u", page, "x", "y"), (1, "u", page, "x", "y"), (None, None, page, None, None), (2, "v", None, "z", None)]
    got = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    plain = "First words are here, and more."
    assert Counter(map(tuple, got)) == Counter([(1, "u", plain, len(plain))] * 2 + [(None, None, plain, len(plain)), (2, "v", "", 0)])
    empty = html_text.extract(spark.createDataFrame([], schema))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p>Just a paragraph of text.", "Just a paragraph of text."),
    ("<article><h1>A &amp; B</h1><p>First  \n words&nbsp;here.<p><b>Second<br>one</article><footer>&copy; me</footer>", "A & B\nFirst words here.\nSecond one"),
    ("<nav><a href=x>Home</a></nav><div class=content><p>Real words are here.</p><script>var t='</p>';</script></div>", "Real words are here."),
    ("</div></p><main>Text at the start, with a sentence.</b></main>", "Text at the start, with a sentence."),
])
def test_main_text(spark, html, text):
    got = html_text.extract(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in got] == [(text, len(text))]


@pytest.mark.parametrize("before,inside", [
    ("<html><head><title>T</title><meta charset=utf-8><script>x</script><body>", ""), ("<head><title>T</title>", ""),
    ("<head><style>p {}</style><noscript><img src=x></noscript><link href=y><body>", ""),
    ("<head><template><p>No text of the page.</p></template><title>T</title></head>", ""),
    *[("<html><head></head><body>", f"<{tag}>") for tag in ("object", "noscript", "svg", "canvas", "audio", "video", "math")],
])
def test_text_after_unclosed_elements(before, inside):
    page = f"{before}<article><p>First words are here.</p>{inside}<p>Second words, and more of them.</p></article>"
    assert html_text.main_text(page, html_text.trained()) == "First words are here.\nSecond words, and more of them."


def test_formulas_are_text():
    page = "<article><p>The area is <math><mi>a</mi><mo>=</mo><mn>7</mn></math> in this case.</p></article>"
    assert html_text.main_text(page, html_text.trained()) == "The area is a=7 in this case."


def test_deep_tree_and_given_pages(spark, sf_dir):
    deep = "<article>" + "<div>" * 5_000 + "<p>Deep words, and more of them.</p>"
    assert "Deep words" in html_text.main_text(deep, html_text.trained())
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        inside = html_text.TreeBuilder()
        inside.feed(r.html[r.html.index("<article>"):r.html.index("</article>")])
        inside.close()
        blocks, words = [], []
        for piece in [*inside.flow, None]:
            if piece is None:
                blocks += [" ".join("".join(words).split())]
                words = []
            else:
                words.append(piece[1])
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
