"""Every operator against plain Python, on nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from areapanel.llm import bpe, exact_dedup, fingerprints, html_content, jaccard_join, language_id, packing, pii, sharding
from areapanel.llm import toxicity
from areapanel.llm.shingles import shingle_sets

tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = tokenizers.path("byte_bpe_50k.json")

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def sure(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for place, (kind, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if sure(kind, m[0])]
    return ",".join(x[2] for x in sorted(found))


def test_pii(spark, odd, none):
    random.seed(2)
    parts = ["@", ".", "+", "1", "23", "4111111111111111", " ", "-", "a", "b.c", "(", "é", "😀", "\n", "255", "%"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(1, 50)))) for i in range(200)]
    for got in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert got.base_sha256 == hashlib.sha256(base_spans(rows[got.doc_id][1]).encode()).hexdigest()
    got = pii.find_pii(odd).collect()
    want = Counter(hashlib.sha256(base_spans(r.text).encode()).hexdigest() for r in odd.collect())
    assert Counter(r.base_sha256 for r in got) == want
    texts = {r.doc_id: r.text for r in pii.redact(odd, "text").collect()}
    assert texts[8] == "der die und nicht [CARD] [IP] é😀 x" and texts[1] is None and texts[10] == "!!! 123"
    assert pii.redact(odd, "text").columns == odd.columns
    assert pii.find_pii(none).count() == 0
    extra = pii.find_pii(spark.createDataFrame([(1, "call 555-123-4567, iban DE89 3704 0044 0532 0130 00")], "doc_id int, text string"))
    assert extra.first().spans == "local_phone:5:17,iban:24:51" and extra.first().n_more == 2


def components(rows, width, percent):
    sets = [set(s.tolist()) for s in shingle_sets([(t or "").encode() for _, t in rows], width)]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for r, (k, _) in zip(root, rows, strict=True):
        least[r] = min((x for x in (least.get(r), k) if x is not None), default=None)
    return Counter((k, len(s), least[r]) for r, s, (k, _) in zip(root, sets, rows, strict=True))


@pytest.mark.parametrize(("width", "percent", "leaf", "direct"), [(3, 90, 64, 1024), (5, 80, 2, 1), (3, 60, 2, 0)])
def test_jaccard_join(spark, odd, none, monkeypatch, width, percent, leaf, direct):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "DIRECT", direct)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    random.seed(1)
    bases = [[random.choice("abcdefghijklmnop") * 2 + str(i % 9) for i in range(60)] for _ in range(3)]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for i in range(60):
        words = list(bases[i % 3])
        for _ in range(i % 5):
            words[random.randrange(60)] = f"w{random.randrange(30)}"
        rows.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.jaccard_join(docs, width=width, percent=percent).collect())
    assert got == components(rows, width, percent)
    assert jaccard_join.jaccard_join(none).count() == 0


def test_one_of_each(spark, odd):
    found = jaccard_join.jaccard_join(odd, width=3, percent=90)
    kept = [r.doc_id for r in jaccard_join.one_of_each(odd, found).collect()]
    assert 5 not in kept and {1, 2, 3, 4, 6, 8, 9, 10, None} <= set(kept)


def test_sharding(spark, odd, none):
    got = sharding.shard_documents(odd, shards=5).collect()
    assert len(got) == odd.count()
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.grown_shard in (r.shard, 5) for r in got)
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    again = {r.doc_id: r.shard for r in sharding.shard_documents(odd, shards=6).collect()}
    assert all(again[r.doc_id] == r.grown_shard for r in got)
    weights = spark.range(20_000).select("id")
    share = sharding.with_shard(weights, "id", [1.0, 3.0]).where("shard = 1").count() / 20_000
    assert abs(share - 0.75) < 0.02
    assert sharding.shard_documents(none).count() == 0
    assert {r.text_crc32 for r in got if r.doc_id in (1, 2)} == {0}


def test_toxicity(spark, odd, none):
    random.seed(3)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        rows.append((i, " ".join(random.choices(words, k=40)) + (" idiot scum" if bad else "")))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.toxic for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum(got[i] == (i % 4 == 0) for i in got) >= 590
    edge = toxicity.score_toxicity(odd, model).collect()
    assert len(edge) == odd.count() and not any(r.toxic for r in edge if r.doc_id in (1, 2, 3, 10))
    assert toxicity.score_toxicity(none, model).count() == 0


def test_packing(spark, odd, none):
    got = packing.pack_documents(odd, TOKENIZER).toPandas()
    encoder = bpe.ChunkEncoder(open(TOKENIZER).read())
    ids = [np.append(x, 1).astype("<u4") for x in encoder.encode([(r.text or "").encode() for r in odd.collect()])]
    assert got.length.sum() == sum(map(len, ids))
    one = got[got.doc_id == 9].sort_values("start")
    data = next(x for x, r in zip(ids, odd.collect(), strict=True) if r.doc_id == 9)
    at = 0
    for start, size, crc in zip(one.start, one.length, one.ids_crc32, strict=True):
        assert start == at and zlib.crc32(data[start : start + size].tobytes()) == crc
        at += size
    assert at == len(data)
    for _, seq in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert seq.offset.tolist() == (seq.length.cumsum() - seq.length).tolist() and seq.length.sum() <= 2048
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_packing_plan():
    histogram = {300: 10, 1748: 7, 700: 9, 648: 12, 2047: 1}
    plan = packing.solve_counts(histogram, 2048)
    used = Counter()
    for lengths, n in plan:
        assert sum(lengths) == 2048
        for x in lengths:
            used[x] += n
    assert all(used[x] <= histogram[x] for x in used) and used[1748] == 7
    data = bytes(range(256)) * 9
    assert packing.crc_between(zlib.crc32(data[:700]), zlib.crc32(data), len(data) - 700) == zlib.crc32(data[700:])


def test_fingerprints(spark, odd, none):
    got = fingerprints.fingerprint_documents(odd).collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0) for r in odd.collect()))
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == rows
    assert len({r.fingerprint for r in got if r.doc_id in (6, 7)}) == 1
    by_key = {r.doc_id: r for r in got}
    assert by_key[2].fingerprint == "" and by_key[2].near_next == 1.0 and by_key[1].near_edited == 1.0
    last = "!!! 123"
    first = "no key here at all"  # null keys come first
    assert by_key[10].edited_sha256 == hashlib.sha256((last[:4] + first[:3]).encode()).hexdigest()
    assert fingerprints.fingerprint_documents(none).count() == 0
    sampler = fingerprints.Sampler(2000)
    a, b = Counter(x=5, y=2, z=1), Counter(x=2, y=4, w=1)
    one, two = sampler.fingerprints([" ".join(c.elements()).encode() for c in (a, b)])
    assert abs(fingerprints.likeness(one, two) - sum((a & b).values()) / sum((a | b).values())) < 0.05


def test_language(spark, odd, none):
    random.seed(4)
    words = {"de": ["der", "und", "nicht", "straße"], "fr": ["les", "était", "nous", "que"]}
    rows = [(i, " ".join(random.choices(words[x], k=20)), x) for i, x in enumerate(["de", "fr"] * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, ~language_id.held_out("doc_id"))
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, model).collect()}
    assert all(got[i] == x for i, _, x in rows)
    edge = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert all(edge[i].lang_pred == "und" and edge[i].rejected and edge[i].score == 0 for i in (1, 2, 3, 10))
    assert edge[8].lang_pred == "de" and language_id.identify(none, model).count() == 0
    kept = language_id.keep_identified(odd, model)
    assert kept.columns == odd.columns and not {1, 2, 3, 10} & {r.doc_id for r in kept.collect()}


def test_bpe(spark, odd, none):
    from tokenizers import Tokenizer

    library, text = Tokenizer.from_file(TOKENIZER), open(TOKENIZER).read()
    random.seed(5)
    parts = ["a", " ", "  ", "the", "\n", "\t", "'s", "é", "😀", "中", " ", "　", "\x1c", "12", "<|endoftext|>", "ß", "_", "\r\n"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 80))) for _ in range(2000)] + ["same passage " * 300] * 2
    encoder, decoder = bpe.ChunkEncoder(text), bpe.Decoder(text)
    for t, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids and decoder.decode(ids) == t
    for c in range(1, 0x500):
        t = f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}"
        assert encoder.fast.encode_ordinary(t) == library.encode(t, add_special_tokens=False).ids
    got = Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe.encode_and_decode(odd, TOKENIZER).collect())
    assert got == Counter((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids),
                           hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd.collect())
    assert bpe.encode_and_decode(none, TOKENIZER).count() == 0


def test_exact_dedup(spark, odd, none):
    rows = [(r.doc_id, exact_dedup.normalise((r.text or "").encode())) for r in odd.collect()]
    assert all(t == re.sub(rb"[\x20\x09-\x0D]+", b" ", t) for _, t in rows)
    groups = {}
    for k, t in rows:
        groups.setdefault(t, []).append(k)
    want = Counter()
    for k, t in rows:
        least = min((x for x in groups[t] if x is not None), default=None)
        want[k, least, len(groups[t]), k == least, hashlib.sha256(t).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_dedup.exact_groups(odd).collect()) == want
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.keep_first(none).count() == 0


def test_trie_spills():
    random.seed(6)
    trie, want = exact_dedup.Trie(budget=300), {}
    for i in range(800):
        t = "".join(random.choices("ab", k=random.randint(0, 12))).encode() * random.randint(1, 3)
        trie.insert(t, i, 1, t)
        low, n = want.get(t, (i, 0))
        want[t] = (min(low, i), n + 1)
    assert {tag: (low, n) for low, n, tag in trie.owners()} == want


PAGES = [("<html><head><title>T</title><script>a='</p>'</script></head><body><nav><a href=x>menu one</a></nav><div class='ad'>buy"
          " now</div><article><h1>Head</h1><p>One &amp; two<b>three</b><br>four<ul><li>five</ul><div class='comments'>me too"
          "</div><p>six seven eight</article><footer>&copy; end</footer>", "Head One & twothree four five six seven eight"),
         (None, ""), ("", ""), ("plain &lt;b&gt;  words", "plain <b> words"), ("<", "<"), ("<script>only code", ""), ("<!-- x", "")]


def test_html(spark):
    docs = spark.createDataFrame([(i, "u", p, "own", 3) for i, (p, _) in enumerate(PAGES)],
                                 "page_id long, url string, html string, text string, n_chars long")
    weights = html_content.learn_weights(docs)
    got = {r.page_id: r for r in html_content.extract_text(docs, weights).collect()}
    for i, (_, text) in enumerate(PAGES):
        assert got[i].text == text and got[i].n_chars == len(text)
    assert html_content.extract_text(docs.limit(0), weights).count() == 0
