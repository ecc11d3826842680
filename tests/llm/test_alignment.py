"""Token alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter

import pytest

from areapanel.llm import alignment
from areapanel.llm.bpe import _byte_names

public = pytest.importorskip("public_tokenizers")
FILES = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


def both_sides():
    import sentencepiece
    from tokenizers import Tokenizer

    ours = Tokenizer.from_file(FILES[0])
    ours.encode_special_tokens = True
    byte, names = _byte_names(), {i: t for t, i in ours.get_vocab().items()}
    theirs = sentencepiece.SentencePieceProcessor(model_file=FILES[1])

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(byte[c] for c in names[i])) for i in ours.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in theirs.encode(text):
            piece = theirs.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if theirs.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = b" " + text.encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    return tokens


def ranges(side):
    at = 0
    for i, data in side:
        yield i, at, at + len(data)
        at += len(data)


def expected(rows, tokens):
    links, found = Counter(), []
    for key, text in rows:
        a, b = (list(ranges(s)) for s in tokens(text))
        mine = [(x, y) for x, _, e in a for y, _, f in b if e == f]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x) for x, s, e in side if s >= start and e <= end) for side in (a, b)))
            start = end
        links.update(mine)
        found.append((key, len(a), len(b), len(ends), mine,
                      hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return Counter((k, a, b, g, len(m), sum(links[p] == most[p[1]] for p in m), sum(links[p] for p in m), h)
                   for k, a, b, g, m, h in found)


@pytest.fixture(scope="module")
def texts():
    random.seed(7)
    parts = ["the", " model", "isation", " ", "  ", "é", "日本", "😀", "\n", "\t", "<|endoftext|>", "</s>", "<0x41>", "12", "½", "ﬁ",
             ".", " of", "​", "a▁b", "\x00", "Straße"]
    return [(i, "".join(random.choices(parts, k=random.randint(1, 12)))) for i in range(300)] + [(0, "the model"), (None, "x")]


def test_alignment_equals_a_walk(spark, texts, odd, monkeypatch):
    tokens = both_sides()
    rows = [r for r in texts if "\x00" not in r[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in alignment.align_tokens(df, *FILES).collect())
    assert got == expected(rows, tokens)
    short = odd.where("doc_id is null or doc_id <> 9")
    got = Counter(tuple(r) for r in alignment.align_tokens(short, *FILES).collect())
    assert got == expected([(r.doc_id, r.text) for r in short.collect()], tokens)


def test_alignment_of_special_strings_and_changed_texts(spark):
    df = spark.createDataFrame([(1, "a▁b"), (2, "<|endoftext|>"), (3, None), (4, ""), (5, "é </s>")],
                               "doc_id int, text string")
    got = {r.doc_id: r for r in alignment.align_tokens(df, *FILES).collect()}
    assert all(tuple(got[i])[1:] == (0, 0, 0, 0, 0, 0, "") for i in (1, 3, 4))
    assert got[2].n_a > 1 and got[5].n_b > 1


def test_blocks_do_not_change_the_result(spark, texts, monkeypatch):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    before = sorted(map(str, alignment.align_tokens(df, *FILES).collect()))
    monkeypatch.setattr(alignment, "DOCUMENTS", 7)
    monkeypatch.setattr(alignment, "ROWS", 3)
    assert sorted(map(str, alignment.align_tokens(df, *FILES).collect())) == before


def test_overlaps(spark, texts):
    tokens = both_sides()
    rows = texts[:80]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = Counter()
    for key, text in rows:
        a, b = (list(ranges(s)) for s in tokens(text))
        for i, (x, s, e) in enumerate(a):
            for j, (y, t, f) in enumerate(b):
                if s < f and t < e:
                    want[key, i, j, x, y, max(s, t), min(e, f), e == f] += 1
    assert Counter(tuple(r) for r in alignment.token_overlaps(df, *FILES).collect()) == want


def test_long_and_empty(spark, odd, none):
    row = alignment.align_tokens(odd.where("doc_id = 9"), *FILES).first()
    assert row.n_a > 40_000 and row.n_b > 40_000 and row.n_groups > 40_000
    got = alignment.align_tokens(none, *FILES)
    assert got.count() == 0 and got.columns[0] == "doc_id"
    assert alignment.token_overlaps(none, *FILES).count() == 0
