"""Operators 3 and 6 against tiktoken and brute force."""

import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import bpe, queries, substring

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe.Vocabulary(f.read())


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_bpe_query_equals_library(spark, texts, library):
    rows = queries.op3_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha(" ".join(map(str, ids)).encode())
        assert r.decoded_sha256 == sha((texts[r.doc_id] or "").encode())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abt he'sI.\n\t 9é漢\U0001f600\xa0\x1c")) | st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_bpe_round_trip(vocabulary, library, texts):
    found = list(vocabulary.encode(texts))
    ids = [library.encode_ordinary(t) for t in texts]
    assert [a.decode().split() for a, _ in found] == [[str(i) for i in x] for x in ids]
    assert [b for _, b in found] == [t.encode() for t in texts] == vocabulary.decode(ids)


@pytest.mark.parametrize("word", ["x" * 3000, "ab" * 2000, "the" * 200, "aaaab" * 70])
def test_long_words_merge_alike(vocabulary, library, word):
    assert vocabulary.merge_long(word.encode()) == library.encode_ordinary(word)
    short = word[:120].encode()
    t = vocabulary.merge([short]).sort_by("pos")
    assert t["tok"].to_pylist() == vocabulary.merge_long(short)


def test_decoded_bytes_come_from_the_ids(library):
    """A wrong entry of the decoding table shows in the decoded bytes, and in no id."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        broken = bpe.Vocabulary(f.read())
    wrong = library.encode_ordinary(" the")
    broken.con.execute("UPDATE vocabulary SET hex = '2078' WHERE id = ?", wrong)
    (ids, raw), (more, plain) = broken.encode(["in the end, the\n the", "of it"])
    assert ids.split() == [str(i).encode() for i in library.encode_ordinary("in the end, the\n the")]
    assert raw == b"in x end, x\n x" and plain == b"of it" and len(more.split()) == 2


def test_digits_and_spaces_of_a_text_are_not_taken_for_ids(vocabulary, library):
    texts = ["one 2 three 44 five 666", "0 1  2\n3", "", "a  b\n c", "\u00f5\u00ff \U0010ffff 7"]
    assert list(vocabulary.encode(texts)) == [(" ".join(map(str, library.encode_ordinary(t))).encode(), t.encode()) for t in texts]


def test_pattern_reads_distinct_pieces_only(vocabulary, library, monkeypatch):
    """Work on pieces grows with the different ones, in texts with any white space."""
    read = []

    class Counted:
        def findall(self, text):
            read.append(len(text))
            return split.findall(text)

    split = bpe._SPLIT
    monkeypatch.setattr(bpe, "_SPLIT", Counted())
    text = "Two  spaces, 12 lines\n\n here's one: \u3000x \t y\xa0z 3.5 "
    got = list(vocabulary.encode([text] * 300))
    assert got == [(" ".join(map(str, library.encode_ordinary(text))).encode(), text.encode())] * 300
    assert sum(read) <= 3 * len(text)


def test_full_table_keeps_what_comes_again(library, monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        vocabulary = bpe.Vocabulary(f.read())
    monkeypatch.setattr(bpe, "TABLE_BYTES", 20_000)
    learnt = []
    learn = vocabulary.learn
    monkeypatch.setattr(vocabulary, "learn", lambda words: learnt.append(set(words.to_pylist())) or learn(words))
    often = [f"oft{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(60)]
    for k in range(30):
        rare = [f"r{chr(97 + k % 26)}{chr(97 + k // 26)}x{chr(97 + i % 26)}{chr(97 + i // 26)}z" for i in range(150)]
        texts = ["a " + " ".join(often + rare), "long " + "y" * 400 + "," + "b" * (30_000 if k == 20 else 3)]
        assert list(vocabulary.encode(texts)) == [(" ".join(map(str, library.encode_ordinary(t))).encode(), t.encode()) for t in texts]
        assert vocabulary.pieces.size() < 30_000 + 20_000 + 400_000 * (k == 20)
    again = [w for found in learnt[2:20] for w in found if w.strip() in often]
    assert not again and len(learnt) == 30


def test_bpe_odd_rows(spark, odd_documents, library):
    rows = bpe.encode(odd_documents).collect()
    want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text or ""))) for r in odd_documents.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    back = bpe.decode(bpe.encode(odd_documents)).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r.doc_id, r.text or "") for r in odd_documents.collect())
    assert bpe.encode(odd_documents.limit(0)).count() == 0


def brute(texts, width):
    """[(n_words, kept words)] by counting every window."""
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        mask = [False] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i:i + width])] > 1:
                mask[i:i + width] = [True] * width
        out.append((len(w), [x for x, m in zip(w, mask, strict=True) if not m]))
    return out


def test_substring_query_equals_brute_force(spark, texts):
    rows = {r.doc_id: r for r in queries.op6_substring_dedup(spark, SF).collect()}
    ids = sorted(texts)
    removed = 0
    for i, (n, kept) in zip(ids, brute([texts[i] for i in ids], 35), strict=True):
        r = rows[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(kept), sha(b" ".join(kept)))
        removed += r.n_removed
    assert removed and len(rows) == len(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(2, 9), st.integers(1, 4))
def test_phrases_cover_every_window_once(words, width, anchor):
    anchor = min(anchor, width)
    p = substring.Phrases([b"%d" % w for w in words], width, anchor)
    n = len(words) - width + 1
    if n <= 0:
        assert p.count == 0
        return
    assert p.first[0] == 0 and p.first[-1] + p.windows[-1] == n and (np.diff(p.first) == p.windows[:-1]).all()
    content = {}
    for k, (a, m) in enumerate(zip(p.first, p.windows, strict=True)):
        key = (int(p.anchor[k]), int(p.content[k]))
        assert content.setdefault(tuple(words[a:a + m + width - 1]), key) == key
    assert len(set(content.values())) == len(content)
    w1, _ = p.window_hashes(width)
    assert len(set(w1.tolist())) == len({tuple(words[i:i + width]) for i in range(n)})


def test_substring_small_texts(spark):
    import random

    pick = random.Random(5)
    base = [f"w{pick.randrange(9)}" for _ in range(400)]
    rows = []
    for i in range(120):
        a, b = pick.randrange(380), pick.randrange(380)
        rows.append((i, " ".join(base[a:a + pick.randrange(30)] + [f"u{i}"] * pick.randrange(9) + base[b:b + pick.randrange(20)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in
           substring.substring_dedup(docs, width=7, anchor=3).collect()}
    want = {i: (n, n - len(k), sha(b" ".join(k))) for (i, _), (n, k) in zip(rows, brute([t for _, t in rows], 7), strict=True)}
    assert got == want


def test_substring_odd_rows(spark, odd_documents):
    rows = substring.substring_dedup(odd_documents).collect()
    every = odd_documents.collect()
    want = Counter((r.doc_id, n, n - len(k)) for r, (n, k) in zip(every, brute([r.text for r in every], 35), strict=True))
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in rows) == want
    assert {r.doc_id: r.clean for r in rows if r.doc_id in (5, 6)} == {5: "", 6: ""}
    assert substring.substring_dedup(odd_documents.limit(0)).count() == 0
