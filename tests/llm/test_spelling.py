import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hourglass.llm import spelling as S


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(rows, every=97, least=3):
    """All pairs of words, forms and chains of forms."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in near.items() if xs}
    form = {w: best[w] if w in best and n[best[w]] >= 2 * n[w] else None for w in n}
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def random_rows(seed: int, docs: int = 60):
    rng = random.Random(seed)
    letters = "abÀé"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(120)]
    vocabulary += [w[:i] + rng.choice(letters) + w[i + rng.randint(0, 1):] for w in vocabulary for i in (0, len(w) // 2, len(w))]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, ", ".join(w.upper() if rng.random() < .2 else w for w in rng.choices(vocabulary, weights, k=80))) for i in range(docs)]
    return rows + [(None, rows[0][1]), (docs, None), (docs + 1, ""), (docs + 2, " 12 ×÷ "), rows[0], rows[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words_equal_all_pairs(spark, seed):
    rows = random_rows(seed)
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = {r.word: tuple(r) for r in S.spelling_variants(docs).collect()}
    assert got == by_hand(rows)


def test_every_edit_of_a_word_is_found(spark):
    word = "abcdefghij"
    edits = {word[:i] + "x" + word[i + k:] for i in range(11) for k in (0, 1)} | {word[:i] + word[i + 1:] for i in range(10)}
    edits |= {"Ā" + word, word + "ÿÿ"[:1], word}
    rows = [(w, 3) for w in edits]
    pairs = S.near_pairs(spark.createDataFrame(rows, "word string, n long")).collect()
    got = {frozenset((r.short, r.long)) for r in pairs}
    assert len(got) == len(pairs)
    assert got == {frozenset((a, b)) for a in edits for b in edits if a < b and one_edit(a, b)}


def test_halves_and_all_grams(spark):
    words = spark.createDataFrame([("abcde", 3)], "word string, n long")
    halves = {(r.gram, r.place, r.size) for r in S.chunks(words).collect()}
    assert halves == {("ab", 0, 5), ("ab", 0, 6), ("cde", 2, 5), ("cde", 3, 6)}
    grams = {(r.gram, r.place) for r in S.grams(words).collect()}
    assert grams == {("abcde"[i:i + q], i) for q in (2, 3) for i in range(6 - q)}


def test_chains_of_forms(spark):
    chain = [("aaaaa", 1), ("aaaab", 2), ("aaabb", 4), ("aabbb", 8), ("abbbb", 16), ("bbbbb", 32)]
    table = spark.createDataFrame([(w, f[0]) for (w, _), f in zip(chain, [*chain[1:], (None,)], strict=True)], "word string, form string")
    assert {(r.word, r.root) for r in S.roots(table).collect()} == {(w, "bbbbb") for w, _ in chain[:-1]}


def test_odd_documents_and_ties(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = {r.word: tuple(r) for r in S.spelling_variants(odd_documents, min_count=1).collect()}
    assert got == by_hand(rows, least=1)
    tie = spark.createDataFrame([(1, "wordz " * 3 + "worda " * 9 + "wordé " * 9)], "doc_id long, text string")
    assert {r.word: r.form for r in S.spelling_variants(tie, typo_every=0).collect()}["wordz"] == "worda"
    assert S.spelling_variants(odd_documents.filter("false")).collect() == []


def test_sf_words_without_typos(documents, texts):
    n = Counter(w.translate(str.maketrans(S.UPPER, S.UPPER.lower())) for t in texts.values() for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    rows = S.word_counts(S.runs(documents).select(F.col("run").alias("word")))
    assert {r.word: r.n for r in rows.collect()} == {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
