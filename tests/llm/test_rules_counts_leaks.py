"""Operators 4, 5 and 8 against brute force and the tokenizer library."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import decontaminate, line_rules, queries, token_counts

SF = "/root/testdata/sf0.01"


def brute_hits(words, items, width=10):
    hit, found = [False] * len(words), set()
    for name, item in items:
        for size, at in {(min(width, len(item)), a) for a in range(max(1, len(item) - width + 1))} if item else ():
            window = item[at:at + size]
            for i in range(len(words) - size + 1):
                if words[i:i + size] == window:
                    hit[i:i + size] = [True] * size
                    found.add(name)
    return hit, sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), max_size=5),
       st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=40), st.integers(1, 5))
def test_automaton_equals_brute_force(items, words, width):
    named = [(str(i), w) for i, w in enumerate(items)]
    automaton = decontaminate.SuffixAutomaton(named, width)
    spans, found = automaton.spans(words)
    marks = [False] * len(words)
    for a, b in spans:
        marks[a:b] = [True] * (b - a)
    assert (marks, sorted(str(i) for i in found)) == brute_hits(words, named, width)
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_decontamination_query_equals_window_index(spark, texts, benchmark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    windows = {}
    for r in benchmark.collect():
        w = word.findall(r.text.translate(low))
        for a in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[a:a + 10]), set()).add(str(r.item_id))
    sizes = {len(w) for w in windows}
    got = {r.doc_id: r for r in queries.op5_decontamination(spark, SF).collect()}
    assert len(got) == len(texts)
    for k, text in texts.items():
        w = word.findall((text or "").translate(low))
        hit, found = [0] * len(w), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                if s := windows.get(tuple(w[a:a + size])):
                    found |= s
                    hit[a:a + size] = [1] * size
        r = got[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), sum(hit), len(found), any(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    assert any(r.contaminated for r in got.values())


def test_item_blocks_give_the_same_hits(spark, documents, benchmark):
    want = {r.row_key: (r.spans, r["items"]) for r in decontaminate.contamination(documents, benchmark).collect()}
    got = {r.row_key: (r.spans, r["items"]) for r in
           decontaminate.contamination(documents, benchmark, block_words=400).collect()}
    assert got == want


def test_decontaminate_odd_rows(spark, odd_documents):
    items = spark.createDataFrame([("i", "ha HA, so"), (None, "null id"), ("e", ""), ("n", None), ("j", "naïve\xa0text")],
                                  "item_id string, text string")
    rows = decontaminate.contamination(odd_documents, items).collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows}
    assert by[1].spans == [[0, 3]] and by[1]["items"] == ["i"] and by[8]["items"] == ["j"]
    assert by[None].spans == [[1, 3]] and by[None]["items"] == [] and by[2].n_words == 0
    clean = decontaminate.decontaminate(odd_documents, items).collect()
    assert by[5].n_words == 60_000 and len(clean) == 11 and {r.doc_id: r.text for r in clean}[1] == " so"
    assert [f.name for f in decontaminate.decontaminate(odd_documents, items).schema] == odd_documents.columns
    none = decontaminate.contamination(odd_documents.limit(0), items)
    assert none.count() == 0 and decontaminate.contamination(odd_documents, items.limit(0)).count() == 11


def test_covered_documents_become_empty(spark):
    docs = spark.createDataFrame([(1, "One two, three four."), (2, "one two three four and then a lot more words"), (3, "clean.")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([("a", "one two three four")], "item_id string, text string")
    assert {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items).collect()} == {
        1: "", 2: " and then a lot more words", 3: "clean."}


def library_count(text):
    t = token_counts.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return len(t.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_query_equals_library(spark, texts):
    for r in queries.op4_token_counts(spark, SF).collect():
        n = library_count(texts[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((texts[r.doc_id] or "").encode()), n > 512)


@pytest.mark.parametrize("entries", [1, 1 << 16])
def test_token_counts_odd_rows(spark, odd_documents, entries):
    extra = spark.createDataFrame([(20, "a<|endoftext|> b  c\n\n d"), (21, "don't  \t we'll\r\n 12345 ½ ①  ")],
                                  "doc_id long, text string")
    docs = odd_documents.select("doc_id", "text").unionByName(extra)
    rows = token_counts.token_counts(docs, table_entries=entries).collect()
    want = Counter((r.doc_id, library_count(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def base_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    mark = [False] * len(words)
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            mark[i:i + 3] = [True] * 3
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n, rep = len(words), sum(mark)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, rep,
            n < 50 or 100 * rep > 50 * n)


def test_quality_rules_query_equals_brute_force(spark, texts, documents):
    host = {r.doc_id: r.source for r in documents.collect()}
    held = {}
    for k, t in texts.items():
        for line in (t or "").split("\n"):
            if w := tuple(line.encode().lower().split()):
                held.setdefault((host[k], w), set()).add(t)
    rows = {r.doc_id: r for r in line_rules.line_rules(documents, max_documents=3).collect()}
    lost = 0
    for k, t in texts.items():
        gone = sum(len(w) for line in (t or "").split("\n") if (w := tuple(line.encode().lower().split()))
                   and len(held[host[k], w]) > 3)
        r, base = rows[k], base_of(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        assert r.n_removed_words == gone and r.kept == (not base[5] and 100 * gone <= 66 * base[0])
        lost += gone
    assert lost
    assert {(r.doc_id, r.base_failed) for r in queries.op8_quality_rules(spark, SF).collect()} == {
        (k, base_of(t)[5]) for k, t in texts.items()}


def test_quality_rules_odd_rows(spark, odd_documents):
    rows = line_rules.line_rules(odd_documents, max_documents=0).collect()
    assert len(rows) == 11 and not any(r.kept for r in rows)
    for r in rows:
        assert r.n_removed_words == r.n_words
    assert {r.doc_id: r.n_words for r in rows} == {1: 4, 2: 0, 3: 0, 4: 0, None: 3, 5: 60_000, 6: 60_000, 7: 1, 8: 6, 9: 4}
    gone = line_rules.remove_lines(odd_documents, max_documents=0)
    assert gone.columns == odd_documents.columns and {r.text for r in gone.collect()} == {"", None, " \t\n\x0b\x0c\r "}
    assert line_rules.line_rules(odd_documents.limit(0)).count() == 0
