"""The corpus pipeline against the brute-force versions of its stages, one after the other."""

import base64
import hashlib
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_bpe_substring import brute as brute_windows
from test_near_duplicates import brute as brute_groups
from test_rules_counts_leaks import base_of

import corpus_pipeline

SF = "/root/testdata/sf0.01"


def removed(text, width=35, seen=None):
    """``text`` without words of repeated windows, line by line."""
    lines, at, words = [], 0, text.encode().split()
    mask = [False] * len(words)
    for i in range(len(words) - width + 1):
        if seen[tuple(words[i:i + width])] > 1:
            mask[i:i + width] = [True] * width
    for line in text.split("\n"):
        own = line.encode().split()
        gone = mask[at:at + len(own)]
        at += len(own)
        if not any(gone):
            lines.append(line)
        elif not all(gone):
            lines.append(b" ".join(w for w, g in zip(own, gone, strict=True) if not g).decode())
    return "\n".join(lines)


def without_items(text, windows, width=10):
    """``text`` without benchmark windows; empty where they cover more than 80 percent of the words."""
    low = text.encode().lower()
    spans = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
    words = [low[a:b] for a, b in spans]
    hit = [False] * len(words)
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit[i:i + size] = [True] * size
    if 100 * sum(hit) > 80 * len(words):
        return ""
    out, at, raw = b"", 0, text.encode()
    for i, h in enumerate(hit):
        if h:
            if i == 0 or not hit[i - 1]:
                out += raw[at:spans[i][0]]
            at = spans[i][1]
    return (out + raw[at:]).decode()


def test_pipeline_equals_brute_force(spark, documents, benchmark):
    from collections import Counter

    rows = {r.doc_id: r for r in documents.collect()}
    texts = {i: r.text for i, r in rows.items() if not base_of(r.text)[5]}  # no line is in over 20 documents of a host here
    texts = {i: t for i, t in texts.items() if brute_groups_of(texts)[i][1] == i}
    assert 0 < len(texts) < len(rows)
    seen = Counter(tuple(w[k:k + 35]) for t in texts.values() for w in [t.encode().split()] for k in range(len(w) - 34))
    texts = {i: removed(t, seen=seen) for i, t in texts.items()}
    assert brute_windows([rows[0].text], 35)  # same definition of a window as the operator's own test
    windows = set()
    for r in benchmark.collect():
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").encode().lower())
        windows |= {tuple(w[a:a + 10]) for a in range(max(1, len(w) - 9))} if w else set()
    texts = {i: without_items(t, windows) for i, t in texts.items()}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: library.encode_ordinary(t) for i, t in texts.items()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert {i: r.ids for i, r in got.items()} == want
    assert all(r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest() for i, r in got.items())


_GROUPS = {}


def brute_groups_of(texts):
    key = len(texts)
    if key not in _GROUPS:
        _GROUPS[key] = brute_groups(texts)
    return _GROUPS[key]


def test_stages_keep_columns_and_odd_rows(spark, odd_documents):
    docs = odd_documents.withColumn("spans", F.lit("clash")).withColumn("row_key", F.lit(1)).withColumn("label", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() <= 11
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 11


def test_stage_decisions(spark):
    words = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, words, "en", "s", 1), (2, words + " more", "en", "s", 1), (3, "too short", "en", "s", 1), (4, other + " " + words, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == {1, 2, 4}
    single = stages["near_duplicates"](spark, kept, SF)
    assert {r.doc_id for r in single.collect()} == {1, 4}
    clean = {r.doc_id: (r.text, r.n_chars) for r in stages["substring_dedup"](spark, single, SF).collect()}
    assert clean == {1: ("", 0), 4: (other, len(other))}
