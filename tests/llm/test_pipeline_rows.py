"""The pipeline's row decisions where ids repeat or are missing, and where near copies fill a host."""

import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(mark, n=80):
    return " ".join(f"{mark}{i}" for i in range(n))


@pytest.fixture(scope="module")
def stages():
    return dict(corpus_pipeline.STAGES)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(3)


def test_repeated_shared_and_missing_ids(spark, stages):
    a, b, c, d, e = (words(x) for x in "abcde")
    rows = [(1, a)] * 3 + [(2, b), (3, b + " more"), (3, c)] + [(None, d)] * 2 + [(None, d + " more"), (None, a), (9, e), (None, e)]
    docs = table(spark, rows)
    single = stages["near_duplicates"](spark, docs, "")
    assert single.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in single.collect()))
    assert [g for g in got if g[0]] == [(1, a), (2, b), (3, c), (9, e)]
    assert len(got) == 5 and got[0][1] in (d, d + " more")
    clean = {r.text for r in stages["substring_dedup"](spark, single, "").collect()}
    assert {a, b, c, e} < clean and "" not in clean


def test_near_copies_do_not_deplete_each_other(spark, stages):
    lines = [words(f"l{k}x", 15) for k in range(6)]
    rows = [(0, "\n".join(lines))]
    for i in range(1, 50):
        edited = list(lines)
        edited[i % 6] = edited[i % 6].replace(f"l{i % 6}x{i % 15} ", f"edit{i} ", 1)
        rows.append((i, "\n".join(edited)))
    furniture = words("menu", 50)
    rows += [(100 + i, furniture + "\n" + words(f"own{i}y", 20)) for i in range(25)]
    kept = stages["quality_rules"](spark, table(spark, rows), "")
    assert {r.doc_id for r in kept.collect()} == set(range(50))
    assert [r.text for r in stages["near_duplicates"](spark, kept, "").collect()] == ["\n".join(lines)]
