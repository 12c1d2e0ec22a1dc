"""Blocks of benchmark items: their number follows the words, not the partitions, and they hold every window."""

import pytest

from hourglass.llm import decontaminate


def windows(words, width=10):
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


@pytest.mark.parametrize("most", [60, 100_000])
def test_blocks_hold_all_windows(spark, most):
    texts = [" ".join(f"w{i}x{j}" for j in range(5 + 9 * i)) for i in range(30)]
    rows = [(f"i{i}", t) for i, t in enumerate(texts)] + [("i0", texts[0]), ("e", ""), ("n", None), (None, texts[1])]
    items = spark.createDataFrame(rows, "item_id string, text string")
    total = sum(len(t.split()) for t in texts)
    for parts in (1, 7):
        folders = decontaminate.item_blocks(items.repartition(parts), "item_id", "text", most)
        blocks = [decontaminate.read_block(f) for f in folders]
        assert all(sum(len(w) for _, w in b) <= most + 9 or len(b) == 1 for b in blocks)
        assert len(blocks) == 1 if total <= most else total // most <= len(blocks) <= 5 * (total // most)
        assert {w for b in blocks for _, words in b for w in windows(words)} == {
            w for t in texts for w in windows(decontaminate.normalised(t.encode()))}
        assert {n for b in blocks for n, _ in b} == {f"i{i}" for i in range(30)} | {None}
    assert decontaminate.item_blocks(items.limit(0), "item_id", "text") == []
