from hourglass.llm import warc


def test_ids_that_a_header_cannot_hold_come_back(spark):
    ids = ["a\r\nWARC-Type: x", "b\n", " lead", "trail ", "", "100%", "%41", "é ü", "k: v", "plain", None]
    rows = [(i, "http://x/" + "\r\n", "<p>" + "same " * 40) for i in ids] + [("z" + i, None, f"<p>{i}") for i in ids if i]
    got = warc.archive_round_trip(spark.createDataFrame(rows, "page_id string, url string, html string").repartition(2)).collect()
    assert sorted(r.page_id or "-" for r in got) == sorted(i or "-" for i, _, _ in rows)
    first = min((i for i in ids if i is not None), key=lambda i: i.encode())
    revisits = {r.page_id: r.refers_to for r in got if r.record_type == "revisit"}
    assert set(revisits.values()) == {first} and set(revisits) == set(ids) - {first}
