import gzip
import hashlib
import random
from collections import Counter

import pytest

from lakelayers.llm.warc import RUN, LoserTree, archived_captures, capture_histories, capture_order, parse_archive, url_key, write_archives


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(2)
    for k in range(0, 9):
        for _ in range(20):
            runs = [sorted(rng.choices(range(20), k=rng.randint(0, 6))) for _ in range(k)]
            assert list(LoserTree(runs, lambda x: (x,))) == sorted(sum(runs, []))


def test_url_keys():
    assert url_key("https://www.Example.com/a?b=C#d") == "com,example)/a?b=c"
    assert url_key("http://x.y") == "y,x)/"
    assert url_key(None) == ""
    assert url_key("http://[bad") == "http://[bad"


def test_round_trip(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5
    rows = [
        (5, "http://b.c/x", "é" * 60), (3, "http://a.c/x", "é" * 60), (9, "http://a.c/x", "é" * 60), (3, "http://a.c/x", "é" * 60),
        (1, None, None), (2, "u\r\nWARC-Type: x", ""), (4, "http://a.c", "tiny"), (6, "http://a.c", "tiny"), (7, "http://t", tricky),
        (8, "http://t", tricky), (None, "http://t", tricky), (100_000_000_000, "http://z", "n" * 99), (11, "http://z", "n" * 99),
    ]
    found = archived_captures(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html] = min(first.get(html, page_id), page_id)
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and page_id != first[html]
        want.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in found)
    keys = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in found]
    assert keys == sorted(keys)


def test_ids_without_numbers_only(spark):
    rows = archived_captures(pages(spark, [(None, "u", "x" * 200), (None, "u", "x" * 200)])).collect()
    assert [(r.record_type, r.refers_to) for r in rows] == [("response", None)] * 2


def test_empty_table(spark):
    assert archived_captures(pages(spark, [])).count() == 0


def test_archives_are_bounded_and_damage_is_noticed(spark, tmp_path):
    write_archives(pages(spark, [(i, "http://a", f"page {i} " * 20) for i in range(30)]), str(tmp_path / "w"), rows_per_file=7)
    files = sorted((tmp_path / "w").glob("part-*"))
    content = [gzip.decompress(f.read_bytes()) for f in files]
    assert [len(list(parse_archive(f.read_bytes(), "f"))) for f in files] == [len(list(parse_archive(c, "f"))) for c in content]
    assert sum(len(list(parse_archive(c, "f"))) for c in content) == 30
    assert max(len(list(parse_archive(c, "f"))) for c in content) <= 7
    for broken in (content[0].replace(b"page", b"pagE", 1), content[0][:-3], b"junk" + content[0]):
        with pytest.raises(ValueError):
            list(parse_archive(broken, "f"))


def test_ranges_follow_the_captures(spark):
    """Many runs and one hot key: ranges of a bounded size, whose merge is the sorted order of all."""
    rng = random.Random(31)
    rows = []
    for archive in range(12):
        run = [
            {"page_id": rng.choice([None, rng.randint(0, 9)]), "payload_bytes": 1, "payload_digest": "", "record_type": "response", "refers_to": None,
             "url_key": rng.choice(["hot"] * 4 + ["a", "z"]), "captured_at": str(rng.randint(0, 3)), "archive": f"part-{archive}", "offset": i, "length": 1}
            for i in range(100)
        ]
        rows += [row | {"place": i} for i, row in enumerate(sorted(run, key=capture_order))]
    histories = capture_histories(spark.createDataFrame(rows, RUN).repartition(5), merge_rows=100)
    got = histories.selectExpr("*", "spark_partition_id() part").collect()
    assert [capture_order(r.asDict()) for r in got] == sorted(capture_order(r) for r in rows)
    sizes = Counter(r.part for r in got)
    assert len(sizes) >= 8 and max(sizes.values()) <= 400
    assert capture_histories(spark.createDataFrame([], RUN)).count() == 0
