"""Pages of kept lists: the same rows as a sort of everything, from one or two files."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lists, paging


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", None]), i, f"text {i}") for i in rng.sample(range(100_000), 9000)]
    frame = spark.createDataFrame(rows, "name string, id long, text string").repartition(7)
    return lists.keep_list(frame, ["name", "id"], str(tmp_path_factory.mktemp("list") / "x"), 1500), sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def test_pages_follow_each_other(kept):
    kept, rows = kept
    for descending in (False, True):
        want = rows[::-1] if descending else rows
        got, cursor, pages = [], None, 0
        while True:
            page, cursor = lists.next_kept_page(kept, "list", {"x": 1}, 1000, cursor, descending)
            got += [tuple(r) for r in page]
            pages += 1
            if cursor is None:
                break
        assert got == want and pages == 9
    with pytest.raises(paging.PageRefused):
        lists.next_kept_page(kept, "list", {"x": 2}, 1000, paging.Cursor("list", {"x": 1}).write(["a", 1]))


def test_a_page_opens_one_or_two_files(spark, kept):
    kept, rows = kept
    assert kept.fences.count() >= 6
    for descending in (False, True):
        for at in range(0, 9000, 450):
            after = list(rows[at][:2])
            page = lists.kept_page(kept, 100, after, descending)
            assert len(page.inputFiles()) <= 2
            assert [tuple(r) for r in page.collect()] == [tuple(r) for r in (rows[max(0, at - 101) : at][::-1] if descending else rows[at + 1 : at + 102])]


def test_pages_within_a_part(kept):
    kept, rows = kept
    own = [r for r in rows if r[0] == "b"]
    got = [tuple(r) for r in lists.kept_page(kept, 50, ["b", own[10][1]], within=["b"]).collect()]
    assert got == own[11:62]
    assert [tuple(r) for r in lists.kept_page(kept, 50, within=["c"]).collect()] == [r for r in rows if r[0] == "c"][:51]
    assert [tuple(r) for r in lists.kept_page(kept, 50, within=[None]).collect()] == [r for r in rows if r[0] is None][:51]
    assert lists.kept_page(kept, 50, within=["zz"]).count() == 0 and lists.kept_page(kept, 50, ["zz", 1]).count() == 0
    last = own[-1]
    assert lists.kept_page(kept, 50, ["b", last[1]], within=["b"]).count() == 0


def test_empty_lists_and_refusals(spark, tmp_path):
    none = lists.keep_list(spark.createDataFrame([], "id long"), ["id"], f"{tmp_path}/none", 2000)
    assert lists.kept_page(none).collect() == [] and lists.next_kept_page(none, "l", {}) == ([], None)
    with pytest.raises(ValueError):
        lists.keep_list(spark.range(3), ["id"], f"{tmp_path}/small", 1000)
    for limit in (0, 1001):
        with pytest.raises(paging.PageRefused):
            lists.kept_page(none, limit)
    import decimal

    with pytest.raises(paging.PageRefused, match="Decimal"):
        paging.Cursor("l", {}).write([decimal.Decimal(1)])


def test_a_long_list_is_made_once_and_has_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(lists, "MOST_FILES", 5, raising=False)
    kept = lists.keep_list(spark.range(12_000).mapInArrow(counted, "id long"), ["id"], f"{tmp_path}/long", 1001)
    assert made.value == 12_000
    fences = kept.fences.orderBy("least").collect()
    assert len(fences) == 5 and sum(f.rows for f in fences) == 12_000 and all(a.greatest < b.least for a, b in zip(fences, fences[1:]))
    for at in (-1, 4_000, 11_950):
        page = lists.kept_page(kept, 100, [at])
        assert [r.id for r in page.collect()] == list(range(at + 1, min(at + 102, 12_000))) and len(page.inputFiles()) <= 2
