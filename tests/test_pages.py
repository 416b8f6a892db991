"""Page files that aren't one whole listing fail the read, and the pages are named."""
import json

import pytest

from tillroll.sources import feeds

SPEC = feeds.feed("ads")


def page(number, total=2300, size=500, **other):
    pages = max(1, -(-total // size))
    n = size if number < pages else total - (pages - 1) * size
    row = {"id": 1, "created_at": "2024-01-01T00:00:00", "updated_at": "2024-01-01T00:00:00"}
    return {"data": [row] * n, "page": number, "page_size": size, "total_count": total, "total_pages": pages,
            "has_next": number < pages, "has_previous": number > 1, **other}


def write(tmp_path, pages, name="extract"):
    folder = tmp_path / name
    folder.mkdir()
    for i, p in enumerate(pages):
        (folder / f"{i}.json").write_text(json.dumps(p) + "\n")
    return str(folder)


@pytest.mark.parametrize("pages, faults", [
    ([1, 2, 3, 4, 5], []), ([5, 3, 1, 2, 4], []),
    ([1, 2, 4, 5], [("missing", 3, 3)]), ([1], [("missing", 2, 5)]), ([3], [("missing", 1, 2), ("missing", 4, 5)]), ([2, 5], [("missing", 1, 1), ("missing", 3, 4)]),
    ([1, 2, 2, 3, 4, 5, 5], [("doubled", 2, 2), ("doubled", 5, 5)]),
])
def test_numbers(spark, tmp_path, pages, faults):
    path = write(tmp_path, [page(n) for n in pages])
    assert sorted(tuple(r)[1:] for r in feeds.page_faults(spark, path, SPEC).collect()) == sorted(faults)
    if faults:
        with pytest.raises(feeds.IncompleteExtract, match=f"{faults[0][0]} page {faults[0][1]}"):
            feeds.read_pages(spark, path, SPEC)
        assert feeds.read_pages(spark, path, SPEC, complete=False).count() > 0
    else:
        assert feeds.read_pages(spark, path, SPEC).count() == 2300


def test_other_listings_and_counts(spark, tmp_path):
    whole = [page(n) for n in range(1, 6)]
    path = write(tmp_path, [*whole, page(2, total=9000), page(9)], "foreign")
    assert sorted(tuple(r) for r in feeds.page_faults(spark, path, SPEC).collect()) == [("foreign", "foreign", 2, 2), ("foreign", "foreign", 9, 9)]
    short = [*whole[:2], {**whole[2], "data": whole[2]["data"][1:]}, {**whole[3], "has_next": False}, whole[4]]
    path = write(tmp_path, short, "short")
    assert sorted(tuple(r)[1:] for r in feeds.page_faults(spark, path, SPEC).collect()) == [("miscounted", 3, 3), ("miscounted", 4, 4)]
    assert feeds.page_faults(spark, write(tmp_path, [page(1, total=0)], "none"), SPEC).count() == 0
    # Extracts side by side are judged each by itself.
    write(tmp_path, [page(n, total=700) for n in (1, 2)], "other")
    assert {r.extract for r in feeds.page_faults(spark, f"{tmp_path}/*", SPEC).collect()} == {"foreign", "short"}
