import datetime as dt

import pytest

from haulmart.plans import listing
from haulmart.plans.pages import SortedListing

DDL = "id bigint, folio string, customer_id bigint, scheduled_departure timestamp, is_active boolean"


@pytest.fixture(scope="module")
def deliveries(spark):
    # A third of all rows leave at the same moment; some have no time, some are gone.
    moment = dt.datetime(2026, 1, 1, 8)
    rows = [
        (i, f"ENT-{i}", 1, None if i % 50 == 0 else moment if i % 3 == 0 else moment + dt.timedelta(hours=i % 97),
         i % 11 != 0)
        for i in range(1, 1300)
    ]
    return {"delivery": spark.createDataFrame(rows, DDL).repartition(7)}


def test_every_page_equals_the_walk(spark, deliveries, tmp_path):
    written = SortedListing.write(deliveries, "delivery", str(tmp_path / "p"), step=60)
    whole = [r.id for r in listing.matching(deliveries, "delivery").orderBy(
        listing.ordered("-scheduled_departure"), "id").collect()]
    assert written.count() == len(whole) and written.pages() == -(-len(whole) // 25)
    for number in (1, 2, 3, 7, 20, written.pages() - 1, written.pages()):
        page = written.page(number)
        assert [r.id for r in page.collect()] == whole[(number - 1) * 25:number * 25]
        assert page.columns == deliveries["delivery"].columns
    # A page of 25 lies in at most three files, each of at most 60 rows.
    held = written.files_of(20)
    assert len(held) <= 3
    assert spark.read.parquet(*[f for f, _ in held]).count() <= 180


def test_pages_outside(spark, deliveries, tmp_path):
    written = SortedListing.write(deliveries, "delivery", str(tmp_path / "p"))
    assert written.page(written.pages() + 1).count() == 0
    with pytest.raises(ValueError):
        written.page(0)
    none = {"delivery": deliveries["delivery"].filter("id < 0")}
    empty = SortedListing.write(none, "delivery", str(tmp_path / "e"))
    assert empty.count() == 0 and empty.pages() == 1 and empty.page(1).count() == 0
