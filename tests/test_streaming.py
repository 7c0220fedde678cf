from conftest import SF
from pagedframes import fixtures as fx
from pagedframes.sources import land_pages, pages_from_table, unnest_typed
from pagedframes.storage import new_folder
from pagedframes.streaming import drain, stream_items, stream_landed


def rows(df):
    return sorted(map(str, df.collect()))


def test_stream_equals_batch_over_restarts(spark):
    pages = fx.event_pages(spark, SF).cache()
    landing, target = new_folder(spark, "landing"), new_folder(spark, "target")

    def pull():
        return drain(stream_items(stream_landed(spark, landing, files_per_batch=1), fx.EVENT), target)

    land_pages(pages.filter("page <= 2"), landing)
    assert pull().count() == 400
    assert pull().count() == 400
    land_pages(pages.filter("page > 2"), landing, mode="append")
    assert rows(pull()) == rows(unnest_typed(pages_from_table(spark, landing, "event"), fx.EVENT))
    assert pull().count() == 1000


def test_untyped_stream(spark):
    landing = new_folder(spark, "landing")
    land_pages(fx.contact_pages(spark, SF), landing)
    items = drain(stream_items(stream_landed(spark, landing)))
    assert items.columns == ["dataset", "page", "total", "pos", "item"]
    assert items.count() == 150
