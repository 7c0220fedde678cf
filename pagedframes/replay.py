"""Landed bodies in the part of an API: for tests, queries and re-runs, as ``fixtures`` are."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagedframes.constants import BLOCK_PAGES
from pagedframes.sources.transport import NotFound, Paging, Transport

_BUFFER = 1 << 20  # bytes of a file that are read ahead
_DECODED = 16  # pages that are decoded together


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class LandedTransport(Transport):
    """Replays the pages of a landing table (``landed.land_pages``).

    ``datasets`` names the dataset that an endpoint, with its parameters, stands
    for; the dataset of any other endpoint bears the endpoint's own name.
    """

    def __init__(self, path: str, datasets: Mapping[str, str] | None = None):
        self.path, self.datasets = path, dict(datasets or {})

    def _block(self, block: int, condition) -> Iterator[tuple[int, str]]:
        filesystem, path = _opened(self.path)
        folder = f"{path}/block={block}"
        if filesystem.get_file_info(folder).type == fs.FileType.NotFound:
            return
        # bodies are large: row groups that cannot hold a page are passed over, the others decoded a few pages at a time
        for fragment in ds.dataset(folder, filesystem=filesystem, format="parquet").get_fragments(condition):
            groups = [group.id for part in fragment.split_by_row_group(condition) for group in part.row_groups]
            with pq.ParquetFile(filesystem.open_input_file(fragment.path), buffer_size=_BUFFER, pre_buffer=False) as file:
                for batch in file.iter_batches(_DECODED, groups, ["dataset", "page", "body"], use_threads=False):
                    held = batch.filter(condition)
                    yield from zip(held.column("page").to_pylist(), held.column("body").to_pylist())

    def pages(self, endpoint: str, first: int, last: int | None, paging: Paging) -> Iterator[tuple[int, str]]:
        condition = (pc.field("dataset") == self.datasets.get(endpoint, endpoint)) & (pc.field("page") >= first)
        if last is not None:
            condition = condition & (pc.field("page") <= last)
        block = (first - 1) // BLOCK_PAGES
        while last is None or block <= (last - 1) // BLOCK_PAGES:
            found = False
            for found_page in self._block(block, condition):
                found = True
                self.pace()
                yield found_page
            if last is None and not found:
                return
            block += 1


BUCKETS = 64
_SPAN = (1 << 32) // BUCKETS  # places in one bucket
_GROUP = 1 << 20  # bytes of bodies that are read together


def _place(url: Column) -> Column:
    return F.crc32(F.encode(url, "UTF-8"))


def land_bodies(bodies: DataFrame, path: str) -> None:
    """Write ``url, body`` so that a body is found by its URL: ordered by place, in small row groups."""
    placed = bodies.select("url", "body", _place(F.col("url")).alias("place"))
    bucketed = placed.withColumn("bucket", F.expr(f"place div {_SPAN}")).repartition("bucket")
    writer = bucketed.sortWithinPartitions("bucket", "place").write.option("parquet.block.size", _GROUP)
    writer.partitionBy("bucket").parquet(path)


class LandedBodies(Transport):
    """Replays single bodies that ``land_bodies`` wrote; holds those of one row group at a time."""

    def __init__(self, path: str):
        self.path = path
        self.bucket: tuple[int | None, list] = (None, [])
        self.held: tuple[int, int, dict[str, str]] = (1, 0, {})  # all bodies from the first place to the last

    def place(self, url: Column) -> Column:
        return _place(url)

    def _groups(self, bucket: int) -> list[tuple[int, int, ds.ParquetFileFragment]]:
        """First place, last place and row group, for all row groups of a bucket."""
        if self.bucket[0] != bucket:
            filesystem, path = _opened(self.path)
            folder, found = f"{path}/bucket={bucket}", []
            if filesystem.get_file_info(folder).type != fs.FileType.NotFound:
                for fragment in ds.dataset(folder, filesystem=filesystem, format="parquet").get_fragments():
                    for part in fragment.split_by_row_group():
                        places = part.row_groups[0].statistics["place"]
                        found.append((places["min"], places["max"], part))
            self.bucket = bucket, found
        return self.bucket[1]

    def _around(self, place: int) -> tuple[int, int, dict[str, str]]:
        bucket = place // _SPAN
        low, high, rows = bucket * _SPAN, (bucket + 1) * _SPAN - 1, {}
        for first, last, part in self._groups(bucket):
            if last < place:
                low = max(low, last + 1)
            elif first > place:
                high = min(high, first - 1)
            else:
                low, high = max(low, first), min(high, last)
                table = part.to_table(columns=["url", "body"], use_threads=False)
                rows.update(zip(table["url"].to_pylist(), table["body"].to_pylist()))
        return low, high, rows

    def get(self, url: str) -> str:
        place = zlib.crc32(url.encode())
        if not self.held[0] <= place <= self.held[1]:
            self.held = self._around(place)
        if url not in self.held[2]:
            raise NotFound(url)
        return self.held[2][url]
