"""Weather archives made from the readings, to have something to unpack."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.schemas import DATE_PARTS


MEMBER_ROWS = 100_000


def _zip_rows(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, most = DATE_PARTS, MEMBER_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import zipfile

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        final = f"{base}/{task.partitionId()}.zip"
        # A name of its own per attempt; only a finished archive gets the final name.
        draft = f"{final}.{task.taskAttemptId()}-{os.getpid()}"
        written = 0
        held = {}  # rows of a day that no member has yet
        numbers = {}

        with store.open_output_stream(draft) as raw, zipfile.ZipFile(raw, "w") as archive:

            def write(day, rows):
                nonlocal written
                numbers[day] = numbers.get(day, -1) + 1
                sink = pa.BufferOutputStream()
                pq.write_table(rows, sink)
                place = "year={}/month={:02d}/day={:02d}".format(*day)
                name = f"export/weather/{place}/part-{task.partitionId()}-{numbers[day]}.parquet"
                archive.writestr(name, sink.getvalue().to_pybytes())
                written += 1

            for batch in batches:
                rows = pa.Table.from_batches([batch])
                days = [tuple(key[part] for part in parts) for key in rows.select(list(parts)).group_by(list(parts)).aggregate([]).to_pylist()]
                for day in [day for day in held if day not in days]:
                    write(day, held.pop(day))
                for day in days:
                    mask = None
                    for part, value in zip(parts, day):
                        same = pc.equal(rows[part], value)
                        mask = same if mask is None else pc.and_(mask, same)
                    own = rows.filter(mask).drop_columns(list(parts))
                    held[day] = pa.concat_tables([held[day], own]) if day in held else own
                    while held[day].num_rows >= most:
                        write(day, held[day].slice(0, most))
                        held[day] = held[day].slice(most)
            for day, own in held.items():
                if own.num_rows:
                    write(day, own)
        store.move(draft, final)
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["members"])

    return run


def write_archives(readings: DataFrame, folder: str) -> int:
    """One archive per task; returns the member count. A day's rows make a member for each
    ``MEMBER_ROWS`` of them, numbered within task and day; in tasks that do not come sorted by
    day there are more, as a day is written when a batch has none of it."""
    made = readings.mapInArrow(_zip_rows(folder), "members long")
    return made.agg(F.sum("members")).first()[0]
