"""Kernels over reads and their windows of the reference: equal pairs of both meet in one task and are looked at once there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.session import shared_path, written

#: Pairs that a task remembers; with more it forgets them all and goes on.
MOST = 100_000
#: Pairs that a kernel gets at once.
TOGETHER = 512
TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def each_once(rows: DataFrame, windows: DataFrame, kernel: Callable[[list[str], list[str]], tuple[list, ...]], kind: str, parts: int) -> DataFrame:
    """ord and what kernel, which is blind to case, tells of each row's read in its window: the columns of kind.

    rows: ord, chrom, s, e, read. windows: chrom, s, e, seq, each once. kernel: from reads and windows a list of values for each column. Windows of one text
    count as one, and only its number travels with the reads, which are dealt to so many parts by both.
    """
    keep = shared_path(rows.sparkSession, "windows")
    fetched = written(windows.withColumn("seq", F.upper("seq")), f"{keep}/fetched")
    texts = written(fetched.select("seq").distinct().withColumn("text", F.monotonically_increasing_id()), f"{keep}/texts")
    told = written(fetched.join(texts, "seq").select("chrom", "s", "e", "text"), f"{keep}/told")
    met = rows.join(told, ["chrom", "s", "e"]).select("ord", "read", "text").repartition(parts, "read", "text").join(texts, "text")
    columns = dict(x.split() for x in kind.split(", "))
    return met.select("ord", "read", "seq").mapInArrow(lambda batches: _told(batches, kernel, columns), f"ord long, {kind}")


def _told(batches: Iterator[pa.RecordBatch], kernel: Callable, columns: dict[str, str]) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    values: list[list] = [[] for _ in columns]
    for b in batches:
        pairs = pc.binary_join_element_wise(b.column("read"), b.column("seq"), "\n").dictionary_encode()
        own = pairs.dictionary.to_pylist()
        new = [x for x in own if x not in known]
        if len(known) + len(new) > MOST:
            known, values, new = {}, [[] for _ in columns], own
        for i in range(0, len(new), TOGETHER):
            some = new[i : i + TOGETHER]
            known.update(zip(some, range(len(known), len(known) + len(some))))
            for column, more in zip(values, kernel(*zip(*(x.split("\n") for x in some)))):
                column += more
        at = [known[x] for x in own]
        made = [pa.array([column[i] for i in at], TYPES[t]).take(pairs.indices) for column, t in zip(values, columns.values())]
        yield pa.record_batch([b.column("ord"), *made], names=["ord", *columns])
