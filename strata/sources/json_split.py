"""Large JSON arrays read by many tasks (A4).

A file that holds one array of objects is cut at every ``}`` by Spark's text
reader, which splits files into byte ranges. Whether such a cut ends an element
depends on all text before it: is it inside a string, and how deep. The effect
of a byte range on (inside a string, depth) is worked out for both possible
starts, the effects of a file's ranges are composed in order (one small row a
range), and in a second pass every range knows its start and gives its whole
elements; only the pieces at the borders of ranges are put together afterwards.
A cut never falls behind a backslash, so escapes do not cross it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.files import as_struct

_ESCAPE = re.compile(r"\\.", re.DOTALL)


def effect(fragment: str, inside: bool) -> tuple[bool, int]:
    """(inside a string at the end, change of depth) of a fragment and the
    ``}`` that cut it off."""
    parts = _ESCAPE.sub("", fragment).split('"')
    depth = 0
    for p in parts[1 if inside else 0::2]:  # the parts outside of strings
        depth += p.count("{") + p.count("[") - p.count("}") - p.count("]")
    inside ^= len(parts) % 2 == 0
    return inside, depth if inside else depth - 1


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Fragments of each (file, start of range), in order."""
    at: list = [None]

    def rows() -> Iterator[tuple[tuple[str, int], str]]:
        for b in batches:
            yield from zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2).to_pylist())

    source = rows()
    first = next(source, None)
    while first is not None:
        key, text = first
        at[0] = None

        def own(key=key, text=text) -> Iterator[str]:
            yield text
            for k, t in source:
                if k != key:
                    at[0] = (k, t)
                    return
                yield t

        fragments = own()
        yield key, fragments
        for _ in fragments:  # whatever the caller left
            pass
        first = at[0]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), fragments in _ranges(batches):
        outer, inner, d_outer, d_inner = False, True, 0, 0
        for f in fragments:
            outer, d = effect(f, outer)
            d_outer += d
            inner, d = effect(f, inner)
            d_inner += d
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in (
            (file, pa.string()), (start, pa.int64()), (outer, pa.bool_()), (d_outer, pa.int64()), (inner, pa.bool_()), (d_inner, pa.int64()))],
            ["file", "start", "outer", "d_outer", "inner", "d_inner"])


def _starts(t: pa.Table) -> pa.Table:
    """Start state of each range of a file, from the effects in order."""
    rows, inside, depth, out = t.sort_by("start").to_pylist(), False, 0, []
    for r in rows:
        out.append((r["file"], r["start"], inside, depth))
        depth += r["d_inner"] if inside else r["d_outer"]
        inside = r["inner"] if inside else r["outer"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.bool_(), pa.int64()))], names=["file", "start", "inside", "depth"])


def _elements(batches: Iterator[pa.RecordBatch], starts: dict) -> Iterator[pa.RecordBatch]:
    """Whole elements (place NULL), and the pieces before the first and
    behind the last end of an element in a range (place 0 and 1; a range
    without an end is one piece of place 1)."""
    for (file, start), fragments in _ranges(batches):
        inside, depth = starts[(file, start)]
        piece, seen, out = [], False, []
        for f in fragments:
            inside, d = effect(f, inside)
            depth += d
            piece.append(f + "}")
            if not inside and depth == 1:  # in the array again: an element ended
                out.append(("".join(piece), None if seen else 0))
                piece, seen = [], True
            if len(out) >= 1000:
                yield _batch(file, start, out)
                out = []
        out.append(("".join(piece), 1))
        yield _batch(file, start, out)


def _batch(file: str, start: int, rows: list) -> pa.RecordBatch:
    text, place = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([file] * len(rows)), pa.array([start] * len(rows), pa.int64()), pa.array(place, pa.int32()),
                                       pa.array(text, pa.string())], ["file", "start", "place", "text"])


def _join_pieces(t: pa.Table) -> pa.Table:
    """The elements that lie across ranges of a file."""
    out, open_text = [], []
    for r in t.sort_by([("start", "ascending"), ("place", "ascending")]).to_pylist():
        open_text.append(r["text"])
        if r["place"] == 0:
            out.append("".join(open_text))
            open_text = []
    return pa.table([pa.array(out, pa.string())], names=["text"])


def read_json_array_split(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The objects of files that hold one JSON array of objects each, a file
    read in as many tasks as ``spark.sql.files.maxPartitionBytes`` cuts it
    into. Columns follow ``schema``; an empty array gives no rows, text behind
    the array is ignored, an element that does not fit the schema gives NULLs
    as ``from_json`` does."""
    schema = as_struct(schema)
    text = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    effects = text.mapInArrow(_effects, "file string, start long, outer boolean, d_outer long, inner boolean, d_inner long")
    starts = effects.groupBy("file").applyInArrow(_starts, "file string, start long, inside boolean, depth long")
    # one row a byte range: as many as the read has tasks
    known = {(r["file"], r["start"]): (r["inside"], r["depth"]) for r in starts.collect()}
    held = spark.sparkContext.broadcast(known)

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _elements(batches, held.value)

    found = text.mapInArrow(elements, "file string, start long, place int, text string")
    whole = found.where("place IS NULL").select("text")
    across = found.where("place IS NOT NULL").groupBy("file").applyInArrow(_join_pieces, "text string")
    clean = F.regexp_replace("text", r"^[\s,\[]+", "")
    return whole.unionAll(across).select(F.from_json(clean, schema).alias("e")).select("e.*")
