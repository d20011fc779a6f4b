"""Schema evolution and rescued data."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

MALFORMED = "_malformed"
MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")


class SchemaChanged(Exception):
    """``failOnNewColumns``: the incoming files carry new columns."""


def _widen(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return evolve_schema(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_widen(a.elementType, b.elementType), True)
    numeric = ["byte", "short", "integer", "long", "float", "double"]
    if a.typeName() in numeric and b.typeName() in numeric:
        return a if numeric.index(a.typeName()) >= numeric.index(b.typeName()) else b
    return StringType()  # a type conflict widens to string


def evolve_schema(stored: StructType, incoming: StructType, mode: str = "addNewColumns") -> StructType:
    """The schema the next run should read with.

    * ``addNewColumns``: stored columns first, new columns appended, type
      conflicts widened (numeric -> wider numeric, structs and arrays field
      by field, otherwise string);
    * ``rescue``: the stored schema plus ``_rescued_data`` (new fields go
      there, see :func:`rescue_data`);
    * ``failOnNewColumns``: raise :class:`SchemaChanged` on new columns;
    * ``none``: the stored schema unchanged (new columns ignored).
    Files read with the wider schema give NULL for columns they lack.
    """
    if mode not in MODES:
        raise ValueError(mode)
    have = {f.name: f for f in stored.fields}
    new = [f for f in incoming.fields if f.name not in have]
    if mode == "none":
        return stored
    if mode == "failOnNewColumns":
        if new:
            raise SchemaChanged(", ".join(f.name for f in new))
        return stored
    if mode == "rescue":
        if "_rescued_data" in have:
            return stored
        return StructType(stored.fields + [StructField("_rescued_data", StringType(), True)])
    inc = {f.name: f for f in incoming.fields}
    fields = [StructField(f.name, _widen(f.dataType, inc[f.name].dataType) if f.name in inc else f.dataType, True)
              for f in stored.fields]
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in new])


def save_schema(schema: StructType) -> str:
    return schema.json()


def load_schema(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def rescue_data(text: Column | str, schema: StructType, rescued: str = "_rescued_data") -> Column:
    """Parse a JSON text column with ``schema``; fields outside the
    schema, or whose value does not fit its type, are kept as JSON text in
    ``rescued`` instead of failing or silently vanishing; text that is not a
    JSON object is kept whole under ``_malformed``.

    Returns a struct of the schema's fields plus ``rescued``.
    """
    t = F.col(text) if isinstance(text, str) else text
    parsed = F.from_json(t, schema)
    raw = F.from_json(t, "map<string,string>")
    names = [f.name for f in schema.fields]
    known = F.array(*[F.lit(n) for n in names])

    def bad(k, v):
        # a field of the schema that is present in the text but parsed NULL
        checks = None
        for n in names:
            c = (k == F.lit(n)) & v.isNotNull() & parsed.getField(n).isNull()
            checks = c if checks is None else (checks | c)
        return (~F.array_contains(known, k)) | (checks if checks is not None else F.lit(False))

    leftover = F.map_filter(raw, bad)
    # text that is no JSON object at all is kept whole
    malformed = F.to_json(F.create_map(F.lit(MALFORMED), t))
    rescued_col = F.when(t.isNotNull() & raw.isNull(), malformed).when(F.size(leftover) > 0, F.to_json(leftover))
    return F.struct(*[parsed.getField(n).alias(n) for n in names], rescued_col.alias(rescued))


def with_rescued(df: DataFrame, text: str, schema: StructType, rescued: str = "_rescued_data") -> DataFrame:
    """A9 on a frame: replaces ``text`` by the schema's columns plus
    ``rescued``."""
    s = rescue_data(text, schema, rescued)
    return df.withColumn("_r", s).select(*[c for c in df.columns if c != text], "_r.*")


def _as_stored(c: Column, have: DataType, want: DataType) -> Column:
    """``c`` with the stored type: casts of atomic values, structs and arrays
    field by field; NULL where nothing fits."""
    if have == want:
        return c
    if isinstance(have, StructType) and isinstance(want, StructType):
        own = {f.name: f.dataType for f in have.fields}
        parts = [(_as_stored(c[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                 for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts)).cast(want)
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(c, lambda x: _as_stored(x, have.elementType, want.elementType)).cast(want)
    nested = [isinstance(t, (StructType, ArrayType)) or t.typeName() == "map" for t in (have, want)]
    if not any(nested):
        return c.try_cast(want)
    if isinstance(want, StringType):
        return F.to_json(c)
    return F.lit(None).cast(want)


def conform_to(df: DataFrame, stored: StructType, rescued: str = "_rescued_data") -> DataFrame:
    """Make newly arrived rows fit a table's stored schema (type conflicts
    do not break the table): a column whose type differs is converted to the
    stored type, nested ones field by field; a value that loses something on
    the way is kept, as text, in the JSON map ``rescued``, together with what
    the column holds already. New columns pass through (the reader adds them
    with ``mergeSchema``)."""
    have = {f.name: f.dataType for f in stored.fields}
    conflicts = [f for f in df.schema.fields if f.name in have and f.dataType != have[f.name] and f.name != rescued]
    if not conflicts:
        return df
    lost, fitted = [], {}
    for f in conflicts:
        c = F.col(f"`{f.name}`")
        new = _as_stored(c, f.dataType, have[f.name])
        nested = any(isinstance(t, (StructType, ArrayType)) or t.typeName() == "map" for t in (f.dataType, have[f.name]))
        if nested:  # compared as JSON: a field that found no place is a loss
            raw = F.to_json(c) if isinstance(f.dataType, (StructType, ArrayType)) or f.dataType.typeName() == "map" else c.cast("string")
            kept = F.to_json(new) if not isinstance(have[f.name], StringType) else new
            gone = c.isNotNull() & ~kept.eqNullSafe(raw)
        else:
            raw = c.cast("string")
            gone = c.isNotNull() & new.isNull()
        lost += [F.lit(f.name), F.when(gone, raw)]
        fitted[f.name] = new
    fresh = F.map_filter(F.create_map(*lost), lambda k, v: v.isNotNull())
    if rescued in df.columns:
        text = F.col(f"`{rescued}`")
        before = F.coalesce(F.from_json(text, "map<string,string>"), F.when(text.isNotNull(), F.create_map(F.lit(MALFORMED), text)),
                            F.create_map().cast("map<string,string>"))
        fresh = F.map_concat(F.map_filter(before, lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    note = F.when(F.size(fresh) > 0, F.to_json(fresh))
    cols = [fitted.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c != rescued]
    return df.select(*cols, note.alias(rescued))


def drifted_schema(spark, src: str, fmt: str, stored: StructType, mode: str = "addNewColumns",
                   sampling_ratio: float = 1.0, **opts) -> StructType:
    """Before a stream restart, infer the schema of the landed files
    (``samplingRatio`` bounds the inference read) and evolve the stored
    schema with it; restart the stream with the result so a new column
    appears after one restart and older rows read it as NULL."""
    r = spark.read.format(fmt).options(**opts)
    if fmt == "json":
        r = r.option("samplingRatio", sampling_ratio)
    incoming = r.load(src).schema
    return evolve_schema(stored, incoming, mode)
