"""What the training-data operators share: stages, row keys, batch sizes, text rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from biblioflow.sources.batches import small_batches
from biblioflow.sources.stages import new_path, release, sized
from biblioflow.sources.stages import staged as table

__all__ = ["ascii_lower", "crc_fold", "deal_key", "new_path", "release", "row_key", "sized", "small_batches", "spare", "table", "utf8"]

def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def spare(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _marked(c: Column, kind: DataType) -> list[Column]:
    """Whether a value is null, and the value in a form that is hashed whole."""
    return [c.isNull(), _hashable(c, kind)]


def _hashable(c: Column, kind: DataType) -> Column:
    match kind:
        case StructType():
            return F.struct(F.lit(len(kind)), *[x for f in kind for x in _marked(c[f.name], f.dataType)])
        case ArrayType():
            return F.transform(c, lambda e: F.struct(*_marked(e, kind.elementType)))
        case MapType():
            entry = lambda k: F.struct(*_marked(k, kind.keyType), *_marked(F.element_at(c, k), kind.valueType))
            return F.transform(F.array_sort(F.map_keys(c)), entry)
        case VariantType():
            return F.to_json(c)
    return c


def row_key(df: DataFrame) -> Column:
    """A key of a row by all its columns, 128 bits: only rows alike in every column share it, nulls inside them included.

    Maps are alike if their entries are, in whatever order; variants, if their JSON texts are.
    """
    cells = [c for f in df.schema for c in _marked(df[f"`{f.name}`"], f.dataType)]
    return F.struct(F.xxhash64(*cells).alias("high"), F.xxhash64(F.lit(1), *cells).alias("low"))


def deal_key(df: DataFrame) -> Column:
    """A hash of a row by all its columns, to deal rows by; plain enough to be the argument of a Python function."""
    plain = [df[f"`{f.name}`"] for f in df.schema if not isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType))]
    rest = [df[f"`{f.name}`"].alias(f"c{k}") for k, f in enumerate(df.schema) if isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType))]
    return F.xxhash64(*plain, *([F.to_json(F.struct(*rest))] if rest else []), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; no other character changes."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(texts: Iterable) -> Iterable[bytes]:
    """UTF-8 bytes of each text; null gives none."""
    return (b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts)
