"""What the typed parse loses (2.7): values of the wrong type and fields that
no schema declares.

``from_json`` with a declared schema turns a wrong-typed value into NULL and
drops undeclared fields without a trace.  Here the message is parsed once more,
into a VARIANT, and every field that has a value there and none in the typed
row is kept, as text, in the map ``rescued``.  The typed columns are those of
``parse.typed``, unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import BY_TYPE

RESCUED = "rescued"


def typed_with_rescue(messages: DataFrame, kind: str) -> DataFrame:
    """The typed events of one kind, broker time, and ``rescued``: map of field
    to raw text, empty where nothing was lost."""
    schema = BY_TYPE[kind]
    # the generator keeps the two parses below the filters, as in parse.typed
    data = messages.select(F.inline(F.array(F.struct(F.from_json("json", schema).alias("data"), raw_fields("json").alias("_raw")))), "kafka_timestamp")
    data = data.filter(F.col("data.data_type") == F.lit(kind))
    return data.select("data.*", "kafka_timestamp", lost_fields(F.col("_raw"), "data", schema).alias(RESCUED))


def raw_fields(json: str) -> Column:
    """The fields of a message as text, from one VARIANT parse; NULL for no object."""
    return F.try_variant_get(F.try_parse_json(json), "$", "map<string,string>")


def lost_fields(raw: Column, data: str, schema: StructType) -> Column:
    """Those of ``raw`` that have no value in the typed struct ``data``."""
    names = [f.name for f in schema.fields]
    read = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"{data}.{n}").isNotNull() for n in names]))
    lost = F.map_filter(raw, lambda field, value: value.isNotNull() & ~F.coalesce(F.element_at(read, field), F.lit(False)))
    return F.coalesce(lost, F.create_map().cast("map<string,string>"))


def rescued_fields(messages: DataFrame, kind: str, key: str) -> DataFrame:
    """One row per lost value: (key, field, raw)."""
    rows = typed_with_rescue(messages, kind).filter(F.size(RESCUED) > 0)
    return rows.select(key, F.explode(RESCUED).alias("field", "raw"))
