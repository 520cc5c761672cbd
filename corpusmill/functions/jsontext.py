"""Expressions that turn JSON text into document content and metadata.

Values stay as raw JSON text, which keeps the key order of nested objects; a
parallel parse into VARIANT only tells the kind of each value.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import text as tx
from corpusmill.functions.batches import OBJECT_BYTES, piecewise
from corpusmill.functions.binding import let

_SCALAR_KINDS = ("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN", "VOID")
NO_METADATA = T.MapType(T.StringType(), T.StringType())
# Documents of one file, before they become rows.
ENTRY_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("seq_num", T.LongType()),
            T.StructField("content", T.StringType()),
            T.StructField("is_json", T.BooleanType()),
            T.StructField("metadata", NO_METADATA),
        ]
    )
)
ARROW_ENTRIES = pa.list_(
    pa.struct(
        [
            ("seq_num", pa.int64()), ("content", pa.string()), ("is_json", pa.bool_()),
            ("metadata", pa.map_(pa.string(), pa.string())),
        ]
    )
)
# Spark's parser takes up to 1000 levels; Python's printer needs a few frames for each.
_FRAMES = 10_000
# JSON proper: no single quotes.
_STRICT = {"allowSingleQuotes": "false"}


def accept_repeated_keys(spark: SparkSession) -> None:
    """Let a repeated key of an object keep its last value instead of being an error."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _parsed(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, _STRICT)


def _shown(value) -> str:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), _FRAMES))
    if isinstance(value, str):
        return value
    if isinstance(value, (dict, list)):
        return json.dumps(value, indent=2)
    return "" if value is None else str(value)


@piecewise(T.StringType(), OBJECT_BYTES)
def rendered(values: pa.Array) -> pa.Array:
    """Text form of a JSON value: objects and lists indented by two, scalars as ``str()``."""
    texts = [None if raw is None else _shown(json.loads(raw)) for raw in values.to_pylist()]
    return pa.array(texts, pa.string())


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, or the leading word of a scalar variant's type: STRING, BIGINT, VOID and so on.

    Lists and objects are told by a cast that looks at one level; only scalars have their
    schema derived, so depth and size of a value do not matter.
    """
    return (
        F.when(F.try_variant_get(value, "$", "array<variant>").isNotNull(), "ARRAY")
        .when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), "OBJECT")
        .otherwise(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))
    )


def _boxed(raw: Column, type_: str) -> Column:
    """The text as one value of the type; null unless it is exactly one."""
    wrapped = F.concat(F.lit('[{"v":'), raw, F.lit("}]"))
    boxes = _parsed(wrapped, f"array<map<string,{type_}>>")
    alone = lambda b: (F.size(b) == 1) & (F.size(F.get(b, 0)) == 1)
    return let(boxes, lambda b: F.when(alone(b), F.element_at(F.get(b, 0), "v")))


def one_value(raw: Column) -> Column:
    """The text as a single variant; null unless it is exactly one JSON value."""
    return _boxed(raw, "variant")


def is_json(raw: Column) -> Column:
    return F.coalesce(one_value(raw).isNotNull(), F.lit(False))


def document(
    raw: Column,
    value: Column,
    seq: Column,
    content_key: str | None,
    metadata_keys: list[str] | None,
    extra: Callable[[Column], Column] | None = None,
) -> Column:
    """One document struct from one JSON value, given as text and as variant.

    ``raw`` is the decoded text for strings and raw JSON for everything else.
    ``is_json`` marks content that still has to pass through :func:`rendered`.
    ``extra`` maps the kind of the value to further metadata.
    """

    return let(_described(raw, value), lambda item: _built(raw, item, seq, content_key, metadata_keys, extra))


def _built(raw: Column, item: Column, seq: Column, content_key, metadata_keys, extra=None) -> Column:
    """The document of a described value."""
    fields, kinds, is_object = item["fields"], item["kinds"], item["kind"] == "OBJECT"
    content, content_kind = raw, item["kind"]
    if content_key is not None:
        key = F.lit(content_key)
        content = F.when(is_object, F.coalesce(F.try_element_at(fields, key), F.lit(""))).otherwise(raw)
        inner = F.coalesce(F.try_element_at(kinds, key), F.lit("STRING"))
        content_kind = F.when(is_object, inner).otherwise(item["kind"])
    if metadata_keys:
        chosen = F.map_filter(fields, lambda k, _: k.isin(*metadata_keys))
    else:
        content_names = [] if content_key is None else [content_key]
        chosen = F.map_filter(
            fields, lambda k, _: F.element_at(kinds, k).isin(*_SCALAR_KINDS) & ~k.isin(content_names)
        )
    own = F.coalesce(chosen, F.create_map().cast(NO_METADATA))
    return F.struct(
        seq.cast("bigint").alias("seq_num"),
        F.when(content_kind == "VOID", "").otherwise(content).alias("content"),
        (~content_kind.isin("STRING", "VOID")).alias("is_json"),
        merged(extra(item["kind"]) if extra else None, own).alias("metadata"),
    )


def _described(raw: Column, value: Column) -> Column:
    """``struct<kind, fields, kinds>``; the maps are null unless the value is an object."""

    def describe(kind_: Column) -> Column:
        members = F.try_variant_get(F.when(kind_ == "OBJECT", value), "$", "map<string,variant>")
        return _with_fields(kind_, F.when(kind_ == "OBJECT", raw), members)

    return let(kind(value), describe)


def _with_fields(kind_: Column, object_text: Column, members: Column) -> Column:
    """``struct<kind, fields, kinds>`` of a value whose text and members are given if it is an object."""
    kinds = F.transform_values(members, lambda _, v: kind(v))
    fields = _parsed(object_text, "map<string,string>")
    # Numbers that are none come with quotes, which only strings shall have.
    plain = let(kinds, lambda k: F.transform_values(
        fields,
        lambda name, v: F.when(
            v.isin('"NaN"', '"Infinity"', '"-Infinity"') & (F.element_at(k, name) != "STRING"), F.replace(v, F.lit('"'))
        ).otherwise(v),
    ))
    return F.struct(kind_.alias("kind"), plain.alias("fields"), kinds.alias("kinds"))


def merged(base: Column | None, override: Column) -> Column:
    """Union of two maps; the second wins."""
    if base is None:
        return override
    return let(
        override,
        lambda o: F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(o, k)), o),
    )


def _items(list_text: Column, values: Column) -> Column:
    """``array<struct<raw, value>>`` of a JSON list."""
    return F.arrays_zip(_parsed(list_text, "array<string>").alias("raw"), values.alias("value"))


def whole_text_entries(
    text: Column, content_key: str | None = None, metadata_keys: list[str] | None = None
) -> Column:
    """Documents of one JSON text; null when the text is not JSON.

    A list gives one document per item. An object gives one per item of its first
    non-empty list, with the object's scalars as context, or else a single document. The
    text is parsed level by level, so that only its items need to fit into variants.
    """
    opening = F.regexp_extract(text, r"^[ \t\r\n]*([\[{])", 1)

    def all_of(items: Column, extra=None) -> Column:
        return F.transform(
            items, lambda e, i: document(e["raw"], e["value"], i, content_key, metadata_keys, extra)
        )

    def unfolded(item: Column, parent: Column, members: Column) -> Column:
        """Items of the list called ``parent`` of a described object."""
        siblings = F.map_filter(
            item["fields"],
            lambda k, _: (k != parent) & F.element_at(item["kinds"], k).isin(*_SCALAR_KINDS),
        )
        context = F.transform_keys(siblings, lambda k, _: F.concat(F.lit("context_"), k))
        origin = F.create_map(F.lit("parent_key"), parent)
        around = F.struct(origin.alias("others"), F.map_concat(origin, context).alias("objects"))
        values = F.try_variant_get(F.element_at(members, parent), "$", "array<variant>")
        items = _items(F.element_at(item["fields"], parent), values)
        return let(
            around,
            lambda a: all_of(items, lambda k: F.when(k == "OBJECT", a["objects"]).otherwise(a["others"])),
        )

    def of_object(members: Column) -> Column:
        def build(item: Column) -> Column:
            filled_lists = F.filter(
                F.json_object_keys(F.when(members.isNotNull(), text)),
                lambda k: (F.element_at(item["kinds"], k) == "ARRAY") & (F.element_at(item["fields"], k) != "[]"),
            )
            single = F.array(_built(text, item, F.lit(0), content_key, metadata_keys))
            return let(
                F.get(filled_lists, 0),
                lambda parent: F.when(parent.isNotNull(), unfolded(item, parent, members)).otherwise(single),
            )

        described = _with_fields(F.lit("OBJECT"), F.when(members.isNotNull(), text), members)
        return F.when(members.isNotNull(), let(described, build))

    def of_scalar(value: Column) -> Column:
        return F.when(value.isNotNull(), F.array(line_document(text, value, F.lit(0), content_key, metadata_keys)))

    def of_list(values: Column) -> Column:
        return F.when(values.isNotNull(), all_of(_items(text, values)))

    lists = _boxed(F.when(opening == "[", text), "array<variant>")
    objects = _boxed(F.when(opening == "{", text), "map<string,variant>")
    return (
        F.when(opening == "[", let(lists, of_list))
        .when(opening == "{", let(objects, of_object))
        .otherwise(let(one_value(F.when(opening == "", text)), of_scalar))
    )


def line_entries(
    text: Column, content_key: str | None = None, metadata_keys: list[str] | None = None
) -> Column:
    """Documents of JSON Lines text; blank and invalid lines are left out.

    ``seq_num`` is the 0-based number of the line, counting skipped ones.
    """
    stripped = F.transform(F.split(text, "\n"), lambda line, i: F.struct(tx.strip(line).alias("line"), i.alias("n")))
    filled = F.filter(stripped, lambda s: s["line"] != "")
    parsed = F.transform(
        filled, lambda s: F.struct(s["line"].alias("line"), s["n"].alias("n"), one_value(s["line"]).alias("value"))
    )
    valid = F.filter(parsed, lambda s: s["value"].isNotNull())
    return F.transform(
        valid, lambda s: line_document(s["line"], s["value"], s["n"], content_key, metadata_keys)
    )


def line_document(
    line: Column,
    value: Column,
    seq: Column,
    content_key: str | None = None,
    metadata_keys: list[str] | None = None,
) -> Column:
    """The document of a text that is one JSON value."""
    raw = F.when(kind(value) == "STRING", value.cast("string")).otherwise(line)
    return document(raw, value, seq, content_key, metadata_keys)
