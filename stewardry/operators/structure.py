"""Which paths and types occur in a corpus of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.functions.spans import let
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small

_NODES = "array<struct<path:string,type:string,value:variant>>"
# NaN as a bare token: after a colon, comma or opening bracket and before the next one.
_BARE_NAN = r"(?<=[:,\[])(\s*)NaN(?=\s*[,\]}])"


def _type_name(value: Column) -> Column:
    """Name of the JSON value's type as a Python reader has it."""
    # the schema of a value is found by going through all of it
    return let(F.schema_of_variant(value), _type_of_schema)


def _type_of_schema(schema: Column) -> Column:
    return (
        F.when(F.startswith(schema, F.lit("OBJECT")), F.lit("dict"))
        .when(F.startswith(schema, F.lit("ARRAY")), F.lit("list"))
        .when(schema == "STRING", F.lit("str"))
        .when(schema == "BOOLEAN", F.lit("bool"))
        .when(schema == "VOID", F.lit("NoneType"))
        .when(schema == "BIGINT", F.lit("int"))
        # Whole numbers too large for a long; a number with a point has fewer digits or a scale.
        .when(schema.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), F.lit("int"))
        .otherwise(F.lit("float"))
    )


def _children(node: Column) -> Column:
    """The nodes right below a node, under their paths."""
    value, path = node["value"], node["path"]

    def of_entry(entry: Column) -> Column:
        return F.struct(
            F.when(path == "", entry["key"]).otherwise(F.concat(path, F.lit("."), entry["key"])).alias("path"),
            _type_name(entry["value"]).alias("type"),
            entry["value"].alias("value"),
        )

    def of_first(first: Column) -> Column:
        inner = F.when(first.isNull(), F.lit("empty")).otherwise(_type_name(first))
        return F.struct(
            path.alias("path"), F.concat(F.lit("list["), inner, F.lit("]")).alias("type"),
            first.alias("value"),
        )

    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    first = F.try_variant_get(value, "$[0]", "variant")
    return (
        F.when(node["type"].isin("dict", "list[dict]"), F.transform(entries, of_entry))
        .when(
            node["type"].isin("list", "list[list]"),
            let(F.struct(first.alias("v")), lambda s: F.array(of_first(s["v"]))),
        )
        .otherwise(F.array().cast(_NODES))
    )


def _labels(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: F.struct(n["path"].alias("path"), n["type"].alias("type")))


def json_nodes(json: Column | str) -> Column:
    """`array<struct<path, type>>` of a document, level by level to its last.

    Every object member gives its path and type; a list gives `list[type of its first
    item]` (`list[empty]` without one) and is entered at that item under the same path.
    Broken JSON gives NULL; bare NaN tokens are read as null where parsing fails.
    """
    json = F.col(json) if isinstance(json, str) else json
    value = F.coalesce(
        F.try_parse_json(json), F.try_parse_json(F.regexp_replace(json, _BARE_NAN, "$1null"))
    )
    root = F.array(F.struct(F.lit("").alias("path"), _type_name(value).alias("type"), value.alias("value")))
    state = F.aggregate(
        # no document has more levels than opening brackets
        F.sequence(F.lit(1), F.length(json) - F.length(F.translate(json, "{[", "")) + 1),
        F.struct(root.cast(_NODES).alias("level"), F.array().cast("array<struct<path:string,type:string>>").alias("all")),
        lambda acc, _: F.when(F.size(acc["level"]) == 0, acc).otherwise(let(
            F.flatten(F.transform(acc["level"], _children)),
            lambda below: F.struct(
                below.alias("level"), F.concat(acc["all"], _labels(below)).alias("all")
            ),
        )),
        lambda acc: acc["all"],
    )
    return F.when(value.isNotNull(), state)


def json_structure(docs: DataFrame, json: str) -> DataFrame:
    """`path, type, n`: one scan, then one aggregate that combines before its shuffle."""
    walked = compute_once(spread_small(docs.select(json)), _nodes=json_nodes(json))
    nodes = walked.select(F.explode("_nodes").alias("_node"))
    return nodes.groupBy(
        F.col("_node.path").alias("path"), F.col("_node.type").alias("type")
    ).agg(F.count(F.lit(1)).alias("n"))
