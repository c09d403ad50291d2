"""Texts at a key path of JSON values of any shape: every value is walked by its own kind, with no inferred schema.

Each JSON text is parsed on its own into a VARIANT (``try_parse_json``), so files or rows of different shapes never
share a type: ``{"text": "one"}``, ``{"text": ["x", "y"]}`` and a list at the top give one, two and as many texts as
the list has elements. The walk goes by rounds. In each, a value that is a list is replaced by its elements (the same
keys still to go); an object with the next key by that key's value; an object without it, or a scalar where keys
remain, is a miss. A value with no key left is a text: a string as it is, an object as JSON (keys in sorted order, as
VARIANT holds them), ``True``/``False``, ``None`` for JSON null, numbers in their JSON form. Lists nested to any depth
are flattened, in document order (``position`` holds the index of every list passed on the way). Every round is
written to the shared folder, so the plan doesn't grow with the depth, and the walk ends when no value is open.

Input rows whose JSON is broken (or NULL) give a ``broken`` outcome, misses a ``missing`` outcome with the key that
was looked for; nothing is dropped without an outcome row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.lineage import cut_lineage

OUTCOME = "text string, outcome string, detail string, position array<int>"


def _leaf_text(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit("None"))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string"))
        .when(kind.startswith("OBJECT"), F.to_json(v))
        .when(kind == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), "True").otherwise("False"))
        .when(kind == "VOID", F.lit("None"))
        .otherwise(F.to_json(v))
    )


def walk_json(rows: DataFrame, json_text: Column, keys: list[str], carry: list[str]) -> DataFrame:
    """(carry..., text, outcome, detail, position) for every text, miss and broken value.

    ``outcome`` is ``text`` (with its ``text``), ``missing`` (``detail`` the key that wasn't found) or ``broken``
    (``detail``: why). ``position`` orders the texts of one input row as in its document.
    """
    spark = rows.sparkSession
    parsed = rows.select(*carry, F.try_parse_json(json_text).alias("__v"))
    broken = parsed.filter(F.col("__v").isNull()).select(
        *carry, F.lit(None).cast("string").alias("text"), F.lit("broken").alias("outcome"),
        F.lit("not JSON").alias("detail"), F.array().cast("array<int>").alias("position"),
    )
    open_ = parsed.filter(F.col("__v").isNotNull()).select(
        *carry, "__v", F.lit(0).alias("__k"), F.array().cast("array<int>").alias("position")
    )
    names = F.array(*[F.lit(k) for k in keys]) if keys else F.array().cast("array<string>")
    finished = [broken]
    while True:
        items = F.try_variant_get("__v", "$", "array<variant>")
        fields = F.try_variant_get("__v", "$", "map<string,variant>")
        wanted = F.try_element_at(names, F.col("__k") + 1)
        child = F.try_element_at(fields, wanted)
        kind = (
            F.when(items.isNotNull(), "list")
            .when(F.col("__k") >= len(keys), "text")
            .when(child.isNotNull(), "step")
            .otherwise("missing")
        )
        step = cut_lineage(
            open_.select(
                *carry, "__v", "__k", "position", kind.alias("__kind"), items.alias("__items"), child.alias("__child"),
                wanted.alias("__wanted"),
            ),
            "json-walk",
        )
        finished.append(
            step.filter("__kind = 'text'").select(
                *carry, _leaf_text(F.col("__v")).alias("text"), F.lit("text").alias("outcome"),
                F.lit(None).cast("string").alias("detail"), "position",
            )
        )
        finished.append(
            step.filter("__kind = 'missing'").select(
                *carry, F.lit(None).cast("string").alias("text"), F.lit("missing").alias("outcome"),
                F.col("__wanted").alias("detail"), "position",
            )
        )
        lists = step.filter("__kind = 'list'").select(*carry, F.posexplode("__items").alias("__i", "__v"), "__k", "position")
        lists = lists.select(*carry, "__v", "__k", F.concat("position", F.array(F.col("__i").cast("int"))).alias("position"))
        steps = step.filter("__kind = 'step'").select(*carry, F.col("__child").alias("__v"), (F.col("__k") + 1).alias("__k"), "position")
        open_ = lists.unionByName(steps)
        if step.filter("__kind in ('list', 'step')").isEmpty():
            break
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return out
