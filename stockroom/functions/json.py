"""JSON extraction from a string column.

Two forms with the same results on string-valued output:

* ``json_fields``        one ``get_json_object`` per output column (the
                          literal form: the document is parsed once per field);
* ``json_struct_fields`` one ``from_json`` with a declared all-STRING struct
                          (the document is parsed exactly once per row, also
                          when later filters use the extracted fields).

Both return a field's JSON text when it is an object/number/boolean, null when
the path is missing, the value is JSON null or the document is malformed.
Typing (dates, booleans) is done afterwards with casts so that ``"true"``
and ``true`` both become boolean true.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_fields(df: DataFrame, col: str, spec: Mapping[str, str]) -> DataFrame:
    """Add one column per ``{out: "$.json.path"}`` using ``get_json_object``."""
    return df.withColumns({out: F.get_json_object(F.col(col), path)
                           for out, path in spec.items()})


def _path_parts(path: str) -> list[str]:
    if not path.startswith("$."):
        raise ValueError(f"only dotted object paths are supported: {path!r}")
    return path[2:].split(".")


def all_string_schema(paths: list[str]) -> T.StructType:
    """Nested struct type covering the given dotted paths, leaves STRING."""
    tree: dict = {}
    for p in paths:
        node = tree
        parts = _path_parts(p)
        for i, part in enumerate(parts):
            if i == len(parts) - 1:
                node.setdefault(part, None)
            else:
                nxt = node.get(part)
                if nxt is None:
                    nxt = node[part] = {}
                node = nxt

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, T.StringType() if v is None else build(v), True)
            for k, v in node.items()
        ])

    return build(tree)


def json_struct_fields(df: DataFrame, col: str, spec: Mapping[str, str],
                       parsed: str = "__json") -> DataFrame:
    """Same output as :func:`json_fields`, parsing each document once.

    A path that is also the parent of another requested path would be a
    struct in the parsed schema, not JSON text; such paths are extracted with
    ``get_json_object`` instead.
    """
    paths = list(spec.values())
    nested = {p for p in paths if any(q.startswith(p + ".") for q in paths)}
    direct = {o: p for o, p in spec.items() if p in nested}
    spec = {o: p for o, p in spec.items() if p not in nested}
    if not spec:
        return json_fields(df, col, direct)
    schema = all_string_schema(list(spec.values()))
    # Parse barrier: the struct is emitted by a one-element generator, so a
    # later filter on an extracted field (e.g. "id is not null") is evaluated
    # on the parsed struct instead of being pushed below the projection and
    # re-parsing the document (Catalyst inlines aliases into pushed filters).
    out = df.select("*", F.explode(F.array(F.from_json(F.col(col), schema))).alias(parsed))

    def leaf(path: str) -> Column:
        c = F.col(parsed)
        for part in _path_parts(path):
            c = c.getField(part)
        return c

    out = out.withColumns({o: leaf(p) for o, p in spec.items()}).drop(parsed)
    return json_fields(out, col, direct) if direct else out
