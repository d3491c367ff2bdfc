"""Rules written as data, compiled to boolean Columns the optimizer can push down."""

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F, types as T

from ..schemas import INACTIVE


def _known(condition):
    """Three-valued logic to two-valued: unknown does not match."""
    return F.coalesce(condition, F.lit(False))


def all_of(conditions) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions) -> Column:
    return reduce(or_, conditions, F.lit(False))


def active(status: str | Column = "status") -> Column:
    """Neither deprecated nor deleted; a missing status counts as active."""
    column = F.col(status) if isinstance(status, str) else status
    return column.isNull() | ~column.isin(*INACTIVE)


def has_key(mapping: Column, key: str) -> Column:
    return _known(F.map_contains_key(mapping, F.lit(key)))


def lacks_key(mapping: Column, key: str) -> Column:
    return ~has_key(mapping, key)


def field_path(path: str) -> Column:
    """``a.b.c`` through structs and maps alike."""
    first, *rest = path.split(".")
    return reduce(lambda column, step: column[step], rest, F.col(f"`{first}`"))


def _type_of(schema, path):
    node = schema
    for step in path.split("."):
        if isinstance(node, T.StructType) and step in node.names:
            node = node[step].dataType
        elif isinstance(node, T.MapType):
            node = node.valueType
        else:
            return None
    return node


def _as_list(value):
    return list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]


def _is_any(column, values, is_array):
    """The field equals one of the values; an array field matches by any element, null by None."""
    present = [v for v in values if v is not None]
    tests = [column.isNull()] if len(present) < len(values) else []
    if present and is_array:
        tests.append(F.arrays_overlap(column, F.array(*[F.lit(v) for v in present])))
    elif present:
        tests.append(column.isin(*present))
    return _known(any_of(tests))


_ORDERED = {
    "gt": Column.__gt__, "gte": Column.__ge__, "lt": Column.__lt__, "lte": Column.__le__,
}


def compile_condition(field: str, type: str, value=None, schema: T.StructType | None = None) -> Column:
    """One ``{field, type, value}`` rule. Absent fields match ``ne``/``nin`` and nothing ordered."""
    column = field_path(field)
    is_array = isinstance(_type_of(schema, field), T.ArrayType) if schema else False
    if type in ("eq", "in"):
        return _is_any(column, _as_list(value), is_array)
    if type in ("ne", "nin"):
        return ~_is_any(column, _as_list(value), is_array)
    if type in _ORDERED:
        if is_array:
            return _known(F.exists(column, lambda item: _ORDERED[type](item, F.lit(value))))
        return _known(_ORDERED[type](column, F.lit(value)))
    if type == "exists":
        wanted = value is None or bool(value)
        return column.isNotNull() if wanted else column.isNull()
    raise ValueError(f"unknown condition type: {type}")


def compile_conditions(conditions, schema: T.StructType | None = None) -> Column:
    """All rules at once; two rules on one field both apply."""
    return all_of(
        compile_condition(c["field"], c["type"], c.get("value"), schema) for c in conditions
    )


def compile_requirements(requirements) -> Column:
    """File requirements such as ``is_file`` or ``size_gte 5`` over inventory columns."""
    tests = []
    for requirement in requirements or []:
        word, *argument = requirement.split()
        if word == "realpath":
            continue  # says which path to hand on, see requirement_path
        if word == "not_empty":
            tests.append(F.col("size") > 0)
        elif word == "size_gte":
            tests.append(F.col("size") >= int(argument[0]))
        elif word == "size_lte":
            tests.append(F.col("size") <= int(argument[0]))
        elif word in ("is_dir", "is_file", "is_symlink"):
            tests.append(F.col(word))
        else:
            raise ValueError(f"unknown file requirement: {requirement}")
    return _known(all_of(tests))


def requirement_path(requirements) -> Column:
    """The real path when the rules ask for it, else the link."""
    return F.col("filepath" if "realpath" in (requirements or []) else "symlink")


def mask_regex(mask: str) -> str:
    """A glob as an anchored regular expression over a name (or path tail, if it has a slash)."""
    return ("(^|/)" if "/" in mask else "^") + _mask_body(mask) + "$"


def _mask_body(mask):
    out, i = [], 0
    while i < len(mask):
        char = mask[i]
        closing = mask.find("]", i + (3 if mask[i + 1:i + 2] == "!" else 2)) if char == "[" else -1
        if char == "*":
            out.append("[^/]*")
        elif char == "?":
            out.append("[^/]")
        elif closing > 0:
            members = re.sub(r"([\\\[\]^&])", r"\\\1", mask[i + 1:closing])
            out.append("[" + ("^" + members[1:] if members[0] == "!" else members) + "]")
            i = closing
        else:
            out.append(re.escape(char) if not char.isalnum() and char != "_" else char)
        i += 1
    return "".join(out)


def matches_mask(name: Column, mask: str) -> Column:
    return name.rlike(mask_regex(mask))


def matches_mask_column(name: Column, mask: Column) -> Column:
    """The same with the mask in a column: the pattern is built per row."""
    # A class, or a single character; an opening bracket without a closing one is a character.
    parts = F.regexp_extract_all(mask, F.lit(r"(?s)\[(?:!.|[^!])[^\]]*\]|."), F.lit(0))

    def as_regex(part):
        inner = F.substr(part, F.lit(2), F.length(part) - 2)
        members = F.regexp_replace(inner, r"([\\\[\]^&])", r"\\$1")
        members = F.when(F.startswith(inner, F.lit("!")), F.concat(F.lit("^"), F.substr(members, F.lit(2)))).otherwise(members)
        return (F.when(F.length(part) > 1, F.concat(F.lit("["), members, F.lit("]")))
                .when(part == "*", F.lit("[^/]*")).when(part == "?", F.lit("[^/]"))
                .otherwise(F.regexp_replace(part, r"([\\.^$|()\[\]{}+])", r"\\$1")))

    start = F.when(F.contains(mask, F.lit("/")), F.lit("(^|/)")).otherwise(F.lit("^"))
    return F.rlike(name, F.concat(start, F.array_join(F.transform(parts, as_regex), ""), F.lit("$")))


def matching_masks(name: Column, masks) -> Column:
    """Every mask the name matches, as an array; each pattern is a compiled literal."""
    hits = F.array(*[F.when(matches_mask(name, m), F.lit(m)) for m in masks])
    return F.array_compact(hits)


def has_extension(name: Column, extensions) -> Column:
    return any_of(F.endswith(name, F.lit(e)) for e in extensions)


def matches_event_patterns(path: Column, patterns) -> Column:
    """Case-insensitive globs over an event's path; ``*`` also crosses folders here."""
    alternatives = "|".join(("(?:.*/)?" if "/" in p else "") + _mask_body(p).replace("[^/]*", ".*") for p in patterns)
    return path.rlike(f"(?i)^(?:{alternatives})$")
