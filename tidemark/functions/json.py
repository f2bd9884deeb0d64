"""JSON text helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import _col

PAGE_META = "Status string, ErrorMessage string, HttpStatus int, Timestamp string, page_no int"


def json_decimal(c: Column | str, path: str, precision: int = 38, scale: int = 6) -> Column:
    return F.get_json_object(_col(c), path).try_cast(f"decimal({precision},{scale})")


def page_meta(c: Column | str) -> Column:
    return F.from_json(_col(c), PAGE_META)


def to_json_text(*cs: Column) -> Column:
    """One JSON object per row, NULL members written out as null."""
    return F.to_json(F.struct(*cs), {"ignoreNullFields": "false"})


def is_json(c: Column | str) -> Column:
    """Whether a response body is JSON rather than plain text."""
    return F.try_parse_json(_col(c)).isNotNull()


def struct_of(fields: list[tuple[str, str]]) -> str:
    """Struct type text from (dotted path, type text) pairs; paths with a common head share a struct."""
    tree: dict = {}
    for path, kind in fields:
        node = tree
        *heads, leaf = path.split(".")
        for head in heads:
            node = node.setdefault(head, {})
        node[leaf] = kind

    def text(node: dict | str) -> str:
        if isinstance(node, str):
            return node
        return "struct<" + ",".join(f"`{name}`:{text(kind)}" for name, kind in node.items()) + ">"

    return text(tree)


def strings(names: str) -> str:
    """Struct type text in which every named field is text."""
    return struct_of([(name, "string") for name in names.split()])
