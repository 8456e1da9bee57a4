"""Types as trees: what changed inside a struct, an array or a map.

A type's text nests without a bound, which no built-in function follows, so the
comparison of two texts is a small Python helper. It runs in Arrow batches and
compares each distinct pair of a batch once.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGES = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("path", "change_type", "old_type", "new_type")]))
TOKEN = re.compile(r"`(?:[^`]|``)*`|[<>(),:]|[^<>(),:`\s]+")


def tree(text: str) -> tuple:
    """``("struct", {name: tree})``, ``("array", tree)``, ``("map", key, value)`` or ``(text,)``.

    Text that is no type of this form is a leaf as it stands.
    """
    tokens = TOKEN.findall(text)

    def one(at: int) -> tuple[tuple, int]:
        kind, following = tokens[at], tokens[at + 1 : at + 2]
        if kind in ("struct", "array", "map") and following == ["<"]:
            at, parts = at + 2, []
            while tokens[at] != ">":
                name = None
                if kind == "struct":
                    name, colon = tokens[at].strip("`"), tokens[at + 1]
                    if colon != ":":
                        raise ValueError(text)
                    at += 2
                part, at = one(at)
                parts.append((name, part))
                if tokens[at] == ",":
                    at += 1
            wanted = {"array": 1, "map": 2}.get(kind, len(parts))
            if len(parts) != wanted or len({n for n, _ in parts}) != len(parts) and kind == "struct":
                raise ValueError(text)
            return (kind, dict(parts)) if kind == "struct" else (kind, *[p for _, p in parts]), at + 1
        if not re.fullmatch(r"[a-z_]\w*", kind):
            raise ValueError(text)
        if following == ["("]:
            end = tokens.index(")", at)
            return (kind + "".join(tokens[at + 1 : end + 1]),), end + 1
        return (kind,), at + 1

    try:
        found, end = one(0)
        return found if end == len(tokens) else (text.strip(),)
    except (IndexError, ValueError):
        return (text.strip(),)


def written(node: tuple) -> str:
    if node[0] == "struct" and len(node) == 2:
        return "struct<" + ",".join(f"{n}:{written(t)}" for n, t in node[1].items()) + ">"
    return node[0] if len(node) == 1 else f"{node[0]}<{','.join(written(t) for t in node[1:])}>"


def widened(old: str, new: str) -> bool:
    """A decimal that only gained digits."""
    sizes = [re.fullmatch(r"decimal\((\d+),(\d+)\)", t) for t in (old, new)]
    if None in sizes:
        return False
    (p, s), (q, r) = [(int(m[1]), int(m[2])) for m in sizes]
    return r >= s and q - r >= p - s


def changes(old: tuple, new: tuple, path: str) -> list[tuple]:
    """``(path, change_type, old_type, new_type)`` of the outermost differences, in order of the old type, then of the new one."""
    if old == new:
        return []
    if old[0] != new[0] or len(old) == 1 or len(new) == 1:
        kind = "widened" if len(old) == len(new) == 1 and widened(old[0], new[0]) else "type_changed"
        return [(path, kind, written(old), written(new))]
    if old[0] == "struct":
        out = []
        for name, part in old[1].items():
            at = f"{path}.{name}"
            out += changes(part, new[1][name], at) if name in new[1] else [(at, "removed", written(part), None)]
        return out + [(f"{path}.{n}", "added", None, written(t)) for n, t in new[1].items() if n not in old[1]]
    steps = ("[]",) if old[0] == "array" else ("{key}", "{value}")
    return [c for step, a, b in zip(steps, old[1:], new[1:], strict=True) for c in changes(a, b, path + step)]


@F.pandas_udf(CHANGES)
def type_changes(paths: pd.Series, olds: pd.Series, news: pd.Series) -> pd.Series:
    """Changes between two type texts, each path led by the text in ``paths``; none where a text is null."""
    known: dict[tuple, list] = {}
    out = []
    for path, pair in zip(paths, zip(olds, news, strict=True), strict=True):
        if None in pair:
            out.append([])
            continue
        if pair not in known:
            known[pair] = changes(tree(pair[0]), tree(pair[1]), "")
        out.append([{"path": path + p, "change_type": k, "old_type": a, "new_type": b} for p, k, a, b in known[pair]])
    return pd.Series(out)
